"""Selection lists such as ``USER_DATABASES,-test%,[x]`` (keys sel_*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.session import literal_table

# Keywords that stand for a group of databases.
DATABASE_KEYWORDS = {
    "ALL_DATABASES": None,
    "SYSTEM_DATABASES": "S",
    "USER_DATABASES": "U",
}


def parse_list(spec: str, delimiter: str = ",") -> list[tuple[str, bool, int]]:
    """(item, included, start position) of each list item; a leading ``-`` excludes."""
    clean = spec.replace("\n", "").replace("\r", "")
    out, position = [], 1
    items = [part.strip() for part in clean.split(delimiter)]
    for item in items:
        if item:
            out.append((item[1:] if item.startswith("-") else item, not item.startswith("-"), position))
        position += len(item) + len(delimiter)
    return out


def _unbracket(item: str) -> str:
    return item[1:-1] if item.startswith("[") and item.endswith("]") else item


def _matches(name: Column, pattern: str) -> Column:
    if pattern == "%":
        return name.isNotNull()
    if "%" not in pattern:
        return F.lower(name) == pattern.lower()
    return name.rlike(S.any_like_regex([pattern.replace("|", "||").replace("_", "|_")]))


def _decide(df: DataFrame, items: list[tuple[Column, bool, int]]) -> DataFrame:
    """Exclusions win over inclusions; the first including item gives the position."""
    included, excluded, position = F.lit(False), F.lit(False), F.lit(None).cast("bigint")
    for cond, include, start in reversed(items):
        if include:
            included = included | cond
            position = F.when(cond, F.lit(start).cast("bigint")).otherwise(position)
        else:
            excluded = excluded | cond
    return df.withColumn("selected", F.coalesce(included & ~excluded, F.lit(False))).withColumn(
        "start_position", position
    )


def sel_name_list(inventory: DataFrame, spec: str, delimiter: str = ",") -> DataFrame:
    """name, selected, start_position for an inventory of (name, database_type 'S'/'U').

    The list is a parameter of fixed size, so it compiles to one filter
    expression: no join, no shuffle.
    """
    items = []
    for item, include, start in parse_list(spec, delimiter):
        if item.upper() in DATABASE_KEYWORDS:
            wanted = DATABASE_KEYWORDS[item.upper()]
            cond = F.lit(True) if wanted is None else F.col("database_type") == wanted
        elif item.upper() == "AVAILABILITY_GROUP_DATABASES":
            cond = F.coalesce(F.col("in_availability_group"), F.lit(False))
        else:
            cond = _matches(F.col("name"), _unbracket(item))
        items.append((cond, include, start))
    kept = inventory.filter(F.lower("name") != "tempdb")
    return _decide(kept, items).select(*inventory.columns, "selected", "start_position")


# The forms of an object list: keyword for everything, the parts of a name, how many of them may be left out at its end.
OBJECT_FORMS = {
    "indexes": ("ALL_INDEXES", ("db", "schema", "object", "index"), 1),
    "objects": ("ALL_OBJECTS", ("db", "schema", "object"), 0),
    "filegroups": ("ALL_FILEGROUPS", ("db", "filegroup"), 0),
}


def split_object_name(item: str, form: str = "indexes") -> tuple[str, ...]:
    """The parts of a dotted name; dots inside brackets belong to a part, parts that may be missing mean any."""
    keyword, names, optional = OBJECT_FORMS[form]
    if item.upper() == keyword:
        return ("%",) * len(names)
    parts, depth, current = [], 0, ""
    for ch in item:
        if ch == "[":
            depth += 1
        if ch == "]":
            depth -= 1
        if ch == "." and depth == 0:
            parts.append(_unbracket(current))
            current = ""
        else:
            current += ch
    parts.append(_unbracket(current))
    if not len(names) - optional <= len(parts) <= len(names):
        raise ValueError(f"expected {'.'.join(names)}, got {item!r}")
    return (*parts, *("%",) * (len(names) - len(parts)))


def sel_object_list(objects: DataFrame, spec: str, delimiter: str = ",", form: str = "indexes") -> DataFrame:
    """Selection over rows of (db, schema, object, index), (db, schema, object) or (db, filegroup), as ``form`` says."""
    _, names, optional = OBJECT_FORMS[form]
    items = []
    for item, include, start in parse_list(spec, delimiter):
        cond = F.lit(True)
        for k, (name, part) in enumerate(zip(names, split_object_name(item, form), strict=True)):
            if k < len(names) - optional:
                cond = cond & _matches(F.col(name), part)
            elif part != "%":
                cond = cond & F.coalesce(_matches(F.col(name), part), F.lit(False))
        items.append((cond, include, start))
    return _decide(objects, items)


def sel_missing_names(inventory: DataFrame, spec: str, delimiter: str = ",") -> DataFrame:
    """Names the list asks for explicitly that the inventory does not have."""
    wanted = [
        _unbracket(item)
        for item, _, _ in parse_list(spec, delimiter)
        if "%" not in item and item.upper() not in {*DATABASE_KEYWORDS, "AVAILABILITY_GROUP_DATABASES"}
    ]
    names = literal_table(inventory.sparkSession, [(n,) for n in wanted], "missing_name string")
    present = (
        inventory.select(F.lower("name").alias("_name"))
        .filter(F.col("_name").isin([n.lower() for n in wanted]))
        .distinct()
    )
    missing = names.join(present, F.lower("missing_name") == F.col("_name"), "left_anti")
    # At most one row per name of the parameter list.
    listed = F.array_join(F.array_sort(F.collect_set("missing_name")), ", ")
    return missing.agg(F.nullif(listed, F.lit("")).alias("missing_names"))
