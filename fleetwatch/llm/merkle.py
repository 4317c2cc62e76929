"""Merkle manifest of a table: one digest for all rows, one for every group, and a proof for every row.

The rows of a group are leaves in the order of their key. While a group has several nodes, every ``ARITY`` consecutive ones
become the digest of their digests; what remains is the group's subroot, and the subroots, in the order of the groups,
become the root in the same way. Each level is one window over blocks of whole runs: lag and lead columns of fixed offsets
give a node's siblings, masked by its slot in the run and by the run's length, and the row of a run's first child hashes
the parent. The way down takes the same windows: a parent's path is a row in front of its children, so no join is made
and a group of any size is cut into many blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fleetwatch.llm.common import ascii_lower, id_remainder
from fleetwatch.plans.ordering import rank_in_group
from fleetwatch.session import settled

ARITY = 16
BLOCK = ARITY * ARITY
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one behind the other, in lower-case hexadecimal digits."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: each field is ``-`` if null, else its number of UTF-8 bytes, a colon and the value's text."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return digest(*parts)


def _window() -> WindowSpec:
    """The windows of a level: by blocks of whole runs, a parent's path (no digest) in front of its children."""
    return Window.partitionBy("grp", F.floor(F.col("pos") / BLOCK)).orderBy("pos", F.col("h").isNotNull())


def _marked(nodes: DataFrame) -> DataFrame:
    """Adds slot, the siblings before and after in the run, and whether the node is its group's only one."""
    w, slot = _window(), (F.col("pos") % ARITY).cast("int")
    before = [F.when(slot >= o, F.lag("h", o).over(w)) for o in range(ARITY - 1, 0, -1)]
    after = [F.when(slot + o < ARITY, F.lead("h", o).over(w)) for o in range(1, ARITY)]
    # A run that is not full ends with its group, so no row follows: the missing leads are null.
    join = lambda parts: F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
    only = (F.col("pos") == 0) & F.lead("h", 1).over(w).isNull()
    return nodes.withColumns({"slot": slot, "before": join(before), "after": join(after), "only": only})


def _grow(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tables (grp, pos, h, done) of the levels above the leaves; ``done`` rows are what remains of their group."""
    levels = []
    while True:
        first = _marked(nodes.select("grp", "pos", "h")).where("slot = 0")
        parent = F.when(F.col("only"), F.col("h")).otherwise(digest(F.col("h"), F.col("after")))
        up = first.select("grp", F.floor(F.col("pos") / ARITY).alias("pos"), parent.alias("h"), F.col("only").alias("done"))
        levels.append(settled(up, f"merkle-{name}{len(levels)}"))
        nodes = levels[-1].where("NOT done")
        if nodes.isEmpty():
            return levels


def _descend(nodes: DataFrame, parents: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Adds to the nodes (grp, pos, h) the path and the columns ``carried`` of their parents (grp, pos, path, ...).

    The path of a group's only node is that of the row at place 0, without a level of its own.
    """
    empty = [F.lit(None).cast(parents.schema[c].dataType).alias(c) for c in ("path", *carried)]
    above = parents.select("grp", (F.col("pos") * ARITY).alias("pos"), "path", *carried)
    rows = nodes.select("*", *empty).unionByName(above, allowMissingColumns=True)
    marked = _marked(rows)
    so_far = _window().rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(F.col("h").isNull(), F.struct("path", *carried)), ignorenulls=True).over(so_far)
    step = F.array(F.struct("before", "after"))
    path = F.when(F.col("only"), F.col("_up.path")).otherwise(F.concat(step, F.col("_up.path")))
    found = marked.withColumn("_up", held).where("h IS NOT NULL")
    return found.select(*nodes.columns, path.alias("path"), *[F.col(f"_up.{c}").alias(c) for c in carried])


def prove(leaves: DataFrame) -> DataFrame:
    """Adds subroot, root and path to leaves (grp string, key, h, ...); names that begin with ``_`` are taken.

    ``path`` lists, level by level from the leaf to the root, the digests of the siblings before and after the node, one
    behind the other. Leaves of a group ascend by key (null first), equal keys by digest; rows that repeat are leaves of
    their own. The null group comes first, the others bytewise. Without leaves there is no row and no root.
    """
    ranked = rank_in_group(leaves, ["grp"], ["key", "h"], "_rank")
    ranked = ranked.withColumn("pos", F.col("_rank") - 1).drop("_rank")
    if ranked.isEmpty():
        return leaves.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("subroot", "string"), ("root", "string"), ("path", PATH))])
    levels = _grow(ranked, "leaf")
    tops = None
    for k, level in enumerate(levels):
        part = level.where("done").select(F.col("grp").alias("name"), "h", F.lit(k).alias("level"))
        tops = part if tops is None else tops.unionByName(part)
    order = rank_in_group(tops, [], [F.col("name").asc_nulls_first()], "_rank")
    tops = settled(order.select(F.lit(0).alias("grp"), (F.col("_rank") - 1).alias("pos"), "h", "name", "level"), "merkle-tops")
    above = _grow(tops, "top")
    root = above[-1].where("done").first()["h"]
    at_root = above[-1].where("done").select("grp", "pos", F.array().cast(PATH).alias("path"))
    for level in reversed([tops, *[up.where("NOT done") for up in above]][: len(above)]):
        at_root = _descend(level, at_root)
    # Subroots that were done at level k stand for the parents of that level's only nodes.
    ends = settled(
        at_root.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("h").alias("subroot"), "level"),
        "merkle-ends",
    )
    below = [ranked, *[up.where("NOT done").drop("done") for up in levels]]
    paths = None
    for k in range(len(levels) - 1, -1, -1):
        parents = ends.where(F.col("level") == k).drop("level")
        parents = parents if paths is None else parents.unionByName(paths.select(*parents.columns))
        paths = _descend(below[k], parents, ["subroot"])
        if k:
            paths = settled(paths, f"merkle-paths{k}")
    return paths.select(*leaves.columns, "subroot", F.lit(root).alias("root"), "path")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings' digests, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, p: digest(p["before"], acc, p["after"]))


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "source",
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text", tampered: Column | None = None,
) -> DataFrame:
    """(key, group, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    ``tampered`` marks rows whose leaf is made anew from the text with A-Z in lower case before it is folded with the
    original siblings; without it all rows are folded as they are. Null values in any field count as such, a null key
    stands first and is never tampered with unless ``tampered`` says so; very long texts are hashed whole, empty tables
    give empty results. Columns that are not among ``fields`` are not read.
    """
    value = {f: F.col(f"`{f.replace('`', '``')}`") for f in fields}
    plain = leaf_digest(*value.values())
    changed = leaf_digest(*[ascii_lower(c.cast("string")) if f == text else c for f, c in value.items()])
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    column = lambda c: F.col(f"`{c.replace('`', '``')}`")
    leaves = settled(
        docs.select(
            column(group).cast("string").alias("grp"), column(key).alias("key"), plain.alias("h"), F.when(hit, changed).alias("claimed")
        ),
        "merkle-leaves",
    )
    found = prove(leaves)
    fold = folded(F.coalesce("claimed", "h"), F.col("path"))
    out = found.select(
        F.col("key").alias(key), F.col("grp").alias(group), F.col("h").alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), fold.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(key: str) -> Column:
    """Rows whose crc32 of the decimal key is a multiple of 5; not those without a key."""
    return F.col(key).isNotNull() & (id_remainder(F.col(key), 5) == 0)


def oracle_sql(levels: int = 7) -> str:
    """DuckDB SQL for the manifest of documents; ``levels`` bounds the levels of either tree (16 to that power nodes)."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({0} AS VARCHAR))), ':', {0}) END"
    fields = [field.format(f) for f in ("doc_id", "source", "lang", "n_chars")]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = "sha256(concat(" + ", ".join(fields) + ", {t}))"

    def tree(name: str, nodes: str, grp: str) -> list[str]:
        """Levels name_0, name_1, ... with a row (grp, pos, h, run, n) for every node, done groups left out."""
        out = [f"{name}_0 AS (SELECT *, count(*) OVER (PARTITION BY {grp}) AS n FROM {nodes})"]
        for k in range(levels):
            out.append(
                f"{name}_r{k} AS (SELECT {grp}, pos // 16 AS pos, string_agg(h, '' ORDER BY pos) AS run, sha256(string_agg(h, '' ORDER BY pos)) AS h "
                f"FROM {name}_{k} WHERE n > 1 GROUP BY {grp}, pos // 16)"
            )
            out.append(f"{name}_{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY {grp}) AS n FROM {name}_r{k})")
        return out

    same = "{a}.g IS NOT DISTINCT FROM l.g AND {a}.pos = l.pos // {d}"
    tops = " UNION ALL ".join(f"SELECT g, h FROM leaf_{k} WHERE n = 1" for k in range(levels + 1))
    ctes = [
        "tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k: "
        "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(i)))",
        "d AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: "
        "CAST(ascii(c) AS BIGINT))), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 5 = 0 AS hit FROM documents CROSS JOIN tab)",
        "d2 AS (SELECT doc_id, source AS g, " + leaf.format(t=field.format("text")) + " AS h, CASE WHEN hit THEN "
        + leaf.format(t=field.format(lower)) + " END AS claimed FROM d)",
        "leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d2)",
        *tree("leaf", "leaves", "g"),
        f"tops AS (SELECT g AS src, h, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM ({tops}))",
        *tree("top", "tops", "g"),
        "root AS (" + " UNION ALL ".join(f"SELECT h FROM top_{k} WHERE n = 1" for k in range(levels + 1)) + ")",
    ]

    def climb(name: str, start: str, keep: str) -> None:
        """Proof and fold, one level a step; a missing run means that the group is done."""
        last = start
        for k in range(levels):
            run, slot = f"{name}_r{k}", f"((l.pos // {16**k}) % 16)"
            b, a = f"substr(r.run, 1, 64 * {slot})", f"substr(r.run, 64 * {slot} + 65)"
            ctes.append(
                f"{name}_c{k} AS (SELECT {keep}, l.g, l.pos, CASE WHEN r.run IS NULL THEN l.proof ELSE concat(l.proof, {b}, {a}) END AS proof, "
                f"CASE WHEN r.run IS NULL THEN l.fold ELSE sha256(concat({b}, l.fold, {a})) END AS fold FROM {last} l "
                f"LEFT JOIN {run} r ON {same.format(a='r', d=16 ** (k + 1))})"
            )
            last = f"{name}_c{k}"

    ctes.append("start AS (SELECT doc_id, h AS leaf, g, pos, '' AS proof, coalesce(claimed, h) AS fold FROM leaves)")
    climb("leaf", "start", "l.doc_id, l.leaf")
    ctes.append(
        f"mid AS (SELECT l.doc_id, l.leaf, t.h AS subroot, t.g, t.pos, l.proof, l.fold FROM leaf_c{levels - 1} l "
        "JOIN tops t ON t.src IS NOT DISTINCT FROM l.g)"
    )
    climb("top", "mid", "l.doc_id, l.leaf, l.subroot")
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, "
        f"fold = root.h AS verified FROM top_c{levels - 1} CROSS JOIN root"
    )
