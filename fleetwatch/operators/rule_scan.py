"""Rules as data: all rules over one input share its scan, and all inputs share one aggregation.

A scan turns every row into one small record per rule that looks at it.  The records of all inputs are grouped by
(server, rule, key, example) with a partial aggregate before the shuffle; no text is aggregated there, so Spark hashes the
records and sorts none of them.  What is left, one row per group and example, is grouped once more: the smallest example
of a group, and findings that several groups give but once.  Servers of the inventory send a record without counts, so
rules that judge every server need no join.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.operators.findings import FINDING_COLUMNS, OK, WARN

FINE = "no problem found"
COPIES_PER_STEP = 1000


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def told(*parts: str) -> str:
    """SQL text of a message; expressions that are NULL print as 'N/A'."""
    return "concat(" + ", ".join(p if p.startswith("'") else f"coalesce(cast({p} as string), 'N/A')" for p in parts) + ")"


VIOLATING = f"CASE WHEN bad = 0 THEN '{FINE}' ELSE {told('bad', quoted(' violating, first: '), 'example')} END"


@dataclass(frozen=True)
class Rule:
    """One rule; all expressions are Spark SQL.

    Over rows of ``role``: ``where`` selects the rows, ``key`` (name to expression) parts the rows of a server into
    groups, ``violates`` marks the rows counted in ``bad``, and ``example``, ``value``, ``bits`` and ``at`` are what
    the group aggregates.

    Over groups, with the columns ``n`` (rows), ``bad``, ``example`` (smallest of the bad rows), ``low`` and ``high``
    (of ``value``), ``bits`` (all of them or-ed), ``latest`` (of ``at``) and ``{name}`` for a part of the key:
    ``having`` selects the groups that give a finding, the other expressions make its columns.  A finding that is not
    achieved has severity ``level``, else 0.

    ``each``: one finding per row; the key must hold all that the finding shows.  ``once``: groups that give the same
    finding give it once.  ``every_server``: servers of the inventory without a row are judged too, with ``n`` = 0.
    """

    check_id: str
    role: str
    name: str
    where: str = "true"
    key: Mapping[str, str] = field(default_factory=dict)
    violates: str = "false"
    example: str = "NULL"
    value: str = "NULL"
    bits: str = "NULL"
    at: str = "NULL"
    having: str = "true"
    named: str | None = None
    level: int = WARN
    scope: str = "NULL"
    current: str = "NULL"
    target: str = "NULL"
    achieved: str = "false"
    details: str = "NULL"
    observed_at: str = "NULL"
    each: bool = False
    once: bool = False
    every_server: bool = False

    def over_group(self, expression: str) -> str:
        for i, name in enumerate(self.key):
            expression = expression.replace("{" + name + "}", f"k[{i}]")
        return expression


def _record(number: int, rule: Rule) -> tuple[str, dict[str, str]]:
    """The condition of a rule's record and its columns."""
    keys = ", ".join(f"cast({e} as string)" for e in rule.key.values())
    return rule.where, {
        "rule": str(number),
        "k": f"cast(array({keys}) as array<string>)",
        "rows": "1L",
        "bad": f"coalesce({rule.violates}, false)",
        "example": f"cast(({rule.example}) as string)",
        "value": f"cast(({rule.value}) as double)",
        "bits": f"cast(({rule.bits}) as bigint)",
        "at": f"cast(({rule.at}) as timestamp_ntz)",
    }


def _absent(number: int) -> tuple[str, dict[str, str]]:
    """The record of an inventory server, which adds no row to its group."""
    return "true", {
        "rule": str(number), "k": "cast(array() as array<string>)", "rows": "0L", "bad": "false",
        "example": "cast(NULL as string)", "value": "cast(NULL as double)", "bits": "cast(NULL as bigint)",
        "at": "cast(NULL as timestamp_ntz)",
    }


def _records(df: DataFrame, records: Sequence[tuple[str, dict[str, str]]]) -> DataFrame:
    """One row per row and record; a single record is a filter, which may reach the files."""
    server = F.col("server_id").cast("string").alias("server_id")
    structs = [F.struct(*[F.expr(e).alias(c) for c, e in columns.items()]) for _, columns in records]
    if len(records) == 1:
        found = df.filter(F.expr(records[0][0])).select(server, structs[0].alias("r"))
    else:
        # Explode first and filter then: array_compact would take every expression out of code generation.
        each = F.array(*[F.when(F.expr(where), r) for (where, _), r in zip(records, structs, strict=True)])
        found = df.select(server, F.explode(each).alias("r")).filter(F.col("r").isNotNull())
    return found.select("server_id", "r.*")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _union(parts[:half]).union(_union(parts[half:]))


def _by_rule(rules: Sequence[Rule], expressions: Sequence[str], kind: str) -> Column:
    """The expression of the row's own rule; rules that share one share a branch."""
    same: dict[str, list[int]] = defaultdict(list)
    for i, (rule, expression) in enumerate(zip(rules, expressions, strict=True)):
        same[rule.over_group(expression)].append(i)
    if len(same) == 1:
        return F.expr(f"cast(({next(iter(same))}) as {kind})")
    branches = " ".join(
        f"WHEN rule IN ({', '.join(map(str, numbers))}) THEN cast(({e}) as {kind})" for e, numbers in same.items()
    )
    return F.expr(f"CASE {branches} END")


def _repeat(judged: DataFrame) -> DataFrame:
    """``copies`` rows for each row, in two steps so that no array grows with a hot row's count."""
    step = f"explode(transform(sequence(0L, (copies - 1) div {COPIES_PER_STEP}), i -> least({COPIES_PER_STEP}L, copies - i * {COPIES_PER_STEP})))"
    columns = [c for c in judged.columns if c != "copies"]
    some = judged.select(*columns, F.expr(step).alias("_some"))
    return some.select(*columns, F.expr("explode(array_repeat(0, cast(_some as int)))").alias("_one")).select(*columns)


def _finding(rule: Rule) -> dict[str, str]:
    """What a rule's finding shows, by name of the field."""
    return {
        "named": rule.named or quoted(rule.name), "scope": rule.scope, "current": rule.current, "target": rule.target,
        "achieved": rule.achieved, "details": rule.details, "observed_at": rule.observed_at,
    }


def _shown(rule: Rule) -> Rule:
    """The rule over groups whose key is the text of their finding."""
    fields = _finding(rule)
    return replace(rule, key=fields, having="true", once=False, **{name: "{" + name + "}" for name in fields})


def _smallest_examples(records: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Rule]]:
    """Groups by (server, rule, key) with their smallest example, and the rules as they read these groups.

    Texts are part of the first key instead of being aggregated. The groups of a rule without example are whole then, so
    one that gives equal findings once is judged there, and the second grouping is by its finding.
    """
    groups = records.groupBy("server_id", "rule", "k", F.when(F.col("bad"), F.col("example")).alias("example")).agg(
        F.sum("rows").alias("n"),
        F.count_if("bad").alias("bad"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.coalesce(F.bit_or("bits"), F.lit(0)).alias("bits"),
        F.max("at").alias("latest"),
    )
    early = [r.once and not r.each and r.example == "NULL" for r in rules]
    if not any(early) and all(r.example == "NULL" for r in rules):
        return groups, rules
    if any(early):
        having = [r.having if now else "true" for r, now in zip(rules, early, strict=True)]
        if any(h != "true" for h in having):
            groups = groups.filter(_by_rule(rules, having, "boolean"))
        keys = [
            "array(" + ", ".join(f"cast({e} as string)" for e in _finding(r).values()) + ")" if now else "k"
            for r, now in zip(rules, early, strict=True)
        ]
        groups = groups.withColumn("k", _by_rule(rules, keys, "array<string>"))
    merged = groups.groupBy("server_id", "rule", "k").agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.min("example").alias("example"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.bit_or("bits").alias("bits"),
        F.max("latest").alias("latest"),
    )
    return merged, [_shown(r) if now else r for r, now in zip(rules, early, strict=True)]


def judge(rules: Sequence[Rule], roles: Mapping[str, DataFrame], servers: DataFrame | None = None) -> DataFrame:
    """Findings of ``rules`` whose roles are given, with one scan per role and one aggregation over all of them.

    ``servers`` is the inventory for rules that judge every server; given also as the role ``servers``, it is read once.
    NULL conditions count as false, and rows without a server form a server of their own.  Returns the findings schema;
    without any rule to run, it raises ValueError.
    """
    rules = [r for r in rules if r.role in roles]
    if not rules:
        raise ValueError("no rule has its role")
    by_role: dict[str, list[tuple[str, dict[str, str]]]] = defaultdict(list)
    for i, rule in enumerate(rules):
        by_role[rule.role].append(_record(i, rule))
    parts = dict(roles)
    if servers is not None:
        inventory = [_absent(i) for i, rule in enumerate(rules) if rule.every_server]
        if inventory:
            name = "servers" if roles.get("servers") is servers else "_inventory"
            parts[name] = servers
            by_role[name] += inventory
    groups, rules = _smallest_examples(_union([_records(parts[r], found) for r, found in by_role.items()]), rules)
    if any(r.having != "true" for r in rules):
        groups = groups.filter(_by_rule(rules, [r.having for r in rules], "boolean"))
    achieved = _by_rule(rules, [r.achieved for r in rules], "boolean")
    level = _by_rule(rules, [str(r.level) for r in rules], "int")
    judged = groups.select(
        "server_id",
        _by_rule(rules, [quoted(r.check_id) for r in rules], "string").alias("check_id"),
        _by_rule(rules, [r.scope for r in rules], "string").alias("scope"),
        F.when(achieved, OK).otherwise(level).cast("int").alias("severity"),
        _by_rule(rules, [r.named or quoted(r.name) for r in rules], "string").alias("name"),
        _by_rule(rules, [r.current for r in rules], "string").alias("current_value"),
        _by_rule(rules, [r.target for r in rules], "string").alias("target_value"),
        achieved.alias("achieved"),
        _by_rule(rules, [r.details for r in rules], "string").alias("details"),
        _by_rule(rules, [r.observed_at for r in rules], "timestamp_ntz").alias("observed_at"),
        F.when(~_by_rule(rules, [str(r.once).lower() for r in rules], "boolean"), F.col("k")).alias("_k"),
        F.when(_by_rule(rules, [str(r.each).lower() for r in rules], "boolean"), F.col("n")).otherwise(1).alias("copies"),
    )
    if any(r.once for r in rules):
        judged = judged.distinct()
    if any(r.each for r in rules):
        judged = _repeat(judged)
    return judged.select(*FINDING_COLUMNS)
