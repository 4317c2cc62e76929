"""Rules that share a scan: repeats, keys, empty inputs and the shape of the plan."""

from __future__ import annotations

from collections import Counter

import pytest

from fleetwatch.operators import compliance as C
from fleetwatch.operators.rule_scan import Rule, judge, told
from fleetwatch.plans import reports

FILES = (
    "server_id string, database_name string, type_desc string, physical_name string, size_pages bigint, growth int, "
    "is_percent_growth boolean, data_space_id int"
)


def test_repeated_rows_give_repeated_findings(spark):
    rows = [("s1", "db", "ROWS", "D:/f", 9000, 128, False, 1)] * 2500 + [("s1", "db", "ROWS", "D:/g", 9000, 128, False, 1)]
    found = C.cmp_small_growth(spark.createDataFrame(rows, FILES)).groupBy("details").count().collect()
    assert {r.details: r["count"] for r in found} == {"D:/f has 0 GB": 2500, "D:/g has 0 GB": 1}


def test_groups_with_one_finding_give_it_once(spark):
    rows = [
        ("s1", "db", "ROWS", "C:/a", 1, growth, percent, space)
        for space, growth, percent in [(1, 1, False), (1, 2, False), (2, 5, False), (2, 5, True), (3, 7, False), (3, 7, False)]
    ] + [("s1", "even", "ROWS", None, 1, 1, None, 1), ("s1", "even", "ROWS", None, 1, None, False, 1)]
    found = judge([C.UNEVEN_GROWTH, C.FILES_ON_C], {"database_files": spark.createDataFrame(rows, FILES)}).collect()
    assert sorted((r.check_id, r.scope) for r in found) == [("76", "db"), ("79", "db")]


def test_nulls_empty_inputs_and_servers_without_rows(spark):
    schema = "server_id string, bad boolean, what string"
    rule = Rule("1", "r", "one", violates="bad", example="what", current="n", achieved="bad = 0",
                details=told("bad", "'x{k}'", "example"), every_server=True)
    servers = spark.createDataFrame([("s1",), ("s2",), ("s2",)], "server_id string")
    rows = spark.createDataFrame([("s1", None, "a"), ("s1", True, None), (None, True, "b")], schema)
    got = {r.server_id: (r.current_value, r.achieved, r.severity, r.details) for r in judge([rule], {"r": rows}, servers).collect()}
    assert got == {"s1": ("2", False, 1, "1x{k}N/A"), "s2": ("0", True, 0, "0x{k}N/A"), None: ("1", False, 1, "1x{k}b")}
    nothing = judge([rule], {"r": rows.limit(0)})
    assert nothing.count() == 0 and nothing.columns == list(C.findings(rows, "1", "x").columns)
    with pytest.raises(ValueError):
        judge([rule], {})


def test_one_scan_per_role_and_one_aggregation(spark, tmp_path):
    files = spark.createDataFrame([("s1", "db", "LOG", "C:/a", 1, 1, True, 1)], FILES)
    keys = spark.createDataFrame([("s1", "db", "symmetric", "k", "DES", 512)], "server_id string, database_name string, kind string, key_name string, algorithm string, key_length int")
    roles = {}
    for name, df in (("database_files", files), ("crypto_keys", keys)):
        df.write.parquet(str(tmp_path / name))
        roles[name] = spark.read.parquet(str(tmp_path / name))
    out = reports.compliance_findings(roles, "2024-01-31 00:00:00", [C.PresenceRule("9", "none", "database_files", "true", "'x'")])
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert Counter(word for word in plan.split() if word == "FileScan") == {"FileScan": 2}
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Aggregate [") == 2  # the groups, and findings given once
    assert Counter(r.check_id for r in out.collect()) == {"35": 1, "73": 1, "79": 1, "9": 1}


def _nodes(df, *words):
    """Plan nodes that begin with one of the words, from the result to the files."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    lines = [line.lstrip(" :+-*") for line in plan.splitlines()]
    return [line.split("(")[0].split(" ")[0] for line in lines if line.startswith(words)]


def test_records_are_hashed_not_sorted(spark, tmp_path):
    """Only what is left of the records, one row per group and example, meets an aggregation of texts."""
    rows = [("s1", f"db{i % 3}", "ROWS", f"C:/{i % 5}", 1, 1, i % 2 == 0, 1) for i in range(50)]
    spark.createDataFrame(rows, FILES).write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    rules = [*C.presence_rules([C.PresenceRule("9", "none on C", "database_files", "physical_name > 'C:/1'", "physical_name")])]
    rules += [C.UNEVEN_GROWTH, C.FILES_ON_C]
    out = judge(rules, {"database_files": files})
    assert _nodes(out, "HashAggregate", "SortAggregate", "ObjectHashAggregate")[-2:] == ["HashAggregate"] * 2
    assert "array_compact" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.check_id, r.scope, r.current_value, r.details) for r in out.collect() if r.check_id == "9")
    assert got == [("9", None, "30", "30 violating, first: C:/2")]
    assert sorted((r.check_id, r.scope) for r in out.collect() if r.check_id != "9") == [
        (c, f"db{i}") for c in ("76", "79") for i in range(3)
    ]


def test_once_with_an_example_or_for_each_row(spark):
    schema = "server_id string, part string, what string, at timestamp_ntz"
    rows = spark.createDataFrame([("s1", "a", "x", None), ("s1", "b", "x", None), ("s1", "c", "y", None), ("s1", "c", "w", None)], schema)
    shown = dict(violates="true", example="what", details="example", once=True)
    rules = [
        Rule("1", "r", "example", key={"part": "part"}, **shown),
        Rule("2", "r", "plain", key={"part": "part"}, having="n = 1", scope="'all'", current="n", achieved="n = 1", once=True),
        Rule("3", "r", "each", key={"part": "part"}, each=True, scope="{part}"),
    ]
    got = sorted((r.check_id, r.scope or "", r.current_value, r.achieved, r.severity, r.details) for r in judge(rules, {"r": rows}).collect())
    assert got == [
        ("1", "", None, False, 1, "w"), ("1", "", None, False, 1, "x"), ("2", "all", "1", True, 0, None),
        ("3", "a", None, False, 1, None), ("3", "b", None, False, 1, None), ("3", "c", None, False, 1, None),
        ("3", "c", None, False, 1, None),
    ]
