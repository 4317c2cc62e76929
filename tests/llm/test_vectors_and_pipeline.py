"""Nearest vectors against brute force, oracles of the SQL queries, and the pipeline's stages."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetwatch.llm import ann, langid, lines, simhash
from fleetwatch.llm.common import where_computed
from fleetwatch.llm.queries import ORACLES, QUERIES, language_model
from tests.llm.conftest import TYPES, prose

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def clustered(n, d=16):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(12, size=n)] + 0.2 * rng.normal(size=(n, d))
    return [(i, (x[i] * rng.uniform(0.5, 2)).tolist(), 0) for i in range(n)]


def test_recall_on_a_tree(spark):
    rows = clustered(3000)
    df = spark.createDataFrame(rows, SCHEMA)
    got = answers(ann.nearest(df, "vec_id % 20 = 0", rows_per_leaf=50, calibration=40))
    want = brute(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(exact.get((q, i), s) == pytest.approx(s, abs=1e-12) for q in got for i, s in got[q])


def test_recall_with_production_parameters(spark):
    """24,000 vectors of 64 numbers, many leaves."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 64))
    x = centres[rng.integers(60, size=24_000)] + 0.8 * rng.normal(size=(24_000, 64))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(24_000), "embedding": x.tolist()}), "vec_id long, embedding array<float>")
    table = df.toPandas()
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    got = ann.nearest(df, "vec_id % 20 = 0").select("query_id", "vec_id").toPandas().groupby("query_id")["vec_id"].agg(set)
    asked = np.random.default_rng(0).choice(np.flatnonzero(ids % 20 == 0), 500, replace=False)
    found = []
    for i in asked:
        scores = x @ x[i]
        scores[i] = -np.inf
        found.append(len(set(ids[np.argpartition(-scores, 20)[:20]].tolist()) & got[ids[i]]) / 20)
    assert np.mean(found) >= 0.96


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.1, 3.3], 0) for i in range(100)] + [(200 + i, [float(i), 1.0, 0.0], 0) for i in range(50)]
    got = answers(ann.nearest(spark.createDataFrame(rows, SCHEMA), "vec_id % 20 = 0"))
    assert [i for i, _ in got[40][:20]] == [i for i, _ in brute(rows, 20)[40]]
    assert got == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in brute(rows, 20).items()}


def test_odd_vectors(spark):
    good = [(i, [float(i % 7 + 1), float(i % 5)], i) for i in range(50)]
    odd = [
        (60, None, 1), (80, [], 1), (100, [0.0, 0.0], 1), (120, [1.0, None], 1), (140, [float("nan"), 1.0], 1), (160, [float("inf"), 1.0], 1),
        (None, [1.0, 2.0], 1), (180, [1.0], None), (20, [9.0, 9.0], 1), (0, [1.0, 0.0], 0),
    ]
    df = spark.createDataFrame(good + odd, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "v", "leaf", "score", "rank")})
    got = answers(ann.nearest(df, "vec_id % 20 = 0"))
    assert got == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in brute(good, 20).items()}
    for few in ([], odd[:6], good[:1]):
        assert ann.nearest(spark.createDataFrame(few, SCHEMA), "vec_id % 20 = 0").count() == 0
    two = ann.nearest(spark.createDataFrame(good[:2], SCHEMA), "vec_id % 20 = 0").collect()
    assert [(r.query_id, r.vec_id) for r in two] == [(0, 1)]


def test_small_blocks_find_the_same(spark, monkeypatch):
    rows = clustered(800)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = answers(ann.nearest(df, "vec_id % 20 = 0", rows_per_leaf=10_000))
    monkeypatch.setattr(ann, "ROWS_BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES_BLOCK", 7)
    assert answers(ann.nearest(df, "vec_id % 20 = 0", rows_per_leaf=10_000)) == whole
    assert {q: [i for i, _ in v] for q, v in whole.items()} == {q: [i for i, _ in v] for q, v in brute(rows, 20).items()}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[key](spark, SF)
    want = con.sql(ORACLES[key])
    assert got.columns == want.columns
    assert Counter(tuple(r) for r in got.collect()) == Counter(want.fetchall())


# Pipeline


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_pipeline_runs(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_dedup", "source_mix", "sentencepiece"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert out.count() > 0
    assert out.select("doc_id").distinct().join(docs, "doc_id", "left_anti").count() == 0


def test_stages_act_on_their_decisions(spark, docs):
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    model = language_model(docs)
    bad = ids(docs.withColumn("p", langid.predict(F.col("text"), model)).where("p.lang_pred = 'und' or p.score < 0.5"))
    assert ids(corpus_pipeline.language_stage(spark, docs, SF)) == ids(docs) - bad
    assert ids(corpus_pipeline.quality_stage(spark, docs, SF)) == ids(where_computed(lines.judge_lines(docs), F.col("kept")))
    firsts = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert ids(corpus_pipeline.dedup_stage(spark, docs, SF)) == firsts


def test_dedup_keeps_one_row_of_each_text(spark):
    ids = [None] * 20 + [7] * 10 + list(range(100, 110))
    texts = [prose(i, ("en", "fr", "de")[i % 3], 80) for i in range(len(ids))]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts, strict=True)]
    copies = [(None, texts[3], "de", "s", 1), (500, texts[4], "en", "s", 1), (100, texts[35], "en", "s", 1), (7, texts[22], "en", "s", 1)]
    table = spark.createDataFrame(rows + copies, TYPES)
    assert simhash.near_duplicates(table).select("fingerprint").distinct().count() == len(texts)
    out = corpus_pipeline.dedup_stage(spark, table, SF)
    assert out.columns == table.columns
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    want = dict(zip(texts, ids, strict=True)) | {texts[4]: 500, texts[35]: 100}
    assert kept == Counter((i, t) for t, i in want.items())


def test_stages_keep_columns_of_any_name_and_type(spark, odd):
    names = ["no_doc_id", "#no_text", "#kept", "file", "row", "copies", "a`b", "_metadata", "_key"]
    table = odd.withColumns({c: F.lit("x") for c in names}).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF)
        assert out.columns == table.columns and out.count() > 0
        assert {r.no_doc_id for r in out.collect()} == {"x"}


def test_dedup_and_mix_shuffle_no_text(spark, docs):
    """The scan of the documents goes through to the result; what is shuffled are slim rows."""
    for _, stage in corpus_pipeline.STAGES[2:4]:
        plan = stage(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_stages_on_odd_rows(spark, odd, clashing, empty):
    for table in (odd, clashing, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            rows = out.collect()
            if name != "sentencepiece":
                assert out.columns == table.columns
            if table is empty:
                assert rows == []
            if name == "simhash_dedup" and rows:
                assert max(Counter(r.doc_id for r in rows).values()) == 1
