"""Importance resampling, the Merkle manifest and files of ids against plain Python, odd rows included."""

from __future__ import annotations

import hashlib
import io
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetwatch.llm import idfiles, merkle, resample
from fleetwatch.llm.queries import ORACLES, byte_file
from fleetwatch.llm.wordtable import WordTable
from tests.llm.conftest import TYPES, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BUCKETS = 10_000


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def features(text):
    words = WORDS.findall(lower(text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % BUCKETS for r in runs]


def drawn_by_hand(docs, target, percent=5):
    found = [(r.doc_id, *features(r.text)) for r in docs]
    s, t = Counter(), Counter()
    for _, _, buckets in found:
        s.update(buckets)
    for r in target:
        t.update(features(r.text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + BUCKETS) / ((s[b] + 1) * (all_t + BUCKETS)))) for b in range(BUCKETS)]
    rows = []
    for key, n, buckets in found:
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, n >= 20, len(buckets), weight, weight + noise, None])
    first = sorted((r for r in rows if r[1]), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for i, r in enumerate(first[: percent * len(first) // 100]):
        r[5] = i + 1
    return sorted((tuple(r[:1] + r[2:]) for r in rows), key=str)


def result(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


DRAW = ("doc_id", "n_features", "weight", "score", "rank")


@pytest.fixture(scope="module")
def benchmark_rows(spark):
    return spark.createDataFrame([(1, prose(1, "en", 50)), (2, None), (3, "")], "item_id long, text string")


def test_draw_equals_brute_force(spark, odd, clashing, benchmark_rows):
    for docs, percent in ((odd, 5), (odd, 40), (odd, 100), (clashing, 40)):
        got = resample.importance_resample(docs, benchmark_rows, percent=percent)
        assert result(got, *DRAW) == drawn_by_hand(docs.collect(), benchmark_rows.collect(), percent)


def test_draw_among_tied_rows(spark, benchmark_rows):
    """A third of the rows under one id, all alike: exactly as many are drawn as the size asks for."""
    rows = [(i, prose(i, "en", 30), "en", "s", 1) for i in range(200)] + [(7, prose(7, "en", 30), "en", "s", 1)] * 100
    docs = spark.createDataFrame(rows, TYPES)
    for percent in (5, 33, 50):
        got = resample.importance_resample(docs, benchmark_rows, percent=percent)
        assert result(got, *DRAW) == drawn_by_hand(docs.collect(), benchmark_rows.collect(), percent)
        ranks = sorted(r["rank"] for r in got.where("rank IS NOT NULL").collect())
        assert ranks == list(range(1, percent * 300 // 100 + 1))


def test_draw_from_nothing(spark, empty, odd, benchmark_rows):
    assert resample.importance_resample(empty, benchmark_rows).count() == 0
    got = resample.importance_resample(odd, benchmark_rows.where("false"), percent=20)
    assert result(got, *DRAW) == drawn_by_hand(odd.collect(), [], 20)


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = prose(3, "fr", 500).encode()
    whole = [(n, sorted(f.tolist())) for n, f in resample.features_of(text, BUCKETS)]
    monkeypatch.setattr(resample, "BLOCK", 40)
    parts = list(resample.features_of(text, BUCKETS))
    assert len(parts) > 10 and len(whole) == 1
    assert sum(n for n, _ in parts) == whole[0][0] and sorted(np.concatenate([f for _, f in parts]).tolist()) == whole[0][1]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_by_hand(rows, hit):
    def leaf(r, change=False):
        out = ""
        for name in ("doc_id", "source", "lang", "n_chars", "text"):
            v = r[name]
            if v is not None:
                v = lower(v) if change and name == "text" else str(v)
            out += "-" if v is None else f"{len(v.encode())}:{v}"
        return h(out)

    def tree(level):
        """Root, and for each leaf a list of (before, after)."""
        paths, where = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            runs = [level[i : i + 16] for i in range(0, len(level), 16)]
            for k, place in enumerate(where):
                run, slot = runs[place // 16], place % 16
                paths[k].append((run[:slot], run[slot + 1 :]))
                where[k] = place // 16
            level = [h("".join(run)) for run in runs]
        return level[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        built[name] = tree([x[1] for x in groups[name]])
    root, tops = tree([built[n][0] for n in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        for (r, digest), path in zip(groups[name], built[name][1], strict=True):
            steps = path + top
            fold = leaf(r, True) if hit(r["doc_id"]) else digest
            for before, after in steps:
                fold = h("".join([*before, fold, *after]))
            proof = h("".join("".join(b + a) for b, a in steps))
            out.append((r["doc_id"], name, digest, built[name][0], root, proof, fold, fold == root))
    return sorted(out, key=str)


MANIFEST = ("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def fifth(key):
    return key is not None and crc32(str(key).encode()) % 5 == 0


def test_manifest_equals_brute_force(spark, odd, clashing, empty):
    for docs in (odd, clashing):
        got = merkle.manifest(docs, tampered=merkle.every_fifth("doc_id"))
        want = manifest_by_hand(docs.collect(), fifth)
        assert result(got, *MANIFEST) == want and {r[-1] for r in want} == {True, False}
    assert merkle.manifest(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4097])
def test_manifest_of_runs_that_end_early(spark, n):
    rows = [(i, f"Text {i}", "en", "hot", i) for i in range(n)] + [(i, "x", None, f"s{i}", 1) for i in range(18)]
    docs = spark.createDataFrame(rows, TYPES)
    got = merkle.manifest(docs, tampered=merkle.every_fifth("doc_id"))
    assert result(got, *MANIFEST) == manifest_by_hand(docs.collect(), fifth)


def test_manifest_of_one_row_and_of_repeated_rows(spark):
    one = spark.createDataFrame([(5, "a", None, None, None)], TYPES)
    (r,) = merkle.manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == h("1:5---1:a") and r.verified and r.proof_sha256 == h("")
    same = spark.createDataFrame([(1, "a", "en", "s", 1)] * 40 + [(None, "b", "en", "s", 1)] * 3, TYPES)
    assert result(merkle.manifest(same), *MANIFEST) == manifest_by_hand(same.collect(), lambda key: False)


def test_manifest_windows_are_blocks(spark, odd):
    nodes = odd.select(F.col("source").alias("grp"), F.col("doc_id").alias("pos"), F.col("text").alias("h"))
    plan = merkle._marked(nodes)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*\], \[grp#\d+, (_w\d+)#\d+L?\]", plan)
    assert windows and f"AS {windows[0]}" in plan and "256.0" in plan


def test_manifest_oracle(spark, odd):
    import duckdb

    con = duckdb.connect()
    con.register("documents", odd.toArrow())
    columns = [c for c in MANIFEST if c != "source"]
    want = sorted(map(tuple, con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op12_merkle_manifest']})").fetchall()), key=str)
    assert result(merkle.manifest(odd, tampered=merkle.every_fifth("doc_id")), *columns) == want


@pytest.mark.parametrize("bits", [1, 7, 8, 15, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 10_001).astype("<u4")
    data = idfiles.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8) and np.array_equal(idfiles.unpack(data, len(ids), bits), ids)


@pytest.mark.parametrize("bits, block", [(16, 8), (17, 5), (11, 64), (3, 1)])
def test_random_access(bits, block):
    ids = np.random.default_rng(1).integers(0, 2**bits, 333).astype("<u4")
    stream = io.BytesIO()
    out = idfiles.IdWriter(stream, bits, block)
    for a, b in ((0, 100), (100, 100), (100, 333)):
        out.ids(ids[a:b])
        out.end(None if a == b else a)
    told = out.close()
    assert told["ids"] == 333 and told["sha256"] == hashlib.sha256(stream.getvalue()).hexdigest()
    back = idfiles.IdFile(stream)
    assert back.starts.tolist() == [0, 100, 100, 333] and back.null.tolist() == [False, True, False]
    for a, b in ((0, 333), (0, 1), (7, 9), (99, 101), (332, 333), (50, 50), (3, 300)):
        assert np.array_equal(back.ids(a, b), ids[a:b])


def test_an_id_that_is_too_large():
    with pytest.raises(ValueError):
        idfiles.IdWriter(io.BytesIO(), 4).ids(np.array([16], "<u4"))


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_by_hand(rows):
    lib, at, out = library(), 0, []
    for key, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, at, len(ids), crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_id_files_equal_the_library(spark, odd, clashing, empty, tmp_path):
    unique = odd.where("doc_id IS NULL OR doc_id NOT IN (0, 101, 107, 108)")
    for n, docs in enumerate((unique, clashing.where("doc_id IS NULL OR doc_id NOT IN (0, 101, 107, 108)"))):
        folder = f"{tmp_path}/ids{n}"
        manifest = idfiles.write_ids(docs, folder, byte_file(), roll_ids=5000)
        rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        want = ids_by_hand(rows)
        sums = sorted(idfiles.read_checksums(spark, folder).collect(), key=lambda r: r.start)
        assert [tuple(r) for r in sums] == [w[:4] for w in want]
        whole = sorted(idfiles.read_ids(spark, folder).collect(), key=lambda r: r.start)
        assert [(r.key, r.start, list(r.ids)) for r in whole] == [(w[0], w[1], w[4]) for w in want]
        assert manifest.count() > 1 and manifest.agg(F.sum("docs")).first()[0] == len(rows)
    none = idfiles.write_ids(empty, f"{tmp_path}/none", byte_file())
    assert none.count() == 0 and idfiles.read_checksums(spark, f"{tmp_path}/none").count() == 0


def test_id_files_of_repeated_keys(spark, odd, tmp_path):
    """Rows that share a key stand in some order; the starts leave no gap and every document is there."""
    idfiles.write_ids(odd, f"{tmp_path}/ids", byte_file())
    got = sorted(idfiles.read_checksums(spark, f"{tmp_path}/ids").collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [(r.key is not None, r.key or 0) for r in got] == sorted((r.key is not None, r.key or 0) for r in got)
    want = Counter((k, n, c) for k, _, n, c, _ in ids_by_hand([(r.doc_id, r.text) for r in odd.collect()]))
    assert Counter((r.key, r.n_tokens, r.ids_crc32) for r in got) == want


def test_a_frequent_key_is_cut(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i if i % 3 else None, f"text {i}", "en", "s", 1) for i in range(3000)]
    manifest = idfiles.write_ids(spark.createDataFrame(rows, TYPES).repartition(4), f"{tmp_path}/ids", byte_file()).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(manifest) == 8 and max(r.docs for r in manifest) < 2 * 3000 / 8


TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "a   b \n c\n\n d", "\n \n", "it's  it 's", "x  y 　z", "a \x1cb \x85c", "\t a\t b", "😀 😀  é", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|>  c", "    x", "12 34 5  6", "...  ,, ;", "a" * 300 + " " + "b " * 50, "\x00 \x00", " ​ x", "᠎ ᠎ a",
]


@pytest.mark.parametrize("chars", [1, 1 << 20])
def test_codec_on_white_space(monkeypatch, chars):
    monkeypatch.setattr(idfiles, "BLOCK_CHARS", chars)
    with open(byte_file(), "rb") as f:
        codec = idfiles.TextCodec(f.read())
    rng = np.random.default_rng(0)
    made = ["".join(rng.choice(list("ab' \n\t.1é"), 40)) for _ in range(300)]
    plain = ["".join(rng.choice(list("abÉß漢 \n.,'"), 9)) for _ in range(2000)]
    texts = [*TEXTS, *made, *plain, None, *TEXTS]
    together = codec.texts(pa.array(texts, pa.string()))
    for text, blocks in zip(texts, together, strict=True):
        want = codec.whole(text or "").tolist()
        assert np.concatenate([np.zeros(0, "<u4"), *blocks]).tolist() == want, repr(text)
        assert np.concatenate([np.zeros(0, "<u4"), *codec.blocks(text or "")]).tolist() == want, repr(text)


def test_word_table_keeps_frequent_words_within_its_bound():
    table, learned = WordTable(20_000), Counter()

    def learn(words):
        learned.update(words)
        return [w.encode() for w in words]

    for i in range(500):
        words = ["often", f"rare{i}", f"seldom{i % 100}", "often", "long" * 30]
        assert table.all(words, learn) == [w.encode() for w in words]
        assert table.size <= 20_000 + 1_000 and "long" * 30 not in table.young
    assert learned["often"] == 1 and learned["rare3"] == 1 and learned["long" * 30] == 500
