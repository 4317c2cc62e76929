"""Language ID, line rules, language model, pieces, mix and near duplicates against brute force and on odd rows."""

from __future__ import annotations

import array
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from fleetwatch.llm import bloom_lm, langid, lines, mix, pieces, simhash
from fleetwatch.llm.queries import QUERIES, language_model, piece_file
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# Language ID


def test_forward_sums_all_segmentations():
    vocabulary = langid.load_vocabulary(piece_file())
    rng = np.random.default_rng(0)
    probs = rng.random((vocabulary.none + 1, 2))
    probs[vocabulary.none] = 0

    def brute(word, lang):
        if not word:
            return 1.0
        total = 0.0
        for n in range(1, min(len(word), vocabulary.longest) + 1):
            h = langid._hash(langid._codes([word[:n]], n))[0]
            at = np.searchsorted(vocabulary.hashes, h)
            known = at < len(vocabulary.hashes) and vocabulary.hashes[at] == h
            if known or n == 1:
                total += probs[at if known else vocabulary.unknown, lang] * brute(word[n:], lang)
        return total

    for word in ("▁the", "▁thermal", "▁漢字x"):
        logs = langid._log_sums([word], vocabulary, probs)[0]
        assert np.exp(logs) == pytest.approx([brute(word, 0), brute(word, 1)])


@pytest.mark.parametrize("length", [1, 7, 8, 9, 33, 43, 400])
def test_long_words_are_summed_in_logs(length):
    """The scaled recursion against one in exact fractions, at the least probabilities too; and it sums for posteriors."""
    from fractions import Fraction

    vocabulary = langid.load_vocabulary(piece_file())
    rng = np.random.default_rng(length)
    probs = np.maximum(rng.random((vocabulary.none + 1, 1)) ** 30, langid.FLOOR)
    probs[vocabulary.none] = 0
    word = "▁" + "".join(rng.choice(list("donaudampfschiffß漢"), length))
    lattice = langid._lattice([word], vocabulary)
    sums = [Fraction(1)]
    for i in range(1, len(word) + 1):
        ways = range(1, min(i, len(lattice)) + 1)
        sums.append(sum(sums[i - k] * Fraction(float(probs[lattice[k - 1][0, i - k], 0])) for k in ways))
    want = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
    assert langid._log_sums([word], vocabulary, probs)[0, 0] == pytest.approx(want, rel=1e-9)
    used = langid._expected([word], np.array([2.0]), probs, vocabulary)
    lengths = np.zeros(len(used))
    for k, row in enumerate(lattice, 1):
        lengths[row[0]] = k
    lengths[vocabulary.unknown] = 1
    lengths[vocabulary.none] = 0
    assert used @ lengths == pytest.approx(2.0 * len(word))  # every character is in one piece of each segmentation


def test_expected_counts_cover_every_letter():
    vocabulary = langid.load_vocabulary(piece_file())
    probs = np.full((vocabulary.none + 1, 1), 0.01)
    probs[vocabulary.none] = 0
    used = langid._expected(["▁q"], np.array([3.0]), probs, vocabulary)
    assert 3.0 <= used.sum() <= 6.0


def test_language_id(spark, odd, clashing, empty):
    model = language_model(odd)
    out = odd.select("doc_id", "text", "lang", langid.predict(F.col("text"), model).alias("p")).select("*", "p.*").collect()
    assert len(out) == odd.count()
    for r in out:
        if r.text is None or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "de") and 0 < r.score <= 1
    good = [r.lang_pred == r.lang for r in out if r.doc_id is not None and r.doc_id < 60]
    assert np.mean(good) > 0.95
    again = clashing.select(langid.predict(F.col("text"), model).alias("p")).select("p.*")
    assert Counter(rows_of(again)) == Counter((r.lang_pred, r.score) for r in out)
    none = language_model(empty)
    assert none.languages == []
    assert {r[0] for r in rows_of(odd.select(langid.predict(F.col("text"), none)["lang_pred"]))} == {"und"}
    assert rows_of(empty.select(langid.predict(F.col("text"), none))) == []


def test_held_out_accuracy(spark):
    out = QUERIES["op1_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = out.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_long_text_in_blocks(monkeypatch):
    vocabulary = langid.load_vocabulary(piece_file())
    probs = np.full((vocabulary.none + 1, 2), 0.001)
    probs[vocabulary.none] = 0
    text = prose(3, "en", 500)
    whole = langid.Scorer(vocabulary, probs).texts([text, "a", None])
    monkeypatch.setattr(langid, "BLOCK_CHARS", 100)
    parts = langid.Scorer(vocabulary, probs).texts([text, "a", None])
    np.testing.assert_allclose(whole, parts)


# Line rules


def test_line_rules_on_odd_rows(spark, odd, clashing, empty):
    out = lines.judge_lines(odd)
    docs = odd.toPandas()  # noqa: F841  read by DuckDB
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.sql(lines.oracle_sql()).fetchall()
    got = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    clean = lambda rows: Counter(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)
    assert clean(rows_of(got)) == clean(want)
    other = lines.judge_lines(clashing)
    assert {"key", "score", "target"} <= set(other.columns)
    assert Counter(rows_of(other.select(*got.columns))) == Counter(rows_of(got))
    assert lines.judge_lines(empty).count() == 0


@pytest.mark.parametrize(
    "line, stays",
    [
        ("A sentence ends here.", True), ("No end", False), ("", True), ("  \t", True), ('She said "go."', True),
        ("Home | News | Sport.", False), ("We use cookies on this site.", False), ("Ends with space. \t", True),
        ("A long line that speaks of cookies, " + "and of much else " * 9 + "as it goes on, use cookies or not.", True),
    ],
)
def test_line_passes(spark, line, stays):
    df = spark.createDataFrame([(line,)], "line string").select(lines.line_passes(F.col("line")))
    assert df.first()[0] is stays


@pytest.mark.parametrize("closers, stays", [(0, True), (7, True), (8, True), (9, True), (500, True)])
def test_any_number_of_closers(spark, closers, stays):
    lines_ = [("He said so." + ")" * closers, stays), ("He said so" + ")" * closers, False), (")" * (closers + 1), False)]
    df = spark.createDataFrame([(x,) for x, _ in lines_], "line string")
    assert [r[0] for r in df.select(lines.line_passes(F.col("line"))).collect()] == [y for _, y in lines_]


def test_cleaned_text_and_lost_share(spark):
    good = "The river runs to the sea and the sea is wide and green today."
    text = "\n".join([good, "menu", good.replace("sea", "lake")])
    junk = "\n".join([good, *["word without any end at all here now then"] * 5])
    out = lines.judge_lines(spark.createDataFrame([(1, text), (2, junk)], "doc_id int, text string")).orderBy("doc_id").collect()
    assert out[0].kept and out[0].cleaned == "\n".join([good, good.replace("sea", "lake")])
    assert not out[1].kept and out[1].n_dup_lines == 4


# Language model


def brute_base(texts, held):
    tokens = [WORD.findall((t or "").translate(LOWER)) + [" end "] for t in texts]
    c = Counter(x for t, h in zip(tokens, held, strict=True) if not h for x in t)
    total = sum(c.values())
    scale = math.log10(total + 0.5 * (len(c) + 1))
    return total, [(len(t), sum(c[x] > 0 for x in t), sum(math.log10(c[x] + 0.5) - scale for x in t)) for t in tokens]


@pytest.mark.parametrize("common", [1 << 16, 1])
def test_base_score_is_exact(spark, odd, clashing, common, monkeypatch):
    from fleetwatch.llm.common import id_remainder

    held = id_remainder(F.col("doc_id"), 5) == 1
    for docs in (odd, clashing):
        model = bloom_lm.fit(docs.where(~held), common_words=common)
        if common == 1:  # only END and a few others are broadcast, all else meets in the shuffle
            model.common, model.counts = model.common[:3], model.counts[:3]
        out = bloom_lm.score(docs.withColumn("held", held), model, "held")
        texts = [(r.doc_id, r.text) for r in odd.collect()]
        flags = [zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i, _ in texts]
        total, want = brute_base([t for _, t in texts], flags)
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out.collect())
        assert got == sorted((i if i is not None else -1, n, k, round(b, 6)) for (i, _), (n, k, b) in zip(texts, want, strict=True))
        assert {r.train_tokens for r in out.collect()} == {total}


def test_filter_levels(spark):
    text = " ".join(["aa"] * 9 + ["bb"] * 4 + ["cc"])
    model = bloom_lm.fit(spark.createDataFrame([(text,)], "text string"))
    digest = lambda w: np.array([xxhash.xxh64_intdigest(w)], np.uint64)
    level = lambda w: int(model.filter.levels(bloom_lm.word_keys(digest(w)))[0])
    assert (level(b"aa"), level(b"bb"), level(b"cc"), level(b"zz")) == (4, 3, 1, 0)
    pair = bloom_lm.pair_keys(digest(b"aa"), digest(b"aa"))
    assert int(model.filter.levels(pair)[0]) == 4  # 8 times


def test_model_beats_unigrams_and_bounds_its_filter(spark, empty):
    rows = [(i, " ".join(["alpha beta gamma delta"] * 30)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held", F.col("doc_id") >= 15)
    model = bloom_lm.fit(docs.where("not held"))
    out = bloom_lm.score(docs, model, "held").where("held_out").collect()
    assert all(r.score > r.base_score + 10 for r in out)
    small = bloom_lm.fit(docs.where("not held"), filter_bytes=1)
    assert len(small.filter.data) <= bloom_lm.SEGMENTS * 8 + 1
    none = bloom_lm.fit(empty)
    assert (none.tokens, none.types) == (0, 0)
    got = bloom_lm.score(docs.withColumn("held", F.lit(True)), none, "held").first()
    assert got.n_known == 0 and got.base_score == 0.0
    assert bloom_lm.score(empty.withColumn("held", F.lit(True)), none, "held").count() == 0


def test_a_filter_beyond_the_bound_keeps_every_ngram(spark):
    rows = [(i, " ".join(f"w{i}x{j} the" if j % 3 else f"v{j}" for j in range(300)) if i % 50 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held", F.col("doc_id") % 5 == 1)
    docs = docs.unionByName(docs.where("doc_id < 9"))
    large, small = (bloom_lm.fit(docs.where("not held"), filter_bytes=n) for n in (64 << 20, 4096))
    want, got = (
        sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in bloom_lm.score(docs, m, "held").collect())
        for m in (large, small)
    )
    assert got == want and len(got) == 209


def test_tokens_in_blocks(monkeypatch):
    texts = [prose(1, "en", 300), None, "", "One two", prose(2, "de", 250)]
    def gather():
        return [(first + int(o), int(h), int(b)) for first, hs, own, before in bloom_lm._tokens(texts) for h, o, b in zip(hs, own, before, strict=True)]
    whole = gather()
    monkeypatch.setattr(bloom_lm, "BLOCK_TOKENS", 7)
    assert gather() == whole
    assert len(whole) == sum(len(WORD.findall(t or "")) + 1 for t in texts)


# Pieces


def library_rows(texts):
    p = sentencepiece.SentencePieceProcessor(model_file=piece_file())
    for t in texts:
        ids = p.encode(t or "", add_bos=True, add_eos=True)
        yield len(ids), hashlib.sha256(array.array("I", ids).tobytes()).hexdigest(), hashlib.sha256(p.decode(ids).encode()).hexdigest()


def test_pieces_equal_the_library(spark, odd, clashing, empty):
    want = Counter(library_rows([r.text for r in odd.collect()]))
    for docs in (odd, clashing):
        assert Counter(rows_of(docs.select(pieces.token_digests(F.col("text"), piece_file()).alias("t")).select("t.*"))) == want
    assert rows_of(empty.select(pieces.token_digests(F.col("text"), piece_file()))) == []
    p = sentencepiece.SentencePieceProcessor(model_file=piece_file())
    for text, ids in rows_of(odd.select("text", pieces.token_ids(F.col("text"), piece_file()))):
        assert ids == p.encode(text or "", add_bos=True, add_eos=True)


def test_pieces_on_random_text():
    codec = pieces.PieceCodec(open(piece_file(), "rb").read())
    rng = np.random.default_rng(1)
    signs = list("aabcdeeeiort    ▁\n\tÉéß漢😀\u0301\x00<>/01.,'")
    for n in (1, 2, 3, 10, 200, 2000):
        for _ in range(20):
            text = "".join(rng.choice(signs, n))
            ids = codec.encode(text)
            assert ids == codec.library.encode(text, add_bos=True, add_eos=True)
            assert codec.decode(ids) == codec.library.decode(ids)


def test_pieces_in_blocks(monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 50)
    monkeypatch.setattr(pieces, "WORD_BYTES", 2000)
    codec = pieces.PieceCodec(open(piece_file(), "rb").read())
    texts = [prose(4, "fr", 400), "  " * 200 + "a", "x" * 300, ""]
    assert [codec.digest(t) for t in texts] == list(library_rows(texts))


def test_pieces_of_many_texts_at_once(monkeypatch):
    codec = pieces.PieceCodec(open(piece_file(), "rb").read())
    rng = np.random.default_rng(2)
    signs = list("abcdei .,\n\n   ▁Éß漢😀")
    texts = ["".join(rng.choice(signs, n)) for n in (1, 2, 5, 9, 30) for _ in range(200)]
    texts += ["\n", "a\nb", "a\n\nb.", "a \nb", "\na", "a ", " a", "", "▁a b", "x" * 300, "<0x0A> <s>", prose(3, "de", 300)]
    for most in (1 << 20, 50):
        monkeypatch.setattr(pieces, "STRETCH_BYTES", most)
        got = list(codec.digests(pa.array([*texts, None], pa.string())))
        assert got == list(library_rows([*texts, ""]))


# Mix


def targets_of(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        rate = rest / share if share else 0
        more = {s for s in sizes if s not in full and weight[s] * rate >= 3 * sizes[s]}
        if not more:
            return {s: 3 * sizes[s] if s in full else weight[s] * rate for s in sizes}
        full |= more


def test_mix(spark, odd, clashing, empty):
    out = mix.mix_copies(odd).collect()
    assert len(out) == odd.count()
    sizes = Counter()
    for r in out:
        sizes[r.source] += r["size"]
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    texts = {(r.doc_id, r.text): len(WORD.findall(r.text or "")) for r in odd.collect()}
    assert sum(sizes.values()) == sum(len(WORD.findall(r.text or "")) for r in odd.collect()) and texts
    want = targets_of(dict(sizes))
    largest = Counter()
    taken = Counter()
    for r in out:
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], 2 * r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert Counter(tuple(r) for r in out) == Counter(rows_of(mix.mix_copies(clashing)))
    assert mix.mix_copies(empty).count() == 0


def test_mix_tree_keeps_words_and_expectations(spark, monkeypatch):
    monkeypatch.setattr(mix, "CHUNK", 8)
    rows = [(i, " ".join(["w"] * (1 + i % 9)), f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix.mix_copies(docs).toPandas()
    for _, g in out.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 9
    share = out[out["source"] == "s0"]
    small, large = share[share["size"] <= 3], share[share["size"] >= 7]
    assert abs(small["copies"].mean() - large["copies"].mean()) < 0.3  # size does not decide


def test_rows_that_share_a_key_meet_the_target(spark):
    rows = [(None, f"w{i} " * 10, "a") for i in range(101)] + [(i, "w " * (5 + i % 7), f"{'abc'[i % 3]}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = mix.mix_copies(docs)
    out = copies.toPandas()
    for _, g in out.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 11
    taken = mix.mix(docs)
    assert taken.count() == out["copies"].sum()
    shared = out[out["doc_id"].isna()]["copies"]
    assert 0 < (shared == shared.max()).sum() < 101  # some rows have one more copy than others
    counts = Counter(r.text for r in taken.where("doc_id is null").collect())
    assert sum(counts.values()) == shared.sum() and set(counts.values()) <= set(shared)


def test_mix_repeats_rows(spark, odd):
    copies = mix.mix_copies(odd)
    out = mix.mix(odd)
    assert out.columns == odd.columns
    assert out.count() == copies.agg(F.sum("copies")).first()[0]
    assert Counter(rows_of(out)) == Counter(rows_of(mix.mix(odd)))


def test_every_source_ends_near_its_target(spark):
    """Sources of a few dozen documents too: what is left to round is a small document."""
    out = mix.mix_copies(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    for _, g in out.groupby("source", dropna=False):
        assert abs(g["taken"].sum() / g["target"].iloc[0] - 1) <= 0.02


def test_a_chunk_keeps_its_words_and_expectations(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(0)
    monkeypatch.setattr(mix, "HEAVY", 2.0)
    sizes, p = np.exp(rng.normal(4, 2, 40)).astype(int) + 1, rng.uniform(0, 1, 40)
    total = np.zeros(40)
    for _ in range(4000):
        rows = pd.DataFrame({"key": [f"{i:02d}" for i in range(40)], "size": sizes, "p": p, "u": rng.uniform(0, 1, 40)})
        out = mix._pivot(rows).sort_values("key")["p"].to_numpy()
        assert abs(out @ sizes - p @ sizes) < 1e-6 * sizes.sum()
        assert (np.minimum(out, 1 - out) > mix.EXACT).sum() <= 2
        total += out
    assert np.abs(total / 4000 - p).max() < 0.04


def test_rows_without_a_decision_are_an_error(spark, tmp_path):
    from fleetwatch.llm import rowvectors

    spark.range(50).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    some = docs.select(*rowvectors.identity(docs), F.col("id").alias("n"))
    right = rowvectors.write_vectors(some, "some")
    assert {(r.id, r.n) for r in docs.select("id", rowvectors.decided(docs, right).alias("n")).collect()} == {(i, i) for i in range(50)}
    lacking = rowvectors.write_vectors(some.where("n <> 7"), "lacking")
    with pytest.raises(Exception, match="no decision"):
        docs.select(rowvectors.decided(docs, lacking).alias("n")).collect()


# SimHash


def brute_print(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in values}


def test_simhash_on_odd_rows(spark, odd, clashing, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = Counter((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True))
    assert Counter(rows_of(simhash.near_duplicates(odd))) == want
    assert Counter(rows_of(simhash.near_duplicates(clashing))) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bucket", [256, 40])
def test_links_connect_what_brute_force_connects(spark, bucket):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    near = [int(b) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for b in base.repeat(6)]
    chain = [0]
    for _ in range(60):
        chain.append(chain[-1] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    dense = [sum(1 << i for i in range(12) if n >> i & 1) for n in range(0, 4096, 5)]
    values = sorted({*base.tolist(), *near, *chain, *dense})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 2, bucket)
    for a, b in rows_of(links):
        assert (int(a) & (2**64 - 1)) ^ (int(b) & (2**64 - 1)) or a != b
    got = {r.node & (2**64 - 1): r.root for r in simhash.components(links).collect()}
    want = brute_components(values)
    groups = lambda label: {frozenset(g) for g in _grouped(label).values()}
    assert groups({v: got.get(v, v if not v >> 63 else v - (1 << 64)) for v in values}) == groups(want)


def _grouped(label):
    out = {}
    for v, r in label.items():
        out.setdefault(r, set()).add(v)
    return out


def test_partitions_cover_every_pair():
    rng = np.random.default_rng(4)
    sample = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    for rows in (10, 10**6, 10**10):
        parts = simhash.plan_partitions(sample, rows, 2)
        for _ in range(300):
            flips = rng.choice(64, 2, replace=False).tolist()
            assert any(sum(b in group for b in flips) <= limit for group, limit in parts)
