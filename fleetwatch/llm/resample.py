"""Importance resampling towards a target collection by hashed n-grams.

Features are runs of one to three words, hashed into buckets. A bucket's gain is the logarithm of its share in the target
over its share in the source; an array of gains, as long as there are buckets, scores a document by the sum over its
features. Random noise that depends on the id alone turns the highest scores into a draw without replacement. The draw's
last score is found by bisection: exact counts over the written scores narrow the threshold down, then the tied ids. Only
thresholds and counts reach the driver; the drawn rows are ranked by range partitions.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.plans.ordering import rank_in_group
from fleetwatch.session import settled

BLOCK = 1 << 20
WAYS = 16  # parts into which one count job cuts the thresholds' range
_WORD = {*b"0123456789", *string.ascii_lowercase.encode(), *range(0x80, 0x100)}
_FOLD = bytes(b if b in _WORD else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in UTF-8 with A-Z in lower case, block by block: runs of digits, letters and non-ASCII characters."""
    text, at = text.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def features_of(text: bytes, buckets: int, longest: int = 3) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the runs that end in them) for each block of a text."""
    before: list[bytes] = []
    for new in words_of(text):
        words = before + new
        hashes = list(map(crc32, words))
        found = hashes[len(before) :]
        tails = [b" " + w for w in words]
        for n in range(2, longest + 1):  # a run's hash goes on from that of the run without its last word
            hashes = list(map(crc32, tails[n - 1 :], hashes))
            found += hashes[max(0, len(before) - n + 1) :]
        yield len(new), np.array(found, np.uint32) % np.uint32(buckets)
        before = words[max(0, len(words) - longest + 1) :] if longest > 1 else []


def bucket_counts(texts: DataFrame, text: str, buckets: int, longest: int = 3) -> np.ndarray:
    """Features in every bucket. A task adds its own up first, so that as many rows leave it as there are buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                if value.is_valid:
                    for _, found in features_of(value.as_py(), buckets, longest):
                        total += np.bincount(found, minlength=buckets) if len(found) > buckets else 0
                        if len(found) <= buckets:
                            np.add.at(total, found, 1)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(total[full])], ["bucket", "n"])

    column = F.col(f"`{text.replace('`', '``')}`").cast("binary").alias("text")
    rows = texts.select(column).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: float = 1000.0) -> np.ndarray:
    """Whole-numbered log ratios of the smoothed shares, bucket by bucket."""
    size, s, t = float(len(source)), float(source.sum()), float(target.sum())
    ratios = [((float(b) + 1) * (s + size)) / ((float(a) + 1) * (t + size)) for a, b in zip(source, target, strict=True)]
    return np.array([math.floor(scale * math.log(r)) for r in ratios], np.int64)


def _noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the key's text alone; a null key counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def score_rows(docs: DataFrame, gain: np.ndarray, text: str, key: str, seed: int, longest: int = 3) -> DataFrame:
    """(row, key, n_words, n_features, weight, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    kind = docs.schema[key].dataType.simpleString()
    name = lambda c: F.col(f"`{c.replace('`', '``')}`")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            rows = np.zeros((batch.num_rows, 3), np.int64)
            for i, value in enumerate(batch.column(0)):
                if value.is_valid:
                    for n, found in features_of(value.as_py(), len(gain), longest):
                        rows[i] += n, len(found), gain[found].sum()
            columns = [pa.array(np.ascontiguousarray(c)) for c in rows.T]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], ["key", "n_words", "n_features", "weight"])

    slim = docs.select(name(text).cast("binary").alias("text"), name(key).alias("key"))
    weighed = slim.mapInArrow(weigh, f"key {kind}, n_words long, n_features long, weight long")
    score = F.col("weight") + _noise(F.col("key"), seed)
    return weighed.withColumn("score", score).withColumn("row", F.monotonically_increasing_id())


def _threshold(df: DataFrame, value: Column, need: int) -> tuple[int, int, int]:
    """The least t such that ``need`` rows have ``value`` <= t, the rows below t, and those at t, by exact counts."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = span["lo"], span["hi"]
    while lo < hi:
        cuts = sorted({lo + (hi - lo) * i // WAYS for i in range(WAYS)})
        counts = df.agg(*[F.count_if(value <= F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        reached = [c for c, n in zip(cuts, counts, strict=True) if n >= need]
        short = [c for c, n in zip(cuts, counts, strict=True) if n < need]
        hi = min(reached, default=hi)
        lo = max(short, default=lo - 1) + 1
    ends = df.agg(F.count_if(value < F.lit(hi)).alias("below"), F.count_if(value == F.lit(hi)).alias("at")).first()
    return hi, ends["below"], ends["at"]


def draw(scored: DataFrame, need: int) -> Column:
    """Condition of the ``need`` first rows by score (descending), key (null last), features and row number."""
    order = [-F.col("score"), F.col("key").isNull().cast("long"), F.coalesce(F.col("key"), F.lit(0)), F.col("n_features"), F.col("row")]
    drawn, tied = F.lit(False), F.lit(True)
    for value in order:
        if not need:
            break
        t, below, at = _threshold(scored.where(tied), value, need)
        drawn = drawn | (tied & (value < F.lit(t)))
        tied = tied & (value == F.lit(t))
        need -= below
        if need == at:
            return drawn | tied
    return drawn


def importance_resample(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text", percent: int = 5,
    min_words: int = 20, buckets: int = 10_000, longest: int = 3, seed: int = 42,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; rank is null for rows that are not drawn.

    ``percent`` of the rows with at least ``min_words`` words are drawn (rounded down), the highest scores first, ties to
    the smaller key, null keys last; rows that agree in all columns share any of their ranks. Keys are whole numbers.
    Null and empty texts have no features and weight 0; very long texts are counted whole, block by block; an empty table
    gives an empty result, an empty target a uniform one. Other columns are not read, whatever their names.
    """
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    scored = settled(score_rows(docs, gain, text, key, seed, longest), "resample-scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    need = percent * eligible.count() // 100
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    if not need:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= min_words) & draw(eligible, need)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("n_features"), F.col("row")]
    ranked = rank_in_group(scored.where(drawn), [], order, "rank").select(*columns, "rank")
    return ranked.unionByName(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
