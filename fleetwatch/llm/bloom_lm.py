"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs of all training texts are gathered by hash. The filter has 4,096 segments by the leading
bits of the hash; a count c is held as its level 1 + floor(log2 c), by storing the n-gram with each level up to its own.
Probing level after level until one is missing gives the level back (never less, seldom more). The words' and the pairs'
counts read this way give an interpolated probability of each word after the one before it.

The filter holds every n-gram, whatever the corpus: a segment grows with its n-grams. As long as all segments together
have at most ``filter_bytes``, the filter is broadcast. A larger one stays a table: the distinct n-grams of each block of
tokens are dealt to their segments, and the levels found there go back to the block. The exact unigram base
score needs no bound: counts of the most frequent words are broadcast (a bounded list), all other words meet their exact
count in a shuffle by word. Words are compared by 63-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwatch.session import settled

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SEGMENT_BITS = 12
SEGMENTS = 1 << SEGMENT_BITS
PROBES = 4
FILL = math.log(2)
END = xxhash.xxh64_intdigest(b" end ")  # holds spaces, so no word has it
BLOCK_TOKENS = 1_000_000
FLUSH = 4_000_000
WEIGHT = 0.7
U = np.uint64
ODD1, ODD2, ODD3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * ODD2
    return h ^ (h >> U(29))


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return hashes | U(1)


def pair_keys(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return _mix(before * ODD1 + hashes * ODD3) & ~U(1)


def _tokens(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole or partial texts: index of the first text, token hashes, text of each token, the token before."""
    digest = xxhash.xxh64_intdigest
    parts: list[np.ndarray] = []
    owners: list[int] = []
    size, before = 0, END

    def out() -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        nonlocal before
        hashes = np.concatenate(parts)
        own = np.repeat(owners, [len(p) for p in parts])
        previous = np.concatenate([np.array([before], U), hashes[:-1]])
        before = int(hashes[-1])
        return owners[0], hashes, own - owners[0], previous

    for k, text in enumerate(texts):
        data = (text or "").encode().lower()
        found: list[int] = []
        for word in WORDS.finditer(data) if len(data) > 16 * BLOCK_TOKENS else WORDS.findall(data):
            found.append(digest(word if isinstance(word, bytes) else word[0]))
            if len(found) >= BLOCK_TOKENS:
                parts.append(np.array(found, U))
                owners.append(k)
                found = []
                yield out()
                parts, owners, size = [], [], 0
        found.append(END)
        parts.append(np.array(found, U))
        owners.append(k)
        size += len(found)
        if size >= BLOCK_TOKENS:
            yield out()
            parts, owners, size = [], [], 0
    if parts:
        yield out()


def _salted(keys: np.ndarray, level: int) -> np.ndarray:
    return _mix(keys + U(level * int(ODD1) & 0xFFFFFFFFFFFFFFFF))


def _slots(keys: np.ndarray, level: int, bits: np.ndarray) -> Iterator[np.ndarray]:
    """Places of an n-gram with a level inside its segment of ``bits`` places (a power of two)."""
    h = _salted(keys, level)
    step = (h >> U(33)) | U(1)
    for i in range(PROBES):
        yield (h + U(i) * step) & (bits - U(1))


@dataclass
class Filter:
    """Bits of all segments one behind the other; ``starts`` in bits, ``bits`` per segment."""

    data: np.ndarray
    starts: np.ndarray
    bits: np.ndarray

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram; 0 for one that isn't held."""
        segment = (keys >> U(64 - SEGMENT_BITS)).astype(np.int64)
        starts, bits = self.starts[segment], self.bits[segment]
        level = np.zeros(len(keys), np.int8)
        live = np.flatnonzero(bits > 0)
        for j in range(1, 64):
            held = live
            for i in range(PROBES):  # few n-grams need all probes: a miss ends them
                if not len(held):
                    break
                h = _salted(keys[held], j)
                at = (h + U(i) * ((h >> U(33)) | U(1))) & (bits[held] - U(1))
                place = starts[held] + at
                held = held[(self.data[(place >> U(3)).astype(np.int64)] >> (place & U(7)).astype(np.uint8)) & 1 == 1]
            if not len(held):
                break
            level[held] = j
            live = held
        return level


def _estimate(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts that share a level."""
    low = np.exp2(levels.astype(float) - 1)
    return np.where(levels > 0, (3 * low - 1) / 2, 0.0)


def _build(batches: Iterator[pd.DataFrame], listed: int) -> Iterator[pd.DataFrame]:
    """Segments from rows (segment, h, n), sorted by segment; then the most frequent words and totals."""
    now, keys, levels = -1, [], []
    top_h, top_n, types, tokens = np.empty(0, U), np.empty(0, np.int64), 0, 0

    def segment() -> pd.DataFrame:
        h, q = np.concatenate(keys), np.concatenate(levels)
        need = q.sum() * PROBES / FILL
        bits = 1 << max(6, math.ceil(math.log2(max(1, need))))
        held = np.zeros(bits, np.uint8)
        for j in range(1, int(q.max(initial=0)) + 1):
            for at in _slots(h[q >= j], j, U(bits)):
                held[at.astype(np.int64)] = 1
        data = np.packbits(held, bitorder="little").tobytes()
        return pd.DataFrame({"kind": [0], "h": [now], "n": [bits], "data": [data]})

    for batch in batches:
        h, n = batch["h"].to_numpy().view(U), batch["n"].to_numpy()
        of = batch["segment"].to_numpy()
        words = (h & U(1)) == 1
        types += int(words.sum())
        tokens += int(n[words].sum())
        top_h, top_n = np.concatenate([top_h, h[words]]), np.concatenate([top_n, n[words]])
        if len(top_h) > 4 * listed:
            best = np.argpartition(-top_n, listed)[:listed]
            top_h, top_n = top_h[best], top_n[best]
        level = np.frexp(n.astype(float))[1].astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            if of[lo] != now:
                if now >= 0:
                    yield segment()
                now, keys, levels = int(of[lo]), [], []
            keys.append(h[lo:hi])
            levels.append(level[lo:hi])
    if now >= 0:
        yield segment()
    if len(top_h) > listed:
        best = np.argpartition(-top_n, listed)[:listed]
        top_h, top_n = top_h[best], top_n[best]
    yield pd.DataFrame({"kind": 1, "h": top_h.view(np.int64), "n": top_n, "data": None})
    yield pd.DataFrame({"kind": [2], "h": [types], "n": [tokens], "data": [None]})


@dataclass
class Model:
    filter: Filter
    common: np.ndarray  # keys of frequent words, sorted
    counts: np.ndarray
    tokens: int
    types: int
    segments: DataFrame | None = None  # (h, n, data) of a filter that is too large to be broadcast; ``filter`` is then empty

    def log10(self, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 probability of each token after the token before it, from counts in the filter.

        P = 0.7 min(1, c(before, token) / c(before)) + 0.3 (c(token) + 0.5) / (N + 0.5 (V + 1)); 0.7 becomes 0 after a
        token that the filter doesn't hold. A text starts after an end.
        """
        both, place = np.unique(np.concatenate([hashes, before]), return_inverse=True)
        single = _estimate(self.filter.levels(word_keys(both)))[place]
        pair = _estimate(self.filter.levels(pair_keys(before, hashes)))
        return self.mixed(single[: len(hashes)], single[len(hashes) :], pair)

    def mixed(self, own: np.ndarray, context: np.ndarray, pair: np.ndarray) -> np.ndarray:
        base = (own + 0.5) / (self.tokens + 0.5 * (self.types + 1))
        follow = np.minimum(1.0, pair / np.maximum(context, 1.0))
        weight = np.where(context > 0, WEIGHT, 0.0)
        return np.log10(weight * follow + (1 - weight) * base)


def fit(training: DataFrame, text: str = "text", filter_bytes: int = 64 << 20, common_words: int = 1 << 16) -> Model:
    """Model of all rows of ``training``; null texts are empty. The filter and the frequent words are all that is
    collected: at most ``filter_bytes``, and about twice ``common_words`` rows. A larger filter isn't collected."""
    spark = training.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for _, hashes, _, before in _tokens(batch["text"].tolist()):
                held += [word_keys(hashes), pair_keys(before, hashes)]
                size += 2 * len(hashes)
                if size >= FLUSH:
                    h, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pd.DataFrame({"h": h.view(np.int64), "n": n})
                    held, size = [], 0
        if held:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    counted = training.select(F.col(text).alias("text")).mapInPandas(count, "h long, n long")
    segment = F.shiftrightunsigned("h", 64 - SEGMENT_BITS).cast("int").alias("segment")
    # Dealt by segment, which also puts equal n-grams together: one shuffle does for the sums and the segments.
    summed = counted.select(segment, "h", "n").repartition(partitions, "segment").groupBy("segment", "h").agg(F.sum("n").alias("n"))
    ordered = summed.sortWithinPartitions(F.col("segment"), F.col("n").desc(), F.col("h"))
    listed = max(64, 2 * common_words // partitions)
    built = ordered.select("segment", "h", "n").mapInPandas(
        lambda it: _build(it, listed), "kind int, h long, n long, data binary"
    )
    built = settled(built, "bloom-filter")
    segments = built.where("kind = 0").select("h", "n", "data")
    large = (segments.agg(F.sum("n").alias("n")).first()["n"] or 0) > 8 * filter_bytes
    rows = (segments.limit(0) if large else segments).toArrow()
    bits = np.zeros(SEGMENTS, U)
    for s, n in zip(rows["h"].to_pylist(), rows["n"].to_pylist(), strict=True):
        bits[s] = n
    starts = np.concatenate([[0], np.cumsum(bits)[:-1]]).astype(U)
    data = np.zeros(int(bits.sum()) // 8 + 1, np.uint8)
    for s, block in zip(rows["h"].to_pylist(), rows["data"], strict=True):
        at = int(starts[s]) // 8
        raw = np.frombuffer(block.as_buffer(), np.uint8)
        data[at : at + len(raw)] = raw
    common = built.where("kind = 1").select("h", "n").toArrow()
    keys, counts = common["h"].to_numpy().astype(np.int64).view(U), common["n"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    total = built.where("kind = 2").agg(F.sum("h").alias("v"), F.sum("n").alias("n")).first()
    model = Model(Filter(data, starts, bits), keys[order], counts[order], total["n"] or 0, total["v"] or 0)
    return replace(model, segments=segments if large else None)


def _block_keys(hashes: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block's words, the words before them and their pairs, and the places of these three among them."""
    previous = np.concatenate([np.array([before], U), hashes[:-1]])
    return np.unique(
        np.concatenate([word_keys(hashes), word_keys(previous), pair_keys(previous, hashes)]), return_inverse=True
    )


def _dealt_scores(blocks: DataFrame, probes: DataFrame, model: Model) -> DataFrame:
    """(row, lm): sums of the log10 probabilities of each text in each block, with the filter's segments as a table.

    ``blocks`` has (block, before, rows, lengths, hashes), ``probes`` (block, segment, data): a block's distinct keys there.
    """
    plain = replace(model, segments=None, filter=None, common=None, counts=None)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = -1, None
        for batch in batches:
            segment, data = batch["segment"].to_numpy(), batch["data"].tolist()
            block, bits = batch["block"].to_numpy(), batch["bits"].to_numpy()
            out = []
            cuts = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1, [len(segment)]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi > lo and segment[lo] != now:
                    now, held = segment[lo], None
                if hi > lo and bits[lo] > 0:  # the segment itself stands before its probes
                    held = Filter(np.frombuffer(data[lo], np.uint8), np.zeros(SEGMENTS, U), np.full(SEGMENTS, bits[lo], U))
                    lo += 1
                if hi > lo:
                    asked = np.frombuffer(b"".join(data[lo:hi]), U)
                    level = held.levels(asked) if held else np.zeros(len(asked), np.int8)
                    ends = np.cumsum([len(d) // 8 for d in data[lo:hi]])[:-1]
                    out += zip(block[lo:hi], segment[lo:hi], [x.tobytes() for x in np.split(level, ends)], strict=True)
            yield pd.DataFrame(out, columns=["block", "segment", "levels"])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, tokens, parts = None, None, []

        def scored() -> pd.DataFrame:
            before, rows, lengths, hashes = tokens
            hashes = np.frombuffer(hashes, U)
            _, place = _block_keys(hashes, before & 0xFFFFFFFFFFFFFFFF)
            own, context, pair = np.split(_estimate(np.frombuffer(b"".join(parts), np.int8))[place], 3)
            lengths = np.frombuffer(lengths, np.int64)
            of = np.repeat(np.arange(len(lengths)), lengths)
            lm = np.bincount(of, plain.mixed(own, context, pair), minlength=len(lengths))
            return pd.DataFrame({"row": np.frombuffer(rows, np.int64), "lm": lm})

        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.block != now:
                    if tokens:
                        yield scored()
                    now, tokens, parts = r.block, (r.before, r.rows, r.lengths, r.hashes), []
                else:
                    parts.append(r.levels)
        if tokens:
            yield scored()

    none = F.lit(None).cast("binary")
    held = model.segments.select(F.col("h").cast("int").alias("segment"), F.lit(-1).cast("long").alias("block"), F.col("n").alias("bits"), "data")
    asked = probes.select("segment", "block", F.lit(0).cast("long").alias("bits"), "data")
    met = held.unionByName(asked).repartition("segment").sortWithinPartitions("segment", "block")
    found = met.mapInPandas(look, "block long, segment int, levels binary")
    whole = blocks.select("block", F.lit(-1).alias("segment"), none.alias("levels"), "before", "rows", "lengths", "hashes")
    found = found.select(
        "block", "segment", "levels", F.lit(0).cast("long").alias("before"), none.alias("rows"), none.alias("lengths"), none.alias("hashes")
    )
    back = whole.unionByName(found).repartition("block").sortWithinPartitions("block", "segment")
    return back.mapInPandas(gather, "row long, lm double")


def score(docs: DataFrame, model: Model, held_out: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    ``held_out`` names a boolean column that is true for rows outside the training set. Null and empty texts have one
    token, the end. Repeated rows come back as often. A word that isn't among the broadcast ones is dealt by its key, with
    the number of times each text has it; the training texts' numbers there add up to its exact count.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(replace(model, segments=None))
    dealt = model.segments is not None
    tokens, types = model.tokens, model.types
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(held_out).alias("held"), F.col(text).alias("text"),
        F.col(key).cast("string").alias("key"),
    )
    schema = "h long, row long, n int, trained boolean, doc struct<key string, held boolean, n long, known long, base double, lm double>"
    more = "block long, segment int, data binary, before long, rows binary, lengths binary, hashes binary"
    blank = dict.fromkeys([c.split(" ")[0] for c in f"{schema.split(', doc')[0]}, doc x, {more}".split(", ")])

    def block_rows(block: int, ids: np.ndarray, hashes: np.ndarray, own: np.ndarray, before: int) -> Iterator[pd.DataFrame]:
        """A block's tokens, and its distinct keys by segment."""
        lengths = np.bincount(own, minlength=len(ids)).astype(np.int64)
        yield pd.DataFrame([blank | {
            "block": block, "before": np.array([before], U).view(np.int64)[0], "rows": ids.astype(np.int64).tobytes(),
            "lengths": lengths.tobytes(), "hashes": hashes.tobytes(),
        }])
        keys, _ = _block_keys(hashes, before)
        segment = (keys >> U(64 - SEGMENT_BITS)).astype(np.int32)
        start = np.concatenate([[0], np.flatnonzero(segment[1:] != segment[:-1]) + 1])
        data = [k.tobytes() for k in np.split(keys, start[1:])]
        yield pd.DataFrame(blank | {"block": block, "segment": segment[start], "data": data})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, held = batch["row"].to_numpy(), batch["held"].to_numpy()
            n = np.zeros(len(batch), np.int64)
            known, base, lm = np.zeros(len(batch), np.int64), np.zeros(len(batch)), np.zeros(len(batch))
            for first, hashes, own, before in _tokens(batch["text"].tolist()):
                width = int(own[-1]) + 1
                span = slice(first, first + width)
                n[span] += np.bincount(own, minlength=width)
                if dealt:
                    yield from block_rows(block, ids[span], hashes, own, int(before[0]))
                    block += 1
                else:
                    lm[span] += np.bincount(own, model.log10(hashes, before), minlength=width)
                keys = word_keys(hashes)
                at = np.searchsorted(model.common, keys)
                at[at == len(model.common)] = 0
                common = model.common[at] == keys if len(model.common) else np.zeros(len(keys), bool)
                if common.any():
                    known[span] += np.bincount(own[common], minlength=width)
                    base[span] += np.bincount(own[common], np.log10(model.counts[at[common]] + 0.5), minlength=width)
                rare_h, rare_own = keys[~common], own[~common]
                order = np.lexsort((rare_h, rare_own))
                rare_h, rare_own = rare_h[order], rare_own[order]
                new = np.ones(len(rare_h), bool)
                new[1:] = (rare_h[1:] != rare_h[:-1]) | (rare_own[1:] != rare_own[:-1])
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(rare_h)))
                where = rare_own[start] + first
                yield pd.DataFrame((blank if dealt else {}) | {
                    "h": rare_h[start].view(np.int64), "row": ids[where], "n": times.astype(np.int32),
                    "trained": ~held[where].astype(bool), "doc": None,
                })
            doc = pd.DataFrame({"key": batch["key"], "held": held.astype(bool), "n": n, "known": known, "base": base, "lm": lm})
            yield pd.DataFrame((blank if dealt else {}) | {
                "h": ids * 2, "row": ids, "n": 0, "trained": False, "doc": doc.to_dict("records"),
            })

    if dealt:  # written once, so that all parts see the same row numbers
        made = settled(rows.mapInPandas(run, f"{schema}, {more}"), "bloom-probes")
        met = made.where("block IS NULL").select("h", "row", "n", "trained", "doc")
        blocks, probes = made.where("hashes IS NOT NULL"), made.where("segment IS NOT NULL")
    else:
        met = rows.mapInPandas(run, schema)
    count = F.sum(F.when(F.col("trained"), F.col("n")).otherwise(0)).over(Window.partitionBy("h"))
    met = met.withColumn("c", count)
    met = met.withColumn("lm", F.col("doc.lm"))
    if dealt:
        scores = _dealt_scores(blocks, probes, model)
        met = met.unionByName(scores.withColumns({"n": F.lit(0), "c": F.lit(0).cast("long")}), allowMissingColumns=True)
    word = F.col("doc").isNull()
    whole = met.groupBy("row").agg(
        F.sum(F.when(word, F.col("n") * F.log10(F.col("c") + 0.5)).otherwise(0.0)).alias("rare"),
        F.sum(F.when(word & (F.col("c") > 0), F.col("n")).otherwise(0)).alias("found"),
        F.sum("lm").alias("lm"), F.first("doc", ignorenulls=True).alias("doc"),
    )
    scale = math.log10(tokens + 0.5 * (types + 1))
    return whole.select(
        F.col("doc.key").cast(docs.schema[key].dataType).alias(key), F.col("doc.held").alias("held_out"),
        F.col("doc.n").alias("n_tokens"), (F.col("doc.known") + F.col("found")).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("doc.base") + F.col("rare") - F.col("doc.n") * F.lit(scale)).alias("base_score"),
        F.col("lm").alias("score"),
    )
