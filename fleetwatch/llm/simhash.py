"""Near duplicates by SimHash fingerprints and the generalised pigeonhole principle.

The 64 bits are grouped by correlation into m partitions. If two fingerprints differ in at most d bits, and thresholds t
of the partitions sum to d - m + 1, some partition differs in at most its t bits (t = -1 leaves a partition out). Dynamic
programming picks the thresholds, and the number of partitions, with the fewest expected probes and candidates, estimated
on a bounded sample of fingerprints. Each fingerprint is probed under all keys within a partition's threshold, and meets
in a bucket; pairs of a bucket are verified on all 64 bits. A bucket with more than ``bucket`` fingerprints is not
compared as a whole: it is cut by further bits, again so that no near pair is lost, until it is small enough.
Buckets yield a tree of links per local component, not all pairs; components follow by alternating stars.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.common import uniform, where_computed
from fleetwatch.llm.rowvectors import decided, identity, stored, write_vectors
from fleetwatch.session import settled

BITS = 64
SEED = 42
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK = 1 << 16
PROBE_COST = 500.0  # a shuffled and sorted key against one comparison of two fingerprints in an array


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles; zero without words."""
    words = WORDS.findall(text.encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(first), BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(first[i : i + BLOCK], last[i : i + BLOCK], strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprint(col: Column, shingle: int = 3) -> Column:
    """Column of fingerprints as signed longs; null text has no words."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = [fingerprint_of(t, shingle) if isinstance(t, str) else 0 for t in texts]
            yield pd.Series(np.array(values, np.uint64).view(np.int64))

    return F.pandas_udf(run, "long")(col)


def fingerprint_hex(col: Column) -> Column:
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def _groups(bits: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of nearly equal width, correlated bits together. ``bits`` is (sample, 64) of 0 and 1."""
    spread = bits.std(axis=0)
    centred = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    link = np.abs(centred.T @ centred) / max(1, len(bits))
    np.fill_diagonal(link, 0)
    left, groups = list(range(BITS)), []
    for k in range(m):
        width = math.ceil(len(left) / (m - k))
        group = [max(left, key=lambda b: (link[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: (link[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _allocate(cost: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one per partition, that sum to ``budget`` at the least cost; cost[i][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (value, chosen) in best.items():
            for t in range(-1, len(row) - 1):
                found = (value + row[t + 1], [*chosen, t])
                if spent + t not in step or found < step[spent + t]:
                    step[spent + t] = found
        best = step
    return best[budget]


def plan_partitions(sample: np.ndarray, rows: int, distance: int = 2) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions that are probed, for ``rows`` distinct fingerprints."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    few = sample[:1000]
    best: tuple[float, list] | None = None
    for m in range(2, distance + 3):
        groups = _groups(bits, m)
        cost = []
        for group in groups:
            mask = np.uint64(sum(1 << b for b in group))
            apart = np.bitwise_count((few[:, None] ^ few[None, :]) & mask)
            apart = apart[~np.eye(len(few), dtype=bool)]
            row = [0.0]
            for t in range(distance + 1):
                keys = sum(math.comb(len(group), j) for j in range(t + 1))
                near = max(float((apart <= t).mean()) if len(apart) else 0.0, keys / 2.0 ** len(group))
                row.append(PROBE_COST * rows * keys + near * rows * rows / 2)
            cost.append(row)
        value, chosen = _allocate(cost, distance - m + 1)
        if best is None or value < best[0]:
            best = value, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _local_links(batches: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Verified links of sorted buckets: each fingerprint with the least of its component in the bucket."""
    held: list[pd.DataFrame] = []

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        bucket = rows["bucket"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(rows)]])
        a, b = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi - lo == 2:
                if int(fps[lo] ^ fps[lo + 1]).bit_count() <= distance:
                    a.append(fps[lo])
                    b.append(fps[lo + 1])
            elif hi - lo > 2:
                part = np.sort(fps[lo:hi])
                near = np.bitwise_count(part[:, None] ^ part[None, :]) <= distance
                label = np.arange(len(part), dtype=np.int32)
                while True:
                    least = np.where(near, label[None, :], np.int32(len(part))).min(axis=1)
                    least = least[least]
                    if (least == label).all():
                        break
                    label = least
                other = label != np.arange(len(part))
                a += part[label[other]].tolist()
                b += part[other].tolist()
        pairs = np.array([a, b], np.uint64).reshape(2, -1)
        return pd.DataFrame({"a": pairs.min(axis=0).view(np.int64), "b": pairs.max(axis=0).view(np.int64)})

    for batch in batches:
        held.append(batch)
        rows = pd.concat(held, ignore_index=True)
        open_ = rows["bucket"].iloc[-1] if len(rows) else None
        ready = rows["bucket"].to_numpy() != open_
        yield solve(rows[ready])
        held = [rows[~ready]]
    if held:
        yield solve(pd.concat(held, ignore_index=True))


def near_links(fps: DataFrame, distance: int = 2, bucket: int = 2048, sample_rows: int = 8192) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect every pair within ``distance`` bits.

    ``fps`` has one column fp of distinct values. Zero and negative numbers are fingerprints like any other.
    """
    spark = fps.sparkSession
    rows = fps.count()
    if rows < 2:
        return spark.createDataFrame([], "a long, b long")
    share = sample_rows / rows
    sampled = fps.where(uniform(F.col("fp"), F.lit("sample")) < share) if share < 1 else fps
    sample = np.sort(sampled.toArrow()["fp"].to_numpy().astype(np.int64)).view(np.uint64)
    if len(sample) < 2:
        sample = np.array([1, 2], np.uint64)
    np.random.default_rng(SEED).shuffle(sample)
    parts = plan_partitions(sample, rows, distance)

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            for k, (group, limit) in enumerate(parts):
                mask = np.uint64(sum(1 << b for b in group))
                flips = [0]
                for _ in range(limit):
                    flips = sorted({f ^ (1 << b) for f in flips for b in group} | set(flips))
                for flip in flips:
                    key = ((fp & mask) ^ np.uint64(flip)).view(np.int64)
                    yield pd.DataFrame({"part": k, "key": key, "fp": batch["fp"].to_numpy(), "known": _signed(int(mask))})

    # bucket: identity of a set of candidates; known: bits that were used for it, so that a cut uses others
    keyed = fps.mapInPandas(probes, "part int, key long, fp long, known long").select(
        F.xxhash64("part", "key").alias("bucket"), "known", "fp"
    )
    links, level = None, 0
    while True:
        keyed = settled(keyed, f"simhash-keys{level}")
        sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        last = level >= 6
        small = sizes if last else sizes.where(F.col("n") <= bucket)
        met = keyed.join(small.select("bucket"), "bucket").select("bucket", "fp")
        met = met.repartition("bucket").sortWithinPartitions("bucket", "fp")
        found = met.mapInPandas(lambda it: _local_links(it, distance), "a long, b long")
        found = settled(found.distinct(), f"simhash-links{level}")
        links = found if links is None else links.unionByName(found)
        if last:
            break
        large = sizes.where(F.col("n") > bucket).select("bucket")
        if large.isEmpty():
            break
        crowded = keyed.join(large, "bucket")

        def cut(batches: Iterator[pd.DataFrame], level: int = level) -> Iterator[pd.DataFrame]:
            """Keys on thirds of the bits not used so far: a pair within the distance agrees on one of them."""
            for batch in batches:
                for known, group in batch.groupby("known"):
                    free = [b for b in range(BITS) if not int(known) >> b & 1]
                    if not free:
                        continue
                    order = np.random.default_rng([SEED, level]).permutation(free)
                    for k, piece in enumerate(np.array_split(order, distance + 1)):
                        mask = sum(1 << int(b) for b in piece)
                        fp = group["fp"].to_numpy().view(np.uint64)
                        yield pd.DataFrame({
                            "parent": group["bucket"].to_numpy(), "part": k,
                            "key": (fp & np.uint64(mask)).view(np.int64), "fp": group["fp"].to_numpy(),
                            "known": _signed((int(known) & ((1 << BITS) - 1)) | mask),
                        })

        keyed = crowded.mapInPandas(cut, "parent long, part int, key long, fp long, known long").select(
            F.xxhash64("parent", "part", "key").alias("bucket"), "known", "fp"
        )
        level += 1
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; root is the least node of its component. Links need not be unique."""
    spark = links.sparkSession
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = settled(links.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "star-0")
    seen, turn = None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == seen or not state["n"]:
            break
        seen, turn = (state["n"], state["s"]), turn + 1
        # Large star: every larger neighbour of a node goes to the node's least neighbour or itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settled(large.where("u <> v").distinct(), f"star-{turn}a")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = settled(small.where("u <> v").distinct(), f"star-{turn}b")
    if not seen or not state["n"]:
        return spark.createDataFrame([], "node long, root long")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 2, bucket: int = 2048
) -> DataFrame:
    """(key, fingerprint, component_id) for every row; the component is that of the graph of links within ``distance``.

    Null, empty and word-free texts have fingerprint zero and link like any other. Rows that repeat come back as often.
    component_id is the smallest key in the component; null keys take no part in that minimum (null if there is no other).
    """
    prints = settled(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle).alias("fp")), "simhash-prints")
    distinct = settled(prints.groupBy("fp").agg(F.min("key").alias("least")), "simhash-distinct")
    roots = components(near_links(distinct.select("fp"), distance, bucket))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settled(rooted.join(names, "root").select(F.col("fp").alias("_fp"), "component_id"), "simhash-named")
    out = prints.join(named, F.col("fp") == F.col("_fp"))
    return out.select(F.col("key").alias(key), fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, distance: int = 2, bucket: int = 2048
) -> DataFrame:
    """One row of each component: that with the smallest key (null last), of equal ones that with the least hash of the text.

    Slim rows with fingerprints decide; the rows kept become vectors by file and row, which the scan of the documents
    looks up. A row is known by its place, never by its key, which may be null or repeat. All columns are kept.
    """
    docs = stored(docs, "simhash-docs")
    name = lambda c: F.col(f"`{c.replace('`', '``')}`")
    slim = docs.select(
        fingerprint(name(text), shingle).alias("fp"), name(key).alias("key"), F.xxhash64(name(text)).alias("lot"), *identity(docs)
    )
    slim = settled(slim, "simhash-slim")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "lot", "file", "row")
    least = settled(slim.groupBy("fp").agg(F.min(first).alias("first")), "simhash-least")
    linked = components(near_links(least.select("fp"), distance, bucket))
    rooted = least.join(linked, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.file", "first.row", F.lit(1).alias("n"))
    vectors = write_vectors(slim.select("file", "row", F.lit(0).alias("n")).unionByName(kept), "simhash-vectors")
    chosen = docs.select(F.struct(*[name(c) for c in docs.columns]).alias("row"), decided(docs, vectors).alias("kept"))
    return where_computed(chosen, F.col("kept") > 0).select(*[F.col(f"row.`{c.replace('`', '``')}`") for c in docs.columns])
