"""Mixing sources to target weights by pivotal dependent rounding.

A source that is to give r times its words gives each document r copies on average: floor(r) copies are certain, the
fraction is rounded. Two documents with fractional copies meet, and words move at random from one to the other, so that
the expected copies of both and their summed words stay as they are, until one of them has whole copies; the other stays
fractional and meets the next. One document at most stays fractional in each chunk of a source; the chunks' residuals
meet in the next level of a reduction tree, until a source has one, which is rounded by its probability. In a chunk the
largest document meets the next smaller ones as one, then the next does, so that a small one stays fractional: a source's
words differ from its target by about the size of one of its smallest documents, unless one outweighs the others.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm.common import WORD, uniform, where_computed
from fleetwatch.llm.rowvectors import decided, identity, stored, write_vectors
from fleetwatch.plans.ordering import rank_in_group
from fleetwatch.session import settled, work_path

CHUNK = 4096
GROUP = 256
HEAVY = 0.01
EXACT = 1e-9


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """Adds weight and target to a table (source, source_size).

    Sources by code point, null last, take the weights in turn. All words are shared out by weight; a target stops at
    ``most`` times its source's size and the excess is shared again among the others until none is above. The ranks come
    from range partitions with offsets; of the shares only sums reach the driver.
    """
    spark = sources.sparkSession
    path = work_path(spark, "mix-sources")
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(
        F.col("source").asc_nulls_last()
    )
    ordered.withColumn("slice", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    ranked = spark.read.parquet(path)
    counts = ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).orderBy("slice").collect()
    starts, before = [], 0
    for r in counts:
        starts += [F.lit(r["slice"]), F.lit(before)]
        before += r["n"]
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    if not before:
        return ranked.select("source", "source_size", F.lit(0.0).alias("weight"), F.lit(0.0).alias("target"))
    row = F.create_map(*starts)[F.col("slice")] + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    weighed = ranked.select(
        "source", "source_size", F.get(cycle, (row % len(weights)).cast("int")).alias("weight")
    )
    total = weighed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    rate = 0.0
    while True:  # ends: the set of full sources only grows
        full = F.col("weight") * rate >= most * F.col("source_size")
        sums = weighed.agg(
            F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("w"),
        ).first()
        after = (total - sums["full"]) / sums["w"] if sums["w"] else rate
        if after <= rate:
            break
        rate = after
    target = F.least(most * F.col("source_size"), F.col("weight") * rate)
    return weighed.withColumn("target", target.cast("double"))


def _pivot(rows: pd.DataFrame) -> pd.DataFrame:
    """One chunk, largest documents first; each row leaves with whole copies, but for one of the smallest.

    A document meets the next ``GROUP`` smaller ones as one: words move between it and them until it has whole copies or
    they can move no more. Each of them takes part by its distance from whole copies, in the same proportions both ways,
    so that every document's expected copies stay as they are. A document of more than ``HEAVY`` of the chunk's words that
    they can balance on one side only takes that side: the source's words come before its own chance.
    """
    rows = rows.sort_values(["size", "key"], ascending=[False, True], kind="stable", ignore_index=True)
    size, p, u = rows["size"].to_numpy(float), rows["p"].to_numpy(float).copy(), rows["u"].to_numpy()
    near = (p <= EXACT) | (p >= 1 - EXACT)
    p[near] = np.round(p[near])
    open_ = np.flatnonzero(~near)
    sizes, own = size[open_], p[open_]
    heavy = HEAVY * size.sum()
    for k, i in enumerate(open_):
        others, more = slice(k + 1, k + 1 + GROUP), None
        while EXACT < own[k] < 1 - EXACT:
            q = own[others]
            part = np.minimum(q, 1 - q)
            words = float(part @ sizes[others])
            if words <= EXACT * sizes[k]:
                break
            lacks, has = (1 - own[k]) * sizes[k], own[k] * sizes[k]
            up, down = min(lacks, words), min(has, words)
            more = more or random.Random(float(u[i]))
            if sizes[k] > heavy and (up < lacks) != (down < has):  # only one side can be balanced
                move = up if up == lacks else -down
            else:
                move = up if more.random() * (up + down) < down else -down
            own[k] += move / sizes[k]
            q = q - part * (move / words)
            own[others] = np.where(q <= EXACT, 0.0, np.where(q >= 1 - EXACT, 1.0, q))
        if not EXACT < own[k] < 1 - EXACT:
            own[k] = round(own[k])
    p[open_] = own
    rows["p"] = p
    return rows


def mix_copies(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
    weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7,
) -> DataFrame:
    """Whole copies of every document: (doc_id, source, size, source_size, target, copies, taken).

    Null text has size 0; documents of size 0 are taken 0 times, as are all of a source of size 0. Of n rows that repeat
    key, source and size, floor(n p) get one more copy for certain, and the rest of n p is rounded as that of one row.
    Draws come from hashes, so reruns agree.
    """
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(source).cast("string").alias("source"), words_in(text).alias("size"))
    out = copies_of(rows, weights, most, seed)
    return out.withColumnRenamed("key", "doc_id").withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def copies_of(rows: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7) -> DataFrame:
    """``mix_copies`` of rows (key, source, size): adds source_size, target, copies, taken."""
    units = settled(rows.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    sources = settled(sources, "mix-sizes")
    targets = settled(source_targets(sources.select("source", "source_size"), weights, most), "mix-targets")
    shape = targets.join(
        sources.select(F.col("source").alias("_s"), "units"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(
        F.col("source").alias("_source"), "source_size", "target", "units",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"),
    )
    units = units.join(shape, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.when(F.col("size") > 0, F.floor(F.col("ratio") + EXACT)).otherwise(0).cast("long")
    part = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("ratio") - whole)).otherwise(0.0)
    fields = (
        "key string, source string, size long, rows long, source_size long, target double, units long, base long, sure long, "
        "p double, u double, chunk long"
    )
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def dealt(df: DataFrame, left, level: int) -> DataFrame:
        draw = uniform(F.col("key"), F.col("source"), F.col("size"), F.lit(seed), F.lit(level))
        lot = F.xxhash64(F.col("key"), F.col("size"), F.lit(seed), F.lit(-1 - level))
        return df.withColumns({"u": draw, "chunk": F.pmod(lot, F.ceil(left / F.lit(float(CHUNK))).cast("long"))}).select(*names)

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        return _pivot(frame)[names]

    start = units.withColumns({"base": whole, "all": F.col("rows") * part})
    start = start.withColumn("sure", F.floor(F.col("all") + EXACT).cast("long"))
    start = start.withColumn("p", F.greatest(F.lit(0.0), F.col("all") - F.col("sure"))).drop("all")
    open_ = (F.col("p") > EXACT) & (F.col("p") < 1 - EXACT)
    done = start.where(~open_)
    todo = dealt(start.where(open_), F.col("units"), 0)
    largest = sources.agg(F.max("units").alias("n")).first()["n"] or 0
    closed = [done.select(*[n for n in names if n not in ("u", "chunk")])]
    left, level = largest, 0
    while left:
        solved = todo.groupBy("source", "chunk").applyInPandas(step, fields)
        solved = settled(solved, f"mix-level{level}")
        chunks = math.ceil(left / CHUNK)
        last = chunks <= 1
        lot = uniform(F.col("key"), F.col("size"), F.lit(seed), F.lit("last"))
        rest = (lot < F.col("p")).cast("double") if last else F.col("p")
        ended = solved if last else solved.where(~open_)
        closed.append(ended.withColumn("p", F.when(open_, rest).otherwise(F.col("p"))).select(*closed[0].columns))
        if last:
            break
        left, level = chunks, level + 1
        fewer = F.col("units")
        for _ in range(level):
            fewer = F.ceil(fewer / F.lit(float(CHUNK)))
        todo = dealt(solved.where(open_), fewer, level)
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    more = (F.col("sure") + F.round("p").cast("long")).alias("more")  # rows with one more copy
    out = out.select("key", "source", "size", "source_size", "target", "rows", "base", more)
    out = out.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    out = out.withColumn("copies", F.col("base") + (F.col("_row") <= F.col("more")).cast("long"))
    return out.select(
        "key", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
    weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 7,
) -> DataFrame:
    """The documents as the mix takes them: each row as often as it has copies, all its columns kept.

    Slim rows decide: what each row is taken becomes vectors by file and row, which the scan of the documents looks up.
    Of rows that share key, source and size but not their copies those with the least hash of the text come first.
    """
    docs = stored(docs, "mix-docs")
    name = lambda c: F.col(f"`{c.replace('`', '``')}`")
    slim = docs.select(
        name(key).cast("string").alias("key"), name(source).cast("string").alias("source"), words_in(f"`{text}`").alias("size"),
        F.xxhash64(name(text)).alias("lot"), *identity(docs),
    )
    slim = settled(slim, "mix-slim")
    plan = copies_of(slim.select("key", "source", "size"), weights, most, seed)
    plan = plan.groupBy(F.col("key").alias("_key"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(
        F.min("copies").alias("_copies"), (F.sum("copies") - F.count(F.lit(1)) * F.min("copies")).alias("_more")
    )
    plan = settled(plan, "mix-plan")
    same = F.col("key").eqNullSafe(F.col("_key")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    met = slim.join(plan.where("_more = 0"), same).select("file", "row", F.col("_copies").alias("n"))
    uneven = plan.where("_more > 0")
    if not uneven.isEmpty():
        parts = slim.join(uneven, same).select("file", "row", "lot", "_key", "_source", "_size", "_copies", "_more")
        parts = rank_in_group(parts, ["_key", "_source", "_size"], ["lot", "file", "row"], "_rank")
        met = met.unionByName(parts.select("file", "row", (F.col("_copies") + (F.col("_rank") <= F.col("_more")).cast("long")).alias("n")))
    vectors = write_vectors(met, "mix-vectors")
    columns = [name(c) for c in docs.columns]
    counted = docs.select(F.struct(*columns).alias("row"), decided(docs, vectors).alias("copies"))
    copied = where_computed(counted, F.col("copies") > 0)
    copied = copied.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copied.select(*[F.col(f"row.`{c.replace('`', '``')}`") for c in docs.columns])
