"""Approximate largest inner products with a hierarchical k-means tree.

Vectors get one more component, sqrt(M^2 - |x|^2) with the largest norm M, and queries a zero there; the nearest vector is
then the one with the largest inner product. k-means splits a bounded sample again and again into a tree; every vector of
the table goes down to a leaf. A query's leaves come best-bin-first from a priority queue of branches by distance. How
many leaves all queries visit is calibrated: a bounded set of queries is answered exactly, over all rows in blocks, and
visits widen until the wanted share of the true neighbours lies in visited leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwatch.llm.common import uniform
from fleetwatch.session import settled

BRANCHES = 8
ROWS_BLOCK = 4000
QUERIES_BLOCK = 1000


@dataclass
class Tree:
    """centres[i] are the children's centres of node i; children[i] their nodes, or -1 - leaf."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int
    norm: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.norm**2 - (x * x).sum(axis=1))
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf each lifted vector goes down to."""
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))] if self.centres else []
        while work:
            node, rows = work.pop()
            c = self.centres[node]
            child = ((c * c).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
            for k, after in enumerate(self.children[node]):
                part = rows[child == k]
                if len(part):
                    if after < 0:
                        out[part] = -1 - after
                    else:
                        work.append((after, part))
        return out

    def visits(self, query: np.ndarray, most: int, rows: dict[int, int] | None = None, need: int = 0) -> list[int]:
        """The first ``most`` leaves of a lifted query, best bin first; further ones until they hold ``need`` of ``rows``."""
        if not self.centres:
            return [0]
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < need):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                held += rows.get(-1 - node, 0) if rows else 0
                continue
            c = self.centres[node]
            for gap, after in zip(((c - query) ** 2).sum(axis=1).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (gap, after))
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(10):
        near = ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        sizes = np.bincount(near, minlength=k)
        for j in np.flatnonzero(sizes):
            centres[j] = x[near == j].mean(axis=0)
        centres = centres[sizes > 0]
        k = len(centres)
    return centres


def fit_tree(sample: np.ndarray, norm: float, leaf_rows: float, seed: int = 5) -> Tree:
    """Splits the sample until a node has at most ``leaf_rows`` of its rows, or only equal ones."""
    tree = Tree([], [], 0, norm)
    rng = np.random.default_rng(seed)
    x = tree.lift(sample)

    def grow(rows: np.ndarray) -> int:
        if len(rows) > max(leaf_rows, 1):
            c = _kmeans(x[rows], min(BRANCHES, len(rows)), rng)
            if len(c) > 1:
                node = len(tree.centres)
                tree.centres.append(c)
                tree.children.append([])
                near = ((c * c).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
                parts = [rows[near == k] for k in range(len(c))]
                if max(map(len, parts)) < len(rows):
                    tree.children[node] += [grow(p) for p in parts]
                    return node
                tree.centres.pop()
                tree.children.pop()
        tree.leaves += 1
        return -tree.leaves

    if len(x):
        grow(np.arange(len(x)))
    tree.leaves = max(1, tree.leaves)
    return tree


def _best(
    queries: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, open_: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best rows of a block: place of the query, rows, scores. Equal scores: smaller id first.

    ``open_`` says which rows a query looks at (all, if it is left out).

    A matrix product picks; the scores of those picked are summed anew row by row, so equal vectors have equal scores.
    """
    rough = queries @ x.T
    rough[own[:, None] == ids[None, :]] = -np.inf
    if open_ is not None:
        rough[~open_] = -np.inf
    k = min(k, rough.shape[1])
    edge = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
    for i in range(len(queries)):
        rows = np.flatnonzero((rough[i] >= edge[i] - 1e-9 * (1 + abs(edge[i]))) & (rough[i] > -np.inf) if np.isfinite(edge[i])
                              else rough[i] > -np.inf)
        scores = (x[rows] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[rows], -scores))[:k]
        yield i, rows[order], scores[order]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), float) if len(vectors) else np.zeros((0, 1))


def nearest(
    vectors: DataFrame, is_query: str, k: int = 20, key: str = "vec_id", vector: str = "embedding", target_recall: float = 0.97,
    sample_rows: int = 16384, calibration: int = 200, rows_per_leaf: int = 512,
) -> DataFrame:
    """(query_id, rank, key, score): the nearest found of every row for which the expression ``is_query`` holds.

    Bounds: about ``sample_rows`` rows fit the tree, about ``calibration`` queries set the number of visits, the tree has
    at most sample_rows / 4 leaves. Rows with null key, null, empty or zero vectors, null or non-finite components, or a
    length other than the most frequent one (the shorter of equally frequent ones) take no part. A key that
    repeats counts once, with its smallest vector. A table without two rows gives no row.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.where(finite & F.exists(v, lambda e: e != 0)).groupBy("id").agg(F.min("v").alias("v"))
    rows = settled(rows, "ann-rows")
    sizes = rows.groupBy(F.size(v).alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate(v, F.lit(0.0), lambda a, e: a + e * e)).alias("norm")
    ).orderBy(F.col("n").desc(), "width").first()
    if sizes is None or sizes["n"] < 2:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    rows = rows.where(F.size(v) == sizes["width"])
    share = min(1.0, sample_rows / sizes["n"])
    sample = rows.where(uniform(F.col("id"), F.lit("sample")) < share).orderBy("id").select("v").toPandas()
    leaves = max(1, min(sizes["n"] // rows_per_leaf, len(sample) // 4))
    tree = fit_tree(_matrix(sample["v"]), float(np.sqrt(sizes["norm"])), len(sample) / leaves)
    sent = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tree = sent.value
            leaf = tree.leaf_of(tree.lift(_matrix(batch["v"]))) if len(batch) else []
            yield pd.DataFrame({"leaf": leaf, "id": batch["id"], "v": batch["v"]})

    index = settled(rows.mapInPandas(assign, "leaf long, id long, v array<double>"), "ann-index")
    queries = index.select(F.col("id").alias(key), F.col("id"), "v").where(F.expr(is_query)).select("id", "v")
    asked = queries.count()
    if not asked:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    some = queries.where(uniform(F.col("id"), F.lit("calibrate")) < min(1.0, calibration / asked)).orderBy("id").toPandas()
    visits = _calibrated(index, some, tree, k, target_recall)

    # Leaves next to each other in the tree share a group of bounded size; a larger leaf is dealt over several groups.
    groups, first, parts, held, sizes_of = -1, {}, {}, ROWS_BLOCK, {}
    for r in index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).orderBy("leaf").collect():
        sizes_of[r["leaf"]] = r["n"]
        parts[r["leaf"]] = -(-r["n"] // ROWS_BLOCK)
        if held + r["n"] > ROWS_BLOCK:
            groups, held = groups + 1, 0
        first[r["leaf"]] = groups
        groups += parts[r["leaf"]] - 1
        held += r["n"] if parts[r["leaf"]] == 1 else ROWS_BLOCK

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per query and group, with the leaves that the query visits there."""
        tree = sent.value
        for batch in batches:
            out = []
            x = _matrix(batch["v"])
            for i, q in enumerate(np.hstack([x, np.zeros((len(x), 1))]) if len(batch) else []):
                seen: dict[int, list[int]] = {}
                for leaf in tree.visits(q, visits, sizes_of, k + 1):
                    for group in range(first.get(leaf, 0), first.get(leaf, 0) + parts.get(leaf, 0)):
                        seen.setdefault(group, []).append(leaf)
                out += [(g, batch["id"].iat[i], batch["v"].iat[i], np.sort(leaves)) for g, leaves in seen.items()]
            yield pd.DataFrame(out, columns=["grp", "id", "v", "leaves"])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf, id_ = batch["leaf"], batch["id"]
            lot = [first[s] + i % parts[s] for s, i in zip(leaf, id_, strict=True)]
            yield pd.DataFrame({"grp": np.array(lot, np.int64), "leaf": leaf, "id": id_, "v": batch["v"]})

    routed = settled(queries.mapInPandas(route, "grp long, id long, v array<double>, leaves array<long>"), "ann-routed")
    shape = routed.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES_BLOCK).cast("int").alias("blocks"))
    shape = settled(shape, "ann-shape")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    lot = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    dealt = index.mapInPandas(deal, "grp long, leaf long, id long, v array<double>")
    left = dealt.join(shape, "grp").select("grp", every, "leaf", "id", "v").groupBy("grp", "block")
    right = routed.join(shape, "grp").select("grp", lot, "id", "v", "leaves").groupBy("grp", "block")

    def search(part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(part) and len(asked):
            x, ids = _matrix(part["v"]), part["id"].to_numpy()
            kinds, kind = np.unique(part["leaf"].to_numpy(), return_inverse=True)
            visited = np.array([np.isin(kinds, leaves) for leaves in asked["leaves"]])
            own = asked["id"].to_numpy()
            for i, at, scores in _best(_matrix(asked["v"]), own, x, ids, k, visited[:, kind]):
                out.append((np.full(len(at), own[i]), ids[at], scores))
        return pd.DataFrame({n: np.concatenate([o[j] for o in out]) for j, n in enumerate(("query_id", "id", "score"))})

    found = left.cogroup(right).applyInPandas(search, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")


def _calibrated(index: DataFrame, some: pd.DataFrame, tree: Tree, k: int, target: float) -> int:
    """The fewest visits at which the calibration queries have the wanted recall; all leaves if there are no such."""
    if not len(some):
        return tree.leaves
    sent = index.sparkSession.sparkContext.broadcast((_matrix(some["v"]), some["id"].to_numpy()))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, own = sent.value
        for batch in batches:
            ids, leaf = batch["id"].to_numpy(), batch["leaf"].to_numpy()
            for i in range(0, len(batch), ROWS_BLOCK):
                block = slice(i, i + ROWS_BLOCK)
                near = list(_best(queries, own, _matrix(batch["v"][block]), ids[block], k))
                at = np.concatenate([rows for _, rows, _ in near])
                yield pd.DataFrame({
                    "query_id": np.repeat(own, [len(rows) for _, rows, _ in near]), "id": ids[block][at],
                    "leaf": leaf[block][at], "score": np.concatenate([scores for _, _, scores in near]),
                })

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    true = index.mapInPandas(exact, "query_id long, id long, leaf long, score double")
    true = true.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "leaf").toPandas()
    leaves = {q: g.to_numpy() for q, g in true.groupby("query_id")["leaf"]}
    depth = []
    for q, x in zip(some["id"], _matrix(some["v"]), strict=True):
        place = {leaf: i for i, leaf in enumerate(tree.visits(np.append(x, 0.0), tree.leaves))}
        depth += [place.get(leaf, tree.leaves) + 1 for leaf in leaves.get(q, [])]
    if not depth:
        return tree.leaves
    depth.sort()
    return min(tree.leaves, depth[min(len(depth) - 1, int(np.ceil(target * len(depth))) - 1)])
