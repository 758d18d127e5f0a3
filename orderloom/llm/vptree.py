"""Approximate nearest neighbours by inner product, with one vantage-point tree per shard.

Inner product becomes distance by one more coordinate: with M the largest norm of the shard, a
vector x gets sqrt(M^2 - |x|^2) and a query 0, and then |q - x|^2 = |q|^2 + M^2 - 2 q.x. A tree
splits its vectors at the median distance from a vantage point and keeps the least and greatest
distance of either half; a half is left out when its lower bound by the triangle inequality, times
``factor``, exceeds the distance of the k-th found so far. Factor one loses nothing; greater factors
prune more. Single points of a leaf are left out by the plain bound.

Shards are cells of a top tree, whose vantage points come from a sample of SAMPLE vectors, the least
by hash; every vector is placed by them. Queries visit their own cell, then the cells that the
bound found there allows. At most 2 ** LEVELS cells are told apart; larger ones are several shards.

Equal vectors are one point with their least k + 1 ids, as no more can be among k results.
Scores are sums of products in double precision, in the order of the components.
Defined results: rows with a null id, or whose vector is null, empty, zero, or has a null or
non-finite component, take no part; vectors of different lengths never meet; a query id that
repeats is asked once, with the least of its vectors; rows with the query's id are no candidates;
no rows, or no queries, give no rows. Other columns have no effect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import stored

K = 20
FACTOR = 1.0
LEAF = 64
SHARD_ROWS = 8192
QUERY_ROWS = 1024
SAMPLE = 2048
LEVELS = 10


class Tree:
    """Vantage-point tree over distinct vectors; nodes in arrays, leaves as ranges of ``order``.

    Every point keeps its distances to the vantage points above it (``above``), so a leaf leaves out
    single points by the triangle inequality too. ``visited`` counts the pairs of query and point
    whose product was taken.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF, seed: int = 0) -> None:
        norms = (points * points).sum(axis=1)
        self.top = float(norms.max())
        self.points = extended(points, self.top)
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        self.visited = 0
        depth = max(1, int(np.ceil(np.log2(max(2, len(points)) / max(1, leaf)))) + 1)
        self.above = np.zeros((len(points), depth + 1))
        self._split(leaf, np.random.default_rng(seed))

    def _split(self, leaf: int, rng) -> None:
        """Nodes: (start, end) of a leaf, or (vantage, near, far, bounds of both halves)."""
        self.nodes.append((0, len(self.points)))
        todo = [(0, 0, len(self.points), 0)]
        while todo:
            at, start, end, depth = todo.pop()
            if end - start <= leaf:
                continue
            own = self.order[start:end]
            vantage = spread_out(self.points[own], rng)
            far_from = distance(self.points[own], vantage)
            self.above[own, depth] = far_from
            half = len(own) // 2
            by = np.argpartition(far_from, half)
            self.order[start:end] = own[by]
            near, far = far_from[by[:half]], far_from[by[half:]]
            middle, left, right = start + half, len(self.nodes), len(self.nodes) + 1
            bounds = (near.min(), near.max(), far.min(), far.max())
            self.nodes[at] = (vantage, left, right, bounds)
            self.nodes += [(start, middle), (middle, end)]
            todo += [(left, start, middle, depth + 1), (right, middle, end, depth + 1)]

    def search(
        self, queries: np.ndarray, k: int, factor: float, top: float | None = None, within: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs that hold the k nearest points of every query, and some more.

        All queries walk the tree together, each nearer half first for most of them. Squared distances
        count up to ``within``, if given, with the norms made up to ``top`` as the caller's are.
        """
        q = np.column_stack([queries, np.zeros(len(queries))])
        reach = (queries * queries).sum(axis=1) + self.top
        # Rounding of distances and products stays far below this.
        slack = 1e-9 * (1 + reach)
        best = np.full((len(q), k), np.inf)  # squared distances found so far
        if within is not None:
            best = np.minimum(best, (within - (top - self.top))[:, None])
        found_q, found_p = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        todo = [(0, np.arange(len(q)), np.zeros(len(q)), np.zeros((len(q), 0)))]
        while todo:
            at, who, bound, seen = todo.pop()
            kth = best[who, -1]
            on = (bound * factor) ** 2 <= kth + slack[who]
            who, seen = who[on], seen[on]
            if not len(who):
                continue
            node = self.nodes[at]
            if len(node) == 2:
                own = self.order[node[0] : node[1]]
                lower = np.zeros((len(who), len(own)))
                for level in range(seen.shape[1]):
                    np.maximum(lower, np.abs(seen[:, level, None] - self.above[own, level]), out=lower)
                # Point by point the bound is used as it is: no point is lost here.
                near = lower**2 <= (best[who, -1] + slack[who])[:, None]
                self.visited += int(near.sum())
                if near.mean() > 0.2:
                    squared = np.where(near, reach[who, None] - 2 * (q[who] @ self.points[own].T), np.inf)
                else:
                    i, j = np.nonzero(near)
                    squared = np.full(near.shape, np.inf)
                    squared[i, j] = reach[who[i]] - 2 * np.einsum("ij,ij->i", q[who[i]], self.points[own[j]])
                merged = np.sort(np.concatenate([best[who], squared], axis=1), axis=1)[:, :k]
                best[who] = merged
                i, j = np.nonzero(squared <= merged[:, -1:] + slack[who, None])
                found_q.append(who[i])
                found_p.append(own[j])
                continue
            vantage, left, right, (near_min, near_max, far_min, far_max) = node
            d = distance(q[who], vantage)
            seen = np.column_stack([seen, d])
            inner = np.maximum(0, np.maximum(d - near_max, near_min - d))
            outer = np.maximum(0, np.maximum(d - far_max, far_min - d))
            halves = [(right, who, outer, seen), (left, who, inner, seen)]
            if np.mean(inner <= outer) < 0.5:
                halves.reverse()
            todo += halves
        return np.concatenate(found_q), np.concatenate(found_p)


def extended(points: np.ndarray, top: float) -> np.ndarray:
    """Points with the coordinate that makes up their squared norms to ``top``."""
    norms = (points * points).sum(axis=1)
    return np.column_stack([points, np.sqrt(np.maximum(top - norms, 0))])


def distance(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = points - to
    return np.sqrt((apart * apart).sum(axis=1))


def spread_out(points: np.ndarray, rng) -> np.ndarray:
    """Of some points, the one from which distances to some others differ most."""
    some = points[rng.choice(len(points), min(len(points), 64), replace=False)]
    tried = points[rng.choice(len(points), min(len(points), 8), replace=False)]
    return tried[int(np.argmax([distance(some, t).std() for t in tried]))]


class Top:
    """The upper levels of a vantage-point tree: complete, fitted on a sample, its leaves are cells.

    Cells are told apart by distances to at most ``levels`` vantage points; a cell's least and greatest
    distance to each of them, over all its rows, bound how near it can come to a query.
    """

    def __init__(self, sample: np.ndarray, top: float, levels: int, seed: int = 1) -> None:
        self.top, self.levels = top, levels
        points, rng = extended(sample, top), np.random.default_rng(seed)
        self.vantage = np.zeros((2**levels - 1, points.shape[1]))
        self.middle = np.zeros(2**levels - 1)
        groups = [points]
        for at in range(2**levels - 1):
            own = groups[at]
            if len(own):
                self.vantage[at] = spread_out(own, rng)
                d = distance(own, self.vantage[at])
                self.middle[at] = np.median(d)
                groups += [own[d <= self.middle[at]], own[d > self.middle[at]]]
            else:
                groups += [own, own]

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each point (with its further coordinate), and its distances on the way."""
        at = np.zeros(len(points), np.int64)
        seen = np.zeros((len(points), self.levels))
        for level in range(self.levels):
            apart = points - self.vantage[at]
            seen[:, level] = np.sqrt((apart * apart).sum(axis=1))
            at = 2 * at + 1 + (seen[:, level] > self.middle[at])
        return at - (2**self.levels - 1), seen

    def bounds(self, queries: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of queries to cells, given the cells' ranges by level."""
        out = np.zeros((len(queries), len(cells)))
        d = np.stack([distance(queries, v) for v in self.vantage], axis=1) if len(self.vantage) else None
        for level in range(self.levels):
            node = (cells + 2**self.levels >> self.levels - level) - 1
            np.maximum(out, low[:, level] - d[:, node], out=out)
            np.maximum(out, d[:, node] - high[:, level], out=out)
        return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed in the order of the components."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def _found(own: pd.DataFrame, asked: pd.DataFrame, k: int, factor: float, top: float) -> Iterator[pd.DataFrame]:
    if not len(own) or not len(asked):
        return
    own = own.sort_values("h")
    points = np.stack(own["v"].to_numpy()).astype(np.float64)
    ids = np.concatenate([np.asarray(i, np.int64) for i in own["ids"]])
    many = own["ids"].map(len).to_numpy(np.int64)
    starts = np.cumsum(many) - many
    tree = Tree(points)
    asked_v = np.stack(asked["v"].to_numpy()).astype(np.float64)
    asked_id, within = asked["id"].to_numpy(np.int64), asked["within"].to_numpy(np.float64)
    for at in range(0, len(asked), QUERY_ROWS):
        some_v, some_id = asked_v[at : at + QUERY_ROWS], asked_id[at : at + QUERY_ROWS]
        q, p = tree.search(some_v, min(k + 1, len(points)), factor, top, within[at : at + QUERY_ROWS])
        score = dots(some_v[q], points[p])
        # Every distinct vector stands for its least k + 1 ids.
        rows = np.repeat(np.arange(len(p)), many[p])
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(many[p]) - many[p], many[p])
        out = pd.DataFrame({"query_id": some_id[q[rows]], "vec_id": ids[starts[p][rows] + nth], "score": score[rows]})
        out = out[out["query_id"] != out["vec_id"]]
        out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        yield out.groupby("query_id").head(k)


_FOUND = "query_id long, vec_id long, score double"


def _searched(points: DataFrame, visits: DataFrame, k: int, factor: float, top: float) -> DataFrame:
    """The best of each shard for the queries that visit it; a task holds a shard and a block of queries.

    ``points``: shard, v, ids, h. ``visits``: shard, block, id, v, within.
    """

    def run(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = pd.concat([none, *_found(own, asked, k, factor, top)])
        return found.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    asked = visits.select(F.col("shard").alias("place"), F.col("block").alias("by")).distinct()
    own = points.join(asked, F.col("shard") == F.col("place")).groupBy("place", "by")
    return own.cogroup(visits.groupBy("shard", "block")).applyInPandas(run, _FOUND)


def _placed(df: DataFrame, tree: Top, extra: bool) -> DataFrame:
    """``df`` with the cell of its vectors ``v`` and their distances on the way; ``extra`` for points."""
    sent = df.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = np.stack(batch["v"].to_numpy()).astype(np.float64)
            own = extended(vectors, sent.value.top) if extra else np.column_stack([vectors, np.zeros(len(vectors))])
            cell, seen = sent.value.place(own)
            yield batch.assign(cell=cell, seen=list(seen))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, cell long, seen array<double>")


def routes(queries: DataFrame, tree: Top, cells: pd.DataFrame, factor: float) -> DataFrame:
    """The cells that each query (id, v, cell, within) must visit beside its own, by their bounds."""
    sent = queries.sparkSession.sparkContext.broadcast((tree, cells))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, cells = sent.value
        number = cells["cell"].to_numpy(np.int64)
        low, high = (np.stack(cells[c].to_numpy()).reshape(len(cells), -1) for c in ("low", "high"))
        for batch in batches:
            for at in range(0, len(batch), QUERY_ROWS):
                some = batch.iloc[at : at + QUERY_ROWS]
                vectors = np.stack(some["v"].to_numpy()).astype(np.float64)
                reach = (vectors * vectors).sum(axis=1) + tree.top
                q = np.column_stack([vectors, np.zeros(len(vectors))])
                near = tree.bounds(q, number, low, high) * factor
                on = near**2 <= (some["within"].to_numpy() + 1e-9 * (1 + reach))[:, None]
                on &= number[None, :] != some["cell"].to_numpy()[:, None]
                yield some.drop(columns="cell").assign(cell=[number[o] for o in on])

    return queries.mapInPandas(run, "id long, v array<double>, within double, cell array<long>").withColumn(
        "cell", F.explode("cell")
    )


def _of_dimension(
    rows: DataFrame, k: int, factor: float, shard_rows: int, size: int, asking: int, top: float
) -> DataFrame:
    """The best found for all queries among the stored ``rows`` (id, v, q) of one dimension."""
    spark = rows.sparkSession
    # Of equal vectors the least k + 1 ids; Spark limits each task's rows before they are shuffled.
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.select("id", "v").withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    points = least.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("h", F.xxhash64("v"))
    queries = rows.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    levels = min(LEVELS, max(0, int(np.ceil(np.log2(max(1, size / shard_rows))))))
    blocks = max(1, -(-asking // (8 * QUERY_ROWS)))
    if levels:
        points = stored(points, "points")
        sample = points.orderBy("h").limit(SAMPLE).select("v").toPandas()["v"].to_numpy()
        tree = Top(np.stack(sample).astype(np.float64), top, levels)
    else:
        tree = Top(np.zeros((1, 1)), top, 0)
    placed = stored(_placed(points, tree, extra=True), "placed")
    ranges = [F.array(*[f(F.get("seen", i)) for i in range(levels)]).cast("array<double>") for f in (F.min, F.max)]
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), ranges[0].alias("low"), ranges[1].alias("high"))
    cells = cells.toPandas()  # at most 2 ** LEVELS rows
    # A cell larger than a shard is dealt over several.
    parts = {int(c): max(1, -(-int(n) // shard_rows)) for c, n in zip(cells["cell"], cells["n"])}
    split = F.broadcast(spark.createDataFrame(list(parts.items()) or [(0, 1)], "cell long, parts int"))
    part = F.pmod(F.col("h"), F.col("parts"))
    points = placed.join(split, "cell").select(F.concat_ws(":", "cell", part).alias("shard"), "v", "ids", "h")
    block = F.pmod(F.xxhash64(F.lit("block"), F.col("id")), F.lit(blocks)).cast("int")

    def visits(asked: DataFrame) -> DataFrame:
        every = asked.join(split, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return every.select(F.concat_ws(":", "cell", "part").alias("shard"), block.alias("block"), "id", "v", "within")

    # A query's own cell is that of its vector as a point; there it finds its first bound.
    homed = _placed(queries, tree, extra=True).select("id", "v", "cell")
    homed = stored(homed.withColumn("within", F.lit(float("inf"))), "queries")
    first = _searched(points, visits(homed), k, factor, top)
    if not levels:
        return first
    first = stored(first, "first_found")
    ranked = first.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
    kth = ranked.filter(F.col("n") == k).select(F.col("query_id").alias("id"), "score")
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    within = F.coalesce(norm + F.lit(top) - 2 * F.col("score"), F.lit(float("inf")))
    bounded = homed.join(kth, "id", "left").select("id", "v", within.alias("within"), "cell")
    rest = stored(routes(bounded, tree, cells, factor).join(homed.select("id", "v"), ["id", "v"]), "routes")
    return first.unionByName(_searched(points, visits(rest), k, factor, top))


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows of each row for which ``queries`` holds: query_id, rank, vec_id, score.

    Every row is in a cell of the top tree, and a cell in one or more shards. A query searches its own
    cell first; the distance of the k-th found there bounds which other cells it visits.
    """
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(vector)).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        F.size(vector).alias("dim"),
        F.coalesce(queries, F.lit(False)).alias("q"),
    )
    rows = stored(rows, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    sizes = rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("asking"), F.max(norm).alias("top")
    )
    found = vectors.sparkSession.createDataFrame([], _FOUND)
    for r in sizes.collect():
        same = rows.filter(F.col("dim") == r["dim"]).select("id", "v", "q")
        found = found.unionByName(_of_dimension(same, k, factor, shard_rows, r["n"], r["asking"], r["top"]))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
