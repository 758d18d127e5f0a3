"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import attach, stored

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """Count and two checksums of the edge set."""
    h = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)),
        F.sum(F.shiftright(h, 32)),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))),
    ).first()
    return row[0], row[1] or 0, row[2] or 0


def _star(pairs: DataFrame, total: int, small: bool) -> DataFrame:
    """Point the neighbours of every node ``u`` at the least of them and ``u``."""
    least = stored(
        pairs.groupBy("u").agg(
            F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")
        ),
        "star",
    )
    if not small:
        pairs = pairs.filter("v > u")
    joined = attach(pairs, least, "u", "n", total)
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root, n_links) of every node of ``links`` (columns u, v; longs, undirected).

    ``root`` is the least node reachable. A round contracts distances by about half, so long
    chains take a logarithmic number of rounds; each round is stored, never held by lineage.
    Empty links give no rows; loops and repeated links change nothing.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    edges = stored(links.filter("u <> v").select(u.alias("u"), v.alias("v")).distinct(), "edges")
    before = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = stored(_star(edges.unionByName(back), 2 * before[0], small=False), "large_star")
        edges = stored(_star(large, before[0], small=True), "small_star")
        after = _mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return children.unionByName(roots)
