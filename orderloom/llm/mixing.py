"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source with target share w of the output and size s has the repetition rate
``w * total / s``. Each document's count is the inverse of the Poisson distribution with that
mean at a number in [0, 1) hashed from seed and id: a rerun gives the same counts, and no state
is kept. Copies are dealt to partitions and ordered by a hash of id and copy number.

Defined results: the size of a row is its text's characters plus one (null text: none), so an
empty source has a rate too; a null source is a source of its own; a null id hashes as an empty
one; rows with equal ids have equal counts, and repeated rows are replicated each. However small
its weight, a source keeps it. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import attach, fresh, stored

ALPHA = 0.5
SEED = 42
# A mean above this is the sum of equal smaller ones, so that exp(-mean) stays normal.
MEAN = 32.0
# Up to so many sources are broadcast; more are joined by salted shuffle.
SMALL = 20_000


def _number(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_key(source: str) -> Column:
    """A non-null key; a null source differs from an empty one."""
    return F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source)))


def rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = ALPHA,
    total: float = 1.0,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per source: key, n, size, weight (share of the output) and rate (copies of a row).

    ``weights`` maps sources to weights; those not named get none. Without it a source weighs
    its size to the power ``alpha``. ``total`` is the output's size as a multiple of the input's.
    """
    size = F.length(F.coalesce(F.col(text), F.lit(""))) + 1
    sums = docs.select(source_key(source).alias("key"), size.alias("s")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("s").alias("size")
    )
    if weights is None:
        weighed = sums.withColumn("w", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(f"+{k}", float(v)) for k, v in weights.items()], "key string, w double"
        )
        weighed = sums.join(given, "key", "left").fillna(0.0, ["w"])
    weighed = stored(weighed, "weights")
    all_w, all_size = weighed.agg(F.sum("w"), F.sum("size")).first()
    share = F.col("w") / F.lit(all_w) if all_w else F.lit(0.0)
    return weighed.select(
        "key", "n", "size", share.alias("weight"),
        (share * F.lit(float(all_size or 0) * total) / F.col("size")).alias("rate"),
    )


def _cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... of a Poisson variable, until the rest is below 2**-52."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda acc: acc["c"])


def poisson_mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = ALPHA,
    total: float = 1.0,
    seed: int = SEED,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    copy: str = "copy",
    order: str = "shuffle_key",
) -> DataFrame:
    """Rows of ``docs`` replicated to the target weights and shuffled globally.

    Adds ``copy`` (from 1) and ``order`` (the hash that orders the output; partitions are dealt
    by it and sorted). Input columns of these names are replaced.
    """
    docs = docs.drop(copy, order)
    key, parts, number = fresh(docs, "_key"), fresh(docs, "_parts"), fresh(docs, "_n")
    per_source = rates(docs, weights, alpha, total, source, text)
    pieces = F.ceil(F.col("rate") / MEAN).cast("int")
    per_source = per_source.select(
        F.col("key").alias(key), F.col("n").alias(number),
        F.struct(pieces.alias("m"), _cumulative(F.col("rate") / F.greatest(pieces, F.lit(1))).alias("c")).alias(parts),
    ).filter(pieces > 0)
    per_source = stored(per_source, "rates")
    keyed = docs.withColumn(key, source_key(source))
    if per_source.count() <= SMALL:
        joined = keyed.join(F.broadcast(per_source.drop(number)), key)
    else:
        joined = attach(keyed, per_source, key, number, docs.count())
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))

    def count(j: Column) -> Column:
        u = _number(F.lit(f"poisson|{seed}"), name, j.cast("string"))
        return F.size(F.filter(F.col(f"{parts}.c"), lambda c: c <= u))

    copies = F.aggregate(
        F.sequence(F.lit(1), F.col(f"{parts}.m")), F.lit(0), lambda acc, j: acc + count(j)
    )
    counted = joined.withColumn(key, copies).filter(F.col(key) > 0)
    rows = counted.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(key))).alias(copy))
    place = F.md5(F.concat_ws("|", F.lit(f"order|{seed}"), name, F.col(copy).cast("string")).cast("binary"))
    # Rows of one id have one place; the task number deals out even those.
    dealt = rows.withColumn(order, place).repartition(F.col(order), F.spark_partition_id() % 64)
    return dealt.sortWithinPartitions(order)
