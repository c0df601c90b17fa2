"""Exact ranks and running sums over a whole table without a one-task window.

Both work in two phases: rows fall into many ordered buckets, the small table of bucket totals is
summed up, and only inside a bucket are rows sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.rows import explode_values
from corpusmill.sources.staging import stage

# Leading hex digits of the hash that name a bucket: 16**4 = 65,536 buckets per class.
HASH_DIGITS = 4


def hash_key(id_col: str, seed: int = 42) -> Column:
    """Pseudo-random but repeatable order of the rows: a hash of key and seed."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _bucket_offsets(
    totals: DataFrame, parts: Sequence[str], bucket: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Sum of all earlier buckets. ``totals`` has one row per bucket, so one task is enough."""
    w = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    w = w.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_before_{s}") for s in sums]
    return totals.select(*parts, *bucket, *before)


def _two_phase(
    df: DataFrame,
    parts: Sequence[str],
    bucket: Sequence[str],
    order: Sequence[Column],
    values: dict[str, Column],
) -> DataFrame:
    """Running sums of ``values`` in the order (bucket, order) within ``parts``."""
    keys = [*parts, *bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    offsets = _bucket_offsets(totals, parts, bucket, list(values))
    # The join asks for the partitioning that the window has already made, so it adds no shuffle
    # of the rows.
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = df.withColumns({f"_in_{n}": F.sum(v).over(w) for n, v in values.items()})
    joined = inside.join(offsets, keys)
    helper = [f"_in_{n}" for n in values] + [f"_before_{n}" for n in values]
    return joined.withColumns(
        {n: F.col(f"_in_{n}") + F.col(f"_before_{n}") for n in values}
    ).drop(*helper)


def range_bucket(df: DataFrame, key: str, buckets: int | None = None, out: str = "_bucket") -> DataFrame:
    """Equal-height range buckets of a numeric key.

    Split points come from one approximate-quantile pass. Keys should be distinct: repeats of one
    value share a bucket, so aggregate them first.
    """
    n = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / n for i in range(1, n)]
    points = sorted(set(df.stat.approxQuantile(key, probs, 1 / (4 * n)))) if n > 1 else []
    splits = [-float("inf"), *points, float("inf")]
    as_double = f"{out}_input"
    bucketizer = Bucketizer(splits=splits, inputCol=as_double, outputCol=out, handleInvalid="keep")
    return bucketizer.transform(df.withColumn(as_double, F.col(key).cast("double"))).drop(as_double)


def running_sums(
    df: DataFrame,
    key: str,
    values: dict[str, Column],
    lead: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``values`` in the order (lead, key) over the whole table.

    ``key`` is numeric; (lead, key) identifies a row.
    """
    bucketed = range_bucket(df, key, buckets)
    order = F.col(key)
    if descending:
        bucketed = bucketed.withColumn("_bucket", -F.col("_bucket"))
        order = F.col(key).desc()
    return _two_phase(bucketed, [], [*lead, "_bucket"], [order], values).drop("_bucket")


def assign_row_key(
    df: DataFrame, order_by: str, out: str = "unique_id", lead: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Contiguous key 0..n-1 in the order of (lead, order_by), which must be distinct."""
    ranked = running_sums(df, order_by, {"_rank": F.lit(1).cast("long")}, lead, buckets=buckets)
    return ranked.withColumn(out, F.col("_rank") - 1).drop("_rank")


def text_bucket(df: DataFrame, key: str, out: str = "_bucket") -> DataFrame:
    """A stage table with range buckets of a distinct text: Spark samples the split points, so long common beginnings do no harm.

    The bucket is the number of the partition, which rises with the key also where small partitions are put together.
    """
    return stage(df.repartitionByRange(F.col(key)).withColumn(out, F.spark_partition_id()), "text-bucket")


def text_rank(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rank 1..n of each row in the order of a distinct text."""
    return _two_phase(text_bucket(df, key), [], ["_bucket"], [F.col(key)], {out: F.lit(1).cast("long")}).drop("_bucket")


def hash_rank(
    df: DataFrame, id_col: str, by: Sequence[str] = (), seed: int = 42, out: str = "hash_rank",
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Rank 1..n of each row in hash order, per class of ``by`` if given."""
    keyed = df.withColumn("_key", hash_key(id_col, seed))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, digits))
    ranked = _two_phase(keyed, list(by), ["_bucket"], [F.col("_key"), F.col(id_col)],
                        {out: F.lit(1).cast("long")})
    return ranked.drop("_key", "_bucket")


def hash_cuts(
    df: DataFrame, id_col: str, targets: Sequence[tuple], by: str | None = None, seed: int = 42,
    digits: int = HASH_DIGITS,
) -> list:
    """Rows of given ranks in hash order: (by, cut, cut_key, cut_id), as a short list.

    ``targets`` are a few tuples (class, cut number, rank); the class is ignored without ``by``.
    A histogram of the hash finds the bucket of each rank, then only that bucket is sorted.
    Callers compare the hash with the cut, so a split of the wide table is a filter without a
    shuffle.
    """
    parts = [by] if by else []
    narrow = df.select(*parts, F.col(id_col).alias("cut_id"), hash_key(id_col, seed).alias("cut_key"))
    narrow = narrow.withColumn("_bucket", F.substring("cut_key", 1, digits))
    totals = narrow.groupBy(*parts, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    edges = _bucket_offsets(totals, parts, ["_bucket"], ["_n"]).join(totals, [*parts, "_bucket"])
    wanted = F.array(*[
        F.struct(F.lit(c if by else 0).alias("class"), F.lit(cut).alias("cut"), F.lit(rank).cast("long").alias("rank"))
        for c, cut, rank in targets
    ])

    def falls_here(t: Column) -> Column:
        after = t["rank"] - F.col("_before__n")
        inside = (after >= 1) & (after <= F.col("_n"))
        return inside & (t["class"] == F.col(by)) if by else inside

    hit = explode_values(edges, [*parts, "_bucket", "_before__n"], F.filter(wanted, falls_here), "_t")
    hit = hit.select(
        *parts, "_bucket", F.col("_t.cut").alias("cut"), (F.col("_t.rank") - F.col("_before__n")).alias("_residual")
    )
    # One row of ``hit`` per target, so its size does not grow with the data.
    w = Window.partitionBy(*parts, "cut").orderBy("cut_key", "cut_id")
    found = narrow.join(F.broadcast(hit), [*parts, "_bucket"]).withColumn("_rn", F.row_number().over(w))
    return found.where(F.col("_rn") == F.col("_residual")).select(*parts, "cut", "cut_key", "cut_id").collect()


def at_or_before(id_col: str, cut, seed: int = 42) -> Column:
    """True for rows up to and including the cut row in hash order."""
    key = hash_key(id_col, seed)
    return (key < F.lit(cut["cut_key"])) | (
        (key == F.lit(cut["cut_key"])) & (F.col(id_col) <= F.lit(cut["cut_id"]))
    )
