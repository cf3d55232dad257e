"""Exact quantiles per group without holding a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Mapping[str, float],
    bucket_width: float,
) -> DataFrame:
    """Linearly interpolated quantiles of a value whose range is bounded.

    Equal values are counted first, so a value that fills a third of a group becomes one row.
    Bucket counts then tell which buckets hold the wanted ranks (the number of buckets per
    group is range / width, whatever the number of rows), and only the values of those
    buckets are ranked.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", F.floor(F.col(value) / bucket_width))
    )
    in_group = Window.partitionBy(*keys)
    running = in_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        counted.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("n"))
        .withColumns(
            {"end": F.sum("n").over(running), "total": F.sum("n").over(in_group)}
        )
        .withColumn("start", F.col("end") - F.col("n"))
    )

    def wanted(name: str, fraction: float) -> list[Column]:
        position = (F.col("total") - 1) * F.lit(float(fraction))
        return [
            F.struct(
                F.lit(name).alias("name"),
                F.lit(side).alias("side"),
                rounding(position).cast("bigint").alias("rank"),
                (position - F.floor(position)).alias("weight"),
            )
            for side, rounding in (("low", F.floor), ("high", F.ceil))
        ]

    ranks = F.array(*[rank for name, f in fractions.items() for rank in wanted(name, f)])
    targets = buckets.select(*keys, "bucket", "start", "end", "total", F.inline(ranks)).filter(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("end"))
    )
    in_bucket = Window.partitionBy(*keys, "bucket").orderBy(value)
    ranked = counted.join(
        targets.select(*keys, "bucket").distinct(), [*keys, "bucket"], "left_semi"
    ).withColumn("through", F.sum("n").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    offset = F.col("rank") - F.col("start")
    hits = targets.join(ranked, [*keys, "bucket"]).filter(
        (offset >= F.col("through") - F.col("n")) & (offset < F.col("through"))
    )

    def pick(column: str, name: str, side: str) -> Column:
        return F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col(column)))

    return hits.groupBy(*keys).agg(
        F.max("total").alias("points"),
        *[
            (
                pick(value, name, "low")
                + (pick(value, name, "high") - pick(value, name, "low")) * pick("weight", name, "low")
            ).alias(name)
            for name in fractions
        ],
    )
