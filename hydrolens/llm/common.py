"""What several operators share: tables, sizes, numbering in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.sources.folders import RunFolder

# A run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A side of a join is broadcast only when a count shows that it has at most so many rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def unused(df: DataFrame, name: str) -> str:
    """A column name like the given one that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own(df: DataFrame, *without: str) -> list[Column]:
    """The columns of a frame, whatever they are called."""
    return [df[f"`{c}`"] for c in df.columns if c not in without]


def words(text: Column, pattern: str = WORD) -> Column:
    """The matches of the pattern, in order; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), F.lit(1))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a count of the stored frame allows it, else left to be shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def in_order(
    df: DataFrame, order: list[str], run: RunFolder, name: str, group: list[str] | None = None
) -> DataFrame:
    """Adds `slot`, the gapless number of each row from 0 in the given order, per group. The frame has no
    such column yet; the names of its columns are free otherwise.

    Rows are dealt by range and sorted, so no group has to fit in one task: a row's number is its
    place in its own range plus the rows of the same group in earlier ranges. Only the counts per
    range and group meet in a window. The sorted rows are stored, so a lost executor cannot
    change places that were already counted.
    """
    group = group or []
    place, part = unused(df, "_place"), unused(df, "_range")
    dealt = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    stored = run.keep(dealt.withColumn(place, F.monotonically_increasing_id()), name)
    stored = stored.withColumn(part, F.shiftright(place, 33))
    first, n, earlier = unused(stored, "_first"), unused(stored, "_n"), unused(stored, "_before")
    counts = stored.groupBy(part, *group).agg(F.min(place).alias(first), F.count("*").alias(n))
    before = Window.partitionBy(*group).orderBy(part)
    offsets = run.keep(counts.withColumn(earlier, F.sum(n).over(before) - F.col(n)).drop(n), f"{name}_offsets")
    same = F.lit(True)
    for key in [part, *group]:
        same = same & stored[key].eqNullSafe(offsets[key])
    return stored.join(small(offsets), same, "inner").select(
        *own(stored, place, part), (offsets[earlier] + stored[place] - offsets[first]).alias("slot")
    )


def bucketed(df: DataFrame, column: str, run: RunFolder, name: str) -> DataFrame:
    """Stored in buckets of the column, one per shuffle partition: grouping by the column, or meeting
    another frame by it, then leaves these rows where they are."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table_name = f"{name}_{run.path.rsplit('-', 1)[1]}"
    df.write.bucketBy(buckets, column).option("path", f"{run.path}/{name}").saveAsTable(table_name)
    return spark.table(table_name)
