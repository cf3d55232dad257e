"""Shards by jump consistent hashing.

The shard of a row follows from its key and the number of shards alone: no ring table is kept, and
when a shard is appended, the only rows that move go into the new shard (about one in n + 1).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens.llm.common import in_order, own, table
from hydrolens.sources.folders import RunFolder

# Fixed values of the published algorithm: multiplier of its linear congruential generator.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key; all keys jump together until each has passed the last shard."""
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), np.int64)
    going = np.arange(len(key))
    following = np.zeros(len(key), np.int64)
    while len(going):
        shard[going] = following
        with np.errstate(over="ignore"):
            key = key * np.uint64(MULTIPLIER) + np.uint64(1)
        following = ((shard[going] + 1) * (2.0**31 / ((key >> np.uint64(33)) + np.uint64(1)))).astype(np.int64)
        still = following < shards
        key, going, following = key[still], going[still], following[still]
    return shard


def shard_of(shards: int):
    """Column function: 64-bit key to shard."""

    @F.pandas_udf(T.IntegerType())
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return of


def assign(df: DataFrame, key: str, shards: int, run: RunFolder) -> DataFrame:
    """Adds `shard`, `grown_shard` (with one shard more) and `slot` (place in the shard, from 0, in
    the order of the key).

    A null key is a key of its own. Rows with equal keys share a shard and take neighbouring slots.
    An empty table gives an empty table. Columns of the input with these names are replaced; others
    may have any name.
    """
    rest = df.drop("shard", "grown_shard", "slot")
    code = F.xxhash64(rest[key])
    placed = rest.select(*own(rest), shard_of(shards)(code).alias("shard"), shard_of(shards + 1)(code).alias("grown_shard"))
    return in_order(placed, [key], run, "shards", ["shard"])


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Writes whole rows in one folder per shard. Executors split a shard over several files as
    its size asks for. A column `shard` of the input is replaced."""
    placed = df.withColumn("shard", shard_of(shards)(F.xxhash64(df[key])))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def document_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    """All documents in shards 0 to 15 by doc_id (law `key`)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    described = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = assign(described, "doc_id", shards, RunFolder(spark))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
