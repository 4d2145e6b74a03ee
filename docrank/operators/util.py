"""Small helpers shared by the operators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from docrank.session import scratch_path, write_parquet

# Bytes up to which a side of a join is broadcast.
MAX_BROADCAST_BYTES = 128 << 20
# A key with more than this share of the rows of a join's large side is split.
HEAVY_SHARE = 1 / 5000
# Rows that one task makes and sums, and fewer for the sake of using every core.
SLICE_ROWS = 2_000_000
LEAST_SLICE_ROWS = 1 << 16


def size_bytes(df: DataFrame) -> int:
    """Bytes of the rows as Spark holds them, from one partial aggregate: 24 a row,
    8 a column, and the length of strings."""
    fixed = 24 + 8 * len(df.columns)
    text = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    total = sum(text, F.lit(fixed).cast("long"))
    return df.agg(F.sum(total).alias("n")).first()["n"] or 0


def fits(df: DataFrame, most: int | None = None) -> bool:
    """True when ``df`` is small enough to broadcast."""
    return size_bytes(df) <= (MAX_BROADCAST_BYTES if most is None else most)


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df.hint("shuffle_merge")


def split_join(large: DataFrame, small: DataFrame, sizes: DataFrame, key: str, count: str, spread_by: str) -> DataFrame:
    """``large`` joined with ``small`` on ``key`` where neither may be broadcast.

    ``sizes``: one row per key with its rows in ``large`` as column ``count``. Keys
    with more than ``HEAVY_SHARE`` of the rows (at most 1 / HEAVY_SHARE of them, so
    their list is broadcast) are split: the rows of ``large`` by the hash of
    ``spread_by``, the rows of ``small`` repeated as often.
    """
    limit = max(1.0, (sizes.agg(F.sum(count).alias("n")).first()["n"] or 0) * HEAVY_SHARE)
    parts = F.least(F.ceil(F.col(count) / F.lit(limit)), F.lit(1000)).cast("int")
    heavy = F.broadcast(sizes.where(F.col(count) > F.lit(limit)).select(key, parts.alias("_parts")))
    n = F.coalesce("_parts", F.lit(1))
    left = large.join(heavy, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread_by), n).cast("int")).drop("_parts")
    right = small.join(heavy, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts")
    return left.join(right.hint("shuffle_merge"), [key, "_part"]).drop("_part")


def dictionary_join(rows: DataFrame, terms: DataFrame, key: str, count: str, spread_by: str) -> DataFrame:
    """``rows`` joined with ``terms`` on ``key``, where ``terms`` may be too large to broadcast whole.

    ``terms``: one row per key, with its rows in ``rows`` as column ``count``. The most frequent keys, as many as
    fit, are broadcast, so that nearly all rows stay where they are; only rows of the rare keys are shuffled.
    """
    # Bytes of the keys by the binary logarithm of their count: a few dozen rows.
    level = F.floor(F.log2(F.col(count).cast("double")))
    text = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in terms.schema if isinstance(f.dataType, (StringType, BinaryType))]
    size = sum(text, F.lit(24 + 8 * len(terms.columns)).cast("long"))
    least = None
    taken = 0
    for r in sorted(terms.groupBy(level.alias("level")).agg(F.sum(size).alias("bytes")).collect(), reverse=True):
        taken += r["bytes"]
        if taken > MAX_BROADCAST_BYTES:
            break
        least = 2 ** r["level"]
    if least is None:
        return split_join(rows, terms, terms.select(key, count), key, count, spread_by)
    frequent = F.broadcast(terms.where(F.col(count) >= least))
    near = rows.join(frequent, key)
    if least <= 1:
        return near
    rare = terms.where(F.col(count) < least)
    far = split_join(rows.join(frequent, key, "left_anti"), rare, rare.select(key, count), key, count, spread_by)
    return near.unionByName(far)


def written(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """``df`` written to a fresh folder on the shared scratch file system and read again, and the folder."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    write_parquet(df, path, **options)
    return spark.read.schema(df.schema).parquet(path), path


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def slices(spark: SparkSession, rows: float) -> int:
    """Tasks to deal ``rows`` intermediate rows to, so that none holds more than about ``SLICE_ROWS``."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, math.ceil(rows / SLICE_ROWS), min(cores, math.ceil(rows / LEAST_SLICE_ROWS)))


def require_positive_k(k: int) -> None:
    if not isinstance(k, int) or isinstance(k, bool) or k <= 0:
        raise ValueError(f"k must be a positive integer, got {k!r}")
