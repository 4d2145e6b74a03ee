"""Written intermediates and row keys shared by the operators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrank.session import scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    Cuts lineage: what follows survives lost executors without running the
    job again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: str):
    """True where crc32 of the id's text leaves 0 modulo 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def hashed_sample(df: DataFrame, by: str, order: list[Column], most: int, parts: int = 16) -> DataFrame:
    """About ``most`` rows for each value of ``by``: the first by ``order`` (a hash first) in each of ``parts`` hash classes.

    The classes split a value that most rows have, and keep each limit small
    enough that Spark applies it before rows are shuffled.
    """
    part, k = fresh(df, "part"), fresh(df, "k")
    dealt = df.withColumn(part, F.pmod(F.shiftright(order[0], 7), F.lit(parts)))
    window = Window.partitionBy(by, part).orderBy(*order)
    return dealt.withColumn(k, F.row_number().over(window)).where(F.col(k) <= math.ceil(most / parts)).drop(k, part)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_keys(docs: DataFrame, id_col: str, text_col: str, key: str) -> tuple[DataFrame, bool]:
    """``docs`` with a long column ``key`` that orders and tells apart its texts, and whether it is the id.

    Usually the id itself. Only where ids repeat or are null, the distinct
    (id, hash of text) pairs are numbered in that order, nulls first, so rows
    with the same id and the same text share a key and all others differ. Ids
    are whole numbers (or text that casts to them).
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    clash = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL")
    if not clash.limit(1).count():
        return docs.withColumn(key, F.col(id_col).cast("long")), True
    pairs = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
                        .alias("print")).distinct()
    parts = saved(pairs.repartitionByRange(F.col("id").asc_nulls_first(), F.col("print"))
                  .sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("print"))
                  .select("id", "print", F.monotonically_increasing_id().alias(key)), "keys")
    own = fresh(docs.withColumn(key, F.lit(0)), "print")
    joined = docs.withColumn(own, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("d").join(
        parts.alias("k"), F.col("d." + id_col).cast("long").eqNullSafe(F.col("k.id"))
        & (F.col("d." + own) == F.col("k.print")))
    return joined.select("d.*", f"k.{key}").drop(own), False
