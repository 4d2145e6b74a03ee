"""Tables sorted by a key, with a sparse directory of their files.

Rows are range-partitioned and sorted by the key (and further columns, so that a
key with many rows is spread over files) and written in small row groups. The
directory has one row a file: its first and last key and its rows. A lookup
reads the directory, opens only files whose range holds a wanted key, and
pushes the keys down to the row groups and pages of these files.

A table of many files is written in passes over ranges of its keys, each shuffled when the one before is
written and its shuffle freed, so the disk holds the shuffle of one pass beside the table.

The directory has one row for ``FILE_ROWS`` rows or ``FILE_BYTES`` of text, so a lookup may hold it on the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrank.session import write_parquet

# Rows of a full file, and of the files that are written to give every core one.
FILE_ROWS = 4_000_000
FILE_BYTES = 256 << 20
LEAST_FILE_ROWS = 1 << 16
ROW_GROUP_BYTES = 4 << 20
# Most passes of a write, each of about as many files as there are cores, and the keys that their bounds are taken from.
MOST_PASSES = 8
SAMPLED_KEYS = 20_000
# An IN list of up to 10 values reaches row groups value by value, a longer one as a range.
PUSHED_TOGETHER = 10
MOST_PUSHED = 200
# Rows of a query side that may be held on the driver.
FEW = 20_000


def few(df: DataFrame, most: int | None = None) -> pa.Table | None:
    """The rows of ``df`` on the driver, or None if there are more than ``most`` (``FEW``)."""
    most = FEW if most is None else most
    table = df.limit(most + 1).toArrow()
    return table if table.num_rows <= most else None


def is_any(column: str, keys: list) -> Column:
    """``column`` is one of ``keys``, in a form that Parquet row groups are tested with."""
    chunks = [F.col(column).isin(keys[i: i + PUSHED_TOGETHER]) for i in range(0, len(keys), PUSHED_TOGETHER)]
    return reduce(lambda a, b: a | b, chunks)


@dataclass(frozen=True)
class RangeTable:
    """The sorted table at ``path``; ``schema`` is that of its rows, ``key`` the column it is sorted by."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path + "/rows")

    def directory(self) -> DataFrame:
        """(file, first, last, n, nulls) of every file; its nulls come first."""
        kind = self.schema[self.key].dataType
        return self.spark.read.schema(T.StructType([
            T.StructField("file", T.StringType()), T.StructField("first", kind), T.StructField("last", kind),
            T.StructField("n", T.LongType()), T.StructField("nulls", T.LongType())])).parquet(self.path + "/directory")

    def files(self, keys: list) -> list[str]:
        """Names of the files that can hold a row with one of ``keys``."""
        keys = sorted({k for k in keys if k is not None})
        if not keys:
            return []
        entries = self.directory().where((F.col("first") <= F.lit(keys[-1])) & (F.col("last") >= F.lit(keys[0])))
        found = []
        for file, first, last in entries.select("file", "first", "last").collect():
            at = bisect_left(keys, first)
            if at < len(keys) and keys[at] <= last:
                found.append(file)
        return sorted(found)

    def lookup(self, keys: list) -> DataFrame:
        """The rows whose key is one of ``keys``, from the files that can hold them."""
        keys = sorted({k for k in keys if k is not None})
        names = self.files(keys)
        if not names:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).parquet(*(f"{self.path}/rows/{n}" for n in names))
        if len(keys) <= MOST_PUSHED:
            return found.where(is_any(self.key, keys))
        # More keys travel as rows, and reach the row groups as a range.
        wanted = self.spark.createDataFrame(pa.table({self.key: keys})).select(F.col(self.key).cast(self.schema[self.key].dataType))
        return found.where(F.col(self.key).between(F.lit(keys[0]), F.lit(keys[-1]))).join(F.broadcast(wanted), self.key, "left_semi")

    def numbered(self) -> DataFrame:
        """All rows with ``place``, their number (from 0) in key order over all files."""
        offsets, before = [], 0
        for file, n in sorted(self.directory().select("file", "n").collect()):
            offsets.append((file, before))
            before += n
        skip = F.broadcast(self.spark.createDataFrame(offsets, "file_ string, skip_ long"))
        return self.placed().join(skip, "file_").withColumn("place", F.col("skip_") + F.col("place")).drop("skip_", "file_")

    def placed(self) -> DataFrame:
        """All rows with ``file_`` and ``place``: the file's number in key order and the row's place in it."""
        return self.rows().withColumns({"file_": F.col("_metadata.file_name"), "place": F.col("_metadata.row_index")})


def _text_bytes(df: DataFrame) -> Column:
    """Bytes of a row's strings."""
    text = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return reduce(lambda a, b: a + b, text, F.lit(0).cast("long"))


def _passes(df: DataFrame, keys: DataFrame, key: str, most: int, rows: int) -> list[DataFrame]:
    """``df`` by up to ``most`` ranges of ``key`` of about as many rows, in order; nulls are in the first. No key is in two."""
    if most < 2:
        return [df]
    found = keys.select(key).where(F.col(key).isNotNull()).sample(min(1.0, SAMPLED_KEYS / rows), seed=1).orderBy(key).toArrow()[key]
    bounds = []
    for i in range(1, most):
        at = found[len(found) * i // most].as_py() if len(found) else None
        if at is not None and (not bounds or at > bounds[-1]):
            bounds.append(at)
    k, edges, parts = F.col(key), [None, *bounds, None], []
    for low, high in zip(edges, edges[1:]):
        part = df if low is None else df.where(k >= F.lit(low))
        parts.append(part if high is None else part.where(k < F.lit(high)) if low is not None else part.where(k.isNull() | (k < F.lit(high))))
    return parts


def write_ranges(df: DataFrame, path: str, key: str, then: tuple[str, ...] = (), rows: int | None = None,
                 finish: Callable[[DataFrame], DataFrame] | None = None, keys: DataFrame | None = None) -> RangeTable:
    """Write ``df`` sorted by ``key`` and ``then`` (nulls first) to the new folder ``path``, its directory last.

    ``rows``: how many rows there are, where that is known and none is long. ``finish``: adds columns to the rows
    where they were dealt, so that these are not shuffled; it must not move rows. ``keys``: rows with the same
    keys, where some are cheaper to read than ``df``."""
    spark = df.sparkSession
    least = 1
    if rows is None:
        total = df.agg(F.count("*").alias("n"), F.sum(_text_bytes(df)).alias("bytes")).first()
        rows, least = total["n"], -(-(total["bytes"] or 0) // FILE_BYTES)
    cores = spark.sparkContext.defaultParallelism
    files = max(1, least, -(-rows // FILE_ROWS), min(cores, rows // LEAST_FILE_ROWS))
    order = [F.col(c).asc_nulls_first() for c in (key, *then)]
    passes = _passes(df, df if keys is None else keys, key, min(MOST_PASSES, -(-files // cores)), rows)
    kind = None
    for i, part in enumerate(passes):
        part = part.repartitionByRange(-(-files // len(passes)), *order)
        part = part if finish is None else finish(part)
        # The files' names are in the order of the passes.
        named = {"mapreduce__output__basename": f"part-{i:05d}"} if len(passes) > 1 else {}
        write_parquet(part.sortWithinPartitions(*order), path + "/rows", "append" if i else "errorifexists",
                      parquet__block__size=str(ROW_GROUP_BYTES), parquet__writer__version="PARQUET_2_0", **named)
        kind = T.StructType([T.StructField(f.name, f.dataType) for f in part.schema])
    table = RangeTable(spark, path, kind, key)
    table.rows().groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"),
        F.count_if(F.col(key).isNull()).alias("nulls")).coalesce(1).write.parquet(path + "/directory")
    return table
