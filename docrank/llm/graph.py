"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrank.llm import arrays
from docrank.llm.tables import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINK = "u long, v long"


def thinned(links: DataFrame) -> DataFrame:
    """Links with the same reach as those of each partition's batches, at most one for a node and batch."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = arrays.forest(np.asarray(batch.column(0), np.int64), np.asarray(batch.column(1), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return links.select("u", "v").mapInArrow(thin, LINK)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (u, v); a component's name is its smallest node.

    Each round links every node's larger neighbours to its least one (large
    star), then its smaller ones (small star), until nothing changes. The
    rounds grow with the logarithm of the longest path. All grouping is by
    partial minimum, joins may be split, and every round is written, so no
    node's links are gathered in a task.
    """
    edges = saved(thinned(links).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = saved(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
