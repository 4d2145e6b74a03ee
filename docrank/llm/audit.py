"""How filters interact: what each order of five document filters keeps, removes and loses.

The files of a table are processed as a stream of available-now micro-batches.
Four filters look at a text alone and are evaluated by Spark; the fifth removes a
text that a smaller id has too, which no batch can know for itself. So state is kept by text:

1. A row becomes its text's key (128 bits of SHA-256), id, part, labels and a mask of the
   filters A to D that it fails. Each Arrow batch is reduced first: of the rows with
   one text only those with the batch's smallest id go on, the others are copies whatever
   comes later and are counted at once. So a text that a third of all rows have sends
   one row a batch.
2. State holds, for each text, its smallest id so far and that row's counters. A smaller id
   retracts the earlier mask from its part's counter (-1), adds the mask with E (+1) and takes
   its place; a larger one is counted with E. Texts are keyed in buckets of about
   ``texts_a_key``, so that a Python call serves several. State lives in RocksDB and the checkpoint.
3. The changes are appended to a table by the streaming sink, once each also after a restart;
   their sums are the counts by part and mask: 32 masks a part.
4. With Z(S), the documents of a part that fail none of the filters in S, every
   figure of every order is a difference: kept after S is Z(S), removed by f after S is
   Z(S) - Z(S + f), and so on. No order is run.

Defined cases: null texts are empty; a null part is the empty string; a null id is
neither smaller nor larger than another, so it fails no E and causes none; rows that
repeat the smallest id and its text all count as first; an id with several label rows
has a label if one row has it, label rows without an id count for nothing; an empty table gives no rows. Ids are whole numbers.
"""

from __future__ import annotations

import math
import pickle
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docrank.llm.tables import saved
from docrank.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILTERS = "ABCDE"
COPY = 16  # the mask of filter E
# How the stream keeps its state; read when it starts.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}  # else every small store takes megabytes
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_ROWS = 1 << 17  # rows of the table for a partition of the state
LEAST_BATCH = 256 << 20  # bytes of files that a micro-batch takes at least
SALTS = 8
COUNTER = ["part", "mask", "good", "toxic"]
REDUCED = "bucket long, key binary, id long, part string, mask int, good boolean, toxic boolean, n long"


def own_mask(text: Column) -> Column:
    """Mask of the filters A to D that a text fails: few words, few distinct words, capitals, symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def described(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, part_col: str, buckets: int) -> DataFrame:
    """(bucket, key, id, null_id, part, mask, good, toxic) of each row, no id null. ``marks``: id, good, toxic, one row an id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("key"), own_mask(text).alias("mask"))
    rows = rows.withColumns({"bucket": F.pmod(F.xxhash64("key"), F.lit(buckets)), "salt": F.pmod(F.xxhash64("key"), F.lit(SALTS))})
    # An id that many rows have is split by the hash of their texts.
    salted = marks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # Never broadcast: files of ids are small beside their rows in memory, of which the salts make eight times as many.
    return rows.join(salted.hint("shuffle_merge"), ["id", "salt"], "left").select(
        "bucket", "key", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("null_id"), "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with their text's smallest id of the batch, counted; the others as counts without a key."""
    for rows in batches:
        if not len(rows):
            continue
        real = rows[~rows["null_id"]]
        copy = real["id"] > real.groupby("key")["id"].transform("min")
        first = real[~copy].groupby(["bucket", "key", "id", *COUNTER], as_index=False).size()
        later = pd.concat([real[copy].assign(mask=real["mask"][copy] | COPY), rows[rows["null_id"]]])
        later = later.groupby(COUNTER, as_index=False).size().assign(bucket=rows["bucket"].iloc[0], key=None, id=0)
        out = pd.concat([x for x in (first, later) if len(x)])
        yield out.rename(columns={"size": "n"})[["bucket", "key", "id", *COUNTER, "n"]]


def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the rows of a bucket; its state maps texts to (id, mask, good, toxic, rows by part)."""
    known = pickle.loads(state.get[0]) if state.exists else {}
    change: Counter = Counter()
    grown = False
    for rows in parts:
        for text, own, part, mask, good, toxic, n in zip(
                rows["key"], rows["id"].tolist(), rows["part"], rows["mask"].tolist(), rows["good"].tolist(), rows["toxic"].tolist(), rows["n"].tolist()):
            if text is None:
                change[part, mask, good, toxic] += n
                continue
            text = bytes(text)
            first = known.get(text)
            if first is None or own <= first[0]:
                if first is None or own < first[0]:
                    if first is not None:
                        for p, m in first[4].items():
                            change[p, first[1], first[2], first[3]] -= m
                            change[p, first[1] | COPY, first[2], first[3]] += m
                    known[text] = first = (own, mask, good, toxic, {})
                first[4][part] = first[4].get(part, 0) + n
                change[part, mask, good, toxic] += n
                grown = True
            else:
                change[part, mask | COPY, good, toxic] += n
    if grown:
        state.update((pickle.dumps(known),))
    rows = [(*k, n) for k, n in change.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=[*COUNTER, "n"])


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source", batches: int = 4, texts_a_key: int = 256, batch_files: int | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) of the Parquet table at ``path``: rows by the filters that they fail.

    ``labels``: doc_id, quality, toxic. A micro-batch takes about one of ``batches`` equal shares of the files'
    bytes, so there are as many at every size but for small tables, or ``batch_files`` files."""
    table = spark.read.parquet(path)
    rows = table.count()  # from the files' footers
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marks = saved(marks.where("good OR toxic"), "marks")
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = {"maxFilesPerTrigger": str(batch_files)} if batch_files else {"maxBytesPerTrigger": str(max(LEAST_BATCH, math.ceil(size / batches)))}
    # As a pattern, a path may name a folder or one file.
    docs = spark.readStream.schema(table.schema).options(**limit).parquet(f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]")
    reduced = described(docs, marks, id_col, text_col, part_col, max(1, rows // texts_a_key)).mapInPandas(reduce_batches, REDUCED)
    changes = reduced.groupBy("bucket").applyInPandasWithState(
        update, "part string, mask int, good boolean, toxic boolean, n long", "known binary", "append", GroupStateTimeout.NoTimeout)
    out = scratch_path(spark, f"llm-audit-{uuid.uuid4().hex}")
    settings = STATE | {PARTITIONS: str(max(spark.sparkContext.defaultParallelism, math.ceil(rows / STATE_ROWS)))}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        query = changes.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", out + "/state").format(
            "parquet").start(out + "/changes")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return spark.read.schema(changes.schema).parquet(out + "/changes").groupBy(*COUNTER).agg(F.sum("n").alias("n")).where("n <> 0")


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts by mask."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    sums = lambda: [F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                    F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")]
    masks = counts.groupBy("part", "mask").agg(*sums())
    passed = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda s: s.bitwiseAND(F.col("mask")) == 0)
    clear = masks.withColumn("none", F.explode(passed)).groupBy("part", "none").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    parts = clear.groupBy("part").agg(*(F.map_from_entries(F.collect_list(F.struct("none", c))).alias(c) for c in ("n", "good", "toxic")))

    def z(which: str, s) -> Column:
        return F.coalesce(F.try_element_at(which, F.lit(s) if isinstance(s, int) else s), F.lit(0)).cast("long")

    # removed by f after the filters S, as often as orders have just S before f
    shares = {f: sum((math.factorial(s.bit_count()) * math.factorial(4 - s.bit_count()) * (z("n", s) - z("n", s | b))
                      for s in range(32) if not s & b), F.lit(0)) for f, b in bit.items()}
    parts = parts.select("part", "n", "good", "toxic", *(shares[f].alias("share" + f) for f in FILTERS))
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            steps.append(f"named_struct('o', '{''.join(order)}', 's', {i + 1}, 'f', '{f}', 'b', {before}, 'a', {before | bit[f]}, 'm', {bit[f]})")
            before |= bit[f]
    rows = parts.withColumn("x", F.explode(F.expr(f"array({', '.join(steps)})")))
    b, a, m = F.col("x.b"), F.col("x.a"), F.col("x.m")
    lost = lambda which: z(which, b) - z(which, a)
    share = F.coalesce(*(F.when(F.col("x.f") == f, F.col("share" + f)) for f in FILTERS))
    return rows.select(
        "part", F.col("x.o").alias("filter_order"), F.col("x.s").cast("int").alias("step"), z("n", a).alias("kept"), lost("n").alias("removed"),
        (z("n", 0) - z("n", m) - lost("n")).alias("redundant"), (z("n", 31 - m) - z("n", 31)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), share.cast("long").alias("shapley"))


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    """The report over the Parquet table at ``path``; ``options`` as for ``mask_counts``."""
    return report(saved(mask_counts(spark, path, labels, **options), "counters"))
