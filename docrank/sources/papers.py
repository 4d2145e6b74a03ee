"""Paper records: JSON-lines scan, projection, document store, catalog reads.

The record has ten fields. A key missing from the JSON object becomes one
space ``" "``; a key present with JSON null stays NULL. ``spark.read.json``
with a schema cannot tell the two apart, so the strict reader parses each
line with ``parse_json`` and tests the variant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field order of the record, with the JSON key each one is read from.
PAPER_FIELDS = (
    ("id", "id"),
    ("submitter", "submitter"),
    ("authors", "authors"),
    ("title", "title"),
    ("comments", "comments"),
    ("journal_ref", "journal-ref"),
    ("doi", "doi"),
    ("abstract", "abstract"),
    ("categories", "categories"),
    ("versions", "versions"),
)
PAPER_COLUMNS = tuple(name for name, _ in PAPER_FIELDS)
# Fields that form the searchable text, in this order.
SEARCH_FIELDS = ("id", "authors", "abstract", "categories", "title")
MISSING = " "

PAPER_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in PAPER_COLUMNS]
)


def _json_path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def project_value(v: Column, key: str, as_json: bool = False) -> Column:
    """One field of a parsed JSON object: missing key -> ' ', JSON null ->
    NULL, a string as is, any other value as its JSON text."""
    raw = F.try_variant_get(v, _json_path(key), "variant")
    as_text = F.to_json(raw) if as_json else F.coalesce(
        F.try_variant_get(v, _json_path(key), "string"), F.to_json(raw)
    )
    return F.when(raw.isNull(), F.lit(MISSING)).when(F.is_variant_null(raw), F.lit(None).cast("string")).otherwise(as_text)


def project_json(lines: DataFrame, fields=PAPER_FIELDS, line_col: str = "value",
                 json_fields=("versions",)) -> DataFrame:
    """Project JSON text lines to string columns with the missing/null rule."""
    v = F.parse_json(F.col(line_col))
    parsed = lines.select(v.alias("_v"))
    return parsed.select(*[project_value(F.col("_v"), key, name in json_fields).alias(name) for name, key in fields])


def read_papers(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Scan a JSON-lines corpus (one record per line).

    ``strict``: keep the missing (' ') / null (NULL) distinction via variant
    parsing. Otherwise the schema reader is used and both become NULL."""
    if strict:
        return project_json(spark.read.text(path))
    df = spark.read.schema(
        T.StructType([T.StructField(key, T.StringType(), True) for _, key in PAPER_FIELDS])
    ).json(path)
    return df.select(*[F.col(f"`{key}`").alias(name) for name, key in PAPER_FIELDS])


def reject_reason(line: Column, whole: Column) -> Column:
    """Why a line is no record, null if it is one. ``whole``: the line parsed as the one element of an array."""
    several = F.try_variant_get(whole, "$[1]", "variant").isNotNull()
    kind = F.schema_of_variant(F.try_variant_get(whole, "$[0]", "variant"))
    return (F.when(F.trim(line) == "", "empty line").when(whole.isNull() | several, "not JSON")
            .when(~F.startswith(kind, F.lit("OBJECT")), "not an object"))


@dataclass(frozen=True)
class PaperScan:
    """What a scan found: ``records`` (the fields), ``rejects`` (file, line, reason), ``counts`` (reason, n; null: records)."""

    records: DataFrame
    rejects: DataFrame
    counts: DataFrame


def scan_papers(spark: SparkSession, path: str, out: str, fields=PAPER_FIELDS, json_fields=("versions",)) -> PaperScan:
    """Scan a JSON-lines corpus that may hold bad lines: records and rejects are written to ``out`` in one pass.

    A line that is empty, no JSON or no object is kept as it is, with its file and a reason; it ends no job."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    # Text after a value is no JSON, but the parser only sees that inside of an array.
    parsed = lines.withColumn("whole", F.try_parse_json(F.concat(F.lit("["), "line", F.lit("]"))))
    told = parsed.withColumn("reason", reject_reason(F.col("line"), F.col("whole"))).withColumn("v", F.try_variant_get("whole", "$[0]", "variant"))
    names = [name for name, _ in fields]
    values = [F.when(F.col("reason").isNull(), project_value(F.col("v"), key, name in json_fields)).alias(name) for name, key in fields]
    told.select(*values, F.col("file").alias("_file"), F.when(F.col("reason").isNotNull(), F.col("line")).alias("_line"),
                F.col("reason").alias("_reason"), F.when(F.col("reason").isNull(), "record").otherwise("reject").alias("_kind")).write.partitionBy(
        "_kind").parquet(out)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, "_file", "_line", "_reason", "_kind")])
    rows = spark.read.schema(schema).parquet(out)
    bad = rows.where("_kind = 'reject'").select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason"))
    return PaperScan(rows.where("_kind = 'record'").select(*names), bad, rows.groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n")))


def limit_corpus(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The first ``n`` records; file order is not defined in Spark, so first
    means smallest ids (a top-n, TakeOrderedAndProject)."""
    return df.orderBy(F.col(id_col).asc()).limit(n)


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).save(path)


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", **options) -> DataFrame:
    """The ``papers`` table from any Spark source: a path for file formats,
    or ``fmt='jdbc'`` with ``url``/``dbtable``/credentials options."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        return reader.option("dbtable", source).load() if "dbtable" not in options else reader.load()
    return reader.load(source)


def plan_ranges(column: str, low: int | None, high: int | None, parts: int) -> list[str]:
    """Predicates that deal the rows with whole numbers ``low`` to ``high`` in ``column`` to ``parts`` ranges of equal width at
    most, and one for rows without a number. Every row meets one of them."""
    if parts < 1:
        raise ValueError("parts is 1 or more")
    out = []
    if low is not None:
        parts = min(parts, high - low + 1)
        border = [low + (high - low + 1) * i // parts for i in range(parts + 1)]
        out = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(border, border[1:])]
        out[0] = f"{column} < {border[1]}" if parts > 1 else f"{column} IS NOT NULL"
        if parts > 1:  # rows that come after the bounds were read are in the outer ranges
            out[-1] = f"{column} >= {border[-2]}"
    return [*out, f"{column} IS NULL"]


def read_table_ranges(spark: SparkSession, source: str, column: str, parts: int, **options) -> DataFrame:
    """The table of a SQL database read by ``parts`` tasks: one query for the bounds of ``column`` (whole numbers), one for
    each range. ``options``: ``url``, credentials and driver of the database."""
    bounds = spark.read.format("jdbc").options(**options).option(
        "dbtable", f"(SELECT min({column}) AS low, max({column}) AS high FROM {source}) bounds").load().first()
    low, high = (None if b is None else int(b) for b in bounds)
    properties = {k: str(v) for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], source, predicates=plan_ranges(column, low, high, parts), properties=properties)


def range_of(predicates: list[str]) -> Column:
    """The number of the first predicate that a row meets."""
    return F.coalesce(*(F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)))


def list_papers(papers: DataFrame) -> DataFrame:
    """All papers, ten columns, ordered by title (ties by id)."""
    return papers.select(*PAPER_COLUMNS).orderBy(F.col("title").asc(), F.col("id").asc())


def get_paper(papers: DataFrame, paper_id) -> DataFrame:
    """The paper with this id (no rows when there is none)."""
    return papers.select(*PAPER_COLUMNS).where(F.col("id") == F.lit(paper_id))


def get_papers(papers: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Batch lookup: papers whose id is in ``ids`` (semi join; a broadcast
    only when the planner measures the id list small)."""
    return papers.select(*PAPER_COLUMNS).join(ids.select(F.col(id_col).alias("id")), "id", "left_semi")


def to_json_rows(df: DataFrame, cols=None, out_col: str = "json") -> DataFrame:
    """Each row as one JSON object, nulls written as null."""
    cols = list(cols or df.columns)
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out_col))
