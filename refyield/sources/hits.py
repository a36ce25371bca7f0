"""Hit-level web data: schema, column check and the tab-separated reader."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from refyield.functions.escapes import unescape
from refyield.sinks.versions import current_folder

# The fields of the input format, in file order.
HIT_SCHEMA = StructType(
    [
        StructField("hit_time_gmt", LongType(), True),
        StructField("date_time", StringType(), True),
        StructField("user_agent", StringType(), True),
        StructField("ip", StringType(), True),
        StructField("event_list", StringType(), True),
        StructField("geo_city", StringType(), True),
        StructField("geo_region", StringType(), True),
        StructField("geo_country", StringType(), True),
        StructField("pagename", StringType(), True),
        StructField("page_url", StringType(), True),
        StructField("product_list", StringType(), True),
        StructField("referrer", StringType(), True),
    ]
)

HIT_COLUMNS: tuple[str, ...] = tuple(f.name for f in HIT_SCHEMA.fields)

# The only columns the revenue report reads.
REQUIRED_COLUMNS: tuple[str, ...] = ("hit_time_gmt", "ip", "event_list", "product_list", "referrer")

CORRUPT_COLUMN = "_corrupt_record"

# Parts of a table of hits by session (see ``write_hits_by_session``).
SESSION_RANGES, FIRST_KEYS = "hits", "first_keys"


def check_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise ``ValueError`` naming any required column the DataFrame lacks."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the hit table lacks {', '.join(missing)}")
    return df


def read_hits(
    spark: SparkSession,
    path: str | list[str],
    *,
    strict: bool = False,
    keep_corrupt: bool = False,
    escapes: bool = False,
) -> DataFrame:
    """Read tab-separated hit files (header line, ``"`` quoting, CRLF or LF).

    The schema is fixed, so there is no inference pass and files stay
    splittable (no multi-line records). Empty fields read as NULL, short
    rows are padded with NULL and a bad number reads as NULL.

    ``strict=True`` makes Spark compare every file's header with the schema
    and fail on a mismatch instead of reading columns by position.
    ``keep_corrupt=True`` adds ``_corrupt_record`` holding the raw line of
    rows that did not fit the schema (see ``split_corrupt``); every field is
    then parsed, whatever the plan selects, as a row is judged by them all.
    ``escapes=True`` reads files of ``write_hits(..., escapes=True)``: line breaks,
    empty texts and NULL come back as they were.
    """
    schema = HIT_SCHEMA
    if keep_corrupt:
        schema = StructType(HIT_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    reader = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", "false" if strict else "true")
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("columnPruning", "false")
    hits = check_columns(reader.csv(path))
    if escapes:
        hits = hits.withColumns({f.name: unescape(f.name) for f in HIT_SCHEMA.fields if isinstance(f.dataType, StringType)})
    return hits


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a ``keep_corrupt`` read into (well-formed hits, malformed rows)."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    good = df.filter(~bad).drop(CORRUPT_COLUMN)
    quarantine = df.filter(bad)
    return good, quarantine


def read_hits_parquet(spark: SparkSession, path: str, *, dates: Iterable[str] | None = None, undated: bool = False) -> DataFrame:
    """Hits written by ``write_hits_by_date``; ``dates`` keeps only those days.

    The date filter is on the partition column, so Spark prunes partitions
    at planning time instead of reading and discarding rows. Sessions are
    then cut at day boundaries (hits of other days are not seen). Hits without
    a time belong to no day: a dated read has them only with ``undated=True``.
    """
    df = spark.read.parquet(path)
    if dates is not None:
        chosen = F.col("hit_date").isin([F.lit(d).cast("date") for d in dates])
        df = df.filter(chosen | F.col("hit_date").isNull() if undated else chosen)
    return check_columns(df)


def read_hits_by_session(spark: SparkSession, path: str) -> DataFrame:
    """All hits of a table that ``write_hits_by_session`` wrote."""
    return _session_table(spark, path)[0].select(*HIT_COLUMNS)


def _session_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    folder = current_folder(spark, path)
    if folder is None:
        raise ValueError(f"no hits by session at {path}")
    schema = StructType(HIT_SCHEMA.fields + [StructField("range", IntegerType())])
    return spark.read.schema(schema).parquet(f"{folder}/{SESSION_RANGES}"), spark.read.parquet(f"{folder}/{FIRST_KEYS}")


def session_hits(spark: SparkSession, path: str, **key_values) -> DataFrame:
    """Hits of one session, e.g. ``session_hits(spark, path, ip="10.1.2.3")``, from the
    files it can be in alone. Give every key the table was written with.

    The ranges are in the order of their keys: those to read begin at or before the
    session, and the next one at or after it. Their numbers, one for each file that
    is read, go into a filter on the partition column.
    """
    rows, first = _session_table(spark, path)
    names = [c for c in first.columns if c != "range"]
    if 2 * len(key_values) != len(names):
        raise ValueError(f"the table was written with {len(names) // 2} session keys, not {', '.join(key_values) or 'none'}")
    sought = F.struct(*[F.lit(x).alias(n) for n, x in zip(names, (x for v in key_values.values() for x in (v is None, "" if v is None else str(v))))])
    begins = F.struct(*names)
    after = F.lead(begins).over(Window.orderBy("range"))  # a row a file
    ranges = first.select("range", (begins <= sought).alias("begun"), (after.isNull() | (after >= sought)).alias("open")).filter("begun AND open")
    wanted = [r["range"] for r in ranges.select("range").collect()]
    found = rows.filter(F.col("range").isin(wanted))
    for k, v in key_values.items():
        found = found.filter(F.col(k).isNull() if v is None else F.col(k) == F.lit(v))
    return found.select(*HIT_COLUMNS)
