"""Batch reads and writes of file datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Row formats carry no types; guessing them would cost a pass over the data.
FORMATS_WITHOUT_SCHEMA = ("csv", "json")

# Their writers cut timestamps to milliseconds unless told otherwise.
FULL_TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Every text is quoted and read back as it was: quotes, blanks at the ends and empty
# texts included. Null is written as a control character, so a text that is just this
# character reads as null.
LOSSLESS_CSV = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "nullValue": "\x01",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# How line breaks, and the backslash that marks them, stand in a CSV file: none ends a
# record but its own end, so a file can be cut anywhere and feeds many tasks.
ESCAPES = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}

# The columns of the data directories' tables. Reading with a known
# schema saves the job that looks into the files for one.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*[change(c).alias(n) if n in names else c for n, c in ((n, F.col(f"`{n}`")) for n in df.columns)])


def _escaped(text: Column) -> Column:
    for raw, mark in ESCAPES.items():
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def _restored(text: Column) -> Column:
    # the backslash last, as no mark can begin with a restored one
    for raw, mark in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(mark), F.lit(raw))
    return text


def load_dataset(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: StructType | str | None = None,
    line_breaks: str = "escaped",
) -> DataFrame:
    """Read a dataset; CSV (with header) and JSON lines need a schema.

    CSV files are those of :func:`save_dataset`, in which line breaks are escaped, and
    split into as many tasks as their size asks for. Files from elsewhere are read with
    ``line_breaks`` "none" if no text holds one, and else with "quoted", a file per task.
    """
    reader = spark.read.format(file_format)
    if file_format in FORMATS_WITHOUT_SCHEMA:
        if schema is None:
            raise ValueError(f"reading {file_format} needs a schema")
        if line_breaks not in ("escaped", "none", "quoted"):
            raise ValueError(f"unknown way of line breaks: {line_breaks}")
        if file_format == "csv":
            reader = reader.options(**LOSSLESS_CSV, multiLine=line_breaks == "quoted")
    loaded = (reader.schema(schema) if schema is not None else reader).load(path)
    return _texts(loaded, _restored) if file_format == "csv" and line_breaks == "escaped" else loaded


def save_dataset(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """Write a dataset in the given format and mode (overwrite, append, ignore, error).

    In CSV a line break is written as a backslash and a letter, see ``ESCAPES``.
    ``single_file`` pulls the data through one task: for small exports only.
    """
    if file_format == "csv":
        df = _texts(df, _escaped)
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if file_format in FORMATS_WITHOUT_SCHEMA:
        writer = writer.options(**FULL_TIMESTAMPS)
    if file_format == "csv":
        writer = writer.options(**LOSSLESS_CSV)
    writer.format(file_format).save(path)
