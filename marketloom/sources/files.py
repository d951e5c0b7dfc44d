"""CSV and Parquet files of the nine tables, and result files."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marketloom.functions.numeric import plain_types
from marketloom.functions.text import missing_to_null
from marketloom.schemas import CLEAN, TABLES, raw_schema
from marketloom.session import side_by_side
from marketloom.shop import Shop

# How timestamps without zone are spelled in CSV files, on both ways.
_STAMPS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}
_CSV = {"header": True, "escape": '"', "enforceSchema": False, **_STAMPS}
_AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


_LINE = "_line"


def _raw_records(spark: SparkSession, path: str, table: str, multi_line: bool) -> DataFrame:
    """Raw columns as text, ``_seq``, and in ``_line`` the text of a record whose fields don't match the columns.

    Ids grow within a split and splits carry their offset, so (file, split, id) is the order of the rows in the
    files however Spark packs splits into tasks. Whole records are parsed, whatever columns are asked for.
    """
    schema = raw_schema(table)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": False, "multiLine": multi_line, **_CSV}
    rows = spark.read.schema(T.StructType([*schema, T.StructField(_LINE, T.StringType())])).options(**options).csv(path)
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Spark refuses reads of the line alone; this condition, always true, asks for a column besides.
    return rows.select("*", place.alias("_seq")).where(F.coalesce(F.length(schema.names[0]) >= 0, F.lit(True)))


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """The raw table as text, missing-value spellings as null, and ``_seq`` as the place in the files.

    Records with more or fewer fields than columns are left out; ``malformed_records`` has them. With ``multi_line`` values
    may hold line breaks; such files are not split.
    """
    rows = _raw_records(spark, path, table, multi_line).where(F.col(_LINE).isNull())
    return rows.select(*[missing_to_null(F.col(c)).alias(c) for c in raw_schema(table).names], "_seq")


def malformed_records(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """The records that ``read_raw_csv`` leaves out: ``table_name, file, place, text, reason``.

    ``place`` is the split's offset in the file; separators within quotes don't count as such.
    """
    separators = F.regexp_count("text", F.lit(r',(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    expected = len(raw_schema(table)) - 1
    return _raw_records(spark, path, table, multi_line).where(F.col(_LINE).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col("_seq.file_path").alias("file"), F.col("_seq.file_block_start").alias("place"),
        F.col(_LINE).alias("text"),
    ).withColumn(
        "reason", F.when(separators > expected, "surplus fields").when(separators < expected, "missing fields").otherwise("broken quotes")
    )


def quarantine(spark: SparkSession, raw_folder: str, path: str, tables=TABLES) -> DataFrame:
    """Stores the malformed records of all raw tables, partitioned by table, and reads them back."""
    found = [malformed_records(spark, f"{raw_folder}/{t}", t) for t in tables]
    reduce(DataFrame.unionByName, found).write.partitionBy("table_name").parquet(path)
    schema = "file string, place bigint, text string, reason string, table_name string"
    return spark.read.schema(schema).parquet(path)


def read_clean_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """The cleaned table with dates and numbers parsed; a value of the wrong type is an error."""
    return spark.read.schema(CLEAN[table]).options(mode="FAILFAST", multiLine=multi_line, **_CSV).csv(path)


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """With header, without index. One file per task; nothing is pulled into one.

    Padding stays as it is. A line break within a value is an error unless ``multi_line`` says that readers expect it.
    """
    if not multi_line:
        broken = F.raise_error(F.lit("a value holds a line break: write and read with multi_line"))
        df = df.withColumns({
            c: F.when(F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r")), broken).otherwise(F.col(c)) for c, kind in df.dtypes if kind == "string"
        })
    df.write.options(header=True, escape='"', **_AS_IS, **_STAMPS).csv(path)


def write_result_csv(df: DataFrame, path: str) -> None:
    write_csv(plain_types(df), path)


def load_tables(spark: SparkSession, csv_folder: str, parquet_folder: str, tables=TABLES) -> Shop:
    """S3: CSV files into typed Parquet tables with exactly the declared columns; tables are loaded side by side."""

    def load(table: str) -> None:
        columns = CLEAN[table].names
        read_clean_csv(spark, f"{csv_folder}/{table}", table).select(*columns).write.parquet(
            f"{parquet_folder}/{table}"
        )

    side_by_side(load, tables)
    return Shop.of_parquet(spark, parquet_folder)


MONTH = "order_month"
"""Column that laid-out facts are partitioned by: the order's month as yyyy-MM."""


ROWS_PER_BUCKET = 5_000_000
"""Items of all months in a bucket, unless a number of buckets is given: a reading task has one bucket of its months."""


def lay_out(shop: Shop, folder: str, name: str, buckets: int | None = None) -> "LaidOut":
    """S3: orders and items partitioned by the order's month and bucketed by order, once for all later runs.

    ``buckets`` is the number of buckets, by the number of items if not given. One bucket of one month becomes one file,
    because rows are dealt by month and the buckets' own hash before they are written; a writing task holds a few such files'
    rows, however large the tables. Items learn their order's month here, in the only join that shuffles
    them; items without an order and orders without a date go to the partition of no month and are kept. The tables
    are ``<name>_orders`` and ``<name>_order_items`` of the session's catalogue, with files below ``folder``.
    """
    if buckets is None:
        buckets = max(4, math.ceil(shop.order_items.count() / ROWS_PER_BUCKET))
    month = F.date_format("order_date", "yyyy-MM").alias(MONTH)
    orders = shop.orders.select(*CLEAN["orders"].names, month)
    # A repeated order id must not repeat its items.
    months = shop.orders.groupBy("order_id").agg(F.min("order_date").alias("order_date")).select("order_id", month)
    items = shop.order_items.join(months, "order_id", "left").select(*CLEAN["order_items"].names, MONTH)
    for table, rows in (("orders", orders), ("order_items", items)):
        dealt = rows.repartition(MONTH, F.pmod(F.hash("order_id"), F.lit(buckets)))
        stored = dealt.write.partitionBy(MONTH).bucketBy(buckets, "order_id")
        stored.option("path", f"{folder}/{table}").saveAsTable(f"{name}_{table}")
    return LaidOut(shop, name)


class LaidOut:
    """Facts laid out by ``lay_out``; ``shop`` reads them, whole or a period of them, beside the other tables."""

    def __init__(self, shop: Shop, name: str):
        self._shop, self._name = shop, name

    def shop(self, first_month: str | None = None, last_month: str | None = None) -> Shop:
        """The shop of the orders from ``first_month`` to ``last_month`` (yyyy-MM, both included) and their items.

        Other months' files are not read. Without limits everything is there, also what has no month. Orders meet their
        items, and items are added up per order, without a shuffle.
        """

        def read(table: str) -> DataFrame:
            if table not in ("orders", "order_items"):
                return self._shop.table(table)
            rows = self._shop.spark.table(f"{self._name}_{table}")
            if first_month is not None:
                rows = rows.where(F.col(MONTH) >= first_month)
            if last_month is not None:
                rows = rows.where(F.col(MONTH) <= last_month)
            return rows.select(*CLEAN[table].names)

        return Shop(self._shop.spark, read)


def row_counts(shop: Shop, tables=TABLES) -> DataFrame:
    """S4."""
    counts = [
        shop.table(t).agg(F.count("*").alias("total_rows")).select(F.lit(t).alias("table_name"), "total_rows")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counts)
