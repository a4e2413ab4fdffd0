"""Bulk loads of CSV files whose columns are found by name.

A load reads every file of a folder or wildcard, takes the columns that its
schema names from wherever a file's header has them, and writes one table in
one pass: rows that fit the schema and, in a partition of their own, those that
do not, with the reason and the fields as they were read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BAD = "_malformed"


def _f(name: str, kind: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, kind, nullable)


# fixed values: columns of the order, order-item and campaign files; a column that is not nullable is required
ORDERS = T.StructType([
    _f("order_id", T.LongType(), False), _f("customer_id", T.LongType(), False), _f("order_status", T.StringType()),
    _f("order_purchase_timestamp", T.TimestampNTZType(), False), _f("order_total", T.DoubleType())])
ORDER_ITEMS = T.StructType([
    _f("order_id", T.LongType(), False), _f("order_item_id", T.IntegerType(), False), _f("product_id", T.LongType(), False),
    _f("seller_id", T.LongType()), _f("price", T.DoubleType(), False), _f("quantity", T.DoubleType())])
MARKETING = T.StructType([
    _f("date_key", T.DateType(), False), _f("campaign_id", T.StringType(), False), _f("impressions", T.LongType()),
    _f("clicks", T.LongType()), _f("spend", T.DoubleType())])
#: Fixed value: how the order files write times.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Load:
    """A written load: ``rows`` fit the schema, ``rejects`` have ``reason``, ``raw`` (fields as JSON) and ``file``."""
    rows: DataFrame
    rejects: DataFrame


def _files(spark: SparkSession, pattern: str) -> list[str]:
    """Data files of a folder, file or wildcard (a listing through the Hadoop FileSystem API)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(path) or []:
        inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [st.getPath().toString() for st in inner
                  if st.isFile() and st.getLen() and not st.getPath().getName().startswith(("_", "."))]
    return sorted(found)


def headers(spark: SparkSession, files: list[str], options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header.  Spark reads the first line of each file for it; names that occur twice get numbers."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        names = spark.read.options(**options).option("header", "true").csv(file).columns
        by_header.setdefault(tuple(c.strip() for c in names), []).append(file)
    return by_header


def _value(c: Column, field: T.StructField, timestamp_format: str | None) -> Column:
    c = F.when(F.trim(c) != "", c)
    if isinstance(field.dataType, T.StringType):
        return c
    if timestamp_format and isinstance(field.dataType, T.TimestampNTZType):
        # read as UTC and counted from the epoch: wall-clock times that the session's zone skips or repeats stay
        at = F.try_to_timestamp(F.concat(F.trim(c), F.lit(" +0000")), F.lit(f"{timestamp_format} Z"))
        seconds = (F.unix_micros(at).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.trim(c).try_cast(field.dataType)


def load_by_header(spark: SparkSession, pattern: str, schema: T.StructType, target: str,
                   timestamp_format: str | None = None, multi_line: bool = False) -> Load:
    """Truncating load of all CSV files of ``pattern`` into the table at ``target``.

    Names match whatever their case; columns that the schema does not name are
    left out, those that a file lacks (or has twice) are null.  A file without
    a required column, or with one twice, fails the load before anything is
    written.  A
    row is rejected if its number of fields is not the header's, if a value
    does not have its column's type, or if a required value is empty; the first
    of these is its reason.  Fields of white space are empty.  No matching
    file, or files with headers alone: an empty table.
    """
    options = {"quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}
    layouts = headers(spark, _files(spark, pattern), options)
    parts = []
    for header, files in layouts.items():
        at = {name.lower(): i for i, name in enumerate(header)}
        for field in schema:
            if not field.nullable and field.name.lower() not in at:
                raise ValueError(f"{files[0]}: no single column {field.name} in the header {list(header)}")
        cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))]
                             + [T.StructField(_BAD, T.StringType())])
        read = (spark.read.schema(cells).options(**options).option("header", "true").option("enforceSchema", "true")
                     .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(files))
        reason, values = F.when(F.col(_BAD).isNotNull(), "fields"), []
        for field in schema:
            raw = F.col(f"_c{at[field.name.lower()]}") if field.name.lower() in at else F.lit(None).cast("string")
            value = _value(raw, field, timestamp_format)
            values.append(value.alias(field.name))
            reason = reason.when((F.trim(raw) != "") & value.isNull(), f"type of {field.name}")
            if not field.nullable:
                reason = reason.when(value.isNull(), f"no {field.name}")
        fields = F.to_json(F.struct(*[F.col(f"_c{i}").alias(header[i]) for i in range(len(header))]),
                           {"ignoreNullFields": "false"})
        parts.append(read.select(*values, reason.alias("reason"), F.coalesce(_BAD, fields).alias("_raw"),
                                 F.col("_metadata.file_path").alias("_file")))
    written = T.StructType([_f(f.name, f.dataType) for f in schema] + [_f("reason", T.StringType()), _f("raw", T.StringType()),
                                                                       _f("file", T.StringType()), _f("rejected", T.BooleanType())])
    every = spark.createDataFrame([], written)
    for part in parts:
        kept = lambda c: F.when(F.col("reason").isNotNull(), F.col(c))
        every = every.unionByName(part.select(*schema.names, "reason", kept("_raw").alias("raw"), kept("_file").alias("file"),
                                              F.col("reason").isNotNull().alias("rejected")))
    every.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("rejected").parquet(target)
    table = spark.read.schema(written).parquet(target)
    return Load(table.where(~F.col("rejected")).select(*schema.names), table.where("rejected").select("reason", "raw", "file"))


def load_orders(spark: SparkSession, pattern: str, target: str) -> Load:
    """Order files; times as ``yyyy-MM-dd HH:mm:ss``."""
    return load_by_header(spark, pattern, ORDERS, target, TIMESTAMP_FORMAT)


def load_order_items(spark: SparkSession, pattern: str, target: str) -> Load:
    """Order-item files."""
    return load_by_header(spark, pattern, ORDER_ITEMS, target)


def load_marketing(spark: SparkSession, pattern: str, target: str) -> Load:
    """A10: campaign files, several by a wildcard."""
    return load_by_header(spark, pattern, MARKETING, target)
