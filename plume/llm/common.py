"""Helpers shared by the operators: input columns, Arrow batches, written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Characters handled at once by the vectorized text code; one longer text is handled alone.
BATCH_CHARS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named input columns: ``doc_id`` as a long, the others as strings."""
    return docs.select(*[F.col(f"`{c}`").cast("long" if c == "doc_id" else "string").alias(c) for c in columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


#: Parquet settings for tables that carry whole texts: small row groups, sizes looked at every ten rows (a text may
#: have megabytes), and a codec that streams, so a writer or reader holds little at once.
TEXT_TABLE = {"compression": "zstd", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "10",
              "parquet.page.size.row.check.min": "10"}


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder, with Parquet ``options``, and read it back.

    Cuts the lineage: the table survives lost executors, and every reader sees
    the same rows even where the producing tasks are not bit-for-bit repeatable.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plume-llm/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_groups(batches: Iterator[pa.RecordBatch], text: str = "text",
                chars: int = BATCH_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut Arrow batches into slices of about ``chars`` characters (one row at least)."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        begin, size = 0, 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if size and size + n > chars:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += n
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]
