"""Materialized tables in the shared folder.

The original pipelines persist their intermediate products as tables
(``raw_reviews``, ``reviews_analyzed``, the exported daily source tables)
and run the analysis queries against those.  ``materialized`` does the same:
the first use writes the table as Parquet under ``spark.checkpoint.dir``
(the cluster's shared folder, so executor loss never loses it, and it cuts
the lineage), later uses read it back.

The location is keyed by a fingerprint of the inputs (size, file count and
folder modification times, taken anew at each use) and of this package's
source, so an appended, removed or rewritten file and changed code build anew.

Also here: ``shared`` (an intermediate consumed by several branches of one
plan, written once instead of recomputed per branch; ``release_shared``
deletes them), ``spread`` (even partitions for a CPU-heavy stage) and
``remove_folder`` (a run deleting its own namespace).
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_CODE_HASH: str | None = None


def _code_hash() -> str:
    global _CODE_HASH
    if _CODE_HASH is None:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        h = hashlib.sha256()
        for dirpath, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(dirpath, f), "rb") as fh:
                        h.update(f.encode() + fh.read())
        _CODE_HASH = h.hexdigest()[:16]
    return _CODE_HASH


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _path_fingerprint(spark: SparkSession, path: str) -> str:
    """Hash of a table's size, file and folder counts, and of its folder's modification times.

    A few calls whatever the number of files: the file system adds up the
    sizes, and only the table's folder and its direct subfolders are looked at.
    """
    h = hashlib.sha256()
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        h.update(f"missing:{path}".encode())
        return h.hexdigest()
    total, top = fs.getContentSummary(p), fs.getFileStatus(p)
    h.update(f"{path}|{total.getLength()}|{total.getFileCount()}|{total.getDirectoryCount()}|{top.getModificationTime()}".encode())
    if top.isDirectory() and total.getDirectoryCount() > 1:
        for st in fs.listStatus(p):
            if st.isDirectory():
                h.update(f"{st.getPath().getName()}|{st.getModificationTime()}".encode())
    return h.hexdigest()


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, added up by the file system."""
    p, fs = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Combined fingerprint of the input folders (see ``_path_fingerprint``)."""
    h = hashlib.sha256()
    for path in sorted(paths):
        h.update(f"{path}={_path_fingerprint(spark, path)}".encode())
    return h.hexdigest()[:16]


NAMESPACE_CONF = "spark.plume.tableNamespace"


def table_root(spark: SparkSession) -> str:
    """``<spark.checkpoint.dir>/plume-tables[/<namespace>]``.

    A run can set ``spark.plume.tableNamespace`` to start from an empty
    namespace (the benchmark does, so it always pays every build).
    """
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/plume-tables"
    try:
        ns = spark.conf.get(NAMESPACE_CONF)
    except Exception:  # noqa: BLE001 - unset
        ns = None
    return f"{root}/{ns}" if ns else root


def written_once(spark: SparkSession, name: str, inputs: list[str],
                 write: Callable[[str], None], in_place: bool = False) -> str:
    """Path of folder ``name`` produced by ``write(path)`` once per input/code version.

    The write goes to a unique temporary folder first and is renamed into
    place, so a failed or concurrent build never leaves a half folder behind.
    ``in_place`` writers (streaming queries, whose sink log records absolute
    paths and whose checkpoint makes a rerun resume) write to the final path.
    """
    key = hashlib.sha256((input_fingerprint(spark, inputs) + _code_hash()).encode()).hexdigest()[:20]
    path = f"{table_root(spark)}/{name}/{key}"
    with _lock_for(path):  # threads of one process wait for a single build
        return _write_once(spark, name, path, write, in_place)


_LOCKS: dict[str, threading.RLock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock_for(path: str) -> threading.RLock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.RLock())


def _write_once(spark: SparkSession, name: str, path: str, write: Callable[[str], None], in_place: bool) -> str:
    if in_place:
        if not folder_exists(spark, f"{path}/_SUCCESS"):
            write(path)
        return path
    if not folder_exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{table_root(spark)}/{name}/_tmp-{uuid.uuid4().hex}"
        write(tmp)
        src, fs = _fs(spark, tmp)
        dst, _ = _fs(spark, path)
        if folder_exists(spark, f"{path}/_SUCCESS"):  # another process finished first
            fs.delete(src, True)
        else:
            if fs.exists(dst):  # a rename that was cut off left part of a table
                fs.delete(dst, True)
            fs.rename(src, dst)
    return path


def materialized(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                 partition_by: list[str] | None = None, sort_within: list[str] | None = None) -> DataFrame:
    """Return table ``name`` built by ``build()``, written once per input/code version."""
    def write(tmp: str) -> None:
        df = build()
        if sort_within:
            df = df.sortWithinPartitions(*sort_within)
        w = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(tmp)
    return spark.read.parquet(written_once(spark, name, inputs, write))


def mark_done(spark: SparkSession, path: str) -> None:
    """Create ``path/_SUCCESS`` (for folders not written by a DataFrame writer)."""
    p, fs = _fs(spark, f"{path}/_SUCCESS")
    fs.create(p, True).close()


def shared(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it as a Parquet table in the shared folder.

    For an intermediate result that several branches of one plan consume:
    without it each branch recomputes the subtree (column pruning makes the
    branches differ, so Spark cannot reuse the exchange).  The written table
    survives executor loss, cuts the lineage and is read back columnar, so
    each branch scans only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{table_root(spark)}/_shared/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _SHARED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SHARED: list[str] = []


def release_shared(spark: SparkSession) -> None:
    """Delete the intermediates this process wrote, once the results that read them are done."""
    while _SHARED:
        remove_folder(spark, _SHARED.pop())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete ``version=<n>`` folders, ascending (folder listings only)."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    found = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
    return sorted(v for v in found if folder_exists(spark, f"{folder}/version={v}/_SUCCESS"))


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Even out the partitions of a CPU-heavy stage's input by size (a REBALANCE hint, whatever the input).

    Rows are dealt by the hash of ``by``.  Without columns Spark deals them
    round robin, for which each task first sorts all its rows.
    """
    return df.hint("rebalance", *by)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this process created (e.g. a benchmark namespace)."""
    p, fs = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def expire_shared(spark: SparkSession, older_than_hours: float = 24.0) -> list[str]:
    """Delete ``shared`` intermediates older than ``older_than_hours`` (housekeeping).

    Meant for a scheduled cleanup: an intermediate is only read by the query
    that wrote it, so anything older than the longest run can go.  Lists one
    folder level through the Hadoop FileSystem API; no data is read.
    """
    import time
    p, fs = _fs(spark, f"{table_root(spark)}/_shared")
    if not fs.exists(p):
        return []
    cutoff_ms = (time.time() - older_than_hours * 3600.0) * 1000.0
    removed = []
    for st in fs.listStatus(p):
        if st.isDirectory() and st.getModificationTime() < cutoff_ms:
            fs.delete(st.getPath(), True)
            removed.append(st.getPath().getName())
    return sorted(removed)
