"""Places for intermediate tables and files that every executor can see."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs inside this one process (as in
    tests) a temporary folder stands in for it; on a cluster its absence is an
    error, as executors could not see each other's files.
    """
    global _local_root
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="concordat-")
        atexit.register(shutil.rmtree, _local_root, True)
    return f"file://{_local_root}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/concordat/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor costs only its unfinished tasks."""
    path = scratch(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def write_bytes(uri: str, data: bytes) -> None:
    """Write a file so that it appears whole or not at all.

    Attempts of one task write the same bytes under names of their own and
    rename, so retries and speculative copies do no harm.
    """
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(attempt) as out:
        out.write(data)
    fs.move(attempt, path)


class AtomicWriter:
    """A streamed file that is renamed to its final name on a clean close."""

    def __init__(self, uri: str):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.attempt = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.attempt)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def __enter__(self) -> AtomicWriter:
        return self

    def __exit__(self, kind, *_) -> None:
        self.out.close()
        if kind is None:
            self.fs.move(self.attempt, self.path)
        else:
            self.fs.delete_file(self.attempt)


def read_bytes(uri: str, offset: int = 0, length: int | None = None) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        return f.read() if length is None else f.read(length)


def file_size(uri: str) -> int:
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.get_file_info(path).size


def open_input(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_concordat_shipped", False):
        return
    sc._concordat_shipped = True
    here = Path(__file__).resolve().parent
    if str(here.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent).as_posix())
    out = Path(tempfile.mkdtemp(prefix="concordat-ship-")) / "concordat_pkg.zip"
    out.write_bytes(buf.getvalue())
    sc.addPyFile(str(out))


BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts.

    The session's limits are only ever lowered, and to the same values by every
    operator, so a lazy plan does not depend on which was built last.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most) if name == "maxRecordsPerBatch" else f"{most}b")


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that no plan refers to any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables written by :func:`materialize` that no later plan reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rpartition("/")[0] for t in tables for f in t.inputFiles()}:
        if "/concordat/" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """:func:`drop` them, and their shuffle files too."""
    drop(spark, *tables)
    release(spark)
