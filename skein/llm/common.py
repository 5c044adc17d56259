"""Helpers shared by the training-data operators: tables, splits, shared folders and Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows of one Arrow batch: texts are long, and a batch is held by the JVM, by Arrow and by the worker at once.
BATCH_ROWS = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, its session set to Arrow batches of at most BATCH_ROWS rows (a smaller setting stays)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where a local session has none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not path and current.isDefined():
        path = current.get()
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='skein-shared-')}"
    if not current.isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, with its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder of any store that Spark reaches, taken away."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as make them no column's of `df` in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def partitions_for(spark: SparkSession, n_bytes: int, per_partition: int = 32 << 20, least: int = 12) -> int:
    """A partition count that follows the input's size, so no partition grows with the corpus."""
    return max(least, -(-int(n_bytes or 0) // per_partition))


def give_back() -> None:
    """Memory that this worker has freed goes back to the system: workers outlive tasks and stages."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], text_col: int, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches re-cut so the texts of one hold about `max_bytes` (a longer single text stays whole)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = max(1, batch.column(text_col).nbytes)
        step = max(1, int(n * max_bytes / size)) if size > max_bytes else n
        for at in range(0, n, step):
            yield batch.slice(at, step)
    give_back()


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def with_results(df: DataFrame, text_col: str, keep: list[str], fields: T.StructType, start: Callable[[], Callable[[list], list[pa.Array]]]) -> DataFrame:
    """`keep` columns of `df` and the `fields` that start()(texts) gives for each batch of texts; nothing is shuffled.

    start() is called once a task; it is given texts as they are, nulls included. A field takes the place of a kept
    column of its name.
    """
    keep = [c for c in keep if c not in fields.names]
    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("t"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    made = T.StructType([T.StructField(f"r{i}", f.dataType) for i, f in enumerate(fields.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = start()
        for chunk in chunks(batches, 0, 4 << 20):
            arrays = [*chunk.columns[1:], *of(chunk.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*chunk.schema.names[1:], *made.names])

    return small_batches(rows).mapInArrow(run, T.StructType([*rows.schema.fields[1:], *made.fields])).toDF(*keep, *fields.names)


class SharedFiles:
    """Binary files in the shared folder. A file URL is used in place; other stores go through pyarrow's file systems.

    Files are written under a private name and then renamed, so a retried or speculative task leaves the same file.
    """

    def __init__(self, root: str):
        self.root = root

    @classmethod
    def create(cls, spark: SparkSession, kind: str) -> SharedFiles:
        return cls(f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}")

    def _posix(self) -> str | None:
        url = urlparse(self.root)
        return unquote(url.path) if url.scheme in ("", "file") else None

    def write(self, name: str, data: bytes) -> None:
        if (base := self._posix()) is not None:
            os.makedirs(base, exist_ok=True)
            part = f"{base}/.{name}.{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(data)
            os.replace(part, f"{base}/{name}")
            return
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        store.create_dir(base, recursive=True)
        part = f"{base}/.{name}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as f:
            f.write(data)
        store.move(part, f"{base}/{name}")

    def local(self, name: str, scratch: str | None = None) -> str:
        """A path that can be memory-mapped: the file itself, or a copy in the caller's `scratch` folder."""
        if (base := self._posix()) is not None:
            return f"{base}/{name}"
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        to = f"{scratch}/{name}"
        if not os.path.exists(to):
            with store.open_input_stream(f"{base}/{name}") as f, open(f"{to}.part", "wb") as g:
                shutil.copyfileobj(f, g, 1 << 20)
            os.replace(f"{to}.part", to)
        return to

    def delete(self) -> None:
        if (base := self._posix()) is not None:
            shutil.rmtree(base, ignore_errors=True)
            return
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        store.delete_dir(base)


def shrink_heaps(spark: SparkSession) -> None:
    """Executors' JVMs collect their garbage and give back heap that earlier stages have grown: a JVM and its Python
    workers share an executor's memory. As many tasks as there are cores, so that each executor has one."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).selectExpr("java_method('java.lang.System', 'gc')").collect()


def release(spark: SparkSession) -> None:
    """Let go of shuffle files whose frames are no longer referred to, and of the heap that the driver's JVM no longer needs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
