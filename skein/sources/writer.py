"""Writes frames as logs, for fixtures of queries and tests. Each part file has its own header."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.files import expand, first_lines
from skein.sources.header import LogHeader


def escaped(char: str) -> str:
    return f"\\x{ord(char):02x}"


def header_text(header: LogHeader) -> str:
    sep = header.separator
    lines = [
        f"#separator {escaped(sep)}",
        f"#set_separator {escaped(header.set_separator)}",
        f"#empty_field {header.empty}",
        f"#unset_field {header.unset}",
        f"#path {header.path}",
        "#fields " + sep.join(header.fields),
        "#types " + sep.join(header.types),
    ]
    return "\n".join(lines)


def write_log(df: DataFrame, folder: str, header: LogHeader, *, compression: str = "none", line_end: str = "") -> None:
    """The string columns of `df`, in order, as lines; the first line of a partition brings the header before it.

    Spark gives the first partition a file even if it has no rows; that file has the header alone. Other empty ones get none.
    """
    line = F.concat(F.concat_ws(header.separator, *df.columns), F.lit(line_end))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = header_text(header).replace("\n", f"{line_end}\n") + f"{line_end}\n"
    df.select(F.when(first, F.concat(F.lit(head), line)).otherwise(line).alias("value")).write.option("compression", compression).mode("overwrite").text(folder)
    for path in expand(df.sparkSession, f"{folder}/part-00000-*"):
        if next(first_lines(df.sparkSession, path), None) is None:
            overwrite(df.sparkSession, f"{folder}/{os.path.basename(path)}", head.encode())


def overwrite(spark: SparkSession, path: str, data: bytes) -> None:
    """`data` as the contents of a file of any store that Spark reaches, compressed by its suffix."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    stream = at.getFileSystem(conf).create(at, True)
    out = codec.createOutputStream(stream) if codec else stream
    try:
        out.write(data)
    finally:
        out.close()


def put(folder: str, name: str, data: bytes) -> None:
    """A file of a folder (a path or URL), written under a private name and renamed, so a retried task leaves the same file."""
    url, part = urlparse(folder), f".{name}.{uuid.uuid4().hex}"
    if url.scheme in ("", "file"):
        base = unquote(url.path)
        os.makedirs(base, exist_ok=True)
        with open(f"{base}/{part}", "wb") as f:
            f.write(data)
        os.replace(f"{base}/{part}", f"{base}/{name}")
        return
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{part}") as f:
        f.write(data)
    store.move(f"{base}/{part}", f"{base}/{name}")


def write_zstd(df: DataFrame, folder: str, header: LogHeader) -> None:
    """As write_log, a file for each partition that has rows; Spark's own text writer has no zstd here."""
    head = f"{header_text(header)}\n".encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sink = 0, pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "zstd") as f:
            f.write(head)
            for batch in batches:
                n += batch.num_rows
                f.write("".join(f"{line}\n" for line in batch.column(0).to_pylist()).encode())
        if n:
            put(folder, f"part-{TaskContext.get().partitionId():05d}.log.zst", sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    df.select(F.concat_ws(header.separator, *df.columns)).mapInArrow(run, "n long").agg(F.sum("n")).collect()
