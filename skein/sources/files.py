"""Finding log files and reading the beginnings of them: on the driver, or in tasks where there are very many."""

from __future__ import annotations

import glob
import gzip
import os
import pickle
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import SparkSession

from skein.sources.header import LogError, LogHeader, parse_header

#: Headers read at once on the driver.
READERS = 16

#: Above this many files the headers are read by tasks, so many in each.
IN_TASKS, FILES_A_TASK = 2_000, 500

#: Stores that a task opens without Spark.
TASK_SCHEMES = ("hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def is_local(pattern: str) -> bool:
    return urlparse(pattern).scheme in ("", "file") or re.match(r"^[A-Za-z]:\\", pattern) is not None


def local_path(path: str) -> str:
    return unquote(path[len("file:") :]) if path.startswith("file:") else path


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match, in byte order, spelt as the pattern spells them."""
    if is_local(pattern):
        plain = local_path(pattern)
        found = [plain] if os.path.isfile(plain) else [p for p in glob.glob(plain, recursive=True) if os.path.isfile(p)]
    else:
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if "**" in pattern.split("/"):
            found = list(below(jvm, fs, pattern))
        else:
            found = [s.getPath().toString() for s in fs.globStatus(path) or [] if s.isFile()]
    if not found:
        raise LogError(f"No files found matching pattern: {pattern}")
    return sorted(set(found), key=lambda p: os.fsencode(p))


def below(jvm, fs, pattern: str) -> Iterator[str]:
    """Files of a remote store that match a pattern with a whole `**` part: those below the folders before it, compared
    by their full paths with Python's own rules (hidden names need a dot in the pattern)."""
    parts = pattern.split("/")
    base = jvm.org.apache.hadoop.fs.Path("/".join(parts[: parts.index("**")]) + "/")
    matches = re.compile(glob.translate(pattern, recursive=True, seps="/")).match
    for folder in fs.globStatus(base) or []:
        if folder.isDirectory():
            files = fs.listFiles(folder.getPath(), True)
            while files.hasNext():
                at = files.next().getPath().toString()
                if matches(at):
                    yield at


def first_lines(spark: SparkSession, path: str) -> Iterator[str]:
    """Lines of a file, decompressed by its suffix as Spark's readers do."""
    if is_local(path):
        yield from local_lines(path)
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        stream.close()


def local_lines(path: str) -> Iterator[str]:
    plain = local_path(path)
    if plain.endswith(".gz"):
        with gzip.open(plain, "rb") as f:
            yield from decoded(f)
    elif plain.endswith((".zst", ".bz2")):
        kind = {"t": "zstd", "2": "bz2"}[plain[-1]]
        with pa.CompressedInputStream(pa.OSFile(plain), kind) as f:
            yield from decoded(f)
    else:
        with open(plain, "rb") as f:
            yield from decoded(f)


def decoded(stream) -> Iterator[str]:
    """Lines of a binary stream; a partial read is kept until its line is whole."""
    rest = b""
    while block := stream.read(1 << 14):
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            yield line.decode("utf-8", "replace")
    if rest:
        yield rest.decode("utf-8", "replace")


def sniff(spark: SparkSession, path: str) -> LogHeader:
    try:
        return parse_header(first_lines(spark, path), path)
    except gzip.BadGzipFile as e:
        raise LogError(f"Input is not a GZIP stream: {path}") from e
    except (OSError, EOFError) as e:
        raise LogError(f"cannot read {path}: {e}") from e
    except Exception as e:
        if isinstance(e, LogError):
            raise
        if "gzip" in str(e).lower() or path.endswith(".gz"):
            raise LogError(f"Input is not a GZIP stream: {path}") from e
        raise LogError(f"cannot read {path}: {e}") from e


def opened(path: str):
    """A binary stream of a file, decompressed by its suffix, without Spark: local paths and the stores that pyarrow knows."""
    if is_local(path):
        raw = pa.OSFile(local_path(path))
    else:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(path)
        raw = store.open_input_stream(at)
    kind = {".gz": "gzip", ".zst": "zstd", ".bz2": "bz2"}.get(os.path.splitext(path)[1])
    return pa.CompressedInputStream(raw, kind) if kind else raw


def sniff_in_tasks(spark: SparkSession, paths: list[str]) -> list[LogHeader | LogError] | None:
    """The header of each file, or what is wrong with it, read by Spark's tasks: for very many files. Only a task's distinct
    headers and the files' numbers come back. None if the tasks cannot open such paths."""
    scheme = urlparse(paths[0]).scheme
    if not is_local(paths[0]) and scheme not in TASK_SCHEMES:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, list[int]] = {}
        for batch in batches:
            for i, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    with opened(path) as f:
                        got: LogHeader | LogError = parse_header(decoded(f), path)
                except LogError as e:
                    got = e
                except (OSError, EOFError) as e:
                    got = LogError(f"Input is not a GZIP stream: {path}" if path.endswith(".gz") else f"cannot read {path}: {e}")
                found.setdefault(pickle.dumps(got), []).append(i)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["header", "files"])

    rows = spark.createDataFrame(pa.table({"i": pa.array(range(len(paths)), pa.int64()), "path": pa.array(paths)}))
    parts = -(-len(paths) // FILES_A_TASK)
    out: list = [None] * len(paths)
    for r in rows.repartition(parts).mapInArrow(run, "header binary, files array<long>").toLocalIterator():
        header = pickle.loads(r.header)
        for i in r.files:
            out[i] = header
    return out


def each_header(spark: SparkSession, paths: list[str], failed: Callable[[str, LogError], None]) -> list[tuple[str, LogHeader]]:
    """(path, header) of every readable file, in order; `failed` is told of the others and may raise."""

    def attempt(path: str) -> LogHeader | LogError:
        try:
            return sniff(spark, path)
        except LogError as e:
            return e

    if len(paths) > IN_TASKS and (found := sniff_in_tasks(spark, paths)) is not None:
        results = found
    else:
        with ThreadPoolExecutor(READERS) as pool:
            results = list(pool.map(attempt, paths))
    out = []
    for path, got in zip(paths, results, strict=True):
        if isinstance(got, LogError):
            failed(path, got)
        else:
            out.append((path, got))
    return out


def for_spark(path: str) -> str:
    """A path whose glob characters are literal to Spark's reader; local ones from the root, as the JVM's folder may differ."""
    path = os.path.abspath(local_path(path)) if is_local(path) else path
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
