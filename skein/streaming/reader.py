"""Logs as streams: the batch reader's parsing over Spark's streaming text source, for a header known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.plans.reader import output_names, parsed
from skein.sources.header import LogHeader


def stream_log(spark: SparkSession, folder: str, header: LogHeader, *, inet: bool = True, replace_periods: bool = True) -> DataFrame:
    """A streaming frame of the lines of files that appear in `folder`; all are taken to have `header`'s layout.

    Directive lines in the files are skipped, as in any log. Watermarks, windows and sinks are Spark's own.
    """
    names = output_names(header.fields, replace_periods, False)
    columns = list(zip(names, header.fields, header.types, strict=True))
    return parsed(spark.readStream.text(folder, lineSep="\n"), header, columns, inet)
