"""Landed page scans (batch and incremental).

Two layouts are read:

* ``named``: what an external puller lands, one JSON document per object named
  ``response<yyyy_MM_dd>_p_<n>.json`` (possibly pretty-printed over many lines). Read with
  ``wholetext`` (one row per file, never split); date and page come from the name.
* ``lines``: what :func:`domus.sinks.tables.write_landing` writes, one envelope per line
  under ``page_date=<d>/`` folders. Read line by line (files split freely); the page
  number is the envelope's ``actualPage`` and the logical file name is rebuilt from both.

Either way the result is ``(file_name, page_date, page_no, envelope)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domus.functions.names import page_file_name, parse_page_file_name
from domus.operators.pages import decode_envelope

PAGE_COLUMNS = ["file_name", "page_date", "page_no", "envelope"]
LAYOUTS = ("named", "lines")


def _shape(df: DataFrame, layout: str) -> DataFrame:
    if layout == "lines":
        pages = decode_envelope(df.withColumn("page_date", F.col("page_date").cast("date")), "value")
        pages = pages.withColumn("page_no", F.col("envelope.actualPage"))
        return pages.withColumn("file_name", page_file_name("page_date", "page_no")).select(*PAGE_COLUMNS)
    d, n = parse_page_file_name("file_name")
    df = df.withColumn("page_date", d).withColumn("page_no", n)
    return decode_envelope(df, "value").select(*PAGE_COLUMNS)


def _reader(r, layout: str, glob: str | None):
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    if layout == "named":
        r = r.option("wholetext", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r


def read_pages(spark: SparkSession, path: str, layout: str = "named", glob: str | None = None) -> DataFrame:
    """A3: every landed page under ``path``."""
    df = _reader(spark.read.format("text"), layout, glob).load(path)
    if layout == "named":
        df = df.withColumn("file_name", F.col("_metadata.file_name"))
    return _shape(df, layout)


def stream_pages(spark: SparkSession, path: str, layout: str = "named",
                 max_files_per_trigger: int | None = None, glob: str | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """A4: the same as a file stream; the checkpoint remembers which files were processed.

    Admission control: ``max_files_per_trigger`` or ``max_bytes_per_trigger`` (one of them).
    """
    r = _reader(spark.readStream.format("text"), layout, glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    df = r.load(path)
    if layout == "named":
        df = df.withColumn("file_name", F.col("_metadata.file_name"))
    return _shape(df, layout)
