"""Landed page file names: build from (date, page) and parse back, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from domus.schemas import PAGE_FILE_DATE_FORMAT, PAGE_FILE_PATTERN, PAGE_FILE_PREFIX


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def page_file_name(page_date, page_no) -> Column:
    """response<yyyy_MM_dd>_p_<n>.json"""
    return F.concat(
        F.lit(PAGE_FILE_PREFIX),
        F.date_format(_c(page_date), PAGE_FILE_DATE_FORMAT),
        F.lit("_p_"),
        _c(page_no).cast("string"),
        F.lit(".json"),
    )


def parse_page_file_name(name) -> tuple[Column, Column]:
    """(page_date DATE, page_no BIGINT) from a file name; NULLs when it does not parse.

    ``regexp_extract`` yields '' on no match and ``try_to_date`` turns that into NULL,
    so a stray object in the landing folder never fails the job.
    """
    n = _c(name)
    date_txt = F.regexp_extract(n, PAGE_FILE_PATTERN, 1)
    page_txt = F.regexp_extract(n, PAGE_FILE_PATTERN, 2)
    page_date = F.try_to_date(date_txt, PAGE_FILE_DATE_FORMAT)
    page_no = F.when(page_txt != "", page_txt.try_cast("bigint"))
    return page_date, page_no
