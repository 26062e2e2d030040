"""Batch table sources: driver test tables, external tables by format, and small state tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from domus import schemas as S


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``read_table(spark, d, "orders")``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_external(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                  path: str | None = None) -> DataFrame:
    """Any table by format + options (parquet, a catalog table, or a connector's format).

    The sink-table probe of the upstream job is ``read_external(...).limit(1)``.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    return r.load(path) if path else r.load()


def read_state(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A state table (manifest, marker) or an empty frame of the declared schema if absent."""
    schema: StructType = S.struct(ddl)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # no state yet; any other error is one
            return spark.createDataFrame([], schema)
        raise


def read_dates(spark: SparkSession, path: str, ddl: str, batch: DataFrame, col: str = "page_date") -> DataFrame:
    """The rows of a state table, partitioned by date, of the dates that a batch has; other dates are
    not read. The dates of one micro-batch come to the driver."""
    dates = [r[0] for r in batch.select(col).distinct().collect() if r[0] is not None]
    return read_state(spark, path, ddl).filter(F.col(col).isin(dates))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The input dealt round robin over ``partitions`` tasks, where the caller asks for it (an
    unsplittable source before CPU-heavy work); as it is by default."""
    return df.repartition(partitions) if partitions else df


def range_count(df: DataFrame, bytes_per_range: int = 128 * 1024 * 1024) -> int:
    """How many ranges to deal ``df`` into: its rows are counted (a pass that reads only the
    columns its filters need) and weighed by Spark's default width of their types, so the
    number grows with the input and each range stays about ``bytes_per_range``."""
    width = df._jdf.schema().defaultSize()
    return max(1, -(-df.count() * width // bytes_per_range))
