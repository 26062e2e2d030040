"""Declared schemas. Nothing is inferred: decode always runs against these."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType, _parse_datatype_string

# ---------------------------------------------------------------------------------------
# Field names, order and types of the listing message, the published
# projection and the landed page envelope. They must equal the upstream payload and
# sink table exactly for decode and publish to give the same rows.
# ---------------------------------------------------------------------------------------
LISTING_DDL = (
    "address STRING, bathrooms BIGINT, country STRING, description STRING, "
    "detailedType MAP<STRING,STRING>, distance STRING, district STRING, exterior BOOLEAN, "
    "externalReference STRING, floor STRING, has360 BOOLEAN, has3DTour BOOLEAN, "
    "hasLift BOOLEAN, hasPlan BOOLEAN, hasStaging BOOLEAN, hasVideo BOOLEAN, "
    "latitude DOUBLE, longitude DOUBLE, municipality STRING, newDevelopment BOOLEAN, "
    "numPhotos BIGINT, operation STRING, parkingSpace MAP<STRING,BOOLEAN>, price DOUBLE, "
    "priceByArea DOUBLE, priceInfo MAP<STRING,MAP<STRING,DOUBLE>>, propertyCode STRING, "
    "propertyType STRING, province STRING, rooms BIGINT, showAddress BOOLEAN, size DOUBLE, "
    "status STRING, suggestedTexts MAP<STRING,STRING>, thumbnail STRING, "
    "topNewDevelopment BOOLEAN, topPlus BOOLEAN, url STRING"
)

# Published columns in sink order; rooms/bathrooms are 32-bit in the sink.
PUBLISHED_DDL = (
    "address STRING, size DOUBLE, price DOUBLE, pricebyarea DOUBLE, rooms INT, "
    "bathrooms INT, floor STRING, haslift BOOLEAN, propertytype STRING, "
    "parkingspace BOOLEAN, exterior BOOLEAN, latitude DOUBLE, longitude DOUBLE, "
    "description STRING, typology STRING, url STRING, propertycode STRING"
)
PUBLISHED_KEY = "propertycode"

# Envelope of one landed search-result page. elementList is carried as raw JSON strings
# so that unknown fields and explicit nulls of each element survive the explode.
ENVELOPE_DDL = (
    "elementList ARRAY<STRING>, total BIGINT, totalPages BIGINT, actualPage BIGINT, "
    "itemsPerPage BIGINT, numPaginations BIGINT, summary ARRAY<STRING>, alertName STRING, "
    "totalAppliedFilters BIGINT, lowerRangePosition BIGINT, upperRangePosition BIGINT, "
    "paginable BOOLEAN"
)
# Landed file name: response<yyyy_MM_dd>_p_<n>.json
PAGE_FILE_PREFIX = "response"
PAGE_FILE_DATE_FORMAT = "yyyy_MM_dd"
PAGE_FILE_PATTERN = r"^response(\d{4}_\d{2}_\d{2})_p_(\d+)\.json$"
# Last-pull marker text format.
MARKER_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"
MANIFEST_DDL = "page_date DATE, file_name STRING, processed_at TIMESTAMP"
PAGE_RUNS_DDL = "page_date DATE, first_page BIGINT, last_page BIGINT, total_pages BIGINT"
MANIFEST_BITS_DDL = "page_date DATE, bucket BIGINT, bits BINARY"
# Kept beside the published columns in the keyed table, for searches: listing fields, and the
# date of the page a version came from.
BESIDE_DDL = "country STRING, operation STRING"
RECENCY = "page_date"
MARKER_DDL = "pulled_at TIMESTAMP"


@lru_cache(maxsize=None)
def struct(ddl: str) -> StructType:
    """DDL text -> StructType (needs an active session; parsed once per DDL)."""
    return _parse_datatype_string(ddl)


def with_corrupt_column(schema: StructType) -> StructType:
    """The schema plus the string column PERMISSIVE decode fills with the raw bad record."""
    if CORRUPT_COLUMN in schema.fieldNames():
        return schema
    return StructType(list(schema.fields)).add(CORRUPT_COLUMN, "string", True)


def subset(schema: StructType, names: list[str]) -> StructType:
    """Narrow a decode schema to the fields a plan reads (JSON keys are case-sensitive)."""
    keep = set(names)
    return StructType([f for f in schema.fields if f.name in keep])
