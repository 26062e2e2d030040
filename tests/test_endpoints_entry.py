"""Endpoint options, the driver contract, and every registered query against DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from domus.plans.queries import ORACLE_SQL, QUERIES
from domus.sources.endpoints import KafkaEndpoint

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_kafka_options():
    ep = KafkaEndpoint("broker:9092", "listings", max_offsets_per_trigger=1000, min_partitions=64,
                       options={"kafka.security.protocol": "SASL_SSL"})
    o = ep.read_options()
    assert o["subscribe"] == "listings" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "1000" and o["minPartitions"] == "64"
    assert o["kafka.security.protocol"] == "SASL_SSL"
    w = ep.write_options()
    assert w == {"kafka.bootstrap.servers": "broker:9092", "topic": "listings", "kafka.security.protocol": "SASL_SSL"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "propertycode"


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) and QUERIES.items() <= E.queries().items()
    assert E.oracle_sql().keys() <= E.queries().keys()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat() + " 00:00:00"
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


# Queries whose plan may gather rows into one partition, and why that stays bounded.
BOUNDED_SINGLE_PARTITION = {
    "limit_one": "count over at most one row",
    "data_arrived": "count over at most one row per scan task",
    "result_pages": "prefix sum over one count row per range",
    "batch_metrics": "sum over one row per committed batch",
}
FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                   "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_NODES if n in plan]
    assert "SinglePartition" not in plan or name in BOUNDED_SINGLE_PARTITION
    got = df.toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_spread_deals_only_where_asked(spark):
    from domus.sources.tables import spread
    narrow = spark.range(0, 1000, numPartitions=1)
    assert spread(narrow) is narrow
    assert sorted(r[0] for r in spread(narrow, 8).collect()) == list(range(1000))
    assert "RoundRobin" in spread(narrow, 8)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]"])
def test_no_machine_folder_on_a_cluster(master):
    from types import SimpleNamespace

    from domus.session import checkpoint_root
    bare = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(bare)


def test_create_table_and_append(spark, tmp):
    from domus import schemas as S
    from domus.sinks.tables import append, create_table
    create_table(spark, "published_listings_t", tmp + "/pub")
    create_table(spark, "published_listings_t", tmp + "/pub")  # idempotent
    assert spark.table("published_listings_t").columns == S.struct(S.PUBLISHED_DDL).fieldNames()
    row = spark.createDataFrame([("a", 70.0, 1200.0, 17.0, 2, 1, "1", True, "flat", True, True, 38.3, -0.4,
                                  "d", "flat", "u", "k1")], S.PUBLISHED_DDL)
    append(row, "parquet", tmp + "/pub")
    append(row, "parquet", tmp + "/pub")
    spark.catalog.refreshTable("published_listings_t")
    assert spark.table("published_listings_t").count() == 2
    spark.sql("DROP TABLE published_listings_t")


TIME_QUERIES = ["since_bucket", "pull_gate", "marker_text", "marker_cycle", "recency_window", "data_arrived",
                "file_name_parse", "page_explode", "envelope_complete", "newest_page", "full_search"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_time_queries_ignore_the_session_zone(spark, duck, name):
    # The driver's session may run in any zone: results must not move with it.
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = E.queries()[name](spark, SMOKE).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = duck.execute(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)
