"""Field states against Python's json, and the counts that travel with a batch's commit."""

import json
import shutil
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from domus import schemas as S
from domus.operators.field_report import field_report
from domus.operators.search import SearchRequest
from domus.sinks.tables import write_messages
from domus.streaming import jobs

FITS = {"price": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool), "rooms": lambda v: isinstance(v, int) and not isinstance(v, bool),
        "hasLift": lambda v: isinstance(v, bool),
        "parkingSpace": lambda v: isinstance(v, dict) and all(x is None or isinstance(x, bool) for x in v.values())}
VALUES = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.just(2.5), st.just("x"), st.just("3"), st.just({"a": True}), st.just({"a": 1}), st.just({}))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.dictionaries(st.sampled_from(sorted(FITS)), VALUES), st.just("{bad"), st.none(), st.just("[1]"), st.just("7"), st.just("")),
                min_size=1, max_size=12))
def test_states(spark, messages):
    texts = [json.dumps(m) if isinstance(m, dict) else m for m in messages]
    want = Counter()
    for m in messages:
        if not isinstance(m, dict):
            want[None, "malformed"] += 1
            continue
        for f, fits in FITS.items():
            want[f, "absent" if f not in m else "null" if m[f] is None else "present" if fits(m[f]) else "wrong type"] += 1
    got = field_report(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    fields = S.struct(S.LISTING_DDL).fieldNames()
    assert len(fields) == 38
    ok = sum(isinstance(m, dict) for m in messages)
    assert Counter({(r.field, r.status): r.messages for r in got if r.field is None or r.field in FITS}) == want
    assert all(r.status == "absent" and r.messages == ok for r in got if r.field and r.field not in FITS)


def _message(k, **more):
    return json.dumps({"propertyCode": f"c{k}", "price": float(k), **more})


def test_metrics_travel_with_the_commit_and_survive_a_replay(spark, tmp):
    paths = jobs.PublishPaths(tmp + "/table", tmp + "/ck", tmp + "/q")
    batches = [[_message(1), _message(2, rooms="two"), "{cut"], [_message(3), "{}", _message(4, price="x")]]
    for day, rows in enumerate(batches, 1):
        df = spark.createDataFrame([(v, f"2024-01-0{day}") for v in rows], "value string, page_date string")
        write_messages(df.withColumn("page_date", df.page_date.cast("date")).coalesce(1), path=tmp + "/messages")
        jobs.publish_job(spark, paths, files=tmp + "/messages")
    want = {(3, 2, 1, "2024-01-01"), (3, 1, 1, "2024-01-02")}
    got = lambda: {(r.decoded, r.flagged, r.quarantined, str(r.newest)) for r in jobs.batch_metrics(spark, tmp + "/table").collect()}
    assert got() == want
    shutil.rmtree(tmp + "/ck/commits")  # Spark forgets that both batches ended and runs the last again
    jobs.publish_job(spark, paths, files=tmp + "/messages")
    assert got() == want and jobs.published_table(spark, tmp + "/table").count() == 4
    jobs.compact_job(spark, tmp + "/table")
    assert got() == want


def test_jobs_on_tables_without_rows(spark, tmp):
    """Not yet written, and a first batch whose rows are all quarantined: searches are empty."""
    write_messages(spark.createDataFrame([("{cut",), ("{}",)], "value string"), path=tmp + "/messages")
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/junk", tmp + "/ck", tmp + "/q"), files=tmp + "/messages")
    for n, table in enumerate((tmp + "/none", tmp + "/junk")):
        assert jobs.published_table(spark, table).count() == 0
        assert jobs.search_job(spark, table, SearchRequest(country="es", min_price=1.0)).count() == 0
        jobs.compact_job(spark, table)
        assert jobs.published_table(spark, table, beside=True).count() == 0
        jobs.snapshot_job(spark, table, f"{tmp}/snap{n}")
        assert spark.read.parquet(f"{tmp}/snap{n}").count() == 0
        jobs.land_search_job(spark, table, SearchRequest(), f"{tmp}/land{n}", __import__("datetime").date(2024, 1, 1))


def test_named_and_line_layouts_land_the_same_pages(spark, tmp):
    import datetime as dt

    from domus.sources.pages import read_pages

    write_messages(spark.createDataFrame([(_message(k),) for k in range(120)], "value string"), path=tmp + "/messages")
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table", tmp + "/ck"), files=tmp + "/messages")
    pages = []
    for layout in ("lines", "named"):
        jobs.land_search_job(spark, tmp + "/table", SearchRequest(), f"{tmp}/{layout}", dt.date(2024, 1, 1), layout=layout)
        pages.append(sorted(map(str, read_pages(spark, f"{tmp}/{layout}", layout=layout).collect())))
    assert pages[0] == pages[1] and len(pages[0]) == 3


@pytest.mark.parametrize("text", [None, "", "nul", "[{}]"])
def test_malformed_alone(spark, text):
    got = field_report(spark.createDataFrame([(text,)], "value string")).collect()
    assert [(r.field, r.status, r.messages) for r in got] == [(None, "malformed", 1)]


def test_a_message_is_parsed_once_each_way_and_the_input_is_dealt(spark):
    from domus.plans.queries import QUERIES

    df = QUERIES["field_report"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # a parse per field and message took 38 times as long; part is one split, so one task did it all
    assert plan.count("from_json") <= 1 and plan.count("parse_json") <= 1, plan
    assert "RepartitionByExpression" in plan or "Repartition " in plan


def test_states_by_a_column(spark):
    rows = [("a", '{"price":1.0}'), ("a", "{bad"), ("b", '{"price":"x","other":1}'), (None, '{"price":null}'), (None, "{}")]
    got = field_report(spark.createDataFrame(rows, "source string, value string"), ddl="price DOUBLE, rooms BIGINT", by=["source"]).collect()
    assert {tuple(r) for r in got} == {("a", "price", "present", 1), ("a", "rooms", "absent", 1), ("a", None, "malformed", 1),
                                       ("b", "price", "wrong type", 1), ("b", "rooms", "absent", 1),
                                       (None, "price", "null", 1), (None, "price", "absent", 1), (None, "rooms", "absent", 2)}
