"""The runnable jobs end to end: landed pages -> messages -> published table -> search."""

import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from domus import cli
from domus.operators.search import SearchRequest
from domus.streaming import jobs


def _listing(code, price, lat=38.3829, lon=-0.4135, **kw):
    return {"propertyCode": code, "price": price, "size": 70.0, "rooms": 2, "bathrooms": 1,
            "propertyType": "flat", "latitude": lat, "longitude": lon,
            "parkingSpace": {"hasParkingSpace": True}, "detailedType": {"typology": "flat"}, **kw}


def _page(root, date, n, total, elements):
    os.makedirs(root, exist_ok=True)
    doc = {"elementList": elements, "total": len(elements), "totalPages": total, "actualPage": n}
    with open(os.path.join(root, f"response{date}_p_{n}.json"), "w") as f:
        json.dump(doc, f, indent=1)


def _messages(root, text, date="2024-05-21"):
    lines = text.strip().split("\n")
    os.makedirs(root, exist_ok=True)
    n = len(lines)
    pq.write_table(pa.table({"page_date": pa.array([dt.date.fromisoformat(date)] * n), "page_no": pa.array([1] * n, pa.int64()),
                             "pos": pa.array(range(n), pa.int32()), "key": pa.nulls(n, pa.string()), "value": lines}), f"{root}/m.parquet")


def test_pages_to_table_to_search(spark, tmp):
    _page(tmp + "/landing", "2024_05_21", 1, 2, [_listing("1", 1200.0), _listing("2", 1000.0, lat=38.3651, lon=-0.4198)])
    _page(tmp + "/landing", "2024_05_21", 2, 2, [_listing("3", 1300.0), _listing("4", 700.0, lat=38.9)])
    run = jobs.replay_pages_job(spark, tmp + "/landing", tmp + "/manifest", tmp + "/ck1", messages=tmp + "/messages")
    assert run.batches == 1
    assert spark.read.parquet(tmp + "/manifest").count() == 2

    # a re-landed page already in the manifest is skipped; a new page goes through
    _page(tmp + "/landing2", "2024_05_21", 1, 2, [_listing("1", 1.0)])
    _page(tmp + "/landing2", "2024_05_22", 1, 1, [_listing("2", 950.0, lat=38.3651, lon=-0.4198)])
    jobs.replay_pages_job(spark, tmp + "/landing2", tmp + "/manifest", tmp + "/ck1b", messages=tmp + "/messages")

    paths = jobs.PublishPaths(tmp + "/table", tmp + "/ck2", tmp + "/quarantine")
    jobs.publish_job(spark, paths, files=tmp + "/messages")
    table = {r["propertycode"]: r["price"] for r in jobs.published_table(spark, tmp + "/table").collect()}
    assert table == {"1": 1200.0, "2": 950.0, "3": 1300.0, "4": 700.0}

    req = SearchRequest(property_types=("flat",), min_price=500, max_price=1200,
                        center=(38.371622, -0.424756), distance_m=4500)
    page = jobs.search_job(spark, tmp + "/table", req).collect()
    assert [(r["propertycode"], r["distance"]) for r in page] == [("2", "844"), ("1", "1592")]

    # country and operation are searched too (absent in these listings), and so is the page date
    assert jobs.search_job(spark, tmp + "/table", SearchRequest(country="es")).count() == 0
    recent = SearchRequest(since="T", as_of=dt.datetime(2024, 5, 23))
    assert [r["propertycode"] for r in jobs.search_job(spark, tmp + "/table", recent).collect()] == ["2"]
    with pytest.raises(ValueError):
        jobs.search_job(spark, tmp + "/table", recent, published_at="no_such_column")


def test_newest_date_wins_over_eight_pulls_and_the_later_of_a_page(spark, tmp):
    """40 listings on 8 pull dates with pages of unlike sizes, one page with two versions of 25."""
    for day in range(1, 9):
        rows = [_listing(str(i), float(day), description="x" * (day % 3) * 50_000) for i in range(40)]
        _page(tmp + "/landing", f"2024_05_0{9 - day if day < 8 else 9}", 1, 1, [])  # dates without listings
        _page(tmp + "/landing", f"2024_06_0{day}", 1, 2, rows[:30])
        _page(tmp + "/landing", f"2024_06_0{day}", 2, 2, rows[30:])
    twice = [_listing(str(i), 100.0) for i in range(25)] + [_listing(str(i), 200.0) for i in range(25)]
    _page(tmp + "/landing", "2024_06_09", 1, 1, twice)
    jobs.replay_pages_job(spark, tmp + "/landing", tmp + "/manifest", tmp + "/ck1", messages=tmp + "/messages", max_files_per_trigger=7)
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table", tmp + "/ck2"), files=tmp + "/messages", max_files_per_trigger=2)
    got = {r["propertycode"]: r["price"] for r in jobs.published_table(spark, tmp + "/table").collect()}
    assert got == {str(i): 200.0 if i < 25 else 8.0 for i in range(40)}


@pytest.mark.parametrize("fails_after", ["messages", "manifest"])
def test_replay_restarts_without_duplicates(spark, tmp, monkeypatch, fails_after):
    """The replay dies after its message write or after its manifest write; started again on
    the same checkpoint it ends with every element sent once and every page logged once."""
    for n in (1, 2):
        _page(tmp + "/landing", "2024_05_21", n, 2, [_listing(f"{n}-{i}", 1.0) for i in range(40)])
    real = jobs.append_manifest

    def dies(rows, path):
        if fails_after == "manifest":
            real(rows, path)
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "append_manifest", dies)
    with pytest.raises(Exception):
        jobs.replay_pages_job(spark, tmp + "/landing", tmp + "/manifest", tmp + "/ck", messages=tmp + "/messages")
    monkeypatch.setattr(jobs, "append_manifest", real)
    jobs.replay_pages_job(spark, tmp + "/landing", tmp + "/manifest", tmp + "/ck", messages=tmp + "/messages")
    assert spark.read.parquet(tmp + "/messages").count() == 80
    assert spark.read.parquet(tmp + "/manifest").count() == 2


def test_cli_pull_decision_and_search(spark, tmp, capsys):
    assert cli.main(["pull-decision", "--marker", tmp + "/marker", "--now", "2024-05-28 18:29:05", "--advance"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"bucket": "AllTime"}
    cli.main(["pull-decision", "--marker", tmp + "/marker", "--now", "2024-05-31 20:00:00"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"bucket": "W"}

    _messages(tmp + "/messages", json.dumps(_listing("9", 800.0)) + "\n" + "junk\n")
    cli.main(["publish", "--messages", tmp + "/messages", "--table", tmp + "/table",
              "--checkpoint", tmp + "/ck", "--quarantine", tmp + "/q"])
    capsys.readouterr()
    cli.main(["search", "--table", tmp + "/table", "--max-price", "1000", "--center", "38.371622,-0.424756",
              "--distance", "4500"])
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert [(r["propertycode"], r["distance"]) for r in out] == [("9", "1592")]

    cli.main(["land-search", "--table", tmp + "/table", "--landing", tmp + "/landing",
              "--pull-date", "2024-05-21", "--max-price", "1000"])
    capsys.readouterr()
    from domus.sources.pages import read_pages
    (page,) = read_pages(spark, tmp + "/landing", layout="lines").collect()
    assert page["file_name"] == "response2024_05_21_p_1.json" and page["envelope"]["totalPages"] == 1
    assert [json.loads(e)["propertyCode"] for e in page["envelope"]["elementList"]] == ["9"]


def test_cli_parser_broker_options():
    a = cli.build_parser().parse_args(["publish", "--bootstrap-servers", "b:9092", "--topic", "t",
                                       "--table", "x", "--checkpoint", "y", "--kafka-option", "kafka.sasl.mechanism=PLAIN"])
    ep = cli._kafka(a)
    assert ep.read_options()["kafka.sasl.mechanism"] == "PLAIN" and ep.topic == "t"


def test_land_search_pages_round_trip(spark, tmp):
    """Every page of a search lands as one envelope per page (50 each, newest key first);
    the landed pages are complete, and replaying + publishing them rebuilds the same rows."""
    import datetime as dt

    from domus.operators.pages import page_set_status
    from domus.sources.pages import read_pages

    rows = [_listing(f"{i:04d}", 500.0 + i, rooms=i % 4, description=f"d{i}", url=f"u/{i}",
                     parkingSpace=None if i % 7 == 0 else {"hasParkingSpace": i % 2 == 0})
            for i in range(120)]
    _messages(tmp + "/messages", "\n".join(json.dumps(r) for r in rows))
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table", tmp + "/ck"), files=tmp + "/messages")
    before = jobs.published_table(spark, tmp + "/table")

    jobs.land_search_job(spark, tmp + "/table", SearchRequest(min_price=500.0), tmp + "/landing",
                         dt.date(2024, 5, 21))
    pages = read_pages(spark, tmp + "/landing", layout="lines")
    status = page_set_status(pages).first()
    assert (status["pages"], status["items"], status["total_pages"], status["complete"]) == (3, 120, 3, True)
    first = pages.filter("page_no = 1").first()["envelope"]["elementList"]
    assert [json.loads(e)["propertyCode"] for e in first[:2]] == ["0119", "0118"]  # key order, descending

    jobs.replay_pages_job(spark, tmp + "/landing", tmp + "/manifest", tmp + "/ck2",
                          messages=tmp + "/messages2", layout="lines")
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table2", tmp + "/ck3"), files=tmp + "/messages2")
    after = jobs.published_table(spark, tmp + "/table2")
    assert after.count() == 120
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0

    # compaction: one row per key in a new folder, same table, and publishing continues there
    assert cli.main(["compact", "--table", tmp + "/table2", "--out", tmp + "/table3"]) == 0
    assert jobs.published_table(spark, tmp + "/table3").count() == 120
    compacted = jobs.published_table(spark, tmp + "/table3")
    assert compacted.exceptAll(after).count() == 0 and after.exceptAll(compacted).count() == 0
    _messages(tmp + "/messages3", json.dumps(_listing("0005", 9999.0)) + "\n", date="2024-05-22")
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table3", tmp + "/ck4"), files=tmp + "/messages3")
    latest = {r["propertycode"]: r["price"] for r in jobs.published_table(spark, tmp + "/table3").collect()}
    assert len(latest) == 120 and latest["0005"] == 9999.0 and latest["0006"] == 506.0


def test_snapshot_search_matches_and_reaches_the_scan(spark, tmp, capsys):
    """A snapshot of the keyed table answers the same search with no aggregation or shuffle,
    and the radius box and price range are pushed into the Parquet scan."""
    rows = [_listing(f"{i:03d}", 500.0 + 7 * i, lat=38.30 + 0.001 * i, lon=-0.50 + 0.0008 * i)
            for i in range(200)]
    _messages(tmp + "/messages", "\n".join(json.dumps(r) for r in rows))
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table", tmp + "/ck"), files=tmp + "/messages")
    assert cli.main(["snapshot", "--table", tmp + "/table", "--out", tmp + "/snap"]) == 0
    capsys.readouterr()
    req = SearchRequest(min_price=600.0, max_price=1500.0, center=(38.371622, -0.424756), distance_m=4500,
                        max_items=50)
    from_log = jobs.search_job(spark, tmp + "/table", req).collect()
    snap = jobs.search_job(spark, tmp + "/snap", req, snapshot=True)
    assert snap.collect() == from_log and len(from_log) > 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = jobs.search_job(spark, tmp + "/snap", req, snapshot=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert "GreaterThanOrEqual(latitude" in plan and "LessThanOrEqual(price" in plan


def test_pull_job_gates_on_the_marker_and_advances_after_landing(spark, tmp, capsys):
    _messages(tmp + "/messages", "\n".join(json.dumps(_listing(f"{i:02d}", 600.0 + i)) for i in range(60)) + "\n")
    jobs.publish_job(spark, jobs.PublishPaths(tmp + "/table", tmp + "/ck"), files=tmp + "/messages")
    from domus.sources.pages import read_pages

    def pull(now):
        cli.main(["pull", "--table", tmp + "/table", "--landing", tmp + "/landing", "--marker", tmp + "/marker",
                  "--now", now, "--max-price", "1000"])
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert pull("2024-05-20 08:00:00") == {"bucket": "AllTime", "pulled": True}
    assert read_pages(spark, tmp + "/landing", layout="lines").count() == 2  # 60 hits, 50 per page
    assert pull("2024-05-20 20:00:00") == {"bucket": "NoPull", "pulled": False}
    assert pull("2024-05-23 09:00:00") == {"bucket": "W", "pulled": True}
    dates = {r["page_date"].isoformat() for r in read_pages(spark, tmp + "/landing", layout="lines").collect()}
    assert dates == {"2024-05-20", "2024-05-23"}
    assert pull("2024-07-01 09:00:00") == {"bucket": None, "pulled": False}  # beyond 30 days: skip
    assert pull("2024-07-01 09:00:00") == {"bucket": None, "pulled": False}  # marker did not move


def test_snapshot_splits_a_hot_location(spark, tmp):
    """A third of all listings at one point: the snapshot still spreads them over files."""
    from pyspark.sql import functions as F

    from domus.sinks.tables import write_snapshot
    n = 3000
    rows = spark.range(0, n).select(
        F.col("id").cast("string").alias("propertycode"),
        F.when(F.col("id") % 3 == 0, F.lit(38.37)).otherwise(38.0 + F.col("id") / 10000).alias("latitude"),
        F.when(F.col("id") % 3 == 0, F.lit(-0.42)).otherwise(-0.5 + F.col("id") / 10000).alias("longitude"))
    write_snapshot(rows, tmp + "/snap", partitions=8)
    snap = spark.read.parquet(tmp + "/snap")
    per_file = [r[1] for r in snap.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert snap.count() == n and len(per_file) >= 6 and max(per_file) < n / 3
