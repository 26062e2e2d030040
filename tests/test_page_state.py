"""Missing pages from runs, and the manifest as bitmaps, against plain Python."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from domus import schemas as S
from domus.operators import incremental
from domus.operators import pages as pages_op
from domus.sinks.tables import append_manifest_bitmaps, append_page_runs
from domus.sources.tables import read_dates, read_state

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def _pages(spark, rows):
    frame = spark.createDataFrame(rows, "page_date date, page_no long, total long")
    return frame.select("page_date", F.struct(F.col("page_no").alias("actualPage"), F.col("total").alias("totalPages")).alias("envelope"))


def _gaps(rows):
    out = set()
    for day in {r[0] for r in rows}:
        seen = {n for d, n, _ in rows if d == day}
        total = max((t for d, _, t in rows if d == day and t is not None), default=0)
        lack = [n for n in range(1, total + 1) if n not in seen]
        for n in lack:
            if n - 1 not in lack:
                end = n
                while end + 1 in lack:
                    end += 1
                out.add((day, n, end))
    return out


PAGE = st.tuples(st.sampled_from(DAYS), st.one_of(st.none(), st.integers(-1, 14)), st.one_of(st.none(), st.integers(0, 12)))


@settings(max_examples=6, deadline=None)
@given(st.lists(PAGE, max_size=25), st.integers(0, 25))
def test_missing_ranges(spark, rows, cut):
    runs = pages_op.page_runs(_pages(spark, rows[:cut])).unionByName(pages_op.page_runs(_pages(spark, rows[cut:])))
    assert {tuple(r) for r in pages_op.missing_pages(runs).collect()} == _gaps(rows)


def test_runs_of_a_hot_date_cross_blocks(spark):
    rows = [(DAYS[0], n, 20_000) for n in range(1, 20_001) if n not in (4096, 4097, 9000)] + [(DAYS[1], 1, 2)]
    random.Random(1).shuffle(rows)
    runs = pages_op.page_runs(_pages(spark, rows))
    assert {tuple(r) for r in runs.select("page_date", "first_page", "last_page").collect()} == {
        (DAYS[0], 1, 4095), (DAYS[0], 4098, 8999), (DAYS[0], 9001, 20_000), (DAYS[1], 1, 1)}
    assert {tuple(r) for r in pages_op.missing_pages(runs).collect()} == {(DAYS[0], 4096, 4097), (DAYS[0], 9000, 9000), (DAYS[1], 2, 2)}


def test_a_batch_reads_only_its_dates_and_a_replay_changes_nothing(spark, tmp):
    first = [(d, n, 6) for d in DAYS for n in (1, 2, 5)]
    second = _pages(spark, [(DAYS[1], 3, 6), (DAYS[1], 6, 6)])
    for batch in (_pages(spark, first), second, second):
        append_page_runs(pages_op.page_runs(batch), tmp + "/runs")
    state = read_dates(spark, tmp + "/runs", S.PAGE_RUNS_DDL, second)
    filters = state._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "page_date" in filters and {r[0] for r in state.select("page_date").distinct().collect()} == {DAYS[1]}
    assert {tuple(r) for r in pages_op.missing_pages(state).collect()} == {(DAYS[1], 4, 4)}
    whole = pages_op.missing_pages(read_state(spark, tmp + "/runs", S.PAGE_RUNS_DDL))
    assert {tuple(r) for r in whole.collect()} == {(DAYS[1], 4, 4)} | {(d, *g) for d in (DAYS[0], DAYS[2]) for g in ((3, 4), (6, 6))}


def test_bits_equal_the_anti_join_with_a_manifest_many_times_the_batch(spark, tmp):
    rng = random.Random(2)
    done = {(d, rng.randint(1, 70_000)) for d in DAYS for _ in range(20_000)}
    batch = [(d, rng.randint(-2, 70_100)) for d in (*DAYS, None) for _ in range(200)] + [(DAYS[0], None), (DAYS[0], 32_768), (DAYS[0], 32_769)]
    rows = [(d, n, f"{d}-{n}") for d, n in batch]
    named = lambda r: spark.createDataFrame(r, "page_date date, page_no long, file_name string")
    manifest = named([(d, n, f"{d}-{n}") for d, n in done] + [(None, None, rows[650][2]), (None, None, f"{DAYS[0]}-None")])
    for part in (0, 1, 0):
        append_manifest_bitmaps(incremental.manifest_bitmaps(manifest.filter(F.pmod("page_no", F.lit(2)) == part)), tmp + "/bits")
    pages = named(rows)
    bits = read_dates(spark, tmp + "/bits", S.MANIFEST_BITS_DDL, pages)
    got = incremental.exclude_processed_bits(pages, bits, manifest.filter("page_date IS NULL"))
    want = incremental.exclude_processed(pages, manifest)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert bits.count() <= 3 * 3 * 3  # one bitmap per batch, date and 32,768 pages
    assert incremental.exclude_processed_bits(pages, bits.limit(0)).count() == sum(d is not None and n is not None and n > 0 for d, n in batch)
