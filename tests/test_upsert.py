"""Last write wins per key, change log replay, compaction, and the skew-safe plan."""

import pytest

from domus.operators.upsert import latest_per_key
from domus.sinks.changelog import ChangeLog

COLS = "propertycode string, price double, rooms int, seq long"


def test_same_key_twice_in_one_batch_newest_wins(spark):
    df = spark.createDataFrame([("a", 1.0, 1, 1), ("a", 2.0, 2, 2), ("b", 5.0, 1, 1)], COLS)
    out = {r["propertycode"]: r for r in latest_per_key(df, "propertycode", ["seq"]).collect()}
    assert out["a"]["price"] == 2.0 and out["b"]["price"] == 5.0


def test_newer_row_with_nulls_replaces_in_full(spark):
    df = spark.createDataFrame([("a", 1.0, 3, 1), ("a", None, None, 2)], COLS)
    r = latest_per_key(df, "propertycode", ["seq"]).first()
    assert r["price"] is None and r["rooms"] is None


def test_brute_force_equivalence(spark):
    import random
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 30)}", rnd.random(), rnd.randint(0, 5), i) for i in range(2000)]
    rows += [("hot", float(i), i % 7, 10_000 + i) for i in range(3000)]  # one key holds most rows
    df = spark.createDataFrame(rows, COLS)
    got = {r["propertycode"]: tuple(r) for r in latest_per_key(df, "propertycode", ["seq"]).collect()}
    best = {}
    for r in rows:
        if r[0] not in best or r[3] > best[r[0]][3]:
            best[r[0]] = r
    assert got == {k: v for k, v in best.items()}


def test_plan_combines_partially_before_shuffle(spark):
    df = spark.createDataFrame([("a", 1.0, 1, 1)], COLS)
    plan = latest_per_key(df, "propertycode", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def _log(tmp):
    return ChangeLog(tmp + "/log", key="propertycode", order=["seq"])


def test_same_key_in_two_batches(spark, tmp):
    log = _log(tmp)
    log.write_batch(spark.createDataFrame([("a", 1.0, 1, 1), ("b", 1.0, 1, 1)], COLS), 0, "r")
    log.write_batch(spark.createDataFrame([("a", 9.0, 2, 0)], COLS), 1, "r")  # arrives later, but is the older version
    out = {r["propertycode"]: r["price"] for r in log.latest(spark).collect()}
    assert out == {"a": 1.0, "b": 1.0}


def test_replaying_a_batch_id_changes_nothing(spark, tmp):
    log = _log(tmp)
    b0 = spark.createDataFrame([("a", 1.0, 1, 1), ("b", 2.0, 1, 1)], COLS)
    b1 = spark.createDataFrame([("a", 3.0, 1, 2)], COLS)
    log.write_batch(b0, 0, "r")
    log.write_batch(b1, 1, "r")
    before = sorted(map(tuple, log.latest(spark).collect()))
    log.write_batch(b0, 0, "r")  # at-least-once redelivery of batch 0
    assert sorted(map(tuple, log.latest(spark).collect())) == before
    assert log.read_log(spark).count() == 3


def test_versions_are_ordered_by_their_columns_across_runs(spark, tmp):
    _log(tmp).write_batch(spark.createDataFrame([("a", 1.0, 1, 5), ("b", 1.0, 1, 1)], COLS), 7, "1")
    _log(tmp).write_batch(spark.createDataFrame([("a", 2.0, 1, 1), ("b", 2.0, 1, 2)], COLS), 0, "2")
    assert {r["propertycode"]: r["price"] for r in _log(tmp).latest(spark).collect()} == {"a": 1.0, "b": 2.0}


def _prices(spark, log):
    got = [(r["propertycode"], r["price"]) for r in log.latest(spark).collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def _put(spark, log, batch, run, *rows):
    log.write_batch(spark.createDataFrame([(k, p, 1, s) for k, p, s in rows], COLS), batch, run)


def test_compaction_keeps_latest_and_new_folder(spark, tmp):
    log = _log(tmp)
    log.write_batch(spark.createDataFrame([("a", 1.0, 1, 1)], COLS), 0, "r")
    log.write_batch(spark.createDataFrame([("a", 2.0, 1, 1), ("c", 3.0, 1, 1)], COLS), 1, "r")
    new = log.compact(spark, tmp + "/log2")
    copied = ChangeLog(new, key="propertycode", order=["seq"])
    assert copied.read_log(spark).count() == 0  # all in the base
    assert sorted(map(tuple, copied.latest(spark).collect())) == sorted(map(tuple, log.latest(spark).collect()))
    with pytest.raises(ValueError):
        log.compact(spark, tmp + "/log2")  # never overwrite a folder that may be read


def test_a_commit_between_the_steps_of_a_compaction_is_not_lost(spark, tmp):
    log = _log(tmp)
    _put(spark, log, 0, "r", ("a", 1.0, 1), ("b", 1.0, 1))
    at = log.snapshot(spark)
    _put(spark, log, 1, "r", ("a", 2.0, 2), ("c", 2.0, 2))  # committed while the compaction runs
    assert log.compact_in_place(spark, at) == 1
    assert _prices(spark, log) == {"a": 2.0, "b": 1.0, "c": 2.0}
    assert log.read_log(spark).count() == 2  # batch 0 is covered, batch 1 is not
    at = log.snapshot(spark)
    _put(spark, log, 2, "r", ("d", 4.0, 4))
    other = _log(tmp)
    other.compact_in_place(spark)  # a second compaction overtakes the first
    assert log.compact_in_place(spark, at) == 2
    assert _prices(spark, log) == {"a": 2.0, "b": 1.0, "c": 2.0, "d": 4.0}


def test_compaction_beside_a_running_writer(spark, tmp):
    """Batches logged before, during and after compactions, in several runs and out of order: the
    table is always the newest version per key, and covered batches are not read again."""
    log, rows = _log(tmp), []

    def write(batch, run, *new):
        rows.extend(new)
        _put(spark, log, batch, run, *new)

    def want():
        best = {}
        for k, p, s in rows:
            if k not in best or s >= best[k][1]:
                best[k] = (p, s)
        return {k: p for k, (p, _) in best.items()}

    write(0, "1", ("a", 1.0, 1), ("b", 1.0, 5))
    write(3, "x", ("a", 2.0, 2))
    assert log.compact_in_place(spark) == 1 and _prices(spark, log) == want()
    write(1, "x", ("b", 9.0, 4), ("c", 3.0, 1))  # a lower batch than the covered one
    assert _prices(spark, log) == want() and log.read_log(spark).count() == 2
    write(0, "2", ("a", 3.0, 3))
    assert log.compact_in_place(spark) == 2 and _prices(spark, log) == want()
    assert log.read_log(spark).count() == 0
    again = _log(tmp)  # a restarted writer replays a covered batch: it is known
    _put(spark, again, 3, "x", ("a", 2.0, 2))
    assert _prices(spark, log) == want() and log.read_log(spark).count() == 0
    assert log.compact_in_place(spark) == 2  # nothing to do


def test_half_a_batch_is_never_seen(spark, tmp, monkeypatch):
    log = _log(tmp)
    _put(spark, log, 0, "r", ("a", 1.0, 1))

    def lost(*_, **__):
        raise RuntimeError("the writer is gone before its commit")

    with monkeypatch.context() as m:
        m.setattr(ChangeLog, "_commit", lost)
        with pytest.raises(RuntimeError):
            _put(spark, log, 1, "r", ("a", 9.0, 9), ("b", 9.0, 9))
    assert _prices(spark, _log(tmp)) == {"a": 1.0}  # its files are there, its commit is not
    _put(spark, _log(tmp), 1, "r", ("a", 2.0, 2), ("b", 2.0, 2))
    assert _prices(spark, _log(tmp)) == {"a": 2.0, "b": 2.0}
    with monkeypatch.context() as m:  # a compaction that dies before its commit changes nothing
        m.setattr(ChangeLog, "_commit", lost)
        with pytest.raises(RuntimeError):
            log.compact_in_place(spark)
    assert _prices(spark, _log(tmp)) == {"a": 2.0, "b": 2.0}
    assert log.compact_in_place(spark) == 1 and _prices(spark, log) == {"a": 2.0, "b": 2.0}


def test_readers_see_whole_batches_beside_a_writer_and_a_compactor(spark, tmp):
    """Every batch gives all keys one new version: a reader never sees two versions at once, and no
    version goes back, while another thread writes and a third one compacts."""
    import threading

    keys, last, errors = [f"k{i}" for i in range(20)], 10, []
    _put(spark, _log(tmp), 0, "r", *[(k, 0.0, 0) for k in keys])
    done = threading.Event()

    def guarded(work):
        def run():
            try:
                work()
            except Exception as e:  # noqa: BLE001 - told to the test
                errors.append(e)
        return threading.Thread(target=run)

    def write():
        log = _log(tmp)
        try:
            for b in range(1, last + 1):
                _put(spark, log, b, "r", *[(k, float(b), b) for k in keys])
        finally:
            done.set()

    def compact():
        while not done.is_set():
            _log(tmp).compact_in_place(spark)

    workers = [guarded(write), guarded(compact)]
    for w in workers:
        w.start()
    seen = []
    while not done.is_set():
        got = _prices(spark, _log(tmp))
        assert set(got) == set(keys) and len(set(got.values())) == 1, got
        seen.append(got["k0"])
    for w in workers:
        w.join()
    assert not errors and seen == sorted(seen)
    assert set(_prices(spark, _log(tmp)).values()) == {float(last)}


def test_empty_tables(spark, tmp):
    log = ChangeLog(tmp + "/none", key="propertycode", order=["seq"], ddl=COLS)
    assert log.latest(spark).count() == 0 and log.latest(spark).columns == ["propertycode", "price", "rooms", "seq"]
    with pytest.raises(ValueError):
        ChangeLog(tmp + "/none", key="propertycode", order=["seq"]).latest(spark)
    _put(spark, log, 0, "r")  # a batch without rows
    assert log.latest(spark).count() == 0
    assert log.compact_in_place(spark) == 1 and log.latest(spark).count() == 0
    _put(spark, log, 1, "r", ("a", 1.0, 1), (None, 5.0, 1))  # a row without a key is not stored
    assert _prices(spark, log) == {"a": 1.0}
    assert log.compact_in_place(spark) == 2 and _prices(spark, log) == {"a": 1.0}


def test_base_is_read_without_an_exchange_and_rewritten_by_bucket(spark, tmp):
    log = ChangeLog(tmp + "/log", key="propertycode", order=["seq"], buckets=8)
    _put(spark, log, 0, "r", *[(f"k{i}", 1.0, 1) for i in range(200)])
    log.compact_in_place(spark)
    first = log.snapshot(spark).gens
    assert len(first) == 8 and len(set(first)) == 1
    _put(spark, log, 1, "r", ("k7", 2.0, 2))
    plan = log.latest(spark)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and plan.count("Exchange ") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
    before, changes = plan.split("Exchange ")
    assert "domus_base" in before and "domus_base" not in changes  # only the changes move
    log.compact_in_place(spark)
    second = log.snapshot(spark).gens
    assert sum(a != b for a, b in zip(first, second)) == 1  # one bucket was rewritten
    assert _prices(spark, log) == {**{f"k{i}": 1.0 for i in range(200)}, "k7": 2.0}
    plan = log.latest(spark).filter("price > 1")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "GreaterThan(price,1.0)" in plan
    for n in range(2, 8):  # superseded buckets are dropped once they are half of the files
        _put(spark, log, n, "r", *[(f"k{i}", float(n), n) for i in range(n, 200, 3)])
        log.compact_in_place(spark)
    at = log.snapshot(spark)
    assert at.written <= 2 * at.buckets
    assert _prices(spark, log) == {f"k{i}": float(max([n for n in range(2, 8) if i >= n and (i - n) % 3 == 0], default=2 if i == 7 else 1))
                                   for i in range(200)}


def test_columns_added_later_and_odd_run_names(spark, tmp):
    log = ChangeLog(tmp + "/it's a=b", key="k", order=["seq"])
    log.write_batch(spark.createDataFrame([("a", 1)], "k string, seq long"), 0, "x/y=z 1")
    log.compact_in_place(spark)
    log.write_batch(spark.createDataFrame([("b", 2, "new")], "k string, seq long, more string"), 1, "x/y=z 1")
    want = {("a", 1, None), ("b", 2, "new")}
    assert {tuple(r) for r in log.latest(spark).collect()} == want
    log.compact_in_place(spark)
    assert {tuple(r) for r in log.latest(spark).collect()} == want


def test_latest_keeps_column_types(spark, tmp):
    log = _log(tmp)
    log.write_batch(spark.createDataFrame([("a", 1.0, 1, 1)], COLS), 0, "r")
    assert dict(log.latest(spark).dtypes) == {"propertycode": "string", "price": "double", "rooms": "int", "seq": "bigint"}


def test_change_log_with_random_batches_replays_and_a_hot_key(spark, tmp):
    """Random micro-batches, one key holding a third of all versions, and redelivered
    batch ids (at-least-once): the keyed table equals the last version of every key."""
    import random

    rng = random.Random(3)
    rows = []
    for seq in range(1500):
        key = "hot" if seq % 3 == 0 else f"k{rng.randrange(200)}"
        rows.append((key, seq, None if rng.random() < 0.1 else float(rng.randrange(1000))))
    batches, i = [], 0
    while i < len(rows):
        n = rng.randint(50, 300)
        batches.append(rows[i:i + n])
        i += n
    log = ChangeLog(tmp + "/log", key="k", order=["seq"])
    for b, chunk in enumerate(batches):
        df = spark.createDataFrame(chunk, "k string, seq long, v double")
        log.write_batch(df, b, "r")
        if rng.random() < 0.3:  # the same batch delivered again after a failure
            log.write_batch(df, b, "r")
    want = {}
    for k, seq, v in rows:
        want[k] = (seq, v)
    got = {r["k"]: (r["seq"], r["v"]) for r in log.latest(spark).collect()}
    assert got == want
    assert log.read_log(spark).count() == sum(len({r[0] for r in c}) for c in batches)  # no duplicates
