import hypothesis.strategies as st
from hypothesis import given, settings

from domus.llm import merkle, queries

SCHEMA = "archive string, offset long, payload string, node long, digest string"


def _frame(spark, rows):
    return merkle.digested(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA))


def brute(a, b):
    def places(rows):
        out = {}
        for arc, off, pay in rows:
            out.setdefault((arc or "", -1 if off is None else off), []).append((off, pay))
        return {k: sorted(v, key=str) for k, v in out.items()}
    x, y = places(a), places(b)
    return {(*k, "missing" if k not in y else "extra" if k not in x else "corrupt")
            for k in x.keys() | y.keys() if x.get(k) != y.get(k)}


def _found(spark, a, b, **how):
    return {(r.archive, r.offset, r.state) for r in merkle.audit(_frame(spark, a), _frame(spark, b), **how).collect()}


def test_damage_of_every_kind_is_located(spark):
    a = [("w1", i * 70, f"p{i}") for i in range(400)] + [("w2", 0, ""), (None, None, None), ("w3", 5, "dup"), ("w3", 5, "dup")]
    b = [r for r in a if r[1] != 70] + [("w4", 10 ** 6, "new"), ("w1", 1, "odd")]
    b = [(x, y, "damaged" if y == 7000 else z) for x, y, z in b]
    b.remove(("w3", 5, "dup"))
    b[b.index(("w2", 0, ""))] = ("w2", 0, None)
    assert _found(spark, a, b, range_bytes=256, fanout=4) == brute(a, b)
    assert _found(spark, a, a) == set() and _found(spark, [], []) == set()
    assert _found(spark, a, [], range_bytes=256) == brute(a, [])


@settings(max_examples=4, deadline=None)
@given(st.data())
def test_random_replicas(spark, data):
    row = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3000)), st.sampled_from(["x", "y", None]))
    a = data.draw(st.lists(row, max_size=30))
    b = [r for r in a if data.draw(st.booleans())] + data.draw(st.lists(row, max_size=4))
    assert _found(spark, a, b, range_bytes=128, fanout=2) == brute(a, b)


def test_query_finds_exactly_the_planted_damage(spark):
    sf = "/root/testdata/sf0.01"
    ids = [r.page_id for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id").collect()]
    want = {(i, "missing") for i in ids if i % 89 == 5} | {(i, "corrupt") for i in ids if i % 97 == 13 and i % 89 != 5}
    got = queries.op1_merkle_fixity(spark, sf).collect()
    assert {(r.page_id, r.state) for r in got} == want and len(got) == len(want)
