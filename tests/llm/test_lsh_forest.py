import random

from domus.llm import graph, lsh_forest, queries


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    """doc_id -> (class, copies, links); rows that share an id are one document."""
    texts = {}
    for i, t in rows:
        if i is not None:
            texts.setdefault(i, set()).add(shingles(t))
    ids = sorted(texts)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = {i: 0 for i in ids}
    copies = {i: 1 for i in ids}
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = ids[x], ids[y]
            if any(s and t and len(s & t) >= threshold * len(s | t) - 1e-9 for s in texts[a] for t in texts[b]):
                links[a] += 1
                links[b] += 1
                if texts[a] == texts[b]:
                    copies[a] += 1
                    copies[b] += 1
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
    return {i: (find(i), copies[i], links[i]) for i in ids}


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, node long, comp string")


def _got(df):
    return {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in df.collect()}


def test_groups_copies_chains_short_and_null_texts(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 9])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = "edit"
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n, "a b"), (n + 1, "a  b\n"), (n + 2, "a"), (n + 3, ""), (n + 4, None), (n + 5, " \t"), (n + 6, "w " * 50_000)]
    rows += [(None, rows[0][1]), (0, rows[0][1])]
    got = _got(lsh_forest.near_duplicates(_frame(spark, rows)))
    want = brute(rows)
    assert {k: v for k, v in got.items() if k is not None} == want
    assert got[None] == (None, 1, 0)


def test_a_group_larger_than_a_block_is_verified_whole(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        text[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(text)))
    docs = _frame(spark, rows)
    members = spark.createDataFrame([(i, 0, 1) for i in range(60)], "node long, comp long, copies long")
    out = lsh_forest.verified(docs, members, block=16)
    counts = {}
    for r in out.filter("b IS NULL").collect():
        counts[r.a] = counts.get(r.a, 0) + r.n
    assert counts == {i: v[2] for i, v in brute(rows).items()}
    assert out.filter("b IS NOT NULL").count() < 60 * 16


def test_no_row_and_no_words(spark):
    assert lsh_forest.near_duplicates(_frame(spark, [(1, None)]).limit(0)).count() == 0
    assert _got(lsh_forest.near_duplicates(_frame(spark, [(1, None), (2, "")]))) == {1: (1, 1, 0), 2: (2, 1, 0)}


def test_depths_reach_the_target():
    assert lsh_forest.recall(lsh_forest.depths()[-1]) >= lsh_forest.TARGET_RECALL
    assert lsh_forest.depths(0.5) == [8]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (501, 500)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500, 501: 500}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert _got(queries.op2_lsh_forest_join(spark, sf)) == brute(rows)


def test_rounds_write_few_tables(spark, monkeypatch):
    names, write = [], graph.store
    monkeypatch.setattr(graph, "store", lambda df, name: names.append(name) or write(df, name))
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in graph.components(chain).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
    rounds = names.count("edges") - 1
    assert rounds > 2 and names.count("step") == rounds and names.count("mapped") == 1
