import random
import re

from pyspark.sql import functions as F

from domus.llm import queries, templates

ITEM = "A train leaves Lisbon for Porto at 40 km per hour and after 3 hours it meets Maria near the old bridge"
SCHEMA = "doc_id long, text string, item_id string, words int, key double"


def _leaks(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1, None) for i, t in docs], SCHEMA)
    b = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id int")
    return {(r.doc_id, r.item_id): (r.kind, r.n_tokens, r.item_tokens) for r in templates.find_leaks(d, b).collect()}


def test_tokens_are_typed(spark):
    row = spark.createDataFrame([("Ask Tom: 3.5 kg, then 12km, to Rome. Go on. 7 m2",)], "t string").select(templates.tokens(F.col("t")).alias("w"))
    assert row.first().w == ["ask", "\x01ntom", "\x01d3.5", "\x01ukg", "then", "\x01d12", "\x01ukm", "to", "\x01nrome", "go", "on", "\x01d7", "m2"]


def test_exact_reparameterised_inconsistent_and_clean(spark):
    moved = ITEM.replace("Lisbon", "Madrid").replace("40 km", "55 miles").replace("3 hours", "8 days").replace("Maria", "Ana")
    twice = "Take 5 cups of flour then 5 cups of milk and stir the bowl for 5 minutes in the warm kitchen"
    filler = " ".join(random.Random(4).choice("red blue green tree house river".split()) for _ in range(300))
    docs = [(1, f"{filler}. {ITEM} {filler}"), (2, f"{filler}.\n{moved}. {filler}"), (3, filler), (4, None), (5, ""),
            (6, twice.replace("5 cups of flour", "6 cups of flour").replace("5 cups of milk", "7 cups of milk")),
            (7, twice.replace("5", "9")), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (None, ITEM), (1, filler),
            (9, ITEM.upper()), (10, "x " * 100_000 + ITEM), (11, "short whole item here"), (12, "a short whole item here too")]
    items = [(1, ITEM), (2, twice), (3, "9 8 7 6 5 4 3 2 1 0 1 2 3"), (4, None), (5, ""), (6, "Short whole item here"), (None, ITEM), (7, "one two")]
    got = _leaks(spark, docs, items)
    kinds = {k: v[0] for k, v in got.items()}
    assert kinds[1, 1] == kinds[1, None] == kinds[10, 1] == kinds[None, 1] == "exact" and kinds[2, 1] == "reparameterised"
    assert kinds[7, 2] == "reparameterised" and (6, 2) not in kinds
    assert kinds[11, 6] == kinds[12, 6] == "exact"
    assert {d for d, _ in kinds} <= {1, 2, 7, 10, None, 11, 12, 9}
    assert got[1, 1][1] == got[1, 1][2]


def test_empty_tables(spark):
    assert _leaks(spark, [(1, ITEM)], [(1, None)]) == {}
    d = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    b = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert templates.find_leaks(d.limit(0), b).count() == 0 and templates.find_leaks(d, b.limit(0)).count() == 0


def _words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def test_query_against_brute_force(spark):
    """Every plain word window of an item that occurs in a document is a leak, and nothing
    else is as long as these synthetic texts hold no re-parameterised items."""
    sf = "/root/testdata/sf0.01"
    items = {r.item_id: _words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        line = " " + " ".join(_words(r.text)) + " "
        want |= {(r.doc_id, i) for i, w in items.items() if len(w) >= 10 and " " + " ".join(w) + " " in line}
    rows = queries.op3_template_leaks(spark, sf).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in rows}
    texts = {r.doc_id: " " + " ".join(_words(r.text)) + " " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        w = items[r.item_id]
        assert any(" " + " ".join(w[k:k + 6]) + " " in texts[r.doc_id] for k in range(len(w) - 5)), r


WORD_PROBLEM = "Tom has 5 apples and 2 pears. Ann takes 3 apples from him. Tom then buys 4 more. How many are left?"


def test_a_shared_stem_is_no_leak_and_a_whole_copy_is(spark):
    stem = "Which of the following statements best describes the main purpose of the "
    item = stem + "small copper valve that sits behind the upper left engine panel near its cooling fan"
    docs = [(1, f"Quiz one. {stem} red door in our garden shed"), (2, f"Quiz two. {item}."), (3, f"{stem} sea"), (4, f"{stem} moon")]
    # where many documents have the stem, even a short item needs its own words
    short = stem + "tall lighthouse keeper"
    docs += [(10 + i, f"{stem} thing {i}") for i in range(40)] + [(5, f"see {short} now")]
    assert {k for k in _leaks(spark, docs, [(1, item), (2, short)])} == {(2, 1), (5, 2)}
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    assert {r.doc_id for r in templates.without_leaks(d, b).collect()} == {i for i, _ in docs} - {2, 5}


def test_names_openers_and_case(spark):
    cities = "We flew on 3 planes from Rome to Oslo and then rode along the coast road towards Bern in 12 hours without sleep"
    named = "Maria and Peter walked with Anna from Madrid to Lisbon over Porto and back to Faro in the cold of winter"
    many = cities.replace("Rome", "San Jose").replace("Oslo", "New York City").replace("Bern", "Los Angeles")
    moved = WORD_PROBLEM.replace("Tom", "Lucy").replace("Ann", "Max").replace("5", "9")
    inserted = "We flew on 4 planes from Pisa to Graz and then slowly rode along the coast road towards Riga in 15 hours without sleep"
    docs = [(1, moved), (2, many), (3, f"see: {named.lower()} end"), (4, named.upper()), (5, inserted)]
    got = _leaks(spark, docs, [(1, WORD_PROBLEM), (2, cities), (3, named)])
    assert {k: v[0] for k, v in got.items()} == {(1, 1): "reparameterised", (2, 2): "reparameterised", (3, 3): "exact", (4, 3): "exact",
                                                 (5, 2): "reparameterised"}


def test_one_wrong_slot_does_not_discard_the_rest(spark):
    item = ("The long tunnel under the river was dug by 40 workers who moved wet clay in small carts every night until "
            "the last wall broke and 40 lamps were lit along its whole dark floor")
    merged = "Mix 12 grams of fine salt with 30 grams of brown sugar and let the bowl stand for one night"
    docs = [(1, item.replace("40 lamps", "41 lamps")), (2, merged.replace("12", "20").replace("30", "20"))]
    got = _leaks(spark, docs, [(1, item), (2, merged)])
    assert {k: v[0] for k, v in got.items()} == {(1, 1): "exact", (2, 2): "reparameterised"}


def test_items_of_few_plain_words_are_found_verbatim(spark):
    items = [(1, "What is 12 * 7 + 5?"), (2, "Compute 3/4 + 5/8."), (3, "Who wrote Hamlet?"), (4, "Capital of France?"), (5, "Hamlet"),
             (6, "1 2 3 4 5 6 7 8 9 10 11 12")]
    docs = [(i, f"Some text. {t} More text") for i, t in items] + [
        (20, "What is 13 * 8 + 5?"), (21, "Compute 3/4 + 6/8."), (22, "Who wrote Faust?"), (23, "Capital of Spain?"), (24, "9 8 7 6 5 4 3 2 1 0 3 3")]
    got = _leaks(spark, docs, items)
    assert {k: v[0] for k, v in got.items()} == {**{(i, i): "exact" for i, _ in items}, (3, 5): "exact"}


def test_generated_copies_with_other_values(spark):
    """Items of words, numbers and names; a copy with every value replaced by another, the same one
    wherever it stood, is found as re-parameterised, a verbatim one as exact, and texts of the
    same words in another order are clean."""
    rng = random.Random(9)
    words = "market river garden window teacher yellow simple travel morning silver kitchen letter answer bridge winter".split()
    names, others = ["Tom", "Lucy", "Boris", "Wanda"], ["Omar", "Petra", "Quinn", "Xena"]

    def item():
        out, values = [], [rng.sample(range(2, 90), 3), rng.sample(names, 2)]
        for k in range(rng.randint(24, 40)):
            kind = rng.random()
            out.append(str(rng.choice(values[0])) if kind < 0.12 and k else rng.choice(values[1]) if kind < 0.2 and k else rng.choice(words))
        return out

    def moved(tokens):
        number = dict(zip(range(2, 90), rng.sample(range(100, 900), 88)))
        name = dict(zip(names, rng.sample(others, 4)))
        return [str(number[int(t)]) if t.isdigit() else name.get(t, t) for t in tokens]

    filler = lambda: [rng.choice(words) for _ in range(rng.randint(5, 60))]
    items = [item() for _ in range(25)]
    docs, want = [], {}
    for i, tokens in enumerate(items):
        has = any(t.isdigit() or t in names for t in tokens)
        docs += [(3 * i, filler() + moved(tokens) + filler()), (3 * i + 1, filler() + tokens + filler()), (3 * i + 2, rng.sample(tokens, len(tokens)))]
        want |= {(3 * i, i): "reparameterised" if has else "exact", (3 * i + 1, i): "exact"}
    got = _leaks(spark, [(d, " ".join(t)) for d, t in docs], [(i, " ".join(t)) for i, t in enumerate(items)])
    assert {k: v[0] for k, v in got.items()} == want
