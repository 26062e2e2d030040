import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from domus.llm import queries, subword_classifier, weak_rules
from domus.llm import subword_classifier as sc

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "be " * 40, "a b c d e\na b c d e\n\nx", "# $ % é ü\x1cz #\n#\n#", "漢字 " * 12 + "end",
       "w" * 100_000, " ".join(f"w{i}" for i in range(30_000)), "a b c d e f a b c d e"]


def brute(text):
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 5))
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


def _base(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str)


def test_statistics_on_odd_texts(spark):
    rows = [(i, t, 1, True) for i, t in enumerate(ODD)] + [(4, ODD[4], 1, None), (None, "x y", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = weak_rules.judge(docs).collect()
    assert _base(got) == sorted(((i, *brute(t)[:5]) for i, t, *_ in rows), key=str)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert not any(r.kept and r.base_failed for r in got)
    assert weak_rules.judge(docs.limit(0)).count() == 0


def test_em_finds_planted_kinds_and_accuracies():
    rng = np.random.default_rng(3)
    n, rules = 60_000, 5
    kind = rng.choice(rules + 1, n, p=[0.85, 0.06, 0.03, 0.03, 0.02, 0.01])  # 0: good
    caught, wrong, voted = rng.uniform(0.7, 0.95, rules), rng.uniform(0.001, 0.02, rules), rng.uniform(0.7, 1, rules)
    chance = np.where(kind[:, None] == np.arange(1, rules + 1), caught, wrong)
    votes = np.where(rng.random((n, rules)) < voted, np.where(rng.random((n, rules)) < chance, 0, 2), 1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = weak_rules.VoteModel(patterns, counts.astype(float))
    right = (model.posterior(patterns)[inverse.ravel()] >= 0.5) == (kind == 0)
    assert abs(model.share[0] - 0.85) < 0.06 and right.mean() > 0.9


def test_weak_quality_query_against_brute_force_and_labels(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op6_weak_quality(spark, SF).collect()
    assert _base(got) == sorted(((i, *brute(t)[:5]) for i, t in docs.items()), key=str)
    assert {r.doc_id: r.base_failed for r in got} == {i: brute(t)[5] for i, t in docs.items()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in got if label.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) / len(clean) > 0.95


def slow_votes(text):
    """The rules' votes on a text, stated anew: 0 bad, 1 abstain, 2 good."""
    text = text or ""
    n, chars, symbols, dup, rep = brute(text)[:5]
    lines = len([x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")])
    upper, letters = sum("A" <= c <= "Z" for c in text), sum(c.isascii() and c.isalpha() or ord(c) >= 0xC0 for c in text)
    marks = sum(c in "!?" for c in text)

    def share(a, b, bad, good):
        if not b:
            return 1
        return 0 if bad(a / b) else 2 if good(a / b) else 1

    line = share(dup, lines, lambda x: dup >= 3 and x > 0.5, lambda x: x < 0.05)
    return (0 if n < 10 else 2 if n >= 50 else 1, share(chars, n, lambda x: not 2.5 <= x <= 12, lambda x: 3 <= x <= 9),
            share(symbols, n, lambda x: x > 0.1, lambda x: x < 0.02), line, share(rep, n, lambda x: x > 0.2, lambda x: x < 0.05),
            share(upper, letters, lambda x: x > 0.3, lambda x: x < 0.15), share(marks, n, lambda x: x > 0.2, lambda x: x < 0.05))


def slow_posteriors(rows, trust=0.2):
    """Expectation-maximisation document by document, in plain loops."""
    rules, classes = len(rows[0]), len(rows[0]) + 1
    good, own, other = weak_rules.VoteModel.GOOD, weak_rules.VoteModel.OWN, weak_rules.VoteModel.OTHER
    belief = [[(good if c == 0 else own if r == c - 1 else other) for r in range(rules)] for c in range(classes)]
    given, share = [[list(b) for b in c] for c in belief], [0.9] + [0.1 / rules] * rules

    def odds(row):
        p = []
        for c in range(classes):
            x = share[c]
            for r, v in enumerate(row):
                x *= given[c][r][v]
            p.append(x)
        return [x / sum(p) for x in p]

    for _ in range(300):
        weights, before = [odds(row) for row in rows], share
        mass = [sum(w[c] for w in weights) for c in range(classes)]
        for c in range(classes):
            for r in range(rules):
                seen = [(trust * mass[c] + 1) * belief[c][r][v] + sum(w[c] for w, row in zip(weights, rows) if row[r] == v) for v in range(3)]
                given[c][r] = [seen[0] / (seen[0] + seen[2]), 1.0, seen[2] / (seen[0] + seen[2])]
        share = [(m + 1) / sum(x + 1 for x in mass) for m in mass]
        if max(abs(a - b) for a, b in zip(share, before)) < 1e-9:
            break
    return [odds(row)[0] for row in rows]


def test_posterior_equals_a_slow_version(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()][:120] + ODD[:-3]
    ascii_only = [t for t in texts if t is None or t.isascii()]
    votes = [slow_votes(t) for t in ascii_only]
    docs = spark.createDataFrame(list(enumerate(ascii_only)), "doc_id long, text string")
    got = {r.doc_id: r for r in weak_rules.judge(docs).collect()}
    shown = docs.join(weak_rules.statistics(docs), "doc_id").select("doc_id", *[v.alias(k) for k, v in weak_rules.votes().items()]).collect()
    assert {r[0]: tuple(r)[1:] for r in shown} == dict(enumerate(votes))
    for i, want in enumerate(slow_posteriors(votes)):
        assert abs(got[i].quality - want) < 1e-6
        assert got[i].kept == (not brute(ascii_only[i])[5] and want >= 0.5)


def _fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op9_quality_classifier(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == _fold(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) / len(held) >= 0.95


def test_classifier_never_sees_the_held_out_fold_and_takes_odd_rows(spark):
    ids = [i for i in range(60)]
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "bad!! junk!! junk!!", None) for i in ids]
                                 + [(None, None, 1.0), (61, "", None), (61, " ", None)],
                                 "doc_id long, text string, score double")
    label = [(i, (1 - i % 2) if _fold(i) else i % 2) for i in ids]  # wrong labels in the fold
    labels = spark.createDataFrame(label + [(None, 1), (1, 1), (3, None)], "doc_id long, quality int")
    model = subword_classifier.train(docs, labels)
    rows = subword_classifier.score(docs, model).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in rows if r.doc_id is not None and r.doc_id < 60)
    assert len(rows) == 63
    assert len({round(r.score, 9) for r in rows if r.doc_id in (None, 61)}) == 1
    none = subword_classifier.train(docs, labels.limit(0))
    assert {r.score for r in subword_classifier.score(docs, none).collect()} == {0.5}
    assert subword_classifier.score(docs.limit(0), none).count() == 0


def test_training_takes_one_row_per_chosen_id(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(subword_classifier, "SubwordClassifier", taken.extend)
    ids = [r.id for r in spark.range(60).filter(~subword_classifier.held_out(F.col("id"))).collect()][:20]
    rows = [(i, f"text of {i}") for i in ids] + [(i, f"other text {n}") for i in ids for n in range(20)] + [(i, None) for i in ids]
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    subword_classifier.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, rows=10)
    assert len(taken) == 10
    first = list(taken)
    taken.clear()
    subword_classifier.train(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5), labels, rows=10)
    assert [(x[0], x[1].tolist(), x[2].tolist()) for x in taken] == [(x[0], x[1].tolist(), x[2].tolist()) for x in first]


def slow_mean(text, value):
    """The classifier's features one by one: words, byte 3/4-grams between word ends, pairs."""
    def scramble(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
        return x ^ (x >> 31)

    found, words = [], (text or "").encode().split()
    for w in words:
        found.append(xxhash.xxh3_64_intdigest(w))
        marked = b"\x02" + w + b"\x03"
        for n in (3, 4):
            for k in range(len(marked) - n + 1):
                x = n
                for b in marked[k:k + n]:
                    x = (x * 257 + b) % 2**64
                found.append(scramble(x))
    for a, b in zip(words, words[1:]):
        found.append(scramble(((xxhash.xxh3_64_intdigest(a) ^ xxhash.xxh3_64_intdigest(b)) + 1) % 2**64))
    return sum(value[f % sc.BUCKETS] for f in found) / max(len(found), 1)


def test_scores_equal_a_slow_version(spark):
    rng = np.random.default_rng(3)
    model = sc.SubwordClassifier([])
    model.value, model.bias = rng.normal(size=sc.BUCKETS) * 20, 0.25
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    texts += [None, "", "a", "été ñ 漢字 \U0001f600", "x " * 3000, "w" * 5000, "a b a b\x0b\x0cc\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in sc.score(docs, model).collect()}
    for i, t in enumerate(texts):
        want = 1 / (1 + np.exp(-np.clip(slow_mean(t, model.value) + model.bias, -40, 40)))
        assert abs(got[i] - want) < 1e-9


def test_training_bytes_are_bounded(spark, monkeypatch):
    rows = [(i, f"good text {i} " * 5 if i % 2 else f"bad junk {i} " * 5) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(sc, "SubwordClassifier", lambda bags: seen.append(bags))
    sc.train(docs, labels)
    monkeypatch.setattr(sc, "TRAIN_BYTES", 20_000)
    sc.train(docs, labels)
    size = [sum(b.nbytes + s.nbytes for _, b, s in bags) for bags in seen]
    assert len(seen[0]) > 100 and size[1] <= 20_000 < size[0] and len(seen[1]) > 5


def test_the_sample_does_not_come_to_the_driver_at_once(spark, monkeypatch):
    rows = [(i, f"good text {i} " * 5 if i % 2 else f"bad junk {i} " * 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    monkeypatch.setattr(type(docs), "collect", lambda self: pytest.fail("the whole sample in one answer"))
    model = sc.train(docs, labels)
    monkeypatch.undo()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in sc.score(docs, model).collect())


def test_the_sample_lies_in_one_buffer(spark, monkeypatch):
    rows = [(i, f"good text {i} " * 5 if i % 2 else f"bad junk {i} " * 5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(sc, "SubwordClassifier", seen.extend)
    sc.train(docs, labels)
    assert len(seen) > 20 and all(abs(share.sum() - 1) < 1e-5 for _, _, share in seen)
    assert len({id(x.base) for _, bucket, _ in seen for x in [bucket]}) == 1
