"""Quality by weak supervision: rules vote or abstain, EM estimates how far to trust them.

Every rule votes good (2), bad (0) or abstains (1) on a document's statistics. The counts of
all vote patterns over the whole corpus (at most 3**rules rows, whatever the corpus size) feed an
expectation-maximisation fit: a document is good or is junk of one of the kinds that the
rules are made for, and each class has a share and gives every rule's vote with some
probability, which tells how accurate the rule is. A document's posterior probability of
being good is then a closed expression over all its votes.

Defined results: a null or empty text has zeros everywhere and fails the base test. Rows are
independent given the fit, so repeated rows agree; extra columns are ignored; an empty table
gives no rows. A text of any length is one document, read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus.llm.common import raw_texts, slices, store

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")
SCHEMA = "doc_id long, " + ", ".join(f"{s} long" for s in STATS)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def repeated_words(ids: np.ndarray, owner: np.ndarray, n_docs: int, width: int = WINDOW) -> np.ndarray:
    """Per document, words inside windows of ``width`` words found twice or more in it. Window
    identity is exact: windows are numbered by numbering ever longer pairs of shorter ones."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(n_docs, dtype=np.int64)
    code = ids
    for at in range(1, width):
        m = len(ids) - at
        code, found = pd.factorize(code[:m] * (int(ids.max()) + 1) + ids[at:])
    inside = np.flatnonzero(owner[:n] == owner[width - 1:])
    code, _ = pd.factorize(code[inside] * n_docs + owner[inside])
    at = inside[np.bincount(code)[code] > 1]
    depth = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + width, -1)
    return np.bincount(owner[np.cumsum(depth[:-1]) > 0], minlength=n_docs)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[np.frombuffer(chars, dtype=np.uint8)] = True
    return t


_LETTER = np.arange(256) >= 0xC3  # first bytes of letters beyond ASCII, about
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_UPPER = _table(bytes(range(65, 91)))
_NOT_WORD_CHAR = _table(SPACES) | ((np.arange(256) & 0xC0) == 0x80)
_COUNTED = {"word_chars": ~_NOT_WORD_CHAR, "n_symbols": _table(SYMBOLS), "n_upper": _UPPER, "n_letters": _LETTER,
            "n_marks": _table(b"!")}


def _statistics(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, text):
            raw = raw_texts(part, text)
            words = [t.split() for t in raw]
            n_words = np.fromiter(map(len, words), dtype=np.int64, count=len(raw))
            ids = np.fromiter(map(_Ids().__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(n_words.sum()))
            owner = np.repeat(np.arange(len(raw)), n_words)
            lines = [[x for x in t.split(b"\n") if x.strip()] for t in raw]
            flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
            ends = np.cumsum([0, *map(len, raw)])
            got = {"n_words": n_words, "n_repeat_words": repeated_words(ids, owner, len(raw)),
                   "n_lines": [len(x) for x in lines], "n_dup_lines": [len(x) - len(set(x)) for x in lines]}
            for name, member in _COUNTED.items():
                got[name] = np.diff(np.r_[0, np.cumsum(member[flat])][ends])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), *[pa.array(got[s], pa.int64()) for s in STATS]],
                names=["doc_id", *STATS])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The statistics that the rules read, one row per document."""
    return docs.select("doc_id", text).mapInArrow(lambda it: _statistics(it, text), SCHEMA)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 2).otherwise(1)


def votes() -> dict[str, Column]:
    """rule -> vote. Ratios are per word, per line or per letter; a zero divisor abstains."""
    c = {s: F.col(s).cast("double") for s in STATS}

    def share(a: str, b: str) -> Column:
        return c[a] / F.when(c[b] > 0, c[b])

    return {
        "length": _vote(c["n_words"] < 10, c["n_words"] >= 50),
        "word_size": _vote(~share("word_chars", "n_words").between(2.5, 12), share("word_chars", "n_words").between(3, 9)),
        "symbols": _vote(share("n_symbols", "n_words") > 0.1, share("n_symbols", "n_words") < 0.02),
        "lines": _vote((c["n_dup_lines"] >= 3) & (share("n_dup_lines", "n_lines") > 0.5), share("n_dup_lines", "n_lines") < 0.05),
        "repeats": _vote(share("n_repeat_words", "n_words") > 0.2, share("n_repeat_words", "n_words") < 0.05),
        "capitals": _vote(share("n_upper", "n_letters") > 0.3, share("n_upper", "n_letters") < 0.15),
        "shouting": _vote(share("n_marks", "n_words") > 0.2, share("n_marks", "n_words") < 0.05),
    }


class VoteModel:
    """Shares of the classes (good first, then one junk kind per rule) and P(vote | class), by
    expectation-maximisation over pattern counts.

    Estimates are drawn towards a belief by ``trust`` times the weight of their class: a good
    document seldom gets a bad vote, a kind's own rule mostly sees it, others mostly do not.
    """

    GOOD, OWN, OTHER = [0.005, 0.2, 0.795], [0.8, 0.1, 0.1], [0.05, 0.25, 0.7]  # P(bad), P(abstain), P(good vote)

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, trust: float = 0.2):
        rules, total = patterns.shape[1], counts.sum()
        belief = np.tile(np.array(self.OTHER), (rules + 1, rules, 1))
        belief[0] = self.GOOD
        belief[np.arange(1, rules + 1), np.arange(rules)] = self.OWN
        self.given, self.share = belief.copy(), np.r_[0.9, np.full(rules, 0.1 / rules)]
        for _ in range(rounds if total else 0):
            before = self.share
            weight = counts[:, None] * self.classes(patterns)
            mass = weight.sum(axis=0)
            for r in range(rules):
                seen = np.stack([np.bincount(patterns[:, r], weights=w, minlength=3) for w in weight.T])
                seen = seen + (trust * mass + 1)[:, None] * belief[:, r]
                self.given[:, r] = seen / (seen[:, :1] + seen[:, 2:])
                self.given[:, r, 1] = 1
            self.share = (mass + 1) / (mass + 1).sum()
            if np.abs(self.share - before).max() < 1e-9:
                break

    def classes(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of every class given each pattern."""
        odds = np.log(self.share) + np.log(self.given[:, np.arange(patterns.shape[1]), patterns]).sum(axis=2).T
        odds = np.exp(odds - odds.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return self.classes(patterns)[:, 0]


def fit(stats: DataFrame) -> VoteModel:
    rules = votes()
    rows = stats.select(*[v.alias(k) for k, v in rules.items()]).groupBy(*rules).count().collect()  # 3**7 rows at most
    table = np.array([tuple(r) for r in rows], dtype=np.int64).reshape(-1, len(rules) + 1)
    order = np.lexsort(table.T)  # the fit does not depend on the order that rows arrive in
    return VoteModel(table[order, :-1], table[order, -1].astype(float))


def posterior(model: VoteModel) -> Column:
    """P(good | votes) as a column expression."""
    against = F.lit(0.0)
    for share, given in zip(model.share[1:], model.given[1:]):
        odds = F.lit(float(np.log(share / model.share[0])))
        for vote, more in zip(votes().values(), np.log(given / model.given[0])):
            odds = odds + F.element_at(F.array(*[F.lit(float(m)) for m in more]), vote + 1)
        against = against + F.exp(odds)
    return 1 / (1 + against)


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics, base test, quality posterior and verdict of every document."""
    stats = store(statistics(docs, text), "quality-stats")
    quality = posterior(fit(stats))
    return (stats.withColumn("base_failed", base_failed()).withColumn("quality", quality)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
