"""Benchmark decontamination by template windows, with DataFrame functions only.

Texts are reduced to tokens in which numbers, units and names are typed slots that keep
their surface: ``17 km to Rome`` and ``5 miles to San Jose`` have one template. A run of name
words is one slot, and so is a capitalised word that begins a sentence, alone or with the
names after it. Windows of template tokens of the benchmark items are hash-joined with those
of every document, and beside them windows of the plain lower-cased words, which find
verbatim copies in any case. Hits of one item on neighbouring diagonals form an alignment,
whose tokens are compared one by one. A benchmark value must stand for one document value
throughout; an alignment counts by its longest stretch in which this holds.

An item is found where such a stretch holds ``share`` of the item's tokens. A token counts
the less the more documents have the windows over it, 1 / (1 + log2(documents)), so that a
common question stem alone is no leak, while a whole copy always is. An alignment of equal
surfaces is ``exact``, any other ``reparameterised``.

Defined results: null or empty texts have no tokens and match nothing. Items shorter than a
window match as a whole. Template windows with fewer than ``literals`` plain words never
match, so that runs of numbers or names do not; their verbatim copies do, by the plain words,
down to items of a single word. An item repeated in the benchmark is reported under
each of its ids, null ids included. Documents that repeat an id are judged text by text.
Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from domus.llm.common import store

WINDOW = 8
LITERALS = 4
MIN_WINDOWS = 3
SHARE = 0.7
NEAR = WINDOW  # diagonals this far apart belong to one alignment
BROADCAST_WINDOWS = 500_000  # 16 bytes each
# Fixed value: words that are units after a number.
UNITS = ("mm cm m km in ft yd mi mile miles metre metres meter meters inch inches foot feet yard yards "
         "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
         "ml l litre litres liter liters gallon gallons cup cups "
         "ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
         "percent degrees kmh mph usd eur gbp dollar dollars euro euros cent cents").split()
SLOT = "\x01"
JOINT = "\x02"  # between the words of one name
TEMPLATE, PLAIN = "template", "plain"


def _marked(text: Column, openers: bool) -> Column:
    """Tokens separated by spaces, slots marked; ``openers``: capitalised sentence openers are slots too."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(SLOT), F.lit(" ")), F.lit(JOINT), F.lit(" "))
    # lookbehinds stand behind a first letter or digit, where few places reach them
    # a capitalised word that does not begin a sentence is a name
    t = F.regexp_replace(t, r"(\p{Lu}(?<=[^.!?\s\x01]\s\p{Lu})\p{Ll}\p{L}*)", SLOT + "n$1")
    if openers:
        t = F.regexp_replace(t, r"(\p{Lu}(?<![\p{L}\p{N}\x01]\p{Lu})\p{Ll}\p{L}*)", SLOT + "o$1")
    t = F.regexp_replace(t, r" \x01n(?<=\x01[on]\p{L}{1,64} \x01n)", JOINT)
    t = F.regexp_replace(t, r"(\p{N}(?<![\p{L}\p{N}]\p{N})\p{N}*(?:[.,:/]\p{N}+)*)", SLOT + "d$1 ")
    t = F.regexp_replace(t, rf"(\x01d\S+\s+)({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", "$1" + SLOT + "u$2")
    # marks between digits stay; spaces stay as they are, empty tokens are left out later
    t = F.regexp_replace(t, r"[.,:/](?:(?!\p{N})|(?<!\p{N}.))|[^ a-zA-Z0-9.,:/\x01\x02\p{L}\p{N}]+", " ")
    return F.lower(t)


def _listed(marked: Column) -> Column:
    return F.filter(F.split(marked, " "), lambda x: x != "")


def tokens(text: Column, openers: bool = False) -> Column:
    """Array of tokens; slots are SLOT + type letter (d number, u unit, n name, o sentence opener) + surface."""
    return _listed(_marked(text, openers))


def _plain(marked: Column) -> Column:
    """The words of a marked text without slots."""
    return _listed(F.replace(F.regexp_replace(marked, r"\x01[dnou]", ""), F.lit(JOINT), F.lit(" ")))


def both(text: Column) -> Column:
    """Struct of the text's template tokens and its plain words."""
    marked = F.transform(F.array(_marked(text, True)), lambda t: F.struct(_listed(t).alias(TEMPLATE), _plain(t).alias(PLAIN)))
    return marked[0]


def shape(token: Column) -> Column:
    """A slot's type, or the word itself; an opener may be a name."""
    kind = F.substring(token, 1, 2)
    return F.when(kind == SLOT + "o", SLOT + "n").when(F.startswith(token, F.lit(SLOT)), kind).otherwise(token)


def value(token: Column) -> Column:
    """A slot's surface."""
    return F.substring(token, 3, 1 << 30)


def _bound(column: Column, of) -> Column:
    """``of(column)`` with the column computed once, not at every place that uses it."""
    return F.transform(F.array(column), of)[0]


def _paired(h: Column, step: int, *salt: Column) -> Column:
    """Hash of every element with the one ``step`` further on."""
    n = F.greatest(F.size(h) - step, F.lit(0))
    return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda x, y: F.xxhash64(x, y, *salt))


def window_hashes(found: Column, widths: list[int], stream: str = TEMPLATE) -> Column:
    """Hashes of every ``widths[0]`` consecutive tokens, then of every ``widths[1]``, and so on (none where
    there are fewer tokens); the hashes of streams and widths differ.

    Tokens are hashed once. Windows of 2, 4, 8... tokens are made by pairing those of half their
    width; a width between is a pair of overlapping windows."""
    def one(x: Column) -> Column:
        if stream == PLAIN:
            return F.xxhash64(x, F.lit(1))
        return F.when(x < JOINT, F.xxhash64(shape(x))).otherwise(F.xxhash64(x))  # slots sort before words

    def level(h: Column, power: int, done: dict[int, Column]) -> Column:
        done = {**done, **{w: _paired(h, w - power, F.lit(w)) if w > power else h for w in widths if power <= w < 2 * power}}
        if max(widths) < 2 * power:
            return F.concat(*[done[w] for w in widths])
        return _bound(_paired(h, power), lambda next_: level(next_, 2 * power, done))

    return _bound(F.transform(found, one), lambda h: level(h, 1, {}))


def benchmark_windows(items: DataFrame, text: str = "text", window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """item (hash of the text), stream, its tokens, width, and per window that may match at, w."""
    found = items.select(F.coalesce(text, F.lit("")).alias("text")).distinct() \
        .select(F.xxhash64("text").alias("item"), both(F.col("text")).alias("t"))
    out = None
    for stream in (TEMPLATE, PLAIN):
        own = found.select("item", F.lit(stream).alias("stream"), F.col(f"t.{stream}").alias("words")).filter("size(words) > 0") \
            .withColumn("width", F.least(F.size("words"), F.lit(window)))
        plain = F.transform("words", lambda x: F.when(F.startswith(x, F.lit(SLOT)), 0).otherwise(1))
        hashes = F.coalesce(*[F.when(F.col("width") == w, window_hashes(F.col("words"), [w], stream)) for w in range(1, window + 1)])
        opened = own.withColumn("plain", plain).select("*", F.posexplode(hashes).alias("at", "w"))
        enough = F.aggregate(F.slice("plain", F.col("at") + 1, F.col("width")), F.lit(0), lambda a, x: a + x)
        own = (opened.filter(enough >= literals) if stream == TEMPLATE else opened).drop("plain")
        out = own if out is None else out.union(own)
    return out


def token_weights(lines: DataFrame, size: DataFrame) -> DataFrame:
    """item, stream, weights: per token 1 / (1 + log2 of the documents with a window over it)."""
    seen = lines.select("item", "stream", "doc_id", "key", F.explode("ats").alias("at")).groupBy("item", "stream", "at") \
        .agg(F.count_distinct(F.struct("doc_id", "key")).alias("n"))
    wide = seen.join(size.select("item", "stream", "width"), ["item", "stream"])
    over = wide.select("item", "stream", "n", F.explode(F.sequence("at", F.col("at") + F.col("width") - 1)).alias("i")) \
        .groupBy("item", "stream", "i").agg(F.max("n").alias("n"))
    every = size.select("item", "stream", F.posexplode("item_words").alias("i", "_"))
    weight = 1 / (1 + F.log2(F.coalesce("n", F.lit(1)).cast("double")))
    listed = every.join(over, ["item", "stream", "i"], "left").groupBy("item", "stream") \
        .agg(F.sort_array(F.collect_list(F.struct("i", weight.alias("weight")))).alias("listed"))
    return listed.select("item", "stream", F.col("listed.weight").alias("weights"))


def consistent(same: Column) -> Column:
    """The longest stretch of aligned tokens (b, d, ...) in which a benchmark value has one document value."""
    def step(a: Column, p: Column) -> Column:
        slot = F.startswith(p["b"], F.lit(SLOT))
        clash = F.filter(a["seen"], lambda x: (x["v"] == value(p["b"])) & (x["d"] != value(p["d"])))
        lo = F.when(slot, F.greatest(a["lo"], F.coalesce(F.array_max(F.transform(clash, lambda x: x["at"] + 1)), F.lit(0)))).otherwise(a["lo"])
        seen = F.when(slot, F.array_append(a["seen"], F.struct(value(p["b"]).alias("v"), value(p["d"]).alias("d"), a["at"].alias("at")))) \
            .otherwise(a["seen"])
        longer = a["at"] + 1 - lo > a["n"]
        return F.struct((a["at"] + 1).alias("at"), lo.alias("lo"), F.when(longer, lo).otherwise(a["best"]).alias("best"),
                        F.when(longer, a["at"] + 1 - lo).otherwise(a["n"]).alias("n"), seen.alias("seen"))

    none = F.array().cast("array<struct<v:string,d:string,at:int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("lo"), F.lit(0).alias("best"), F.lit(0).alias("n"), none.alias("seen"))
    return F.aggregate(same, start, step, lambda a: F.struct(a["best"], a["n"]))


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, literals: int = LITERALS,
               min_windows: int = MIN_WINDOWS, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, kind, start (plain word of the document), n_tokens matched, item_tokens, n_slots
    and text_key (hash of the text) of every item found in a document, the best alignment of each pair."""
    # the item's own id column may clash with names used here, so ids come back by the text's hash
    bench = store(benchmark_windows(items, text, window, literals), "benchmark-windows")
    parts = bench.groupBy("stream", "width").agg(F.count("*").alias("n")).orderBy("stream", "width").collect()  # at most 2 x ``window`` rows
    small = sum(r.n for r in parts) <= BROADCAST_WINDOWS
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    pair = ["doc_id", "key", "item", "stream"]
    # windows of all streams and widths end to end: one reading of the documents
    widths = {x: [r.width for r in parts if r.stream == x] for x in (PLAIN, TEMPLATE)}
    windows = [window_hashes(F.col(f"t.{x}"), w, x) for x, w in widths.items() if w]
    windows = F.concat(*windows) if windows else F.array().cast("array<bigint>")
    spread = docs.select("doc_id", F.xxhash64("text").alias("key"), both(F.col("text")).alias("t")) \
        .select("doc_id", "key", F.posexplode(windows).alias("pos", "w"))
    wanted = bench.select("w", "item", "stream", "at")
    hits = spread.join(F.broadcast(wanted) if small else wanted, "w").select(*pair, (F.col("pos") - F.col("at")).alias("shift"), "at")
    size = store(bench.groupBy("item", "stream").agg(F.count("*").alias("windows"), F.first("words").alias("item_words"),
                                                     F.first("width").alias("width")), "benchmark-items")
    around = Window.partitionBy(*pair).orderBy("shift").rangeBetween(-NEAR, NEAR)
    lines = hits.groupBy(*pair, "shift").agg(F.sort_array(F.collect_set("at")).alias("ats")) \
        .withColumn("near", F.collect_list(F.struct("shift", "ats")).over(around))  # at most 2 x NEAR + 1
    n = F.aggregate("near", F.lit(0), lambda a, h: a + F.size(h["ats"]))
    lines = store(lines.join(size.select("item", "stream", "windows"), ["item", "stream"])
                  .filter(n >= F.least("windows", F.lit(min_windows))).drop("windows"), "alignments")
    size = size.drop("windows").join(token_weights(lines, size), ["item", "stream"])
    # the few documents with an alignment are read again for their tokens
    near = docs.withColumn("key", F.xxhash64("text")).alias("d").join(
        lines.alias("l"), F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.key") == F.col("l.key")))
    read = near.select("l.*", both(F.col("d.text")).alias("t"))
    before, passed = F.lit(None).cast("int"), F.lit(0)
    for r in parts:  # where the windows of a stream and width begin
        before = F.when((F.col("stream") == r.stream) & (F.col("width") == r.width), passed).otherwise(before)
        passed = passed + F.greatest(F.size(f"t.{r.stream}") - r.width + 1, F.lit(0))
    aligned = read.join(size, ["item", "stream"]).withColumn("before", before).withColumn(
        "words", F.when(F.col("stream") == TEMPLATE, F.col(f"t.{TEMPLATE}")).otherwise(F.col(f"t.{PLAIN}")))

    def diagonal(i: Column) -> Column:
        """The nearest one whose windows are over token i; else, in templates, the alignment's own."""
        over = F.filter("near", lambda h: F.exists(h["ats"], lambda a: (a <= i) & (i < a + F.col("width"))))
        best = F.array_min(F.transform(over, lambda h: F.struct(F.abs(h["shift"] - F.col("shift")).alias("far"), h["shift"].alias("shift"))))
        return F.coalesce(best["shift"], F.when(F.col("stream") == TEMPLATE, F.col("shift"))) - F.col("before")

    # array positions count from 1; a place outside the document is null
    paired = F.transform("item_words", lambda b, i: F.struct(
        b.alias("b"), F.get("words", i + diagonal(i)).alias("d"), (i + diagonal(i)).alias("pos"), F.get("weights", i).alias("weight")))
    same = F.filter(paired, lambda p: F.coalesce(shape(p["b"]) == shape(p["d"]), F.lit(False)))
    judged = aligned.select(*pair, "t", "item_words", "weights", same.alias("same")).withColumn("best", consistent(F.col("same"))) \
        .withColumn("same", F.slice("same", F.col("best.best") + 1, F.col("best.n")))
    # written, for a filter on these columns would be pushed below them, every use with a copy of what makes it
    judged = store(judged, "aligned-tokens")
    total = lambda column, of: F.aggregate(column, F.lit(0.0), lambda a, x: a + of(x))
    judged = judged.filter((total("same", lambda p: p["weight"]) >= share * total("weights", lambda x: x) - 1e-9) & (F.size("same") > 0))
    slots = F.array_distinct(F.transform(F.filter("same", lambda p: F.startswith(p["b"], F.lit(SLOT))),
                                         lambda p: F.struct(value(p["b"]).alias("b"), value(p["d"]).alias("d"))))
    ahead = F.slice(f"t.{TEMPLATE}", 1, F.array_min("same.pos"))
    start = F.when(F.col("stream") == PLAIN, F.array_min("same.pos")).otherwise(
        F.aggregate(ahead, F.lit(0), lambda a, x: a + F.size(F.split(x, JOINT))))
    equal = F.forall("same", lambda p: F.when(F.startswith(p["b"], F.lit(SLOT)), value(p["b"]) == value(p["d"])).otherwise(p["b"] == p["d"]))
    row = F.struct(equal.alias("equal"), F.size("same").alias("n_tokens"), "stream", (-start).alias("neg_start"),
                   F.size("item_words").alias("item_tokens"), F.size(slots).alias("n_slots"))
    best = judged.groupBy("doc_id", "key", "item").agg(F.max(row).alias("r"))
    ids = items.select("item_id", F.xxhash64(F.coalesce(text, F.lit(""))).alias("item")).distinct()
    return best.join(ids, "item").select(
        "doc_id", "item_id", F.when(F.col("r.equal"), "exact").otherwise("reparameterised").alias("kind"),
        (-F.col("r.neg_start")).alias("start"), "r.n_tokens", "r.item_tokens", "r.n_slots", F.col("key").alias("text_key"))


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    found = find_leaks(docs, items, text).select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_k"))
    return docs.join(found, same, "left_anti")
