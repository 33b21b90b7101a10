"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact weighted shingles.

DataFrame functions only. A window has as many words as the item it is compared with; shingles
are five words (fewer for shorter items), lower-cased. A shingle weighs more the fewer items have
it. A document holds an item if a window's weighted Jaccard similarity with it is 0.8 or more.

1. A window that similar holds a shingle of the item. Shingles are found by their longest word: the
   words of all documents join the longest words of the items' shingles, and whole shingles are
   compared where one is met. Windows start at every word from which they hold one.
2. Every window gets a 64-bit SimHash of its weighted shingles, unless more than a fifth of its
   shingles are in no item: these weigh most, so it can be similar to none.
3. Fingerprints within RADIUS bits agree up to NEAR bits in one of eight blocks. The items' blocks
   are listed with all values that near, windows join them on block and value, and the exact
   Hamming distance is checked. At the border of 0.8, fingerprints differ by 10 bits on average with a
   deviation of 3, so the radius lies more than four deviations out.
4. The weighted similarity is computed from the whole sets.

Only the benchmark is hinted for broadcast, each table of it up to MOST_BROADCAST rows; larger ones are
joined by shuffles, in which a word takes along its neighbours, not the whole text. Long texts are
searched in parts of SPAN words or an item's length. Matches of a document meet per item only.

Defined results: null or empty texts and items match nothing; a null doc_id or item_id stays null;
rows that repeat give one row for each pair of ids; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmill.llm.common import stored, table

WORDS = 5
SIMILAR = (4, 5)
BLOCKS = 8
BITS = 64 // BLOCKS
NEAR = 2
RADIUS = BLOCKS * (NEAR + 1) - 1
MOST_BROADCAST = 500_000
#: Starts of windows that are looked at together.
SPAN = 256


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")


def _shingles(words: Column, width: Column) -> Column:
    """Hashes of all runs of ``width`` words."""
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice(words, i, width)))


def _items(benchmark: DataFrame) -> DataFrame:
    """item (a number of its text), item_id, n_words, width, shingles."""
    words = benchmark.select("item_id", _words("text").alias("words")).filter(F.size("words") > 0)
    return words.select(
        F.xxhash64("words", "item_id").alias("item"),
        "item_id",
        "words",
        F.size("words").alias("n_words"),
        F.least(F.size("words"), F.lit(WORDS)).alias("width"),
    ).dropDuplicates(["item"])


def _weights(items: DataFrame, n_items: int) -> DataFrame:
    """shingle, weight: a whole number, so that sums do not depend on their order."""
    each = items.select("item", F.explode(F.array_distinct(_shingles(F.col("words"), F.col("width")))).alias("shingle"))
    return each.groupBy("shingle").agg(_weight(F.lit(n_items) / F.count("*")).alias("weight"))


def _weight(rarity: Column) -> Column:
    return F.floor(1000 * F.log(1 + rarity)).cast("long")


def _simhash(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows``: shingle and weight by key. One 64-bit fingerprint and the whole weight a key."""
    votes = [
        F.sum(F.when(F.shiftright("shingle", b).bitwiseAND(1) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"b{b}")
        for b in range(64)
    ]
    bits = [F.when(F.col(f"b{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)) for b in range(64)]
    return rows.groupBy(*by).agg(*votes, F.sum("weight").alias("total")).select(
        *by, "total", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint")
    )


def _block(fingerprint: str) -> Column:
    """Block number ``block`` of a fingerprint."""
    return F.expr(f"cast(shiftrightunsigned({fingerprint}, block * {BITS}) & {(1 << BITS) - 1} as int)")


def _near_values() -> list[int]:
    """All ways to flip at most NEAR bits of a block."""
    return [v for v in range(1 << BITS) if v.bit_count() <= NEAR]


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start (word of the best window) of every pair that matches."""
    items = stored(_items(benchmark))
    n_items, n_words, reach = items.agg(
        F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.max(F.col("n_words") - F.col("width")), F.lit(0))
    ).first()
    small = n_words <= MOST_BROADCAST
    sent = F.broadcast if small else lambda df: df
    sent_index = F.broadcast if n_items * BLOCKS * len(_near_values()) <= MOST_BROADCAST else lambda df: df
    weights = stored(_weights(items, n_items))
    rest = _weight(F.lit(float(n_items)))

    # 1. shingles of items, by their longest word
    runs = items.select(
        "item", "n_words", "width", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.col("n_words") - F.col("width") + 1),
            lambda i: F.slice("words", i, F.col("width")),
        )).alias("place", "run"),
    )
    longest = F.element_at(
        F.array_sort(F.transform("run", lambda w: F.struct((-F.length(w)).alias("by"), w.alias("word")))), 1
    )["word"]
    anchors = runs.select(
        longest.alias("word"), F.xxhash64("run").alias("shingle"), "n_words", "width",
        (F.array_position("run", longest) - 1).cast("int").alias("ahead"),
    ).distinct()
    key = F.xxhash64("doc_id", "text").alias("key")
    words = docs.select(key, _words("text").alias("words")).select("key", "words", F.posexplode("words").alias("at", "word"))
    low = F.lit(0)
    if not small:
        low = F.greatest(F.col("at") - (WORDS - 1), F.lit(0))
        words = words.withColumn("words", F.slice("words", low + 1, 2 * WORDS - 1))
    met = words.join(sent(anchors), "word")
    start = F.col("at") - F.col("ahead")
    met = met.filter(
        (start >= 0) & (F.xxhash64(F.slice("words", start - low + 1, F.col("width"))) == F.col("shingle"))
    ).select("key", "n_words", "width", "shingle", start.alias("start"))
    span = max(SPAN, reach + 1)
    part = F.sequence(
        F.expr(f"cast(greatest(start - {reach}, 0) div {span} as int)"), F.expr(f"cast(start div {span} as int)")
    )
    parts = met.withColumn("part", F.explode(part)).groupBy("key", "part").agg(
        F.collect_set(F.struct("n_words", "width", "start")).alias("hits"), F.collect_set("shingle").alias("known")
    )
    # windows of one part that hold a met shingle: number of words and start in one long
    first, last = F.col("part") * span, F.col("part") * span + (span - 1)
    from_, to = lambda h: F.greatest(h["start"] - (h["n_words"] - h["width"]), first), lambda h: F.least(h["start"], last)
    of_hit = lambda h: F.transform(
        F.sequence(from_(h), to(h)), lambda s: F.shiftleft(h["n_words"].cast("long"), 32) + s
    )
    in_part = F.filter("hits", lambda h: from_(h) <= to(h))
    near = parts.join(docs.select(key, "doc_id", "text"), "key").select(
        "doc_id", "part", "known", F.array_distinct(F.flatten(F.transform(in_part, of_hit))).alias("places"),
        F.slice(_words("text"), first + 1, span + reach + WORDS).alias("words"),
    )
    windows = near.select("doc_id", "part", "known", "words", F.explode("places").alias("place")).select(
        "doc_id", "part", "known", "words", F.expr("cast(place & 4294967295 as int)").alias("start"),
        F.shiftright("place", 32).cast("int").alias("n_words"),
    ).select(
        "doc_id", "start", "n_words", "known", F.least("n_words", F.lit(WORDS)).alias("width"),
        F.slice("words", F.col("start") - first + 1, F.col("n_words")).alias("words"),
    )
    windows = windows.select(
        F.xxhash64("doc_id", "start", "words", "width", "n_words").alias("window"), "doc_id", "start", "n_words", "known",
        F.array_distinct(_shingles(F.col("words"), F.col("width"))).alias("shingles"),
    )
    unknown = F.size(F.array_except("shingles", "known"))
    of_all, foreign = SIMILAR[1], SIMILAR[1] - SIMILAR[0]
    windows = stored(windows.filter(of_all * unknown <= foreign * F.size("shingles")).drop("known").dropDuplicates(["window"]))

    # 2. fingerprints, stored: each is met twice, and a plan with its sums is large on the driver
    parts = windows.select("window", "n_words", F.explode("shingles").alias("shingle"))
    parts = parts.join(sent(weights), "shingle", "left").withColumn("weight", F.coalesce("weight", rest))
    prints = stored(_simhash(parts, ["window", "n_words"]))
    own = items.select("item", F.explode(F.array_distinct(_shingles(F.col("words"), F.col("width")))).alias("shingle"))
    weighed = F.collect_list(F.struct("shingle", "weight")).alias("weighed")
    own = stored(own.join(sent(weights), "shingle"))
    item_prints = _simhash(own, ["item"]).join(own.groupBy("item").agg(weighed), "item")
    item_prints = stored(items.select("item", "item_id", "n_words").join(item_prints, "item").select(
        "item", "item_id", "n_words", "weighed", F.col("total").alias("item_total"), F.col("fingerprint").alias("item_print"),
    ))

    # 3. Hamming blocks
    numbers = F.array(*[F.lit(b) for b in range(BLOCKS)])
    flips = F.array(*[F.lit(v) for v in _near_values()])
    index = (
        item_prints.select("item", "n_words", "item_print", F.explode(numbers).alias("block"))
        .select("item", "n_words", "item_print", "block", F.explode(flips).alias("flip"), _block("item_print").alias("own"))
        .select("item", "n_words", "item_print", "block", F.col("own").bitwiseXOR(F.col("flip")).alias("value"))
    )
    asked = prints.select("window", "n_words", "total", "fingerprint", F.explode(numbers).alias("block")).select(
        "window", "n_words", "total", "fingerprint", "block", _block("fingerprint").alias("value")
    )
    agree = asked.join(sent_index(index), ["n_words", "block", "value"])
    agree = agree.filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    pairs = agree.select("window", "total", "item").distinct().join(windows.drop("n_words"), "window")
    pairs = pairs.join(sent(item_prints.drop("n_words", "item_print")), "item")

    # 4. whole sets
    common = F.aggregate(
        F.filter("weighed", lambda x: F.array_contains("shingles", x["shingle"])), F.lit(0).cast("long"), lambda a, x: a + x["weight"]
    )
    judged = pairs.withColumn("common", common).withColumn("union", F.expr("total + item_total - common"))
    similar = judged.filter(SIMILAR[1] * F.col("common") >= SIMILAR[0] * F.col("union"))
    best = F.max(F.struct((F.col("common") / F.col("union")).alias("similarity"), (-F.col("start")).alias("last")))
    return similar.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"), F.expr("-best.last").alias("start")
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
