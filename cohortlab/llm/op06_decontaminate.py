"""Benchmark decontamination: SimHash of item-sized windows, DataFrame operations only.

A window is item-sized: it has as many words as the benchmark item it is held against.
Two texts of a and b shingles have weighted similarity t or more only if they share
``(a + b) t / (1 + t)`` of them. The places of a document that hold a shingle of an item
are counted, and every start whose window can hold that many is proposed, in whatever
order the shared shingles stand; windows that cannot are never fingerprinted.
Fingerprints of windows and items are 64-bit SimHashes of five-word
shingles, cut into ``radius + 1`` blocks: fingerprints within the radius have at least one
equal block, so joining on (item, block number, block) loses none of them. Candidates
are verified by the weighted Jaccard similarity of the shingle multisets, 0.8 or more.

The blocks lose no pair within ``RADIUS``; similarity itself bounds no distance. Unlike
texts are about 32 bits apart, and a test holds items with an edit to less than ``RADIUS``.

Words are lower-cased runs outside ASCII white space. A text of fewer than five words is
one shingle; items of fewer are looked for among the documents' runs of as many words. Documents that are shorter than an item match it if the whole document does.
Besides the item-sized windows, windows that a document's begin or end cuts are judged
where a shingle at word p of the document is at word o of the item and p - o lies outside.

Defined results: null and blank texts have no words and match nothing, as documents or
as items; repeated rows are found each; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import WORD_SPLIT, ascii_lower, keep_rows, stage, table, text_or_empty

WORDS = 5
SIMILARITY = 0.8
RADIUS = 31
SLOTS = 1 << 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), WORD_SPLIT), lambda w: w != "")


def shingles_of(w: Column, words: int) -> Column:
    """Hashes of all runs of ``words`` words; of all words if there are fewer."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1)))
    return F.when(F.size(w) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(words))))).otherwise(
        F.array().cast("array<bigint>"))


def simhash(rows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """``keys, fp``: a bit is 1 if set in over half of the row's shingles."""
    each = rows.select(*keys, F.explode(shingles).alias("_h"))
    bit = [F.sum(F.shiftright("_h", b).bitwiseAND(F.lit(1))).alias(f"_b{b}") for b in range(64)]
    votes = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *bit)
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"_b{b}") * 2 > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, fp.alias("fp"))


def blocks_of(fp: Column, radius: int) -> Column:
    """The fingerprint's bits cut into ``radius + 1`` runs of nearly equal length."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*[F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 63 else -1))
                     for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def bag(rows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    return rows.select(*keys, F.explode(shingles).alias("h")).groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("c"))


def shared_least(a: Column, b: Column, similarity: float) -> Column:
    """Shingles that texts of ``a`` and ``b`` shingles share at least if they are as similar."""
    return F.greatest(F.ceil((a + b) * (similarity / (1 + similarity)) - 1e-6).cast("int"), F.lit(1))


def whole_windows(hits: DataFrame, words: int, similarity: float) -> DataFrame:
    """Item-sized windows that can hold enough places of ``hits``: a place enters the count of
    starts at its first window and leaves it after its last. A shorter document is one window."""
    keys = ["doc_id", "text_hash", "item"]
    length = F.least("item_words", "n")
    size = F.greatest(length - (words - 1), F.lit(1))
    events = (hits.repartition(*keys).select(
        *keys, length.alias("length"), (F.col("n") - length).alias("last"), shared_least(size, F.col("ni"), similarity).alias("need"),
        F.explode(F.array(F.struct((F.col("p") - size + 1).alias("at"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                          F.struct((F.col("p") + 1).alias("at"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
        .groupBy(*keys, "length", "last", "need", F.col("e.at").alias("at")).agg((F.max("e.up") - F.max("e.down")).alias("step")))
    along = Window.partitionBy(*keys).orderBy("at")
    runs = (events.withColumns({"held": F.sum("step").over(along), "next": F.lead("at").over(along)}).filter("held >= need")
            .withColumns({"low": F.greatest("at", F.lit(0)), "high": F.least(F.col("next") - 1, F.col("last"))}).filter("low <= high"))
    return (runs.select(*keys, "length", F.explode(F.sequence("low", "high")).alias("start"))
            .select(*keys, "start", (F.col("start") + F.col("length")).alias("stop")))


def cut_windows(hits: DataFrame, words: int, similarity: float) -> DataFrame:
    """Windows that an offset in ``hits`` proposes and the document's begin or end cuts, if they
    are long enough."""
    begin = hits.withColumn("o", F.explode("offsets")).withColumn("begin", F.col("p") - F.col("o"))
    spots = (begin.filter("begin < 0 or begin + item_words > n")
             .withColumns({"start": F.greatest("begin", F.lit(0)),
                           "stop": F.least("n", F.greatest(F.col("begin") + F.col("item_words"), F.lit(1)))}))
    size = F.greatest(F.col("stop") - F.col("start") - (words - 1), F.lit(1))
    return (spots.filter(size >= shared_least(size, F.col("ni"), similarity))
            .select("doc_id", "text_hash", "item", "start", "stop"))


def may_hold(text: DataFrame, doc_id: str, text_hash: str, windows: DataFrame) -> DataFrame:
    """The rows of ``text`` that share a slot with a document of ``windows``. There are ``SLOTS``
    slots, so the table sent to every task has a bound; a row that shares one by chance goes in
    the exact join behind. Only texts that are left are shuffled, whole."""
    slot = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(SLOTS))
    taken = windows.select(slot("doc_id", "text_hash").alias("_slot")).distinct()
    return text.join(F.broadcast(taken), slot(doc_id, text_hash) == F.col("_slot"), "left_semi")


def matches(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
            radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_hash, item_id, start, distance, similarity``: every window (start in words)
    of a document that is as similar to an item."""
    if not 0 <= radius < 64:
        raise ValueError("radius must be 0 to 63 bits")
    items = benchmark.select("item_id", words_of(text_or_empty("text")).alias("iw")).filter("size(iw) > 0")
    items = stage(items.groupBy("item_id", "iw").agg(F.lit(1)).select(
        "item_id", F.xxhash64("iw").alias("item"), F.size("iw").alias("item_words"), shingles_of(F.col("iw"), words).alias("ish")), "decon-items")
    texts = items.dropDuplicates(["item"]).select("item", "item_words", "ish")
    source = docs.select("doc_id", text_or_empty("text").alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w")).filter("size(w) > 0")
    anchors = (texts.select("item", "item_words", F.size("ish").alias("ni"), F.posexplode("ish").alias("o", "h"))
               .groupBy("item", "item_words", "ni", "h").agg(F.collect_list("o").alias("offsets")))
    place = ["doc_id", "text_hash", F.size("w").alias("n")]
    places = source.select(*place, F.posexplode(shingles_of(F.col("w"), words)).alias("p", "h"))
    hits = places.join(anchors.filter(F.col("item_words") >= words), "h").drop("h")
    for r in texts.filter(F.col("item_words") < words).select("item_words").distinct().collect():  # fewer than ``words`` rows
        k = r["item_words"]
        runs = source.filter(F.size("w") >= k).select(*place, F.posexplode(shingles_of(F.col("w"), k)).alias("p", "h"))
        hits = hits.unionByName(runs.join(anchors.filter(F.col("item_words") == k), "h").drop("h"))
    hits = stage(hits, "decon-hits")
    found = whole_windows(hits, words, similarity).union(cut_windows(hits, words, similarity)).distinct()
    windows = stage(found, "decon-windows")
    spots = windows.select("doc_id", "text_hash", "start", "stop").distinct()
    held = spots.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spots"))
    text = docs.select(F.col("doc_id").alias("_id"), text_or_empty("text").alias("text")).withColumn("_hash", F.xxhash64("text"))
    text = may_hold(text, "_id", "_hash", windows)
    cut = (text.join(held.hint("merge"), text["_id"].eqNullSafe(held["doc_id"]) & (text["_hash"] == held["text_hash"]))
           .select("doc_id", "text_hash", words_of(F.col("text")).alias("w"), F.explode("spots").alias("s"))
           .select("doc_id", "text_hash", "s.start", "s.stop", shingles_of(F.slice("w", F.col("s.start") + 1, F.col("s.stop") - F.col("s.start")), words).alias("sh")))
    # windows of the same words are judged once
    cut = stage(cut.withColumn("window", F.xxhash64("sh")), "decon-cut")
    kinds = cut.select("window", "sh").dropDuplicates(["window"])
    wfp = simhash(kinds, ["window"], "sh")
    ifp = simhash(texts, ["item"], "ish").withColumnRenamed("fp", "ifp")
    proposed = (windows.join(cut.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.col("start").alias("_s"),
                                        F.col("stop").alias("_e"), "window").distinct(),
                             F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t"))
                             & (F.col("start") == F.col("_s")) & (F.col("stop") == F.col("_e")))
                .select("doc_id", "text_hash", "item", "start", "window"))
    proposed = stage(proposed, "decon-proposed")
    pairs = proposed.select("item", "window").distinct()
    left = pairs.join(wfp, "window").select("item", "window", "fp", F.posexplode(blocks_of(F.col("fp"), radius)).alias("slot", "block"))
    right = ifp.select("item", "ifp", F.posexplode(blocks_of(F.col("ifp"), radius)).alias("slot", "block"))
    near = (left.join(right, ["item", "slot", "block"]).select("item", "window", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))).alias("distance"))
            .filter(F.col("distance") <= radius).distinct())
    near = stage(near, "decon-near")
    wbag = bag(kinds, ["window"], "sh")
    ibag = bag(texts, ["item"], "ish").withColumnRenamed("c", "ic")
    shared = near.join(wbag, "window").join(ibag, ["item", "h"]).groupBy("item", "window", "distance").agg(F.sum(F.least("c", "ic")).alias("both"))
    sizes = kinds.select("window", F.size("sh").alias("nw"))
    alike = (shared.join(sizes, "window").join(texts.select("item", F.size("ish").alias("ni")), "item")
             .withColumn("similarity", F.col("both") / (F.col("nw") + F.col("ni") - F.col("both")))
             .filter(F.col("similarity") >= similarity).select("item", "window", "distance", "similarity"))
    return (proposed.join(alike, ["item", "window"]).join(items.select("item", "item_id"), "item")
            .select("doc_id", "text_hash", "item_id", "start", "distance", "similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """One row per document and item: the most similar window, the first of equals."""
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "distance")).alias("b")
    return (matches(docs, benchmark, **params).groupBy("doc_id", "text_hash", "item_id").agg(best)
            .select("doc_id", "text_hash", "item_id", F.col("b.start").alias("start"), F.col("b.distance").alias("distance"),
                    (-F.col("b.s")).alias("similarity")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, all columns, without a window like a benchmark item."""
    return keep_rows(docs, matches(docs, benchmark, **params), how="left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
