"""Quality classifier: interpolated modified Kneser-Ney n-grams trained on trusted text.

Trusted text is labelled rows of quality 1 that are not toxic. Half of them, by a hash of
the id, set the thresholds; all of the other half is learned from. Words are cut at ASCII white space and lower-cased;
a text is ``<s> words </s>``. Counts of every order, continuation counts, discounts and
context totals are grouped counts and joins, per language.

A text's log probability is a sum of weights of its n-grams. With p(g) the interpolated
probability of an n-gram, b(g) the mass that its context leaves to the lower order,
g' the n-gram without its first and 'g the one without its last word, the weight is
``log p(g) - log b('g) - log p(g') + log b(g)``: an n-gram that the model lacks adds
nothing, the sum telescopes to the back-off score. So one equi-join of the documents'
n-grams with the weights gives all scores. Weights of at most ``SEND_BYTES`` go to every
task, and are summed per document before the shuffle; beyond, both sides are sharded by
n-gram.

A document is rejected if its perplexity lies above the ``QUANTILE`` of its language's
trusted rows of the half that is not learned from. A language without such rows rejects
nothing.

Defined results: a null or empty text is ``<s> </s>``; a null language is a language of
its own; repeated rows are scored each; empty tables give empty results and, without
labels, keep every document. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import WORD_SPLIT, ascii_lower, spare_names, stage, table, text_or_empty

ORDER = 2
QUANTILE = 0.99
SEND_BYTES = 64 << 20
BEGIN, END = "<s>", "</s>"


def tokens(text: Column) -> Column:
    words = F.filter(F.split(ascii_lower(text), WORD_SPLIT), lambda w: w != "")
    return F.concat(F.array(F.lit(BEGIN)), words, F.array(F.lit(END)))


def grams_of(words: Column, k: int) -> Column:
    """All runs of ``k`` words."""
    starts = F.sequence(F.lit(1), F.size(words) - (k - 1))
    return F.when(F.size(words) >= k, F.transform(starts, lambda i: F.slice(words, i, F.lit(k)))).otherwise(
        F.array().cast("array<array<string>>"))


def language(col: str = "lang") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return good.filter("q = 1 and coalesce(t, 0) = 0").select("doc_id")


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``lang, doc_id, text`` of labelled good rows, each doc_id once."""
    rows = docs.select("doc_id", language().alias("lang"), text_or_empty("text").alias("text"))
    return rows.join(trusted_ids(labels), "doc_id", "left_semi")


def learnable() -> Column:
    return F.pmod(F.crc32(F.concat(F.lit("train "), F.col("doc_id").cast("string"))), F.lit(2)) == 0


def training_ids(trusted: DataFrame) -> DataFrame:
    """All trusted ids of the half that is learned from."""
    return trusted.filter(learnable()).select("lang", "doc_id").distinct()


def train(texts: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """From ``texts(lang, text)``: ``weights(lang, key, weight)`` and ``unknown(lang, weight)``,
    natural logarithms."""
    if order < 1:
        raise ValueError("order must be 1 or more")
    words = stage(texts.select("lang", tokens(F.col("text")).alias("w")), "kn-texts")
    grams = {}
    for k in range(1, order + 1):
        held = words.select("lang", F.explode(grams_of(F.col("w"), k)).alias("g"))
        grams[k] = held.groupBy("lang", "g").agg(F.count(F.lit(1)).alias("c"))
    begins = F.element_at("g", 1) == BEGIN
    for k in range(1, order):
        # below the highest order a count is that of distinct left neighbours; nothing stands left of <s>
        longer = grams[k + 1].select("lang", F.slice("g", 2, k).alias("g")).groupBy("lang", "g").agg(F.count(F.lit(1)).alias("left"))
        grams[k] = (grams[k].join(longer, ["lang", "g"], "left")
                    .select("lang", "g", F.when(begins, F.col("c")).otherwise(F.coalesce("left", "c")).alias("c")))
    lower = None
    levels = []
    for k in range(1, order + 1):
        # <s> alone is never predicted
        level = grams[k].filter(F.element_at("g", -1) != BEGIN)
        level = stage(level.withColumn("h", F.slice("g", 1, k - 1) if k > 1 else F.array().cast("array<string>")), "kn-counts")
        n = level.groupBy("lang").agg(*[F.sum((F.col("c") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        n = n.select("lang", *[F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(i - 0.01), F.when(
            (F.col("n1") > 0) & (F.col(f"n{i}") > 0), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")))), F.lit(0.5)).alias(f"d{i}")
            for i in (1, 2, 3)])
        level = level.join(n, "lang").withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        heads = level.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.sum("d").alias("left"), F.count(F.lit(1)).alias("kinds"))
        heads = heads.withColumn("b", F.col("left") / F.col("total"))
        if k == 1:
            # the left mass is spread over the words seen and one unknown word
            unknown = stage(heads.select("lang", F.log(F.col("b") / (F.col("kinds") + 1)).alias("weight")), "kn-unknown")
            level = level.join(heads, ["lang", "h"]).withColumn("p", (F.col("c") - F.col("d")) / F.col("total") + F.col("b") / (F.col("kinds") + 1))
            level = level.join(unknown, "lang").withColumn("rest", F.col("weight"))
        else:
            below = lower.select("lang", F.col("g").alias("tail"), F.col("p").alias("q"))
            level = (level.withColumn("tail", F.slice("g", 2, k - 1)).join(heads, ["lang", "h"]).join(below, ["lang", "tail"])
                     .withColumn("p", (F.col("c") - F.col("d")) / F.col("total") + F.col("b") * F.col("q"))
                     .withColumn("rest", F.log("b") + F.log("q")))
        lower = stage(level.select("lang", "g", "p", "rest"), "kn-level")
        levels.append(lower.select("lang", "g", (F.log("p") - F.col("rest")).alias("weight")))
        if k > 1:
            levels.append(heads.select("lang", F.col("h").alias("g"), F.log("b").alias("weight")))
    weights = levels[0]
    for part in levels[1:]:
        weights = weights.union(part)
    weights = (weights.select("lang", F.xxhash64("lang", "g").alias("key"), "weight")
               .groupBy("lang", "key").agg(F.sum("weight").alias("weight")))
    return stage(weights, "kn-weights"), unknown


def perplexity(docs: DataFrame, weights: DataFrame, unknown: DataFrame, order: int = ORDER,
               send_bytes: int = SEND_BYTES) -> DataFrame:
    """``docs`` needs ``rid, lang, text``; returns ``rid, lang, n_tokens, log_prob, perplexity``."""
    rows = docs.select("rid", "lang", tokens(F.col("text")).alias("w"))
    every = [F.transform(grams_of(F.col("w"), k), lambda g: F.xxhash64("lang", g)) for k in range(1, order + 1)]
    keys = rows.select("rid", F.explode(F.concat(*every)).alias("key"))
    known = weights.select("key", "weight")
    if weights.count() * 16 <= send_bytes:  # rows of two 8-byte numbers
        known = F.broadcast(known)
    found = (keys.join(known, "key").groupBy("rid").agg(F.sum("weight").alias("found")))
    sizes = docs.select("rid", "lang", (F.size(tokens(F.col("text"))) - 1).cast("long").alias("n_tokens"))
    # a language that the model has not seen has no score
    scored = (sizes.join(unknown.withColumnRenamed("weight", "_unk"), "lang", "left").join(found, "rid", "left")
              .withColumn("log_prob", F.col("n_tokens") * F.col("_unk") + F.coalesce("found", F.lit(0.0))))
    return scored.select("rid", "lang", "n_tokens", "log_prob", F.exp(-F.col("log_prob") / F.col("n_tokens")).alias("perplexity"))


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, text_hash, lang, n_tokens, log_prob, perplexity, threshold, kept`` for every row."""
    trusted = trusted_rows(docs, labels)
    ids = stage(training_ids(trusted), "kn-training")
    weights, unknown = train(trusted.join(ids, ["lang", "doc_id"], "left_semi").select("lang", "text"), order)
    # rows of one id, language and text are scored once: the n-grams of copies must not add up
    source = docs.select("doc_id", language().alias("lang"), text_or_empty("text").alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text")).withColumn("rid", F.struct("doc_id", "text_hash", "lang"))
    repeated = stage(source.groupBy("rid").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("rid"), "kn-repeated")
    if not repeated.isEmpty():  # only the texts of repeated rows are shuffled
        again = source.join(repeated, "rid").dropDuplicates(["rid"])
        source = source.join(repeated, "rid", "left_anti").unionByName(again)
    scored = perplexity(source, weights, unknown, order)
    scored = stage(scored.select("rid.doc_id", "rid.text_hash", "lang", "n_tokens", "log_prob", "perplexity"), "kn-scores")
    held = trusted_ids(labels)
    bounds = (scored.join(held, "doc_id", "left_semi").filter(~learnable())
              .groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10000).alias("threshold")))
    judged = scored.join(bounds, "lang", "left").withColumn(
        "kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
    each = docs.select("doc_id", language().alias("lang"), F.xxhash64(text_or_empty("text")).alias("text_hash"))
    one = judged.withColumnsRenamed({"doc_id": "_id", "lang": "_lang", "text_hash": "_hash"})
    return (each.join(one, each["doc_id"].eqNullSafe(one["_id"]) & (each["text_hash"] == one["_hash"]) & (each["lang"] == one["_lang"]))
            .drop("_id", "_hash", "_lang"))


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier keeps."""
    lang, text_hash, i, l, h = spare_names(docs, "_lang_or", "_text_hash", "_i", "_l", "_h")
    kept = (classify(docs, labels, **params).filter("kept")
            .select(F.col("doc_id").alias(i), F.col("lang").alias(l), F.col("text_hash").alias(h)).distinct())
    marked = docs.withColumns({lang: language(), text_hash: F.xxhash64(text_or_empty("text"))})
    on = marked["doc_id"].eqNullSafe(kept[i]) & (marked[lang] == kept[l]) & (marked[text_hash] == kept[h])
    return marked.join(kept, on, "left_semi").drop(lang, text_hash)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")
