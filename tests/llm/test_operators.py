"""Training-data operators against brute force, and the defined results of odd rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cohortlab.llm import op01_lm_scoring as lm
from cohortlab.llm import op03_sharding, op06_decontaminate, op07_simhash_dedup, op08_exact_dedup, op09_sentencepiece
from cohortlab.llm import op05_quality as quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, item string"
BENCH = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion at dawn"


@pytest.fixture(scope="module")
def odd(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, base), (2, base), (3, base.upper() + "  "), (4, None), (5, ""), (6, " \n"), (None, base), (None, None),
            (7, base + " nu"), (7, base + " nu"), (8, "x " * 5000 + ITEM), (9, f"before {ITEM} after"), (10, ITEM.replace("fox", "cat")),
            (11, "one"), (12, "wörter über ÄÖ 😀 \x0b end")]
    return spark.createDataFrame([(i, t, "en" if k % 3 else None, "s", 1, 0, "z") for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "one"), (5, ITEM)], BENCH)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(words, n=5):
    return [tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if re.match(r"op\d", n)} >= {f"op{i}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)}


def test_decontamination_matches_brute_force(odd, bench):
    want = set()
    for d in odd.collect():
        w = split(d.text)
        for b in bench.collect():
            iw = split(b.text)
            if not w or not iw:
                continue
            for a in range(max(1, len(w) - len(iw) + 1)):
                x, y = Counter(shingles(w[a:a + len(iw)])), Counter(shingles(iw))
                if sum((x & y).values()) / sum((x | y).values()) >= 0.8:
                    want.add((d.doc_id, b.item_id))
    got = {(r.doc_id, r.item_id) for r in op06_decontaminate.leaks(odd, bench).collect()}
    assert got == want and (9, 1) in got and (9, 5) in got and (11, 4) in got


def test_decontamination_judges_every_window(spark):
    # swapped sentences, edits and repeats: starts that no shingle's own offset gives
    rng = np.random.default_rng(5)
    items, docs = [], []
    for k, n in enumerate((40, 60, 47, 90, 18)):
        w = [f"w{x}" for x in rng.integers(0, 10**6 if k != 2 else 3, n)]
        items.append((k, " ".join(w)))
        around = [f"v{x}" for x in rng.integers(0, 10**6, 50)]
        for cut in (n // 2, n // 3):
            swapped = w[cut:] + w[:cut]
            docs += [(len(docs), " ".join(around + swapped + around)), (len(docs) + 1, " ".join(swapped)),
                     (len(docs) + 2, " ".join(around + swapped[:-2] + ["edit"] + around)), (len(docs) + 3, " ".join(around + w[:-1] + w))]
    want = set()
    for d, text in docs:
        w = split(text)
        for i, item in items:
            y = Counter(shingles(split(item)))
            size = len(split(item))
            for a in range(max(1, len(w) - size + 1)):
                x = Counter(shingles(w[a:a + size]))
                if sum((x & y).values()) / sum((x | y).values()) >= 0.8:
                    want.add((d, i, a))
    found = op06_decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, BENCH))
    got = {(r.doc_id, r.item_id, r.start) for r in found.collect()}
    assert want <= got and (8, 1) in {x[:2] for x in want}
    inside = {(d, i) for d, i, _ in got - want}
    assert inside <= {(d, i) for d, i, _ in want}


def test_decontamination_of_short_items(spark):
    docs = [(0, "one two three four five six seven"), (1, "Two  three"), (2, "two four three"), (3, "x two three two three y"), (4, "one two three"), (5, "seven")]
    items = [(0, "two three"), (1, "seven"), (2, "four five six seven"), (3, "two three two three y")]
    want = set()
    for d, text in docs:
        for i, item in items:
            w, iw = split(text), split(item)
            want |= {(d, i, a) for a in range(len(w) - len(iw) + 1) if w[a:a + len(iw)] == iw}
    found = op06_decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, BENCH))
    assert {(r.doc_id, r.item_id, r.start) for r in found.collect()} == want and (0, 0, 1) in want


def test_radius_covers_similar_windows(spark):
    # items that differ by one edit: those at 0.8 or more lie within the radius
    rng = np.random.default_rng(3)
    rows = []
    for k in range(60):
        w = [f"w{x}" for x in rng.integers(0, 10**6, 14 + k)]
        e = list(w)
        e[0 if k % 2 else -1] = "edit"
        rows.append((k, " ".join(w), " ".join(e)))
    df = spark.createDataFrame(rows, "k long, text string, other string")
    items = df.select(F.col("k").alias("item_id"), "text")
    docs = df.select(F.col("k").alias("doc_id"), F.concat(F.lit("some words before "), "other", F.lit(" and after")).alias("text"))
    found = {(r.doc_id, r.item_id): r.distance for r in op06_decontaminate.leaks(docs, items).collect()}
    assert {(k, k) for k in range(60)} <= set(found)
    assert max(found.values()) < op06_decontaminate.RADIUS


def test_simhash_matches_brute_force(odd):
    import xxhash

    rows = odd.select("doc_id", "text").collect()

    def fingerprint(text):
        w = split(text)
        hs = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles(w, 4)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps = [fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    comp = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    low = {c: min((ids[i] for i in range(len(rows)) if comp[i] == c and ids[i] is not None), default=None) for c in comp}
    want = Counter((ids[i], f"{fps[i]:016x}", low[comp[i]]) for i in range(len(rows)))
    got = Counter((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in op07_simhash_dedup.near_groups(odd).collect())
    assert got == want


def test_keep_one_of_each_component(spark):
    # unlike texts without an id, and unlike texts of one id, are components of their own
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(6)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (3, texts[4]), (3, texts[5]), (9, texts[5])]
    kept = op07_simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, t) for t in texts[:4]] + [(3, texts[4]), (3, texts[5])])


@pytest.mark.parametrize("block", [4, 4096])
def test_simhash_long_lists(spark, block):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(f"w{i}") for i in range(300)], F.col("id").cast("string")).alias("text"))
    got = op07_simhash_dedup.near_groups(docs, block=block)
    rows = got.select("fp", "component_id").distinct().collect()
    assert len(rows) > 4
    part = {r.fp & (1 << 64) - 1: r.component_id for r in rows}
    for a in part:
        for b in part:
            if (a ^ b).bit_count() <= 4:
                assert part[a] == part[b]


@pytest.mark.parametrize("key_bits", [3, 64])
def test_exact_dedup(odd, key_bits):
    rows = odd.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, r.doc_id))
    got = op08_exact_dedup.exact_dedup(odd, capacity=2, max_depth=3, key_bits=key_bits)["result"].collect()
    assert len(got) == len(rows)
    want = Counter()
    for t, members in groups.items():
        for m in members:
            want[(m[3], min(members)[3], len(members), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_sharding_law(odd):
    rows = op03_sharding.shard(odd, shards=3).collect()
    assert len(rows) == odd.count()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    texts = {}
    for r in rows:
        assert texts.setdefault((r.text_crc32, r.size), r.shard) == r.shard


def test_sentencepiece_round_trip(odd):
    rows = op09_sentencepiece.encode(odd).collect()
    assert len(rows) == odd.count() and all(r.parity for r in rows)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5)} == {0}


def test_sentencepiece_ids_of_whole_texts(spark, odd, tmp_path):
    import sentencepiece

    # the registered query returns the ids, and they are the library's for the whole text
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=op09_sentencepiece.MODEL_PATH)
    rows = op09_sentencepiece.query(spark, str(tmp_path)).collect()
    want = Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in odd.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    assert corpus_pipeline.tokenize(spark, odd, str(tmp_path)).columns == ["doc_id", *(x.split()[0] for x in op09_sentencepiece.OUT.split(", "))]


def test_sentencepiece_parity_is_of_whole_texts():
    # a text that the library encodes otherwise than its words is not in parity, and ends no job
    with open(op09_sentencepiece.MODEL_PATH, "rb") as f:
        codec = op09_sentencepiece.Codec(f.read())
    real = codec.library

    class Other:
        def encode(self, texts, num_threads=1):
            return [ids[:-1] if " " in t else ids for t, ids in zip(texts, real.encode(texts), strict=True)]

    codec.library = Other()
    assert [(r, p) for _, r, p in codec.encode(["some words", "word", ""])] == [(True, False), (True, True), (True, True)]


def reference_perplexity(train, text):
    """Modified Kneser-Ney of order 2, written out by recursion."""
    seqs = [["<s>", *split(t), "</s>"] for t in train]
    two = Counter(b for s in seqs for b in zip(s, s[1:]))
    one = Counter(b for _, b in two)

    def discounts(counts):
        n = Counter(counts.values())
        if not n[1]:
            return [0.5] * 3
        y = n[1] / (n[1] + 2 * n[2])
        return [max(0.0, min(i - 0.01, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else 0.5 for i in (1, 2, 3)]

    d1, d2 = discounts(one), discounts(two)
    cut = lambda c, d: d[min(c, 3) - 1]
    total, left = sum(one.values()), sum(cut(c, d1) for c in one.values())
    p1 = lambda w: ((one[w] - cut(one[w], d1)) / total if w in one else 0) + left / total / (len(one) + 1)
    score, s = 0.0, ["<s>", *split(text), "</s>"]
    for u, w in zip(s, s[1:]):
        after = [c for (a, _), c in two.items() if a == u]
        if after:
            b = sum(cut(c, d2) for c in after) / sum(after)
            score += math.log((two[u, w] - cut(two[u, w], d2)) / sum(after) + b * p1(w) if (u, w) in two else b * p1(w))
        else:
            score += math.log(p1(w))
    return math.exp(-score / (len(s) - 1))


def test_kneser_ney_matches_recursion(spark):
    train = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "the the the end", "", "a mat on a log"]
    new = ["the cat sat on a log", "zzz the dog", "", "the the mat qqq qqq", "cat"]
    weights, unknown = quality.train(spark.createDataFrame([("en", t) for t in train], "lang string, text string"))
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(new)], "rid long, lang string, text string")
    for send_bytes in (0, quality.SEND_BYTES):
        got = {r.rid: r.perplexity for r in quality.perplexity(docs, weights, unknown, send_bytes=send_bytes).collect()}
        for i, t in enumerate(new):
            assert got[i] == pytest.approx(reference_perplexity(train, t), rel=1e-9)


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 12)] + [(12, 0, 0), (None, 1, 0), (1, 1, None)], LABELS)
    rows = quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.kept is not None for r in rows)
    none = quality.classify(odd, spark.createDataFrame([], LABELS))
    assert none.filter("kept").count() == odd.count()
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_quality_of_repeated_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, " ".join(f"w{x}" for x in rng.integers(0, 30, 40)), "en") for i in range(60)]
    poor = [(100, "w1 w2 w3 zz yy w4 w5 w6 xx", "en"), (None, "w7 w8 qq w9 w1 w2", "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)
    held = [r for r in good if zlib.crc32(f"train {r[0]}".encode()) % 2]  # they set the threshold, the model does not learn from them
    found = []
    for copies in (1, 6):
        rows = quality.classify(spark.createDataFrame(good + (poor * copies) + held * (copies - 1), "doc_id long, text string, lang string"), labels).collect()
        assert len(rows) == 60 + (2 * copies) + len(held) * (copies - 1)
        found.append({(r.doc_id, round(r.perplexity, 9), round(r.threshold, 9), r.kept) for r in rows})
    assert found[0] == found[1] and len(found[0]) == 62


def test_attention_gradient():
    rng = np.random.default_rng(0)
    model = lm.Attention(500)
    windows = lm.Windows([rng.integers(0, 499, n).astype(np.int32) for n in (5, 70, 0, 33)], 499)
    model.start_from(windows.target)
    given, inside, place, valid = windows.take(np.arange(len(windows.base)))
    assert sorted(place[valid]) == list(range(len(windows.target)))  # each id is scored once
    target = windows.target[place[valid]]
    _, grad = model.gradient(given, inside, valid, target)
    direction = grad / np.linalg.norm(grad)
    start, at = model.vector.copy(), []
    for step in (0.01, -0.01):
        model.vector[:] = start + np.float32(step) * direction
        at.append(model.gradient(given, inside, valid, target)[0])
    assert (at[0] - at[1]) / 0.02 == pytest.approx(float(np.linalg.norm(grad)), rel=0.05)


def test_attention_probabilities_add_up():
    rng = np.random.default_rng(3)
    model, end = lm.Attention(6), 5
    model.start_from(rng.integers(0, 6, 200))
    model.vector += rng.normal(0, 0.3, model.vector.shape).astype(np.float32) * (model.vector > -20)
    texts = [np.array(t, np.int32) for k in range(4) for t in itertools.product(range(5), repeat=k)]
    windows = lm.Windows(texts, end)
    each = model.score(windows)
    whole = np.exp(np.add.reduceat(each, windows.starts))
    begun = np.exp([each[a:a + 3].sum() for t, a in zip(texts, windows.starts, strict=True) if len(t) == 3])
    short = [len(t) < 3 for t in texts]
    # texts of up to two ids, and all that begin with three
    assert whole[short].sum() + begun.sum() == pytest.approx(1.0, abs=1e-5)


def test_attention_beats_word_counts_on_held_out_text():
    # two languages of their own words: the context tells which, word counts cannot
    rng = np.random.default_rng(5)
    words = [[f"{a}{b}" for a in "kmnp" for b in s] for s in ("aeio", "uyrl")]

    def text(k):
        return " ".join(rng.choice(words[k % 2], 40)).encode()

    sub = lm.Subwords(*lm.read_vocabulary(lm.VOCABULARY))
    train, held = [text(k) for k in range(200)], [text(k) for k in range(40)]
    windows = lm.Windows([sub.ids(t) for t in train], sub.end)
    model = lm.Attention(sub.end + 1)
    model.start_from(windows.target)
    model.train(windows, 150, lm.FIRST_RATE)
    c = Counter(w for t in train for w in [*t.split(), b"\n"])
    n = sum(c.values())
    base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for t in held for w in [*t.split(), b"\n"])
    assert model.score(lm.Windows([sub.ids(t) for t in held], sub.end)).sum() / math.log(10) > base


def test_lm_learns_from_every_training_document(spark):
    # each document has an id of its own, whose embedding moves only if the document is learned from
    sub = lm.Subwords(*lm.read_vocabulary(lm.VOCABULARY))
    found = ((i, sub.encoding.decode_single_token_bytes(i)) for i in range(2000, 20000))
    own = [(i, b[1:].decode()) for i, b in found if re.fullmatch(rb" [a-z]{4,}", b) and sub.encoding.encode_ordinary(b.decode()) == [i]][:60]
    docs = spark.createDataFrame([(k, " ".join([w] * 8)) for k, (_, w) in enumerate(own)], "doc_id long, text string").repartition(2)
    n, vector, _ = lm.train_model(docs, sample_rows=1, steps=1)
    moved = (lm.Attention(n, vector).p["embed"] != lm.Attention(n).p["embed"]).any(axis=1)
    assert [bool(moved[i]) for i, _ in own] == [zlib.crc32(str(k).encode()) % 10 != 0 for k in range(60)]


def test_lm_counts_match_brute_force(odd):
    rows = odd.select("doc_id", "text").collect()
    train = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 != 0
    tokens = [(r.doc_id, [*split(r.text), "\n"]) for r in rows]
    c = Counter(t for i, ts in tokens if train(i) for t in ts)
    n = sum(c.values())
    want = sorted((str(i), not train(i), len(ts), sum(c[t] > 0 for t in ts), n,
                   round(sum(math.log10((c[t] + 0.1) / (n + 0.1 * (len(c) + 1))) for t in ts), 6)) for i, ts in tokens)
    got = lm.lm_scores(odd, steps=5).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_empty_tables(spark, bench):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    assert op06_decontaminate.leaks(none, bench).count() == 0
    assert op06_decontaminate.drop_leaks(none, spark.createDataFrame([], BENCH)).count() == 0
    assert op07_simhash_dedup.near_groups(none).count() == 0
    assert op08_exact_dedup.exact_dedup(none)["result"].count() == 0
    assert op03_sharding.shard(none).count() == 0
    assert op09_sentencepiece.encode(none).count() == 0
    assert quality.classify(none, labels).count() == 0
    assert lm.lm_scores(none, steps=2).count() == 0


def test_pipeline_stages(spark, odd, bench, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 13)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, str(tmp_path))
        assert kept.columns == odd.columns and kept.count() <= docs.count(), name
    left = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not left & {8, 9, 11}
