"""Operators 3, 4 and 10 against brute force, and columns of operators whose names clash."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from cohortlab.llm import op03_sharding, op04_warc, op05_quality, op06_decontaminate, op07_simhash_dedup, op08_exact_dedup, op10_url_filter
from cohortlab.llm.common import Scratch, release, shared_dir

PAGES = "page_id long, url string, html string"


def test_merge_in_passes_keeps_order_and_few_files(tmp_path):
    rng = random.Random(2)
    scratch, opened, most = Scratch(str(tmp_path)), [0], [0]
    plain = scratch.fs.open_input_stream

    class Counting:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def open_input_stream(self, path):
            f = plain(path)
            opened[0] += 1
            most[0] = max(most[0], opened[0])

            class Held:
                def __enter__(self):
                    return f

                def __exit__(self, *_):
                    opened[0] -= 1
                    f.close()

            return Held()

    scratch.fs = Counting(scratch.fs)
    runs = [sorted((rng.randrange(50), k, i) for i in range(rng.randrange(1, 30))) for k in range(200)]
    assert list(op04_warc.merge_runs(iter(runs), scratch, fan_in=3, held_rows=40)) == sorted(r for run in runs for r in run)
    assert 2 <= most[0] <= 2 * 3 and opened[0] == 0
    assert list(op04_warc.merge_runs(iter([]), scratch)) == []
    scratch.close()
    assert list(tmp_path.iterdir()) == []


def test_archive_against_brute_force(spark):
    long, other = "é" * 600, "y" * 1000
    rows = [(10**13, "http://a/b ", long), (-10**13, " http://a/b", long), (2**63 - 1, "http://b/", long), (5, None, other),
            (None, "http://c/%0A\r\n", other), (None, "", "z" * 2000), (7, "no url", None), (8, "http://x.y/ q", "short"),
            (9, "HTTP://X.Y/?a", "short"), (5, None, other), (12, "u", other + "1")]
    pages = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], PAGES + ", digest long").repartition(3)
    top = defaultdict(lambda: None)
    for i, _, html in rows:
        if i is not None and (top[html] is None or i > top[html]):
            top[html] = i
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and top[html] is not None and i != top[html]
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top[html] if revisit else None] += 1
    index = op04_warc.archive(pages, archive_bytes=3000, fan_in=2).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == want
    assert Counter(r.url for r in index) == Counter(r[1] or "" for r in rows)
    ordered = sorted(index, key=lambda r: (r.part, r.place))
    keys = [(r.urlkey, r.captured_at) for r in ordered]
    assert keys == sorted(keys)
    assert op04_warc.archive(spark.createDataFrame([], PAGES)).count() == 0


def test_record_ids_differ(spark):
    pages = spark.createDataFrame([(None, "a", "x"), (None, "a", "x"), (1, "a", "x"), (1, "a", "y")], PAGES)
    path = op04_warc.write_archives(pages)
    data = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    ids = [line for line in data.split("\r\n") if line.startswith("WARC-Record-ID")]
    assert len(set(ids)) == 4


def brute_verdict(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h) + len(p), len(p), v == "allow", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


@pytest.mark.parametrize("segment_bytes", [64 << 20, 40])
def test_urls_against_brute_force(spark, segment_bytes):
    rng = random.Random(4)
    hosts = ["com", "example.com", "www.example.com", "WWW.Example.Com", "net", "a.net", "xnet", "é.net", "", "com.", "notexample.com"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/es/a?b://c", "/fr/#/es/", "?q=/fr/", "/EN/", "/" + "z" * 5000]
    urls = [f"{rng.choice(['http', 'https', 'HTTP', ''])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "plain", "a://b://c/en/", "http:/example.com/en/", "://", "x\ny://a.net/es/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in op10_url_filter.filter_urls(pages, op10_url_filter.RULES, segment_bytes=segment_bytes).collect()}
    assert got == {k: brute_verdict(u, op10_url_filter.RULES) for k, u in enumerate(urls)}
    assert op10_url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), op10_url_filter.RULES).count() == 0


def test_url_keys_that_collide():
    rules = [("block", f"h{k}.org", "/") for k in range(40)]
    arrays = [op10_url_filter.DigestArray(s, key=lambda x: len(x) % 3) for s in op10_url_filter.build_segments(rules, 200, key=lambda x: len(x) % 3)]
    assert op10_url_filter.judge([("h7.org", "/a"), ("a.h33.org", "/"), ("h77.org", "/")], arrays, "allow") == [
        ("h7.org/", "block"), ("h33.org/", "block"), (None, "allow")]


def test_differencing_beats_greedy_and_is_even():
    rng = random.Random(6)
    for shards, n in ((2, 5), (4, 60), (16, 400), (3, 2)):
        sizes = [rng.randrange(1, 1000) for _ in range(n)]
        loads = [0] * shards
        for s, part in zip(sizes, op03_sharding.difference(sizes, shards), strict=True):
            loads[part] += s
        assert sum(loads) == sum(sizes)
        if n >= 50:  # largest first onto the least load
            greedy = [0] * shards
            for s in sorted(sizes, reverse=True):
                greedy[greedy.index(min(greedy))] += s
            assert max(loads) - min(loads) <= max(greedy) - min(greedy)
    assert op03_sharding.difference([], 4) == []
    # the textbook case: 8 7 6 5 4 in two parts differ by two
    two = op03_sharding.difference([8, 7, 6, 5, 4], 2)
    assert abs(sum(s if p else -s for s, p in zip([8, 7, 6, 5, 4], two, strict=True))) == 2


def test_shards_of_groups_ties_and_nulls(spark):
    rng = random.Random(8)
    texts = [None, "", "same " * 200] + ["".join(rng.choices("abé", k=rng.randrange(400))) for _ in range(600)]
    rows = [(k if k % 50 else None, texts[k % len(texts)]) for k in range(1500)] + [(3, "same " * 200)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = op03_sharding.shard(docs, bundles=512, cells=7).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, loads, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        homes[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values())  # groups stay whole
    giant = homes[1001, zlib.crc32(b"same " * 200)].pop()
    even = [loads[s] for s in range(16) if s != giant]
    assert max(even) - min(even) <= 0.02 * sum(even) / 15


CLASHES = ["_row_hash", "_kept_id", "_text_hash", "_lang_or", "_nth", "_own_sha", "_keep_id", "_i", "_ROW_NTH"]


def test_stages_keep_columns_with_clashing_names(spark):
    words = [f"word{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (None, None), (None, None), (3, " ".join(words[::-1])), (3, " ".join(words[::-1]))]
    docs = spark.createDataFrame([(i, t, "en", *[f"{c}{k}" for c in CLASHES]) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    want = {"quality": 6, "exact": 3, "near": 3, "leaks": 6}
    out = {"quality": op05_quality.keep_good(docs, labels),
           "exact": op08_exact_dedup.keep_first(docs), "near": op07_simhash_dedup.keep_one(docs), "leaks": op06_decontaminate.drop_leaks(docs, bench)}
    whole = {tuple(r) for r in docs.collect()}
    for name, frame in out.items():
        assert frame.columns == docs.columns, name
        got = [tuple(r) for r in frame.collect()]
        assert len(got) == want[name] and set(got) <= whole, name


def test_release_deletes_what_is_not_read(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id long, text string")
    kept = op08_exact_dedup.exact_dedup(docs)["result"]
    rows = sorted(map(tuple, kept.collect()))
    assert release(spark, keep=kept) > 0
    assert sorted(map(tuple, kept.collect())) == rows
    assert shared_dir(spark)
