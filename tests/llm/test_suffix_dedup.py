"""Suffix-array dedup against brute force: suffix order, common prefixes, removed bytes."""

import hashlib
import random
from array import array

import pytest

from cohortlab.llm import op02_suffix_dedup as op

SCHEMA = "doc_id long, text string, rid string, spans int, data string"


def brute_suffixes(text, cap):
    order = sorted(range(len(text)), key=lambda i: list(text[i:]), reverse=True)
    out = []
    for k, i in enumerate(order):
        n, j = 0, order[k - 1]
        while k and n < cap and i + n < len(text) and j + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        out.append((i, n))
    return out


def brute_removed(rows, length=100):
    """Rows in corpus order -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_induced_order_and_common_prefixes(tmp_path, letters):
    rng = random.Random(letters)
    scratch = op.Scratch(str(tmp_path))
    for n in (0, 1, 2, 7, 40, 150):
        for repeat in (1, 3):
            text = array("H", [rng.randint(1, letters) for _ in range(n)] * repeat + [0])
            for limit in (4, 10_000):  # with and without runs on disk
                for cap in (5, 100):
                    assert list(op.suffixes(text, cap, scratch, limit)) == brute_suffixes(text, cap)
    scratch.close()
    assert not list(tmp_path.iterdir())


def corpus():
    rng = random.Random(7)
    words = ["alpha", "beta", "gämma", "delta", "ε", "zeta", "eta", "theta", "iota", "kappa"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common, other = text(60), text(45)
    rows = [(i, text(rng.randint(0, 80))) for i in range(30)]
    rows += [(100 + i, f"{text(5)} {common} {text(9)}") for i in range(25)]
    rows += [(200, common[3:130] + other), (201, other[20:] + common[50:]), (202, "a" * 700), (203, "ab" * 400 + "a" * 130),
             (204, None), (205, ""), (206, common[:101]), (207, common[1:102]), (208, common + common), (209, text(12_000)), (210, other)]
    rows += [(300 + i, other) for i in range(20)]
    rows += [(-5, common[10:]), (None, common)]
    return rows


@pytest.mark.parametrize("params", [{}, {"chunk_bytes": 600, "shard_bytes": 500, "queue_items": 16}, {"gram": 11, "chunk_bytes": 4000}])
def test_removed_bytes_match_brute_force(spark, params):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(5)
    want = brute_removed(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))
    got = op.kept_texts(docs, **params).collect()
    have = sorted((r.doc_id is None, r.doc_id or 0, len(r.data), len(r.data) - len(r.kept), len(r.spans) // 8,
                   hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert have == sorted((i is None, i or 0, *rest) for i, *rest in want)


def test_query_on_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_removed(sorted(((r.doc_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0)))
    assert sorted(map(tuple, op.query(spark, sf).collect())) == sorted(want)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.kept_texts(empty).count() == 0
    text = "the same text in every row, long enough to hold a window of one hundred bytes and some more of them, too"
    same = spark.createDataFrame([(1, text, "x", 1, "y")] * 3, SCHEMA)
    assert sorted(len(r.kept) for r in op.kept_texts(same).collect()) == [0, 0, len(text)]
