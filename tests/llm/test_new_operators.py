"""Prefix trie, Jaccard join and structure repair against brute force; odd rows."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cohortlab.llm import op11_prefix_trie as trie
from cohortlab.llm import op12_jaccard_join as jaccard
from cohortlab.llm import op13_structure_repair as repair

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, place int, digest string"
DOCS = "doc_id long, text string, lang string, sid int, size string"


def turns(n_convs, seed=1):
    """Conversations with common heads, copies, nulls, repeated rows and turns."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_convs):
        if c % 7 == 5:
            continue
        for t in range(int(rng.integers(1, 7))):
            role = ["system", "user", "assistant", None, "tool"][int(rng.choice(5, p=[.1, .4, .4, .05, .05]))]
            text = [f"line {rng.integers(3)}.", "no end", "", None, " \t", "Same words here?"][int(rng.choice(6, p=[.5, .2, .05, .05, .05, .15]))]
            rows.append((c, t if rng.random() > .05 else None, role, text, 7, "z"))
    rows += [(1, 0, "user", "twin.", 7, "z")] * 2 + [(2000, 3, "user", "alone", 7, "z"), (2001, 9, None, None, 7, "z"), (None, 1, "user", "nobody", 7, "z")]
    return rows


def in_order(rows):
    convs = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), text, t))
    return {c: [(r[2], r[4], r[5]) for r in sorted(v, key=lambda r: r[:4])] for c, v in convs.items()}


def brute_trie(rows):
    own = in_order([(c, t, r or "", x or "") for c, t, r, x, *_ in rows])
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = [(r, x) for r, x, _ in own.get(c - c % 20, [])[:h] + v[h:]]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = {}

    def under(node):
        got = [under(k) for k in kids[node]]
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves, saved = sum(g[0] for g in got) or 1, sum(g[1] for g in got) + (len(members[node]) - 1) * words
        ends = ",".join(str(c) for c in members[node] if len(whole[c]) == len(node))
        out[node] = (members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(got), leaves, saved,
                     hashlib.sha256(ends.encode()).hexdigest())
        return leaves, saved

    if members:
        under(())
    return sorted(out.values(), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("most", [3, 4096])
def test_trie_matches_brute_force(spark, most):
    rows = turns(150)
    nodes = trie.trie(trie.rebuilt(trie.turn_rows(spark.createDataFrame(rows, TURNS).repartition(5))), most=most)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in nodes.collect()), key=repr) == brute_trie(rows)


def test_trie_of_equal_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t % 3}", 0, "") for c in (0, 20, 40, 41) for t in range(300)]
    nodes = trie.trie(trie.rebuilt(trie.turn_rows(spark.createDataFrame(rows, TURNS))), most=2, most_turns=250)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in nodes.collect()), key=repr) == brute_trie(rows)


def test_trie_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = trie.query(spark, SF_SMALL)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == brute_trie(rows)


def test_trie_of_no_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.trie(trie.rebuilt(trie.turn_rows(none))).count() == 0


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_classes(docs, percent=90):
    sets = []
    for _, text in docs:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        least[top(i)] += [d] if d is not None else []
    return sorted(((d, len(s), min(least[top(i)], default=None)) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def near_copies(seed):
    """Families of near copies around texts that are there or not, chains, common lines,
    copies, short and odd texts."""
    rng = np.random.default_rng(seed)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**7, n)]
    line = fresh(25)
    texts = [None, "", " \n", "one", "One", "two words", "two  WORDS", "two words more", "a a a a a a a", "a a a", "über Äpfel \x0b 😀", "x " * 3000]
    for family in range(6):
        base = fresh(int(rng.integers(40, 120)))
        if family % 2:
            texts.append(" ".join(base))
        for _ in range(14):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = fresh(1)[0]
            texts.append(" ".join(w))
    chain = fresh(90)
    for _ in range(20):
        chain = chain[2:] + fresh(2)
        texts.append(" ".join(chain))
    texts += [" ".join(line + fresh(int(rng.integers(0, 60)))) for _ in range(60)]
    texts += [" ".join(fresh(1) + line + line + fresh(1)) for _ in range(15)]
    texts += [texts[20]] * 9
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    return docs + [(None, texts[30]), (None, None), docs[25], (docs[3][0], texts[40])]


@pytest.mark.parametrize("seed, small", [(1, {}), (2, {"bucket_pairs": 300, "block": 3}), (3, {"one_in": 3, "block": 5}), (4, {"one_in": 10**6})])
def test_jaccard_matches_brute_force(spark, seed, small):
    docs = near_copies(seed)
    df = spark.createDataFrame([(i, t, "en", 0, "s") for i, t in docs], DOCS).repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(df, **small).collect()), key=repr)
    assert got == brute_classes(docs)


def test_jaccard_query_on_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.query(spark, SF_SMALL).collect()), key=repr)
    assert got == brute_classes(docs)


def test_jaccard_of_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert jaccard.classes(none).count() == 0
    blank = spark.createDataFrame([(1, None, "", 0, ""), (2, " ", "", 0, "")], DOCS)
    assert sorted(tuple(r) for r in jaccard.classes(blank).select("doc_id", "n_shingles", "component_id").collect()) == [(1, 0, 1), (2, 0, 2)]


def brute_edits(codes):
    """Cheapest (cost, edits) by uniform-cost search over all edits. Paths of one cost to one
    place and last role have no other as a prefix, so the first of them is the best."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, roles = heapq.heappop(heap)
        if (i, roles[-1:]) in seen or not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        seen.add((i, roles[-1:]))
        if i == len(codes) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit
        for r in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", i, roles + r))
        if i < len(codes):
            kind, fault = divmod(codes[i], 4)
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles))
            if fault not in (1, 2):
                more = 5 if fault == 3 else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, roles + "xsua"[kind]))
                for r in "ua":
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, roles + r))


def test_edits_match_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(250):
        n = int(rng.integers(0, 12))
        codes = bytes((4 * rng.choice(4, p=[.1, .2, .35, .35], size=n) + rng.choice(4, p=[.55, .1, .1, .25], size=n)).tolist())
        assert repair.cheapest_edits(codes) == brute_edits(codes)
    mixed = [bytes([4 * k + f for k, f in zip(rng.integers(0, 4, 5), rng.integers(0, 4, 5), strict=True)]) for _ in range(150)]
    for codes in mixed:
        assert repair.cheapest_edits(codes) == brute_edits(codes)


def test_bounds_never_exceed_the_cost():
    rng = np.random.default_rng(9)
    for _ in range(40):
        codes = bytes(rng.integers(0, 16, 300).tolist())
        assert repair.lower_bounds(codes)[0, 0] <= repair.cheapest_edits(codes)[0]


def test_long_conversation_is_searched():
    codes = bytes(np.random.default_rng(4).integers(0, 16, 20_000).tolist())
    cost, audit = repair.cheapest_edits(codes)
    assert cost > 0 and len(audit) >= 20_000


def brute_repairs(rows):
    hurt, ids = [], {r[0] for r in rows if r[0] is not None}
    for c, t, role, text, *_ in rows:
        if c is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        x = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if x == 0:
            continue
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        hurt += [(c, t, "user" if x == 4 else role, text)] * (2 if x == 3 else 1)
    by_conv = in_order(hurt)
    out = []
    for c in ids:
        rows, seen, faults = by_conv.get(c, []), set(), []
        for role, text, _ in rows:
            last = (WORD.findall(text) or [""])[-1][-1:]
            faults.append(1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0)
            seen.add((role, text))
        first = [r[:1] if r[:1] in ("s", "u", "a") else "x" for r, _, _ in rows]
        numbers = [t for _, _, t in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, audit = brute_edits([4 * "xsua".index(k) + f for k, f in zip(first, faults, strict=True)])
        lines, roles, left = [], "", iter(rows)
        for e in audit:
            role, text = "", ""
            if e != "I":
                role, text, _ = next(left)
            if e in "RI":
                role = "assistant" if roles.endswith("u") else "user"
            if e != "D":
                lines.append(f"{role}:{text}")
                roles += role[0]
        assert re.fullmatch(r"(s?(ua)+)?", roles)
        out.append((c, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


REPAIRED = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_matches_brute_force(spark, tmp_path):
    rows = turns(120, seed=3)
    spark.createDataFrame(rows, TURNS).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = repair.query(spark, str(tmp_path))
    assert sorted(tuple(r[c] for c in REPAIRED) for r in got.collect()) == brute_repairs(rows)


def test_repair_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(tuple(r[c] for c in REPAIRED) for r in repair.query(spark, SF_SMALL).collect())
    assert got == brute_repairs(rows)


def test_repair_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert repair.query(spark, str(tmp_path)).count() == 0


def test_shared_pairs_hold_owners_not_ids():
    import tracemalloc

    import numpy as np

    from cohortlab.llm import op12_jaccard_join as J

    r = np.random.default_rng(5)
    n, n_sets = 200_000, 300
    sids, sizes = r.integers(-(1 << 62), 1 << 62, n_sets), r.integers(1, 900, n_sets)
    value, owner = r.integers(0, 9_000, n).astype(np.uint64), r.integers(0, n_sets, n).astype(np.uint32)
    tracemalloc.start()
    got = J.shared_pairs(value, owner, np.append(sids, sids[:1]), np.append(sizes, sizes[:1]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75 * n  # 110 bytes a pair, and 48 before the call, with ids and sizes for each pair
    pairs = set(zip(value.tolist(), sids[owner].tolist()))
    times = {}
    for v, _ in pairs:
        times[v] = times.get(v, 0) + 1
    size = dict(zip(sids.tolist(), sizes.tolist()))
    want = sorted((v, s, size[s], times[v]) for v, s in pairs if times[v] > 1)
    assert sorted(zip(*(c.tolist() for c in got))) == want


def test_parity_lists_are_decoded():
    from cohortlab.llm import op09_sentencepiece as S

    with open(S.MODEL_PATH, "rb") as f:
        codec = S.Codec(f.read())
    decoded, said, encode, decode = [], [], codec.library.encode, codec.decode

    class Library:
        def encode(self, texts, num_threads):
            said.append(encode(texts, num_threads=num_threads))
            return said[-1]

    codec.library = Library()
    codec.decode = lambda ids: (decoded.append(ids), decode(ids))[1]
    texts = ["one two one", "", "a  b", " c", "zwölf two"]
    for _ in range(2):  # new words, then known ones
        got = codec.encode(texts)
        assert [(t[1], t[2]) for t in got] == [(True, True)] * len(texts)
    assert all(a is b for ours, theirs in zip(decoded, said, strict=True) for a, b in zip(ours, theirs, strict=True))
