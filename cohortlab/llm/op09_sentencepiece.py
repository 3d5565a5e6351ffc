"""SentencePiece encoding and decoding by the tokenizers library.

The model's protobuf is read field by field; normaliser, white-space marker, pieces,
scores and byte fallback are rebuilt as a tokenizers pipeline. Unigram models become
a Unigram with their scores. BPE models become a BPE whose merges are the splits of
each piece into two pieces, ranked by the piece's score. Where no piece holds a marker
behind another sign, merges never cross words: texts are cut at the markers, and each
distinct word of a worker goes through the pipeline once. Batches are encoded on
several threads. The ids of every row's whole text are decoded again (pieces are joined
here; texts with bytes beyond ASCII by the library's decoder) and compared with the text, and compared with the ids that the sentencepiece library gives the whole text.

Defined results: a null or empty text has no ids, decodes to the empty text and is
in parity. Rows and columns besides doc_id and text do not matter; an empty table gives
an empty result; texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import table, text_or_empty

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
MODEL_MAX_BYTES = 64 << 20
GROUP_BYTES = 2 << 20
WORD_TABLE = 800_000
# Fixed values of the model format: marker of a space, piece types, model types.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if b < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


def parse_model(data: bytes) -> dict:
    model = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "charsmap": b"", "prefix": True, "squeeze": True,
             "escape": True, "suffix": False}
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model["pieces"].append((piece, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model["type"] = v
                elif n == 24:
                    model["suffix"] = bool(v)
                elif n == 35:
                    model["byte_fallback"] = bool(v)
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    model["charsmap"] = v
                elif n in (3, 4, 5):
                    model[{3: "prefix", 4: "squeeze", 5: "escape"}[n]] = bool(v)
    if model["type"] not in (UNIGRAM, BPE) or model["suffix"]:
        raise ValueError("only unigram and BPE models with the marker before a word are supported")
    return model


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    ranked = {p: s for p, s, kind in pieces if kind in (NORMAL, USER_DEFINED)}
    found = []
    for i, (piece, score, kind) in enumerate(pieces):
        if kind == NORMAL:
            found += [(-score, i, k, piece[:k], piece[k:]) for k in range(1, len(piece))
                      if piece[:k] in ranked and piece[k:] in ranked]
    return [(left, right) for *_, left, right in sorted(found)]


def words_apart(pieces: list[tuple[str, float, int]]) -> bool:
    """No piece holds a marker behind another sign, so that none crosses a word border."""
    return all(MARK not in p.lstrip(MARK) for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED))


def build_tokenizer(model: dict):
    """The tokenizers pipeline of a parsed model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    pieces = model["pieces"]
    unk = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
    if model["type"] == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=unk, byte_fallback=model["byte_fallback"])
    else:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(pieces)}, merges_of(pieces), unk_token=pieces[unk][0],
                          fuse_unk=True, byte_fallback=model["byte_fallback"])
    tok = Tokenizer(core)
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["squeeze"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["prefix"]:
        steps.append(normalizers.Prepend(MARK if model["escape"] else " "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tok.normalizer = normalizers.Sequence(steps)
    if words_apart(pieces) and model["escape"] and model["type"] == BPE:
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    back = [decoders.ByteFallback(), decoders.Fuse()]
    if model["escape"]:  # on the joined text; encoding never spells the marker by byte pieces
        back.append(decoders.Replace(MARK, " "))
    if model["prefix"]:
        back.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(back)
    own = [AddedToken(p, normalized=False) for p, _, kind in pieces if kind == USER_DEFINED]
    if own:
        tok.add_tokens(own)
    return tok


def spelling(piece: str) -> str | None:
    """The text of a piece; None of a byte beyond ASCII, which is no sign by itself."""
    if not re.fullmatch("<0x[0-9A-Fa-f]{2}>", piece):
        return piece
    return chr(code) if (code := int(piece[3:5], 16)) < 128 else None


class Codec:
    """Encoder and decoder of one model in one Python worker.

    If merges cannot cross words, a text is the concatenation of its words, so each
    distinct word is encoded once and kept in two half tables of about ``WORD_TABLE``
    words; the older half goes when the other is full. Round trip and parity are those of
    whole texts."""

    def __init__(self, data: bytes, threads: int = THREADS, word_table: int = WORD_TABLE):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece

        self.threads, self.word_table = threads, word_table
        self.model = m = parse_model(data)
        self.tok = build_tokenizer(m)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.by_word = (m["type"] == BPE and words_apart(m["pieces"]) and m["escape"] and m["prefix"] and not m["squeeze"]
                        and not m["charsmap"] and all(kind != USER_DEFINED for *_, kind in m["pieces"]))
        from tokenizers import Tokenizer

        self.bare = Tokenizer(self.tok.model)
        self.opens = np.array([p.startswith(MARK) for p, *_ in m["pieces"]])
        self.spelled = [spelling(p) for p, *_ in m["pieces"]]
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def judged(self, texts: list[str], ids: list[bytes]) -> list[tuple[bytes, bool, bool]]:
        """Ids as bytes, round trip and parity of whole texts."""
        said = self.library.encode(texts, num_threads=self.threads)
        same = [i == array("i", r).tobytes() for i, r in zip(ids, said, strict=True)]
        # where the library gave equal ids, they are not made into a list again
        back = self.decode([r if s else array("i", i).tolist() for i, r, s in zip(ids, said, same, strict=True)])
        return [(i, b == t, s) for i, b, t, s in zip(ids, back, texts, same, strict=True)]

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts taken whole."""
        return [np.asarray(e.ids, np.int32).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Encode words as batches of word lists, which the threads share. A list whose pieces do
        not show the words' borders is encoded word by word."""
        lists = [words[k:k + 2000] for k in range(0, len(words), 2000)]
        found = self.bare.encode_batch_fast([[MARK + w for w in part] for part in lists], is_pretokenized=True, add_special_tokens=False)
        for part, e in zip(lists, found, strict=True):
            ids = np.asarray(e.ids, np.int32)
            ends = np.append(np.flatnonzero(self.opens[ids]), len(ids))  # a word's first piece holds its marker
            cut = ends.tolist()
            if len(cut) == len(part) + 1:
                self.words.update((w, ids[a:b].tobytes()) for w, a, b in zip(part, cut[:-1], cut[1:], strict=True))
            else:
                self.words.update(zip(part, self.whole(part), strict=True))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        out = [b""] * len(texts)
        # neighbouring markers may merge; texts that have them go whole
        whole = [i for i, t in enumerate(texts) if t and (not self.by_word or "  " in t or MARK in t or t[0] == " " or t[-1] == " ")]
        if whole:
            for i, found in zip(whole, self.whole([texts[i] for i in whole]), strict=True):
                out[i] = found
        table, taken = self.words, set(whole)
        cut = [(i, text.split(" ")) for i, text in enumerate(texts) if text and i not in taken]
        new = set().union(*(words for _, words in cut)).difference(table)
        again = new.intersection(self.older)
        table.update((w, self.older[w]) for w in again)
        new -= again
        if new:
            self.learn(sorted(new))
        for i, words in cut:
            out[i] = b"".join(map(table.__getitem__, words))
        if len(table) > self.word_table // 2:  # words that were not met again go with the older half
            self.older, self.words = table, {}
        return self.judged(texts, out)

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of the ids. Lists without byte pieces beyond ASCII are joined here, the steps of the
        tokenizer's decoder in its order; the others go through that decoder."""
        out, rest, spelled = [], [], self.spelled.__getitem__
        for k, each in enumerate(ids):
            try:
                text = "".join(map(spelled, each))
            except TypeError:  # a byte that others complete
                text = ""
                rest.append(k)
            if self.model["escape"]:
                text = text.replace(MARK, " ")
            out.append(text[1:] if self.model["prefix"] and text.startswith(" ") else text)
        if rest:
            for k, text in zip(rest, self.tok.decode_batch([ids[k] for k in rest], skip_special_tokens=False), strict=True):
                out[k] = text
        return out


_codec: dict[tuple, Codec] = {}


def worker_codec(data: bytes, threads: int) -> Codec:
    """The codec of a Python worker: built by its first task, used again by the next ones. A
    worker holds one model at a time."""
    key = (hashlib.sha256(data).digest(), threads)
    if key not in _codec:
        _codec.clear()
        _codec[key] = Codec(data, threads)
    return _codec[key]


OUT = "n_bytes long, n_tokens long, n_byte_tokens long, ids array<int>, ids_crc32 long, round_trip boolean, parity boolean"


def encode(docs: DataFrame, model: str | bytes = MODEL_PATH, threads: int = THREADS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Ids of every row's whole text, with round trip and parity. Texts go to the
    threads in groups of about ``group_bytes``, so that memory follows the longest text."""
    import zlib

    spark = docs.sparkSession
    if isinstance(model, str):
        with open(model, "rb") as f:
            model = f.read()
    if len(model) > MODEL_MAX_BYTES:
        raise ValueError(f"a model of {len(model)} bytes is too large to broadcast")
    shared = spark.sparkContext.broadcast(model)
    source = docs.select("doc_id", text_or_empty("text").alias("text"))
    kind = dict(source.dtypes)["doc_id"]

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
        texts, begin, size = [], 0, 0
        for k, x in enumerate(batch.column(1)):
            texts.append(x.as_py())
            size += len(texts[-1])
            if size >= group_bytes:
                yield batch.column(0).slice(begin, k + 1 - begin), texts
                texts, begin, size = [], k + 1, 0
        if texts:
            yield batch.column(0).slice(begin), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared.value, threads)
        low = next((i for i, p in enumerate(codec.model["pieces"]) if p[2] == BYTE), -1)
        for batch in batches:
            for doc_ids, texts in groups(batch):
                found = codec.encode(texts)
                arrays = [np.frombuffer(f[0], np.int32) for f in found]
                flat = np.concatenate(arrays)
                ends = np.cumsum([0, *map(len, arrays)])
                fallback = np.concatenate([[0], np.cumsum((flat >= low) & (flat < low + 256))]) if low >= 0 else np.zeros(len(flat) + 1)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([
                    doc_ids, pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array(np.diff(ends), pa.int64()), pa.array((fallback[ends[1:]] - fallback[ends[:-1]]).astype(np.int64)),
                    ids, pa.array([zlib.crc32(f[0]) for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found], pa.bool_())],
                    ["doc_id", *(x.split()[0] for x in OUT.split(", "))])

    return source.mapInArrow(run, f"doc_id {kind}, {OUT}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
