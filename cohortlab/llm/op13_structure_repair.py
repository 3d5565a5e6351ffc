"""Conversation structure repair by iterative-deepening A*.

Every conversation's rows, in order, are put right by the cheapest edits that leave role
initials ``(s?(ua)+)?``: Keep (0), Rerole (1), Delete (2; required for blank rows and
repeats), Insert (5); a row that ends without ``[.!?]`` and stays adds 5. The search goes
depth first in ASCII order of the edits (D, I, K, R) under cost bounds that grow by the
least excess seen. A table holds, for each place and role state, the largest budget that
is known to fail there. All paths that accept cost as much as the bound, so the first one
is the ASCII-least cheapest answer. The lower bound of the rest comes from the relaxed
problem that lets any number of system turns open a conversation: one backward pass,
three numbers a row.

Rows carry one byte (role class and fault) into the search; their texts follow in a second
pass that streams each conversation behind its edits into a running digest, so no task
holds a conversation's texts. Its bytes of state, its bounds and its table do pass through
one task.

Defined results: rows are ordered by turn (nulls first), then role and digest of the
text; null roles, texts and turns read as one space; roles whose first character is not
s, u or a (and empty ones) can stay only by Rerole; rows without conv_id are left out;
repeated rows are rows; a conversation without rows after damage has zeros and empty
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import placed, stage, table

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5  # costs
CLASSES = "xsua"  # role classes by number: other, system, user, assistant
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # what the conversation's last turn is
ACCEPTS = (START, ASSISTANT)
# state after a kept turn of each class, None where it may not follow
AFTER = [[None, SYSTEM, USER, None], [None, None, USER, None], [None, None, None, ASSISTANT], [None, None, USER, None]]
TURNED = [USER, USER, ASSISTANT, USER]  # state after a turn whose role is chosen
REPAIR_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def lower_bounds(codes: bytes) -> np.ndarray:
    """Row i: least cost of the rows from i on in the relaxed problem, before the first user
    turn, where a user turn is next and where an assistant turn is."""
    out = np.empty((len(codes) + 1, 3), np.int64)
    opening, user, assistant = 0, 0, INSERT
    out[len(codes)] = opening, user, assistant
    never = 1 << 60
    for i in range(len(codes) - 1, -1, -1):
        kind, fault = divmod(codes[i], 4)
        o, u, a = DELETE + opening, DELETE + user, DELETE + assistant
        if fault not in (BLANK, DUPLICATE):
            stays = CUT_SHORT if fault == TRUNCATED else 0
            as_user = stays + assistant + (0 if kind == USER else REROLE)
            o = min(o, as_user, stays + opening if kind == SYSTEM else never)
            u = min(u, as_user)
            a = min(a, stays + user + (0 if kind == ASSISTANT else REROLE))
        opening, user, assistant = min(o, INSERT + a), min(u, INSERT + a), min(a, INSERT + u)
        out[i] = opening, user, assistant
    return out


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and edits (initials) of rows given by ``4 * role class + fault``."""
    n = len(codes)
    bounds = lower_bounds(codes)
    rest = bounds[:, [0, 0, 2, 1]].tolist()  # by place and state
    failed = np.full((n + 1, 4), -1, np.int64)

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, place, state) in ASCII order."""
        if i < n:
            yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, TURNED[state]
        if i < n:
            kind, fault = divmod(codes[i], 4)
            if fault in (BLANK, DUPLICATE):
                return
            stays = CUT_SHORT if fault == TRUNCATED else 0
            if AFTER[state][kind] is not None:
                yield "K", KEEP + stays, i + 1, AFTER[state][kind]
            yield "R", REROLE + stays, i + 1, TURNED[state]

    bound = rest[0][START]
    while True:
        excess = 1 << 60
        path: list[str] = []
        frames = [(0, START, bound, edits(0, START))]
        while frames:
            i, state, budget, left = frames[-1]
            if i == n and state in ACCEPTS:
                return bound, "".join(path)
            for name, cost, j, then in left:
                remains = budget - cost
                if rest[j][then] > remains:
                    excess = min(excess, rest[j][then] - remains)
                elif failed[j, then] < remains:
                    path.append(name)
                    frames.append((j, then, remains, edits(j, then)))
                    break
            else:
                failed[i, state] = max(failed[i, state], budget)
                frames.pop()
                if path:
                    path.pop()
        bound += excess if excess < 1 << 60 else 1


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that the ids decide."""
    space = F.lit(" ")
    turn = F.col("turn").cast("long")
    kind = (F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(turn.cast("string"), space)).cast("binary")) % 20)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), kind.alias("kind")).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), times)).alias("nth")).drop("nth")


def coded(rows: DataFrame) -> DataFrame:
    """``conv_id, place, turn, code, role, text``: the rows in order with class and fault."""
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    at = placed(rows.withColumn("digest", digest), "conv_id", ["turn", "role", "digest"], "repair-rows")
    earlier = F.min("place").over(Window.partitionBy("conv_id", "digest")) < F.col("place")
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(earlier, DUPLICATE)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(0))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(0)
    return at.select("conv_id", "place", "turn", (kind * 4 + fault).cast("int").alias("code"), "role", "text")


class Audit:
    """What one conversation's rows, fed in order, add up to."""

    def __init__(self, conv_id: int):
        self.conv_id, self.codes = conv_id, bytearray()
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, code: int) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.high:  # rows come in order of their turns
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> tuple:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        kinds, faults = codes // 4, codes % 4
        pairs = kinds[:-1] * 4 + kinds[1:]
        legal = np.isin(pairs, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
        cost, audit = cheapest_edits(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *(int((faults == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), int((~legal).sum()), cost, audit)


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over (conv_id, turn, code) in order: a row of ``REPAIR_SCHEMA`` a conversation."""
    kinds = [pa.int64()] * 7 + [pa.string()]
    names = [c.split()[0] for c in REPAIR_SCHEMA.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    now: Audit | None = None
    for b in batches:
        rows = []
        for conv_id, turn, code in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    rows.append(now.row())
                now = Audit(conv_id)
            now.add(turn, code)
        yield out(rows)
    if now is not None:
        yield out([now.row()])


class Repaired:
    """The running digest of one conversation's repaired lines."""

    def __init__(self, conv_id: int, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, START
        self.digest, self.lines = hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def turned(self, text: str) -> None:
        self.state = TURNED[self.state]
        self.line("user" if self.state == USER else "assistant", text)

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.turned("")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.turned(text)
        elif edit == "K":
            self.state = AFTER[self.state][CLASSES.index(role[0])]
            self.line(role, text)

    def row(self) -> tuple[int, str]:
        self.inserts()
        return self.conv_id, self.digest.hexdigest()


def write_repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over (conv_id, role, text) in order, each conversation's edits (role null)
    before its rows: the digest of its repaired lines."""
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    now: Repaired | None = None
    for b in batches:
        rows = []
        for conv_id, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if role is None:
                if now is not None:
                    rows.append(now.row())
                now = Repaired(conv_id, text)
            else:
                now.add(role, text)
        yield out(rows)
    if now is not None:
        yield out([now.row()])


def repair(rows: DataFrame) -> DataFrame:
    """``REPAIR_SCHEMA`` and ``repaired_sha256`` of each conversation in ``rows(conv_id,
    turn, role, text)``."""
    at = coded(rows)
    codes = at.select("conv_id", "turn", "code", "place").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    audits = stage(codes.select("conv_id", "turn", "code").mapInArrow(search, REPAIR_SCHEMA), "repair-audits")
    lines = at.select("conv_id", "place", "role", "text").union(
        audits.select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("string"), "audit"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return audits.join(lines.mapInArrow(write_repairs, "conv_id long, repaired_sha256 string"), "conv_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    ids = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(repair(damaged(conversations)), "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
