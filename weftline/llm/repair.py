"""Repair of conversation structure by signatures: each distinct signature is solved once.

A conversation's rows, in order, are written as a string of one character a row, which stands for the initial of
its role and its first fault.  Whatever is counted or repaired depends on that signature alone, so the
signatures are made distinct, each is solved once by a memoised recursion, and the audits are joined back
and replayed over the texts.

A row's edits are Keep (free), Rerole to user or assistant, Delete (the only one for blank and duplicate
rows); Insert adds an empty user or assistant turn anywhere; a truncated row that is not deleted costs
more.  The cheapest edits that give the role initials ``(s?(ua)+)?`` are sought, of equally cheap ones those
whose initials come first in ASCII.  The initials and the rows fix the roles, as the pattern alternates.

How it is distributed: equal rows of a turn are collapsed with their number before anything is shuffled; rows
are sorted by range of (conversation, turn), so a conversation of any size spreads over tasks, each of which
gives its piece of the signature, one byte a row.  Only the digest of a repaired conversation, which is a
sequential hash, reads its texts in one task, row by row, with nothing kept but the hash's state and the audit.

Defined results: where text is formed a null role, text, conversation id or turn is one space, so a null
text is blank; null turns come first; rows with equal turns stand by role, then by a hash of the text; a
null ``conv_id`` is a conversation of its own; repeated rows each count and the second is a duplicate; an
empty role has no initial and is neither of the three; very long texts and conversations are worked on whole; a conversation that
damage leaves no rows has zeros, an empty audit and the hash of the empty string; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.workers import give_back
from weftline.scratch import Scratch

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Signature characters: four roles (system, user, assistant, other) with no fault, truncated, duplicate, blank.
ROLES, FAULTS = "suax", ("none", "truncated", "duplicate", "blank")
#: Fixed value: white space.
WHITE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
SOLVED = "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def code(role: str, fault: str) -> str:
    return chr(ord("A") + 4 * ROLES.index(role) + FAULTS.index(fault))


def read(character: str) -> tuple[str, str]:
    """(role initial, fault) of a signature character."""
    n = ord(character) - ord("A")
    return ROLES[n // 4], FAULTS[n % 4]


#: What has been emitted: nothing, ``s``, an ``u`` or an ``a`` last.  A conversation may end in the first and the last.
BEGUN, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {BEGUN: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}


def _edits(character: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, next state) of what can be done with a row."""
    role, fault = read(character)
    out = [(DELETE, "D", state)]
    if fault in ("none", "truncated"):
        extra = TRUNCATED if fault == "truncated" else 0
        after = _AFTER[state]
        if role == "s" and state == BEGUN:
            out.append((extra, "K", SYSTEM))
        if role == ("u" if after == USER else "a"):
            out.append((extra, "K", after))
        out.append((REROLE + extra, "R", after))
    return out


@functools.cache
def _step(character: str, cost: tuple, place: tuple) -> tuple[int, tuple, tuple, bytes]:
    """One row of the recursion: (least cost, costs above it, places, choices) of the four states before the row.

    An audit from here is up to two insertions, an edit of the row and an audit of the rows after it, which
    its place stands for; no edit of a row has the initial I, so such keys compare as their audits do.
    """
    found = [min((cost[to] + c, (edit, place[to]), (edit, to, False)) for c, edit, to in _edits(character, state)) for state in range(4)]
    for _ in range(2):
        before = list(found)
        for state in range(4):
            to = _AFTER[state]
            found[state] = min(found[state], (before[to][0] + INSERT, ("I", *before[to][1]), ("I", to, True)))
    least, keys = min(c for c, _, _ in found), sorted({key for _, key, _ in found})
    return least, tuple(c - least for c, _, _ in found), tuple(keys.index(key) for _, key, _ in found), bytes(_CHOICES.index(choice) for _, _, choice in found)


#: What a state can choose: (edit, next state, whether the row is still to come); the end has no edit.
_CHOICES = [(edit, to, edit == "I") for edit in ("", *"DIKR") for to in range(4)]
#: At the end audits are "", "II", "I" and "".
_END = (0, (0, 2 * INSERT, INSERT, 0), (0, 2, 1, 0), bytes(_CHOICES.index(c) for c in (("", BEGUN, False), ("I", USER, True), ("I", ASSISTANT, True), ("", ASSISTANT, False))))


def solve(signature: str) -> tuple[int, str]:
    """(least cost, its ASCII-least audit): a recursion over the rows that are left and what was emitted last.

    It runs from the last row, so depth is no limit.  A step depends on the row, on how the costs of the four
    states differ and on the order of their audits, of which there are few, so steps are memoised over all
    signatures; four bytes a row are kept to read the audit off.
    """
    total, cost, place, choices = _END
    kept = bytearray(choices)
    for character in reversed(signature):
        more, cost, place, choices = _step(character, cost, place)
        total += more
        kept += choices
    out, state, at = [], BEGUN, len(signature)
    while edit := (choice := _CHOICES[kept[4 * at + state]])[0]:
        out.append(edit)
        state = choice[1]
        at -= not choice[2]
    return total + cost[BEGUN], "".join(out)


def measure(signature: str) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) rows of a signature."""
    counts, roles = dict.fromkeys(FAULTS, 0), []
    for character in signature:
        role, fault = read(character)
        counts[fault] += 1
        roles.append(role)
    illegal = sum(a + b not in LEGAL for a, b in zip(roles, roles[1:], strict=False))
    return counts["blank"], counts["duplicate"], counts["truncated"], illegal


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), *[pa.int64()] * 5, pa.string()]
    names = [x.split()[0] for x in SOLVED.split(", ")]
    for batch in batches:
        rows = [(s, *measure(s), *solve(s)) for s in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, conv, turn, role, text) rows after the contract's damage, by the CRC of ``conv_id:turn``."""
    def said(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    rows = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), said(F.col(role)).alias("role"), said(F.col(text)).alias("text"))
    rows = rows.select("*", said(F.col("conv_id")).alias("conv"), (F.crc32(F.concat(said(F.col("conv_id")), F.lit(":"), said(F.col("turn"))).cast("binary")) % 20).alias("kind"))
    whole = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), whole.alias("text"), copies.alias("copies"))


def collapsed(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their number: conv, turn, role, a and b (hashes of the text), n, blank, cut."""
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    return rows.filter("copies > 0").select(
        "conv", "turn", "role", "copies", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.reverse("text")).alias("b"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    ).groupBy("conv", "turn", "role", "a", "b").agg(F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))


def _coded(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, a, b, piece): the signature characters of each collapsed row."""
    first = rows.groupBy("conv", "role", "a", "b").agg(F.min(F.struct(F.col("turn").isNotNull().alias("late"), "turn")).alias("first"))
    here = F.struct(F.col("turn").isNotNull().alias("late"), "turn")
    initial = F.expr("CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")

    def char(fault: str) -> Column:
        return F.char(F.lit(ord("A") + FAULTS.index(fault)) + 4 * initial)

    rows = rows.join(first, ["conv", "role", "a", "b"])
    leader = F.when(here != F.col("first"), char("duplicate")).when(F.col("cut"), char("truncated")).otherwise(char("none"))
    rest = F.repeat(char("duplicate"), (F.col("n") - 1).cast("int"))
    piece = F.when(F.col("blank"), F.repeat(char("blank"), F.col("n").cast("int"))).otherwise(F.concat(leader, rest))
    return rows.select("conv", "turn", "role", "a", "b", piece.alias("piece"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, part, piece): a task's share of each conversation's signature."""
    from pyspark import TaskContext

    part, conv, held = TaskContext.get().partitionId(), None, []
    out: list[tuple[str, str]] = []

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([part] * len(out), pa.int32()), pa.array([x[1] for x in out], pa.string())], names=["conv", "part", "piece"])

    for batch in batches:
        for c, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if c != conv:
                if held:
                    out.append((conv, "".join(held)))
                conv, held = c, []
            held.append(piece)
        if len(out) >= 10_000:
            yield batch_of()
            out = []
    if held:
        out.append((conv, "".join(held)))
    yield batch_of()


ORDER = ("conv", "turn", "role", "a", "b")


def signatures(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, signature) of each conversation that has rows."""
    coded = scratch.write(_coded(rows), "coded")
    pieces = coded.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("conv", "piece").mapInArrow(_pieces, "conv string, part int, piece string")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda x: x["piece"]), "")
    return pieces.groupBy("conv").agg(joined.alias("signature"))


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def replay(rows: Iterator[dict]) -> Iterator[dict]:
    """Repaired digests, from each conversation's audit (``head``) followed by its rows in order."""
    head, sha, state, edits, begun = None, None, BEGUN, iter(""), False

    def say(role: str, text: str) -> None:
        nonlocal begun
        if begun:
            sha.update(b"\n")
        begun = True
        sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

    def until_row() -> str:
        """The next edit that takes a row, after the insertions before it; empty at the end."""
        nonlocal state
        for edit in edits:
            if edit != "I":
                return edit
            state = _AFTER[state]
            say("user" if state == USER else "assistant", "")
        return ""

    def close() -> dict:
        if until_row():
            raise ValueError(f"conversation {head['conv']} has fewer rows than its audit")
        return head | {"repaired_sha256": sha.hexdigest()}

    for row in rows:
        if row["head"]:
            if head is not None:
                yield close()
            head, sha, state, edits, begun = row, hashlib.sha256(), BEGUN, iter(row["audit"]), False
            continue
        for _ in range(row["n"]):
            edit = until_row()
            if not edit:
                raise ValueError(f"conversation {row['conv']} has more rows than its audit")
            if edit == "D":
                continue
            kept = edit == "K"
            state = SYSTEM if kept and state == BEGUN and row["role"][:1] == "s" else _AFTER[state]
            say(row["role"] if kept else "user" if state == USER else "assistant", row["text"])
    if head is not None:
        yield close()


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in REPAIRED.split(", ")]

    def each() -> Iterator[dict]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                yield from batch.slice(i, 500).to_pylist()

    def framed(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], t) for n, t in zip(names, kinds, strict=True)], names=names)

    out: list[dict] = []
    try:
        for row in replay(each()):
            out.append(row)
            if len(out) >= 2_000:
                yield framed(out)
                out = []
        yield framed(out)
    finally:
        give_back()


def repaired(conversations: DataFrame, rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Audit and digest (``REPAIRED``) of every conversation of ``conversations``, whose rows are ``rows`` (see :func:`damaged`)."""
    scratch = scratch or Scratch(rows.sparkSession, "repair")
    small = scratch.write(collapsed(rows), "rows")
    with_signature = signatures(small, scratch)
    spans = small.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    heads = every.join(with_signature, "conv", "left").join(spans, "conv", "left").withColumns({"signature": F.coalesce("signature", F.lit("")), "gaps": F.coalesce("gaps", F.lit(0).cast("long"))})
    heads = scratch.write(heads, "signatures")
    solved = scratch.write(heads.select("signature").distinct().mapInArrow(_solved, SOLVED), "solved")
    heads = heads.join(solved, "signature").drop("signature")
    hashes = [F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.reverse("text")).alias("b")]
    texts = rows.filter("copies > 0").select("conv", F.lit(False).alias("head"), "turn", "role", *hashes, F.col("copies").cast("int").alias("n"), "text")
    stream = texts.unionByName(heads.withColumn("head", F.lit(True)), allowMissingColumns=True)
    ordered = stream.repartition("conv").sortWithinPartitions("conv", F.desc("head"), "turn", "role", "a", "b")
    return ordered.select("head", "conv", "role", "n", "text", *[x.split()[0] for x in REPAIRED.split(", ")][:-1]).mapInArrow(_replayed, REPAIRED)


def op12(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every conversation, after the contract's damage."""
    return repaired(conversations, damaged(conversations))
