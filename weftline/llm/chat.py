"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and only that
reply (its text, not its markers) is under the loss mask.  What follows the last assistant turn, or a
conversation without one, becomes a closing example without a target, so no turn is lost.

Template, per turn: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.  Roles and texts are escaped so that no
control string of this or other common templates can occur inside them: a backslash is doubled, and
a backslash goes after the first character of every place where a control string begins.  In a role a
line feed is escaped too.  Reading takes each backslash away and keeps the character after it.

``expand`` makes the examples of a stream of turns.  The context of each is the very text of all turns
before it; examples of a conversation share it as a rope, so that expanding costs what the turns cost
and not the square of a conversation's length.  ``materialise`` writes each example's full text out, a row
at a time, where a trainer wants it; ``prefix_targets`` writes the segment that each example adds, its place in the
whole, and the digest of its context; and the registered query reads turns and loss back from the expanded
examples: turns from their contexts and what follows, loss from their targets.

Rows of one conversation are sorted by (turn, role, text) on the executors and streamed: a partition
is read batch by batch, and readers let go of the turns they have read, so an example's own turns are
the most that is held, however long a conversation is (``materialise`` alone holds a whole one).

Defined results: null roles and texts are empty; null turns come first and a null conv_id is one
conversation; turns with equal numbers are ordered by role, then text; repeated rows are turns of
their own; very long texts are formatted whole; an empty table gives no examples; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates; none is the beginning of another.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

#: A longer run of turns without a reply is handed on in pieces without a target.
PIECE_TURNS = 4_096
#: Characters of rows that are held before they are handed on.
HELD_CHARS = 4_000_000
EXAMPLES = (
    "conv_id long, example_no long, segment string, segment_start long, target_start long, target_end long, end long, context_sha256 string"
)
TEXTS = "conv_id long, example_no long, context string, target string, closing string"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends in it."""
    head = START + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(segment: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn in formatted text."""
    for m in _TURN.finditer(segment):
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)


def _null(x) -> bool:
    return x is None or x != x


class Rope:
    """Formatted turns of one conversation, from ``base`` on: a reader may let go of what it has read."""

    def __init__(self, turns: list[str] | None = None):
        self.base, self.turns = 0, turns or []

    def __len__(self) -> int:
        return self.base + len(self.turns)

    def text(self, a: int, b: int) -> str:
        if a < self.base:
            raise ValueError("turns that were let go are asked for")
        return "".join(self.turns[a - self.base : b - self.base])

    def let_go(self, upto: int) -> None:
        del self.turns[: max(0, upto - self.base)]
        self.base = max(self.base, upto)


@dataclass
class Example:
    """One example: all turns before a reply, and the reply; ``target`` is None where turns close a conversation.

    The first ``n_context`` turns of the conversation's rope are this example's context, and ``head`` is
    what stands before the target in the last turn.
    """

    conv: int | None
    number: int
    rope: Rope
    n_context: int
    head: str
    target: str | None
    closing: str

    def context(self, since: int = 0) -> str:
        """Formatted text before the target, from turn ``since`` on."""
        return self.rope.text(since, self.n_context) + self.head


def expand(turns: Iterator[tuple[int | None, str, str]]) -> Iterator[Example]:
    """The examples of turns (conversation, role, text) that come conversation by conversation, in order."""
    conv, begun, number, rope, open_ = None, False, 0, Rope(), 0
    for c, role, text in turns:
        if not begun or c != conv:
            if open_:
                yield Example(conv, number, rope, len(rope), "", None, "")
            conv, begun, number, rope, open_ = c, True, 0, Rope(), 0
        turn, lo, hi = format_turn(role, text)
        if role == "assistant":
            yield Example(conv, number, rope, len(rope), turn[:lo], turn[lo:hi], turn[hi:])
            number, open_ = number + 1, 0
        else:
            open_ += 1
        rope.turns.append(turn)
        if open_ >= PIECE_TURNS:
            yield Example(conv, number, rope, len(rope), "", None, "")
            number, open_ = number + 1, 0
    if open_:
        yield Example(conv, number, rope, len(rope), "", None, "")


def _turns(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, str, str]]:
    for pdf in batches:
        for c, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"], strict=True):
            yield None if _null(c) else int(c), "" if _null(role) else role, "" if _null(text) else text


def _framed(rows: Iterator[tuple], schema: str, size) -> Iterator[pd.DataFrame]:
    """Frames of rows; ``size`` says how many characters a row holds."""
    fields = [x.split() for x in schema.split(", ")]
    out, held = [], 0

    def frame() -> pd.DataFrame:
        pdf = pd.DataFrame(out, columns=[n for n, _ in fields], dtype=object)
        return pdf.astype({n: "Int64" for n, kind in fields if kind == "long"})

    for row in rows:
        out.append(row)
        held += size(row) + 100
        if held >= HELD_CHARS:
            yield frame()
            out, held = [], 0
    yield frame()


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        conv, begun, seen, at, sha = None, False, 0, 0, hashlib.sha256()
        for x in expand(_turns(batches)):
            if not begun or x.conv != conv or not x.number:
                conv, begun, seen, at, sha = x.conv, True, 0, 0, hashlib.sha256()
            new = x.context(seen)
            before = sha.copy()
            before.update(new.encode("utf-8", "surrogatepass"))
            start, whole = at, new + (x.target or "") + x.closing
            lo, hi = (None, None) if x.target is None else (at + len(new), at + len(new) + len(x.target))
            sha.update(whole.encode("utf-8", "surrogatepass"))
            seen, at = x.n_context + (x.target is not None), at + len(whole)
            x.rope.let_go(x.n_context)
            yield x.conv, x.number, whole, start, lo, hi, at, before.hexdigest()

    yield from _framed(rows(), EXAMPLES, lambda r: len(r[2]))


def _full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = ((x.conv, x.number, x.context(), x.target, x.closing) for x in expand(_turns(batches)) if x.target is not None)
    yield from _framed(rows, TEXTS, lambda r: len(r[2]) + len(r[3]))


def in_order(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with a conversation's rows together and sorted."""
    rows = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def prefix_targets(df: DataFrame, **columns: str) -> DataFrame:
    """One row per example (``EXAMPLES``): what it adds to its conversation, where, and the digest of all before its target."""
    return in_order(df, **columns).select("conv_id", "role", "text").mapInPandas(_segments, EXAMPLES)


def materialise(df: DataFrame, **columns: str) -> DataFrame:
    """Full texts (``TEXTS``) of the examples with a target, each a row of its own."""
    return in_order(df, **columns).select("conv_id", "role", "text").mapInPandas(_full, TEXTS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def read_examples(examples: Iterator[Example]) -> Iterator[tuple]:
    """Digests of each conversation (``DIGESTS``), from nothing but its examples.

    Each example's context is read from where the one before it was read to; what was read before must
    be the beginning of it.
    """
    conv, state, seen, last = None, None, 0, None

    def close() -> tuple:
        n, turns, loss_chars, loss, chars, count = state
        return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, count

    for x in examples:
        if state is None or x.conv != conv or not x.number:
            if state:
                yield close()
            conv, state, seen, last = x.conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0], 0, None
        if x.n_context < seen or last is not None and x.rope.text(seen - 1, seen) != last:
            raise ValueError(f"example {x.number} of conversation {x.conv} does not begin with the turns before it")
        text = x.context(seen) + (x.target or "") + x.closing
        for role, said, _, _ in parse(text):
            state[0] += 1
            state[1].update(f"{role}\n{said}\n".encode())
        if x.target is not None:
            target = unescape(x.target)
            state[2] += len(target)
            state[3].update(target.encode())
            state[5] += 1
        state[4] += len(text)
        seen = x.n_context + (x.target is not None)
        last = x.head + x.target + x.closing if x.target is not None else x.rope.text(seen - 1, seen)
        x.rope.let_go(seen - 1)
    if state:
        yield close()


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield from _framed(read_examples(expand(_turns(batches))), DIGESTS, lambda r: 0)


def read_back(df: DataFrame, **columns: str) -> DataFrame:
    """Digests (``DIGESTS``) of each conversation as its expanded examples have it."""
    return in_order(df, **columns).select("conv_id", "role", "text").mapInPandas(_read_back, DIGESTS)


def op8(conversations: DataFrame) -> DataFrame:
    """The contract's columns for all conversations and the planted conversation -7."""
    says = "</s>[INST] ok [/INST]"
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(rows.unionByName(extra))


def _escaped_length(col: str) -> str:
    places = " + ".join(f"(length({col}) - length(replace({col}, '{x}', ''))) // {len(x)}" for x in CONTROL)
    return rf"(length({col}) + length({col}) - length(replace({col}, '\', '')) + {places})"


ORACLE = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_escaped_length('role')} + {_escaped_length('text')} + {len(START) + len(END) + 1})::BIGINT AS formatted_chars,
  (count(*) FILTER (role = 'assistant'))::BIGINT AS n_examples
FROM t GROUP BY conv_id
"""
