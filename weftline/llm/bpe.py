"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Why a transducer can do it.  Merging always takes the adjacent pair with the lowest rank, leftmost
first.  A sequence of tokens is the encoding of its bytes exactly if every token encodes to itself
and every two neighbours, encoded together, stay those two tokens: as long as no merge crosses a
border, what happens on one side of it does not depend on the other.  So encodings are the paths of
a non-deterministic transducer that walks a trie of the vocabulary and may end a token where the trie
has one that is compatible with the token before.  For each prefix there is exactly one such last
token, hence one new path per byte.

Determinisation happens on demand, for a piece that is met again: one that is met first is walked path by path, longest
tokens first, as most rare pieces come once and their states would never be met again.  A state is the set of live paths (tokens not yet emitted, last
token, trie node); what all paths agree on is emitted at once.  A path dies when its token can grow
no further, so at most as many are alive as the longest token has bytes: lookahead is bounded and
cost is linear in the text, for any piece length.  States are kept up to ``max_states``, then
forgotten and built again as needed; ids of short pieces are kept in two generations of bounded size,
so frequent ones stay.  All of that is dropped when a task ends: a worker keeps the vocabulary alone.

Decoding streams: chunks of ids give bytes, and an incremental UTF-8 state machine hands on complete
characters, holding back at most three bytes; ill-formed parts become U+FFFD.

Defined results: a null text is an empty text with no ids and empty bytes; repeated rows and ties are
encoded alike; empty tables give empty tables; very long texts are encoded whole, piece by piece;
other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.workers import text_udf

#: Bytes of a piece that may be walked without making states; longer ones are walked in bounded memory.
SHORT = 256
#: A vocabulary file larger than this is refused: it is broadcast to every executor.
MAX_VOCABULARY_BYTES = 64 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file with lines ``base64(token) rank``."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The defining procedure: merge the pair of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encoder of byte strings, built from ranks; states are made as they are met."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 120_000):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {r: t for t, r in ranks.items()}
        self._next: dict[int, int] = {}
        self._token = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                child = self._next.get(key)
                if child is None:
                    child = self._next[key] = len(self._token)
                    self._token.append(-1)
                node = child
            self._token[node] = rank
        #: A node's token if that encodes to itself, else -1; -2 while not known.
        self._whole = [-2] * len(self._token)
        self._fits: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states."""
        self._states: list[tuple] = [(((), -1, 0),)]
        self._number: dict[tuple, int] = {self._states[0]: 0}
        self._arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._ends: dict[int, tuple[int, ...]] = {}
        self._met: set[int] = set()

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins into a token; (-1, -1) for a byte, None if the token's bytes do not encode to it."""
        if token in self._halves:
            return self._halves[token]
        data, ranks = self.bytes_of[token], self.ranks
        if len(data) == 1:
            out = (-1, -1)
        else:
            out = None
            for i in range(1, len(data)):  # both halves must be tokens that encode to themselves, and meet untouched
                a, b = ranks.get(data[:i]), ranks.get(data[i:])
                if a is not None and b is not None and max(a, b) < token and self.halves(a) and self.halves(b) and not self._crossed(a, b, token):
                    out = (a, b)
                    break
        self._halves[token] = out
        return out

    def _crossed(self, left: int, right: int, before: int) -> bool:
        """Whether a merge across the border of two tokens comes before a merge of rank ``before``.

        Seen backwards in time: the parts beside the border are the tokens themselves, then, undoing the
        later of their merges, its half beside the border.  Two parts that stand side by side would be
        joined if their union has a lower rank than what the left part is merged into next, and no
        higher rank than what the right part is (leftmost goes first on equal ranks).
        """
        of, ranks = self.bytes_of, self.ranks
        x, y, up_x, up_y = left, right, before, before - 1
        while True:
            union = ranks.get(of[x] + of[y])
            if union is not None and union < up_x and union <= up_y:
                return True
            if x >= y and len(of[x]) > 1 or len(of[y]) == 1:
                if len(of[x]) == 1:
                    return False
                x, up_x = self._halves[x][1], x
            else:
                y, up_y = self._halves[y][0], y

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens, encoded together, stay those two tokens."""
        key = left << 32 | right
        out = self._fits.get(key)
        if out is None:
            if len(self._fits) > 2 * self.max_states:
                self._fits.clear()
            out = self._fits[key] = not self._crossed(left, right, 1 << 62)
        return out

    def _complete(self, paths: tuple) -> tuple[tuple[int, ...], int] | None:
        """(pending tokens, token) of the one path that may end a token here."""
        whole, fits = self._whole, self._fits
        for pending, last, node in paths:
            token = whole[node]
            if token == -2:
                token = self._token[node]
                token = whole[node] = token if token >= 0 and self.halves(token) else -1
            if token >= 0:
                if last < 0:
                    return pending, token
                ok = fits.get(last << 32 | token)
                if ok or ok is None and self.fits(last, token):
                    return pending, token
        return None

    def _walk(self, piece: bytes) -> list[int]:
        """Ids of a piece, path by path; no state is made.

        Longest tokens go first.  One path alone leads to each place of a piece, so a place that is left is never met again.
        """
        follow, whole, fits, n = self._next, self._whole, self._fits, len(piece)
        at, last = 0, -1
        out: list[int] = []
        tried: list[tuple[int, int, list[tuple[int, int]]]] = []
        while True:
            node, i, choice = 0, at, []
            while i < n:
                node = follow.get(node << 8 | piece[i])
                if node is None:
                    break
                i += 1
                token = whole[node]
                if token == -2:
                    token = self._token[node]
                    token = whole[node] = token if token >= 0 and self.halves(token) else -1
                if token >= 0:
                    choice.append((token, i))
            while True:
                while not choice:
                    at, last, choice = tried.pop()
                    out.pop()
                token, i = choice.pop()
                if last >= 0:
                    ok = fits.get(last << 32 | token)
                    if ok is None:
                        ok = self.fits(last, token)
                    if not ok:
                        continue
                break
            out.append(token)
            if i == n:
                return out
            tried.append((at, last, choice))
            at, last = i, token

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        paths, follow = self._states[state], self._next
        alive = []
        for pending, last, node in paths:
            child = follow.get(node << 8 | byte)
            if child is not None and node:
                alive.append((pending, last, child))
        done = self._complete(paths)
        if done:
            alive.append((done[0] + (done[1],), done[1], follow[byte]))
        elif paths[0][2] == 0:
            alive.append(((), -1, follow[byte]))
        if len(alive) == 1:
            shared, last, node = alive[0]
            made = (((), last, node),)
        else:
            shared = alive[0][0]
            for path in alive:
                pending, k = path[0], 0
                for k in range(min(len(shared), len(pending)) + 1):  # noqa: B007
                    if k == len(shared) or k == len(pending) or shared[k] != pending[k]:
                        break
                shared = shared[:k]
                if not k:
                    break
            k = len(shared)
            made = tuple([(pending[k:], last, node) for pending, last, node in alive]) if k else tuple(alive)
        to = self._number.get(made)
        if to is None:
            to = self._number[made] = len(self._states)
            self._states.append(made)
        arc = self._arcs[state << 8 | byte] = (to, shared)
        return arc

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece.  A piece that is itself in the vocabulary is that one token."""
        if not piece:
            return []
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        if len(self._states) > self.max_states:
            self.reset()
        if len(piece) <= SHORT:
            met = hash(piece)
            if met not in self._met:
                if len(self._met) > 2 * self.max_states:
                    self._met.clear()
                self._met.add(met)
                return self._walk(piece)
        out: list[int] = []
        state, arcs = 0, self._arcs
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                if len(self._states) > 2 * self.max_states:  # a very long piece: forget all but where it stands
                    paths = self._states[state]
                    self.reset()
                    arcs, state = self._arcs, self._number.setdefault(paths, len(self._states))
                    if state == len(self._states):
                        self._states.append(paths)
                arc = self._step(state, byte)
            state = arc[0]
            if arc[1]:
                out.extend(arc[1])
        end = self._ends.get(state)
        if end is None:
            pending, token = self._complete(self._states[state])
            end = self._ends[state] = (*pending, token)
        out.extend(end)
        return out


class Tokenizer:
    """Texts to ids and back; pieces are matches of ``pattern``, each encoded on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = 150_000):
        self.fst = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.max_pieces = max_pieces
        self.forget()

    def forget(self) -> None:
        """Drop everything that was kept to save work."""
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self.fst.reset()
        self.fst._fits.clear()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, which is among the new ones after that if it is short."""
        ids = self._new.get(piece)
        if ids is not None:
            return ids
        ids = self._old.get(piece)
        if ids is None:
            ids = self.fst.encode(piece.encode("utf-8"))
            ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self._new) >= self.max_pieces:
                self._old, self._new = self._new, {}
            self._new[piece] = ids
        return ids

    def encode_packed(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        # The list of a text's pieces is the quicker way; a very long text is matched piece by piece.
        if len(text) > 1 << 20:
            return b"".join([self._piece(m[0]) for m in self.pattern.finditer(text)])
        pieces = self.pattern.findall(text)
        out = list(map(self._new.get, pieces))
        if None in out:
            out = [self._piece(piece) if ids is None else ids for piece, ids in zip(pieces, out, strict=True)]
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode_bytes(self, ids: Iterable[int], chunk: int = 8_192) -> Iterator[bytes]:
        """The bytes of ids, ``chunk`` tokens at a time."""
        ids, of = iter(ids), self.fst.bytes_of
        while data := b"".join(map(of.__getitem__, itertools.islice(ids, chunk))):
            yield data

    def decode(self, ids: Iterable[int]) -> str:
        machine = Utf8Machine()
        return "".join([*map(machine.feed, self.decode_bytes(ids)), machine.close()])


class Utf8Machine:
    """Incremental UTF-8: ``feed`` bytes cut anywhere, get the characters that are complete.

    The state is (bytes still needed, least and greatest allowed next byte, bytes read so far), as in
    the table of well-formed sequences of the Unicode standard: the ranges of the second byte keep
    out overlong forms, surrogates and values above U+10FFFF.
    """

    def __init__(self) -> None:
        self.need, self.low, self.high, self.read = 0, 0x80, 0xBF, b""

    def _lead(self, byte: int) -> bool:
        """Enter the state after a lead byte; False if no sequence begins with it."""
        if 0xC2 <= byte <= 0xDF:
            self.need, self.low, self.high = 1, 0x80, 0xBF
        elif 0xE0 <= byte <= 0xEF:
            self.need, self.low, self.high = 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        elif 0xF0 <= byte <= 0xF4:
            self.need, self.low, self.high = 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        else:
            return False
        self.read = bytes([byte])
        return True

    def _push(self, byte: int, out: list[str]) -> None:
        if self.need:
            if self.low <= byte <= self.high:
                self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                self.read += bytes([byte])
                if not self.need:
                    out.append(self.read.decode("utf-8"))
                return
            self.need = 0
            out.append("�")
        if byte < 0x80:
            out.append(chr(byte))
        elif not self._lead(byte):
            out.append("�")

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        at = 0
        while self.need and at < len(data):  # finish what the last chunk left open
            self._push(data[at], out)
            at += 1
        tail = len(data)
        for back in range(1, min(4, len(data) - at) + 1):  # a lead byte near the end may be incomplete
            byte = data[len(data) - back]
            if byte >= 0xC0:
                tail = len(data) - back
                break
            if byte < 0x80:
                break
        try:
            out.append(data[at:tail].decode("utf-8"))
        except UnicodeDecodeError:
            for byte in data[at:tail]:
                self._push(byte, out)
        for byte in data[tail:] if tail >= at else b"":
            self._push(byte, out)
        return "".join(out)

    def close(self) -> str:
        """U+FFFD if a sequence was left incomplete."""
        left, self.need = self.need, 0
        return "�" if left else ""


_MADE: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(data: bytes, pattern: str) -> Tokenizer:
    """The tokenizer of a vocabulary file's bytes; made once per Python process."""
    key = hashlib.sha256(data).hexdigest(), pattern
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Tokenizer(read_ranks(data), pattern)
        # The vocabulary's tables hold no cycles and stay: the collector need not walk through them again and again.
        gc.collect()
        gc.freeze()
    return _MADE[key]


def _forget() -> None:
    for made in _MADE.values():
        made.forget()


def load_vocabulary(path: str) -> bytes:
    """Bytes of a vocabulary file, read on the driver."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def encode(df: DataFrame, vocabulary: bytes, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with an array of token ids."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @text_udf("array<int>", _forget)
    def ids(texts: list) -> pd.Series:
        t = tokenizer(shared.value, pattern)
        return pd.Series([np.frombuffer(t.encode_packed(x), "<u4").astype(np.int32) for x in texts], dtype=object)

    return df.withColumn(out_col, ids(F.col(text_col)))


def decode(df: DataFrame, vocabulary: bytes, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that an array of ids stands for."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @text_udf("string", _forget)
    def texts(ids: list) -> pd.Series:
        t = tokenizer(shared.value, pattern)
        return pd.Series([t.decode(x or []) for x in ids], dtype=object)

    return df.withColumn(out_col, texts(F.col(ids_col)))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def digests(df: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded bytes.

    ``round_trip`` says whether the state machine's text equals the text that was encoded.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    @text_udf(DIGESTS, _forget)
    def digest(texts: list) -> pd.DataFrame:
        t = tokenizer(shared.value, pattern)
        rows = []
        for x in texts:
            x = x or ""
            ids = t.encode_packed(x)
            sha, machine, at, same = hashlib.sha256(), Utf8Machine(), 0, True
            for data in t.decode_bytes(np.frombuffer(ids, "<u4").tolist()):
                sha.update(data)
                part = machine.feed(data)
                same, at = same and x.startswith(part, at), at + len(part)
            part = machine.close()
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), sha.hexdigest(), same and not part and at == len(x)))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in DIGESTS.split(", ")])

    return df.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("d")).select("doc_id", "d.*")


def op2(df: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The contract's columns; the vocabulary's path and pattern are parameters."""
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return digests(df, load_vocabulary(path), pattern)
