"""Personal data: exact patterns, and a linear-chain CRF over word shapes for what they miss.

Base spans come from four fixed patterns with their checks.  The CRF tags every token of every text
with begin and inside labels per kind; it is trained on the driver from a small labelled table (about
650 short sentences, written by rule below, or any rows in the same form) by gradient ascent on the
exact conditional likelihood, and decoded by Viterbi in numpy batches.  Its spans are added where they
touch no base span and pass the kind's check; base spans are never changed.

How all tokens can be decoded: a token's features depend on its form and on the forms beside it, so
scores are sums of rows looked up by form, made once per form.  Where entering or continuing any label
at a token loses against ``O``, the token is *weak*.  A path that visits labels on weak tokens gains by
``O`` in their place, but for what it may lose where it leaves or enters the stretch; so a weak token
is ``O`` on every best path once the losses summed from it to either end of its stretch outweigh the
most that can be lost there.  Such tokens cut the chain exactly, and Viterbi runs over the others.

Defined results: a null or empty text has no spans; positions are code points of the whole text, end
exclusive; very long texts and tokens are read whole, in time linear in them; equal spans of different
kinds all stay; of labels with equal scores the first listed wins; repeated rows are tagged alike; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.workers import text_udf

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns.  Possessive forms match the same and keep long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def is_card(text: str) -> bool:
    d = _digits(text)
    return 13 <= len(d) <= 19 and luhn(d)


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the run of local characters before an ``@``, then a domain with a dot."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the four patterns, by kind as listed, then start."""
    if not text:
        return []
    out = list(emails(text)) if "@" in text else []
    if not _DIGITS.search(text):
        return out
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and is_card(m[0])]
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- the CRF -------------------------------------------------------------------------------------

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
N_FEATURES = 1 << 12
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: Words that are features of their own.
CUES = {"phone", "tel", "call", "mobile", "fax", "mail", "email", "e-mail", "card", "visa", "ip", "host", "server", "at", "dot", "(at)", "(dot)", "[at]", "[dot]", "version", "token", "order", "year", "page"}


_SAME = re.compile(r"(.)\1+", re.DOTALL)


def shape(token: str) -> str:
    """Runs of digits, capitals and small letters as 9, A and a; of more than ten runs those beyond are told apart by a hash of 64 values."""
    classes = "".join("9" if c in "0123456789" else "A" if c.isupper() else "a" if c.isalpha() else c for c in token)
    runs = _SAME.sub(r"\1", classes)
    return runs if len(runs) <= 10 else f"{runs[:10]}{_number(runs[10:]) % 64}"


def _bucket(n: int) -> int:
    return n if n <= 4 else 5 if n <= 6 else 6 if n <= 9 else 7 if n <= 12 else 8 if n <= 16 else 9


Form = tuple[str, int, str, str]
EDGE: Form = ("^", 0, "-", "^")


def form(token: str) -> Form:
    """What the model sees of a token: shape, number of digits, cue word, first sign."""
    word = token.strip(".,;:!?").lower()
    return shape(token), _bucket(len(_DIGITS.findall(token))), word if word in CUES else "-", token[:1] if not token[:1].isalnum() else "w"


def _number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % N_FEATURES


def _own(f: Form) -> list[int]:
    return [_number(n) for n in ("bias", f"s{f[0]}", f"d{f[1]}", f"w{f[2]}", f"f{f[3]}")]


def _beside(side: str, f: Form) -> list[int]:
    return [_number(n) for n in (f"{side}s{f[0]}", f"{side}d{f[1]}", f"{side}w{f[2]}")]


def _with(side: str, digits: int, f: Form) -> int:
    return _number(f"{side}d{digits}d{f[1]}s{f[0]}")


def features(tokens: list[str]) -> np.ndarray:
    """(tokens, features) hashed feature numbers; every token has as many."""
    own = [form(t) for t in tokens]
    rows = []
    for i, here in enumerate(own):
        before, after = own[i - 1] if i else EDGE, own[i + 1] if i + 1 < len(own) else EDGE
        rows.append([*_own(here), *_beside("p", before), *_beside("n", after), _with("p", before[1], here), _with("n", after[1], here)])
    return np.array(rows, np.int32).reshape(len(tokens), -1)


def labelled_table(n: int = 640, seed: int = 7) -> list[tuple[list[str], list[str]]]:
    """A small labelled table: sentences of filler, cues, personal data in many forms, and look-alikes."""
    r = random.Random(seed)
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("an", "er", "th", "lo", "mi", "sch", "ue", "ta", "re")) for _ in range(r.randint(1, 4)))

    def card() -> str:
        body = number(15)
        digits = next(body + str(k) for k in range(10) if luhn(body + str(k)))
        sep = r.choice(("", " ", "-", ".", "/", "_", "  "))
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        return r.choice((
            lambda: f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", lambda: f"({number(3)}) {number(3)}-{number(4)}",
            lambda: f"{number(3)}-{number(3)}-{number(4)}", lambda: f"0{number(2)} {number(3)} {number(4)}", lambda: f"+{number(2)} {number(3)} {number(6)}",
            lambda: f"{number(3)}.{number(3)}.{number(4)}", lambda: f"0{number(2)} {number(4)} {number(4)}", lambda: f"0{number(3)} {number(7)}",
            lambda: f"0{number(1)} " + " ".join(number(2) for _ in range(4)),
        ))()

    def email() -> str:
        name, host = word() + r.choice((".", "", "_")) + number(r.randint(0, 2)), f"{word()}.{r.choice(('com', 'org', 'net'))}"
        a, b = r.choice((("(at)", "(dot)"), ("[at]", "[dot]"), ("at", "dot")))
        return r.choice((f"{name}@{host}", f"{name} {a} {host.replace('.', f' {b} ')}", f"{name} {a} {host}" if a != "at" else f"{name}@{host}"))

    makers = {"email": email, "card": card, "phone": phone, "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))}
    cues = {"email": ("mail", "email", "write"), "card": ("card", "visa", "paid"), "phone": ("call", "phone", "tel"), "ip": ("host", "server", "ip")}
    alike = (
        lambda: f"version {r.randint(1, 9)}.{r.randint(0, 9)}.", lambda: f"in {r.randint(1800, 2030)}", lambda: f"on {r.randint(2000, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
        lambda: f'token = "{"".join(r.choice("0123456789abcdef") for _ in range(40))}"', lambda: f"order {number(r.randint(3, 8))}", lambda: f"{number(2)} {word()}",
        lambda: f"{word()} at {word()}", lambda: f"the dot {word()}", lambda: f"page {number(r.randint(1, 3))}", lambda: f"{number(1)},{number(3)}", lambda: number(16), lambda: f"{number(3)} {number(2)}",
        lambda: f"{word()} 97{r.randint(8, 9)} {number(1)} {number(2)} {number(6)} {number(1)}", lambda: " ".join(number(1) for _ in range(r.randint(4, 10))), lambda: " ".join(number(2) for _ in range(r.randint(2, 7))),
    )
    def prose() -> str:
        """Ordinary words, some with a capital, some with a sign after them or around them."""
        out = []
        for _ in range(r.randint(1, 5)):
            w = word()
            w = r.choice((w, w, w, w.capitalize(), w.upper()))
            out.append(r.choice((w, w, w, w, f"{w},", f"{w}.", f"{w};", f"{w}:", f"{w}!", f"{w}?", f"({w})", f'"{w}"', f"{w}'s", f"{w}-{word()}", f"#{w}", f"*{w}*", f"<{w}>", "-", "|", "###", "--", f"{w}é")))
        return " ".join(out)

    rows = []
    for _ in range(n):
        tokens, tags = [], []

        def say(text: str, kind: str | None = None, tokens=tokens, tags=tags) -> None:
            for i, t in enumerate(text.split()):
                tokens.append(t)
                tags.append("O" if kind is None else f"{'I' if i else 'B'}-{kind}")

        for _ in range(r.randint(1, 3)):
            say(prose())
            if r.random() < 0.55:
                kind = r.choice(KINDS)
                if r.random() < 0.4:
                    say(r.choice(cues[kind]) + r.choice(("", ":")))
                say(makers[kind](), kind)
                if r.random() < 0.3:
                    tokens[-1] += r.choice((".", ",", "!!", "***", "%%%"))
            else:
                say(r.choice(alike)())
        say(prose())
        rows.append((tokens, tags))
    return rows


#: Tokens whose best-path pointers are held at once, and forms whose scores are kept between batches.
BATCH, MAX_FORMS, MAX_TOKENS = 65_536, 50_000, 200_000


class Crf:
    """Weights of emissions (feature, label) and transitions (label, label)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def scores(self, feats: np.ndarray) -> np.ndarray:
        return self.emit[feats].sum(axis=-2)

    def viterbi(self, e: np.ndarray, before: int | None = None, after: int | None = None) -> np.ndarray:
        """Best labels of a batch of sequences of one length: scores (batch, length, labels) in, (batch, length) out.

        ``before`` and ``after`` are the labels of the tokens beside the sequences, where there are any.
        """
        n, length, _ = e.shape
        best, back = e[:, 0] + (0 if before is None else self.move[before]), np.zeros((n, length, len(LABELS)), np.int8)
        for t in range(1, length):
            through = best[:, :, None] + self.move
            back[:, t] = through.argmax(1)
            best = through.max(1) + e[:, t]
        out = np.empty((n, length), np.int8)
        out[:, -1] = (best + (0 if after is None else self.move[:, after])).argmax(1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[np.arange(n), t, out[:, t]]
        return out


class Tagger:
    """Scores by form, and labels of whole texts."""

    def __init__(self, crf: Crf):
        self.crf = crf
        stay, labels = crf.move[0, 0], crf.move[1:, 1:]
        #: The best way into each label, and the most that a changed way out of labels or into one costs.
        self.into = np.maximum(crf.move[0, 1:], labels.max(0)) - stay
        self.leave = max(0.0, float((stay - crf.move[1:, 0]).max()))
        self.left = max(0.0, float((crf.move[1:, 0] - stay).max()))
        self.enter = max(0.0, float((labels - crf.move[0, 1:]).max()))
        self.forget()

    def forget(self) -> None:
        """Drop what is kept between batches."""
        self._forms: dict[Form, int] = {}
        self._tokens: dict[str, int] = {}
        self._tables: list[np.ndarray] = []
        self._numbers(EDGE)

    def _numbers(self, f: Form) -> int:
        k = self._forms.get(f)
        if k is None:
            k = self._forms[f] = len(self._forms)
            emit = self.crf.emit
            beside = [np.stack([emit[_with(side, d, f)] for d in range(10)]) for side in "pn"]
            row = emit[_own(f)].sum(0), emit[_beside("p", f)].sum(0), emit[_beside("n", f)].sum(0), *beside, np.int64(f[1])
            if not self._tables or k == len(self._tables[0]):
                # Room for twice as many forms: each row is copied once on average.
                old = self._tables or [np.empty((0, *x.shape), x.dtype) for x in row]
                self._tables = [np.concatenate((t, np.empty((max(64, k), *x.shape), x.dtype))) for t, x in zip(old, row, strict=True)]
            for table, x in zip(self._tables, row, strict=True):
                table[k] = x
        return k

    def emissions(self, tokens: list[str], bounds: list[int]) -> np.ndarray:
        """Scores (tokens, labels); ``bounds`` says where texts begin, and ends with the number of tokens."""
        if len(self._forms) > MAX_FORMS or len(self._tokens) > MAX_TOKENS:
            self.forget()
        known, ids = self._tokens, np.empty(len(tokens), np.int64)
        for i, token in enumerate(tokens):
            k = known.get(token)
            if k is None:
                k = self._numbers(form(token))
                if len(token) <= 64:
                    known[token] = k
            ids[i] = k
        own, left, right, with_left, with_right, digits = self._tables
        before, after = np.concatenate(([0], ids[:-1])), np.concatenate((ids[1:], [0]))
        edges = np.array(bounds)
        before[edges[:-1][edges[:-1] < len(ids)]] = 0
        after[edges[1:][edges[1:] > 0] - 1] = 0
        return own[ids] + left[before] + right[after] + with_left[ids, digits[before]] + with_right[ids, digits[after]]

    def tag(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Labels of the tokens of each text."""
        bounds = [0]
        for tokens in texts:
            bounds.append(bounds[-1] + len(tokens))
        labels = np.zeros(bounds[-1], np.int8)
        if len(labels):
            e = self.emissions([t for tokens in texts for t in tokens], bounds)
            self._between(labels, e, ~self.surely_none(e, bounds), bounds)
        return [labels[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def surely_none(self, e: np.ndarray, bounds: list[int]) -> np.ndarray:
        """Tokens that are O on every best path (see the head of this file); a small margin stands against rounding."""
        step = e[:, 1:] - e[:, :1]
        first = np.zeros(len(e), bool)
        first[[b for b in bounds[:-1] if b < len(e)]] = True
        step = (step + np.where(first[:, None], np.maximum(self.into, 0), self.into)).max(1) + 1e-6
        weak = step < 0
        total = np.cumsum(np.where(weak, step, 0))
        edge = weak & ~first  # goes on from the token before
        begins, ends = weak & ~(edge & np.concatenate(([False], weak[:-1]))), weak.copy()
        ends[:-1] &= ~(edge[1:] & weak[:-1])
        run = np.cumsum(begins) - 1
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
        if not len(start):
            return weak
        base, top = total[start] - step[start], total[stop]
        run = np.maximum(run, 0)
        to_left, to_right = total - base[run], top[run] - total + step
        whole = (top - base)[run]
        return weak & (step < -self.left) & (to_left < -(self.leave + self.left)) & (to_right < -self.enter) & (whole < -(self.leave + self.enter))

    def _between(self, labels: np.ndarray, e: np.ndarray, unsure: np.ndarray, bounds: list[int]) -> None:
        """Viterbi over runs of tokens that are not surely O."""
        starts = np.zeros(len(e) + 1, bool)
        starts[bounds] = True
        begin = np.flatnonzero(unsure & (np.concatenate(([True], ~unsure[:-1])) | starts[:-1]))
        end = np.flatnonzero(unsure & (np.concatenate((~unsure[1:], [True])) | starts[1:])) + 1
        size = end - begin
        kinds = np.stack([size, ~starts[begin], ~starts[end]], 1)
        for length, left, right in np.unique(kinds, axis=0).tolist():
            some = begin[(kinds == (length, left, right)).all(1)]
            most = max(1, BATCH // length)
            for i in range(0, len(some), most):
                at = some[i : i + most, None] + np.arange(length)
                labels[at] = self.crf.viterbi(e[at], 0 if left else None, 0 if right else None)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[list[str], list[str]]] | None = None, epochs: int = 80, rate: float = 0.15, decay: float = 1e-4) -> Crf:
    """Adam on the exact negative log-likelihood, sequences padded into one batch."""
    rows = rows or labelled_table()
    n, length = len(rows), max(len(t) for t, _ in rows)
    feats = [features(t) for t, _ in rows]
    width, k = feats[0].shape[1], len(LABELS)
    x, y, live = np.zeros((n, length, width), np.int32), np.zeros((n, length), np.int64), np.zeros((n, length), bool)
    for i, (f, (_, tags)) in enumerate(zip(feats, rows, strict=True)):
        x[i, : len(f)], y[i, : len(f)], live[i, : len(f)] = f, [LABELS.index(t) for t in tags], True
    emit, move = np.zeros((N_FEATURES, k)), np.zeros((k, k))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (emit, move)]
    for step in range(1, epochs + 1):
        e = emit[x].sum(2)
        alpha, beta = np.zeros((n, length, k)), np.zeros((n, length, k))
        alpha[:, 0] = e[:, 0]
        for t in range(1, length):
            new = _logsum(alpha[:, t - 1, :, None] + move, 1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            new = _logsum(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], new, 0)
        total = _logsum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
        node[np.arange(n)[:, None], np.arange(length), y] -= live
        g_move = np.zeros((k, k))
        for t in range(1, length):
            on = live[:, t]
            pair = np.exp(alpha[on, t - 1, :, None] + move + (e[on, t] + beta[on, t])[:, None, :] - total[on, None, None])
            g_move += pair.sum(0)
            np.add.at(g_move, (y[on, t - 1], y[on, t]), -1)
        g_emit = np.zeros_like(emit)
        np.add.at(g_emit, x.reshape(-1), np.repeat(node.reshape(-1, k), width, axis=0))
        for p, g, m in ((emit, g_emit, moments[0]), (move, g_move, moments[1])):
            g = g / n + decay * p
            m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
            p -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return Crf(emit, move)


_LEAD, _TAIL = re.compile(r"[^\w+(\[]+"), re.compile(r"[\w)\]]")
_AT, _DOT = re.compile(r" ?[(\[]at[)\]] ?| at "), re.compile(r" ?[(\[]dot[)\]] ?| dot ")


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """The span without signs at its ends that no kind begins or ends with."""
    lead = _LEAD.match(text, a, b)
    a = lead.end() if lead else a
    while b > a and not _TAIL.match(text, b - 1, b):
        b -= 1
    return a, b


def is_address(text: str) -> bool:
    """One address, spelled out or not: something, an at, something with a dot before a word character."""
    plain = _DOT.sub(".", _AT.sub("@", " ".join(text.split())))
    at = plain.find("@", 1)
    return at > 0 and " " not in plain and re.search(r"\.[\w-]", plain[at + 1 :]) is not None


def _valid(kind: str, text: str) -> bool:
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15 and not re.search(r"[^\W\d_]", text)
    if kind == "card":
        return is_card(text)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]+", p) and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    return is_address(text)


def added_spans(texts: list[str | None], base: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """CRF spans of a batch of texts that touch no base span and pass their kind's check."""
    out: list[list[Span]] = [[] for _ in texts]
    for i, labels in enumerate(tagger.tag([_TOKEN.findall(t) if t else [] for t in texts])):
        if not labels.any():
            continue
        text, tokens, k = texts[i], [m.span() for m in _TOKEN.finditer(texts[i])], 0
        for k in np.flatnonzero((labels > 0) & (labels % 2 == 1)).tolist():
            kind, end = LABELS[labels[k]][2:], k + 1
            while end < len(tokens) and labels[end] == labels[k] + 1:
                end += 1
            a, b = _trimmed(text, tokens[k][0], tokens[end - 1][1])
            if b > a and _valid(kind, text[a:b]) and all(b <= s or e <= a for _, s, e in base[i]):
                out[i].append((kind, a, b))
    return out


def joined(spans: list[Span]) -> str:
    """kind:start:end by kind as listed, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"


def find(df: DataFrame, model: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of base spans, their digest, all spans and how many they are."""
    tagger = Tagger(model or train())

    @text_udf(RESULT, tagger.forget)
    def found(texts: list) -> pd.DataFrame:
        base = [base_spans(t) for t in texts]
        rows = []
        for spans, more in zip(base, added_spans(texts, base, tagger), strict=True):
            counts = [sum(s[0] == k for s in spans) for k in KINDS]
            rows.append((*counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans + more), len(more), len(spans) + len(more)))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in RESULT.split(", ")])

    return df.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("f")).select("doc_id", "f.*")


def redact(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one."""
    got = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, kind in got:
        if b <= at:
            continue
        out += [text[at:a] if a > at else "", f"[{kind.upper()}]" if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])


def op4(df: DataFrame) -> DataFrame:
    return find(df)
