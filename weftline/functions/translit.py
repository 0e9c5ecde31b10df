"""Transliteration to Devanagari as native column expressions, plus a second one for cross-checks.

All letters of the scheme are first put into ASCII, those that are none or have two characters as capitals, of
which a text in small letters has none.  Two patterns mark vowels without a consonant and consonants
without a vowel, and one pass turns everything into Devanagari; what a text already has of it is never touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.text import ASCII_DIGITS, DEVANAGARI_DIGITS, has_mixed_language, join_hyphens, looks_like_sanskrit, straight_quotes, strip

# The letters of the scholarly scheme and of ITRANS.
CONSONANTS = {
    "kh": "ख", "gh": "घ", "ch": "छ", "jh": "झ", "ṭh": "ठ", "ḍh": "ढ", "th": "थ", "dh": "ध", "ph": "फ", "bh": "भ",
    "k": "क", "g": "ग", "ṅ": "ङ", "c": "च", "j": "ज", "ñ": "ञ", "ṭ": "ट", "ḍ": "ड", "ṇ": "ण", "t": "त", "d": "द", "n": "न",
    "p": "प", "b": "ब", "m": "म", "y": "य", "r": "र", "l": "ल", "v": "व", "ś": "श", "ṣ": "ष", "s": "स", "h": "ह",
}
VOWELS = {
    "ai": ("ऐ", "ै"), "au": ("औ", "ौ"), "ā": ("आ", "ा"), "ī": ("ई", "ी"), "ū": ("ऊ", "ू"), "ṝ": ("ॠ", "ॄ"), "ṛ": ("ऋ", "ृ"),
    "ḹ": ("ॡ", "ॣ"), "ḷ": ("ऌ", "ॢ"), "a": ("अ", ""), "i": ("इ", "ि"), "u": ("उ", "ु"), "e": ("ए", "े"), "o": ("ओ", "ो"),
}
SIGNS = {"ṃ": "ं", "ṁ": "ं", "ḥ": "ः", "'": "ऽ", "||": "॥", "|": "।"}
VIRAMA = "्"
ITRANS_CONSONANTS = {
    "kSh": "क्ष", "x": "क्ष", "GY": "ज्ञ", "j~n": "ज्ञ", "dny": "ज्ञ", "chh": "छ", "Ch": "छ", "kh": "ख", "gh": "घ", "~N": "ङ", "N^": "ङ",
    "ch": "च", "jh": "झ", "~n": "ञ", "JN": "ञ", "Th": "ठ", "Dh": "ढ", "th": "थ", "dh": "ध", "ph": "फ", "bh": "भ", "sh": "श",
    "Sh": "ष", "shh": "ष", "k": "क", "g": "ग", "j": "ज", "T": "ट", "D": "ड", "N": "ण", "t": "त", "d": "द", "n": "न", "p": "प",
    "b": "ब", "m": "म", "y": "य", "r": "र", "l": "ल", "v": "व", "w": "व", "s": "स", "h": "ह", "L": "ळ",
}
ITRANS_VOWELS = {
    "RRI": ("ॠ", "ॄ"), "R^I": ("ॠ", "ॄ"), "RRi": ("ऋ", "ृ"), "R^i": ("ऋ", "ृ"), "LLI": ("ॡ", "ॣ"), "L^I": ("ॡ", "ॣ"), "LLi": ("ऌ", "ॢ"),
    "L^i": ("ऌ", "ॢ"), "aa": ("आ", "ा"), "A": ("आ", "ा"), "ii": ("ई", "ी"), "I": ("ई", "ी"), "uu": ("ऊ", "ू"), "U": ("ऊ", "ू"),
    "ai": ("ऐ", "ै"), "au": ("औ", "ौ"), "a": ("अ", ""), "i": ("इ", "ि"), "u": ("उ", "ु"), "e": ("ए", "े"), "o": ("ओ", "ो"),
}
ITRANS_SIGNS = {"M": "ं", ".m": "ं", "H": "ः", ".a": "ऽ", "||": "॥", "|": "।", "OM": "ॐ", "AUM": "ॐ", ".N": "ँ", ".h": VIRAMA}


#: Capitals, which no text has once it is in small letters, for letters of two characters and for those that are no ASCII:
#: the patterns' classes are then all ASCII, which Java looks up in a bit set and not one by one.
_SHORT = dict(zip([k for k in (*CONSONANTS, *VOWELS) if not (len(k) == 1 and k.isascii())], "KGCJQXTDPBNMLOWSREAUIFHVYZ", strict=True))
#: Marks of private use: a consonant without a vowel and a vowel without a consonant.
_BARE, _ALONE = "\ue400", "\ue401"


def iast_to_devanagari(x: Column) -> Column:
    """[C9] Native expressions; characters that are no part of the scheme stay as they are."""
    x = F.lower(x)
    for key, to in {**_SHORT, "||": SIGNS["||"]}.items():
        if len(key) > 1:
            x = F.replace(x, F.lit(key), F.lit(to))
    single = {k: to for k, to in _SHORT.items() if len(k) == 1}
    x = F.translate(x, "".join(single), "".join(single.values()))
    consonants, vowels = ({_SHORT.get(k, k): v for k, v in d.items()} for d in (CONSONANTS, VOWELS))
    c, v = f"[{''.join(consonants)}]", f"[{''.join(vowels)}]"
    x = F.regexp_replace(x, f"(?<!{c}){v}", f"{_ALONE}$0")
    x = F.regexp_replace(x, f"{c}(?!{v})", f"$0{_BARE}")
    for key, (letter, _) in vowels.items():
        x = F.replace(x, F.lit(_ALONE + key), F.lit(letter))
    last = consonants | {k: sign for k, (_, sign) in vowels.items() if sign} | {k: s for k, s in SIGNS.items() if len(k) == 1} | {_BARE: VIRAMA} | dict(zip(ASCII_DIGITS, DEVANAGARI_DIGITS, strict=True))
    # A letter without a counterpart is dropped: the vowel that a consonant has by itself.
    return F.translate(x, "".join(last) + "a", "".join(last.values()))


def gated(x: Column, compose: bool = True) -> Column:
    """[C13] The transliteration of what is Sanskrit and not mixed; null for everything else."""
    fit = looks_like_sanskrit(x, compose) & ~has_mixed_language(x, compose)
    return F.when(fit, iast_to_devanagari(straight_quotes(x)))


#: Words of at most so many characters are kept, and how many of them.
KEPT_CHARS, KEPT_WORDS = 64, 50_000


class _Scan:
    """Longest match from the left, with a pending virama after each consonant.

    No key has white space, so a word's output depends on the word alone: each is scanned once while it is kept.
    """

    def __init__(self, consonants: dict[str, str], vowels: dict[str, tuple[str, str]], signs: dict[str, str]):
        keys = sorted([*consonants, *vowels, *signs], key=lambda k: (-len(k), k))
        self.pattern = re.compile("|".join([*map(re.escape, keys), "."]), re.DOTALL)
        plain = dict(zip(ASCII_DIGITS, DEVANAGARI_DIGITS, strict=True)) | signs | {k: alone for k, (alone, _) in vowels.items()}
        self.alone, self.signs, self.consonants = plain, {k: sign for k, (_, sign) in vowels.items() if k not in consonants}, consonants
        self.kept = lru_cache(KEPT_WORDS)(self.word)

    def word(self, word: str) -> str:
        out: list[str] = []
        open_ = False
        for piece in self.pattern.findall(word):
            letter = self.consonants.get(piece)
            sign = self.signs.get(piece) if open_ and letter is None else None
            if open_ and sign is None:
                out.append(VIRAMA)
            out.append(letter or (self.alone.get(piece, piece) if sign is None else sign))
            open_ = letter is not None
        return "".join(out) + (VIRAMA if open_ else "")

    def __call__(self, text: str) -> str:
        return "".join([self.kept(w) if len(w) <= KEPT_CHARS else self.word(w) for w in _WORDS.findall(text)])


_WORDS = re.compile(r"\s+|\S+")
_IAST, _ITRANS = _Scan(CONSONANTS, VOWELS, SIGNS), _Scan(ITRANS_CONSONANTS, ITRANS_VOWELS, ITRANS_SIGNS)


def scanned_iast(text: str) -> str:
    return _IAST(text.lower())


def scanned_itrans(text: str) -> str:
    return _ITRANS(text)


@F.pandas_udf(T.StringType())
def iast_by_scan(x: pd.Series) -> pd.Series:
    """[C10] A second implementation, by scanning; for cross-checks and not for the hot path."""
    return x.map(lambda s: None if s is None else scanned_iast(s))


@F.pandas_udf(T.StringType())
def itrans_to_devanagari(x: pd.Series) -> pd.Series:
    """[C12] ITRANS, longest match first; a dot that begins no sign stays a dot."""
    return x.map(lambda s: None if s is None else scanned_itrans(s))


def cross_checked(x: Column, second: Callable[[Column], Column] = iast_by_scan) -> Column:
    """[C11] Struct of the chosen output, whether both agree but for outer white space, and both outputs; ``second`` is any other implementation."""
    ready = straight_quotes(join_hyphens(x))
    a, b = iast_to_devanagari(ready), second(ready)
    return F.struct(a.alias("chosen"), (strip(a) == strip(b)).alias("agree"), a.alias("first"), b.alias("second"))


# Repairs of a work's own abbreviations.
REPAIRS = (
    ("â", "ā"), ("Â", "Ā"), (r"(?i)\bhds\b\s*[:.]", "bhāgavata-bhāṣyam (haridāsa śāstrī):"),
    (r"(?i)\brpc\b", "rāmapada caṭṭopādhyāya"), (r"(?i)\brc\b", "rāmapada caṭṭopādhyāya"),
)


def repaired(x: Column) -> Column:
    """[C14] Typing slips and abbreviations set right before transliteration."""
    for pattern, to in REPAIRS:
        x = F.regexp_replace(x, pattern, to)
    return x
