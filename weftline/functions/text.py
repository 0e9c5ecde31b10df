"""Scalar text functions: columns in, columns out, no Python on the executors unless stated.

Operator ids of the survey stand in brackets.  Nulls give null, except where a predicate is said to
be false for them.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character classes and words that results depend on.
IAST_MARKS = r"[Ā-ſḀ-ỿ̀-ͯ]"
DEVANAGARI = r"[ऀ-ॿ]"
BENGALI = r"[ঀ-৿]"
LATIN = r"[a-zA-Z]"
#: Letters that make a line of verse transliteration; not the blocks of ``IAST_MARKS``.
VERSE_MARKS = "āīūṛṝḷḹṃḥśṣñṅṭḍṇĀĪŪṚṜḶḸṂḤŚṢÑṄṬḌṆ"
IAST_LETTER = r"[a-zA-Zāīūṛṝḷḹṅñṭḍṇśṣṁṃḥ']"
STRONG_ENGLISH = (
    "see", "cf", "editor", "translator", "translation", "chapter", "footnote", "endnote", "op", "trans", "vol",
    "manuscript", "variant", "note",
)
WEAK_ENGLISH = (
    "the", "of", "and", "is", "are", "was", "were", "this", "that", "these", "those", "with", "from", "into", "onto",
    "for", "not", "but", "or", "as", "by", "on", "in", "at", "to", "be", "been", "has", "have", "had", "will", "would",
    "should", "could", "can", "may", "might", "cit", "ed", "no", "text", "reading", "source", "ibid", "page", "pages",
)
TOKEN_EDGES = "|()[]{}.,;:!?\"'’‘"
ASCII_DIGITS, DEVANAGARI_DIGITS = "0123456789", "०१२३४५६७८९"
WHITE = r"[\s\x1c-\x1f\x85\xa0]"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.trim(x, F.lit(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"))


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    """Canonical composition; Spark has no built-in for it, so text crosses to Python in Arrow batches."""
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def full_text(runs: Column) -> Column:
    """[C1] A paragraph's text: its runs' texts joined."""
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")


#: Ranges that hold all characters but marks that decompose for good.
APART = (
    r"[\u0374\u037E\u0387\u0958-\u095F\u09DC-\u09DF\u0A33-\u0A5E\u0B5C\u0B5D\u0F43-\u0F69\u1100-\u11FF\u1F71-\u1FFD\u2000\u2001\u2126-\u212B"
    r"\u2329\u232A\u2ADC\uF900-\uFB4E\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1F}]"
)


def composed(x: Column) -> Column:
    """Canonical composition of texts that may need it; others, which one range of a pattern tells for most, do not reach Python."""
    return F.coalesce(nfc(F.when(x.rlike(r"[\u0300-\x{10FFFF}]") & (x.rlike(r"\p{M}|[ᄀ-ᇿ]") | x.rlike(APART)), x)), x)


def looks_like_iast(x: Column, compose: bool = True) -> Column:
    """[C3] Not blank and, composed, with a letter or mark of the scholarly transliteration.

    A letter and a separate mark that compose to a letter outside the class do not count; ``compose``
    is left out only for texts that are composed already.
    """
    x = composed(x) if compose else x
    return F.coalesce(x.rlike(IAST_MARKS), F.lit(False))


def has_devanagari(x: Column) -> Column:
    """[C4]"""
    return F.coalesce(x.rlike(DEVANAGARI), F.lit(False))


def has_latin(x: Column) -> Column:
    """[C4]"""
    return F.coalesce(x.rlike(LATIN), F.lit(False))


def english_score(x: Column) -> Column:
    """[C2] Share of words that are common English words: the default scorer where no trained one is at hand."""
    tokens = F.filter(F.split(F.lower(x), r"[^a-z]+"), lambda t: t != "")
    hits = F.size(F.filter(tokens, lambda t: t.isin(*STRONG_ENGLISH, *WEAK_ENGLISH)))
    return F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))


def language(x: Column, score_en: Column | None = None, score_sa: Column | None = None) -> Column:
    """[C2] ``en`` or ``sa``: the language whose scorer gives less wins, a tie goes to ``sa``.

    Scorers are columns, so a caller may pass piece counts of trained models; by default a text is
    English if at least a fifth of its words are common English words.
    """
    if score_en is None or score_sa is None:
        return F.when(english_score(x) >= 0.2, F.lit("en")).otherwise(F.lit("sa"))
    return F.when(score_en < score_sa, F.lit("en")).otherwise(F.lit("sa"))


def looks_like_sanskrit(x: Column, compose: bool = True) -> Column:
    """[C5] Tests in order: blank, Devanagari, transliteration marks, no Latin letters, language."""
    return (
        F.when(x.isNull() | (strip(x) == ""), F.lit(False)).when(has_devanagari(x), F.lit(False))
        .when(looks_like_iast(x, compose), F.lit(True)).when(~has_latin(x), F.lit(False)).otherwise(language(x) == "sa")
    )


def whole_tokens(x: Column) -> Column:
    """White-space tokens without edge punctuation, hyphens and quotes, lower case, pure ASCII letters only."""
    edge = "".join("\\" + c for c in TOKEN_EDGES)
    bare = F.transform(F.split(x, rf"{WHITE}+"), lambda t: F.regexp_replace(F.regexp_replace(t, f"^[{edge}]+|[{edge}]+$", ""), "[-'’]", ""))
    return F.transform(F.filter(bare, lambda t: t.rlike("^[A-Za-z]+$")), lambda t: F.lower(t))


def has_mixed_language(x: Column, compose: bool = True) -> Column:
    """[C6] Transliteration with clear English in it.

    True for a label of one to four ASCII words before a colon at the start, one strong English word,
    or two different weak ones; only whole tokens count.  Tokens are looked at only where there is
    transliteration at all.
    """
    gate = looks_like_iast(x, compose)
    tokens = F.array_distinct(whole_tokens(F.when(gate, x)))
    strong = F.arrays_overlap(tokens, F.array(*map(F.lit, STRONG_ENGLISH)))
    weak = F.size(F.array_intersect(tokens, F.array(*map(F.lit, WEAK_ENGLISH)))) >= 2
    label = x.rlike(rf"^{WHITE}*(?:[A-Za-z]+{WHITE}*){{1,4}}:")
    return F.coalesce(F.when(gate, label | strong | weak), F.lit(False))


def join_hyphens(x: Column) -> Column:
    """[C7] Without hyphens between two transliteration letters."""
    return F.regexp_replace(x, f"(?<={IAST_LETTER})-(?={IAST_LETTER})", "")


def straight_quotes(x: Column) -> Column:
    """[C8] Curly single quotes made straight."""
    return F.translate(x, "’‘", "''")


def to_devanagari_digits(x: Column) -> Column:
    """[C15]"""
    return F.translate(x.cast("string"), ASCII_DIGITS, DEVANAGARI_DIGITS)


def from_devanagari_digits(x: Column) -> Column:
    """[C16] Null if anything but digits is left."""
    ascii_ = F.translate(x, DEVANAGARI_DIGITS, ASCII_DIGITS)
    return F.when(ascii_.rlike("^[0-9]+$"), ascii_).cast("long")


def matching_form(x: Column) -> Column:
    """[C17] Bare Devanagari for comparing two settings of a text: no leading bold line, quote marks,
    emphasis, square or round brackets, then nothing but Devanagari (its danda and digits stay)."""
    x = F.regexp_replace(x, r"^\s*\*\*[^\n*]+\*\*\s*\n", "")
    for pattern in (r"(?m)^\s*>+\s*", r"[*_]", r"\[[^\]]*\]", r"\([^)]*\)", "[^ऀ-ॿ]"):
        x = F.regexp_replace(x, pattern, "")
    return x


def clean_ocr(x: Column, compose: bool = True) -> Column:
    """[C18] Composed; rejoined line-end hyphens, single blanks, at most one empty line, no outer white space."""
    x = composed(x) if compose else x
    x = F.regexp_replace(x, r"-\n(?=[^\s\x1c-\x1f\x85\xa0])", "")
    x = F.regexp_replace(x, r"[ \t]+", " ")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def line_script(x: Column) -> Column:
    """[C19] bengali, devanagari, iast, plain or other: the first that a line shows."""
    return (
        F.when(x.rlike(BENGALI), "bengali").when(x.rlike(DEVANAGARI), "devanagari")
        .when(x.rlike(LATIN), F.when(F.length(F.translate(x, VERSE_MARKS, "")) < F.length(x), "iast").otherwise("plain")).otherwise("other")
    )


def without_marker_lines(x: Column) -> Column:
    """[C20] Lines that are only bars, brackets, ASCII digits and blanks are dropped."""
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda t: ~t.rlike(r"^[|()0-9\s]+$")), "\n")


def is_section_line(line: Column) -> Column:
    """[P9] Verse markers, numbered labels, section numbers and short pada titles, as trimmed lines."""
    t = strip(line)
    title = t.rlike(r"(?iu)^(prathamo|dvitīyo|tṛtīyo|caturtho)['’]?dhyāy|^(prathamaḥ|dvitīyaḥ|tṛtīyaḥ|caturthaḥ)(?U:\s)*pādaḥ") & (F.length(t) < 70)
    return t.rlike(r"(?U)^\|\|\s*[\d.]+\s*\|\|$") | t.rlike(r"(?U)^\d+\.\s*[^\n]+$") | t.rlike(r"(?U)^\(\s*[\d.]+\s*\)$") | title


def is_stray_line(line: Column) -> Column:
    """[P10] Stray ``@N`` lines and malformed section markers such as ``(39]``."""
    t = strip(line)
    return t.rlike(r"(?U)^@\d+$") | t.rlike(r"(?U)^[(\[]\d+[)\]]$")


def without_section_lines(x: Column) -> Column:
    """[P9, P10] Without section lines and stray lines."""
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda t: ~(is_section_line(t) | is_stray_line(t))), "\n")


def without_boilerplate(x: Column, lines: tuple[str, ...]) -> Column:
    """[C22] Without given lines and without lines that are a number."""
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda t: ~(strip(t).isin(*lines) | strip(t).rlike("^[0-9]+$"))), "\n")


def chapter_title(x: Column) -> Column:
    """[C24] A title without its leading ``(N)`` and trailing number."""
    return strip(F.regexp_replace(F.regexp_replace(x, r"^\s*\([0-9]+\)\s*", ""), r"\s+[0-9]+\s*$", ""))


def without_verse_numbers(x: Column) -> Column:
    """[C25] Without numbers between double bars."""
    return strip(F.regexp_replace(x, r"\|\|\s*[0-9]+\s*\|\|?", ""))


def clean_label(x: Column) -> Column:
    """[C26] Without leading signs such as emoji, and without a trailing note between asterisks, from the first asterisk of the line that one closes at the end."""
    x = F.regexp_replace(x, r"^[^\p{L}\p{M}\p{N}_]+", "")
    return strip(F.regexp_replace(x, r"\s*\*.*\*\s*$", ""))


def short_heading(x: Column, prefix: str, alias: str) -> Column:
    """[C27] A fixed alias for headings with a prefix; ``?`` for none."""
    return F.coalesce(F.when(x.startswith(prefix), F.lit(alias)).otherwise(x), F.lit("?"))


def short_label(x: Column) -> Column:
    """[C28] Without a trailing note in brackets."""
    return F.regexp_replace(x, r"\s*\(.*\)\s*$", "")


def truncate(x: Column, n: int, more: str = "…") -> Column:
    """[C29] The first n characters, and ``more`` if any are cut."""
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit(more))).otherwise(x)


def truncate_units(x: Column, n: int, more: str = "…") -> Column:
    """[C29] The first n UTF-16 units, as a browser counts them, and ``more`` if any are cut; a pair that the cut would part goes whole."""
    # A text of more than n units has more than n in its first n + 1 characters, so no more of it is looked at.
    units = F.encode(F.substring(x, 1, n + 1), "UTF-16BE")
    parted = F.hex(F.substring(units, 2 * n - 1, 1)).between("D8", "DB")
    kept = F.decode(F.substring(units, F.lit(1), F.when(parted, 2 * n - 2).otherwise(2 * n)), "UTF-16BE")
    return F.when(F.length(units) > 2 * n, F.concat(kept, F.lit(more))).otherwise(x)



def escape_html(x: Column) -> Column:
    """[C30]"""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def slug(*parts: Column) -> Column:
    """[C31] Parts joined by dots."""
    return F.concat_ws(".", *parts)


def format_signature(run: Column) -> Column:
    """[C32] What makes two runs look alike."""
    return F.struct(*[run[n].alias(n) for n in ("bold", "italic", "underline", "size", "font", "color")])


def has_mixed_formatting(runs: Column) -> Column:
    """[C33] More than one run and more than one signature."""
    return (F.size(runs) > 1) & (F.size(F.array_distinct(F.transform(runs, format_signature))) > 1)


def fully_bold(runs: Column) -> Column:
    """[C34] At least one run with text, and all of those bold."""
    full = F.filter(runs, lambda r: F.coalesce(strip(r["text"]) != "", F.lit(False)))
    return (F.size(full) > 0) & F.forall(full, lambda r: F.coalesce(r["bold"], F.lit(False)))


def tag_of(color: Column, tags: dict[str, str], default: str | None = None) -> Column:
    """[C35] The tag of a colour; ``OTHER:`` and the colour, or ``default``, for an unknown one."""
    known = F.create_map(*[F.lit(v) for kv in tags.items() for v in kv])[color] if tags else F.lit(None).cast("string")
    return F.coalesce(known, F.lit(default) if default else F.concat(F.lit("OTHER:"), F.coalesce(color, F.lit("DEFAULT"))))


def without_rules(x: Column) -> Column:
    """[C36] Without lines that are three or more hyphens."""
    return F.array_join(F.filter(F.split(x, "\n", -1), lambda t: ~t.rlike(r"^\s*-{3,}\s*$")), "\n")


def first_label_in(heading: Column, commentaries: Column) -> Column:
    """[C38, G9] The first commentary whose label is part of a heading; null if none is."""
    return F.get(F.filter(commentaries, lambda c: F.contains(heading, c["label"])), 0)


def without_frontmatter(x: Column) -> Column:
    """[A3] What follows the second ``---`` line; the whole text if there are not two."""
    parts = F.split(x, "---\n", 3)
    return F.when(F.size(parts) == 3, F.element_at(parts, 3)).otherwise(x)


def is_placeholder(x: Column, phrase: str) -> Column:
    """[P3] Nothing but a placeholder phrase, maybe after a label and a colon."""
    return F.coalesce(x.rlike(rf"^\s*(?:[^:\n]+:\s*)?\[?{phrase}\]?\s*$"), F.lit(False))


def is_bracket_number(x: Column) -> Column:
    """[P4]"""
    return F.coalesce(strip(x).rlike(r"^\[[0-9A-Za-z\-–—]+\]$"), F.lit(False))


def without_title_and_colophon(x: Column, title: str, colophon: str) -> Column:
    """[C23] Without the first line that begins with ``title``, and without colophons and lone dandas; empty lines stay."""
    kept = F.filter(F.split(x, "\n", -1), lambda t: (t == "") | ~(t.rlike(colophon) | t.rlike("^॥+\\s*$")))
    first = F.array_position(F.transform(kept, lambda t: t.startswith(title)), True)
    return F.array_join(F.when(first > 0, F.filter(kept, lambda t, i: i != first - 1)).otherwise(kept), "\n")


#: Ordinal stems, 1 to 20, in ITRANS.
ORDINALS = (
    "prathama", "dvitIya", "tRRitIya", "chaturtha", "pa~nchama", "ShaShTha", "saptama", "aShTama", "navama", "dashama",
    "ekAdasha", "dvAdasha", "trayodasha", "chaturdasha", "pa~nchadasha", "ShoDasha", "saptadasha", "aShTAdasha", "ekonaviMsha", "viMsha",
)


def ordinal_chapter(number: Column) -> Column:
    """[C21] The ITRANS title of a chapter: an ordinal up to twenty, the number beyond, and the word for chapter."""
    stem = F.coalesce(F.get(F.array(*map(F.lit, ORDINALS)), (number - 1).cast("int")), number.cast("string"))
    return F.concat(stem, F.lit("o'dhyAyaH"))


def is_separator(x: Column) -> Column:
    """[P1] Empty paragraphs and end ornaments."""
    return F.coalesce(strip(x), F.lit("")).isin("") | F.contains(x, F.lit("o)0(o"))


def is_verse_end(x: Column) -> Column:
    """[P11] A line that ends with a verse number between bars."""
    return F.coalesce(x.rlike(r"\|\|\s*[0-9]+\s*\|\|\s*$"), F.lit(False))


def entry_description(title_iast: Column, title_english: Column, work_iast: Column, author: Column, labels: Column) -> Column:
    """[C39] What a page of an entry says of itself."""
    name = F.when(F.coalesce(title_english, F.lit("")) != "", F.concat(title_iast, F.lit(" — "), title_english)).otherwise(title_iast)
    return F.concat(name, F.lit(", from "), work_iast, F.lit(" by "), author, F.lit(", with commentaries by "), F.array_join(labels, ", "), F.lit("."))


def work_description(iast: Column, devanagari: Column, english: Column, author: Column, n: Column) -> Column:
    """[C39] What a page of a work says of itself."""
    quoted = F.when(F.coalesce(english, F.lit("")) != "", F.concat(F.lit(', "'), english, F.lit('"'))).otherwise("")
    plural = F.when(n == 1, "").otherwise("s")
    return F.concat(iast, F.lit(" ("), devanagari, F.lit(")"), quoted, F.lit(" by "), author, F.lit(" — "), n.cast("string"), F.lit(" section"), plural, F.lit(" with historical commentaries."))


def beside(path: Column, suffix: str) -> Column:
    """[C40] The path of a file that goes with another: the last extension replaced; a leading dot is no extension."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/.])(\.[^./]*)$", ""), F.lit(suffix))


def english_words() -> Column:
    """[I2] All words that speak for English: the strong and the weak ones, each once."""
    return F.array_union(F.array(*map(F.lit, STRONG_ENGLISH)), F.array(*map(F.lit, WEAK_ENGLISH)))
