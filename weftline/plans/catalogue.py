"""Registered queries over the driver's tables, with their oracle SQL.

Each query's docstring names the survey's operators that it covers.  Tables of the driver have no
transliterated text, so some queries first map accented letters to it, in both engines alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.functions import text as X
from weftline.functions import translit
from weftline.operators import align, graph, ordered, qc, relational
from weftline.sources import html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.lines(t(spark, sf_dir, "documents"), "doc_id", "text")


LINES = "lines AS (SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INT AS idx, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"
# Accented letters of the tables, and the transliteration letters they stand for here.
ACCENTS, LETTERS = "éèêçàùñ", "āīūśṣṛṇ"
IAST_SQL = f"translate(text, '{ACCENTS}', '{LETTERS}')"


def iast_text() -> F.Column:
    return F.translate("text", ACCENTS, LETTERS)


# Letters inside and outside the class of verse lines: ō and š are outside, ñ is inside.
VERSE_TO = "āōšśñṣ"
SCRIPT_SQL = """CASE WHEN regexp_matches(line, '[ঀ-৿]') THEN 'bengali' WHEN regexp_matches(line, '[ऀ-ॿ]') THEN 'devanagari'
  WHEN regexp_matches(line, '[a-zA-Z]') THEN CASE WHEN regexp_matches(line, '[āīūṛṝḷḹṃḥśṣñṅṭḍṇĀĪŪṚṜḶḸṂḤŚṢÑṄṬḌṆ]') THEN 'iast' ELSE 'plain' END ELSE 'other' END"""


@query(f"""WITH {LINES}, a AS (SELECT *, {SCRIPT_SQL} AS s FROM (SELECT doc_id, idx, translate(line, 'éèêçàù', '{VERSE_TO}') AS line FROM lines) WHERE trim(line) <> ''),
b AS (SELECT *, coalesce(last_value(CASE WHEN s <> 'other' THEN s END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx), 'other') AS tag FROM a),
c AS (SELECT *, CASE WHEN lag(tag) OVER w IS DISTINCT FROM tag AND row_number() OVER w > 1 THEN 1 ELSE 0 END AS new FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
d AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY idx) AS block FROM c)
SELECT doc_id, block::BIGINT AS block, tag, min(idx)::INT AS start, max(idx)::INT AS "end", count(*)::BIGINT AS n FROM d GROUP BY doc_id, block, tag""")
def line_script_blocks(spark, sf_dir):
    """Blocks of lines of one script; blank lines are none."""
    rows = doc_lines(spark, sf_dir).filter(F.trim("line") != "")
    rows = rows.withColumn("tag", X.line_script(F.translate("line", "éèêçàù", VERSE_TO)))
    return ordered.folded_blocks(rows, ["doc_id"], "idx", "tag")


@query("""WITH a AS (SELECT *, CASE WHEN lag(role) OVER w IS DISTINCT FROM role AND row_number() OVER w > 1 THEN 1 ELSE 0 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
b AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM a)
SELECT conv_id, block::BIGINT AS block, role, min(turn) AS start, max(turn) AS "end", string_agg(text, chr(10) ORDER BY turn) AS text FROM b GROUP BY conv_id, block, role""")
def conversation_islands(spark, sf_dir):
    """Consecutive turns of one role, texts joined."""
    return ordered.blocks(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role", "text")


@query("""WITH a AS (SELECT *, CASE WHEN turn % 3 = 1 THEN 'quoted' ELSE role END AS tag FROM conversations)
SELECT conv_id, turn, coalesce(last_value(CASE WHEN tag <> 'quoted' THEN tag END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn), 'root') AS context FROM a""")
def quoted_merge(spark, sf_dir):
    """Every third turn counts as quoted and joins its context."""
    rows = t(spark, sf_dir, "conversations").withColumn("tag", F.when(F.col("turn") % 3 == 1, "quoted").otherwise(F.col("role")))
    return ordered.merge_into_context(rows, ["conv_id"], ["turn"], "tag", "quoted", "root", "context").select("conv_id", "turn", "context")


@query("""WITH g AS (SELECT conv_id, role, min(turn) AS first_idx, count(*) AS n, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id, role)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY first_idx) AS rank FROM g""")
def tag_groups_in_order(spark, sf_dir):
    """Texts per role in order of first appearance."""
    return ordered.tag_groups(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role", "text")


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(replace(replace(text, 'er ', 'er-' || chr(10)), 'é', 'e' || chr(769))), '-\n(\S)', '\1', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents""")
def ocr_normalize(spark, sf_dir):
    """Line-end hyphens, put in after each 'er', are joined again, and letters taken apart are composed."""
    text = F.replace(F.replace("text", F.lit("er "), F.lit("er-\n")), F.lit("é"), F.lit("e\u0301"))
    return t(spark, sf_dir, "documents").select("doc_id", X.clean_ocr(text).alias("clean"))


@query("""WITH m AS (SELECT avg(n_chars) AS mean_length FROM documents)
SELECT doc_id, n_chars, CASE WHEN n_chars < 20 THEN 'near-empty' WHEN n_chars < 0.3::DOUBLE * mean_length THEN 'significantly below average' END AS reason,
  CASE WHEN n_chars < 20 OR n_chars < 0.3::DOUBLE * mean_length THEN 'flagged' ELSE 'ok' END AS status FROM documents, m""")
def page_quality(spark, sf_dir):
    """pages that are short against the mean of all."""
    return qc.page_status(t(spark, sf_dir, "documents"), F.col("n_chars")).select("doc_id", "n_chars", "reason", "status")


@query("""WITH m AS (SELECT avg(n_chars) AS mean_length FROM documents)
SELECT count(*)::BIGINT AS total, count_if(n_chars < 20 OR n_chars < 0.3::DOUBLE * mean_length)::BIGINT AS flagged, count_if(n_chars < 20)::BIGINT AS near_empty FROM documents, m""")
def page_report(spark, sf_dir):
    """totals of the page check."""
    rows = qc.page_status(t(spark, sf_dir, "documents"), F.col("n_chars"))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "flagged").alias("flagged"), F.count_if(F.col("reason") == "near-empty").alias("near_empty"))


# The scheme as its tables have it, in the order of the alphabet, for the oracle alone.
_PAIRS = {
    "c": ("k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v ś ṣ s h", "क ख ग घ ङ च छ ज झ ञ ट ठ ड ढ ण त थ द ध न प फ ब भ म य र ल व श ष स ह"),
    "v": ("a ā i ī u ū ṛ ṝ ḷ ḹ e ai o au", "अ आ इ ई उ ऊ ऋ ॠ ऌ ॡ ए ऐ ओ औ"),
    "m": ("ā i ī u ū ṛ ṝ ḷ ḹ e ai o au", "ा ि ी ु ू ृ ॄ ॢ ॣ े ै ो ौ"),
    "s": ("ṃ ṁ ḥ '' || | 0 1 2 3 4 5 6 7 8 9", "ं ं ः ऽ ॥ । ० १ २ ३ ४ ५ ६ ७ ८ ९"),
}
_MAPS = {k: "MAP {" + ", ".join(f"'{x}': '{y}'" for x, y in zip(a.split(), b.split(), strict=True)) + "}" for k, (a, b) in _PAIRS.items()}
_CONSONANT = "kh|gh|ch|jh|ṭh|ḍh|th|dh|ph|bh|[kgṅcjñṭḍṇtdnpbmyrlvśṣsh]"


def dev_sql(x: str) -> str:
    """Transliteration as DuckDB SQL: syllables are found and looked up, one by one."""
    head = f"regexp_extract(u, '^(?:{_CONSONANT})')"
    rest = f"substr(u, length({head}) + 1)"
    unit = f"""CASE WHEN {head} <> '' THEN {_MAPS["c"]}[{head}] || CASE {rest} WHEN '' THEN '्' WHEN 'a' THEN '' ELSE {_MAPS["m"]}[{rest}] END
      ELSE coalesce({_MAPS["v"]}[u], {_MAPS["s"]}[u], u) END"""
    return f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(?:{_CONSONANT})(?:ai|au|[aāiīuūṛṝḷḹeo])?|ai|au|\\|\\||(?s:.)'), lambda u: {unit}), '')"


# Devanagari is put into the texts, which must stay as it is.
MIXED_SCRIPT_SQL = f"replace({IAST_SQL}, 'que', 'कृष्ण')"
DEV_SQL = dev_sql(MIXED_SCRIPT_SQL)


def mixed_script_text() -> F.Column:
    return F.replace(iast_text(), F.lit("que"), F.lit("कृष्ण"))


@query(f"SELECT doc_id, {DEV_SQL} AS devanagari FROM documents")
def translit_iast(spark, sf_dir):
    """Transliteration as native expressions."""
    return t(spark, sf_dir, "documents").select("doc_id", translit.iast_to_devanagari(mixed_script_text()).alias("devanagari"))


@query(f"""SELECT doc_id, length(regexp_replace(regexp_replace(regexp_replace({DEV_SQL}, '\\[[^\\]]*\\]', '', 'g'), '\\([^)]*\\)', '', 'g'), '[^ऀ-ॿ]', '', 'g'))::BIGINT AS n FROM documents""")
def match_normalize_len(spark, sf_dir):
    """C17: length of the bare form used for matching."""
    return t(spark, sf_dir, "documents").select("doc_id", F.length(X.matching_form(translit.iast_to_devanagari(mixed_script_text()))).cast("long").alias("n"))


@query(f"""WITH {LINES} SELECT doc_id, idx, (sum(length(line)) OVER w)::BIGINT AS "end", ((sum(length(line)) OVER w) - length(line))::BIGINT AS start FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY idx)""")
def running_offsets(spark, sf_dir):
    """Offsets of lines in the joined text."""
    return ordered.running_offsets(doc_lines(spark, sf_dir), ["doc_id"], ["idx"], F.col("line")).select("doc_id", "idx", "end", "start")


HYPHEN_CLASS = "[a-zA-Zāīūṛṝḷḹṅñṭḍṇśṣṁṃḥ'']"


@query(f"""SELECT doc_id, regexp_replace(regexp_replace(replace({IAST_SQL}, ' ', '-'), '({HYPHEN_CLASS})-({HYPHEN_CLASS})', '\\1\\2', 'g'), '({HYPHEN_CLASS})-({HYPHEN_CLASS})', '\\1\\2', 'g') AS joined FROM documents""")
def hyphen_join(spark, sf_dir):
    """Hyphens, put for blanks, go between two letters."""
    return t(spark, sf_dir, "documents").select("doc_id", X.join_hyphens(F.replace(iast_text(), F.lit(" "), F.lit("-"))).alias("joined"))


@query("""SELECT event_id, translate(event_id::VARCHAR, '0123456789', '०१२३४५६७८९') AS digits, event_id AS back, translate('a’' || event_type || '‘', '’‘', '''''') AS quoted FROM events""")
def digit_and_quote_maps(spark, sf_dir):
    """Digits to Devanagari and back, quotes made straight."""
    digits = X.to_devanagari_digits(F.col("event_id"))
    return t(spark, sf_dir, "events").select(
        "event_id", digits.alias("digits"), X.from_devanagari_digits(digits).alias("back"),
        X.straight_quotes(F.concat(F.lit("a’"), F.col("event_type"), F.lit("‘"))).alias("quoted"),
    )


_lists = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
# One letter is taken apart; composed, it is no letter of the scheme.
MIXED_SQL = f"""WITH {LINES}, l AS (SELECT doc_id, idx, nfc_normalize(translate(replace(line, 'è', 'e' || chr(768)), 'éêçàùñ', 'āūśṣṛṇ')) AS line FROM lines),
k AS (SELECT *, list_distinct(list_transform(list_filter(list_transform(regexp_split_to_array(line, '\\s+'), lambda x: replace(replace(trim(x, '|()[]{{}}.,;:!?"''’‘'), '-', ''), '''', '')),
  lambda x: regexp_full_match(x, '[A-Za-z]+')), lambda x: lower(x))) AS toks, regexp_matches(line, '[Ā-ſḀ-ỿ̀-ͯ]') AS iast FROM l),
m AS (SELECT *, iast AND (regexp_matches(line, '^\\s*(?:[A-Za-z]+\\s*){{1,4}}:') OR len(list_intersect(toks, {_lists(X.STRONG_ENGLISH)})) > 0
  OR len(list_intersect(toks, {_lists(X.WEAK_ENGLISH)})) >= 2) AS mixed FROM k)
"""


def apart_lines(spark, sf_dir) -> DataFrame:
    """Lines of the documents with letters of the scheme and one that is taken apart; texts are composed before they are split."""
    docs = t(spark, sf_dir, "documents")
    apart = F.translate(F.replace("text", F.lit("è"), F.lit("e\u0300")), "éêçàùñ", "āūśṣṛṇ")
    return ordered.lines(docs.withColumn("text", X.composed(apart)), "doc_id", "text")


@query(MIXED_SQL + "SELECT doc_id, idx, iast, mixed FROM m")
def mixed_language(spark, sf_dir):
    """Lines with transliteration, and with English in it."""
    line = F.col("line")
    return apart_lines(spark, sf_dir).select("doc_id", "idx", X.looks_like_iast(line, False).alias("iast"), X.has_mixed_language(line, False).alias("mixed"))


@query(MIXED_SQL + """SELECT CASE WHEN NOT iast THEN 'skipped' WHEN mixed THEN 'mixed' ELSE 'converted' END AS disposition, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS docs FROM m GROUP BY 1""")
def dispositions(spark, sf_dir):
    """F4, C5 without its classifier: lines by what happens to them."""
    line = F.col("line")
    kind = F.when(~X.looks_like_iast(line, False), "skipped").when(X.has_mixed_language(line, False), "mixed").otherwise("converted")
    return apart_lines(spark, sf_dir).groupBy(kind.alias("disposition")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"))


@query(f"""WITH d AS (SELECT text, {DEV_SQL} AS dev FROM documents)
SELECT count(text)::BIGINT AS n_in, count(dev)::BIGINT AS n_out, count_if(regexp_matches(dev, '[ऀ-ॿ]') AND regexp_matches(dev, '[a-zA-Z]'))::BIGINT AS n_stray, count(text) = count(dev) AS match FROM d""")
def sanity_report(spark, sf_dir):
    """Inputs against outputs."""
    d = t(spark, sf_dir, "documents")
    return qc.sanity(d, F.col("text"), translit.iast_to_devanagari(mixed_script_text()))


EV = "e AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN event_type END AS mark FROM events)"


@query(f"""WITH {EV}, f AS (SELECT *, CASE WHEN mark IS NOT NULL AND row_number() OVER (PARTITION BY user_id, mark ORDER BY ts, event_id) = 1 THEN mark END AS fresh FROM e)
SELECT event_id, last_value(fresh IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS chunk FROM f""")
def marker_chunks(spark, sf_dir):
    """Events belong to the last marker seen for the first time."""
    rows = t(spark, sf_dir, "events").withColumn("mark", F.when(F.col("event_id") % 7 == 0, F.col("event_type")))
    return ordered.marker_chunks(rows, ["user_id"], ["ts", "event_id"], "mark").select("event_id", "chunk")


@query("""SELECT event_id, max((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) = 1 AS after FROM events""")
def seen_label_split(spark, sf_dir):
    """Events from a user's first purchase on."""
    return ordered.after_label(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase").select("event_id", "after")


@query("""SELECT event_id, last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""")
def carry_forward(spark, sf_dir):
    """The last value above fifty."""
    rows = t(spark, sf_dir, "events").withColumn("v", F.when(F.col("value") > 50, F.col("value")))
    return ordered.carry_forward(rows, ["user_id"], ["ts", "event_id"], "v", "carried").select("event_id", "carried")


@query("""SELECT event_id, coalesce(lead(event_id) OVER w, -1) AS next_id, coalesce(lag(event_id) OVER w, -1) AS prev_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def next_start_range(spark, sf_dir):
    """Neighbours in a user's events."""
    rows = ordered.next_start(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_id", "next_id")
    return ordered.neighbours(rows, ["user_id"], ["ts", "event_id"], "event_id").select("event_id", F.coalesce("next_id", F.lit(-1).cast("long")).alias("next_id"), F.coalesce("prev", F.lit(-1).cast("long")).alias("prev_id"))


@query("""SELECT * FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) WHERE previous > value""")
def out_of_order(spark, sf_dir):
    """Values that fall."""
    return ordered.out_of_order(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "value", "previous")


@query("""WITH a AS (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, event_type FROM a WHERE k = 1 OR event_type IS DISTINCT FROM p""")
def without_repeats(spark, sf_dir):
    """Consecutive repeats dropped."""
    return ordered.without_repeats(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "event_type")


@query("""WITH a AS (SELECT *, sum((event_type = 'view')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY g) AS chunk FROM a WHERE event_type <> 'view'""")
def separator_chunks(spark, sf_dir):
    """Runs between views, empty ones not counted."""
    return ordered.separator_chunks(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "view").select("event_id", "chunk")


@query("""WITH a AS (SELECT *, event_type = 'purchase' AS e FROM events),
b AS (SELECT *, coalesce(sum(e::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(e::INT) OVER (PARTITION BY user_id) AS n FROM a)
SELECT event_id, (b + 1)::BIGINT AS segment FROM b WHERE b < n""")
def closed_segments(spark, sf_dir):
    """Segments that end with a purchase; the open rest is dropped."""
    return ordered.segments(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase").select("event_id", "segment")


@query("""WITH q AS (SELECT o_orderkey AS k, unnest([1, 2, 3]) AS block, unnest([2, 1, 2]) AS quota FROM orders),
s AS (SELECT *, sum(quota) OVER (PARTITION BY k ORDER BY block) AS hi FROM q), i AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem)
SELECT i.k, i.n::BIGINT AS n, coalesce(s.block, -1) AS block FROM i LEFT JOIN s ON i.k = s.k AND i.n > s.hi - s.quota AND i.n <= s.hi""")
def quota_assignment(spark, sf_dir):
    """Lines of an order dealt to blocks of 2, 1 and 2; those beyond are marked, not refused."""
    orders = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    quotas = orders.select("k", F.inline(F.array(*[F.struct(F.lit(b).alias("block"), F.lit(q).alias("quota")) for b, q in ((1, 2), (2, 1), (3, 2))])))
    items = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"))
    return ordered.assign_quotas(items, quotas, ["k"], "n", "block", "quota", excess="null").select("k", "n", F.coalesce("block", F.lit(-1)).alias("block"))


@query("""WITH g AS (SELECT user_id, event_type, sum(length(props)) AS total, min(event_id) AS first FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, first) AS n FROM g) SELECT user_id, event_type, total::BIGINT AS total FROM r WHERE n = 1""")
def dominant_value(spark, sf_dir):
    """F1, H5: a user's main event type by length of properties, ties to the first seen."""
    return ordered.dominant(t(spark, sf_dir, "events"), ["user_id"], "event_type", F.length("props").cast("long"), "event_id", "DEFAULT").select("user_id", "event_type", "total")


@query("""WITH m AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'login' OR event_id % 11 = 0 THEN event_id END AS mark FROM events),
a AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS r FROM m)
SELECT user_id, coalesce(r, -1) AS range_id, count(*)::BIGINT AS n, sum(event_id)::BIGINT AS total FROM a GROUP BY ALL""")
def range_slices(spark, sf_dir):
    """Events in half-open ranges, by an as-of window."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    ranges = e.filter((F.col("event_type") == "login") | (F.col("event_id") % 11 == 0)).select("user_id", F.col("event_id").alias("from"), F.col("event_id").alias("range_id"))
    rows = ordered.slice_ranges(e, ranges, ["user_id"], "event_id", "from", "range_id")
    return rows.groupBy("user_id", F.coalesce("range_id", F.lit(-1).cast("long")).alias("range_id")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))


@query("""WITH p AS (SELECT l_orderkey AS k, sum(l_quantity) AS a, sum(CASE WHEN l_linenumber > 1 THEN l_quantity ELSE 0 END) AS b FROM lineitem GROUP BY 1)
SELECT k, a, b, a - b AS deficit, b / a AS ratio FROM p WHERE a <> 0 AND a - b > 20 AND b / a < 0.97::DOUBLE""")
def deficit_qc(spark, sf_dir):
    """Orders whose first line is much of the whole."""
    rows = t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("a"), F.sum(F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).otherwise(0)).alias("b"))
    return align.deficits(rows, "a", "b", 20).select("k", "a", "b", "deficit", "ratio")


@query("SELECT a.n_nationkey, a.n_name, b.n_regionkey FROM nation a JOIN nation b USING (n_nationkey)")
def zip_by_position(spark, sf_dir):
    """G1: positions joined one to one, or an error."""
    n = t(spark, sf_dir, "nation")
    return relational.zip_positions(n.select("n_nationkey", "n_name"), n.select("n_nationkey", "n_regionkey"), ["n_nationkey"])


@query("SELECT k AS n_nationkey, n_name FROM range(0, 31) r(k) LEFT JOIN nation ON k = n_nationkey")
def left_from_sequence(spark, sf_dir):
    """A fixed range of keys, with gaps as nulls."""
    return relational.fill_sequence(t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name"), "n_nationkey", 0, 30)


@query("""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_totalprice AS high, coalesce(b.o_custkey, -1) AS even FROM (SELECT * FROM orders WHERE o_totalprice > 150000) a
FULL JOIN (SELECT * FROM orders WHERE o_custkey % 2 = 0) b ON a.o_orderkey = b.o_orderkey""")
def full_outer_merge(spark, sf_dir):
    """Keys of either side."""
    o = t(spark, sf_dir, "orders")
    return relational.full_merge(o.filter("o_totalprice > 150000").select("o_orderkey", F.col("o_totalprice").alias("high")), o.filter("o_custkey % 2 = 0").select("o_orderkey", F.col("o_custkey").alias("even")), ["o_orderkey"]).fillna(-1, ["even"])


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'mula' WHEN 'view' THEN 'quoted' ELSE 'OTHER:' || event_type END AS tag FROM events""")
def dimension_tags(spark, sf_dir):
    """A small map, unknown values marked."""
    return t(spark, sf_dir, "events").select("event_id", X.tag_of(F.col("event_type"), {"click": "mula", "view": "quoted"}).alias("tag"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf_dir):
    """Documents not labelled yet."""
    return relational.todo(t(spark, sf_dir, "documents").select("doc_id", "n_chars"), t(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def limit_then_resume(spark, sf_dir):
    """H3: the limit counts before finished items go."""
    return relational.todo(t(spark, sf_dir, "documents").select("doc_id"), t(spark, sf_dir, "labels"), ["doc_id"], 100)


_ANCHOR = """'(?is)<a\\b[^>]*?\\bhref\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))[^>]*>(.*?)</a>'"""
# Every second page quotes its addresses with single quotes, every third not at all, and labels get a reference.
_HTML = """replace(CASE page_id % 3 WHEN 1 THEN regexp_replace(html, 'href="([^"]*)"', 'href=''\\1''', 'g') WHEN 2 THEN regexp_replace(html, 'href="([^"]*)"', 'href=\\1', 'g') ELSE html END, '</a>', ' <i> &amp; </i></a>')"""


def linked_pages(spark, sf_dir) -> DataFrame:
    single = F.regexp_replace("html", 'href="([^"]*)"', "href='$1'")
    bare = F.regexp_replace("html", 'href="([^"]*)"', "href=$1")
    page = F.when(F.col("page_id") % 3 == 1, single).when(F.col("page_id") % 3 == 2, bare).otherwise(F.col("html"))
    return t(spark, sf_dir, "pages").withColumn("html", F.replace(page, F.lit("</a>"), F.lit(" <i> &amp; </i></a>")))


@query(f"""WITH p AS (SELECT page_id, {_HTML} AS html FROM pages),
a AS (SELECT page_id, {", ".join(f"regexp_extract_all(html, {_ANCHOR}, {k}) AS g{k}" for k in (1, 2, 3, 4))} FROM p),
u AS (SELECT page_id, (unnest(range(0, len(g4))))::INT AS pos, concat(unnest(g1), unnest(g2), unnest(g3)) AS href, unnest(g4) AS label FROM a)
SELECT page_id, pos, replace(href, '&amp;', '&') AS href, replace(array_to_string(list_transform(regexp_split_to_array(label, '<[^>]*>'), lambda x: trim(x)), ''), '&amp;', '&') AS label FROM u""")
def toc_links(spark, sf_dir):
    """Anchors of pages in order, however their addresses are quoted."""
    return html.links(linked_pages(spark, sf_dir), ["page_id"], "html")


CITES = """c AS (SELECT l_orderkey, l_linenumber, l_suppkey, (l_partkey % 4 + 1) AS a, (l_suppkey % 4 + 1) AS p, (l_partkey % 60) AS s, CASE WHEN l_partkey % 3 = 0 THEN 'वे.सू.' ELSE 'ब्र.सू.' END AS abbrev FROM lineitem WHERE l_partkey % 5 <> 0)"""


def citation_lines(spark, sf_dir):
    """References written into lines, so that the pattern has something to find."""
    rows = t(spark, sf_dir, "lineitem")
    abbrev = F.when(F.col("l_partkey") % 3 == 0, "वे.सू.").otherwise("ब्र.सू.")
    num = graph.devanagari_triple(F.col("l_partkey") % 4 + 1, F.col("l_suppkey") % 4 + 1, F.col("l_partkey") % 60)
    cite = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("x ["), abbrev, F.lit(" "), num, F.lit("] y"))).otherwise(F.lit("[see] none"))
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", cite.alias("line"))


@query(f"WITH {CITES} SELECT l_orderkey, l_linenumber, abbrev, a::BIGINT AS adhyaya, p::BIGINT AS pada, s::BIGINT AS sutra, concat_ws('.', a, p, s) AS sutra_id FROM c")
def citation_edges(spark, sf_dir):
    """References in lines of all works; ``citation_edges_of_works`` has P5."""
    return graph.citations(citation_lines(spark, sf_dir)).select("l_orderkey", "l_linenumber", "abbrev", "adhyaya", "pada", "sutra", "sutra_id")


@query(f"""WITH {CITES} SELECT l_orderkey, l_linenumber, w AS work, abbrev, a::BIGINT AS adhyaya, p::BIGINT AS pada, s::BIGINT AS sutra, concat_ws('.', a, p, s) AS sutra_id
FROM (SELECT *, ['tattva-sandarbha', 'bhagavat-sandarbha', 'paramatma-sandarbha', 'krishna-sandarbha', 'govinda-bhashya', 'stavamala'][l_suppkey % 6 + 1] AS w FROM c) WHERE w NOT IN ('govinda-bhashya', 'stavamala')""")
def citation_edges_of_works(spark, sf_dir):
    """References in lines of the works in the allow-list; two of six made-up works are not in it."""
    slugs = F.array(*map(F.lit, (*graph.WORKS, "govinda-bhashya", "stavamala")))
    rows = citation_lines(spark, sf_dir).withColumn("work", F.get(slugs, (F.col("l_suppkey") % 6).cast("int")))
    return graph.citations(graph.of_works(rows, "work")).select("l_orderkey", "l_linenumber", "work", "abbrev", "adhyaya", "pada", "sutra", "sutra_id")


@query(f"""WITH {CITES}, e AS (SELECT concat_ws('.', a, p, s) AS sutra_id, abbrev, l_orderkey, l_linenumber FROM c),
f AS (SELECT sutra_id, abbrev, min((l_orderkey, l_linenumber)) AS pos, count(*) AS n FROM e GROUP BY ALL)
SELECT sutra_id, sum(n)::BIGINT AS citation_count, count(*)::BIGINT AS n_sources, string_agg(abbrev, ',' ORDER BY pos, abbrev) AS sources, CASE WHEN count(*) > 1 THEN 'both' ELSE 'single' END AS kind FROM f GROUP BY sutra_id""")
def citation_nodes(spark, sf_dir):
    """per target, counts and sources in order of first mention."""
    return graph.target_nodes(graph.citations(citation_lines(spark, sf_dir)), "sutra_id", "abbrev", ["l_orderkey", "l_linenumber"])


@query(f"WITH {CITES} SELECT l_suppkey, count(*)::BIGINT AS citation_count, count(DISTINCT concat_ws('.', a, p, s))::BIGINT AS n_targets FROM c GROUP BY 1")
def citation_sources(spark, sf_dir):
    """per source, citations and distinct targets."""
    return graph.source_nodes(graph.citations(citation_lines(spark, sf_dir)), ["l_suppkey"], "sutra_id")


@query("""WITH p AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), z AS (SELECT l_partkey, count(*) AS size FROM p GROUP BY 1)
SELECT l_suppkey, sum(size - 1)::BIGINT AS paths, count(*)::BIGINT AS middles FROM p JOIN z USING (l_partkey) GROUP BY 1""")
def two_hop(spark, sf_dir):
    """Suppliers over shared parts, without spelling out pairs."""
    return graph.two_hop(t(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


@query("""SELECT o_custkey, o_orderkey, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)""")
def position_number(spark, sf_dir):
    """Orders of a customer numbered by position."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("n"))


@query("""SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) WHERE n = 1""")
def first_per_key(spark, sf_dir):
    """F16, I4: the first part of each brand."""
    return ordered.first_per_key(t(spark, sf_dir, "part"), ["p_brand"], ["p_partkey"]).select("p_brand", "p_partkey", "p_name")


@query("""SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) AS n FROM part) WHERE n = 1""")
def last_wins(spark, sf_dir):
    """The last part of each brand."""
    return ordered.last_wins(t(spark, sf_dir, "part"), ["p_brand"], "p_partkey").select("p_brand", "p_partkey", "p_name")


# Headings that are padded, empty and without a blank are among them.
HEADED = f"""{LINES}, h AS (SELECT doc_id, idx, CASE WHEN idx % 12 = 8 THEN '##  ' WHEN idx % 12 = 10 THEN '##' || left(line, 5) WHEN idx % 6 = 2 THEN '##   ' || left(line, 12) || '  ' WHEN idx % 6 IN (0, 4) THEN '### ' || left(line, 8) ELSE line END AS line FROM lines),
s AS (SELECT *, regexp_matches(line, '^##\\s+') AS h2, regexp_matches(line, '^###\\s+') AS h3 FROM h),
g AS (SELECT *, sum(h2::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS sn FROM s), u AS (SELECT *, sum(h3::INT) OVER (PARTITION BY doc_id, sn ORDER BY idx) AS tn FROM g)"""


@query(f"""WITH {HEADED} SELECT doc_id, idx, (CASE WHEN sn > 0 THEN sn - 1 ELSE -1 END)::BIGINT AS section, (CASE WHEN sn > 0 AND tn > 0 THEN tn - 1 ELSE -1 END)::BIGINT AS sub,
last_value(CASE WHEN h2 THEN trim(regexp_replace(line, '^##\\s+', '')) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx) AS heading FROM u""")
def sections_hierarchy(spark, sf_dir):
    """Two heading levels over lines."""
    return ordered.sections(headed_lines(spark, sf_dir), "doc_id", "idx", "line").fillna(-1, ["section", "sub"]).select("doc_id", "idx", "section", "sub", "heading")


def headed_lines(spark, sf_dir) -> DataFrame:
    at, start = F.col("idx"), lambda n: F.substring("line", 1, n)
    head = F.when(at % 12 == 8, F.lit("##  ")).when(at % 12 == 10, F.concat(F.lit("##"), start(5))).when(at % 6 == 2, F.concat(F.lit("##   "), start(12), F.lit("  ")))
    head = head.when((at % 6).isin(0, 4), F.concat(F.lit("### "), start(8))).otherwise(F.col("line"))
    return doc_lines(spark, sf_dir).withColumn("line", head)


@query(f"""WITH {LINES}, a AS (SELECT *, idx % 5 = 1 AS s, idx % 5 = 3 AS e FROM lines),
b AS (SELECT *, coalesce(sum(e::INT) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM a),
c AS (SELECT *, max(s::INT) OVER (PARTITION BY doc_id, g ORDER BY idx) AS i FROM b)
SELECT doc_id, min(idx)::INT AS start, max(idx)::INT AS "end", string_agg(line, ' ' ORDER BY idx) AS text FROM c WHERE i = 1 GROUP BY doc_id, g HAVING bool_or(e)""")
def span_colophon(spark, sf_dir):
    """Spans from a start line to the next end line."""
    rows = doc_lines(spark, sf_dir)
    return ordered.open_spans(rows, ["doc_id"], "idx", F.col("idx") % 5 == 1, F.col("idx") % 5 == 3, "line")


@query(f"""WITH {LINES}, a AS (SELECT *, CASE WHEN idx % 4 = 0 THEN line || '\\-' ELSE line END AS l FROM lines),
b AS (SELECT *, sum(CASE WHEN lag_l IS NULL OR NOT ends_with(lag_l, '\\-') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx) AS g FROM (SELECT *, lag(l) OVER (PARTITION BY doc_id ORDER BY idx) AS lag_l FROM a))
SELECT doc_id, min(idx)::INT AS idx, string_agg(CASE WHEN ends_with(l, '\\-') THEN left(l, length(l) - 2) ELSE l END, '' ORDER BY idx) AS line, count(*)::BIGINT AS n_lines FROM b GROUP BY doc_id, g""")
def dehyphenate(spark, sf_dir):
    """Lines with a continuation mark, put on every fourth, joined."""
    rows = doc_lines(spark, sf_dir).withColumn("line", F.when(F.col("idx") % 4 == 0, F.concat("line", F.lit("\\-"))).otherwise(F.col("line")))
    return ordered.join_continued(rows, ["doc_id"], "idx", "line", "\\-")


@query(f"""WITH {LINES}, a AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY idx) AS nx FROM lines)
SELECT doc_id, idx, (unnest(CASE WHEN ends_with(line, '.') AND trim(nx) <> '' THEN [0, 1] ELSE [0] END))::INT AS sub, unnest(CASE WHEN ends_with(line, '.') AND trim(nx) <> '' THEN [line, ''] ELSE [line] END) AS line FROM a""")
def verse_breaks(spark, sf_dir):
    """An empty line after lines that end with a full stop."""
    return ordered.verse_breaks(doc_lines(spark, sf_dir), ["doc_id"], "idx", "line", F.col("line").endswith("."))


@query(f"""WITH {LINES}, e AS (SELECT doc_id, idx, CASE WHEN idx % 3 = 2 THEN '' ELSE line END AS line FROM lines),
a AS (SELECT *, sum((trim(line) = '')::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS g FROM e), b AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY g) AS para FROM a WHERE trim(line) <> '')
SELECT doc_id, para, min(idx)::INT AS start, count(*)::BIGINT AS n_lines, string_agg(line, chr(10) ORDER BY idx) AS text FROM b GROUP BY doc_id, para""")
def paragraph_split(spark, sf_dir):
    """Paragraphs between empty lines."""
    rows = doc_lines(spark, sf_dir).withColumn("line", F.when(F.col("idx") % 3 == 2, "").otherwise(F.col("line")))
    return ordered.paragraphs(rows, ["doc_id"], "idx", "line")


@query(f"""WITH {LINES}, k AS (SELECT doc_id, idx, line FROM lines WHERE NOT regexp_full_match(line, '[|()0-9\\s]+') AND NOT regexp_full_match(line, '\\s*-{{3,}}\\s*'))
SELECT doc_id, count(*)::BIGINT AS n, string_agg(left(line, 20), '|' ORDER BY idx) AS heads FROM k GROUP BY doc_id""")
def line_cleanup(spark, sf_dir):
    """Marker lines and rules dropped, heads of the lines that stay, as its SQL has it; ``line_cleanup_whole`` has P9, P10 and whole lines."""
    clean = X.without_rules(X.without_marker_lines(F.col("text")))
    ls = F.split(clean, "\n", -1)
    return t(spark, sf_dir, "documents").select("doc_id", F.size(ls).cast("long").alias("n"), F.array_join(F.transform(ls, lambda x: F.substring(x, 1, 20)), "|").alias("heads"))


# Every few lines of a text become a line that must go, or one that looks like it and must stay.
_GOING = ("|| 1.2 ||", " 12. label of a topic", "( 1.2 )", "prathamo'dhyāyaḥ", "Dvitīyaḥ  pādaḥ", "---", "@12", "(39]", "|| 3 ||")
_STAYING = ("|| 1.2 || tail", "12 no dot", "prathamaḥ x", "@1x", "(39] and more", "a 12. label")


@query(rf"""WITH {LINES}, a AS (SELECT doc_id, idx, CASE WHEN idx % 3 = 1 THEN [{', '.join("'" + x.replace("'", "''") + "'" for x in _GOING)}][(idx // 3 + doc_id) % {len(_GOING)} + 1] WHEN idx % 7 = 2 THEN [{', '.join(f"'{x}'" for x in _STAYING)}][(idx // 7 + doc_id) % {len(_STAYING)} + 1] ELSE line END AS line FROM lines),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13) || chr(160)) AS x FROM a WHERE NOT regexp_full_match(line, '[|()0-9\s]+') AND NOT regexp_full_match(line, '\s*-{{3,}}\s*')),
g AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY idx) AS clean FROM k WHERE NOT (regexp_full_match(x, '\|\|\s*[0-9.]+\s*\|\|') OR regexp_full_match(x, '[0-9]+\.\s*.+') OR regexp_full_match(x, '\(\s*[0-9.]+\s*\)') OR regexp_full_match(x, '@[0-9]+') OR regexp_full_match(x, '[(\[][0-9]+[)\]]')
  OR length(x) < 70 AND (regexp_matches(lower(x), '^(prathamo|dvitīyo|tṛtīyo|caturtho)[''’]?dhyāy') OR regexp_matches(lower(x), '^(prathamaḥ|dvitīyaḥ|tṛtīyaḥ|caturthaḥ)\s*pādaḥ'))) GROUP BY doc_id)
SELECT doc_id, coalesce(clean, '') AS clean FROM documents LEFT JOIN g USING (doc_id)""")
def line_cleanup_whole(spark, sf_dir):
    """Marker, rule, section and stray lines, put into the texts with others like them, dropped; the whole cleaned text."""
    at, doc = F.col("idx"), F.col("doc_id")
    pick = lambda of, every: F.get(F.array(*map(F.lit, of)), ((F.floor(at / every) + doc) % len(of)).cast("int"))
    line = F.when(at % 3 == 1, pick(_GOING, 3)).when(at % 7 == 2, pick(_STAYING, 7)).otherwise(F.col("line"))
    texts = doc_lines(spark, sf_dir).withColumn("line", line).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda r: r["line"]), "\n").alias("text"))
    return texts.select("doc_id", X.without_section_lines(X.without_rules(X.without_marker_lines(F.col("text")))).alias("clean"))


@query("""SELECT doc_id, replace(replace(replace(replace(CASE WHEN length(text) > 220 THEN left(text, 220) || '…' ELSE text END, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS shown FROM documents""")
def excerpt(spark, sf_dir):
    """Escaped excerpts."""
    return t(spark, sf_dir, "documents").select("doc_id", X.escape_html(X.truncate(F.col("text"), 220)).alias("shown"))


@query("""SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS orders, count(*)::BIGINT AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 1""")
def grouped_entries(spark, sf_dir):
    """entries per work in sequence."""
    entries = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(entries, lambda r: r["o_orderkey"].cast("string")), ",").alias("orders"), F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


@query(r"""WITH a AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN '(' || p_size || ') ' || p_name || ' ' || p_size WHEN p_partkey % 4 = 1 THEN '🔷 ' || p_name || ' *' || p_brand || '*' ELSE '🔷 ' || p_name || ' *(' || p_brand || ')*' END AS x FROM part)
SELECT p_partkey, trim(regexp_replace(regexp_replace(x, '^\s*\([0-9]+\)\s*', ''), '\s+[0-9]+\s*$', '')) AS title,
  trim(regexp_replace(regexp_replace(x, '^[^\p{L}\p{M}\p{N}_]+', ''), '\s*\*.*\*\s*$', '')) AS label FROM a""")
def titles_and_labels(spark, sf_dir):
    """Titles and labels without their ornaments."""
    p = t(spark, sf_dir, "part")
    key = F.col("p_partkey")
    x = F.when(key % 2 == 0, F.concat(F.lit("("), "p_size", F.lit(") "), "p_name", F.lit(" "), "p_size")).when(key % 4 == 1, F.concat(F.lit("🔷 "), "p_name", F.lit(" *"), "p_brand", F.lit("*")))
    x = x.otherwise(F.concat(F.lit("🔷 "), "p_name", F.lit(" *("), "p_brand", F.lit(")*")))
    return p.select("p_partkey", X.chapter_title(x).alias("title"), X.clean_label(x).alias("label"))


# Lines of a text take scripts in turn, so that texts of different lengths have all the faults there are.
_SCRIPTS_SQL = f"""{LINES}, a AS (SELECT doc_id, idx, CASE idx % 11 WHEN 1 THEN CASE WHEN doc_id % 3 = 0 THEN '|| ' || idx || ' || অ' ELSE 'অ ' || line END WHEN 2 THEN '(12)' WHEN 3 THEN 'अ ' || line WHEN 4 THEN 'अ' WHEN 5 THEN 'ā ' || line WHEN 6 THEN CASE WHEN doc_id % 5 = 0 THEN 'अ' ELSE 'a ' || line END
  WHEN 7 THEN '|| 3 ||' ELSE CASE WHEN doc_id % 7 = 0 THEN 'অ' ELSE line END END AS line FROM lines WHERE idx < 11),
s AS (SELECT *, {SCRIPT_SQL} AS s FROM a WHERE trim(line) <> '')"""


@query(rf"""WITH {_SCRIPTS_SQL}, b AS (SELECT *, coalesce(last_value(CASE WHEN s <> 'other' THEN s END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx), 'other') AS tag FROM s),
c AS (SELECT *, CASE WHEN lag(tag) OVER w IS DISTINCT FROM tag THEN 1 ELSE 0 END AS new FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
k AS (SELECT doc_id, g, tag, string_agg(line, chr(10) ORDER BY idx) AS text FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY idx) AS g FROM c) GROUP BY doc_id, g, tag),
f AS (SELECT *, min(g) FILTER (tag = 'bengali') OVER (PARTITION BY doc_id) AS m FROM k), h AS (SELECT *, min(g) FILTER (tag = 'devanagari' AND g > m) OVER (PARTITION BY doc_id) AS d FROM f),
l AS (SELECT *, max(g) FILTER (tag IN ('iast', 'plain') AND g > d) OVER (PARTITION BY doc_id) AS z FROM h),
r AS (SELECT doc_id, first(d) AS d, max(text) FILTER (g = m) AS main, string_agg(text, chr(10) ORDER BY g) FILTER (tag IN ('iast', 'plain') AND g > d AND g < z) AS rest, count(*) FILTER (tag IN ('iast', 'plain') AND g > d) AS n FROM l GROUP BY doc_id),
x AS (SELECT doc_id, d, n, array_to_string(list_filter(string_split(main, chr(10)), lambda x: NOT regexp_full_match(x, '[|()0-9\s]+')), chr(10)) AS main, array_to_string(list_filter(string_split(coalesce(rest, ''), chr(10)), lambda x: NOT regexp_full_match(x, '[|()0-9\s]+')), chr(10)) AS rest FROM r),
y AS (SELECT *, CASE WHEN d IS NULL THEN 'missing bengali or devanagari block' WHEN n = 0 THEN 'no latin (IAST) block found after devanagari' WHEN n = 1 THEN 'only one latin block -- can''t distinguish IAST from plain transliteration'
  WHEN trim(main) = '' OR trim(rest) = '' THEN 'empty bengali or iast after marker-stripping' END AS reason FROM x)
SELECT doc_id, CASE WHEN reason IS NULL THEN main END AS main, CASE WHEN reason IS NULL THEN rest END AS rest, reason FROM y""")
def pick_blocks(spark, sf_dir):
    """Of blocks of one script, the first Bengali one and the Latin ones after the first Devanagari one but the last, without marker lines, or why not."""
    at, doc, line = F.col("idx") % 11, F.col("doc_id"), F.col("line")
    bengali = F.when(doc % 3 == 0, F.concat(F.lit("|| "), "idx", F.lit(" || অ"))).otherwise(F.concat(F.lit("অ "), line))
    made = F.when(at == 1, bengali).when(at == 2, "(12)").when(at == 3, F.concat(F.lit("अ "), line)).when(at == 4, "अ").when(at == 5, F.concat(F.lit("ā "), line))
    made = made.when(at == 6, F.when(doc % 5 == 0, "अ").otherwise(F.concat(F.lit("a "), line))).when(at == 7, "|| 3 ||").otherwise(F.when(doc % 7 == 0, "অ").otherwise(line))
    rows = doc_lines(spark, sf_dir).filter("idx < 11").withColumn("line", made).filter(F.trim("line") != "")
    blocks = ordered.folded_blocks(rows.withColumn("tag", X.line_script(F.col("line"))), ["doc_id"], "idx", "tag", text="line")
    return ordered.pick_blocks(blocks, ["doc_id"], "block", "tag", "text")


@query("""WITH a AS (SELECT *, event_id % 13 = 0 AS c, event_id % 13 <> 0 AND event_type = 'view' AS s FROM events),
b AS (SELECT *, sum(c::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS chapter FROM a),
g AS (SELECT *, sum(s::INT) OVER (PARTITION BY user_id, chapter ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM b),
f AS (SELECT *, max((trim(props) <> '')::INT) OVER (PARTITION BY user_id, chapter, g) AS filled FROM g WHERE NOT c AND NOT s)
SELECT event_id, chapter::BIGINT AS chapter, dense_rank() OVER (PARTITION BY user_id, chapter ORDER BY g) AS item FROM f WHERE filled = 1""")
def numbered_items(spark, sf_dir):
    """Chapters and items numbered by position."""
    chapter = F.col("event_id") % 13 == 0
    return ordered.numbered_items(t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], chapter, ~chapter & (F.col("event_type") == "view"), F.col("props")).select("event_id", "chapter", "item")


@query("""SELECT p_brand, p_partkey, place FROM (SELECT p_brand, p_partkey, (coalesce(list_position(['3', '1'], (p_size % 4)::VARCHAR), 0) - 1)::BIGINT AS place,
row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part) WHERE n = 1""")
def works_by_category(spark, sf_dir):
    """F16: the first entry of each work with its category's place in a custom order."""
    parts = t(spark, sf_dir, "part").withColumn("category", (F.col("p_size") % 4).cast("string"))
    return ordered.by_category(parts, "p_brand", "category", ["p_size", "p_partkey"], ["3", "1"]).select("p_brand", "p_partkey", "place")


@query("""WITH a AS (SELECT *, event_type = 'purchase' AS m, value > 30 AS r, event_id % 5 = 0 AS b FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM a),
f AS (SELECT x.event_id AS mark, y.event_id AS i, y.r, row_number() OVER (PARTITION BY x.event_id ORDER BY y.k) AS p FROM n x JOIN n y ON x.user_id = y.user_id AND y.k > x.k AND y.k < x.k + 20 WHERE x.m AND NOT y.b),
s AS (SELECT mark, min(CASE WHEN r THEN p END) AS a FROM f GROUP BY mark),
z AS (SELECT f.mark, a, coalesce(min(CASE WHEN NOT r AND p > a THEN p END), 1000000) AS z FROM f JOIN s ON f.mark = s.mark GROUP BY f.mark, a)
SELECT n.event_id, count(f.i)::BIGINT AS n_run, coalesce(min(f.i), -1) AS first_run FROM n LEFT JOIN z ON n.event_id = z.mark LEFT JOIN f ON f.mark = z.mark AND f.p >= z.a AND f.p < z.z AND f.p < z.a + 4 WHERE n.m GROUP BY n.event_id""")
def next_runs(spark, sf_dir):
    """E29 on a small frame, as its SQL has it: within 20 events, four at most; ``next_runs_whole`` has the whole rule."""
    rows = ordered.next_run(t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "purchase", F.col("value") > 30, F.col("event_id") % 5 == 0, 20, 4)
    return rows.select("event_id", F.size("run").cast("long").alias("n_run"), F.coalesce(F.get("run", 0), F.lit(-1)).alias("first_run"))


@query("""WITH n AS (SELECT *, event_type = 'purchase' AS m, value > 30 AS r, event_id % 5 = 0 AS b, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
f AS (SELECT x.event_id AS mark, y.event_id AS i, y.r, row_number() OVER (PARTITION BY x.event_id ORDER BY y.k) AS p FROM n x JOIN n y ON x.user_id = y.user_id AND y.k > x.k AND y.k < x.k + 400 WHERE x.m AND NOT y.b),
s AS (SELECT mark, min(CASE WHEN r THEN p END) AS a FROM f GROUP BY mark),
z AS (SELECT f.mark, a, coalesce(min(CASE WHEN NOT r AND p > a THEN p END), 1000000) AS z FROM f JOIN s ON f.mark = s.mark GROUP BY f.mark, a)
SELECT n.event_id, count(f.i)::BIGINT AS n_run, coalesce(string_agg(f.i::VARCHAR, ' ' ORDER BY f.p), '') AS run FROM n LEFT JOIN z ON n.event_id = z.mark LEFT JOIN f ON f.mark = z.mark AND f.p >= z.a AND f.p < z.z AND f.p < z.a + 6 WHERE n.m GROUP BY n.event_id""")
def next_runs_whole(spark, sf_dir):
    """After each purchase the next run of high values within 400 events, six at most."""
    rows = ordered.next_run(t(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "purchase", F.col("value") > 30, F.col("event_id") % 5 == 0)
    return rows.select("event_id", F.size("run").cast("long").alias("n_run"), F.array_join(F.transform("run", lambda x: x.cast("string")), " ").alias("run"))


@query("""WITH k AS (SELECT n_nationkey AS id, n_name AS text FROM nation UNION ALL SELECT 100 + n_nationkey, n_name || ' x' FROM nation WHERE n_nationkey % 2 = 0),
c AS (SELECT n_nationkey AS k, unnest([n_name, n_name || ' x', n_name || ' x y']) AS text, unnest([1, 2, 3]) AS n FROM nation)
SELECT k, n, id FROM (SELECT c.k, c.n, k.id, row_number() OVER (PARTITION BY c.k ORDER BY n DESC, id) AS r FROM c JOIN k USING (text)) WHERE r = 1""")
def longest_prefix(spark, sf_dir):
    """The longest known prefix of a run of texts."""
    n = t(spark, sf_dir, "nation")
    known = n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("text")).union(n.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey") + 100, F.concat("n_name", F.lit(" x"))))
    return ordered.longest_prefix(n.select(F.col("n_nationkey").alias("k"), F.array("n_name", F.lit("x"), F.lit("y")).alias("parts")), known, ["k"], "parts", "text")


@query(f"""WITH RECURSIVE i AS (SELECT row_number() OVER (ORDER BY item_id, text) - 1 AS pos, text AS q FROM benchmark),
f AS (SELECT doc_id, text, -1::BIGINT AS pos, 1::BIGINT AS cur, 0::BIGINT AS hit, 0::BIGINT AS n FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, text, pos, CASE WHEN hit > 0 THEN hit + greatest(1, n // 2) ELSE cur END AS cur, hit, n FROM (
    SELECT f.doc_id, f.text, i.pos, f.cur, length(q) AS n, CASE WHEN coalesce(q, '') = '' THEN 0 WHEN contains(substr(f.text, f.cur), q) THEN instr(substr(f.text, f.cur), q) + f.cur - 1
      WHEN length(q) > {align.PREFIX} AND contains(substr(f.text, f.cur), left(q, {align.PREFIX})) THEN instr(substr(f.text, f.cur), left(q, {align.PREFIX})) + f.cur - 1 ELSE 0 END AS hit
    FROM f JOIN i ON i.pos = f.pos + 1))
SELECT doc_id, pos::INT AS pos, (hit - 1)::INT AS start, n::INT AS match_length FROM f WHERE hit > 0""")
def forward_match(spark, sf_dir):
    """Whole benchmark items sought in order in each document; the list of items is read in parts of bounded size."""
    items = (r["text"] for r in t(spark, sf_dir, "benchmark").select("item_id", "text").orderBy("item_id", "text").toLocalIterator())
    return align.forward_match_all(t(spark, sf_dir, "documents").select("doc_id", "text"), "text", items)


_READY = f"""replace(regexp_replace(regexp_replace(replace(replace({MIXED_SCRIPT_SQL}, ' ', '-'), '.', '’'), '({HYPHEN_CLASS})-({HYPHEN_CLASS})', '\\1\\2', 'g'), '({HYPHEN_CLASS})-({HYPHEN_CLASS})', '\\1\\2', 'g'), '’', '''')"""


@query(f"""SELECT doc_id, d AS first, CASE WHEN doc_id % 4 = 0 THEN '।' || d WHEN doc_id % 4 = 1 THEN ' ' || d ELSE d END AS second, doc_id % 4 > 0 AS agree, d AS chosen FROM (SELECT doc_id, {dev_sql(_READY)} AS d FROM documents)""")
def translit_cross_check(spark, sf_dir):
    """Both transliterations of prepared text, whether they agree, and the first, which is always chosen.

    The second is spoilt for two texts of four, by a sign and by outer white space, of which only the sign is a disagreement.
    """
    x = F.replace(F.replace(mixed_script_text(), F.lit(" "), F.lit("-")), F.lit("."), F.lit("’"))
    spoilt = lambda ready: F.concat(F.when(F.col("doc_id") % 4 == 0, "।").when(F.col("doc_id") % 4 == 1, " ").otherwise(""), translit.iast_by_scan(ready))
    return t(spark, sf_dir, "documents").select("doc_id", translit.cross_checked(x, spoilt).alias("c")).select("doc_id", "c.first", "c.second", "c.agree", "c.chosen")
