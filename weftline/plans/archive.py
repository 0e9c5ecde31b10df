"""Registered queries of sources, sinks, paragraphs, the citation graph and resumable runs.

Formats that the driver's tables lack are written first, from the tables, into the shared folder, and
read back by the readers under test; the oracle has what must come back.  Docstrings name the survey's
operators that a query's plan runs.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import charmodel, translit
from weftline.functions import text as X
from weftline.operators import align, graph, ordered, relational
from weftline.plans.catalogue import HEADED, LINES, MIXED_SQL, ORACLE_SQL, QUERIES, apart_lines, citation_lines, dev_sql, doc_lines, headed_lines, query, t
from weftline.scratch import Scratch
from weftline.sources import files, formats, html, ocr, robots, stores
from weftline.streaming import incremental

__all__ = ["ORACLE_SQL", "QUERIES"]


def folder(spark, name: str) -> str:
    return Scratch(spark, "query").path(name)


# --- sources ---------------------------------------------------------------------------------------


@query("""SELECT 'nation-' || n_nationkey AS entry_id, n_name AS devanagari, 'Chapter ' || n_nationkey AS iast, r_name AS work, lower(r_name) AS slug, n_nationkey::DOUBLE AS sequence,
  '## ' || n_name || chr(10) || '---' || chr(10) || 'body of "' || n_name || '"' || chr(10) AS body FROM nation JOIN region ON n_regionkey = r_regionkey""")
def entry_files(spark, sf_dir):
    """Entries with a templated header, a file each, read back and validated."""
    n = t(spark, sf_dir, "nation").join(t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.concat(F.lit("## "), "n_name", F.lit('\n---\nbody of "'), "n_name", F.lit('"\n'))
    head = [("title.devanagari", files.quoted(F.col("n_name"))), ("title.iast", F.concat(F.lit("Chapter "), "n_nationkey")), ("work.devanagari", files.quoted(F.col("r_name")))]
    head += [("workSlug", files.quoted(F.lower("r_name"))), ("sequence", F.col("n_nationkey").cast("string")), ("availableScripts", F.lit('["devanagari", "iast"]'))]
    root = folder(spark, "entries")
    stores.write_files(n.select(F.concat(F.lit("nation-"), "n_nationkey", F.lit(".md")).alias("name"), files.with_header(body, head).alias("content")), root, "name", "content")
    return files.read_entries(spark, root).select("entry_id", F.col("title.devanagari").alias("devanagari"), F.col("title.iast").alias("iast"), F.col("work.devanagari").alias("work"), F.col("workSlug").alias("slug"), "sequence", "body")


@query("SELECT doc_id, text AS body FROM documents")
def bodies(spark, sf_dir):
    """A3: texts behind a header, put before two of three."""
    x = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("---\nid: 1\nlang: x\n---\n"), "text")).otherwise(F.col("text"))
    return t(spark, sf_dir, "documents").select("doc_id", X.without_frontmatter(x).alias("body"))


_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _docx(word: str) -> bytes:
    """A small word-processor file with everything that the walk must order."""
    p = lambda *runs: "<w:p>" + "".join(f"<w:r><w:rPr>{'<w:b/>' if i else ''}</w:rPr><w:t>{x}</w:t></w:r>" for i, x in enumerate(runs)) + "</w:p>"
    table = lambda *inner: "<w:tbl><w:tr>" + "".join(f"<w:tc>{x}</w:tc>" for x in inner) + "</w:tr></w:tbl>"
    refs = '<w:sectPr><w:headerReference w:type="default" r:id="r2"/><w:footerReference w:type="first" r:id="r10"/></w:sectPr>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {_NS}><w:body>{p(word, '-one')}{table(p('cell'), table(p('inner')) + p('after'))}{p('two')}{refs}</w:body></w:document>")
        z.writestr("word/_rels/document.xml.rels", '<Relationships><Relationship Id="r2" Target="header2.xml"/><Relationship Id="r10" Target="footer10.xml"/></Relationships>')
        z.writestr("word/header2.xml", f"<w:hdr {_NS}>{p('head')}{table(p('head cell'))}</w:hdr>")
        z.writestr("word/footer10.xml", f"<w:ftr {_NS}>{p('foot')}</w:ftr>")
        z.writestr("word/footnotes.xml", f"<w:footnotes {_NS}><w:footnote w:type='separator'>{p('no')}</w:footnote><w:footnote>{p('note')}</w:footnote></w:footnotes>")
    return out.getvalue()


@query("""SELECT r_name AS name, i::INT AS para_idx, part, text, n::INT AS n_runs FROM region, (VALUES (0, 'body', '-one', 2), (1, 'body', 'two', 1), (2, 'table', 'cell', 1), (3, 'table', 'after', 1), (4, 'table', 'inner', 1),
  (5, 'header', 'head', 1), (6, 'header', 'head cell', 1), (7, 'footer', '', 0), (8, 'header', '', 0), (9, 'footer', 'foot', 1), (10, 'header', '', 0), (11, 'footer', '', 0), (12, 'footnote', 'note', 1)) v(i, part, w, n),
  LATERAL (SELECT CASE WHEN i = 0 THEN r_name || w ELSE w END AS text)""")
def document_walk(spark, sf_dir):
    """Paragraphs of word-processor files in their fixed order, with the whole text of their runs."""
    root = folder(spark, "docx")
    rows = [(f"{r.r_name}.docx", bytearray(_docx(r.r_name))) for r in t(spark, sf_dir, "region").collect()]
    stores.write_files(spark.createDataFrame(rows, "name string, content binary"), root, "name", "content")
    rows = files.read_docx(spark, root)
    return rows.select(F.regexp_extract("path", r"([^/]+)\.docx$", 1).alias("name"), "para_idx", "part", X.full_text(F.col("runs")).alias("text"), F.size("runs").alias("n_runs"))


@query("SELECT r_name AS name, 13::BIGINT AS n FROM region")
def paragraph_counts(spark, sf_dir):
    """Paragraphs of each file."""
    return document_walk(spark, sf_dir).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id::INT AS page, html AS raw_text FROM pages WHERE page_id BETWEEN 10 AND 60")
def page_records(spark, sf_dir):
    """A JSON file per page, and a range of pages of them read back, sorted."""
    p = t(spark, sf_dir, "pages").select(F.format_string("page_%04d.json", "page_id").alias("name"), F.to_json(F.struct(F.col("page_id").alias("page"), F.col("html").alias("raw_text"))).alias("content"))
    root = folder(spark, "pages")
    stores.write_files(p, root, "name", "content")
    return files.read_pages(spark, root, pages=(10, 60)).select("page", "raw_text").orderBy("page")


@query("""SELECT 1 AS book, (conv_id % 7)::INT AS chapter, turn::INT AS verse_number, text AS original_text, 'u/' || conv_id AS source_url FROM conversations WHERE conv_id % 3 = 1 AND trim(text) <> ''""")
def verse_records(spark, sf_dir):
    """Verse records from CSV with line feeds and quotes in them, one book."""
    rows = t(spark, sf_dir, "conversations").filter(F.trim("text") != "").select((F.col("conv_id") % 3).alias("book"), (F.col("conv_id") % 7).alias("chapter"), F.col("turn").alias("verse_number"), F.concat(F.lit('"'), "text", F.lit('"\n"')).alias("original_text"), F.concat(F.lit("u/"), "conv_id").alias("source_url"))
    root = folder(spark, "verses")
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(root)
    got = files.read_verses(spark, root, 1)
    return got.withColumn("original_text", F.expr("substring(original_text, 2, length(original_text) - 4)"))


@query("""SELECT 's' || s_suppkey AS name, n::INT AS line_no, CASE n WHEN 2 THEN chr(92) || 'start ' || s_name ELSE 'line ' || s_suppkey END AS line FROM supplier, (VALUES (2), (3)) v(n)""")
def source_slices(spark, sf_dir):
    """Lines of text files from the start marker up to the end marker."""
    x = F.concat(F.lit("skip\n\\start "), "s_name", F.lit("\nline "), "s_suppkey", F.lit("\n\\end\nrest"))
    root = folder(spark, "itx")
    stores.write_files(t(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey", F.lit(".itx")).alias("name"), x.alias("content")), root, "name", "content")
    return files.read_slices(spark, root, "\\start", "\\end").select(F.regexp_extract("path", r"([^/]+)\.itx$", 1).alias("name"), "line_no", "line")


@query("SELECT page_id, 'bracketed' AS ocr_engine, replace(html, '<', '[') AS raw_text FROM pages")
def recognized_pages(spark, sf_dir):
    """Page images, here bytes of text, through an engine by name."""
    ocr.register("bracketed", lambda: lambda image, lang: image.decode("utf-8").replace("<", "["))
    pages = t(spark, sf_dir, "pages").withColumn("image", F.col("html").cast("binary"))
    return ocr.recognized(pages, "page_id", "image", "bracketed", "san")


def _hub(spark, sf_dir) -> DataFrame:
    page = F.concat(F.lit('<a href="../toc/'), "page_id", F.lit('.html"><b>Book '), F.col("page_id") % 9, F.lit("</b> - x</a><a href='//other.org/v?a=1&amp;b=2'>Verse  "), "page_id", F.lit(".2.3</a><a href=v.html>Verse 4."), "page_id", F.lit("</a><a href=x>Introduction</a>"))
    return html.links(t(spark, sf_dir, "pages").withColumn("html", page), ["page_id"], "html")


@query("SELECT page_id, page_id % 9 AS book, 'https://hub.org/toc/' || page_id || '.html' AS url FROM pages")
def hub_books(spark, sf_dir):
    """Links that name books, with full addresses, by number; a label's pieces lose their outer blanks."""
    rows = _hub(spark, sf_dir).withColumn("label", F.regexp_replace("label", "^Book ?([0-9]+)-", "Book $1 -"))
    return html.books(rows, F.lit("https://hub.org/a/index.html")).select("page_id", "book", "url").orderBy("book", "page_id")


@query("""SELECT page_id, page_id AS book, 2::BIGINT AS chapter, 3::BIGINT AS verse, 'https://other.org/v?a=1&b=2' AS url FROM pages
UNION ALL SELECT page_id, 8, 4, page_id, 'https://hub.org/a/v.html' FROM pages""")
def hub_verses(spark, sf_dir):
    """Links that name verses, in the long form and in the short one, which takes its book from the context."""
    return html.verses(_hub(spark, sf_dir), F.lit(8).cast("long"), F.lit("https://hub.org/a/index.html")).select("page_id", "book", "chapter", "verse", "url")


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE 'a ' || page_id || chr(10) || 'b & c' END AS text,
  CASE page_id % 5 WHEN 0 THEN 'no <blockquote> found (structure mismatch)' WHEN 1 THEN 'blockquote present but empty' WHEN 2 THEN 'blockquote found but no ''English translation'' label nearby -- verify structure' END AS reason FROM pages""")
def verse_quotes(spark, sf_dir):
    """The first block quote of a page's content, with reasons for review."""
    quote = F.concat(F.lit("<blockquote class=q><p> a "), "page_id", F.lit("<br></p><i>b &amp; c</i></blockquote><blockquote>later</blockquote>"))
    inner = F.when(F.col("page_id") % 5 == 0, "<p>none").when(F.col("page_id") % 5 == 1, "<blockquote> <br> </blockquote>").otherwise(quote)
    label = F.when(F.col("page_id") % 5 == 2, "").otherwise("<h4>english Translation:</h4>")
    whole = F.concat(F.lit("<blockquote>outside</blockquote><div><div id='scontent'>"), inner, label, F.lit("</div></div><p>English translation"))
    # A page without the content element is looked at as a whole.
    page = F.when(F.col("page_id") % 5 == 4, F.concat(inner, F.lit("<p>ENGLISH TRANSLATION"))).otherwise(whole)
    return t(spark, sf_dir, "pages").select("page_id", html.quoted_verses(page).alias("q")).select("page_id", "q.text", "q.reason")


@query("SELECT url, CASE WHEN page_id % 4 = 0 THEN 'page fetch failed' END AS reason FROM pages")
def fetch_review(spark, sf_dir):
    """Pages of an ingest table; those that could not be fetched become review rows."""
    got, failed = html.fetched(t(spark, sf_dir, "pages").withColumn("html", F.when(F.col("page_id") % 4 > 0, F.col("html"))), "url", "html")
    return got.select("url", F.lit(None).cast("string").alias("reason")).unionByName(failed)


@query("""SELECT user_id, event_id, coalesce(lead(event_id) OVER w, 1000000) AS range_end FROM events WHERE event_type = 'purchase' WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def closed_ranges(spark, sf_dir):
    """Ranges that end where the next begins, the last where a closing page says."""
    rows = t(spark, sf_dir, "events").filter(F.col("event_type") == "purchase").select("user_id", "event_id")
    return ordered.next_start(rows, ["user_id"], ["event_id"], "event_id", close=F.lit(1_000_000).cast("long"))


# --- sinks -----------------------------------------------------------------------------------------


@query("SELECT url, 'a' AS reason FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT url, 'b' FROM pages WHERE page_id % 3 = 0")
def review_log(spark, sf_dir):
    """Review rows appended as CSV by two runs that have some and one that has none."""
    p, root = t(spark, sf_dir, "pages"), folder(spark, "review")
    for part, reason in ((p.filter("page_id % 2 = 0"), "a"), (p.limit(0), "none"), (p.filter("page_id % 3 = 0"), "b")):
        files.append_log(part.select("url", F.lit(reason).alias("reason")), root)
    return spark.read.option("header", True).csv(root)


@query("SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 2 = 1")
def accumulated(spark, sf_dir):
    """Records of an earlier run, written as JSON, and new ones."""
    o, root = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s")), folder(spark, "prior")
    o.filter("k % 2 = 0").write.json(root)
    return relational.append_new(spark.read.schema("k long, s string").json(root), o.filter("k % 2 = 1").withColumn("s", F.lit("new")))


@query("""WITH a AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'sutra' WHEN role = 'assistant' OR turn % 3 = 1 THEN 'quoted' ELSE 'plain' END AS kind, trim(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS text FROM conversations),
b AS (SELECT *, CASE WHEN kind = 'quoted' THEN turn - row_number() OVER (PARTITION BY conv_id, kind ORDER BY turn) ELSE turn + 1000000 END AS g FROM a),
c AS (SELECT conv_id, kind, g, min(turn) AS i, string_agg(text, '  ' || chr(10) || '> ' ORDER BY turn) AS x FROM b GROUP BY ALL)
SELECT conv_id, string_agg(CASE kind WHEN 'quoted' THEN '> ' || x WHEN 'sutra' THEN '<p class="sutra">' || x || '</p>' ELSE x END, chr(10) || chr(10) ORDER BY i) AS markdown FROM c GROUP BY conv_id""")
def rendered_parts(spark, sf_dir):
    """Parts as Markdown: runs of quoted ones one block quote, marked verses, at most one empty line."""
    kind = F.when(F.col("turn") % 5 == 4, "sutra").when((F.col("role") == "assistant") | (F.col("turn") % 3 == 1), "quoted").otherwise("plain")
    plain = F.trim(F.translate("text", "\n\r", "  "))
    text = F.when(kind == "sutra", F.concat(F.lit("॥ "), plain)).otherwise(plain)
    return files.rendered(t(spark, sf_dir, "conversations").withColumns({"kind": kind, "text": text}), ["conv_id"], "turn", "kind", "text")


@query("SELECT conv_id, string_agg(role || turn, chr(10) || chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id")
def chapter_texts(spark, sf_dir):
    """One text per key in a file, parts in order, read back with the key of its name."""
    root = folder(spark, "chapters")
    few = t(spark, sf_dir, "conversations").withColumn("part", F.concat("role", "turn"))
    files.write_chapters(few, ["conv_id"], "turn", "part", root)
    return files.read_chapters(spark, root, ["conv_id"]).withColumn("conv_id", F.col("conv_id").cast("long"))


MAP_SQL = "m AS (SELECT concat_ws('.', p_size % 4 + 1, p_partkey % 4 + 1, p_partkey % 60) AS sutra_id, 'govinda-bhashya-adhyaya-' || (p_size % 4 + 1) AS file, p_partkey % 60 AS section, 'x (' || (p_partkey % 60) || ')' AS heading FROM part WHERE p_partkey % 7 < 5 GROUP BY ALL)"


def sutra_map(spark, sf_dir) -> DataFrame:
    """A map of verses to sections, from parts."""
    p, size = F.col("p_partkey"), F.col("p_size")
    rows = t(spark, sf_dir, "part").filter(p % 7 < 5)
    return rows.select(F.concat_ws(".", size % 4 + 1, p % 4 + 1, p % 60).alias("sutra_id"), F.concat(F.lit("govinda-bhashya-adhyaya-"), size % 4 + 1).alias("file"), (p % 60).alias("section"), F.concat(F.lit("x ("), p % 60, F.lit(")")).alias("heading")).distinct()


@query(f"WITH {MAP_SQL} SELECT *, 'json' AS kind FROM m UNION ALL SELECT *, 'tsv' FROM m")
def map_files(spark, sf_dir):
    """A map written as JSON lines and as tab-separated values, both read back."""
    rows, a, b = sutra_map(spark, sf_dir), folder(spark, "map-json"), folder(spark, "map-tsv")
    files.write_map(rows, a)
    files.write_map(rows, b, tsv=True)
    schema = "sutra_id string, file string, section long, heading string"
    back = spark.read.schema(schema).json(a).withColumn("kind", F.lit("json"))
    return back.unionByName(spark.read.schema(schema).option("sep", "\t").csv(b).withColumn("kind", F.lit("tsv")))


@query("""SELECT s_suppkey, to_json({'id': 's:' || s_suppkey, 'label': s_name, 'n': s_nationkey})::VARCHAR AS node FROM supplier""")
def graph_json(spark, sf_dir):
    """Nodes as JSON text."""
    return t(spark, sf_dir, "supplier").select("s_suppkey", files.as_json(F.concat(F.lit("s:"), "s_suppkey").alias("id"), F.col("s_name").alias("label"), F.col("s_nationkey").alias("n")).alias("node"))


@query("SELECT 'granthas/' || lower(p_brand) || '/' || p_partkey AS route FROM part UNION ALL SELECT DISTINCT 'granthas/' || lower(p_brand) FROM part")
def page_routes(spark, sf_dir):
    """Addresses of entries and works."""
    return graph.routes(t(spark, sf_dir, "part").withColumn("work", F.lower("p_brand")), "work", "p_partkey")


@query("""SELECT stage, count(*)::BIGINT AS files FROM (SELECT 'raw' AS stage FROM pages UNION ALL SELECT 'clean' FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT 'checked' FROM pages WHERE page_id % 4 = 0) GROUP BY stage""")
def stage_counts(spark, sf_dir):
    """Files of each stage."""
    p = t(spark, sf_dir, "pages")
    stages = [p.filter(F.col("page_id") % n == 0).select(F.lit(s).alias("stage")) for s, n in (("raw", 1), ("clean", 2), ("checked", 4))]
    return stages[0].union(stages[1]).union(stages[2]).groupBy("stage").agg(F.count(F.lit(1)).alias("files"))


# --- paragraphs and their runs ---------------------------------------------------------------------

RUNS_SQL = "r AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN ' ' ELSE role END AS text, turn % 3 > 0 AS bold, CASE WHEN turn % 5 = 4 THEN 'FF0000' END AS color FROM conversations)"


def run_arrays(spark, sf_dir) -> DataFrame:
    """Conversations as paragraphs: (conv_id, runs)."""
    turn = F.col("turn")
    run = F.struct(
        turn.alias("turn"), F.when(turn % 4 == 3, " ").otherwise(F.col("role")).alias("text"), (turn % 3 > 0).alias("bold"), F.lit(None).cast("boolean").alias("italic"), F.lit(None).cast("boolean").alias("underline"),
        F.lit(None).cast("double").alias("size"), F.lit(None).cast("string").alias("font"), F.when(turn % 5 == 4, "FF0000").alias("color"),
    )
    rows = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    return rows.withColumn("runs", F.transform("runs", lambda r: r.dropFields("turn")))


@query(f"""WITH {RUNS_SQL} SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text, count(DISTINCT (bold, coalesce(color, ''))) AS n_formats, count(*) > 1 AND count(DISTINCT (bold, coalesce(color, ''))) > 1 AS mixed,
  coalesce(bool_and(bold) FILTER (trim(text) <> ''), false) AS all_bold, 'new' AS new_text, arg_min(bold, turn) AS new_bold, 1 AS n_new FROM r GROUP BY conv_id""")
def run_formats(spark, sf_dir):
    """Text and formats of paragraphs, and paragraphs rewritten in their first format."""
    r = F.col("runs")
    new = files.rewritten(r, F.lit("new"))
    return run_arrays(spark, sf_dir).select(
        "conv_id", X.full_text(r).alias("text"), F.size(F.array_distinct(F.transform(r, X.format_signature))).cast("long").alias("n_formats"), X.has_mixed_formatting(r).alias("mixed"), X.fully_bold(r).alias("all_bold"),
        F.get(new, 0)["text"].alias("new_text"), F.get(new, 0)["bold"].alias("new_bold"), F.size(new).alias("n_new"),
    )


_STRONG, _WEAK = ("[" + ", ".join(f"'{w}'" for w in words) + "]" for words in (X.STRONG_ENGLISH, X.WEAK_ENGLISH))
SHARE_SQL = f"(SELECT CASE WHEN len(k) > 0 THEN len(list_filter(k, lambda x: list_contains(list_concat({_STRONG}, {_WEAK}), x))) / len(k)::DOUBLE ELSE 0 END FROM (SELECT list_filter(regexp_split_to_array(lower(line), '[^a-z]+'), lambda x: x <> '') AS k))"


@query(f"WITH {LINES} SELECT doc_id, idx, CASE WHEN {SHARE_SQL} >= 0.2 THEN 'en' ELSE 'sa' END AS lang FROM lines")
def line_languages(spark, sf_dir):
    """C2 with the default scorer: the language of lines."""
    return doc_lines(spark, sf_dir).select("doc_id", "idx", X.language(F.col("line")).alias("lang"))


_FIT = f"""regexp_matches(line, '[^\\s]') AND NOT regexp_matches(line, '[ऀ-ॿ]') AND (iast OR (regexp_matches(line, '[a-zA-Z]') AND {SHARE_SQL} < 0.2)) AND NOT mixed"""


@query(MIXED_SQL + f"SELECT doc_id, idx, CASE WHEN {_FIT} THEN {dev_sql('line')} END AS converted FROM m")
def gated_lines(spark, sf_dir):
    """Lines that are Sanskrit and not mixed, transliterated once per distinct line; the others are null."""
    rows = relational.convert_distinct(apart_lines(spark, sf_dir), "line", translit.gated(F.col("line"), False), "converted")
    return rows.select("doc_id", "idx", "converted")


@query(MIXED_SQL + f"""SELECT doc_id, idx FROM m WHERE idx >= 1 AND idx % 9 <> 4 AND (idx < 4 OR idx >= 6 AND idx < 30) AND {_FIT}""")
def kept_paragraphs(spark, sf_dir):
    """Lines in fixed ranges without empty ones and ornaments, Sanskrit and not mixed."""
    rows = apart_lines(spark, sf_dir).withColumn("line", F.when(F.col("idx") % 9 == 4, F.concat("line", F.lit(" o)0(o "))).otherwise(F.col("line")))
    rows = relational.within(rows, "idx", [(1, 4), (6, 30)]).filter(~X.is_separator(F.col("line")))
    return rows.filter(X.looks_like_sanskrit(F.col("line"), False) & ~X.has_mixed_language(F.col("line"), False)).select("doc_id", "idx")


@query("""SELECT p_partkey, CASE WHEN p_size % 25 BETWEEN 1 AND 20 THEN ['प्रथम', 'द्वितीय', 'तृतीय', 'चतुर्थ', 'पञ्चम', 'षष्ठ', 'सप्तम', 'अष्टम', 'नवम', 'दशम', 'एकादश', 'द्वादश', 'त्रयोदश', 'चतुर्दश', 'पञ्चदश', 'षोडश', 'सप्तदश', 'अष्टादश', 'एकोनविंश', 'विंश'][p_size % 25]
  ELSE translate((p_size % 25)::VARCHAR, '0123456789', '०१२३४५६७८९') END || 'ओ''ध्यायः' AS title FROM part""")
def ordinal_titles(spark, sf_dir):
    """Titles of chapters, ordinals up to twenty, from ITRANS."""
    return t(spark, sf_dir, "part").select("p_partkey", translit.itrans_to_devanagari(X.ordinal_chapter(F.col("p_size") % 25)).alias("title"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(text, 'â', 'ā'), 'Â', 'Ā'), '(?i)\bthe\b\s*[:.]', 'the:', 'g'), '(?i)\brpc\b', 'rāmapada caṭṭopādhyāya', 'g'), '(?i)\brc\b', 'rāmapada caṭṭopādhyāya', 'g') AS repaired
  FROM (SELECT doc_id, replace(replace(text, ' a ', ' RPC '), 'ê', 'â') AS text FROM documents)""")
def repaired_texts(spark, sf_dir):
    """C14: typing slips and abbreviations, put into the texts, set right; a full stop after one word is left to its own rule."""
    x = F.replace(F.replace("text", F.lit(" a "), F.lit(" RPC ")), F.lit("ê"), F.lit("â"))
    return t(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(translit.repaired(x), r"(?i)\bthe\b\s*[:.]", "the:").alias("repaired"))


@query(f"""WITH {LINES}, a AS (SELECT doc_id, idx, CASE idx % 5 WHEN 1 THEN ' 12 ' WHEN 2 THEN 'stavamala ' WHEN 3 THEN '१२' ELSE line END AS line FROM lines)
SELECT doc_id, string_agg(line, chr(10) ORDER BY idx) AS clean FROM a WHERE trim(line) <> 'stavamala' AND NOT regexp_full_match(trim(line), '[0-9]+') GROUP BY doc_id""")
def boilerplate_free(spark, sf_dir):
    """Headers and page numbers in ASCII digits dropped; other digits stay."""
    at = F.col("idx") % 5
    line = F.when(at == 1, " 12 ").when(at == 2, "stavamala ").when(at == 3, "१२").otherwise(F.col("line"))
    docs = doc_lines(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("l")))), lambda r: r["l"]), "\n").alias("text"))
    return docs.select("doc_id", X.without_boilerplate(F.col("text"), ("stavamala",)).alias("clean"))


@query(f"""WITH {LINES}, a AS (SELECT doc_id, idx, CASE idx % 6 WHEN 1 THEN 'Gitavali ' || idx WHEN 3 THEN '॥  ' WHEN 4 THEN 'इति ' || line || ' समाप्तम् ।' ELSE line END AS line FROM lines),
b AS (SELECT *, min(idx) FILTER (idx % 6 = 1) OVER (PARTITION BY doc_id) AS title FROM a)
SELECT doc_id, string_agg(line, chr(10) ORDER BY idx) AS clean FROM b WHERE idx % 6 NOT IN (3, 4) AND idx IS DISTINCT FROM title GROUP BY doc_id""")
def untitled_bodies(spark, sf_dir):
    """The first title line, all colophons and lone dandas dropped."""
    at = F.col("idx") % 6
    line = F.when(at == 1, F.concat(F.lit("Gitavali "), "idx")).when(at == 3, "॥  ").when(at == 4, F.concat(F.lit("इति "), "line", F.lit(" समाप्तम् ।"))).otherwise(F.col("line"))
    docs = doc_lines(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("l")))), lambda r: r["l"]), "\n").alias("text"))
    return docs.select("doc_id", X.without_title_and_colophon(F.col("text"), "Gitavali", r"^इति\s+.*समाप्तम्\s*।?\s*$").alias("clean"))


@query("SELECT conv_id, turn, trim(text) AS clean FROM conversations WHERE text NOT LIKE '%|%'")
def unnumbered_verses(spark, sf_dir):
    """Numbers between bars dropped."""
    rows = t(spark, sf_dir, "conversations").filter(~F.contains("text", F.lit("|")))
    return rows.select("conv_id", "turn", F.trim(X.without_verse_numbers(F.concat(F.lit("||  3||"), "text", F.lit("|| 12 |")))).alias("clean"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '?' WHEN starts_with(p_name, 'a') THEN 'alias' ELSE p_name END AS heading, p_name || ' b' AS label FROM part""")
def short_names(spark, sf_dir):
    """An alias for headings with a prefix, ``?`` for none, and labels without a trailing note."""
    heading = F.when(F.col("p_size") % 3 > 0, F.col("p_name"))
    return t(spark, sf_dir, "part").select("p_partkey", X.short_heading(heading, "a", "alias").alias("heading"), X.short_label(F.concat("p_name", F.lit(" b ("), "p_brand", F.lit(") (x)  "))).alias("label"))


@query("""SELECT n_nationkey, list_filter(['ASIA', 'AFRICA', 'A'], lambda x: contains(n_name || ' ' || r_name, x))[1] AS label FROM nation JOIN region ON n_regionkey = r_regionkey""")
def commentary_tabs(spark, sf_dir):
    """The first commentary whose label is part of a heading."""
    n = t(spark, sf_dir, "nation").join(F.broadcast(t(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    known = F.array(*[F.struct(F.lit(x).alias("label")) for x in ("ASIA", "AFRICA", "A")])
    return n.select("n_nationkey", X.first_label_in(F.concat_ws(" ", "n_name", "r_name"), known)["label"].alias("label"))


_KINDS_SQL = "CASE event_id % 7 WHEN 0 THEN 'label : none given' WHEN 1 THEN ' none given ' WHEN 2 THEN 'none given here' WHEN 3 THEN '[12a]' WHEN 4 THEN ' [1–2] ' WHEN 5 THEN '[x y]' ELSE event_type || ' || 12||' END"


@query(f"""WITH a AS (SELECT event_id, {_KINDS_SQL} AS x FROM events) SELECT event_id, regexp_full_match(x, '\\s*(?:[^:\\n]+:\\s*)?none given\\s*') AS placeholder, regexp_full_match(trim(x), '\\[[0-9A-Za-z–—-]+\\]') AS number, regexp_matches(x, '\\|\\|\\s*[0-9]+\\s*\\|\\|\\s*$') AS verse_end FROM a""")
def line_kinds(spark, sf_dir):
    """Placeholders, numbers in brackets and ends of verses."""
    k = F.col("event_id") % 7
    x = F.when(k == 0, "label : none given").when(k == 1, " none given ").when(k == 2, "none given here").when(k == 3, "[12a]").when(k == 4, " [1–2] ").when(k == 5, "[x y]").otherwise(F.concat("event_type", F.lit(" || 12||")))
    return t(spark, sf_dir, "events").select("event_id", X.is_placeholder(x, "none given").alias("placeholder"), X.is_bracket_number(x).alias("number"), X.is_verse_end(x).alias("verse_end"))


_EMOJI = "replace(text, 'e', 'e😀')"


@query(f"""WITH c AS (SELECT doc_id, {_EMOJI} AS text FROM documents), u AS (SELECT doc_id, text, string_split(left(text, 220), '') AS cs, length(text) + length(regexp_replace(text, '[^😀]', '', 'g')) AS units FROM c),
w AS (SELECT *, list_transform(cs, lambda x: CASE WHEN x = '😀' THEN 2 ELSE 1 END) AS ws FROM u),
k AS (SELECT *, len(list_filter(range(1, len(ws) + 1), lambda i: list_sum(ws[1:i]) <= 220)) AS n FROM w)
SELECT doc_id, CASE WHEN units <= 220 THEN text ELSE left(text, n) || '…' END AS shown FROM k""")
def unit_excerpts(spark, sf_dir):
    """Excerpts counted as a browser counts, with signs of two units in them."""
    return t(spark, sf_dir, "documents").select("doc_id", X.truncate_units(F.replace("text", F.lit("e"), F.lit("e😀")), 220).alias("shown"))


@query("""SELECT p_partkey, p_name || CASE WHEN p_size % 2 = 0 THEN ' — ' || p_type ELSE '' END || ', from ' || p_brand || ' by x, with commentaries by a, b.' AS entry,
  p_brand || ' (' || p_name || ')' || CASE WHEN p_size % 2 = 0 THEN ', "' || p_type || '"' ELSE '' END || ' by x — ' || p_size || ' section' || CASE WHEN p_size = 1 THEN '' ELSE 's' END || ' with historical commentaries.' AS work,
  CASE WHEN p_size % 2 = 0 THEN 'd.d/f.x.review_diffs.csv' ELSE '.f.review_diffs.csv' END AS path FROM part""")
def page_descriptions(spark, sf_dir):
    """What pages say of themselves, and names of files that go with another."""
    english = F.when(F.col("p_size") % 2 == 0, F.col("p_type"))
    path = F.when(F.col("p_size") % 2 == 0, "d.d/f.x.docx").otherwise(".f")
    return t(spark, sf_dir, "part").select(
        "p_partkey", X.entry_description(F.col("p_name"), english, F.col("p_brand"), F.lit("x"), F.array(F.lit("a"), F.lit("b"))).alias("entry"),
        X.work_description(F.col("p_brand"), F.col("p_name"), english, F.lit("x"), F.col("p_size")).alias("work"), X.beside(path, ".review_diffs.csv").alias("path"),
    )


@query(f"""WITH {LINES}, k AS (SELECT doc_id, unnest(regexp_split_to_array(lower(line), '[^a-z]+')) AS w FROM lines)
SELECT w AS word, count(*)::BIGINT AS n FROM k WHERE list_contains(list_concat({_STRONG}, {_WEAK}), w) GROUP BY w""")
def english_word_use(spark, sf_dir):
    """The words that speak for English, strong and weak ones in one set, counted in the texts."""
    tokens = t(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    return tokens.filter(F.array_contains(X.english_words(), F.col("word"))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- ordered operators -----------------------------------------------------------------------------


@query("""SELECT * FROM (SELECT o_custkey, o_orderkey, (o_orderkey % 5 + 1)::BIGINT AS declared, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS number FROM orders) WHERE declared <> number AND o_orderkey % 3 > 0""")
def declared_numbers(spark, sf_dir):
    """Entries whose declared number is not their place; entries that declare none are counted and not reported."""
    rows = t(spark, sf_dir, "orders").withColumn("declared", F.when(F.col("o_orderkey") % 3 > 0, (F.col("o_orderkey") % 5 + 1).cast("long")))
    return ordered.declared_mismatches(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "declared").select("o_custkey", "o_orderkey", "declared", "number")


@query("""WITH u AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber IN (2, 3) THEN 2 ELSE l_linenumber END AS unit, count(*) AS n_items FROM lineitem GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY unit) AS number FROM u)
SELECT k, unit::INT AS unit, n_items::BIGINT AS n_items, number, (CASE WHEN number = 1 THEN 1 ELSE 2 END)::INT AS block FROM n""")
def sutra_units(spark, sf_dir):
    """Lines two and three of an order are one unit; counts are checked against quotas; each unit has its block, none too many."""
    items = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"))
    groups = spark.createDataFrame([(2, 2), (3, 2)], "member int, first int")
    units = ordered.merged_units(items, ["k"], "line", groups, "member", "first")
    sizes = units.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    quotas = sizes.select("k", F.inline(F.array(F.struct(F.lit(1).alias("block"), F.lit(1).cast("long").alias("quota")), F.struct(F.lit(2).alias("block"), (F.col("n") - 1).alias("quota")))))
    checked = ordered.checked_counts(units, quotas, ["k"], "quota")
    return ordered.assign_quotas(checked, quotas, ["k"], "number", "block", "quota").select("k", "unit", "n_items", "number", "block")


HEADED_PLAIN = LINES + """, h AS (SELECT doc_id, idx, CASE WHEN idx % 12 = 8 THEN '##  ' WHEN idx % 12 = 10 THEN '##' || left(line, 5) WHEN idx % 6 = 2 THEN '##   ' || left(line, 12) || '  ' WHEN idx % 6 IN (0, 4) THEN '### ' || left(line, 8) ELSE line END AS line FROM lines),
s AS (SELECT *, starts_with(line, '## ') AND length(line) > 3 AS h2, starts_with(line, '### ') AND length(line) > 4 AS h3 FROM h),
g AS (SELECT *, sum(h2::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS sn FROM s), u AS (SELECT *, sum(h3::INT) OVER (PARTITION BY doc_id, sn ORDER BY idx) AS tn FROM g)"""


@query(f"""WITH {HEADED_PLAIN} SELECT doc_id, idx, (CASE WHEN sn > 0 THEN sn - 1 ELSE -1 END)::BIGINT AS section, (CASE WHEN sn > 0 AND tn > 0 THEN tn - 1 ELSE -1 END)::BIGINT AS sub,
last_value(CASE WHEN h2 THEN trim(substr(line, 3)) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx) AS heading FROM u""")
def plain_sections(spark, sf_dir):
    """Headings by the stricter rule, hashes, one blank and something."""
    rows = ordered.sections(headed_lines(spark, sf_dir), "doc_id", "idx", "line", plain=True).fillna(-1, ["section", "sub"])
    return rows.select("doc_id", "idx", "section", "sub", "heading")


_TREE = HEADED_PLAIN.replace("starts_with(line, '## ') AND length(line) > 3", "regexp_matches(line, '^##\\s')").replace("starts_with(line, '### ') AND length(line) > 4", "regexp_matches(line, '^###\\s')")


@query(f"WITH {_TREE} SELECT doc_id, (sn - 1)::BIGINT AS section, (CASE WHEN h3 THEN tn - 1 ELSE -1 END)::BIGINT AS sub, trim(ltrim(line, '#')) AS heading FROM u WHERE sn > 0 AND (h2 OR h3)")
def contents_rows(spark, sf_dir):
    """Tables of contents as trees, and their rows."""
    tree = ordered.contents(headed_lines(spark, sf_dir), "doc_id", "idx", "line")
    return ordered.contents_rows(tree, "doc_id").fillna(-1, ["sub"])


@query(f"""WITH {LINES}, a AS (SELECT doc_id, idx, CASE idx % 7 WHEN 3 THEN '## ' || left(line, 6) WHEN 5 THEN 'x <p class="sutra"> ' || left(line, 9) || ' </p> <p class="sutra">2</p>' ELSE line END AS line, idx % 7 = 3 AS h FROM lines),
b AS (SELECT *, sum(h::INT) OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS section, last_value(CASE WHEN h THEN trim(substr(line, 4)) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx) AS heading FROM a)
SELECT doc_id, idx, section::BIGINT AS section, heading, trim(regexp_extract(line, '<p class="sutra">(.*?)</p>', 1)) AS text FROM b WHERE idx % 7 = 5""")
def sutra_lines(spark, sf_dir):
    """Marked lines with the section that holds them."""
    at = F.col("idx") % 7
    line = F.when(at == 3, F.concat(F.lit("## "), F.substring("line", 1, 6))).when(at == 5, F.concat(F.lit('x <p class="sutra"> '), F.substring("line", 1, 9), F.lit(' </p> <p class="sutra">2</p>'))).otherwise(F.col("line"))
    return ordered.marked_lines(doc_lines(spark, sf_dir).withColumn("line", line), "doc_id", "idx", "line")


@query(f"""WITH {LINES}, a AS (SELECT doc_id, idx // 4 AS section, CASE idx % 5 WHEN 1 THEN '[12]' WHEN 2 THEN 'label: none given' ELSE line END AS line, idx % 5 IN (1, 2) AS skip FROM lines)
SELECT doc_id, section::BIGINT AS section, sum(CASE WHEN skip OR regexp_full_match(trim(line), '\\[[0-9A-Za-z–—-]+\\]') THEN 0 ELSE length(line) END)::BIGINT AS length FROM a GROUP BY ALL""")
def section_lengths(spark, sf_dir):
    """lengths of sections, markers and placeholders not counted."""
    at = F.col("idx") % 5
    line = F.when(at == 1, "[12]").when(at == 2, "label: none given").otherwise(F.col("line"))
    rows = doc_lines(spark, sf_dir).select("doc_id", F.floor(F.col("idx") / 4).alias("section"), line.alias("line"))
    counts = ~X.is_bracket_number(F.col("line")) & ~X.is_placeholder(F.col("line"), "none given")
    return align.range_lengths(rows, ["doc_id"], "section", "line", counts, F.length("line"))


# --- joins, sets, reports --------------------------------------------------------------------------


@query("""SELECT 0::BIGINT AS place, 0::BIGINT AS page, NULL::INT AS p_partkey, count(*)::BIGINT AS sought, count_if(p_size % 3 > 0)::BIGINT AS matched, count_if(p_size % 3 = 0)::BIGINT AS missing FROM part
UNION ALL SELECT k, (k - 1) // 20 + 1, p_partkey, NULL, NULL, NULL FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS k FROM part WHERE p_size % 3 = 0)""")
def match_summary(spark, sf_dir):
    """Matches counted in one row, place 0, and what was not found in rows, in order, twenty to a page."""
    rows = t(spark, sf_dir, "part").withColumn("found", F.col("p_size") % 3 > 0)
    none = F.lit(None).cast("long")
    counts = relational.match_counts(rows, "found").select(none.cast("int").alias("p_partkey"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("page"), "sought", "matched", "missing")
    pages = relational.report_pages(rows.filter(~F.col("found")).select("p_partkey"), ["p_partkey"])
    return counts.unionByName(pages.select("p_partkey", "place", "page", none.alias("sought"), none.alias("matched"), none.alias("missing")))


@query("SELECT p_partkey, p_name FROM part WHERE p_size % 3 > 0 ORDER BY p_partkey LIMIT 10")
def first_matches(spark, sf_dir):
    """H4: the first ten matches of a report."""
    return relational.first_rows(t(spark, sf_dir, "part").filter("p_size % 3 > 0").select("p_partkey", "p_name"), ["p_partkey"], 10)


@query("SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 3 = 0")
def matched_sections(spark, sf_dir):
    """Matches with the section of their number."""
    m = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("n"), "l_linenumber")
    s = t(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("n"), "o_custkey")
    return relational.matched_sections(m, s, "n").withColumnRenamed("n", "l_orderkey")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 2 = 0 INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def common_customers(spark, sf_dir):
    """Keys that two tables have."""
    o = t(spark, sf_dir, "orders")
    return relational.intersect(o.filter("o_orderkey % 2 = 0"), o.filter("o_totalprice > 200000"), ["o_custkey"])


@query("SELECT l_orderkey, count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R' GROUP BY 1")
def counts_without_work(spark, sf_dir):
    """A decision that leaves one work out."""
    return relational.without_value(t(spark, sf_dir, "lineitem"), "l_returnflag", "R").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part), w AS (SELECT p_brand, p_partkey, CASE p_size % 4 WHEN 3 THEN 0 WHEN 1 THEN 1 ELSE -1 END AS place, p_size FROM f WHERE n = 1)
SELECT p_brand, place::BIGINT AS place, row_number() OVER (PARTITION BY place ORDER BY p_size, p_brand) AS rank, row_number() OVER (ORDER BY place, p_size, p_brand) AS overall FROM w""")
def shelves(spark, sf_dir):
    """F16, H6: works on the shelves of their categories, in order, over all shelves and on each."""
    parts = t(spark, sf_dir, "part").withColumn("category", (F.col("p_size") % 4).cast("string"))
    works = ordered.by_category(parts, "p_brand", "category", ["p_size", "p_partkey"], ["3", "1"])
    return ordered.in_shelf_order(works, "p_size", "p_brand").select("p_brand", "place", "rank", "overall")


WORK_NAMES = ["तत्त्वसन्दर्भः", "भागवतसन्दर्भः", "गोविन्दभाष्यम्"]
# Some citations stand before the first heading, and some under a heading that has an alias.
GRAPH_SQL = MAP_SQL + f""", c AS (SELECT concat_ws('.', l_partkey % 4 + 1, l_suppkey % 4 + 1, l_partkey % 60) AS sutra_id, CASE WHEN l_suppkey % 2 = 0 THEN 'तत्त्वसन्दर्भः' ELSE 'भागवतसन्दर्भः' END AS work,
  CASE WHEN l_orderkey % 11 = 0 THEN '?' WHEN l_orderkey % 13 = 0 THEN '{graph.ALIAS[1]}' WHEN l_orderkey % 4 = 0 THEN 'plain ' || chr((97 + l_orderkey % 9)::INT) ELSE 'अनुच्छेदः ' || translate((l_orderkey % 30)::VARCHAR, '0123456789', '०१२३४५६७८९') END AS heading,
  CASE WHEN l_partkey % 3 = 0 THEN 'वे.सू.' ELSE 'ब्र.सू.' END || ' ' || translate(concat_ws('.', l_partkey % 4 + 1, l_suppkey % 4 + 1, l_partkey % 60), '0123456789', '०१२३४५६७८९') AS raw,
  'entry-' || (l_orderkey % 50) AS file, CASE WHEN l_orderkey % 11 = 0 THEN -1 ELSE l_orderkey % 30 END AS section, l_orderkey AS o, l_linenumber AS l FROM lineitem WHERE l_partkey % 5 <> 0),
e AS (SELECT sutra_id, work, heading, raw, 'x [' || raw || '] y' AS context, '/granthas/w' || CASE WHEN work = 'तत्त्वसन्दर्भः' THEN 0 ELSE 1 END || '/' || file || '/#section-' || section AS href, file, section, o, l, false AS mapped, 'a:' || work || '|' || heading AS id FROM c
  UNION ALL SELECT sutra_id, 'गोविन्दभाष्यम्', heading, '', '{graph.MAPPED_CONTEXT}', '/granthas/govinda-bhashya/' || file || '/#section-' || section, file, section, NULL, NULL, true, 'a:गोविन्दभाष्यम्|' || file || '|' || section FROM m WHERE sutra_id IN (SELECT sutra_id FROM c)),
p AS (SELECT id, work, mapped, sutra_id, min((o, l, file, section)) AS first, count(*) AS n FROM e GROUP BY id, work, mapped, sutra_id),
n AS (SELECT id, work, min(heading) AS heading, min(file) FILTER (mapped) AS sort_file, min(section) FILTER (mapped) AS sort_section, count(*) AS count, count(DISTINCT sutra_id) AS n_targets, arg_min(href, (coalesce(o, 0), coalesce(l, 0), file, section)) AS href FROM e GROUP BY id, work, mapped)"""


def citations_and_map(spark, sf_dir) -> DataFrame:
    """The citations of the graph, written once, as most queries read them more than once."""
    key = F.col("l_orderkey")
    heading = F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, F.concat(F.lit(graph.ALIAS[0]), F.lit(" x"))).when(key % 4 == 0, F.concat(F.lit("plain "), F.char(F.lit(97) + key % 9)))
    heading = heading.otherwise(F.concat(F.lit("अनुच्छेदः "), X.to_devanagari_digits(key % 30)))
    even = F.col("l_suppkey") % 2 == 0
    cites = graph.citations(citation_lines(spark, sf_dir)).select(
        "sutra_id", "cite", "line", F.when(even, WORK_NAMES[0]).otherwise(WORK_NAMES[1]).alias("work"), F.when(even, "w0").otherwise("w1").alias("slug"), heading.alias("heading"),
        F.concat(F.lit("entry-"), key % 50).alias("file"), F.when(key % 11 > 0, key % 30).alias("section"), F.struct("l_orderkey", "l_linenumber").alias("at"),
    )
    scratch = Scratch(spark, "graph")
    # Citations are read for their targets and for themselves, but made once.
    cited = scratch.write(graph.cited(cites), "cited")
    linked = scratch.write(graph.with_mapped(cited, sutra_map(spark, sf_dir), WORK_NAMES[2], "govinda-bhashya").filter("mapped"), "mapped")
    return cited.unionByName(linked)


_SECTION_ORDER = """list_position(['तत्त्वसन्दर्भः', 'भागवतसन्दर्भः', 'गोविन्दभाष्यम्'], work), sort_file NULLS FIRST, sort_section NULLS FIRST,
  CASE WHEN sort_file IS NULL THEN heading NOT LIKE 'अनुच्छेदः %' END NULLS FIRST, CASE WHEN sort_file IS NULL THEN TRY_CAST(translate(replace(heading, 'अनुच्छेदः ', ''), '०१२३४५६७८९', '0123456789') AS BIGINT) END NULLS FIRST, heading, id"""


@query(f"""WITH {GRAPH_SQL} SELECT id, work, heading, count::BIGINT AS count, n_targets::BIGINT AS n_targets, href,
  row_number() OVER (ORDER BY {_SECTION_ORDER}) AS overall, row_number() OVER (PARTITION BY work ORDER BY {_SECTION_ORDER}) AS rank FROM n""")
def graph_sections(spark, sf_dir):
    """Sections of citations, and of a map that makes no new targets, with the address of the first mention, in the order of the site, over all works and within each."""
    return graph.section_ranks(graph.section_nodes(citations_and_map(spark, sf_dir)), WORK_NAMES).select("id", "work", "heading", "count", "n_targets", "href", "overall", "rank")


@query(f"""WITH {GRAPH_SQL} SELECT id, string_agg(sutra_id, ' ' ORDER BY coalesce(first[1], 0), coalesce(first[2], 0), first[3], first[4], sutra_id) AS sutra_ids FROM p GROUP BY id""")
def section_targets(spark, sf_dir):
    """the targets of each section in order of first mention."""
    return graph.section_nodes(citations_and_map(spark, sf_dir)).select("id", F.array_join("sutra_ids", " ").alias("sutra_ids"))


@query(f"""WITH {GRAPH_SQL} SELECT sutra_id, row_number() OVER (PARTITION BY sutra_id ORDER BY mapped, o, l, file, section, href, raw) - 1 AS place, work, heading, raw, context, href FROM e""")
def citations_of_sutras(spark, sf_dir):
    """every citation of a target in order, with its text, its line and its address."""
    return graph.sutra_cites(citations_and_map(spark, sf_dir))


@query(f"""WITH {GRAPH_SQL} SELECT sutra_id, count(*) FILTER (NOT mapped)::BIGINT AS count, count(DISTINCT work) FILTER (NOT mapped)::BIGINT AS n_works, CASE WHEN count(DISTINCT work) FILTER (NOT mapped) > 1 THEN 'both' ELSE 'single' END AS kind,
  CASE WHEN count(*) FILTER (NOT mapped) > 1 THEN '×' || count(*) FILTER (NOT mapped) END AS label, bool_or(mapped) AS ring FROM e GROUP BY sutra_id""")
def sutra_classes(spark, sf_dir):
    """targets by how many works they are linked with, and their labels."""
    return graph.linked_with(citations_and_map(spark, sf_dir))


_ADJACENT = """x AS (SELECT 's:' || sutra_id AS s, id AS a, work AS w FROM e), g AS (SELECT DISTINCT kind, node, neighbour FROM (
  SELECT 'sutra-section' AS kind, s AS node, a AS neighbour FROM x UNION ALL SELECT 'sutra-work', s, w FROM x UNION ALL SELECT 'section-sutra', a, s FROM x UNION ALL SELECT 'section-work', a, w FROM x UNION ALL SELECT 'work-sutra', w, s FROM x UNION ALL SELECT 'work-section', w, a FROM x))"""


@query(f"""WITH {GRAPH_SQL}, {_ADJACENT}, d AS (SELECT kind, node, count(*) AS degree FROM g GROUP BY kind, node)
SELECT kind, node, (sum(degree) OVER (ORDER BY kind, node) - degree)::BIGINT AS "offset", degree FROM d""")
def graph_offsets(spark, sf_dir):
    """Compressed adjacency of sutras, sections and works in all directions: where a node's neighbours begin and how many they are."""
    return graph.compressed(graph.graph_edges(citations_and_map(spark, sf_dir)))[0]


@query(f"""WITH {GRAPH_SQL}, {_ADJACENT} SELECT row_number() OVER (ORDER BY kind, node, neighbour) - 1 AS place, kind, node, neighbour FROM g""")
def graph_neighbours(spark, sf_dir):
    """The neighbours that the offsets point to."""
    return graph.compressed(graph.graph_edges(citations_and_map(spark, sf_dir)))[1]


@query(f"""WITH {GRAPH_SQL} SELECT id, 'section' AS kind, to_json({{'id': id, 'work': work, 'heading': heading, 'count': count, 'href': href}})::VARCHAR AS json FROM n
UNION ALL SELECT 's:' || sutra_id, 'sutra', to_json({{'id': 's:' || sutra_id, 'label': translate(sutra_id, '0123456789', '०१२३४५६७८९'), 'class': CASE WHEN count(DISTINCT work) FILTER (NOT mapped) > 1 THEN 'both' ELSE 'single' END, 'count': count(*) FILTER (NOT mapped), 'ring': bool_or(mapped)}})::VARCHAR FROM e GROUP BY sutra_id
UNION ALL SELECT DISTINCT id || ' s:' || sutra_id, 'edge', to_json({{'from': id, 'to': 's:' || sutra_id}})::VARCHAR FROM e""")
def graph_document(spark, sf_dir):
    """The graph as lines of JSON, nodes with counts and first addresses, and edges."""
    return graph.graph_document(citations_and_map(spark, sf_dir))


# Margins, rows and gaps of the drawing.
TOP, SECTION_ROW, SECTION_GAP, SUTRA_ROW, SUTRA_GAP, BAND_HEAD = 64, 30, 26, 24, 30, 26


@query(f"""WITH {GRAPH_SQL}, s AS (SELECT id, row_number() OVER (ORDER BY {_SECTION_ORDER}) AS r, dense_rank() OVER (ORDER BY list_position(['तत्त्वसन्दर्भः', 'भागवतसन्दर्भः', 'गोविन्दभाष्यम्'], work)) AS g FROM n),
v AS (SELECT DISTINCT sutra_id, split_part(sutra_id, '.', 1)::INT AS a, split_part(sutra_id, '.', 2)::INT AS p, split_part(sutra_id, '.', 3)::INT AS z FROM e),
w AS (SELECT sutra_id, row_number() OVER (ORDER BY a, p, z) AS r, dense_rank() OVER (ORDER BY a) AS g FROM v)
SELECT id, ({TOP} + (r - 1) * {SECTION_ROW} + (g - 1) * {SECTION_GAP})::BIGINT AS y FROM s UNION ALL SELECT 's:' || sutra_id, ({TOP} + (r - 1) * {SUTRA_ROW} + (g - 1) * {SUTRA_GAP} + g * {BAND_HEAD})::BIGINT FROM w""")
def graph_layout(spark, sf_dir):
    """Places of sections and verses in their columns, with gaps between works and chapters."""
    cites = citations_and_map(spark, sf_dir)
    order = graph.section_order(WORK_NAMES)
    sections = graph.layout(graph.section_nodes(cites), order[:1], [*order[1:], "id"], TOP, SECTION_ROW, SECTION_GAP).select("id", "y")
    part = lambda k: F.split_part("sutra_id", F.lit("."), F.lit(k)).cast("int")
    verses = cites.select("sutra_id").distinct().withColumns({"adhyaya": part(1), "pada": part(2), "sutra": part(3)})
    return sections.unionByName(graph.layout(verses, ["adhyaya"], ["pada", "sutra"], TOP, SUTRA_ROW, SUTRA_GAP, BAND_HEAD).select(F.concat(F.lit("s:"), "sutra_id").alias("id"), "y"))


@query(f"WITH {GRAPH_SQL} SELECT DISTINCT sutra_id, split_part(sutra_id, '.', 1)::BIGINT AS adhyaya, split_part(sutra_id, '.', 2)::BIGINT AS pada, split_part(sutra_id, '.', 3)::BIGINT AS sutra FROM e")
def sutras_in_order(spark, sf_dir):
    """H1: verses of the graph sorted as numbers."""
    part = lambda k: F.split_part("sutra_id", F.lit("."), F.lit(k)).cast("long")
    return graph.in_sutra_order(citations_and_map(spark, sf_dir).select("sutra_id").distinct().withColumns({"adhyaya": part(1), "pada": part(2), "sutra": part(3)}))


@query(f"WITH {GRAPH_SQL}, d AS (SELECT DISTINCT sutra_id, work FROM e) SELECT sutra_id, string_agg(work, ' ' ORDER BY work) AS neighbours, count(*)::BIGINT AS n FROM d GROUP BY 1")
def works_of_sutras(spark, sf_dir):
    """The works that each verse is linked with."""
    return graph.adjacency(citations_and_map(spark, sf_dir), "sutra_id", "work")


# --- resumable runs --------------------------------------------------------------------------------


#: Files of a batch, and about how many batches each half of a large table makes.
BATCH_FILES, BATCHES = 16, 6


class Stopped(Exception):
    """A run that was stopped inside a batch."""


def interrupted(spark, rows: DataFrame, order: list[str], name: str, transform, kind=None, every: int = 2_000) -> incremental.Run:
    """A run over rows in order that is stopped inside its second batch, goes on, is given more rows, and has nothing left at last.

    Files are larger where rows are more, and a batch is a share of them, so batches, each with its own commit and its
    own look at the folder, stay the same in number.
    """
    source, run = folder(spark, f"{name}-in"), incremental.Run(spark, folder(spark, name))
    half = F.col(order[0]) % 2 == 0
    every = max(every, -(-rows.count() // (BATCHES * BATCH_FILES * 2)))
    incremental.stage_rows(rows.filter(half), order, source, every)
    schema, seen = spark.read.parquet(source).schema, []

    def stops(batch: DataFrame) -> DataFrame:
        seen.append(1)
        if len(seen) == 2:
            raise Stopped
        return transform(batch)

    try:
        run.resume(source, schema, stops, kind)
    except Exception as e:
        if "Stopped" not in str(e):
            raise
    run.resume(source, schema, transform, kind, files_per_batch=BATCH_FILES)
    incremental.stage_rows(rows.filter(~half), order, source, every)
    run.resume(source, schema, transform, kind, files_per_batch=BATCH_FILES)
    if run.resume(source, schema, transform, kind):
        raise ValueError("a finished run has nothing left")
    return run


@query("SELECT event_id, user_id * 2 AS twice FROM events")
def resumed_run(spark, sf_dir):
    """K1, K4: a run that is stopped inside a batch and goes on from it; its rows, each once."""
    progress = incremental.Progress()
    spark.streams.addListener(progress)
    try:
        run = interrupted(spark, t(spark, sf_dir, "events").select("event_id", "user_id"), ["event_id"], "resumed", lambda b: b.select("event_id", (F.col("user_id") * 2).alias("twice")))
    finally:
        spark.streams.removeListener(progress)
    return run.rows("event_id long, twice long")


@query("SELECT event_type AS kind, count(*)::BIGINT AS n FROM events GROUP BY 1")
def running_totals(spark, sf_dir):
    """Counters per kind in a table, exact over a run that was stopped inside a batch."""
    return interrupted(spark, t(spark, sf_dir, "events").select("event_id", "event_type"), ["event_id"], "totals", lambda b: b.select("event_id", "event_type"), F.col("event_type")).totals()


@query(f"""WITH {LINES}, f AS (SELECT DISTINCT line FROM lines WHERE doc_id % 2 = 0)
SELECT doc_id, idx, {dev_sql('lines.line')} AS converted, CASE WHEN f.line IS NULL THEN 2 ELSE 1 END::BIGINT AS converted_run FROM lines LEFT JOIN f ON lines.line = f.line""")
def memoised_lines(spark, sf_dir):
    """K6: lines converted over two runs with one memo: the second converts only lines that the first has not met, and says so."""
    memo, rows = incremental.Memo(spark, folder(spark, "memo")), doc_lines(spark, sf_dir)
    memo.convert(rows.filter("doc_id % 2 = 0"), "line", translit.iast_to_devanagari, "converted", run=1)
    return memo.convert(rows, "line", translit.iast_to_devanagari, "converted", run=2)[0].select("doc_id", "idx", "converted", "converted_run")


# --- data sources, fetching and learnt scorers -----------------------------------------------------


@query("""SELECT 'nation-' || n_nationkey AS entry_id, n_name || ' "' || n_nationkey || '", #1 \\' AS devanagari, r_name AS work, lower(r_name) AS slug, n_nationkey::DOUBLE AS sequence, ['a, b', 'c'] AS scripts,
  '# ' || n_name AS body FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'AFRICA')""")
def entry_source(spark, sf_dir):
    """Entries as a data source, with quotes, backslashes and commas in their headers, of two works by a filter that is pushed down."""
    n = t(spark, sf_dir, "nation").join(F.broadcast(t(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    title = F.concat("n_name", F.lit(' "'), "n_nationkey", F.lit('", #1 \\'))
    head = [("title.devanagari", files.quoted(title)), ("work.devanagari", F.concat("r_name", F.lit("  # a note"))), ("workSlug", F.concat(F.lit("'"), F.lower("r_name"), F.lit("'"))), ("sequence", F.col("n_nationkey").cast("string"))]
    head += [("availableScripts", F.lit('["a, b", c]')), ("commentaries", F.lit("[{id: x, label: 'it''s'}]"))]
    root = folder(spark, "entries")
    stores.write_files(n.select(F.concat(F.lit("nation-"), "n_nationkey", F.lit(".md")).alias("name"), files.with_header(F.concat(F.lit("# "), "n_name"), head).alias("content")), root, "name", "content")
    formats.register(spark)
    rows = spark.read.format("weft-entries").load(root).filter(F.col("workSlug").isin("asia", "africa"))
    return rows.select("entry_id", F.col("title.devanagari").alias("devanagari"), F.col("work.devanagari").alias("work"), F.col("workSlug").alias("slug"), "sequence", F.col("availableScripts").alias("scripts"), "body")


@query("""SELECT 's' || s_suppkey AS name, i::INT AS para_idx, part, CASE WHEN i = 0 THEN s_name ELSE w END AS text FROM supplier, (VALUES (0, 'body', ''), (2, 'table', 'cell'), (12, 'footnote', 'note')) v(i, part, w)""")
def document_parts(spark, sf_dir):
    """Word-processor files, one for each supplier, made by tasks, and some of their parts read as a data source that parses no other."""

    @F.pandas_udf("binary")
    def made(names: pd.Series) -> pd.Series:
        return names.map(_docx)

    root = folder(spark, "docx")
    # A file's rows are few bytes, so Spark reads them in few tasks; files are made in more.
    dealt = t(spark, sf_dir, "supplier").repartition(spark.sparkContext.defaultParallelism * 2, "s_suppkey")
    stores.write_files(dealt.select(F.concat(F.lit("s"), "s_suppkey", F.lit(".docx")).alias("name"), made(F.col("s_name")).alias("content")), root, "name", "content")
    formats.register(spark)
    rows = spark.read.format("weft-docx").load(root).filter(F.col("part").isin("body", "table", "footnote")).filter("para_idx IN (0, 2, 12)")
    return rows.select(F.regexp_extract("path", r"([^/]+)\.docx$", 1).alias("name"), "para_idx", "part", F.regexp_replace(X.full_text(F.col("runs")), "-one$", "").alias("text"))


_GATE_SQL = """p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1) END AS path FROM pages),
r AS (SELECT DISTINCT host, unnest(['disallow', 'allow', 'disallow']) AS rule, unnest([left(path, 2), left(path, 4), left(path, 6)]) AS path FROM p WHERE page_id % 4 = 0),
h AS (SELECT p.page_id, arg_max(r.rule = 'allow', length(r.path) * 2 + (r.rule = 'allow')::INT) AS allow FROM p JOIN r ON p.host = r.host AND starts_with(p.path, r.path) GROUP BY p.page_id)"""


@query(f"WITH {_GATE_SQL} SELECT page_id, host, coalesce(allow, true) AS allowed FROM p LEFT JOIN h USING (page_id)")
def fetch_gate(spark, sf_dir):
    """Pages that the rules of their hosts allow; the longest path that fits decides."""
    return robots.gate(t(spark, sf_dir, "pages"), host_rules(spark, sf_dir)).select("page_id", "host", "allowed")


def host_rules(spark, sf_dir) -> DataFrame:
    """Rules made from some pages' addresses: a refusal, a leave within it, and a refusal within that."""
    host, path = robots.host_and_path(F.col("url"))
    some = t(spark, sf_dir, "pages").filter("page_id % 4 = 0").select(host.alias("host"), path.alias("p"))
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.left("p", F.lit(n)).alias("path")) for rule, n in (("disallow", 2), ("allow", 4), ("disallow", 6))])
    return some.select("host", F.lit("*").alias("agent"), F.inline(rules)).distinct()


@query(f"WITH {_GATE_SQL}, a AS (SELECT page_id, host FROM p LEFT JOIN h USING (page_id) WHERE coalesce(allow, true)) SELECT page_id, host, ((row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) * 1.0)::DOUBLE AS at FROM a")
def fetch_schedule(spark, sf_dir):
    """Seconds at which allowed pages may be fetched, a second between two of a host (without the random part, which tests cover)."""
    return robots.schedule(robots.gate(t(spark, sf_dir, "pages"), host_rules(spark, sf_dir)), "page_id", jitter=0).select("page_id", "host", "at")


_LEARN_SQL = """WITH x AS (SELECT doc_id, lang, '  ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}]+', ' ', 'g')) || ' ' AS t FROM documents WHERE lang IN ('en', 'de')),
g AS (SELECT doc_id, lang, substr(t, unnest(range(1, length(t) - 1)), 3) AS gram FROM x WHERE length(t) > 3), n AS (SELECT lang, gram, count(*) AS n FROM g WHERE doc_id % 5 <> 0 GROUP BY ALL),
w AS (SELECT lang, left(gram, 2) AS two, sum(n) AS of FROM n GROUP BY ALL), v AS (SELECT count(DISTINCT substr(gram, 3, 1)) AS v FROM n),
c AS (SELECT l.lang, m.gram, -ln((coalesce(n.n, 0) + 0.1::DOUBLE) / (coalesce(w.of, 0) + 0.1::DOUBLE * v)) AS cost FROM (SELECT DISTINCT gram FROM n) m CROSS JOIN (SELECT DISTINCT lang FROM n) l CROSS JOIN v
  LEFT JOIN n ON n.lang = l.lang AND n.gram = m.gram LEFT JOIN w ON w.lang = l.lang AND w.two = left(m.gram, 2)),
s AS (SELECT g.doc_id, sum(c.cost) FILTER (c.lang = 'en') AS en, sum(c.cost) FILTER (c.lang = 'de') AS de FROM g JOIN c ON c.gram = g.gram GROUP BY g.doc_id)"""


def learnt(spark, sf_dir) -> DataFrame:
    docs = t(spark, sf_dir, "documents").filter(F.col("lang").isin("en", "de"))
    model = Scratch(spark, "languages").write(charmodel.train(docs.filter("doc_id % 5 <> 0"), "text", "lang"), "model")
    return charmodel.classified(docs, "doc_id", "text", model, "en", "de")


@query(_LEARN_SQL + " SELECT doc_id, CASE WHEN coalesce(en, 0) < coalesce(de, 0) THEN 'en' ELSE 'de' END AS lang FROM x LEFT JOIN s USING (doc_id)")
def learned_languages(spark, sf_dir):
    """C2 with learnt scorers: of two languages that of less cost, learnt from four fifths of the documents."""
    return learnt(spark, sf_dir)


@query(f"""WITH {HEADED}, f AS (SELECT doc_id, idx, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS i, trim(regexp_replace(line, '^##\\s+', '')) AS title, CASE WHEN idx % 6 = 2 THEN (doc_id + idx) % 40 END AS declared FROM s WHERE h2),
q AS (SELECT *, row_number() OVER (ORDER BY lpad(doc_id::VARCHAR, 9, '0'), i) AS number FROM f)
SELECT 'part-' || lpad(doc_id::VARCHAR, 9, '0') || '.md' AS file, number, 'part-' || lpad(doc_id::VARCHAR, 9, '0') || '.md: heading ''' || title || ''' declares अनुच्छेदः ' || declared || ' but positional count is ' || number AS warning
FROM q WHERE declared IS NOT NULL AND declared <> number""")
def section_warnings(spark, sf_dir):
    """Sections counted on over files in order, with a warning where a heading declares another number."""
    rows = ordered.sections(headed_lines(spark, sf_dir), "doc_id", "idx", "line").filter("is_h2")
    name = F.concat(F.lit("part-"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".md"))
    rows = rows.select(name.alias("file"), "idx", "heading", F.when(F.col("idx") % 6 == 2, (F.col("doc_id") + F.col("idx")) % 40).alias("declared"))
    return ordered.declared_warnings(rows, "file", ["idx"], "heading", "declared")


@query(f"""WITH {LINES}, a AS (SELECT doc_id, idx, line, idx % 5 = 3 AS s, sum((idx % 5 = 3)::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS g FROM lines),
b AS (SELECT doc_id, idx, dense_rank() OVER (PARTITION BY doc_id ORDER BY g) AS chunk FROM a WHERE NOT s) SELECT doc_id, idx, chunk, CASE WHEN chunk = 1 THEN 'पादः ' || doc_id END AS heading FROM b""")
def headed_chunks(spark, sf_dir):
    """Chunks between separators, the first of each with the heading of the whole."""
    rows = ordered.separator_chunks(doc_lines(spark, sf_dir), ["doc_id"], ["idx"], F.col("idx") % 5 == 3, heading=F.concat(F.lit("पादः "), F.col("doc_id")), first="heading")
    return rows.select("doc_id", "idx", "chunk", "heading")


@query()
def missing_content(spark, sf_dir):
    """Sections, of six lines each and of some documents without the last two, against their documents (tested against a loop)."""
    rows = doc_lines(spark, sf_dir).withColumn("line", translit.iast_to_devanagari(F.when(F.col("idx") % 8 == 7, "[12]").otherwise(F.col("line"))))
    rows = Scratch(spark, "missing").write(rows, "lines")
    at, some = F.col("idx") % 6, F.col("doc_id") % 3 == 0
    notes = F.array_sort(F.collect_list(F.when((at > 0) & ((at < 4) | ~some), F.struct("idx", "line"))))
    sections = rows.groupBy("doc_id", (F.floor(F.col("idx") / 6) + 1).alias("number")).agg(F.max(F.when(at == 0, F.col("line"))).alias("root"), F.transform(notes, lambda r: r["line"]).alias("notes"))
    return align.missing_content(rows, sections, "doc_id", "idx", "line", "number", "root", "notes", "न व्याख्यातम्")


@query(f"""WITH {GRAPH_SQL}, v AS (SELECT DISTINCT sutra_id, 'vedanta-sutra-graph/sutra/' || sutra_id || '/' AS route, split_part(sutra_id, '.', 1)::INT AS a, split_part(sutra_id, '.', 2)::INT AS p, split_part(sutra_id, '.', 3)::INT AS z FROM e)
SELECT sutra_id, route, lag(route) OVER (ORDER BY a, p, z) AS previous, lead(route) OVER (ORDER BY a, p, z) AS next FROM v""")
def verse_routes(spark, sf_dir):
    """A page for each verse of the graph, and those before and after it."""
    return graph.sutra_routes(citations_and_map(spark, sf_dir))


@query("SELECT doc_id, CASE WHEN length(text) > 600 THEN left(text, 600) || '...' ELSE text END AS shown FROM documents")
def review_excerpts(spark, sf_dir):
    """Texts for review, six hundred characters and three dots."""
    return t(spark, sf_dir, "documents").select("doc_id", X.truncate(F.col("text"), 600, "...").alias("shown"))
