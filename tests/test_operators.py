import json
import zipfile

import pytest
from pyspark.sql import functions as F

from weftline.functions import charmodel, translit
from weftline.functions import text as X
from weftline.operators import align, graph, ordered, qc, relational
from weftline.plans import catalogue
from weftline.sources import files, formats, html, ocr, robots, stores
from weftline.streaming import incremental


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(column(F.col("x"))).collect()]


def test_gates(spark):
    mixed = ["footnote body: nandīśvareśvara iti smṛtaḥ", "yogeśas prakaṭin he'no", "cit ātmā", "[page 6] ātmā", "[page 6] [ibid.] ātmā", "no marks the of and", "see ātmā", None]
    assert values(spark, mixed, X.has_mixed_language) == [True, False, False, False, True, False, True, False]
    apart = ["kṛṣṇa", "ñ only", "", None, "plain", "cafe\u0301 the of", "kr\u0323", "na\u0304da", "\u0301 alone"]
    assert values(spark, apart, X.looks_like_iast) == [True, False, False, False, False, False, True, True, True]
    assert values(spark, ["cafe\u0301 the of", "na\u0304da the of"], X.has_mixed_language) == [False, True]
    assert values(spark, ["kṛṣṇa", "कृष्ण ā", "12 34", " ", "nimittam api", "this is the text of the page", None], X.looks_like_sanskrit) == [True, False, False, False, True, False, False]


def test_composition_equals_the_standard(spark):
    import random
    import unicodedata

    r = random.Random(7)
    parts = ["e", "r", "a", "ṛ", "Ṃ", "n", "\u0301", "\u0304", "\u0323", "\u0325", "\u0303", "\u0338", "न", "\u093c", "\u094d", "ा", "\u1100", "\u1161", "\u11a8", "가", "\u2126", "\uf900", "é", "\u0340", " ", "\U0001d15e", "\u0cbf", "\u0cc6\u0cc2\u0cd5"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(3000)] + [chr(c) for c in range(0x300, 0x370)] + [None, "r\u0323\u0304", "r\u0304\u0323", "कृष्ण"]
    assert values(spark, texts, X.composed) == [None if x is None else unicodedata.normalize("NFC", x) for x in texts]
    # Every character that composition changes by itself is let through to it.
    changed = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    assert len(changed) > 1000 and all(values(spark, changed, lambda x: x.rlike(r"\p{M}") | x.rlike(X.APART)))


def test_transliteration(spark):
    pairs = {"कृष्ण rāma": "कृष्ण राम", "कa ओka": "कअ ओक", "|| 1 || kh": "॥ १ ॥ ख्", "aiauā": "ऐऔआ", "te'tisudhā": "तेऽतिसुधा", "śrīkṛṣṇa": "श्रीकृष्ण", "śrīlarūpasanātanau": "श्रीलरूपसनातनौ", "hds": "ह्द्स्", "aitareya | 12": "ऐतरेय । १२"}
    assert values(spark, list(pairs), translit.iast_to_devanagari) == list(pairs.values())
    assert values(spark, list(pairs), translit.iast_by_scan) == list(pairs.values())
    assert values(spark, ["śrī-kṛṣṇa te’ti", "a-1", "a - b"], lambda x: X.straight_quotes(X.join_hyphens(x))) == ["śrīkṛṣṇa te'ti", "a-1", "a - b"]
    got = spark.createDataFrame([("śrī-kṛṣṇa",), (None,)], "x string").select(translit.cross_checked(F.col("x")).alias("c")).collect()
    assert got[0].c.chosen == "श्रीकृष्ण" and got[0].c.agree
    assert values(spark, ["shrIkR^iShNa", "namaH", "om .n"], translit.itrans_to_devanagari) == ["श्रीकृष्ण", "नमः", "ओम् .न्"]
    gated = ["kṛṣṇa’ḥ", "see kṛṣṇa", "this is the text of the page", "कृ", "", None]
    assert values(spark, gated, translit.gated) == ["कृष्णऽः", None, None, None, None, None]
    assert values(spark, ["prathamao'dhyAyaH"], translit.itrans_to_devanagari) == ["प्रथमओ'ध्यायः"]
    assert values(spark, ["rc and hds: x"], translit.repaired) == ["rāmapada caṭṭopādhyāya and bhāgavata-bhāṣyam (haridāsa śāstrī): x"]


def test_scalar_text(spark):
    assert values(spark, ["a-\nb  c\n\n\n\nd\t ", " x ", "e\u0301"], X.clean_ocr) == ["ab c\n\nd", "x", "é"]
    assert values(spark, ["**शीर्ष**\n> क *ख* [1] (x) ग-घ।"], X.matching_form) == ["कखगघ।"]
    assert values(spark, ["१२", "x", None], X.from_devanagari_digits) == [12, None, None]
    assert values(spark, ["অ x", "अ", "kṛ", "k", "12", "ñ", "mañ", "mō", "š", "ő x"], X.line_script) == ["bengali", "devanagari", "iast", "plain", "other", "other", "iast", "plain", "other", "plain"]
    assert values(spark, ["a\n|| 12 ||\nb", "(1)"], X.without_marker_lines) == ["a\nb", ""]
    assert values(spark, ["a\n---\nb"], X.without_rules) == ["a\nb"]
    assert values(spark, ["(3) title 7", "x"], X.chapter_title) == ["title", "x"]
    assert values(spark, ["🔷 सर्व-संवादिनी *(जीव)*", "🔶 बलदेवः", "abc *xyz*", "a *b* c * d *  ", "a *b"], X.clean_label) == ["सर्व-संवादिनी", "बलदेवः", "abc", "a", "a *b"]
    assert values(spark, ["---\na: 1\n---\nbody", "body"], X.without_frontmatter) == ["body", "body"]
    assert values(spark, ["abcd", "ab"], lambda x: X.truncate(x, 3)) == ["abc…", "ab"]
    assert values(spark, ["a😀b😀c", "a😀", None], lambda x: X.truncate_units(x, 3)) == ["a😀…", "a😀", None]
    assert values(spark, ["t 1\nइति x समाप्तम्\n\n॥\nt 2", "x"], lambda x: X.without_title_and_colophon(x, "t", "^इति")) == ["\nt 2", "x"]
    assert values(spark, [" ", "a o)0(o", "a", None], X.is_separator) == [True, True, False, True]
    assert values(spark, ["d/a.b.docx", ".docx", "d.d/f"], lambda x: X.beside(x, ".r.csv")) == ["d/a.b.r.csv", ".docx.r.csv", "d.d/f.r.csv"]
    assert values(spark, ["[12a]", "[x y]", None], X.is_bracket_number) == [True, False, False]
    assert values(spark, ["label : missing", "missing", "not missing it"], lambda x: X.is_placeholder(x, "missing")) == [True, True, False]
    assert values(spark, ["é"], X.nfc) == ["é"]
    assert values(spark, ["a || 12 || b"], X.without_verse_numbers) == ["a  b"]


def test_runs(spark):
    run = files.RUN
    df = spark.sql(f"select from_json('[{{\"text\":\"kṛ\",\"bold\":true}},{{\"text\":\"ṣṇaḥ\"}}]', 'array<{run}>') r union all select from_json('[{{\"text\":\" \"}},{{\"text\":\"x\",\"bold\":true}}]', 'array<{run}>') union all select cast(array() as array<{run}>)")
    got = df.select(X.full_text(F.col("r")), X.has_mixed_formatting(F.col("r")), X.fully_bold(F.col("r")), files.rewritten(F.col("r"), F.lit("new")).alias("w")).collect()
    assert [tuple(g[:3]) for g in got] == [("kṛṣṇaḥ", True, False), (" x", True, True), ("", False, False)]
    assert [(len(g.w), g.w[0].text, g.w[0].bold) for g in got] == [(1, "new", True), (1, "new", None), (1, "new", None)]


def seq(spark, tags, name="tag"):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(tags)], f"k long, idx long, {name} string")


def column(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("idx").collect()]


def test_ordered(spark):
    df = seq(spark, ["a", "a", None, None, "b"])
    assert column(ordered.islands(df, ["k"], ["idx"], "tag"), "block") == [(0,), (0,), (1,), (1,), (2,)]
    df = seq(spark, ["q", "m", "q", "s", "q"])
    assert column(ordered.merge_into_context(df, ["k"], ["idx"], "tag", "q", "m", "c"), "c") == [("m",), ("m",), ("m",), ("s",), ("s",)]
    df = seq(spark, [None, "1", None, "2", "1", None])
    assert column(ordered.marker_chunks(df, ["k"], ["idx"], "tag"), "chunk") == [(None,), ("1",), ("1",), ("2",), ("2",), ("2",)]
    df = seq(spark, ["x", "|", "|", "y", "z", "|", "w"])
    assert column(ordered.separator_chunks(df, ["k"], ["idx"], F.col("tag") == "|"), "chunk") == [(1,), (2,), (2,), (3,)]
    assert column(ordered.segments(df, ["k"], ["idx"], F.col("tag") == "|"), "segment") == [(1,), (1,), (2,), (3,), (3,), (3,)]
    assert column(ordered.without_repeats(df, ["k"], ["idx"], "tag"), "tag") == [("x",), ("|",), ("y",), ("z",), ("|",), ("w",)]
    df = seq(spark, ["ab\\-", "cd\\-", "e", "f"], "line")
    assert column(ordered.join_continued(df, ["k"], "idx", "line", "\\-"), "line", "n_lines") == [("abcde", 3), ("f", 1)]
    df = seq(spark, ["s", "in", "e", "out", "s", "open"], "line")
    assert column(ordered.open_spans(df, ["k"], "idx", F.col("line") == "s", F.col("line") == "e", "line").withColumnRenamed("start", "idx"), "idx", "end", "text") == [(0, 2, "s in e")]
    df = seq(spark, ["## ", "##", "##   B  ", "### ", "x"], "line")
    assert column(ordered.sections(df, "k", "idx", "line"), "section", "sub", "heading") == [(0, None, ""), (0, None, ""), (1, None, "B"), (1, 0, "B"), (1, 0, "B")]
    assert column(ordered.sections(df, "k", "idx", "line", plain=True), "section", "sub") == [(None, None), (None, None), (0, None), (0, None), (0, None)]
    df = seq(spark, ["pre", "### early", "## A", "### a", "x", "##no", "## B"], "line")
    assert column(ordered.sections(df, "k", "idx", "line"), "section", "sub", "heading") == [(None, None, None)] * 2 + [(0, None, "A"), (0, 0, "A"), (0, 0, "A"), (0, 0, "A"), (1, None, "B")]


def test_quotas_and_slices(spark):
    items = spark.createDataFrame([(1, n) for n in range(1, 7)], "k long, n long")
    quotas = spark.createDataFrame([(1, 10, 2), (1, 20, 0), (1, 30, 3)], "k long, block long, quota long")
    assert [r.block for r in ordered.assign_quotas(items, quotas, ["k"], "n", "block", "quota", excess="null").orderBy("n").collect()] == [10, 10, 30, 30, 30, None]
    with pytest.raises(Exception, match="more items than quotas: 6"):
        ordered.assign_quotas(items, quotas, ["k"], "n", "block", "quota").collect()
    assert ordered.assign_quotas(items.filter("n < 5"), quotas, ["k"], "n", "block", "quota").count() == 4
    units = ordered.merged_units(items, ["k"], "n", spark.createDataFrame([(2, 2), (3, 2)], "m long, f long"), "m", "f")
    assert [(r.unit, r.n_items, r.number) for r in units.orderBy("unit").collect()] == [(1, 1, 1), (2, 2, 2), (4, 1, 3), (5, 1, 4), (6, 1, 5)]
    assert ordered.checked_counts(units, quotas, ["k"], "quota").count() == 5
    with pytest.raises(Exception, match="expected 5 units, got 4"):
        ordered.checked_counts(units.filter("unit < 6"), quotas, ["k"], "quota").collect()
    with pytest.raises(Exception, match="expected 5 units, got 0"):
        ordered.checked_counts(units.filter("unit > 6"), quotas, ["k"], "quota").collect()
    stated = spark.createDataFrame([(1, 1, 1), (1, 2, None), (1, 3, 4)], "k long, i long, d long")
    assert [(r.i, r.number) for r in ordered.declared_mismatches(stated, ["k"], ["i"], "d").collect()] == [(3, 3)]
    ranges = spark.createDataFrame([(1, 2, "a"), (1, 5, "b")], "k long, s long, name string")
    assert [r.name for r in ordered.slice_ranges(items, ranges, ["k"], "n", "s", "name").orderBy("n").collect()] == [None, "a", "a", "a", "b", "b"]
    df = spark.createDataFrame([(1, 0, "red", 2), (1, 1, "blue", 1), (1, 2, "blue", 1), (2, 0, "x", 0)], "k long, i long, c string, w long")
    assert {r.k: r.c for r in ordered.dominant(df, ["k"], "c", F.col("w"), "i", "DEFAULT").collect()} == {1: "red", 2: "DEFAULT"}


def match_by_loop(big, queries):
    at, out = 0, []
    for q in queries:
        hit = big.find(q, at) if q else -1
        if hit < 0 and q and len(q) > 12:
            hit = big.find(q[:12], at)
        if hit < 0:
            out.append((False, None, None))
            continue
        out.append((True, hit, len(q)))
        at = hit + max(1, len(q) // 2)
    return out


def test_forward_match_equals_a_loop(spark):
    import random

    r = random.Random(1)
    cases = []
    for _ in range(60):
        big = "".join(r.choice("ab") for _ in range(80))
        cases.append((big, [big[i : i + r.randint(1, 20)] + r.choice(["", "x"]) for i in sorted(r.randint(0, 70) for _ in range(6))]))
        cases[-1][1][2:2] = ["", None][: r.randint(0, 2)]
    df = spark.createDataFrame(cases, "big string, queries array<string>")
    got = align.forward_match(df, "big", "queries").collect()
    assert [[tuple(m) for m in g.matches] for g in got] == [match_by_loop(b, q) for b, q in cases]


def test_forward_match_of_one_list_equals_a_loop(spark, monkeypatch):
    import random

    r = random.Random(2)
    word = lambda: "".join(r.choice("ab") for _ in range(r.randint(0, 30)))
    queries = [word() for _ in range(40)] + [None, ""]
    texts = ["".join(r.choice("ab") for _ in range(400)) for _ in range(30)] + ["", "ab", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "k long, big string")
    for chars in (align.LIST_CHARS, 60):  # a small bound deals the list out in parts
        monkeypatch.setattr(align, "LIST_CHARS", chars)
        got = sorted(tuple(r) for r in align.forward_match_all(df, "big", iter(queries)).collect())
        assert got == [(i, k, a, n) for i, x in enumerate(texts) if x is not None for k, (found, a, n) in enumerate(match_by_loop(x, queries)) if found]
    assert align.forward_match_all(df, "big", iter([])).count() == 0


def test_forward_match_query_seeks_whole_items(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog and goes home again"
    texts = [(1, "so " + item[:45] + " not; then " + item), (2, item[:14] + " alone"), (3, "nothing")]
    spark.createDataFrame([(1, item), (2, "goes home")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in catalogue.QUERIES["forward_match"](spark, str(tmp_path)).collect())
    whole = texts[0][1].index(item)
    assert got == [(1, 0, whole, len(item)), (1, 1, texts[0][1].index("goes home", whole), 9), (2, 0, 0, len(item))]


def test_next_runs_whole_equals_a_loop(spark, tmp_path):
    import random

    r = random.Random(4)
    rows = [(i, 1 + i // 1500, "purchase" if r.random() < 0.01 else "view", 50.0 if i % 450 in range(430, 445) or r.random() < 0.002 else 1.0) for i in range(3000)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    expected = {}
    for user in (1, 2):
        own = [x for x in rows if x[1] == user]
        for k, x in enumerate(own):
            if x[2] == "purchase":
                run = []
                for y in own[k + 1 : k + 400]:
                    if y[0] % 5 == 0:
                        continue
                    if y[3] > 30:
                        run.append(y[0])
                    elif run:
                        break
                    if len(run) == 6:
                        break
                expected[x[0]] = run
    got = {x.event_id: [int(i) for i in x.run.split()] for x in catalogue.QUERIES["next_runs_whole"](spark, str(tmp_path)).collect()}
    assert got == expected and max(map(len, expected.values())) == 6
    assert any(run and run[0] - e >= 20 for e, run in expected.items())


def test_deficits_and_checks(spark):
    df = spark.createDataFrame([(1, 1000, 900), (2, 1000, 980), (3, 100, 45), (4, 0, 0)], "k long, a long, b long")
    assert [r.k for r in align.deficits(df, "a", "b").collect()] == [1]
    pages = spark.createDataFrame([(1, 5), (2, 100), (3, 1000), (4, 900)], "k long, n long")
    assert {r.k: r.reason for r in qc.page_status(pages, F.col("n")).collect()} == {1: "near-empty", 2: "significantly below average", 3: None, 4: None}


def test_citations(spark):
    df = spark.createDataFrame([(1, "x [वे.सू. २.१.११, १.१.१] [ब्र.सू. १.३.२८] [ब्र.सू. no] [see १.१.१]")], "k long, line string")
    rows = graph.citations(df).select("abbrev", "sutra_id").collect()
    assert [tuple(r) for r in rows] == [("वे.सू.", "2.1.11"), ("ब्र.सू.", "1.3.28")]
    edges = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), ("c", 2), ("d", 3)], "n string, m long")
    assert {r.n: r.paths for r in graph.two_hop(edges, "n", "m").collect()} == {"a": 2, "b": 1, "c": 1, "d": 0}


def test_citations_of_listed_works(spark):
    """Golden rows: five citations of four verses in a work of the list; the same pattern elsewhere is left out."""
    listed, other = "tattva-sandarbha-pramana-prakaranam.md", "govinda-bhashya-adhyaya-2.md"
    cites = [(157, "२.१.११"), (172, "१.३.२८"), (174, "१.३.२८"), (195, "१.१.४७"), (211, "२.२.३८")]
    rows = [(listed, n, "tattva-sandarbha", f"x [वे.सू. {c}] y") for n, c in cites] + [(other, 390, "govinda-bhashya", "[ब्र.सू. २.३.३९]"), ("z.md", 1, None, "[ब्र.सू. १.१.१]")]
    df = spark.createDataFrame(rows, "file string, n int, work string, line string")
    got = [tuple(r) for r in graph.citations(graph.of_works(df, "work")).select("file", "n", "sutra_id").orderBy("file", "n").collect()]
    assert got == [(listed, 157, "2.1.11"), (listed, 172, "1.3.28"), (listed, 174, "1.3.28"), (listed, 195, "1.1.47"), (listed, 211, "2.2.38")]
    assert graph.citations(df).count() == 7


def test_section_and_stray_lines_go(spark):
    gone = [" (39]", "@1", "[7)", "|| 1.2 ||", "12. label of a topic", "( 1.2 )", "prathamo'dhyāyaḥ", "Dvitīyaḥ pādaḥ", "|| 3 ||", "---", "१२. नाम", "@१"]
    stay = ["(39] and more", "@1x", "|| 1.2 || tail", "12 no dot", "a 12. label", "prathamaḥ  x", "dvitīyaḥ pādaḥ " + "x" * 70, "", "a line of far more than twenty characters stays whole"]
    text = "\n".join(x for pair in zip(gone, stay + stay[:3], strict=True) for x in pair)
    assert values(spark, [text], X.without_section_lines)[0].count("\n") == 12
    assert values(spark, [text, None], lambda x: X.without_section_lines(X.without_rules(x))) == ["\n".join(stay + stay[:3]), None]


def test_relational(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "i long, l string"), spark.createDataFrame([(1, "p"), (3, "q")], "i long, r string")
    with pytest.raises(Exception, match="positions do not match"):
        relational.zip_positions(a, b, ["i"]).collect()
    assert relational.full_merge(a, b, ["i"]).count() == 3 and relational.fill_sequence(a, "i", 1, 4).count() == 4
    assert [r.i for r in relational.todo(a, b, ["i"]).collect()] == [2] and relational.todo(a, b, ["i"], 1).count() == 0
    assert relational.append_new(a, a).count() == 4
    assert {r.u for r in relational.convert_distinct(a, "l", F.upper("l"), "u").collect()} == {"X", "Y"}


def test_html(spark):
    page = '<p><a class="x" href="b2.html">Book 2 - two</a><A HREF=\'v?a=1&amp;b\'><b>Verse </b> 3.4</A><a href=w>Verse \t1.2.3</a><a href="z">other &lt;</a><a name="n">none</a></p><article><h1>T</h1><script>x</script><p>body</p></article>'
    rows = html.links(spark.createDataFrame([(1, page)], "k long, html string"), ["k"], "html")
    assert [(r.pos, r.href, r.label) for r in rows.orderBy("pos").collect()] == [(0, "b2.html", "Book 2 - two"), (1, "v?a=1&b", "Verse3.4"), (2, "w", "Verse \t1.2.3"), (3, "z", "other <")]
    base = F.lit("https://h.org/a/b.html")
    assert [(r.book, r.url) for r in html.books(rows, base).collect()] == [(2, "https://h.org/a/b2.html")]
    spaced = rows.withColumn("label", F.replace("label", F.lit("Verse3"), F.lit("Verse 3")))
    assert sorted((r.book, r.chapter, r.verse, r.url) for r in html.verses(spaced, F.lit(9), base).collect()) == [(1, 2, 3, "https://h.org/a/w"), (9, 3, 4, "https://h.org/a/v?a=1&b")]
    assert values(spark, [page, "<p>none</p>"], lambda x: html.element_text(x, "article")) == ["T\nbody", None]


def test_quoted_verses():
    label = "<p>English translation</p>"
    assert html.quoted_verse(f"<blockquote>a<br>b <i>c</i></blockquote>{label}") == ("a\nb\nc", None)
    assert html.quoted_verse(f"<blockquote>out</blockquote><div id=scontent><p><blockquote>in</blockquote></div>{label}") == ("in", html.NO_LABEL)
    assert html.quoted_verse(f"<blockquote>out</blockquote><div id=scontent>x</div>{label}") == (None, html.NO_QUOTE)
    assert html.quoted_verse("<blockquote> </blockquote>") == (None, html.EMPTY_QUOTE) and html.quoted_verse(None) == (None, html.NO_QUOTE)


def test_engines_by_name(spark):
    ocr.register("loud", lambda: lambda image, lang: f"{lang}:{image.decode().upper()}")
    df = spark.createDataFrame([(1, bytearray(b"ab")), (2, None)], "page long, image binary")
    assert [(r.page, r.ocr_engine, r.raw_text) for r in ocr.recognized(df, "page", "image", "loud", "ben").orderBy("page").collect()] == [(1, "loud", "ben:AB"), (2, "loud", None)]
    with pytest.raises(ValueError, match="unknown engine 'none'.*loud"):
        ocr.recognized(df, "page", "image", "none", "ben")


def test_reports_and_sets(spark):
    df = spark.createDataFrame([(3, False), (1, True), (2, False)], "n long, found boolean")
    assert tuple(relational.match_counts(df, "found").first()) == (3, 1, 2)
    pages = relational.report_pages(spark.range(45).repartition(7), ["id"], 20)
    assert [tuple(r) for r in pages.orderBy("id").collect()] == [(i, i + 1, i // 20 + 1) for i in range(45)]
    assert [r.n for r in relational.first_rows(df, ["n"], 2).collect()] == [1, 2]
    assert sorted(r.n for r in relational.within(df, "n", [(0, 2), (3, 9)]).collect()) == [1, 3]
    assert relational.intersect(df, df.filter("n > 1").unionByName(df), ["n"]).count() == 3
    works = spark.createDataFrame([("a",), (None,), ("b",)], "w string")
    assert relational.without_value(works, "w", "a").count() == 2


def test_map_adds_no_targets(spark):
    rows = [("1.1.1", "A", "h", 1, 4), ("1.1.1", "A", "h", 9, 5), ("1.1.2", "A", "अनुच्छेदः २", 3, 1), ("1.1.3", "A", "अनुच्छेदः १०", 2, 2), ("1.1.2", "A", None, 0, None), ("1.1.1", "B", graph.ALIAS[0] + " x", 5, 0)]
    cites = spark.createDataFrame(rows, "sutra_id string, work string, heading string, at int, section int").withColumns({"slug": F.lower("work"), "file": F.lit("f"), "cite": F.col("sutra_id"), "line": F.lit(" l ")})
    mapping = spark.createDataFrame([("1.1.1", "f-1", 4, "g"), ("9.9.9", "f-1", 5, "g")], "sutra_id string, file string, section int, heading string")
    both = graph.with_mapped(graph.cited(cites), mapping, "G", "gg")
    nodes = graph.section_ranks(graph.section_nodes(both), ["B", "A", "G"])
    want = [(f"a:B|{graph.ALIAS[1]}", 1, ["1.1.1"], "/granthas/b/f/#section-0", 1, 1), ("a:A|अनुच्छेदः २", 1, ["1.1.2"], "/granthas/a/f/#section-1", 2, 1), ("a:A|अनुच्छेदः १०", 1, ["1.1.3"], "/granthas/a/f/#section-2", 3, 2)]
    want += [("a:A|?", 1, ["1.1.2"], "/granthas/a/f/#section--1", 4, 3), ("a:A|h", 2, ["1.1.1"], "/granthas/a/f/#section-4", 5, 4), ("a:G|f-1|4", 1, ["1.1.1"], "/granthas/gg/f-1/#section-4", 6, 1)]
    assert [(r.id, r["count"], r.sutra_ids, r.href, r.overall, r["rank"]) for r in nodes.orderBy("overall").collect()] == want
    assert {r.sutra_id: (r.neighbours, r.n) for r in graph.adjacency(both, "sutra_id", "work").collect()}["1.1.1"] == ("A B G", 3)
    said = [(r.place, r.work, r.heading, r.raw, r.context) for r in graph.sutra_cites(both).filter("sutra_id = '1.1.1'").orderBy("place").collect()]
    assert said == [(0, "A", "h", "1.1.1", "l"), (1, "B", graph.ALIAS[1], "1.1.1", "l"), (2, "A", "h", "1.1.1", "l"), (3, "G", "g", "", graph.MAPPED_CONTEXT)]
    assert {r.sutra_id: (r["count"], r.kind, r.label, r.ring) for r in graph.linked_with(both).collect()} == {"1.1.1": (3, "both", "×3", True), "1.1.2": (2, "single", "×2", False), "1.1.3": (1, "single", None, False)}
    offsets, places = graph.compressed(graph.graph_edges(both))
    listed = [r.neighbour for r in places.orderBy("place").collect()]
    for r in offsets.collect():
        own = {x.neighbour for x in graph.graph_edges(both).filter((F.col("kind") == r.kind) & (F.col("node") == r.node)).collect()} if r.kind == "work-sutra" else None
        assert listed[r.offset : r.offset + r.degree] == sorted(listed[r.offset : r.offset + r.degree]) and (own is None or set(listed[r.offset : r.offset + r.degree]) == own)


def test_global_order_of_hot_and_null_keys(spark):
    rows = [(None if i % 5 == 0 else "hot" if i % 3 else f"k{i}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i long").repartition(6)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    ranked = ordered.rank_within(ordered.global_rank(df, ["k", "i"]), ["k"], "rank", "within")
    got = [(r.k, r.i) for r in ranked.orderBy("rank").collect()]
    assert got == want and [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 401))
    assert {(r.k, r.within) for r in ranked.collect()} == {(k, 1 + sum(x[0] == k for x in want[:n])) for n, (k, _) in enumerate(want)}
    totals = [r.before for r in ordered.running_total(df.withColumn("v", F.col("i")), ["k", "i"], "v", "before").orderBy("before", "i").collect()]
    sums = [0]
    for _, i in want[:-1]:
        sums.append(sums[-1] + i)
    assert totals == sorted(sums) and ordered.global_rank(df.limit(0), ["k", "i"]).count() == 0


def test_picked_blocks_and_their_reasons(spark):
    blocks = [(1, 0, "bengali", "অ 1"), (1, 1, "devanagari", "अ"), (1, 2, "iast", "ā x"), (1, 3, "plain", "a y"), (2, 0, "plain", "abc"), (2, 1, "devanagari", "अ"), (3, 0, "bengali", "অ"), (3, 1, "devanagari", "अ"), (4, 0, "bengali", "অ"), (4, 1, "devanagari", "अ"), (4, 2, "plain", "a"), (5, 0, "bengali", "অ"), (5, 1, "devanagari", "अ"), (5, 2, "iast", "ā\n|| 12 ||"), (5, 3, "plain", "a"), (5, 4, "iast", "b"), (6, 0, "bengali", "12"), (6, 1, "devanagari", "अ"), (6, 2, "iast", "ā"), (6, 3, "plain", "a")]
    got = {r.k: (r.main, r.rest, r.reason) for r in ordered.pick_blocks(spark.createDataFrame(blocks, "k long, block long, tag string, text string"), ["k"], "block", "tag", "text").collect()}
    assert got == {1: ("অ 1", "ā x", None), 2: (None, None, ordered.NO_MAIN), 3: (None, None, ordered.NO_LATIN), 4: (None, None, ordered.ONE_LATIN), 5: ("অ", "ā\na", None), 6: (None, None, ordered.EMPTY_AFTER)}


def test_warnings_count_on_over_files(spark):
    rows = [("a.md", 1, "h1", 1), ("a.md", 2, "h2", None), ("b.md", 1, "h3", 3), ("b.md", 2, "h4", 7), ("c.md", 1, "h5", 2)]
    got = ordered.declared_warnings(spark.createDataFrame(rows, "f string, i long, title string, d long"), "f", ["i"], "title", "d").orderBy("number").collect()
    assert [(r.number, r.warning) for r in got] == [(4, "b.md: heading 'h4' declares अनुच्छेदः 7 but positional count is 4"), (5, "c.md: heading 'h5' declares अनुच्छेदः 2 but positional count is 5")]


HEADER = """---
title:
  devanagari: "क"
  iast: ka
work:
  devanagari: ख
  iast: kha
workSlug: kha-1
sequence: 2
corpusName:
  iast: c
  note: >
    folded
    text
commentaries:
  - id: one
    label: एक
  - id: two
    label: द्वि
availableScripts: [devanagari, iast]
---
## Head
body
"""


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "md").mkdir()
    (tmp_path / "md/a.md").write_text(HEADER)
    row = files.read_entries(spark, str(tmp_path / "md")).collect()[0]
    assert (row.entry_id, row.title.devanagari, row.sequence, row.corpusName.note, row.availableScripts) == ("a", "क", 2.0, "folded text\n", ["devanagari", "iast"])
    assert [c.label for c in row.commentaries] == ["एक", "द्वि"] and row.body == "## Head\nbody\n"
    (tmp_path / "md/bad.md").write_text("no header")
    with pytest.raises(Exception, match="lacks"):
        files.read_entries(spark, str(tmp_path / "md")).collect()
    (tmp_path / "x.itx").write_text("skip\n\\start here\nline\n\\end\nrest")
    assert [(r.line_no, r.line) for r in files.read_slices(spark, str(tmp_path / "x.itx"), "\\start", "\\end").collect()] == [(2, "\\start here"), (3, "line")]
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    para = lambda t, p="": f"<w:p><w:r><w:rPr>{p}</w:rPr><w:t>{t}</w:t></w:r></w:p>"
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{para('one', '<w:b/>')}<w:tbl><w:tr><w:tc>{para('cell')}</w:tc></w:tr></w:tbl>{para('two')}</w:body></w:document>")
        z.writestr("word/footnotes.xml", f"<w:footnotes {ns}><w:footnote w:type='separator'>{para('no')}</w:footnote><w:footnote>{para('note')}</w:footnote></w:footnotes>")
    got = files.read_docx(spark, str(tmp_path / "d.docx")).collect()
    assert [(r.para_idx, r.part, r.runs[0].text) for r in got] == [(0, "body", "one"), (1, "body", "two"), (2, "table", "cell"), (3, "footnote", "note")] and got[0].runs[0].bold
    assert stores.write_files(spark.createDataFrame([("a", "x"), ("b", "é")], "n string, c string"), f"file://{tmp_path}/named", "n", "c") == 2
    assert (tmp_path / "named/b").read_text() == "é"
    (tmp_path / "p").mkdir()
    for i in (1, 2, 3):
        (tmp_path / f"p/page_{i:04}.json").write_text(json.dumps({"page": i, "raw_text": "t"}))
    assert files.read_pages(spark, str(tmp_path / "p"), pages=(2, 3)).count() == 2
    (tmp_path / "v.csv").write_text('book,chapter,verse_number,original_text,source_url\n1,1,1,"a\nb",u\n2,1,1,c,u\n')
    assert [r.original_text for r in files.read_verses(spark, str(tmp_path / "v.csv"), 1).collect()] == ["a\nb"]
    parts = spark.createDataFrame([(1, 0, "plain", "a"), (1, 1, "quoted", "b"), (1, 2, "quoted", "c"), (1, 3, "sutra", "॥ d")], "k long, i long, kind string, t string")
    assert files.rendered(parts, ["k"], "i", "kind", "t").collect()[0].markdown == 'a\n\n> b  \n> c\n\n<p class="sutra">d</p>'
    files.write_chapters(parts, ["k"], "i", "t", str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).collect()[0].value.startswith("a\n\nb")
    assert not files.append_log(parts.limit(0), str(tmp_path / "log")) and files.append_log(parts, str(tmp_path / "log"))


def test_a_run_stopped_inside_a_batch_stays_exact(spark, tmp_path):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("kind"))
    incremental.stage_rows(rows.filter("id < 60"), ["id"], str(tmp_path / "in"), every=10)
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    assert schema.names == ["id", "kind", "position"]
    files = [sorted(r.position for r in spark.read.parquet(f).collect()) for f in spark.read.parquet(str(tmp_path / "in")).inputFiles()]
    assert all(len(f) <= 10 and f == list(range(f[0], f[0] + len(f))) for f in files) and sum(map(len, files)) == 60
    run, calls = incremental.Run(spark, str(tmp_path / "run")), []

    def stops(batch):
        calls.append(1)
        out = batch.withColumn("twice", F.col("id") * 2)
        # The second batch fails in its tasks, the third after some of its rows are written.
        return out.withColumn("twice", F.when(F.col("id") >= 0, F.raise_error(F.lit("stopped inside")).cast("long"))) if len(calls) == 2 else out

    with pytest.raises(Exception, match="stopped inside"):
        run.resume(str(tmp_path / "in"), schema, stops, F.col("kind"), files_per_batch=2)
    before = run.processed()
    assert 0 < before < 60 and len(calls) == 2
    assert run.resume(str(tmp_path / "in"), schema, stops, F.col("kind"), files_per_batch=2) == 60 - before and run.resume(str(tmp_path / "in"), schema, stops, F.col("kind")) == 0
    incremental.stage_rows(rows.filter("id >= 60"), ["id"], str(tmp_path / "in"), every=1)
    assert run.resume(str(tmp_path / "in"), schema, stops, F.col("kind"), files_per_batch=2) == 40
    assert sorted(r.twice for r in run.rows("twice long").collect()) == [2 * i for i in range(100)]
    assert {r.kind: r.n for r in run.totals().collect()} == {"0": 34, "1": 33, "2": 33}


def test_counts_of_a_batch_that_was_committed_twice_are_those_of_one(spark, tmp_path):
    """Rows written and counts not: the batch is done again under its number, and nothing counts twice."""
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "in"))
    run, schema = incremental.Run(spark, str(tmp_path / "run")), spark.range(1).schema
    spark.range(7).write.parquet(str(tmp_path / "run/rows/batch=0"))  # left by a run that died between the two
    assert run.resume(str(tmp_path / "in"), schema, lambda b: b) == 10 and run.rows("id long").count() == 10 and run.processed() == 10


def test_more_than_a_hundred_batches(spark, tmp_path):
    """A stream's own record of progress ends at a hundred batches; the counts do not."""
    spark.range(101).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "in"))
    run = incremental.Run(spark, str(tmp_path / "run"))
    assert run.resume(str(tmp_path / "in"), spark.range(1).schema, lambda b: b) == 101 and run.counts().select("batch").distinct().count() == 101


def test_memo_converts_only_new_texts(spark, tmp_path):
    memo = incremental.Memo(spark, str(tmp_path / "memo"))
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "k long, x string")
    got, n = memo.convert(first, "x", F.upper, "y", run=1)
    assert n == 2 and {r.k: r.y for r in got.collect()} == {1: "A", 2: "A", 3: None, 4: "B"}
    second = spark.createDataFrame([(1, "a"), (5, "c"), (6, "c")], "k long, x string")
    got, n = memo.convert(second, "x", F.upper, "y", run=2)
    assert n == 1 and {r.k: (r.y, r.y_run) for r in got.collect()} == {1: ("A", 1), 5: ("C", 2), 6: ("C", 2)}
    assert memo.convert(second, "x", F.upper, "y", run=3)[1] == 0


HARD = """# a comment first
title: {devanagari: "क, \\"ख\\" \\u0915", iast: 'it''s', english: a b} # note
work:
    devanagari: "x # no"   # yes
    iast: a:b#c
workSlug: kha-1

sequence: 2
corpusName:
  note: >
    folded
    text

    next
  iast: |-
    l1
      l2
commentaries:
- id: one
  label: "a: b"
-   {id: two, label: [x, 'y, z'], note: ~}
availableScripts: [a, "b, c", [d, {e: f}], ]
"quoted key": null
empty:
"""


def test_headers():
    got = files.parse_header(HARD)
    assert got["title"] == {"devanagari": 'क, "ख" क', "iast": "it's", "english": "a b"} and got["work"] == {"devanagari": "x # no", "iast": "a:b#c"}
    assert got["corpusName"] == {"note": "folded text\nnext\n", "iast": "l1\n  l2"} and got["commentaries"] == [{"id": "one", "label": "a: b"}, {"id": "two", "label": ["x", "y, z"], "note": None}]
    assert got["availableScripts"] == ["a", "b, c", ["d", {"e": "f"}]] and got["quoted key"] is None and got["empty"] is None and got["sequence"] == "2"
    assert files.parse_header("") == {} == files.parse_header("# nothing\n")
    for wrong in ('a: "open', "a: [b", "a: 'x' y", "just text"):
        with pytest.raises(ValueError):
            files.parse_header(wrong)


def test_quoted_values_come_back(spark):
    odd = ['say "x"', "back\\slash", "a # b: c", "line\nfeed\ttab", "'", "", "{[,]}"]
    assert [files.parse_header(f"k: {q}")["k"] for q in values(spark, odd, files.quoted)] == odd


def test_data_sources_push_their_filters(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"e{i}.md").write_text(HEADER.replace("workSlug: kha-1", f"workSlug: kha-{i % 2}"))
    (tmp_path / ".hidden.md").write_text("no")
    formats.register(spark)
    rows = spark.read.format("weft-entries").load(str(tmp_path))
    assert rows.count() == 4 == files.read_entries(spark, str(tmp_path)).count()
    assert sorted(map(str, rows.collect())) == sorted(map(str, files.read_entries(spark, str(tmp_path)).collect()))
    assert [r.entry_id for r in rows.filter("workSlug = 'kha-1'").orderBy("entry_id").collect()] == ["e1", "e3"]
    reader = formats._Entries({"path": str(tmp_path)})
    assert list(reader.pushFilters([formats.EqualTo(("workSlug",), "kha-1"), formats.EqualTo(("author",), "x")])) == [formats.EqualTo(("author",), "x")]
    assert [r[0] for p in reader.partitions() for r in reader.read(p)] == ["e1", "e3"]
    (tmp_path / "bad.md").write_text("no header")
    with pytest.raises(Exception, match="lacks"):
        spark.read.format("weft-entries").load(str(tmp_path)).collect()
    assert spark.read.format("weft-entries").option("strict", "false").load(str(tmp_path)).count() == 5
    from weftline.plans.archive import _docx

    (tmp_path / "d.docx").write_bytes(_docx("w"))
    docs, plain = spark.read.format("weft-docx").load(str(tmp_path)), files.read_docx(spark, str(tmp_path))
    mine = [(r.para_idx, r.part, [x.text for x in r.runs]) for r in docs.orderBy("para_idx").collect()]
    assert mine == [(r.para_idx, r.part, [x.text for x in r.runs]) for r in plain.orderBy("para_idx").collect()]
    assert [r.para_idx for r in docs.filter("part = 'table'").orderBy("para_idx").collect()] == [2, 3, 4]
    reader = formats._Docx({"path": str(tmp_path)})
    assert not list(reader.pushFilters([formats.In(("part",), ("table", "body"))])) and [p.part for p in reader.partitions()] == ["body", "table"]


def test_rules_of_hosts(spark):
    rules = [("h.org", "*", "disallow", "/a"), ("H.org", "*", "allow", "/a/b"), ("h.org", "*", "disallow", "/*.pdf$"), ("h.org", "*", "crawl-delay", "3"), ("g.org", "*", "disallow", "/"), ("g.org", "Weftline", "disallow", ""), ("tie.org", "*", "allow", "/x"), ("tie.org", "*", "disallow", "/x"), ("q.org", "*", "disallow", "/p?(.)")]
    cases = {"https://h.org/": True, "http://u@H.org:80/a/c": False, "https://h.org/a/b/c": True, "https://h.org/z.pdf": False, "https://h.org/z.pdf?x": True, "https://h.org": True, "https://g.org/any": True, "https://free.org/x": True, "https://tie.org/x": True, "https://q.org/p?(.)1": False, "https://q.org/pp.1": True, None: False, "nothing": False}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, agent string, rule string, path string")
    gated = robots.gate(pages, table)
    assert {r.url: r.allowed for r in gated.collect()} == cases and {r.delay for r in gated.filter("host = 'h.org'").collect()} == {3.0}
    assert robots.gate(pages, table.limit(0)).filter("allowed").count() == 11
    many = spark.createDataFrame([(i, f"https://h{i % 3}.org/{i // 6}") for i in range(60)], "page_id long, url string").repartition(4)
    plans = [sorted((r.page_id, r.at) for r in robots.schedule(robots.gate(many, table), "page_id").collect()) for _ in range(2)]
    assert plans[0] == plans[1] and len(plans[0]) == 60
    for h in range(3):
        at = [a for i, a in plans[0] if i % 3 == h]
        assert at[0] == 0 and all(1 <= b - a <= 2 for a, b in zip(at, at[1:], strict=False)) and len({round(b - a, 3) for a, b in zip(at, at[1:], strict=False)}) > 3


def test_learnt_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IN ('en', 'fr') AND length(text) >= 40")
    model = charmodel.train(docs.filter("doc_id % 5 <> 0"), "text", "lang").cache()
    held = docs.filter("doc_id % 5 = 0")
    got = {r.doc_id: r.lang for r in charmodel.classified(held, "doc_id", "text", model, "en", "fr").collect()}
    truth = {r.doc_id: r.lang for r in held.select("doc_id", "lang").collect()}
    right = sum(got[i] == x for i, x in truth.items()) / len(truth)
    assert len(truth) > 60 and right >= 0.9, right
    odd = spark.createDataFrame([(1, None), (2, "12 34"), (3, ""), (4, "the " * 50_000)], "k long, t string")
    costs = {r.k: (r.en, r.fr) for r in charmodel.costs(odd, "k", "t", model, ["en", "fr"]).collect()}
    assert costs[1] == costs[2] == costs[3] == (0.0, 0.0) and costs[4][0] > 0 and len(costs) == 4
    assert charmodel.classified(odd.filter("k < 4"), "k", "t", model, "en", "fr").filter("lang = 'fr'").count() == 3
    model.unpersist()


def bare(x):
    import re

    x = re.sub(r"\A\s*\*\*[^\n*]+\*\*\s*\n", "", x)
    for pattern in (r"(?m)^\s*>+\s*", r"[*_]", r"\[[^\]]*\]", r"\([^)]*\)", "[^\u0900-\u097f]"):
        x = re.sub(pattern, "", x)
    return x


def test_missing_content_equals_a_loop(spark):
    import random

    r = random.Random(6)
    word = lambda n: "".join(r.choice("कखगघङ ") for _ in range(n))
    paragraphs, sections, want = [], [], {}
    for doc in range(25):
        lines, parts = [], []
        for number in range(1, r.randint(2, 8)):
            root, notes = word(r.randint(0, 40)), [word(r.randint(0, 90)) for _ in range(r.randint(0, 4))]
            lines += [root, "[12]", "न व्याख्यातम्", *notes, r.choice(["", "x: न व्याख्यातम्"])]
            kept = [n for n in notes if r.random() < 0.6] + r.choice([[], ["_न व्याख्यातम्_"]])
            parts.append((number, root if r.random() < 0.85 else word(30), kept))
        paragraphs += [(doc, i, x) for i, x in enumerate(lines)]
        sections += [(doc, *p) for p in parts]
        big, offsets = "".join(map(bare, lines)), []
        for i, x in enumerate(lines):
            offsets += [i] * len(bare(x))
        found = [(n, offsets[at]) for (n, _, _), (ok, at, _) in zip(parts, match_by_loop(big, [bare(p[1]) for p in parts]), strict=True) if ok]
        for k, (n, start) in enumerate(found):
            end = found[k + 1][1] if k + 1 < len(found) else len(lines)
            skip = lambda x: x.strip() == "[12]" or x.strip().removeprefix("x: ") == "न व्याख्यातम्"
            source = sum(len(bare(x)) for x in lines[start:end] if not skip(x))
            target = len(bare(parts[n - 1][1])) + sum(len(bare(x)) for x in parts[n - 1][2] if x != "_न व्याख्यातम्_")
            if source and source - target > 60 and target / source < 0.97:
                want[doc, n] = (start, source, target)
    got = align.missing_content(spark.createDataFrame(paragraphs, "doc long, i int, line string"), spark.createDataFrame(sections, "doc long, number long, root string, notes array<string>"), "doc", "i", "line", "number", "root", "notes", "न व्याख्यातम्")
    assert {(x.doc, x.number): (x.start, x.source_length, x.target_length) for x in got.collect()} == want and len(want) > 10
