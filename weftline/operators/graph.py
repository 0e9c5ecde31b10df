"""Citation graph: bracketed references in lines to edges, node tables and hops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import ASCII_DIGITS, DEVANAGARI_DIGITS, from_devanagari_digits, short_heading, strip
from weftline.operators.ordered import global_rank, rank_within, running_total
from weftline.scratch import Scratch

# What a reference looks like.
CITATION = r"\[((?:वे\.सू्?\.|ब्र\.सू्?\.)[^\]]*)\]"
TRIPLE = r"([०-९]+)\.([०-९]+)\.([०-९]+)"

# Fixed value: works whose references make the graph.
WORKS = ("tattva-sandarbha", "bhagavat-sandarbha", "paramatma-sandarbha", "krishna-sandarbha")


def of_works(lines: DataFrame, work: str, works: tuple[str, ...] = WORKS) -> DataFrame:
    """[P5] The rows whose work is in an allow-list; a null work is in none."""
    return lines.filter(F.col(work).isin(*works))


def citations(lines: DataFrame, line: str = "line", pattern: str = CITATION) -> DataFrame:
    """[J2, J3] One row per reference with its first triple of numbers; references without one are dropped."""
    rows = lines.withColumn("cite", F.explode(F.regexp_extract_all(F.col(line), F.lit(pattern), F.lit(1))))
    rows = rows.withColumn("_t", F.regexp_extract("cite", TRIPLE, 0)).filter("_t <> ''")
    part = lambda k: F.split_part(F.translate("_t", DEVANAGARI_DIGITS, ASCII_DIGITS), F.lit("."), F.lit(k)).cast("long")
    rows = rows.withColumns({"adhyaya": part(1), "pada": part(2), "sutra": part(3)}).drop("_t")
    return rows.withColumn("abbrev", F.when(F.col("cite").startswith("वे"), "वे.सू.").otherwise("ब्र.सू.")).withColumn("sutra_id", F.concat_ws(".", "adhyaya", "pada", "sutra"))


def target_nodes(edges: DataFrame, target: str, source: str, order: list[str]) -> DataFrame:
    """Per target: citations, distinct sources, sources in order of first mention, class single or both."""
    first = edges.groupBy(target, source).agg(F.min(F.struct(*order)).alias("at"), F.count(F.lit(1)).alias("n"))
    return first.groupBy(target).agg(
        F.sum("n").alias("citation_count"), F.count(F.lit(1)).alias("n_sources"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col(source).cast("string").alias("s")))), lambda r: r["s"]), ",").alias("sources"),
    ).withColumn("kind", F.when(F.col("n_sources") > 1, "both").otherwise("single"))


def source_nodes(edges: DataFrame, source: list[str], target: str) -> DataFrame:
    """Per source: citations and distinct targets (two-level, so a hot source is combined early)."""
    pairs = edges.groupBy(*source, target).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(*source).agg(F.sum("n").alias("citation_count"), F.count(F.lit(1)).alias("n_targets"))


def two_hop(edges: DataFrame, near: str, middle: str) -> DataFrame:
    """[G11] For each node, how many other nodes it reaches over one middle node, from counts per middle.

    Pairs of a middle node are never spelled out: the sum over a node's middles of (size - 1) counts
    each path once.
    """
    pairs = edges.select(near, middle).distinct()
    sizes = pairs.groupBy(middle).agg(F.count(F.lit(1)).alias("size"))
    return pairs.join(sizes, middle).groupBy(near).agg(F.sum(F.col("size") - 1).alias("paths"), F.count(F.lit(1)).alias("middles"))


def devanagari_triple(a: Column, b: Column, c: Column) -> Column:
    """A reference text for three numbers."""
    return F.translate(F.concat_ws(".", a.cast("string"), b.cast("string"), c.cast("string")), "0123456789", DEVANAGARI_DIGITS)


# Headings that are shown by an alias, and what a link of the map says.
ALIAS = ("श्री-सर्व-संवादिन्याः", "सार-निष्कर्षः")
MAPPED_CONTEXT = "This sūtra is quoted and explained directly in Govinda-bhāṣya."


def deep_link(base: str, slug: Column, entry: Column, section: Column) -> Column:
    """[C31] The address of a section of an entry; a citation before the first heading has section -1."""
    return F.concat(F.lit(f"{base}granthas/"), slug, F.lit("/"), entry, F.lit("/#section-"), section.cast("string"))


def cited(cites: DataFrame, base: str = "/") -> DataFrame:
    """Citations as the graph holds them: sutra_id, work, heading (shortened, ``?`` for none), raw, context, href, file, section, at, mapped.

    ``cites`` has sutra_id, work, slug, heading, cite, line, file, section and ``at``, by which mentions are ordered.
    """
    return cites.select(
        "sutra_id", "work", short_heading(F.col("heading"), *ALIAS).alias("heading"), F.col("cite").alias("raw"), strip(F.col("line")).alias("context"),
        deep_link(base, F.col("slug"), F.col("file"), F.coalesce("section", F.lit(-1))).alias("href"), "file", "section", "at", F.lit(False).alias("mapped"),
    )


def with_mapped(cites: DataFrame, mapping: DataFrame, work: str, slug: str, base: str = "/") -> DataFrame:
    """[G4] Citations of :func:`cited`, and for each target that some citation has, the section that the map gives it; the map makes no new targets.

    ``mapping`` has sutra_id, file, section, heading.  Mapped rows have no place ``at``: they come after all others, by their file, section and target.
    """
    known = cites.select("sutra_id").distinct()
    linked = mapping.join(known, "sutra_id", "left_semi").select(
        "sutra_id", F.lit(work).alias("work"), "heading", F.lit("").alias("raw"), F.lit(MAPPED_CONTEXT).alias("context"),
        deep_link(base, F.lit(slug), F.col("file"), F.col("section")).alias("href"), "file", "section", F.lit(None).cast(cites.schema["at"].dataType).alias("at"), F.lit(True).alias("mapped"),
    )
    return cites.unionByName(linked)


def section_id() -> Column:
    """[C31] A cited section is its work and heading, a mapped one its work, file and place."""
    key = F.when(F.col("mapped"), F.concat_ws("|", "work", "file", F.col("section").cast("string"))).otherwise(F.concat_ws("|", "work", "heading"))
    return F.concat(F.lit("a:"), key)


def section_nodes(cites: DataFrame) -> DataFrame:
    """[F10, G4] Per section: citations, its distinct targets in order of first mention, and the address of the first mention.

    Two levels: rows are summed per section and target first, so a hot section is gathered from its distinct
    targets only, which are as many as the cited work has verses.
    """
    mention = F.struct(F.col("mapped").alias("late"), "at", "file", "section", F.col("sutra_id").alias("target"))
    pairs = cites.withColumn("id", section_id()).groupBy("id", "work", "mapped", "sutra_id").agg(
        F.min(F.struct(mention.alias("m"), "href", "heading")).alias("first"), F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("mapped"), F.col("file"))).alias("sort_file"), F.min(F.when(F.col("mapped"), F.col("section"))).alias("sort_section"),
    )
    return pairs.groupBy("id", "work", "mapped").agg(
        F.min("first").alias("_f"), F.min("sort_file").alias("sort_file"), F.min("sort_section").alias("sort_section"), F.sum("n").alias("count"), F.count(F.lit(1)).alias("n_targets"),
        F.transform(F.array_sort(F.collect_list(F.struct("first.m", "sutra_id"))), lambda x: x["sutra_id"]).alias("sutra_ids"),
    ).withColumns({"href": F.col("_f.href"), "heading": F.col("_f.heading")}).drop("_f")


def sutra_cites(cites: DataFrame) -> DataFrame:
    """Every citation of a target in order: sutra_id, place from 0, work, heading, raw, context, href.

    A row each, as a target may have any number: places come from a global rank, not from a window over a target.
    """
    rows = global_rank(cites, ["sutra_id", "mapped", "at", "file", "section", "href", "raw"], "rank")
    return rank_within(rows, ["sutra_id"], "rank", "place").select("sutra_id", (F.col("place") - 1).alias("place"), "work", "heading", "raw", "context", "href")


def linked_with(cites: DataFrame) -> DataFrame:
    """Per target: its citations, how many works they are from, class single or both, the label ``×N`` if there are several, and whether the map links it (a ring).

    What the map gives is an edge and no citation: it counts for the ring alone.
    """
    pairs = cites.groupBy("sutra_id", "work", "mapped").agg(F.count(F.lit(1)).alias("n"))
    own = ~F.col("mapped")
    out = pairs.groupBy("sutra_id").agg(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("count"), F.count_if(own).alias("n_works"), F.max("mapped").alias("ring"))
    return out.withColumns({"kind": F.when(F.col("n_works") > 1, "both").otherwise("single"), "label": F.when(F.col("count") > 1, F.concat(F.lit("×"), F.col("count").cast("string")))})


def layout(nodes: DataFrame, group: list[Column | str], order: list[Column | str], top: int, row: int, gap: int, head: int = 0) -> DataFrame:
    """[E32] ``y`` of nodes in a column: ``row`` a node, ``gap`` between groups, ``head`` before each group's first node.

    A node's place is its global rank, a group's the rank among groups, so no window spans a group.
    Nodes are written first: they are read for the bounds of ranges and for the places of nodes and of groups, but made once.
    """
    nodes = Scratch(nodes.sparkSession, "layout").write(nodes, "nodes")
    names = [f"_g{i}" for i in range(len(group))]
    rows = nodes.withColumns({n: F.col(g) if isinstance(g, str) else g for n, g in zip(names, group, strict=True)})
    groups = global_rank(rows.select(*names).distinct(), names, "_group").withColumnsRenamed({n: f"{n}_" for n in names})
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}_"))
    placed = global_rank(rows, [*names, *order], "_place").join(groups, same)
    y = F.lit(top) + (F.col("_place") - 1) * row + (F.col("_group") - 1) * gap + F.col("_group") * head
    return placed.withColumn("y", y.cast("long")).drop("_place", "_group", *names, *[f"{n}_" for n in names])


def graph_edges(cites: DataFrame) -> DataFrame:
    """[G11] (kind, node, neighbour) in all directions: sutra to sections and works, section to sutras and works, work to sections and sutras."""
    of = {"sutra": F.concat(F.lit("s:"), "sutra_id"), "section": section_id(), "work": F.col("work")}
    pairs = [F.struct(F.lit(f"{a}-{b}").alias("kind"), of[a].alias("node"), of[b].alias("neighbour")) for a in of for b in of if a != b]
    return cites.select(F.inline(F.array(*pairs))).distinct()


def compressed(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """[G11] Adjacency in compressed form, of distinct (kind, node, neighbour): (kind, node, offset, degree) and (place, kind, node, neighbour).

    A node's neighbours are those with places from its offset on.  Offsets are a running sum of degrees over
    nodes in order, places the rank of edges in the same order, both by range; no node's list is gathered.
    """
    degrees = edges.groupBy("kind", "node").agg(F.count(F.lit(1)).alias("degree"))
    offsets = running_total(degrees, ["kind", "node"], "degree", "offset").select("kind", "node", "offset", "degree")
    places = global_rank(edges, ["kind", "node", "neighbour"], "place")
    return offsets, places.select((F.col("place") - 1).alias("place"), "kind", "node", "neighbour")


def graph_document(cites: DataFrame) -> DataFrame:
    """[B13] The graph as lines of JSON: nodes with their label, counts and first address, and an edge for each section and target."""
    sections = section_nodes(cites).select("id", F.lit("section").alias("kind"), F.to_json(F.struct("id", "work", "heading", "count", "href")).alias("json"))
    label = F.translate("sutra_id", "0123456789", DEVANAGARI_DIGITS)
    sutras = linked_with(cites).select(F.concat(F.lit("s:"), "sutra_id").alias("id"), F.lit("sutra").alias("kind"), F.to_json(F.struct(F.concat(F.lit("s:"), "sutra_id").alias("id"), label.alias("label"), F.col("kind").alias("class"), "count", "ring")).alias("json"))
    edges = graph_edges(cites).filter("kind = 'section-sutra'").select(F.concat_ws(" ", "node", "neighbour").alias("id"), F.lit("edge").alias("kind"), F.to_json(F.struct(F.col("node").alias("from"), F.col("neighbour").alias("to"))).alias("json"))
    return sections.unionByName(sutras).unionByName(edges)


def in_sutra_order(rows: DataFrame) -> DataFrame:
    """[H1] Sorted by chapter, quarter and number, as numbers."""
    return rows.orderBy("adhyaya", "pada", "sutra")


# Fixed value: how a heading states its number.
STATED = r"अनुच्छेदः\s+(.+)$"


def section_order(works: list[str]) -> list[Column]:
    """[H2] What sections are sorted by: place of the work; mapped ones by file, as a reader sorts names, and place; of the others those
    with a stated number by it, before those without, which go by heading."""
    place = F.array_position(F.array(*map(F.lit, works)), F.col("work"))
    number = from_devanagari_digits(F.regexp_extract("heading", STATED, 1))
    unstated = (~F.col("heading").rlike(STATED)).cast("int")
    return [place, F.collate("sort_file", "UNICODE"), F.col("sort_section"), F.when(F.col("sort_file").isNull(), unstated), F.when(F.col("sort_file").isNull(), number), F.collate("heading", "UNICODE")]


def section_ranks(nodes: DataFrame, works: list[str]) -> DataFrame:
    """[H2] Sections with their rank in the list of all works, by range and not by a window, and in their work's list."""
    rows = global_rank(nodes, [*section_order(works), "id"], "overall")
    return rank_within(rows, ["work"], "overall", "rank")


def adjacency(cites: DataFrame, of: str, to: str) -> DataFrame:
    """[G11] Per node its neighbours, each once, in order."""
    return cites.select(of, to).distinct().groupBy(of).agg(F.array_join(F.sort_array(F.collect_list(F.col(to).cast("string"))), " ").alias("neighbours"), F.count(F.lit(1)).alias("n"))


def sutra_routes(cites: DataFrame) -> DataFrame:
    """[B12, E19] Address of each verse's page, with those of the verses before and after it in the graph.

    Neighbours are joined by rank, so that no window orders all verses in one task.
    """
    part = lambda k: F.split_part("sutra_id", F.lit("."), F.lit(k)).cast("int")
    verses = cites.select("sutra_id").distinct().withColumns({"adhyaya": part(1), "pada": part(2), "sutra": part(3)})
    ranked = global_rank(verses, ["adhyaya", "pada", "sutra"], "rank").select("sutra_id", "rank")
    route = lambda x: F.concat(F.lit("vedanta-sutra-graph/sutra/"), x, F.lit("/"))
    beside = lambda step, name: ranked.select((F.col("rank") + step).alias("rank"), route(F.col("sutra_id")).alias(name))
    rows = ranked.join(beside(1, "previous"), "rank", "left").join(beside(-1, "next"), "rank", "left")
    return rows.select("sutra_id", route(F.col("sutra_id")).alias("route"), "previous", "next")


def routes(entries: DataFrame, work: str, entry: str) -> DataFrame:
    """[B12] Addresses of pages: one per entry below its work, and one per work."""
    pages = entries.select(F.concat_ws("/", F.lit("granthas"), work, F.col(entry).cast("string")).alias("route"))
    return pages.unionByName(entries.select(F.concat_ws("/", F.lit("granthas"), work).alias("route")).distinct())
