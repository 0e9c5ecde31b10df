import os

import pytest

import __spark_entry__
from weftline.plans import archive, catalogue

SF = "/root/testdata/sf0.001"


def test_names_and_oracles():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert all(f.__doc__ for f in catalogue.QUERIES.values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["line_script_blocks", "quota_assignment", "sections_hierarchy", "mixed_language", "toc_links", "forward_match", "translit_iast", "document_walk", "graph_sections", "verse_quotes", "gated_lines", "resumed_run", "pick_blocks", "line_cleanup_whole", "next_runs_whole", "citation_edges_of_works", "graph_neighbours", "citations_of_sutras", "graph_layout", "match_summary", "fetch_gate", "entry_source", "section_warnings", "memoised_lines", "learned_languages", "verse_routes", "titles_and_labels", "shelves"])
def test_queries_equal_their_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "lineitem", "orders", "pages", "benchmark", "region", "part", "events", "nation", "supplier"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rows = archive.QUERIES[name](spark, SF)
    names = sorted(rows.columns)
    mine = sorted(map(str, (tuple(r) for r in rows.select(*names).collect())))
    theirs = sorted(map(str, con.sql(f"select {', '.join(chr(34) + n + chr(34) for n in names)} from ({archive.ORACLE_SQL[name]})").fetchall()))
    assert mine == theirs


def test_every_supplier_has_its_document(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"Supplier {k}") for k in range(7)], "s_suppkey long, s_name string")
    rows.write.parquet(str(tmp_path / "supplier.parquet"))
    got = {(r["name"], r.para_idx, r.part, r.text) for r in archive.QUERIES["document_parts"](spark, str(tmp_path)).collect()}
    assert got == {(f"s{k}", *x) for k in range(7) for x in ((0, "body", f"Supplier {k}"), (2, "table", "cell"), (12, "footnote", "note"))}
