import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", ["diagram_class", "canonical_fig", "keywords_topk", "figures_upsert", "integrity", "p4_found", "p1_found", "p4_cascade", "p1_bundles", "relations", "context_labels", "figure_text", "prompt_row", "xml_metadata", "claims_source", "p6_claim_parts", "p6_tables", "bundle_extract", "store_deleted", "page_images", "dataset_rows"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    df = entry.queries()[name](spark, DATA)
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(map(str, want.fetchall()))
