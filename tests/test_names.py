import posixpath

import pytest
from pyspark.sql import functions as F

from figloom.functions import names

PATHS = [
    "data/a.tif", "./data/a.tif", "data//a.tif", "data/./a.tif", "data/tmp/../a.tif", "/srv/drawings/data/a.tif", "/srv/drawings/./data/a.tif",
    "file:///srv/drawings/data/a.tif", "file:/srv/drawings/data/a.tif", "/../x", "a/../../b", "data/A.tif", "/", "data/a/", "a..b/c", ".hidden/x", "x/..y",
]


def test_paths_resolve_without_a_disk(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string")
    for p, got in df.select("p", names.canonical_path(F.col("p"))).collect():
        bare = p[len("file:") :] if p.startswith("file:") else p
        bare = "/" + bare.lstrip("/") if p.startswith("file:") else bare
        assert got == posixpath.normpath(posixpath.join("/srv/drawings", bare)), p


def test_uri_escapes_and_empty_paths(spark):
    df = spark.createDataFrame([("file:///srv/drawings/a%20b+c.tif",), ("a%20b",), ("",), (None,), ("file:///srv/drawings/a%zz",)], "p string")
    got = [r[0] for r in df.select(names.canonical_path(F.col("p"))).collect()]
    assert got == ["/srv/drawings/a b+c.tif", "/srv/drawings/a%20b", None, None, "/srv/drawings/a%zz"]


@pytest.mark.parametrize("value, doc, family", [("us-1 2.a1", "US12A1", None), ("F 000-12", "F00012", "F00012"), ("f7 ", "F7", "F7"), ("FX1", "FX1", None), ("12", "12", None), ("", "", None), (None, None, None), ("F", "F", None)])
def test_ids(spark, value, doc, family):
    row = spark.createDataFrame([(value,)], "v string").select(names.document_key(F.col("v")), names.family_key(F.col("v"))).first()
    assert tuple(row) == (doc, family)
