import random

import pytest
from pyspark.sql import functions as F

from figloom.llm import forest as G


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def graph(name):
    rnd = random.Random(7)
    if name == "hub":
        return [("h", f"n{i}") for i in range(200)] + [("n3", "n4")]
    if name == "chain":
        return [(f"n{i}", f"n{i + 1}") for i in range(60)]
    return [(f"n{rnd.randrange(150)}", f"n{rnd.randrange(150)}") for _ in range(90)] + [(None, "n1"), ("n1", "n1"), ("n2", "n1"), ("n1", "n2"), ("n1", "n2")]


@pytest.mark.parametrize("name", ["hub", "chain", "random"])
def test_spanning_forest(spark, name):
    edges = graph(name)
    nodes, forest = G.spanning_forest(spark.createDataFrame(edges, "a string, b string"))
    got = {}
    for r in nodes.collect():
        got.setdefault(r.root, set()).add(r.node)
    assert {frozenset(g) for g in got.values()} == components(edges)
    chosen = [tuple(r) for r in forest.collect()]
    assert components(chosen) == components(edges) and len(chosen) == sum(len(g) - 1 for g in components(edges))
    assert all(root in group for root, group in got.items())


def test_no_edges(spark):
    nodes, forest = G.spanning_forest(spark.createDataFrame([("x", "x"), (None, "y")], "a string, b string"))
    assert nodes.count() == forest.count() == 0


def test_document_groups(spark):
    docs = spark.createDataFrame([("US1", "F 01"), ("US2", "f-01"), ("US2", None), ("US3", "N/A"), ("US4", "N/A"), ("US5", None), (None, "F01"), ("--", "F01"), ("US6", "F9"), ("us 7", "F9")], "doc_id string, family_id string")
    links = spark.createDataFrame([("us-3", "GONE1", "division"), ("GONE1", "US 5", "priority"), ("US4", "US1", "cites"), ("US1", "US1", "reissue"), (None, "US1", "reissue")], "doc_id string, related_doc_id string, link_kind string")
    groups = {}
    for r in G.document_groups(docs, links).collect():
        groups.setdefault(r.root, set()).add(r.doc_id)
    assert sorted(map(sorted, groups.values())) == [["US1", "US2"], ["US3", "US5"], ["US4"], ["US6", "us 7"]]


def test_deal_is_near_the_shares_and_whole(spark):
    rnd = random.Random(2)
    sizes = [(f"r{i}", rnd.choice([1, 1, 2, 3, 8, 20])) for i in range(3000)] + [("giant", 5000), ("big", 600)]
    plan = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split string, share double")
    dealt = {r.root: r.split for r in G.deal(spark.createDataFrame(sizes, "root string, n_rows long"), plan).collect()}
    assert dealt.keys() == {r for r, _ in sizes}
    total = sum(n for _, n in sizes)
    for split, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(n for r, n in sizes if dealt[r] == split) / total - share) < 0.01
    again = {r.root: r.split for r in G.deal(spark.createDataFrame(sizes[::-1], "root string, n_rows long"), plan).collect()}
    assert again == dealt


def test_deal_of_odd_plans(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 1)], "root string, n_rows long")
    assert {r.split for r in G.deal(groups, spark.createDataFrame([("only", 3.0), ("none", None)], "split string, share double")).collect()} == {"only"}
    with pytest.raises(ValueError):
        G.deal(groups, spark.createDataFrame([("x", 0.0)], "split string, share double"))
    plan = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "split string, share double")
    assert G.deal(groups.limit(0), plan).count() == 0


_ = F
