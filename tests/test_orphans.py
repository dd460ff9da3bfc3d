import datetime as dt
import random

from figloom.operators import orphans as O

T = lambda h: None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def reference(spark, rows, targets):
    r = spark.createDataFrame([(k, key, T(h)) for k, key, h in rows], "ref_key string, key string, at timestamp")
    t = spark.createDataFrame([(key, T(a), T(b)) for key, a, b in targets], "key string, live_from timestamp, live_to timestamp")
    return O.Reference("t", "f", r, t)


def test_reasons_and_bounds(spark):
    targets = [("a", 5, 10), ("a", 20, None), ("b", None, None), ("c", 1, None), ("c", 1, None), (None, 0, None), ("d", 3, 3)]
    rows = [("r1", "a", 4), ("r2", "a", 5), ("r3", "a", 10), ("r4", "a", 20), ("r5", "b", 9), ("r6", "c", 9), ("r7", None, 9), ("r8", "zz", 9), ("r9", "c", None), ("r10", "d", 3)]
    got = {r.ref_key: r.why for r in O.direct_orphans([reference(spark, rows, targets)]).collect()}
    assert got == {"r1": "late", "r3": "removed", "r5": "missing", "r7": "missing", "r8": "missing", "r9": "removed", "r10": "removed"}


def test_against_brute_force_with_a_hot_key(spark):
    rnd = random.Random(1)
    key = lambda: rnd.choice(["hot"] * 3 + list("abcdef"))
    targets = [(key(), rnd.randrange(50), rnd.choice([None, rnd.randrange(60)]) if rnd.random() < 0.9 else 1) for _ in range(60)]
    targets = [t for t in targets if not (t[0] == "hot" and t[2] is None)]
    rows = [(f"r{i}", key(), rnd.randrange(60)) for i in range(300)]
    got = {r.ref_key for r in O.direct_orphans([reference(spark, rows, targets)]).collect()}
    assert got == {k for k, x, h in rows if not any(t == x and a <= h and (b is None or h < b) for t, a, b in targets)}


def test_report_counts_months_and_empty_tables(spark):
    ref = reference(spark, [("r1", "a", 1), ("r2", "b", 1), ("r3", "b", 800), ("r4", "b", None)], [("a", 0, None)])
    graph = lambda r: O.Graph(O._grouped(O.direct_orphans([r]), O.F.col("ref_key")), links)
    links = spark.createDataFrame([], "tab string, key string, ref_field string, month string, parent_tab string, parent_key string")
    got = {r.month: (r.n_refs, r.n_orphans, r.n_missing) for r in O.report([ref], O.cascade(graph(ref))).collect()}
    assert got == {"2024-01": (2, 1, 1), "2024-02": (1, 1, 1), None: (1, 1, 1)}
    empty = reference(spark, [], [])
    assert O.report([empty], O.cascade(graph(empty))).count() == 0


def test_cascade_reaches_a_fixpoint(spark):
    links = [("b", "1", "a", "1"), ("c", "1", "b", "1"), ("c", "2", "b", "2"), ("d", "1", "c", "1"), ("a", "9", "d", "1"), ("d", "1", "a", "9"), ("x", "1", "x", "1")]
    graph = O.Graph(
        spark.createDataFrame([(t, k, "f", k, "2024-01", "missing", 1) for t, k in (("a", "1"), ("a", "1"), ("b", "1"), ("a", None))], "tab string, key string, ref_field string, ref_key string, month string, why string, n_rows long"),
        spark.createDataFrame([(t, k, "f", "2024-02", p, q) for t, k, p, q in links], "tab string, key string, ref_field string, month string, parent_tab string, parent_key string"),
    )
    got = {(r.tab, r.key): r.step for r in O.cascade(graph).where("key IS NOT NULL").collect()}
    assert got == {("a", "1"): 0, ("b", "1"): 0, ("c", "1"): 1, ("d", "1"): 2, ("a", "9"): 3}
    kinds = {(r.tab, r.step): r.orphan_kind for r in O.cascade_report(O.cascade(graph)).collect()}
    assert kinds[("a", 0)] == "direct" and kinds[("a", 3)] == "inherited"
    nothing = O.Graph(graph.direct.limit(0), graph.links.limit(0))
    assert O.cascade(nothing).count() == 0
