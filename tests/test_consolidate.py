import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from figloom.operators import consolidate as C
from figloom.operators.running import running_total
from figloom.shared import new_path

SCHEMA = "file_id long, path string, kind string, applicant_id string, n_bytes long, sha256 string, payload binary, written_at timestamp, removed_at timestamp, m string"
T0 = dt.datetime(2024, 1, 1)


def rows(n, hot=0.4, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        name = "data/hot.tif" if rnd.random() < hot else f"data/{rnd.randrange(n // 2)}.tif"
        path = rnd.choice([name, "./" + name, "/srv/drawings/" + name, "data//" + name[5:], None if rnd.random() < 0.02 else name])
        body = bytes(rnd.randrange(256) for _ in range(rnd.randrange(40)))
        at = None if rnd.random() < 0.03 else T0 + dt.timedelta(seconds=rnd.randrange(50))
        out.append((i, path, "tiff", rnd.choice(["A", "A", "B", None]), len(body), rnd.choice([None, "x"]), rnd.choice([body, b"", None]) if i % 9 == 0 else body, at, None, "x"))
    return out


def written(spark, data, files=7):
    path = new_path(spark, "in")
    spark.createDataFrame(data, SCHEMA).repartition(files).write.parquet(path)
    return path


def best(data):
    def key(r):
        p = r[1]
        return f"?{r[0]}" if not p else "data/" + p.rsplit("/", 1)[-1]

    out = {}
    for r in data:
        rank = (r[7] is not None, r[7] or T0, r[0])
        if key(r) not in out or rank > out[key(r)][0]:
            out[key(r)] = (rank, r)
    return [r for _, r in out.values()]


def test_every_path_is_kept_once_with_its_last_content(spark):
    data = rows(400)
    store = C.consolidate(spark, written(spark, data), new_path(spark, "store"), bundle_bytes=300)
    got = {m.file_id: m for m in C.store_members(store).collect()}
    want = {r[0]: r for r in best(data)}
    assert got.keys() == want.keys() and store.select(F.explode("members")).count() == len(want)
    for i, m in got.items():
        assert m.payload == want[i][6] and m.applicant_id == want[i][3]
        assert m.sha256 == (None if want[i][6] is None else hashlib.sha256(want[i][6]).hexdigest())


def test_bundles_are_few_and_near_the_target(spark):
    data = rows(400)
    store = C.consolidate(spark, written(spark, data), new_path(spark, "store"), bundle_bytes=300)
    size = {}
    for r in best(data):
        size[r[3]] = size.get(r[3], 0) + max(1, r[4])
    n = {r.applicant_id: r["count"] for r in store.groupBy("applicant_id").count().collect()}
    assert n.keys() == size.keys() and all(s / 340 <= n[a] <= math.ceil(s / 300) for a, s in size.items())
    assert store.agg(F.max("n_bytes")).first()[0] < 300 + 40


def test_empty_table_and_staging_is_gone(spark):
    out = new_path(spark, "store")
    assert C.consolidate(spark, written(spark, []), out, bundle_bytes=10).count() == 0
    with pytest.raises(FileExistsError):
        C.consolidate(spark, written(spark, rows(5)), out, bundle_bytes=10)


def test_compaction_keeps_rows_and_repeats(spark):
    data = rows(60)
    source, out = written(spark, data + data[:20], files=40), new_path(spark, "packed")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    packing = C.compact_files(spark, source, out, target_bytes=1 << 20)
    assert packing.n_files >= 40 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    new = spark.read.parquet(out)
    assert len(new.inputFiles()) == 1
    assert sorted(map(str, new.collect())) == sorted(map(str, spark.read.parquet(source).collect()))


def test_compaction_of_an_empty_table(spark):
    out = new_path(spark, "packed")
    C.compact_files(spark, written(spark, []), out)
    assert spark.read.parquet(out).count() == 0


def test_running_total_with_hot_null_and_empty_keys(spark):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot"] * 4 + ["b", None]), i, rnd.choice([None, 1, 2, 5])) for i in range(500)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    got = {r.i: r.before for r in running_total(df, ["k"], ["i"], "v").collect()}
    sums, want = {}, {}
    for k, i, v in data:
        want[i] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + (v or 0)
    assert got == want
    assert running_total(df.limit(0), ["k"], ["i"], "v").count() == 0
