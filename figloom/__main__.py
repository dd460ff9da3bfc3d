"""python -m figloom COMMAND: the jobs and the store's administration."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from figloom.operators import metadata
from figloom.operators.store import Store, session_info
from figloom.plans import pipeline
from figloom.session import prepare, warehouse
from figloom.sources import bundles
from figloom.streaming.ingest import ingest


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="figloom")
    p.add_argument("--warehouse", help="folder of the store; default FIGLOOM_WAREHOUSE")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("init", "counts", "integrity", "info", "vacuum", "clear", "overview"):
        sub.add_parser(name)
    for name in ("index", "fts"):
        sub.add_parser(name).add_argument("raw", help="folder with bundles")
    sub.choices["index"].add_argument("--force", action="store_true")
    stream = sub.add_parser("ingest")
    stream.add_argument("raw")
    stream.add_argument("checkpoint")
    build = sub.add_parser("build")
    build.add_argument("raw")
    build.add_argument("out", help="folder of the JSON lines")
    build.add_argument("--documents", help="Parquet table with the doc_id to build; default all")
    captions = sub.add_parser("captions")
    captions.add_argument("rows")
    captions.add_argument("out")
    captions.add_argument("--base", action="append", default=[], help="folders that relative image paths are below")
    a = p.parse_args(argv)

    spark = prepare(SparkSession.builder.appName("figloom").getOrCreate())
    if a.command == "captions":
        pipeline.captions(spark, a.rows, a.out, a.base or ["."]).show(truncate=False)
        return
    if a.command == "info":
        session_info(spark).show(truncate=False)
        return
    store = Store(spark, warehouse(a.warehouse))
    if a.command == "index":
        pipeline.index(spark, a.raw, store, a.force)
    elif a.command == "ingest":
        ingest(spark, a.raw, store, a.checkpoint)
    elif a.command == "build":
        only = spark.read.parquet(a.documents) if a.documents else None
        pipeline.build(spark, a.raw, store, a.out, split=only).show()
    elif a.command == "fts":
        xml = bundles.extract(bundles.scan_bundles(spark, a.raw)).where("kind = 'xml'").selectExpr("doc_id", "path", "decode(content, 'utf-8') AS body")
        one = xml.groupBy("doc_id").agg({"body": "max"}).toDF("doc_id", "body")
        store.create()
        pipeline.load_sections(store, metadata.with_metadata(one, "doc_id", "body"))
    elif a.command in ("counts", "integrity", "overview"):
        getattr(store, a.command)().show(truncate=False)
    else:
        {"init": store.create, "vacuum": store.vacuum, "clear": store.clear}[a.command]()


if __name__ == "__main__":
    main()
