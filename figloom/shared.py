"""Tables written to the folder that all executors share, used to cut lineage.

Unlike a local checkpoint, a written table outlives the executor that made it.
The folder comes from ``spark.checkpoint.dir``; only a local-mode session without that
setting (tests) gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI. Raises on a cluster that names none."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = folder = tempfile.mkdtemp(prefix="figloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + _own[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; what is written there goes when the driver ends."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@atexit.register
def _clean() -> None:
    spark = SparkSession.getActiveSession() if any(not p.startswith(("file:", "/")) for p in _made) else None
    for path in _made:
        if path.startswith(("file:", "/")):
            shutil.rmtree(path.removeprefix("file:").replace("//", "/"), ignore_errors=True)
        elif spark is not None:
            with contextlib.suppress(Exception):  # the session may be gone; the folder is scratch space
                delete(spark, path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of ``path``, Hadoop path)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file so that a reader sees the old or the new contents: a temporary one takes its name in one step."""
    fs, at = file_system(spark, path)
    _, temp = file_system(spark, f"{path}.next-{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = context._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    uri = fs.makeQualified(at).toUri()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, context._jsc.hadoopConfiguration()).rename(fs.makeQualified(temp), fs.makeQualified(at), options)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: later plans start from the files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._figloom_path = path
    return back


def drop(df: DataFrame) -> None:
    """Deletes the files of a table made by ``written`` that no later plan reads."""
    delete(df.sparkSession, df._figloom_path)
