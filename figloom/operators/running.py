"""Running totals per key without one task per key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from figloom.shared import written


def _sums(key_columns: list[int], value: int):
    """A function for ``mapInArrow``: adds to sorted rows the sum of the earlier values of the same keys in this partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in key_columns:
                code = b.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            first = tuple(b.column(k)[0].as_py() for k in key_columns)
            amount = b.column(value).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(amount) - amount
            if first != last:
                carried = 0
            starts = np.flatnonzero(new)
            base = np.full(b.num_rows, -carried)
            if len(starts):
                base[starts[0] :] = np.repeat(before[starts], np.diff(np.append(starts, b.num_rows)))
            local = before - base
            carried = int(local[-1] + amount[-1])
            last = tuple(b.column(k)[b.num_rows - 1].as_py() for k in key_columns)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local)], names=[*b.schema.names, "_local"])

    return run


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "before") -> DataFrame:
    """Adds ``out``: the sum of ``value`` (an integer) over the rows of the same keys that come earlier in ``order``.

    ``order`` must be unique within the keys and hold no column of ``keys``. A key with a third of
    all rows is cut by range over many partitions: each partition sums its own rows as it reads them, and only the
    totals (a row per partition and key) are summed again across partitions. NULL keys are a
    key of their own, NULL values count as 0. The ranges are written once, so that both passes
    see the same ones.
    """
    ranges = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_part", F.spark_partition_id())
    names = ranges.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema.fields)
    spread = written(ranges.mapInArrow(_sums([names.index(k) for k in keys], names.index(value)), f"{schema}, _local long"), "ranges")
    totals = spread.groupBy("_part", *keys).agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    offsets = offsets.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in keys], "_offset")
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return spread.join(offsets, same).withColumn(out, F.col("_local") + F.col("_offset")).drop("_local", "_offset", "_part", "_p", *[f"_k_{k}" for k in keys])
