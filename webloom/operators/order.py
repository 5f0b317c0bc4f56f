"""Exact positions and running sums inside groups of any size.

A global range sort lays each group out in one run, possibly across partitions; partition totals
and their prefix sums give every row its place, so no group ever has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.session import materialize


def running(records: DataFrame, group: list[str], order: list[Column], value: str | None = None, partitions: int | None = None) -> DataFrame:
    """``records`` plus ``position`` (from 1 inside the group, by ``order``) and, with ``value``, ``before``: the sum of ``value`` ahead of the row.

    Null groups count as one group of their own; null values as 0.  ``order`` should end in a unique
    column: then the result depends on no partitioning.
    """
    spark = records.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in group]
    ranged = records.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    ranged = materialize(_local(ranged, group, value), "ranked")
    # a group has at most one row here for each partition
    totals = ranged.groupBy("_part", *group).agg(F.max("_local").alias("_n"), F.max("_sum").alias("_s"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s0"),
    )
    match = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        match = match & ranged[g].eqNullSafe(F.col(f"_g{i}"))
    joined = ranged.join(offsets, match)
    own = F.coalesce(F.col(value), F.lit(0)) if value else F.lit(0)
    out = joined.withColumn("position", F.col("_local") + F.col("_n0"))
    if value:
        out = out.withColumn("before", (F.col("_sum") + F.col("_s0") - own).cast("long"))
    return out.drop("_part", "_local", "_sum", "_p", "_n0", "_s0", *[f"_g{i}" for i in range(len(group))])


def slots(records: DataFrame, group: str, order: list[Column], at: str, gap: int, partitions: int | None = None) -> DataFrame:
    """``records`` plus ``slot``: i * gap + the maximum over the group so far of (at - their i * gap), i counted from 0 by ``order``.

    A prefix maximum splits as a prefix sum does: with i counted inside a partition, the rows before it
    shift every term of the partition by the same number of gaps.
    """
    spark = records.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(group).asc_nulls_first()
    ranged = records.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType()), T.StructField("_top", T.LongType())])
    place, value = ranged.columns.index(group), ranged.columns.index(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen, top = TaskContext.get().partitionId(), object(), 0, None
        for batch in batches:
            local, tops = [], []
            for k, v in zip(batch.column(place).to_pylist(), batch.column(value).to_pylist()):
                if k != last:
                    last, seen, top = k, 0, None
                if v is not None and (top is None or v - seen * gap > top):
                    top = v - seen * gap
                local.append(seen)
                tops.append(top)
                seen += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64()), pa.array(tops, pa.int64())], names=[*batch.schema.names, "_part", "_local", "_top"])

    ranged = materialize(ranged.mapInArrow(run, schema), "slots")
    totals = ranged.groupBy("_part", F.col(group).alias("_g")).agg((F.max("_local") + 1).alias("_n"), F.max("_top").alias("_t"))
    earlier = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = totals.withColumn("_n0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    before = shifted.select(F.col("_part").alias("_p"), "_g", "_n0", F.max(F.col("_t") - F.col("_n0") * gap).over(earlier).alias("_t0"))
    joined = ranged.join(before, (F.col("_part") == F.col("_p")) & ranged[group].eqNullSafe(F.col("_g")))
    top = F.greatest(F.col("_top") - F.col("_n0") * gap, F.col("_t0"))  # nulls are passed over
    return joined.withColumn("slot", top + (F.col("_local") + F.col("_n0")) * gap).drop("_part", "_local", "_top", "_p", "_g", "_n0", "_t0")


def _local(ranged: DataFrame, group: list[str], value: str | None) -> DataFrame:
    extra = [T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType()), T.StructField("_sum", T.LongType())]
    schema = T.StructType([*ranged.schema.fields, *extra])
    places = [ranged.columns.index(g) for g in group]
    at = ranged.columns.index(value) if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen, total = TaskContext.get().partitionId(), object(), 0, 0
        for batch in batches:
            local, sums = [], []
            values = batch.column(at).to_pylist() if at is not None else [0] * batch.num_rows
            keys = zip(*(batch.column(p).to_pylist() for p in places)) if places else repeat((), len(values))
            for key, v in zip(keys, values):
                if key != last:
                    last, seen, total = key, 0, 0
                seen += 1
                total += v or 0
                local.append(seen)
                sums.append(total)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(local), pa.int32()), pa.array(local, pa.int64()), pa.array(sums, pa.int64())],
                names=[*batch.schema.names, "_part", "_local", "_sum"],
            )

    return ranged.mapInArrow(run, schema)
