"""Ordered folds: a sequential rule over the rows of each key, with constant state and no group held in memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def fold(rows: DataFrame, key: str, order: list[str], columns: list[str], out: str, start: Callable[[], Any], step: Callable[..., tuple]) -> DataFrame:
    """(key, columns..., out...) where ``step(state, *columns) -> (state, out values)`` runs through each key in order.

    Rows are sorted inside partitions, which spills to disk, and streamed; a key's rows pass through
    one task, but only its state is held.  Null keys make one group.
    """
    extra = StructType.fromDDL(out)
    target = StructType([*(rows.schema[c] for c in [key, *columns]), *extra.fields])
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = object(), None
        for batch in batches:
            made = []
            for k, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if k != last:
                    last, state = k, start()
                state, result = step(state, *values)
                made.append(result)
            tail = [pa.array([m[i] for m in made], type=arrow.field(len(batch.columns) + i).type) for i in range(len(extra))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *tail], schema=arrow)

    placed = rows.repartition(key).sortWithinPartitions(key, *order)
    return placed.select(key, *columns).mapInArrow(run, target)
