"""Row expanders over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema


AT_ONCE = 512


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[..., Iterable[tuple]]]) -> DataFrame:
    """Run a row expander over Arrow batches.

    ``make`` is called once per task and returns ``f(*values) -> rows``; models and automata are
    therefore built once per task and never per row.  At most AT_ONCE rows are held as Python objects.
    """
    target = df.sparkSession.createDataFrame([], schema).schema
    arrow_schema = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = make()
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                out: list[tuple] = []
                for values in zip(*(column.to_pylist() for column in whole.slice(at, AT_ONCE).columns)):
                    out.extend(expand(*values))
                if out:
                    columns = [pa.array(column, type=field.type) for column, field in zip(zip(*out), arrow_schema)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return df.mapInArrow(run, target)
