"""Streaming over groups of bounded size inside sorted partitions.

``applyInPandas`` starts a frame a group, which costs most where groups are many and small. Here a
partition sorted by its keys is read batch by batch, group borders are found on whole arrays, and
only the last, unfinished group is carried over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def fixed(column, dtype: str, width: int) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype=dtype).reshape(len(parts), width)


def borders(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group begins."""
    new = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for key in keys:
        values = table[key].to_numpy()
        new |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def grouped(df: DataFrame, keys: list[str], handle: Callable, schema: str) -> DataFrame:
    """``handle(table, starts)`` over whole groups, equal in ``keys`` (long columns without nulls)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            starts = borders(table, keys)
            last = int(starts[-1])
            rest = table.slice(last)
            if last:
                yield from handle(table.slice(0, last), starts[:-1])
        if rest is not None:
            yield from handle(rest, np.array([0]))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
