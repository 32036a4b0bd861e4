"""Rows of a series in order, streamed through a Python task in Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from ..session import shuffle_tasks

# The small task functions travel with the task, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


def in_order(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Each key in one partition, sorted.

    The number of partitions is stated, so adaptive execution does not merge them: the Python
    work per row is worth a task, however few bytes it reads.
    """
    return df.repartition(shuffle_tasks(df.sparkSession), *key).sortWithinPartitions(*key, *order_by)


def pieces(batch: pd.DataFrame, key: Sequence[str]) -> Iterator[tuple[tuple, int, int]]:
    """(key, start, stop) of each run of equal keys; a run may go on in the next batch."""
    if batch.empty:
        return
    changed = np.zeros(len(batch), dtype=bool)
    changed[0] = True
    for c in key:
        values = batch[c]
        changed[1:] |= (values.to_numpy()[1:] != values.to_numpy()[:-1])
    starts = np.flatnonzero(changed)
    names = list(batch[list(key)].iloc[starts].itertuples(index=False, name=None))
    yield from zip(names, starts.tolist(), [*starts[1:].tolist(), len(batch)])


def floats(batch: pd.DataFrame, column: str) -> np.ndarray:
    return batch[column].to_numpy(dtype="float64", na_value=np.nan, copy=True)
