"""Sums of vectors that each task makes of its rows, added up in groups before the driver adds those."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups of tasks, which is also the most rows the driver gets.
FAN = 64


def total(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of the vectors of `size` numbers that `part` makes of each batch of `rows`; zero without rows."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np  # self-contained, so that workers need no more than this

        found = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                found = found + part(batch)
        task = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([task, pa.array([found], pa.list_(pa.float64()))], ["task", "sums"])

    def added(tasks: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        ordered = tasks.sort_values("task")
        return pd.DataFrame({"task": ordered["task"].iloc[:1], "sums": [np.sum(np.stack(ordered["sums"].to_list()), axis=0)]})

    found = rows.mapInArrow(of_task, "task int, sums array<double>")
    if rows.rdd.getNumPartitions() > FAN:
        found = found.groupBy(F.col("task") % FAN).applyInPandas(added, "task int, sums array<double>")
    collected = sorted(found.collect(), key=lambda row: row["task"])
    return np.sum([row["sums"] for row in collected], axis=0) if collected else np.zeros(size)
