"""Lookups in tables of any size that tasks read block by block from the shared folder.

For narrow tables too large for a broadcast, when the rows that ask are wide:
neither the driver nor a task holds the whole table, and what asks for rows
is not shuffled.  Each lookup reads the blocks that can have its keys, so a
task should look up many keys at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ordertally.llm.common import staged

BLOCK_ROWS = 1 << 18  # rows of a block, of which a task holds one at a time


def sorted_blocks(spark: SparkSession, table: DataFrame, name: str) -> list[str]:
    """Files with the rows of ``table``, each a range of its first column, ``key``, in its order.

    The keys are distinct longs, not null; the other columns are numbers.
    """
    # Staged before, as a range partitioning runs the query for its bounds once more.
    table = staged(spark, table, f"{name}-rows")
    blocks = max(1, -(-table.count() // BLOCK_ROWS))
    return staged(spark, table.repartitionByRange(blocks, "key").sortWithinPartitions("key"), name).inputFiles()


def rows_at(files: list[str], wanted: np.ndarray) -> list[np.ndarray]:
    """The columns of the rows whose keys are in ``wanted`` (sorted, distinct), in the order of the keys."""
    found = []
    for uri in files:
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            found.append([np.empty(0, f.type.to_pandas_dtype()) for f in file.schema_arrow])
            for g in range(file.num_row_groups):
                ends = file.metadata.row_group(g).column(0).statistics
                some = wanted
                if ends is not None and ends.has_min_max:
                    some = wanted[np.searchsorted(wanted, ends.min) : np.searchsorted(wanted, ends.max, side="right")]
                if len(some):
                    columns = [c.to_numpy() for c in file.read_row_group(g, use_threads=False).columns]
                    at = np.minimum(np.searchsorted(columns[0], some), len(columns[0]) - 1)
                    at = at[columns[0][at] == some]
                    found.append([c[at] for c in columns])
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]
