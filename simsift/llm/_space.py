"""Tables and files in the folder that the driver and all executors share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.space import new_folder, read_table, shared_dir, written

#: What may be broadcast: rows, and bytes as the planner knows them of a written table.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16_000_000


def bounded(table: DataFrame) -> DataFrame:
    """A written table to broadcast if it has few rows and bytes, else as it is."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(table) if size <= BROADCAST_BYTES and table.count() <= BROADCAST_ROWS else table


__all__ = ["bounded", "new_folder", "read_table", "shared_dir", "written"]
