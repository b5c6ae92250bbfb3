"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of a plan (file sizes for scans; no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - estimate unavailable (e.g. Connect)
        return None


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the estimated size is under ``limit``.

    Beyond it the plan is left to the planner: sort-merge join, which AQE may
    still turn into a broadcast once the real shuffle size is known.
    """
    size = plan_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df
