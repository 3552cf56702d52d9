"""Type-2 history kept up to date from a stream of source rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tellerlake.operators.dimensions import latest_per_key
from tellerlake.plans.daily import load_dim_customer
from tellerlake.schemas import TRACKED
from tellerlake.sources.lake import Lake

DIMENSION = "silver/dim_customer"


def apply_customers(
    lake: Lake, batch: DataFrame, batch_id: int, stream: str, as_of: date, order: str = "created_timestamp"
) -> None:
    """Apply one batch of a stream, unless the dimension has it already.

    The batch is folded to the newest row of each customer first, so it opens at
    most one current version. The rewrite's own log row names the batch: both
    are there or neither is, and a replay changes nothing.
    """
    if batch_id <= lake.last_batch(DIMENSION, stream):
        return
    newest = latest_per_key(batch, "customer_id", TRACKED, order)
    load_dim_customer(lake, newest, as_of, stream=stream, batch=batch_id)


def follow_customers(
    lake: Lake,
    source: DataFrame,
    checkpoint: str,
    as_of: Callable[[], date] = date.today,
    order: str = "created_timestamp",
) -> StreamingQuery:
    """Apply every micro-batch to the customer dimension."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_customers(lake, batch, batch_id, checkpoint, as_of(), order)

    return (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
