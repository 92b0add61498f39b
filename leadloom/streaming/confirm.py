"""Appointments that shops agree to during the day, as a stream.

The day's plan and the ticks are two streams.  Every row of the plan waits for a tick of its lead
that comes within ``open_for`` after it was planned, and leaves as soon as there is one, once however
many ticks follow.  Either side may arrive first.  Event times bound what is kept: a plan row is
forgotten when no tick in time can come any more, a tick when no plan row that it fits can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadloom.schema import SHOP_COLUMNS


def confirmed_stream(plans: DataFrame, ticks: DataFrame, open_for: str = "1 day", lateness: str = "6 hours") -> DataFrame:
    """Planned shops whose owner agreed to a time, each once.

    ``plans`` has the columns of planned shops and ``planned_at``, ``ticks`` has ``lead_id`` and
    ``ticked_at``; both are timestamps.  Rows that arrive more than ``lateness`` behind the newest
    of their stream may be left out; without such rows the result is that of ``confirmed_visits``
    with the ticks in time, in whatever order they arrive.
    """
    columns = [c for c in SHOP_COLUMNS if c in plans.columns]
    planned = plans.select(*columns, "planned_at").withWatermark("planned_at", lateness)
    ticked = ticks.select(F.col("lead_id").alias("ticked_lead"), "ticked_at").withWatermark("ticked_at", lateness)
    in_time = F.expr(f"ticked_at >= planned_at AND ticked_at <= planned_at + INTERVAL {open_for}")
    return (
        planned.join(ticked, (F.col("lead_id") == F.col("ticked_lead")) & in_time, "left_semi")
        .select(*columns)
        .withColumn("appointment_confirmed", F.lit(True))
    )


def write_confirmed(confirmed: DataFrame, path: str, checkpoint_path: str) -> StreamingQuery:
    """Add the confirmed visits of all ticks that are there to ``path``, then stop; the next run goes on from there."""
    return (
        confirmed.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
