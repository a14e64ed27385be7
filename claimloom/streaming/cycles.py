"""Gap cycles over a stream of dated rows, beside the batch form in operators.cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_cycles(rows: DataFrame, max_gap_days: int = 120, lateness: str = "30 days") -> DataFrame:
    """(slug, start_date, end_date, n) of each cycle of (slug, ts), given out once the watermark has passed it.

    A session window closes when the gap is reached, so a gap of exactly max_gap_days, which keeps a cycle
    together, needs one second more. Rows later than the watermark are dropped by Spark; dates are by UTC.
    """
    gap = f"{max_gap_days * 86400 + 86400} seconds"  # dates: a gap counts from day to day, not from second to second
    days = rows.withColumn("day", F.date_trunc("day", "ts")).withWatermark("day", lateness)
    found = days.groupBy("slug", F.session_window("day", gap)).agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count("*").alias("n"))
    return found.select("slug", F.to_date("first").alias("start_date"), F.to_date("last").alias("end_date"), "n")
