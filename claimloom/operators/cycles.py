"""Process cycles from dated rows: gap sessions, assignment by interval or nearest start, boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V


def gap_cycles(rows: DataFrame, max_gap_days: int = 120) -> DataFrame:
    """(slug, sequence, start_date, end_date, first_char, last_char, first_evidence, last_evidence) of each run of dates whose gaps are at most max_gap_days.

    `rows` has slug, event_date, char_start, char_end, candidate_id and evidence_id; rows without a date are left out.
    """
    order = Window.partitionBy("slug").orderBy("event_date", "char_start", "candidate_id")
    gap = F.datediff("event_date", F.lag("event_date").over(order)) > max_gap_days
    seen = rows.where("event_date is not null").withColumn("opens", F.coalesce(gap, F.lit(False)).cast("int"))
    seen = seen.withColumn("sequence", (F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1).cast("int"))
    key = F.struct("event_date", "char_start", "candidate_id")
    return seen.groupBy("slug", "sequence").agg(F.min("event_date").alias("start_date"), F.max("event_date").alias("end_date"), F.min("char_start").alias("first_char"), F.max("char_end").alias("last_char"), F.min_by("evidence_id", key).alias("first_evidence"), F.max_by("evidence_id", key).alias("last_evidence"))


def assign_cycles(rows: DataFrame, cycles: DataFrame) -> DataFrame:
    """(candidate_id, sequence): the first cycle whose dates hold the row's date, else the one whose start is nearest.

    Rows without a date go by their place in the text in the same way. Ties go to the earlier cycle; a slug without
    cycles gives null. The join is by slug, and each row meets only its own slug's few cycles.
    """
    pairs = rows.select("slug", "candidate_id", "event_date", "char_start").join(cycles, "slug", "left")
    day = F.col("event_date")
    inside = F.when(day.isNotNull(), (F.col("start_date") <= day) & (day <= F.col("end_date"))).otherwise((F.col("first_char") <= F.col("char_start")) & (F.col("char_start") <= F.col("last_char")))
    away = F.when(day.isNotNull(), F.abs(F.datediff("start_date", "event_date"))).otherwise(F.abs(F.col("first_char") - F.col("char_start")))
    key = F.struct((~inside).alias("outside"), F.when(inside, 0).otherwise(away).alias("away"), F.col("sequence").alias("n"))
    return pairs.groupBy("candidate_id").agg(F.min_by("sequence", F.when(F.col("sequence").isNotNull(), key)).alias("sequence"))


def boundaries(rows: DataFrame, keys: list[str], order: list[str], text_col: str = "quote_text") -> DataFrame:
    """(keys, subtype, candidate_id): of each group the first row with a phrase of the subtype that comes first in priority.

    Groups without any such phrase give no row: no boundary is made up.
    """
    rank = F.array_position(F.array(*(F.lit(s) for s, _ in V.BOUNDARY_PHRASES)), F.col("subtype"))
    hit = rows.withColumn("subtype", X.boundary_subtype(F.col(text_col))).where("subtype is not null")
    first = F.min_by(F.struct("subtype", "candidate_id"), F.struct(rank.alias("rank"), *order))
    return hit.groupBy(*keys).agg(first.alias("b")).select(*keys, "b.subtype", "b.candidate_id")


def latest_judgments(judgments: DataFrame) -> DataFrame:
    """Judgments that no other one supersedes."""
    gone = judgments.where("supersedes_judgment_id is not null").select(F.col("supersedes_judgment_id").alias("judgment_id")).distinct()
    return judgments.join(gone, "judgment_id", "left_anti")
