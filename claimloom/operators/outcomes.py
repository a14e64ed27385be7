"""What came of provider requests: the end of a request's attempts, ledgers of usage and latency, and validation outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

# Attempts a request has, statuses and errors after which another one follows.
MAX_ATTEMPTS = 3
RETRIED_STATUSES = [408, 409, 425, 429]
RETRIED_ERRORS = ["TimeoutError", "APITimeoutError", "APIConnectionError", "RateLimitError", "InternalServerError"]
RETRIED_CODES = ["stream_read_error"]
CONTRACT_ERRORS = ["LLMContractError", "LinkflowProviderContractError"]
SHOWN_FAULTS = 25
#: What no artifact may hold.
SECRET = r"(?i)(Authorization:\s*Bearer\s+\S+|\bsk-[A-Za-z0-9_-]+)"


def is_retryable(status: Column, error_type: Column, code: Column) -> Column:
    """Whether an attempt that failed is made again: never after a breach of the contract; by its status, if it has one, else by its error."""
    slow = F.coalesce(error_type.isin("TimeoutError") | code.isin(RETRIED_CODES), F.lit(False))
    by_status = F.when(status.isNotNull(), status.isin(RETRIED_STATUSES) | (status >= 500))
    return ~F.coalesce(error_type.isin(CONTRACT_ERRORS), F.lit(False)) & (slow | F.coalesce(by_status, error_type.isin(RETRIED_ERRORS), F.lit(False)))


def finish_status(status: Column, error_type: Column) -> Column:
    """How a request ended: completed without an error; else by its last error."""
    refused = status.between(400, 499) & ~status.isin(RETRIED_STATUSES)
    return F.when(error_type.isNull(), "completed").when(error_type.isin(CONTRACT_ERRORS), "contract_invalid").when(F.coalesce(refused, F.lit(False)), "provider_rejected").otherwise("provider_incomplete")


def provider_outcomes(attempts: DataFrame, faults: DataFrame | None = None, most: int = MAX_ATTEMPTS) -> DataFrame:
    """One row for each request: its finish_status, attempts, retries, latency, and the digest and type of its last error.

    `attempts` has request_id, attempt (from 1), status, error_type (null for a success), error_code, message and
    latency_ms. A request ends with its first success, its first failure that is not made again, or its attempt number
    `most`; later attempts of it don't count. With only failures that would be made again it is `pending`. A request
    that completed but has faults (request_id, claim_array, pos, fault) is contract_invalid; `shown` holds the first 25 of them,
    `faults` their number. Messages are digested, never shown.
    """
    ends = F.col("error_type").isNull() | ~is_retryable(F.col("status"), F.col("error_type"), F.col("error_code")) | (F.col("attempt") >= most)
    before = Window.partitionBy("request_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    counted = attempts.withColumn("ends", ends).withColumn("ended", F.coalesce(F.max("ends").over(before), F.lit(False))).where("not ended")
    last = lambda col: F.max_by(col, "attempt")
    found = counted.groupBy("request_id").agg(
        F.max("ends").alias("ends"), F.count("*").cast("int").alias("attempts"), F.sum(F.coalesce("latency_ms", F.lit(0))).alias("latency_ms"),
        last(F.struct("status", "error_type", "message")).alias("last"),
    )
    bad = F.lit(0).cast("long")
    shown = F.array().cast("array<string>")
    if faults is not None:
        text = F.concat_ws(" ", F.concat_ws(".", "claim_array", F.col("pos").cast("string")), F.regexp_replace("fault", SECRET, "[removed]"))
        # The least of each task come first to the last one: no request's faults are gathered whole.
        ranked = faults.select("request_id", text.alias("text")).withColumn("rank", F.row_number().over(Window.partitionBy("request_id").orderBy("text")))
        per = ranked.groupBy("request_id").agg(F.count("*").alias("faults"), F.array_sort(F.collect_list(F.when(F.col("rank") <= SHOWN_FAULTS, F.col("text")))).alias("shown"))
        found = found.join(per, "request_id", "left")
        bad, shown = F.coalesce("faults", bad), F.coalesce("shown", shown)
    state = F.when(~F.col("ends"), "pending").otherwise(finish_status(F.col("last.status"), F.col("last.error_type")))
    return found.select(
        "request_id", F.when((state == "completed") & (bad > 0), "contract_invalid").otherwise(state).alias("finish_status"), "attempts", (F.col("attempts") - 1).alias("retry_count"), "latency_ms",
        F.col("last.status").alias("http_status"), F.col("last.error_type").alias("error_type"), F.when(F.col("last.error_type").isNotNull(), F.sha2(F.coalesce("last.message", F.lit("")), 256)).alias("response_digest"), bad.alias("faults"), shown.alias("shown"),
    )


def usage_ledger(records: DataFrame) -> DataFrame:
    """The tokens of every window's call, in the order of deal and window."""
    return records.select("run_id", "deal_slug", "window_id", "provider", "model", "reasoning_effort", "input_tokens", "output_tokens", "token_source").orderBy("deal_slug", "window_id")


def latency_ledger(records: DataFrame) -> DataFrame:
    return records.select("run_id", "deal_slug", "window_id", "latency_ms", "retry_count", "provider_failure").orderBy("deal_slug", "window_id")


def merged_counts(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """(keys, column): maps of counts merged by adding what stands under one name, names in order; rows without any name give an empty map.

    Entries are summed by name within each task first, so what is shuffled and at last gathered is one entry a name.
    """
    names = df.select(*keys, F.explode_outer(column).alias("name", "n")).groupBy(*keys, "name").agg(F.sum("n").alias("n"))
    entries = F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", F.coalesce("n", F.lit(0)).alias("n")))))
    return names.groupBy(*keys).agg(F.map_from_entries(entries).alias(column))


def disposition_counts(dispositions: DataFrame) -> DataFrame:
    """(deal_slug, disposition_counts): each deal's map of dispositions and their numbers."""
    one = dispositions.select("deal_slug", F.create_map(F.coalesce("disposition", F.lit("")), F.lit(1).cast("long")).alias("disposition_counts"))
    return merged_counts(one, "disposition_counts", "deal_slug")


def ambiguity_queue(failures: DataFrame) -> DataFrame:
    """Failures as the rows of the queue that people go through."""
    return failures.select(F.col("check_name").alias("check"), "table_name", "row_id", "detail")


def validation_report(failures: DataFrame) -> DataFrame:
    """(passed, hard_failures, by_check): one row; by_check is a map in the order of names."""
    mix = merged_counts(failures.select(F.create_map("check_name", F.lit(1).cast("long")).alias("by_check")), "by_check")
    total = F.aggregate(F.map_values("by_check"), F.lit(0).cast("long"), lambda a, b: a + b)
    return mix.select((total == 0).alias("passed"), total.alias("hard_failures"), "by_check")


def observed(failures: DataFrame, checks: list[str]) -> tuple[DataFrame, Observation]:
    """failures, and what tells their numbers by check once they have been written: no second pass is made for the report."""
    seen = Observation()
    return failures.observe(seen, F.count("*").alias("hard_failures"), *(F.count_if(F.col("check_name") == k).alias(k) for k in checks)), seen


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
