"""Projections and summaries: bidder rows, proof, exports, costs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V
from claimloom.functions.ids import in_ranges, placed
from claimloom.operators.reconcile import CANONICAL
from claimloom.sources.shared import stored


def bids_of_actors(events: DataFrame, links: DataFrame, actors: DataFrame) -> DataFrame:
    """Each actor's least and greatest bids in a cycle: by submitters or offerors, of the known kinds, with a label that names someone."""
    bids = events.where("event_type = 'bid'").select("deal_slug", "event_id", "cycle_id", "bid_value", "bid_value_lower", "bid_value_upper")
    roles = links.where(F.col("role").isin(V.PROJECTION_ROLES)).select("event_id", "actor_id")
    who = actors.where(F.col("observability").isin(V.PROJECTION_OBSERVABILITY) & F.col("kind").isin(V.PROJECTION_KINDS) & ~X.is_generic_label(F.col("label"))).select("actor_id", "label", "observability")
    grouped = bids.join(roles, "event_id").join(who, "actor_id").groupBy("deal_slug", "cycle_id", "actor_id", "label", "observability")
    return grouped.agg(F.min("bid_value").alias("bI"), F.min("bid_value_lower").alias("bI_lo"), F.max("bid_value_upper").alias("bI_hi"), F.max("bid_value").alias("bF"), (F.count("*") > 0).alias("has_bid"))


def bidder_rows(events: DataFrame, links: DataFrame, actors: DataFrame, name: str = V.PROJECTION_NAME) -> DataFrame:
    """bids_of_actors numbered over all deals in the order of slug, cycle and actor; they are stored in ranges of it, and numbered range by range."""
    order = ["deal_slug", "cycle_id", "actor_id"]
    found = placed(stored(in_ranges(bids_of_actors(events, links, actors), order), "bids"), order)
    n = F.col("place").cast("string")
    return found.select(
        F.concat(F.lit("bidderrow_"), n).alias("bidder_row_id"), F.concat(F.lit("projectionunit_"), n).alias("unit_id"), F.concat(F.lit("projectionjudgment_"), n).alias("judgment_id"),
        F.lit(name).alias("projection_name"), "deal_slug", "cycle_id", "actor_id", F.col("label").alias("actor_label"), "bI", "bI_lo", "bI_hi", "bF", "has_bid",
    )


def projection_units(rows: DataFrame) -> DataFrame:
    return rows.select("unit_id", "projection_name", "cycle_id", "actor_id")


def projection_judgments(rows: DataFrame) -> DataFrame:
    return rows.select("judgment_id", "unit_id", F.col("has_bid").alias("included"), F.lit(V.PROJECTION_RULE).alias("rule_id"), F.when(F.col("has_bid"), "source-backed bid in cycle").otherwise("no source-backed bid in cycle").alias("reason"))


def tagged(tables: dict[str, DataFrame], *columns: str) -> DataFrame:
    """The rows of all tables as one: table_name and the given columns."""
    return reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("table_name"), *columns) for name, df in tables.items()))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of each table, an empty one's too: one aggregation over the rows of all."""
    spark = next(iter(tables.values())).sparkSession
    none = spark.createDataFrame([(name, 0) for name in tables], "table_name string, one long")
    return tagged(tables).withColumn("one", F.lit(1).cast("long")).unionByName(none).groupBy("table_name").agg(F.sum("one").alias("n"))


def group_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def verdict(live: Column, obligations: Column, insufficient: Column, undisposed_: Column, unevidenced: Column, bidder_rows_: Column, actors: Column, events: Column, failures: Column) -> Column:
    """SOUND, SUSPECT, BLOCKED or UNSOUND from the counts of a run."""
    blocked = (bidder_rows_ == 0) | (actors == 0) | (events == 0)
    suspect = (live == 0) | (insufficient > 0) | (undisposed_ > 0) | (unevidenced > 0) | (live < F.greatest(F.lit(1), F.floor(obligations / 3)))
    return F.when(blocked, "BLOCKED").when(failures > 0, "UNSOUND").when(suspect, "SUSPECT").otherwise("SOUND")


def facts(claims: DataFrame, obligations: DataFrame, results: DataFrame, dispositions: DataFrame, canonical: dict[str, DataFrame], row_evidence: DataFrame, bidders: DataFrame, failures: DataFrame) -> DataFrame:
    """What a proof counts, as one table of (family, key, table_name, own, wanted, met, unmet).

    A key's own row says that it is there and whether it wants something; other rows of the same family and key say
    that a want is met, or that it isn't.
    """
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, family: str, key: Column, table: str | None = None, wanted=F.lit(True), met=F.lit(False), unmet=F.lit(False)) -> DataFrame:
        own = F.lit(table is not None)
        return df.select(F.lit(family).alias("family"), key.alias("key"), (F.lit(table) if table else none).alias("table_name"), own.alias("own"), (own & wanted).alias("wanted"), met.alias("met"), unmet.alias("unmet"))

    emitted = F.coalesce(F.col("result") == "claims_emitted", F.lit(False))
    parts = [
        rows(claims, "claim", F.col("claim_id"), "claims"), rows(dispositions.where("current"), "claim", F.col("claim_id"), met=F.lit(True)),
        rows(obligations, "duty", F.col("obligation_id"), "obligations", wanted=F.coalesce(F.expr("current and importance in ('required', 'important')"), F.lit(False))), rows(results.where("current"), "duty", F.col("obligation_id"), met=emitted, unmet=~emitted),
        *(rows(df, "row", F.concat_ws("/", F.lit(name), F.col(CANONICAL[name])), name) for name, df in canonical.items()), rows(row_evidence, "row", F.concat_ws("/", "row_table", "row_id"), met=F.lit(True)),
        rows(bidders, "bidder", none, "bidder_rows"), rows(failures, "failure", none, "failures"),
    ]
    return reduce(DataFrame.unionByName, parts)


def proof(facts_: DataFrame) -> DataFrame:
    """One row of counts and the verdict: facts are summed by key, and what wants without being met is counted."""
    some = lambda col: F.count_if(F.col(col))
    # Tables as numbers: the greatest of strings can't be aggregated by hashing, and all facts would be sorted, before their shuffle and behind it.
    told = {name: i for i, name in enumerate(("bidder_rows", "actors", "events", "failures"), 1)}
    number = reduce(lambda so_far, x: so_far.when(F.col("table_name") == x[0], x[1]), told.items(), F.when(F.col("table_name").isNull(), 0)).otherwise(0)
    keys = facts_.groupBy("family", "key").agg(F.max(number).alias("told"), some("own").alias("n"), some("wanted").alias("wanted"), some("met").alias("met"), some("unmet").alias("unmet"))
    c = F.col
    total = lambda what, name: F.coalesce(F.sum(F.when(what, c("n"))), F.lit(0)).alias(name)
    lacking = (c("met") == 0) | (c("unmet") > 0)
    one = keys.agg(
        total(c("family") == "claim", "live_claims"), total(c("family") == "duty", "obligations"), F.count_if((c("family") == "duty") & (c("wanted") > 0) & lacking).alias("insufficient"), total((c("family") == "claim") & (c("met") == 0), "undisposed"),
        total((c("family") == "row") & (c("met") == 0), "unevidenced"), total(c("told") == told["bidder_rows"], "bidder_rows"), total(c("told") == told["actors"], "actors"), total(c("told") == told["events"], "events"), total(c("told") == told["failures"], "failures"),
    )
    return one.withColumn("verdict", verdict(*map(c, ("live_claims", "obligations", "insufficient", "undisposed", "unevidenced", "bidder_rows", "actors", "events", "failures"))))


def deal_summaries(deals: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Each deal's number of rows in every table, zero included: one aggregation over the rows of all tables."""
    every = tagged({"deals": deals, **tables}, "deal_slug").groupBy("deal_slug").agg(*(F.count_if(F.col("table_name") == name).alias(name) for name in ("deals", *tables)))
    return every.where("deals > 0").drop("deals")


def coverage_export(obligations: DataFrame, results: DataFrame) -> DataFrame:
    """Obligations with their results, current or not."""
    return obligations.join(results.select("obligation_id", "result", "claim_count", "reason_code"), "obligation_id", "left").select("deal_slug", "obligation_id", "expected_claim_type", "importance", "result", "claim_count", "reason_code").orderBy("deal_slug", "obligation_id")


def disposition_export(claims: DataFrame, dispositions: DataFrame) -> DataFrame:
    ends = dispositions.select("claim_id", "disposition", "canonical_table", "canonical_id", "reason_code")
    return claims.select("deal_slug", "claim_id", "claim_type", "claim_sequence").join(ends, "claim_id", "left").orderBy("deal_slug", "claim_sequence", "claim_id").select("deal_slug", "claim_id", "claim_type", "disposition", "canonical_table", "canonical_id", "reason_code")


def token_basis(sources: Column) -> Column:
    """actual if that is the only source, mixed for any other set but the estimated alone, else estimated."""
    return F.when(sources == F.array(F.lit("actual")), "actual").when((F.size(sources) > 0) & (sources != F.array(F.lit("estimated"))), "mixed").otherwise("estimated")


def usage_basis(bases: Column) -> Column:
    """The basis of several deals together: theirs if all agree, else mixed."""
    return F.when(bases == F.array(F.lit("actual")), "actual").when(bases == F.array(F.lit("estimated")), "estimated").otherwise("mixed")


def deal_cost_metrics(records: DataFrame, claims: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Each deal's windows, tokens, latency, retries and failures, and what became of its claims."""
    zero = lambda col: F.coalesce(F.col(col), F.lit(0))
    costs = records.groupBy("deal_slug").agg(
        F.count("*").alias("windows"), F.sum(zero("input_tokens")).alias("input_tokens"), F.sum(zero("output_tokens")).alias("output_tokens"), F.sum(zero("retry_count")).alias("retry_count"),
        F.count_if(F.coalesce("provider_failure", F.lit("")) != "").alias("provider_failure_count"), F.max(zero("latency_ms") / 1000).alias("max_latency_s"),
        token_basis(F.sort_array(F.collect_set(F.when(F.col("token_source") != "", F.col("token_source"))))).alias("token_usage_basis"),
    )
    ends = dispositions.groupBy("deal_slug").agg(
        *(F.count_if(F.col("disposition") == d).alias(d) for d in ("canonicalized", "merged_duplicate", "rejected")),
        F.count_if((F.col("disposition") == "rejected") & F.col("reason_code").contains("quote")).alias("quote_rejections"),
    )
    sizes = claims.groupBy("deal_slug").agg(F.count("*").alias("claims"))
    return costs.join(sizes, "deal_slug", "left").join(ends, "deal_slug", "left").fillna(0)


def percentiles(values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """p50 (the middle of the two middle values for even numbers), p95 by nearest rank, and the greatest."""
    return values.groupBy(*keys).agg(F.percentile(column, 0.5).alias("p50"), F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {column})").alias("p95"), F.max(column).alias("max"))


def cost_envelope(metrics: DataFrame, input_price: float = 0.0, output_price: float = 0.0, deal_counts: list[int] = V.DEAL_COUNTS) -> DataFrame:
    """Costs of more deals in proportion to the observed ones: one row for each number of deals.

    `metrics` has one row for each observed deal: windows, input_tokens, output_tokens, claims, retry_count,
    provider_failure_count, quote_rejections, cost_usd (null where unknown), token_usage_basis. The actual cost is
    given for the observed number only, and only if every deal has one.
    """
    names = ["windows", "input_tokens", "output_tokens", "claims", "retry_count", "provider_failure_count", "quote_rejections"]
    total = metrics.agg(F.count("*").alias("deals"), *(F.sum(n).alias(n) for n in names), F.when(F.count("cost_usd") == F.count("*"), F.sum("cost_usd")).alias("actual"), F.sum("cost_usd").alias("partial"), usage_basis(F.sort_array(F.collect_set("token_usage_basis"))).alias("cost_basis"))
    rows = total.withColumn("deal_count", F.explode(F.array(*map(F.lit, deal_counts)))).withColumn("scale", F.try_divide(F.col("deal_count"), F.col("deals")))
    scaled = {n: F.col(n).cast("double") * F.col("scale") for n in names}
    cost = (scaled["input_tokens"] * input_price + scaled["output_tokens"] * output_price) / 1_000_000
    return rows.select(
        "deal_count", "cost_basis", *(v.alias(f"projected_{n}") for n, v in scaled.items()), cost.alias("estimated_cost_usd"),
        F.when(F.col("deal_count") == F.col("deals"), F.col("actual")).alias("actual_cost_usd"), F.col("partial").alias("partial_actual_cost_usd"),
        F.when(F.col("claims") > 0, F.col("quote_rejections") / F.col("claims")).otherwise(0.0).alias("quote_rejection_rate"),
    )


def cost_rows(metrics: DataFrame, input_price: float = 0.0, output_price: float = 0.0, deal_counts: list[int] = V.DEAL_COUNTS) -> DataFrame:
    """The rows of the cost summary: projections from exactly three observed deals, else one row of what was observed, with nothing projected.

    `metrics` as for cost_envelope, with coverage_obligations.
    """
    names = ["windows", "input_tokens", "output_tokens", "claims", "coverage_obligations", "retry_count", "provider_failure_count", "quote_rejections"]
    told = {"windows", "input_tokens", "output_tokens", "retry_count", "provider_failure_count"}  # without a projection, too
    shown = {"provider_failure_count": "provider_failures", "quote_rejections": "quote_validation_rejections"}
    total = metrics.agg(F.count("*").alias("deals"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names), F.when(F.count("cost_usd") == F.count("*"), F.sum("cost_usd")).alias("actual"), usage_basis(F.sort_array(F.collect_set("token_usage_basis"))).alias("basis"))
    three = F.col("deals") == V.DEAL_COUNTS[0]
    rows = total.withColumn("deal_count", F.explode(F.when(three, F.array(*(F.lit(n).cast("long") for n in deal_counts))).otherwise(F.array("deals")))).withColumn("scale", F.try_divide(F.col("deal_count"), F.col("deals")))
    scaled = {n: F.when(three, F.col(n).cast("double") * F.col("scale")).otherwise(F.col(n).cast("double") if n in told else F.lit(None).cast("double")) for n in names}
    cost = F.when(three, (scaled["input_tokens"] * input_price + scaled["output_tokens"] * output_price) / 1_000_000)
    return rows.select(
        "deal_count", F.when(F.col("deals") == 0, "estimated").otherwise(F.col("basis")).alias("cost_basis"), *(v.alias(f"projected_{shown.get(n, n)}") for n, v in scaled.items()), cost.alias("estimated_cost_usd"),
        F.when(three & (F.col("deal_count") == F.col("deals")), F.col("actual")).alias("actual_cost_usd"), F.when(three, "linear_from_observed_three_deal_metrics").otherwise("not_projected_requires_three_observed_deals").alias("assumption_basis"),
    )


def candidate_metrics(results: DataFrame, keys: tuple[str, ...] = ("stage", "candidate")) -> DataFrame:
    """Of each stage and candidate: jobs, the share that went well, means over those rounded to four places, and totals."""
    ok = F.col("result") == "OK"
    mean = lambda col: F.round(F.avg(F.when(ok, F.col(col))), 4).alias(f"mean_{col}")
    claims = F.coalesce("strict_claims", F.lit(0))
    return results.groupBy(*keys).agg(
        F.count("*").alias("jobs_recorded"), F.count_if(ok).alias("ok_jobs"), F.count_if(~ok | ok.isNull()).alias("failed_jobs"), F.round(F.count_if(ok) / F.count("*"), 4).alias("ok_rate"),
        *(mean(x) for x in ("duration_s", "input_tokens", "output_tokens", "quote_match_rate")), F.coalesce(F.sum(F.when(ok, claims)), F.lit(0)).alias("total_strict_claims"), F.round(F.avg(F.when(ok, claims)), 4).alias("mean_strict_claims_per_ok_job"),
    )


def shard_plan(slugs: DataFrame, size: int) -> DataFrame:
    """(deal_slug, source_order, shard_id): runs of `size` slugs in order, numbered range by range."""
    found = placed(stored(in_ranges(slugs.select("deal_slug").distinct(), ["deal_slug"]), "slugs"), ["deal_slug"])
    return found.select("deal_slug", F.col("place").cast("int").alias("source_order"), F.format_string("shard-%04d", (F.floor((F.col("place") - 1) / size) + 1).cast("int")).alias("shard_id"))
