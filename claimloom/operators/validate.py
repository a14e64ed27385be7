"""Data-quality checks: each gives the failing rows as (check_name, table_name, row_id, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.operators.reconcile import CANONICAL


def failures(df: DataFrame, check: str, table: str, row_id: str, detail: Column | str) -> DataFrame:
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.col(row_id).alias("row_id"), detail.alias("detail"))


def exactly_one(left: DataFrame, right: DataFrame, key: str, check: str, table: str, what: str) -> DataFrame:
    """Rows of left without exactly one current row of right; right is filtered before the join."""
    n = right.where("current").groupBy(key).agg(F.count("*").alias("n"))
    bad = left.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n <> 1")
    return failures(bad, check, table, key, F.concat(F.lit(f"current {what} count is "), F.col("n").cast("string")))


def without(left: DataFrame, right: DataFrame, key: str, check: str, table: str, detail: str) -> DataFrame:
    """Rows of left whose key right lacks."""
    return failures(left.join(right.select(key), key, "left_anti"), check, table, key, detail)


def canonical_without_evidence(tables: dict[str, DataFrame], row_evidence: DataFrame) -> DataFrame:
    """Canonical rows without provenance: one anti-join for all tables."""
    ids = reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("row_table"), F.col(CANONICAL[name]).alias("row_id")) for name, df in tables.items()))
    bad = ids.join(row_evidence.select("row_table", "row_id"), ["row_table", "row_id"], "left_anti")
    return bad.select(F.lit("row_evidence").alias("check_name"), F.col("row_table").alias("table_name"), "row_id", F.lit("canonical row has no relational row_evidence").alias("detail"))


def _missing(parts: list[tuple[str, Column]]) -> Column:
    return F.array_join(F.array_compact(F.array(*(F.when(~ok, F.lit(name)) for name, ok in parts))), ", ")


def bid_semantics(claims: DataFrame) -> DataFrame:
    """Bid claims whose quote lacks the bidder, date, any of the values, or a bid's context."""
    q = F.col("quote_text")
    value = reduce(lambda a, b: a | b, (X.number_in_quote(F.col(v), q) for v in ("bid_value", "bid_value_lower", "bid_value_upper")))
    lack = _missing([("bidder_label", X.has_phrase(q, F.col("bidder_label"))), ("bid_date", X.date_in_quote(F.col("bid_date"), q)), ("bid_value", value), ("bid_context", X.bid_in_quote(F.coalesce("bid_stage", F.lit("None")), q))])
    return failures(claims.withColumn("lack", lack).where("lack <> ''"), "semantic_claim_evidence", "bid_claims", "claim_id", F.concat(F.lit("quote does not support "), F.col("lack")))


def relation_semantics(claims: DataFrame) -> DataFrame:
    """Relation claims whose quote lacks the subject, the object, or words for the relation."""
    q = F.col("quote_text")
    lack = _missing([("subject_label", X.has_phrase(q, F.col("subject_label"))), ("object_label", X.has_phrase(q, F.col("object_label"))), ("relation_type", X.relation_in_quote(F.col("relation_type"), F.col("role_detail"), q))])
    return failures(claims.withColumn("lack", lack).where("lack <> ''"), "semantic_claim_evidence", "actor_relation_claims", "claim_id", F.concat(F.lit("quote does not support "), F.col("lack")))


def source_truth(spans: DataFrame, sources: DataFrame) -> DataFrame:
    """Spans that the source does not bear out.

    `spans` has evidence_id, filing_id, char_start, char_end, quote_text, quote_text_hash, evidence_fingerprint;
    `sources` filing_id, text (null where the file is missing) and raw_sha256. A span may fail several checks.
    """
    c = F.col
    j = spans.join(sources, "filing_id", "left")
    bad_place = (c("char_start") < 0) | (c("char_end") < c("char_start")) | (c("char_end") > F.length("text"))
    missing, changed = c("text").isNull(), X.sha256(c("text")) != c("raw_sha256")
    other = F.substring(c("text"), c("char_start") + 1, c("char_end") - c("char_start")) != c("quote_text")
    row = lambda when, check, detail: F.when(when, F.struct(F.lit(check).alias("check_name"), F.lit(detail).alias("detail")))
    found = F.array_compact(F.array(
        row(missing, "source_truth", "source file is missing"),
        row(~missing & changed, "source_truth", "source hash differs"),
        row(~missing & bad_place, "source_truth", "span lies outside the source"),
        row(~missing & ~bad_place & other, "source_truth", "quote differs from the source"),
        row(X.sha256(c("quote_text")) != c("quote_text_hash"), "evidence_fingerprint", "quote hash does not recompute"),
        row(X.fingerprint(c("filing_id"), c("char_start"), c("char_end"), c("quote_text_hash")) != c("evidence_fingerprint"), "evidence_fingerprint", "fingerprint does not recompute"),
    ))
    return j.select("evidence_id", F.explode(found).alias("f")).select("f.check_name", F.lit("spans").alias("table_name"), F.col("evidence_id").alias("row_id"), "f.detail")


def duplicate_keys(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    bad = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").withColumn("row_id", F.concat_ws("/", *(F.col(k).cast("string") for k in key)))
    return failures(bad, "unique", table, "row_id", F.concat(F.col("n").cast("string"), F.lit(" rows share the key")))


def orphans(df: DataFrame, table: str, key: str, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent; null references are allowed."""
    bad = df.where(F.col(column).isNotNull()).join(parent.select(F.col(parent_key).alias(column)), column, "left_anti").withColumn("row_id", F.col(key).cast("string"))
    return failures(bad, "reference", table, "row_id", F.concat(F.lit(f"{column} "), F.col(column).cast("string"), F.lit(" has no parent")))


def broken_rule(df: DataFrame, table: str, key: str, rule: Column, detail: str) -> DataFrame:
    """Rows for which a rule is false; null counts as kept, as a CHECK does."""
    return failures(df.where(F.coalesce(~rule, F.lit(False))).withColumn("row_id", F.col(key).cast("string")), "check", table, "row_id", detail)


def soft_flags(judgments: DataFrame, counts: DataFrame) -> DataFrame:
    """Notes that fail nothing: judged exclusions, and cohorts known by their number only."""
    out = judgments.where("judgment_kind = 'projection_eligibility' and included = false").select(F.lit("projection_exclusion").alias("flag_type"), F.lit("judgments").alias("table_name"), F.col("judgment_id").alias("row_id"), F.concat("projection_name", F.lit(" excludes actor_id="), "actor_id").alias("detail"))
    n = F.col("anonymous_remainder_count")
    cohorts = counts.where(n != 0).select(F.lit("count_only_cohort").alias("flag_type"), F.lit("participation_counts").alias("table_name"), F.col("participation_count_id").alias("row_id"), F.concat(n.cast("string"), F.lit(" anonymous participant(s) remain aggregate only")).alias("detail"))
    return out.unionByName(cohorts)
