"""The driver's tables in the shapes of this library, written alike in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Filings: each document between a page marker, noise lines, a background heading and a later section.
FIL = r"""fil AS (
  SELECT 'd' || doc_id AS deal_slug, doc_id,
    '<!-- PAGE ' || (doc_id % 40 + 1) || ' -->' || chr(10) || 'Table of Contents' || chr(10) || (doc_id % 300) || chr(10) || '**Background of the Merger**' || chr(10) || chr(10)
    || CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10)) ELSE text END
    || chr(10) || chr(10) || 'Financing' || chr(10) || chr(10) || 'COMMAND=X' || chr(10) AS text,
    CASE doc_id % 4 WHEN 0 THEN 'DEFM14A' WHEN 1 THEN 'SC TO-T' WHEN 2 THEN 'defa14a' ELSE NULL END AS form_type
  FROM documents)"""


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    body = F.when(d % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))).otherwise(F.col("text"))
    text = F.concat(F.lit("<!-- PAGE "), (d % 40 + 1).cast("string"), F.lit(" -->\nTable of Contents\n"), (d % 300).cast("string"), F.lit("\n**Background of the Merger**\n\n"), body, F.lit("\n\nFinancing\n\nCOMMAND=X\n"))
    form = F.when(d % 4 == 0, "DEFM14A").when(d % 4 == 1, "SC TO-T").when(d % 4 == 2, "defa14a")
    return docs.select(F.concat(F.lit("d"), d.cast("string")).alias("deal_slug"), text.alias("text"), form.alias("form_type"))


# Claims: each event of a user is a claim of the user's slug, with all typed fields derived from its number k.
CLM = r"""clm0 AS (
  SELECT 'u' || user_id AS deal_slug, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS claim_sequence,
    CASE event_type WHEN 'view' THEN 'actor' WHEN 'click' THEN 'event' WHEN 'purchase' THEN 'bid' WHEN 'signup' THEN 'participation_count' ELSE 'actor_relation' END AS claim_type,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS day, value
  FROM events),
clm1 AS (
  SELECT *, CASE WHEN k % 10 = 0 THEN 'five parties' WHEN k % 10 = 1 THEN 'Potential bidders' ELSE 'Party ' || chr(65 + k % 26) || CASE WHEN k % 26 = 4 THEN '''s' ELSE '' END END AS label,
    'Party ' || chr(65 + (k + 7) % 26) AS label2 FROM clm0),
clm AS (
  SELECT deal_slug, event_id, claim_sequence, deal_slug || '_claim_' || claim_sequence AS claim_id, claim_type, k, day, value, label, label2,
    deal_slug || '_llmspan_' || claim_sequence AS evidence_id, CASE k % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence,
    CASE WHEN claim_type = 'actor' THEN label END AS actor_label, CASE k % 3 WHEN 0 THEN 'organization' WHEN 1 THEN 'person' ELSE 'group' END AS actor_kind,
    CASE k % 2 WHEN 0 THEN 'named' ELSE 'anonymous_handle' END AS observability,
    CASE WHEN claim_type = 'event' THEN day END AS event_date, 'event ' || k AS description,
    CASE WHEN k % 5 = 0 THEN NULL ELSE label END AS event_actor_label, CASE WHEN k % 7 = 0 THEN '' ELSE 'advisor' END AS event_actor_role,
    label AS bidder_label, CASE WHEN claim_type = 'bid' THEN day END AS bid_date, CASE WHEN k % 3 = 0 THEN NULL ELSE value END AS bid_value,
    CASE WHEN k % 3 = 0 THEN round(value, 2) END AS bid_value_lower, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN round(value, 2) + 1 END AS bid_value_upper,
    CASE k % 4 WHEN 0 THEN 'final' WHEN 1 THEN 'initial' WHEN 2 THEN 'revised' ELSE 'unspecified' END AS bid_stage,
    CASE k % 2 WHEN 0 THEN 'ioi' ELSE 'first_round' END AS process_stage, 'bidders' AS actor_class, k % 10 AS count_min, CASE WHEN k % 2 = 0 THEN k % 10 + 2 END AS count_max, 'exact' AS count_qualifier,
    label AS subject_label, label2 AS object_label, CASE k % 4 WHEN 0 THEN 'member_of' WHEN 1 THEN 'advises' WHEN 2 THEN 'finances' ELSE 'supports' END AS relation_type,
    CASE WHEN k % 6 = 0 THEN 'lead adviser' END AS role_detail
  FROM clm1)"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide claims; `k` and `event_id` stay for seeding defects."""
    e = table(spark, sf_dir, "events")
    k, v = F.col("k"), F.col("value")
    kind = F.col("claim_type")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    base = e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("deal_slug"), "event_id", n.alias("claim_sequence"),
        F.when(F.col("event_type") == "view", "actor").when(F.col("event_type") == "click", "event").when(F.col("event_type") == "purchase", "bid").when(F.col("event_type") == "signup", "participation_count").otherwise("actor_relation").alias("claim_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), F.to_date("ts").alias("day"), "value",
    )
    letter = lambda x: F.char(F.lit(65) + x % 26)
    label = F.when(k % 10 == 0, "five parties").when(k % 10 == 1, "Potential bidders").otherwise(F.concat(F.lit("Party "), letter(k), F.when(k % 26 == 4, "'s").otherwise("")))
    base = base.withColumn("label", label).withColumn("label2", F.concat(F.lit("Party "), letter(k + 7)))
    pick = lambda *names: _pick(k, names)
    third, row = k % 3 == 0, F.col("claim_sequence").cast("string")
    return base.select(
        "deal_slug", "event_id", "claim_sequence", F.concat_ws("_", "deal_slug", F.lit("claim"), row).alias("claim_id"), "claim_type", "k", "day", "value", "label", "label2",
        F.concat_ws("_", "deal_slug", F.lit("llmspan"), row).alias("evidence_id"), pick("high", "medium", "low").alias("confidence"),
        F.when(kind == "actor", F.col("label")).alias("actor_label"), pick("organization", "person", "group").alias("actor_kind"), pick("named", "anonymous_handle").alias("observability"),
        F.lit("process").alias("event_type"), F.lit("exclusivity_grant").alias("event_subtype"), F.when(kind == "event", F.col("day")).alias("event_date"), F.concat(F.lit("event "), k.cast("string")).alias("description"),
        F.when(k % 5 != 0, F.col("label")).alias("event_actor_label"), F.when(k % 7 == 0, "").otherwise("advisor").alias("event_actor_role"),
        F.col("label").alias("bidder_label"), F.when(kind == "bid", F.col("day")).alias("bid_date"), F.when(~third, v).alias("bid_value"),
        F.when(third, F.round(v, 2)).alias("bid_value_lower"), F.when(third & (k % 2 == 0), F.round(v, 2) + 1).alias("bid_value_upper"), pick("final", "initial", "revised", "unspecified").alias("bid_stage"),
        pick("ioi", "first_round").alias("process_stage"), F.lit("bidders").alias("actor_class"), (k % 10).alias("count_min"), F.when(k % 2 == 0, k % 10 + 2).alias("count_max"), F.lit("exact").alias("count_qualifier"),
        F.col("label").alias("subject_label"), F.col("label2").alias("object_label"), pick("member_of", "advises", "finances", "supports").alias("relation_type"), F.when(k % 6 == 0, "lead adviser").alias("role_detail"),
        F.lit(None).cast("date").alias("effective_date_first"), F.col("label").alias("raw_value"),
    )


def _pick(k: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (k % len(names) + 1).cast("int"))


# Obligations: the fixed ones for each user; a claim is linked to one of its type, chosen by k.
OBL = (
    "slugs AS (SELECT DISTINCT deal_slug FROM clm),\nduty(n, expected_claim_type, obligation_label, importance) AS (VALUES "
    + ", ".join(f"({i}, '{t}', '{label}', '{w}')" for i, (t, label, w) in enumerate(V.OBLIGATIONS, 1))
    + "),\nobl AS (SELECT deal_slug || '_obligation_' || n AS obligation_id, deal_slug, n, expected_claim_type, obligation_label, importance FROM slugs, duty)"
)


def user_obligations(claims_: DataFrame) -> DataFrame:
    from claimloom.operators.evidence import obligations

    slugs = claims_.select("deal_slug").distinct()
    return obligations(slugs.select("deal_slug", F.concat("deal_slug", F.lit("_region_1")).alias("region_id"), F.concat("deal_slug", F.lit("_filing_1")).alias("filing_id")))


# Links: of the obligations of a claim's type the one at place k; every 40th event names none that exists.
LNK = """lnk AS (
  SELECT *, deal_slug || '_obligation_' || CASE WHEN event_id % 400 = 399 THEN 99 ELSE CASE claim_type
      WHEN 'event' THEN CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 5 END WHEN 'participation_count' THEN CASE k % 2 WHEN 0 THEN 2 ELSE 3 END
      WHEN 'actor' THEN CASE k % 3 WHEN 0 THEN 6 WHEN 1 THEN 7 ELSE 8 END WHEN 'bid' THEN 9 ELSE CASE WHEN event_id % 300 = 7 THEN 9 ELSE 10 END END END AS coverage_obligation_id
  FROM clm)"""


def linked_claims(claims_: DataFrame) -> DataFrame:
    kind, k, e = F.col("claim_type"), F.col("k"), F.col("event_id")
    own = F.when(kind == "event", _pick(k, (1, 4, 5))).when(kind == "participation_count", _pick(k, (2, 3))).when(kind == "actor", _pick(k, (6, 7, 8))).when(kind == "bid", 9).otherwise(F.when(e % 300 == 7, 9).otherwise(10))
    n = F.when(e % 400 == 399, 99).otherwise(own)
    return claims_.withColumn("coverage_obligation_id", F.concat_ws("_", "deal_slug", F.lit("obligation"), n.cast("string")))


# Quotes: sentences by template, some of which leave out what they should hold.
QUO = """quo AS (
  SELECT *, CASE k % 5
      WHEN 0 THEN 'On ' || strftime(day, '%Y-%m-%d') || ', ' || label || ' submitted a bid of $' || CAST(round(value, 2) AS VARCHAR)
      WHEN 1 THEN label || ' made an offer in ' || strftime(day, '%B') || ' on day ' || CAST(day(day) AS VARCHAR) || ' of ' || CAST(year(day) AS VARCHAR) || ' at ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
      WHEN 2 THEN 'The board met with ' || label || ', an adviser and member of the group of ' || label2
      WHEN 3 THEN label || ' and ' || label2 || ' agreed on financing and a guarantee of 100'
      ELSE 'No one was named' END AS quote_text
  FROM clm)"""


def quoted_claims(claims_: DataFrame) -> DataFrame:
    k, day, v = F.col("k"), F.col("day"), F.col("value")
    q = (
        F.when(k % 5 == 0, F.concat(F.lit("On "), F.date_format(day, "yyyy-MM-dd"), F.lit(", "), "label", F.lit(" submitted a bid of $"), F.round(v, 2).cast("string")))
        .when(k % 5 == 1, F.concat("label", F.lit(" made an offer in "), F.date_format(day, "MMMM"), F.lit(" on day "), F.dayofmonth(day).cast("string"), F.lit(" of "), F.year(day).cast("string"), F.lit(" at "), F.floor(v).cast("string")))
        .when(k % 5 == 2, F.concat(F.lit("The board met with "), "label", F.lit(", an adviser and member of the group of "), "label2"))
        .when(k % 5 == 3, F.concat("label", F.lit(" and "), "label2", F.lit(" agreed on financing and a guarantee of 100")))
        .otherwise("No one was named")
    )
    return claims_.withColumn("quote_text", q)


# Cost records: each event as one provider call of its user.
COST = """cost AS (
  SELECT 'u' || user_id AS deal_slug, event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 997 AS INTEGER) END AS input_tokens, CAST(event_id % 101 AS INTEGER) AS output_tokens,
    CAST(event_id % 5000 AS INTEGER) AS latency_ms, CASE WHEN event_id % 50 = 0 THEN 1 END AS retry_count, CASE WHEN event_id % 77 = 0 THEN 'timeout' ELSE '' END AS provider_failure,
    CASE user_id % 3 WHEN 0 THEN 'actual' WHEN 1 THEN 'estimated' ELSE CASE event_id % 2 WHEN 0 THEN 'actual' ELSE 'estimated' END END AS token_source
  FROM events)"""


def cost_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), u.cast("string")).alias("deal_slug"), "event_id", F.when(e % 11 != 0, (e % 997).cast("int")).alias("input_tokens"), (e % 101).cast("int").alias("output_tokens"), (e % 5000).cast("int").alias("latency_ms"),
        F.when(e % 50 == 0, 1).alias("retry_count"), F.when(e % 77 == 0, "timeout").otherwise("").alias("provider_failure"),
        F.when(u % 3 == 0, "actual").when(u % 3 == 1, "estimated").otherwise(F.when(e % 2 == 0, "actual").otherwise("estimated")).alias("token_source"),
    )


# Dated rows of the events, for cycles.
DAT = """dat AS (
  SELECT 'u' || user_id AS slug, CAST(event_id AS VARCHAR) AS candidate_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS event_date,
    CAST(event_id % 10007 AS INTEGER) AS char_start, CAST(event_id % 10007 + 50 AS INTEGER) AS char_end, 'e' || event_id AS evidence_id FROM events)"""


def dated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("slug"), e.cast("string").alias("candidate_id"), F.when(e % 13 != 0, F.to_date("ts")).alias("event_date"),
        (e % 10007).cast("int").alias("char_start"), (e % 10007 + 50).cast("int").alias("char_end"), F.concat(F.lit("e"), e.cast("string")).alias("evidence_id"),
    )
