"""Evidence regions, coverage obligations, and the windows and prompts made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V
from claimloom.functions.ids import make_id

REGION_KIND = "sale_process_narrative"


def regions(paragraphs: DataFrame) -> DataFrame:
    """One region for each filing with paragraphs of the background section, which need not be contiguous."""
    chosen = paragraphs.where(F.col("section") == V.BACKGROUND)
    ordered = F.array_sort(F.collect_list(F.struct("char_start", "paragraph_id")))
    found = chosen.groupBy("deal_slug", "filing_id").agg(F.transform(ordered, lambda s: s["paragraph_id"]).alias("paragraph_ids"))
    types = F.array(*(F.lit(t) for t in dict.fromkeys(t for t, _, _ in V.OBLIGATIONS)))
    return found.select(
        make_id(F.col("deal_slug"), "region", F.lit(1)).alias("region_id"), "filing_id", "deal_slug", F.lit(REGION_KIND).alias("region_kind"), F.lit(1).alias("priority"),
        F.element_at("paragraph_ids", 1).alias("start_paragraph_id"), F.element_at("paragraph_ids", -1).alias("end_paragraph_id"), "paragraph_ids", types.alias("expected_claim_types"),
    )


def without_background(paragraphs: DataFrame) -> DataFrame:
    """Filings that have no background section: a run must not go on with them."""
    return paragraphs.groupBy("deal_slug").agg(F.count_if(F.col("section") == V.BACKGROUND).alias("n")).where("n = 0").select("deal_slug")


def obligations(slugs: DataFrame) -> DataFrame:
    """The fixed obligations of each slug of (deal_slug, region_id, filing_id)."""
    fixed = F.array(*(F.struct(F.lit(i).alias("n"), F.lit(t).alias("expected_claim_type"), F.lit(label).alias("obligation_label"), F.lit(w).alias("importance")) for i, (t, label, w) in enumerate(V.OBLIGATIONS, 1)))
    rows = slugs.select("deal_slug", "region_id", "filing_id", F.explode(fixed).alias("o"))
    return rows.select(make_id(F.col("deal_slug"), "obligation", F.col("o.n")).alias("obligation_id"), "region_id", "filing_id", "deal_slug", "o.expected_claim_type", "o.obligation_label", "o.importance", F.lit(True).alias("current"))


def window_paragraphs(regions_: DataFrame, paragraphs: DataFrame, spans: DataFrame) -> DataFrame:
    """The paragraphs of each region in their listed order, with their seed spans."""
    wanted = regions_.select("region_id", F.posexplode("paragraph_ids").alias("pos", "paragraph_id"))
    seeds = spans.where("span_kind = 'paragraph_seed'").select("paragraph_id", F.col("evidence_id").alias("source_span_id"))
    return wanted.join(paragraphs, "paragraph_id").join(seeds, "paragraph_id").select("region_id", "pos", "paragraph_id", "source_span_id", "char_start", "char_end", "paragraph_text")


def windows(regions_: DataFrame, window_paragraphs_: DataFrame, obligations_: DataFrame) -> DataFrame:
    """One request for each region: ordered paragraphs and obligations as arrays."""
    texts = window_paragraphs_.groupBy("region_id").agg(F.array_sort(F.collect_list(F.struct("pos", "paragraph_id", "source_span_id", "char_start", "char_end", "paragraph_text"))).alias("ordered_paragraphs"))
    duties = obligations_.withColumn("n", F.regexp_extract("obligation_id", "_([0-9]+)$", 1).cast("int")).groupBy("region_id").agg(F.array_sort(F.collect_list(F.struct("n", "obligation_id", "expected_claim_type", "obligation_label", "importance"))).alias("coverage_obligations"))
    slug = F.col("deal_slug")
    head = regions_.select(make_id(slug, "llmrequest", F.lit(1)).alias("request_id"), make_id(slug, "window", F.lit(1)).alias("window_id"), "region_id", "filing_id", "deal_slug", "region_kind", F.col("expected_claim_types").alias("allowed_claim_types"))
    return head.join(texts, "region_id").join(duties, "region_id")


def prompt_text(windows_: DataFrame) -> DataFrame:
    """(request_id, prompt): the obligations of each allowed type, then the paragraphs, as one text."""
    duty = lambda o: F.concat(F.lit("- "), o["obligation_id"], F.lit(": "), o["importance"], F.lit(" | "), o["obligation_label"])
    section = lambda t: F.concat_ws("\n", F.concat(t, F.lit(":")), F.array_join(F.transform(F.filter("coverage_obligations", lambda o: o["expected_claim_type"] == t), duty), "\n"))
    used = F.filter("allowed_claim_types", lambda t: F.exists("coverage_obligations", lambda o: o["expected_claim_type"] == t))
    duties = F.array_join(F.transform(used, section), "\n")
    texts = F.array_join(F.transform("ordered_paragraphs", lambda p: F.concat(F.lit("["), p["paragraph_id"], F.lit("]\n"), p["paragraph_text"])), "\n\n")
    head = F.concat(F.lit("deal: "), F.col("deal_slug"), F.lit("\nfiling: "), F.col("filing_id"), F.lit("\nregion: "), F.col("region_id"), F.lit("\n"))
    return windows_.select("request_id", F.concat(head, F.lit("Coverage obligations:\n"), duties, F.lit("\n\nWindow paragraphs:\n"), texts).alias("prompt"))
