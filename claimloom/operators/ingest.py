"""Filings to clean lines, paragraphs, sections and hashed evidence spans.

Input is a DataFrame of filings (deal_slug, text, and for summaries source_path and form_type). Everything is keyed
by deal_slug, so one shuffle by slug serves all windows of a filing, and order comes from line numbers alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions.ids import make_id

PARSER_VERSION = 1
MARKER = r"<!--\s*PAGE\s+[0-9]+\s*-->"


def universal_newlines(df: DataFrame, col: str = "text") -> DataFrame:
    """Carriage returns, with or without a line feed, become line feeds; to be done before hashes and offsets."""
    return df.withColumn(col, F.regexp_replace(col, "\r\n?", "\n"))


def lines(filings: DataFrame) -> DataFrame:
    """(deal_slug, pos, line, char_start, char_end, bare, rule): every line with its newline and code point offsets."""
    parts = filings.select("deal_slug", F.posexplode(F.filter(F.split("text", r"(?<=\n)"), lambda x: x != "")).alias("pos", "line"))
    before = Window.partitionBy("deal_slug").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("char_start", F.coalesce(F.sum(F.length("line")).over(before), F.lit(0)).cast("int"))
    placed = placed.withColumn("char_end", F.col("char_start") + F.length("line")).withColumn("bare", X.stripped(F.col("line")))
    return placed.withColumn("rule", X.removal_rule(F.col("bare")))


def removals(filings: DataFrame) -> DataFrame:
    """The log of removed lines, by rule."""
    return lines(filings).where("rule is not null").select("deal_slug", F.col("rule").alias("rule_id"), "char_start", "char_end", F.col("line").alias("removed_text"))


def blocks(filings: DataFrame) -> DataFrame:
    """(deal_slug, char_start, char_end, paragraph_text, page_hint): runs of lines that are contiguous in the raw text.

    A blank line, a page marker (a block of its own) and a removed line each end a block.
    """
    order = Window.partitionBy("deal_slug").orderBy("pos")
    kept = lines(filings).where("rule is null")
    kept = kept.withColumn("marker", F.col("line").rlike(MARKER)).withColumn("blank", F.col("bare") == "")
    held = F.lag(F.struct("marker", "blank", "char_end")).over(order)
    opens = F.col("marker") | F.col("blank") | held.isNull() | held["marker"] | held["blank"] | (held["char_end"] != F.col("char_start"))
    marked = kept.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
    here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("block", F.sum("opens").over(here)).withColumn("page", F.last(F.when(F.col("marker"), X.page_number(F.col("line"))), ignorenulls=True).over(here))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "")
    grouped = marked.where(~F.col("blank")).groupBy("deal_slug", "block")
    return grouped.agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), text.alias("paragraph_text"), F.max("page").alias("page_hint")).drop("block")


def paragraphs(filings: DataFrame) -> DataFrame:
    """Numbered paragraphs with the section whose heading was last seen, and their hash."""
    order = Window.partitionBy("deal_slug").orderBy("char_start")
    found = blocks(filings).withColumn("n", F.row_number().over(order)).withColumn("heading", X.section_heading(F.col("paragraph_text")))
    section = F.coalesce(F.last("heading", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit("unknown_section"))
    slug = F.col("deal_slug")
    return found.select(
        "deal_slug", "n", make_id(slug, "para", F.col("n")).alias("paragraph_id"), make_id(slug, "filing", F.lit(1)).alias("filing_id"),
        section.alias("section"), "page_hint", "char_start", "char_end", "paragraph_text", X.sha256(F.col("paragraph_text")).alias("paragraph_hash"),
    )


def seed_spans(paragraphs_: DataFrame) -> DataFrame:
    """One evidence span for each paragraph."""
    return paragraphs_.select(
        "deal_slug", make_id(F.col("deal_slug"), "evidence", F.col("n")).alias("evidence_id"), "filing_id", "paragraph_id",
        F.lit("raw_md").alias("span_basis"), F.lit("paragraph_seed").alias("span_kind"), F.lit(None).cast("string").alias("parent_evidence_id"), F.lit("ingest").alias("created_by_stage"),
        "char_start", "char_end", F.col("paragraph_text").alias("quote_text"), F.col("paragraph_hash").alias("quote_text_hash"),
        X.fingerprint(F.col("filing_id"), F.col("char_start"), F.col("char_end"), F.col("paragraph_hash")).alias("evidence_fingerprint"),
    )


def filings_summary(filings: DataFrame) -> DataFrame:
    """One row for each filing: hash, pages, known sections, scope of its form type."""
    marker = "<!-- PAGE "
    pages = ((F.length("text") - F.length(F.replace(F.col("text"), F.lit(marker), F.lit("")))) / len(marker)).cast("int")
    known = paragraphs(filings).where("section <> 'unknown_section'").groupBy("deal_slug").agg(F.count_distinct("section").cast("int").alias("section_count"))
    form = F.col("form_type") if "form_type" in filings.columns else F.lit("")
    rows = filings.select("deal_slug", make_id(F.col("deal_slug"), "filing", F.lit(1)).alias("filing_id"), X.sha256(F.col("text")).alias("raw_sha256"), F.lit(PARSER_VERSION).alias("parser_version"), pages.alias("page_count"), X.process_scope(form).alias("process_scope"))
    return rows.join(known, "deal_slug", "left").withColumn("section_count", F.coalesce("section_count", F.lit(0)))
