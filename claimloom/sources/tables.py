"""Sources: markdown filings, manifests, seeds, ledgers, index pages. All are read by Spark, so any store will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V
from claimloom.operators.ingest import universal_newlines

SEEDS = "deal_slug string, target_name string, acquirer string, date_announced string, primary_url string, is_reference string"
MANIFEST = "source struct<filing_form_type: string, form_type: string>"


def _named(df: DataFrame, pattern: str) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select("*", path.alias("source_path"), F.regexp_extract(path, pattern, 1).alias("deal_slug"))


def example_filings(spark: SparkSession, folder: str) -> DataFrame:
    """(deal_slug, source_path, text) of each markdown file of a folder but README; the slug is the file's name."""
    files = _named(spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True), r"([^/]+)\.md$")
    return universal_newlines(files.where("deal_slug <> 'README'").select("deal_slug", "source_path", F.col("value").alias("text")))


def filings(spark: SparkSession, folder: str) -> DataFrame:
    """(deal_slug, source_path, text, form_type, has_manifest) of `<folder>/<slug>/raw.md` with its manifest.json."""
    raw = _named(spark.read.text(f"{folder}/*/raw.md", wholetext=True), r"([^/]+)/raw\.md$").select("deal_slug", "source_path", F.col("value").alias("text"))
    found = _named(spark.read.schema(MANIFEST).json(f"{folder}/*/manifest.json", multiLine=True), r"([^/]+)/manifest\.json$")
    form = F.coalesce(F.nullif(F.col("source.filing_form_type"), F.lit("")), F.col("source.form_type"), F.lit(""))
    manifests = found.select("deal_slug", F.upper(form).alias("form_type"), F.lit(True).alias("has_manifest"))
    return universal_newlines(raw.join(manifests, "deal_slug", "left").withColumn("has_manifest", F.coalesce("has_manifest", F.lit(False))))


def missing(wanted: DataFrame, found: DataFrame, key: str = "deal_slug") -> DataFrame:
    """Wanted keys that were not found: a run must stop at any."""
    return wanted.select(key).distinct().join(found.select(key), key, "left_anti")


def require_none(bad: DataFrame, what: str, key: str = "deal_slug") -> None:
    """Raises with up to ten keys if there is any row."""
    rows = bad.select(key).limit(10).collect()
    if rows:
        raise ValueError(f"{what}: {', '.join(str(r[0]) for r in rows)}")


def seeds(spark: SparkSession, path: str) -> DataFrame:
    """The seeds table, is_reference as a boolean."""
    rows = spark.read.csv(path, header=True, schema=SEEDS)
    return rows.withColumn("is_reference", F.coalesce(F.lower(F.trim("is_reference")) == "true", F.lit(False)))


def ledger(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A file of JSON lines; blank lines are skipped."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


# Fixed value: a row of an index page's table of documents.
INDEX_ROW = r'<a href="([^"]+\.(?:htm|html))"[^>]*>([^<]+)</a>\s*</td>\s*<td[^>]*>([^<]*)</td>\s*<td[^>]*>([^<]*)</td>'


def index_rows(pages: DataFrame, html_col: str = "html", site: str = "") -> DataFrame:
    """(all other columns, pos, name, form_type, size_bytes, url) of each document row of index pages."""
    group = lambda i: F.regexp_extract_all(html_col, F.lit("(?i)" + INDEX_ROW), F.lit(i))
    rows = pages.select(*(c for c in pages.columns if c != html_col), F.posexplode(F.arrays_zip(group(1).alias("href"), group(2).alias("name"), group(3).alias("form"), group(4).alias("size"))).alias("pos", "r"))
    href = F.col("r.href")
    url = F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site), href))
    size = F.when(F.trim("r.size").rlike("^[0-9]+$"), F.trim("r.size").try_cast("int"))
    return rows.select(*(c for c in rows.columns if c != "r"), F.trim("r.name").alias("name"), F.trim("r.form").alias("form_type"), size.alias("size_bytes"), url.alias("url"))


def primary_documents(rows: DataFrame, key: str = "filing") -> DataFrame:
    """(key, outcome, url): the document with the narrative of each filing of (key, pos, form_type, url).

    The first of a primary form, else the first that is no exhibit. outcome is `primary`; `exhibit` for a tender
    offer, whose first matching exhibit it is; `excluded`, `unknown_form`, `no_primary` or `no_exhibit`, with a
    null url, where a run must stop.
    """
    doc, pos = F.struct("form_type", "url"), F.col("pos")
    first = lambda when: F.min_by(doc, F.when(when, pos))
    form = F.col("form_type")
    best = rows.groupBy(key).agg(
        first(form.isin(V.PRIMARY_FORMS)).alias("main"), first(~F.upper(form).startswith("EX-")).alias("other"), first(form.rlike("(?i)" + V.OFFER_EXHIBIT)).alias("offer"),
    ).withColumn("doc", F.coalesce("main", "other"))
    chosen = F.col("doc.form_type")
    outcome = (
        F.when(F.col("doc").isNull(), "no_primary").when(chosen.isin(V.EXCLUDED_FORMS), "excluded").when(~chosen.isin(V.PRIMARY_FORMS), "unknown_form")
        .when(chosen.isin(V.TENDER_FORMS), F.when(F.col("offer").isNull(), "no_exhibit").otherwise("exhibit")).otherwise("primary")
    )
    return best.withColumn("outcome", outcome).select(key, "outcome", F.when(F.col("outcome") == "primary", F.col("doc.url")).when(F.col("outcome") == "exhibit", F.col("offer.url")).alias("url"))


def joined_pages(pages: DataFrame, key: str = "deal_slug") -> DataFrame:
    """(key, text): pages of (key, page_no, text) as one text, each below its marker."""
    one = F.concat(F.lit("\n<!-- PAGE "), F.col("page_no").cast("string"), F.lit(" -->\n"), F.coalesce("text", F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("page_no", one.alias("t"))))
    return pages.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("text"))
