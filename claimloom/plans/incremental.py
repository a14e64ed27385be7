"""Ingest that redoes only what changed, and checks that read the sources again.

Every table is partitioned by slug. A filing's digest covers its text and form; filings whose digest is the stored one are left
out by an anti-join, and the partitions of the others are replaced whole, those of filings that are gone emptied. Digests
are written last, so a run that broke off is simply done again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.operators import evidence as E
from claimloom.operators import ingest as I
from claimloom.sources import sinks
from claimloom.sources.shared import stored

DIGESTS = "source_digests"


def filing_digest() -> Column:
    """A filing's digest: of its text, form and the parser's version, parted by NUL; null texts have one of their own."""
    return X.sha256(F.concat_ws("\0", F.lit(str(I.PARSER_VERSION)), F.coalesce("form_type", F.lit("")), F.coalesce(F.concat(F.lit("="), "text"), F.lit("null"))))


def _stored_digests(spark: SparkSession, out: str) -> DataFrame:
    schema = "source_digest string, deal_slug string"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/{DIGESTS}")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(f"{out}/{DIGESTS}") if there else spark.createDataFrame([], schema)


def changes(filings: DataFrame, out: str) -> DataFrame:
    """(deal_slug, source_digest, change): `new`, `changed` and `gone` slugs against the digests stored below `out`; unchanged ones are left out."""
    now = filings.select("deal_slug", filing_digest().alias("source_digest"))
    held = _stored_digests(filings.sparkSession, out).withColumnRenamed("source_digest", "old")
    both = now.join(held, "deal_slug", "full")
    what = F.when(F.col("source_digest").isNull(), "gone").when(F.col("old").isNull(), "new").when(F.col("old") != F.col("source_digest"), "changed")
    return both.select("deal_slug", "source_digest", what.alias("change")).where("change is not null")


def tables_of(filings: DataFrame) -> dict[str, DataFrame]:
    """What ingest makes of filings; a later table is made of the ones before it."""
    paragraphs = stored(I.paragraphs(filings), "paragraphs")
    spans, regions = I.seed_spans(paragraphs), E.regions(paragraphs)
    return {"filings": I.filings_summary(filings).join(filings.select("deal_slug", *(c for c in ("source_path",) if c in filings.columns)), "deal_slug"), "paragraphs": paragraphs, "spans": spans, "evidence_regions": regions, "coverage_obligations": E.obligations(regions)}


def ingest(filings: DataFrame, out: str) -> DataFrame:
    """Brings the tables below `out` up to date with filings (deal_slug, text, form_type, and source_path if there is one), and gives changes().

    One filing a slug; repeated slugs are an error, as their partition could hold only one. Only partitions of new,
    changed and gone slugs are written. A slug that is gone, or whose new text gives no row of a table, has an empty partition of it: none.
    """
    twice = filings.groupBy("deal_slug").count().where("count > 1").select("deal_slug").first()
    if twice:
        raise ValueError(f"more than one filing of {twice[0]}")
    found = stored(changes(filings, out), "changes")
    if found.isEmpty():
        return found
    todo = filings.join(found.where("change <> 'gone'").select("deal_slug"), "deal_slug", "left_semi")
    made = tables_of(todo)
    for name, df in made.items():
        sinks.replace_slugs(df.repartition("deal_slug"), f"{out}/{name}")
        _emptied(found.join(df.select("deal_slug").distinct(), "deal_slug", "left_anti"), f"{out}/{name}")
    sinks.replace_slugs(found.where("change <> 'gone'").select("source_digest", "deal_slug").repartition("deal_slug"), f"{out}/{DIGESTS}")
    _emptied(found.where("change = 'gone'"), f"{out}/{DIGESTS}")
    return found


def _emptied(slugs: DataFrame, path: str) -> None:
    """Takes the partitions of slugs away, as far as they are there; folders only, slug by slug as they stream in."""
    spark = slugs.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in slugs.select("deal_slug").distinct().toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/deal_slug={escape(r[0])}")
        folder.getFileSystem(conf).delete(folder, True)


def plain_path(path: Column) -> Column:
    """A file's path without the scheme of a local store."""
    return F.regexp_replace(path, "^file:/+", "/")


def source_files(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """(path, file_sha256, text) of each file below a folder, at any depth; the digest is of its bytes, the text has universal newlines."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return I.universal_newlines(files.select(plain_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("file_sha256"), F.decode("content", "UTF-8").alias("text")))


def resolved(filings: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """filings (filing_id, source_path, raw_sha256) with `path` and `text` of the file that a source path means, null where there is none.

    The candidates are, in this order: an absolute path itself, the path below the root, the file's name below the
    root. Any number of filings may mean one file.
    """
    given = plain_path(F.col("source_path"))
    base = plain_path(F.lit(root.rstrip("/") + "/"))
    candidates = F.array(F.when(given.startswith("/"), given), F.concat(base, F.regexp_replace(given, "^/+", "")), F.concat(base, F.regexp_extract(given, "([^/]*)/*$", 1)))
    asked = filings.where("source_path <> ''").select("filing_id", F.posexplode(candidates).alias("rank", "path")).where("path is not null")
    best = asked.join(files.select("path").distinct(), "path").groupBy("filing_id").agg(F.min_by("path", "rank").alias("path"))
    return filings.join(best, "filing_id", "left").join(files.select("path", "text"), "path", "left")


def source_failures(found: DataFrame) -> DataFrame:
    """Filings of resolved() that their file doesn't bear out: (check_name, table_name, row_id, detail)."""
    lacks = F.coalesce(F.col("source_path"), F.lit("")) == ""
    detail = F.when(lacks, "missing source_path").when(F.col("path").isNull(), "source file is missing").when(X.sha256(F.col("text")) != F.col("raw_sha256"), "raw_sha256 differs from the source file")
    return found.select(F.lit("source_truth").alias("check_name"), F.lit("filings").alias("table_name"), F.col("filing_id").alias("row_id"), detail.alias("detail")).where("detail is not null")


def validate_sources(out: str, files: DataFrame, root: str) -> DataFrame:
    """The failures of the tables below `out` against the files as they are now: of filings, and of the spans of those that still stand."""
    from claimloom.operators import validate as Q

    spark = files.sparkSession
    filings = spark.read.parquet(f"{out}/filings").select("filing_id", "source_path", "raw_sha256")
    found = stored(resolved(filings, files, root), "resolved")
    bad = source_failures(found)
    good = found.join(bad.select(F.col("row_id").alias("filing_id")), "filing_id", "left_anti").select("filing_id", "text", "raw_sha256")
    spans = spark.read.parquet(f"{out}/spans").join(good.select("filing_id"), "filing_id", "left_semi")
    return bad.unionByName(Q.source_truth(spans, good))
