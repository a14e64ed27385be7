"""A repeated ingest rewrites only what changed, and changed files fail the check of sources."""

import os

from pyspark.sql import functions as F

from claimloom import __main__ as cli
from claimloom.operators import ingest as I
from claimloom.plans import incremental as N
from claimloom.sources import tables

TEXT = "<!-- PAGE 1 -->\n**Background of the Merger**\n\nOn March 5, 2014, Party {0} bid.\n\nMore of {0}.\n"


def written(folder):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def slugs(paths):
    return {p.split("deal_slug=")[1].split("/")[0] for p in paths}


def test_only_changed_filings_are_written_again(spark, tmp_path):
    files, out = tmp_path / "f", str(tmp_path / "out")
    files.mkdir()
    for i in range(50):
        (files / f"deal{i}.md").write_text(TEXT.format(i))
    read = lambda: tables.example_filings(spark, str(files)).withColumn("form_type", F.lit("DEFM14A"))
    assert {r["change"] for r in N.ingest(read(), out).collect()} == {"new"}
    first = written(out)
    assert slugs(first) == {f"deal{i}" for i in range(50)}
    assert N.ingest(read(), out).count() == 0 and written(out) == first

    (files / "deal7.md").write_text(TEXT.format("seven") + "\nand a paragraph\n")
    assert sorted((r["row_id"], r["detail"]) for r in N.validate_sources(out, N.source_files(spark, str(files)), str(files)).collect()) == [("deal7_filing_1", "raw_sha256 differs from the source file")]
    assert [tuple(r) for r in N.ingest(read(), out).select("deal_slug", "change").collect()] == [("deal7", "changed")]
    second = written(out)
    assert {p for p in first if second.get(p) != first[p]} and slugs(p for p in {**first, **second} if first.get(p) != second.get(p)) == {"deal7"}
    assert N.validate_sources(out, N.source_files(spark, str(files)), str(files)).count() == 0
    assert spark.read.parquet(f"{out}/paragraphs").where("deal_slug = 'deal7'").count() == 5

    (files / "deal8.md").unlink()
    (files / "deal9.md").write_text("no section at all")
    assert sorted(tuple(r) for r in N.ingest(read(), out).select("deal_slug", "change").collect()) == [("deal8", "gone"), ("deal9", "changed")]
    for name in ("filings", "paragraphs", "spans", "evidence_regions", "coverage_obligations", N.DIGESTS):
        left = {r[0] for r in spark.read.parquet(f"{out}/{name}").select("deal_slug").distinct().collect()}
        assert "deal8" not in left and ("deal9" in left) == (name not in ("evidence_regions", "coverage_obligations")) and len(left) >= 48

    whole = I.paragraphs(read()).select("paragraph_id", "paragraph_hash")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, spark.read.parquet(f"{out}/paragraphs").select("paragraph_id", "paragraph_hash").collect()))


def test_a_run_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    filings = spark.createDataFrame([("a", TEXT.format(1), ""), ("b", None, None)], "deal_slug string, text string, form_type string")
    out = str(tmp_path / "out")
    whole = N.sinks.replace_slugs

    def broken(df, path, slug="deal_slug"):
        if path.endswith("coverage_obligations"):
            raise OSError("gone")
        whole(df, path, slug)

    monkeypatch.setattr(N.sinks, "replace_slugs", broken)
    try:
        N.ingest(filings, out)
    except OSError:
        pass
    monkeypatch.undo()
    assert {r["change"] for r in N.changes(filings, out).collect()} == {"new"}
    N.ingest(filings, out)
    assert N.changes(filings, out).count() == 0 and spark.read.parquet(f"{out}/coverage_obligations").count() > 0


def test_source_paths(spark):
    files = spark.createDataFrame([("/r/x/a.md", "A"), ("/r/a.md", "B"), ("/r/x/x/a.md", "C"), ("/r/b.md", "D")], "path string, text string")
    sha = F.sha2(F.col("t"), 256)
    rows = [("1", "/r/x/a.md", "A"), ("2", "x/a.md", "A"), ("3", "elsewhere/b.md", "D"), ("4", "a.md", "wrong"), ("5", "", "x"), ("6", None, "x"), ("7", "no/where.md", "x"), ("8", "/r/x/a.md", "A"), ("9", "file:/r/a.md", "B")]
    filings = spark.createDataFrame(rows, "filing_id string, source_path string, t string").withColumn("raw_sha256", sha).drop("t")
    found = N.resolved(filings, files, "/r")
    assert {r["filing_id"]: r["text"] for r in found.collect()} == {"1": "A", "2": "A", "3": "D", "4": "B", "5": None, "6": None, "7": None, "8": "A", "9": "B"}
    assert sorted((r["row_id"], r["detail"]) for r in N.source_failures(found).collect()) == [("4", "raw_sha256 differs from the source file"), ("5", "missing source_path"), ("6", "missing source_path"), ("7", "source file is missing")]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "one.md").write_bytes(TEXT.format(1).replace("\n", "\r\n").encode())
    for said in ("new 1", ""):
        cli.main(["ingest", "--examples", "--filings", str(tmp_path / "f"), "--out", str(tmp_path / "o")])
        assert capsys.readouterr().out.strip() == said
    cli.main(["validate", "--filings", str(tmp_path / "f"), "--out", str(tmp_path / "o")])
    assert capsys.readouterr().out == ""
    (tmp_path / "f" / "one.md").unlink()
    (tmp_path / "f" / "two.md").write_text("x")
    cli.main(["validate", "--filings", str(tmp_path / "f"), "--out", str(tmp_path / "o")])
    assert capsys.readouterr().out == "filings one_filing_1 source file is missing\n"
