"""Lines, paragraphs and spans against a sequential model, and a whole run."""

import json
import re

import pytest
from pyspark.sql import functions as F

from claimloom.operators import ingest as I
from claimloom.plans import run as kernel
from claimloom.sources import sinks, tables

RAW = "ZEQ.=1\n<!-- PAGE 3 -->\nTable of Contents\n**Background of the Merger**\n\nOn March 5, 2014, Party A submitted a bid of $10.50.\nIt went on\n12\nafter a page.\n \nParty A is a member of Buyer Group.\n\nFinancing\nCOMMAND=X\nCOMMAND=Y Background of X\nlast"


def model(raw):
    """Blocks as (start, end): contiguous lines that are neither blank nor noise; a marker alone."""
    out, at, current = [], 0, None
    for line in re.findall(r"[^\n]*\n|[^\n]+", raw):
        end, bare = at + len(line), line.strip()
        noise = bare.startswith("ZEQ.=") or bare in ("Table of Contents", "TOC_END") or re.fullmatch(r"\d{1,4}", bare) or (bare.startswith("COMMAND=") and " Background of " not in bare)
        if noise:
            current = None
        elif re.search(r"<!--\s*PAGE", line):
            out.append([at, end])
            current = None
        elif not bare:
            current = None
        elif current is None:
            current = [at, end]
            out.append(current)
        else:
            current[1] = end
        at = end
    return [tuple(x) for x in out]


@pytest.fixture
def filings(spark):
    return spark.createDataFrame([("a-b", RAW, ""), ("c", "x\n\nBackground of the Merger\ny", "DEFM14A"), ("e", "", ""), ("n", None, "")], "deal_slug string, text string, form_type string")


def test_paragraphs(filings):
    rows = {s: sorted(r for r in I.paragraphs(filings).collect() if r["deal_slug"] == s) for s in ("a-b", "c", "e")}
    found = sorted(I.paragraphs(filings).where("deal_slug = 'a-b'").collect(), key=lambda r: r["n"])
    assert [(r["char_start"], r["char_end"]) for r in found] == model(RAW)
    assert all(RAW[r["char_start"] : r["char_end"]] == r["paragraph_text"] for r in found)
    assert found[0]["page_hint"] == 3 and found[0]["section"] == "unknown_section" and found[-1]["section"] == "Financing"
    assert len(rows["c"]) == 2 and rows["e"] == []


def test_removals_round_trip(filings):
    log = I.removals(filings).where("deal_slug = 'a-b'").collect()
    assert sorted(r["rule_id"] for r in log) == ["isolated_folio", "printer_command", "table_of_contents", "zeq_banner"]
    assert all(RAW[r["char_start"] : r["char_end"]] == r["removed_text"] for r in log)


def payload(quote="On March 5, 2014, Party A submitted a bid of $10.50."):
    common = {"confidence": "high"}
    return json.dumps({
        "actor_claims": [common | {"claim_type": "actor", "coverage_obligation_id": "a-b_obligation_6", "quote_text": "Buyer Group", "actor_label": "Buyer Group", "actor_kind": "group", "observability": "named"}],
        "bid_claims": [common | {"claim_type": "bid", "coverage_obligation_id": "a-b_obligation_9", "quote_text": quote, "bidder_label": "Party A", "bid_date": "2014-03-05", "bid_value": 10.5, "bid_value_lower": None, "bid_value_upper": None, "bid_value_unit": None, "consideration_type": None, "bid_stage": "final"}],
        "actor_relation_claims": [common | {"claim_type": "actor_relation", "coverage_obligation_id": "a-b_obligation_10", "quote_text": "Party A is a member of Buyer Group.", "subject_label": "Party A", "object_label": "Buyer Group", "relation_type": "member_of", "role_detail": None, "effective_date_first": None}],
    })


RUN = "2024-01-01T000000Z_test_0123abcd"


def provider(spark, text):
    return lambda requests: requests.select("request_id", F.lit(text).alias("payload"))


def test_run(spark, filings, tmp_path):
    one = filings.where("deal_slug = 'a-b'")
    proof = kernel.run(spark, one, provider(spark, payload()), str(tmp_path / "r"), RUN)
    assert proof["verdict"] == "SUSPECT" and proof["live_claims"] == 3 and proof["bidder_rows"] == 1 and proof["failures"] == 0
    row = spark.read.parquet(str(tmp_path / "r" / "bidder_rows")).first()
    assert (row["actor_label"], row["bI"], row["bF"]) == ("Party A", 10.5, 10.5)
    actors = spark.read.parquet(str(tmp_path / "r" / "actors")).orderBy("actor_id").collect()
    assert [(r["actor_id"], r["label"]) for r in actors] == [("a-b_actor_1", "A B"), ("a-b_actor_2", "Buyer Group"), ("a-b_actor_3", "Party A")]
    report = json.loads((tmp_path / "r" / "validation_report.json").read_text())
    assert report["passed"] and report["hard_failures"] == 0 and set(report) == {"passed", "hard_failures", *kernel.CHECKS}
    request = spark.read.parquet(str(tmp_path / "r" / "requests")).first()
    assert json.loads(request["schema"])["properties"]["bid_claims"]["items"]["properties"]["coverage_obligation_id"]["enum"] == ["a-b_obligation_9"]
    again = kernel.run(spark, one, provider(spark, payload()), str(tmp_path / "r"), RUN)
    assert again == proof
    with pytest.raises(ValueError, match="another configuration"):
        kernel.run(spark, one, provider(spark, payload()), str(tmp_path / "r"), RUN, "quarantine")


def test_run_refuses_whole_requests(spark, filings, tmp_path):
    one = filings.where("deal_slug = 'a-b'")
    with pytest.raises(ValueError, match="quote_absent"):
        kernel.run(spark, one, provider(spark, payload("not there")), str(tmp_path / "a"), RUN)
    with pytest.raises(ValueError, match="bad"):
        kernel.run(spark, one, provider(spark, payload().replace('"group"', '"martian"')), str(tmp_path / "d"), RUN)
    with pytest.raises(ValueError, match="no claims"):
        kernel.run(spark, one, provider(spark, payload("not there")), str(tmp_path / "b"), RUN, "quarantine")
    with pytest.raises(ValueError, match="no background"):
        kernel.run(spark, filings.where("deal_slug in ('a-b', 'c')").withColumn("text", F.lit("plain")), provider(spark, "{}"), str(tmp_path / "c"), RUN)


def test_sources(spark, tmp_path):
    for slug, form in (("one", "defm14a"), ("two", None)):
        (tmp_path / "f" / slug).mkdir(parents=True)
        (tmp_path / "f" / slug / "raw.md").write_bytes(b"a\r\nb\rc")
        if form:
            (tmp_path / "f" / slug / "manifest.json").write_text(json.dumps({"source": {"form_type": form}}, indent=1))
    found = {r["deal_slug"]: r for r in tables.filings(spark, str(tmp_path / "f")).collect()}
    assert found["one"]["text"] == "a\nb\nc" and found["one"]["form_type"] == "DEFM14A" and not found["two"]["has_manifest"]
    wanted = spark.createDataFrame([("one",), ("three",)], "deal_slug string")
    with pytest.raises(ValueError, match="three"):
        tables.require_none(tables.missing(wanted, tables.filings(spark, str(tmp_path / "f"))), "not found")
    (tmp_path / "seeds.csv").write_text("deal_slug,target_name,acquirer,date_announced,primary_url,is_reference\na,T,Q,2014-01-01,u, TRUE \nb,T,Q,2014-01-01,u,\n")
    assert [r["is_reference"] for r in tables.seeds(spark, str(tmp_path / "seeds.csv")).orderBy("deal_slug").collect()] == [True, False]


def test_sinks(spark, tmp_path):
    sinks.append_jsonl(tmp_path / "l.jsonl", {"b": 1, "a": 2})
    sinks.append_jsonl(tmp_path / "l.jsonl", {"a": 3})
    assert (tmp_path / "l.jsonl").read_text() == '{"a": 2, "b": 1}\n{"a": 3}\n'
    for bad in ({"my_API_key": 1}, {"x": [{"y": "sk-123"}]}):
        with pytest.raises(sinks.SecretError):
            sinks.write_json(tmp_path / "x.json", bad)
    assert not (tmp_path / "x.json").exists()
    df = spark.createDataFrame([("a", 1), ("a_b", 2)], "deal_slug string, v int")
    sinks.replace_slugs(df, str(tmp_path / "t"))
    sinks.replace_slugs(df.where("v = 1").withColumn("v", F.lit(9)), str(tmp_path / "t"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("deal_slug", "v").collect()) == [("a", 9), ("a_b", 2)]


def test_kernel(tmp_path):
    digest = kernel.config_hash({"a": 1})
    assert kernel.clock(RUN, digest) == kernel.clock(RUN, digest) != kernel.clock(RUN, digest, "x")
    with pytest.raises(ValueError):
        kernel.parse_run_id("2024_x_0")
    with kernel.locked(tmp_path), pytest.raises(RuntimeError):
        with kernel.locked(tmp_path):
            pass
    kernel.corpus_skeleton(str(tmp_path / "c"), RUN, ["a", "b", "c"], [{"deal_count": 3}], 2)
    assert [json.loads(x)["shard_id"] for x in (tmp_path / "c" / "corpus_manifest.jsonl").read_text().splitlines()] == ["shard-0001", "shard-0001", "shard-0002"]
    with pytest.raises(FileExistsError):
        kernel.corpus_skeleton(str(tmp_path / "c"), RUN, ["a"], [])


def test_request_schema_is_closed():
    from claimloom.operators import contract

    schema = json.loads(contract.request_schema())
    assert not schema["additionalProperties"] and schema["required"] == list(contract.FIELDS)
    for name, array in schema["properties"].items():
        item = array["items"]
        assert not item["additionalProperties"] and sorted(item["required"]) == sorted(item["properties"]) == sorted(contract.FIELDS[name])
        assert item["properties"]["claim_type"]["enum"] == [name.removesuffix("_claims")]
    assert schema["properties"]["event_claims"]["items"]["properties"]["actor_role"]["type"] == ["string", "null"]
