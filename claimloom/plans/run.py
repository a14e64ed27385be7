"""A run on the driver: identifiers, clock, lock, ledgers, and the stages from filings and payloads to artifacts."""

from __future__ import annotations

import contextlib
import datetime as dt
import fcntl
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V
from claimloom.functions.ids import make_id
from claimloom.operators import claims as C
from claimloom.operators import contract as K
from claimloom.operators import evidence as E
from claimloom.operators import ingest as I
from claimloom.operators import outcomes as O
from claimloom.operators import project as P
from claimloom.operators import reconcile as R
from claimloom.operators import validate as Q
from claimloom.sources import sinks

RUN_ID = re.compile(r"^(?P<stamp>\d{4}-\d{2}-\d{2}T\d{6}Z)_(?P<scope>[a-z0-9][a-z0-9-]*)_(?P<digest>[0-9a-f]{8})$")
STAMP = "%Y-%m-%dT%H%M%SZ"
#: A provider: from requests (request_id, prompt, ...) to (request_id, payload). The boundary to any network.
Provider = Callable[[DataFrame], DataFrame]


def config_hash(config: dict) -> str:
    """The hash of a configuration as compact sorted JSON; secret-like keys are refused."""
    sinks.reject_secrets(config)
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def make_run_id(scope: str, started: dt.datetime, digest: str) -> str:
    if started.tzinfo is None:
        raise ValueError("the start must have a time zone")
    run_id = f"{started.astimezone(dt.UTC).strftime(STAMP)}_{scope}_{digest[:8]}"
    parse_run_id(run_id)
    return run_id


def parse_run_id(run_id: str) -> dict[str, str]:
    m = RUN_ID.match(run_id)
    if not m:
        raise ValueError("a run id is YYYY-MM-DDTHHMMSSZ_scope_hash")
    dt.datetime.strptime(m["stamp"], STAMP)
    return m.groupdict()


def clock(run_id: str, digest: str, label: str = "run", sequence: int = 0) -> str:
    """A time within a day of the run's start that follows from its configuration, label and sequence alone."""
    start = dt.datetime.strptime(parse_run_id(run_id)["stamp"], STAMP)
    offset = int(hashlib.sha256(f"{digest}\0{label}\0{sequence}".encode()).hexdigest()[:8], 16) % 86400
    return (start + dt.timedelta(seconds=offset)).strftime("%Y-%m-%dT%H:%M:%SZ")


@contextlib.contextmanager
def locked(folder: str | Path) -> Iterator[None]:
    """One run at a time in a folder; a second one fails at once."""
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    with (path / "run.lock").open("w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            raise RuntimeError(f"another run holds {path}") from e
        yield


def check_resume(folder: str | Path, digest: str) -> None:
    """A folder of a run of another configuration is refused."""
    path = Path(folder) / "manifest.json"
    if path.exists() and json.loads(path.read_text())["config_hash"] != digest:
        raise ValueError("the folder holds a run of another configuration")


@dataclass
class Extracted:
    """Accepted claims with their spans and coverage, and why requests were refused."""

    claims: DataFrame
    spans: DataFrame
    coverage: DataFrame
    refused: DataFrame


def extract(windows: DataFrame, payloads: DataFrame, obligations: DataFrame, faults: DataFrame | None = None) -> Extracted:
    """Binds the claims of payloads (request_id, payload) to windows. A request with any fault is refused whole.

    faults: what payload_faults gives of the payloads, if it is at hand already.
    """
    faults = K.payload_faults(payloads.select("request_id", "payload")) if faults is None else faults
    broken = faults.select("request_id", F.regexp_replace("fault", " .*$", "").alias("violation")).distinct()
    parsed = C.parse_payloads(payloads)  # claims of faulty payloads go below, with those of all refused requests
    head = windows.select("request_id", "deal_slug", "filing_id", "region_id", "window_id")
    flat = C.flatten(parsed.where("parse_error is null")).join(head, "request_id")
    n = F.row_number().over(_claim_order())
    flat = flat.withColumn("claim_sequence", n).withColumn("claim_id", make_id(F.col("deal_slug"), "claim", n)).withColumn("evidence_id", make_id(F.col("deal_slug"), "llmspan", n))
    paras = windows.select("window_id", F.explode("ordered_paragraphs").alias("p")).select("window_id", "p.paragraph_id", "p.char_start", "p.paragraph_text", "p.source_span_id")
    bound = C.bind_quotes(flat.select(F.col("claim_id").alias("claim_key"), "window_id", "quote_text"), paras)
    flat = flat.join(bound.withColumnRenamed("claim_key", "claim_id"), "claim_id")
    status = C.quote_status(F.col("hits"))
    faults = C.violations(flat, obligations).join(flat.select("claim_id", "request_id"), "claim_id").select("request_id", "violation")
    unbound = flat.where("hits <> 1").select("request_id", F.concat(F.lit("quote_"), status).alias("violation"))
    refused = broken.unionByName(faults).unionByName(unbound)
    good = C.accepted(flat, refused, "request_id")
    date = lambda name: F.to_date(F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd")))
    is_event = F.col("claim_type") == "event"
    claims = good.withColumns({
        "event_date": date("event_date"), "bid_date": date("bid_date"), "effective_date_first": date("effective_date_first"), "event_actor_label": F.when(is_event, F.col("actor_label")), "event_actor_role": F.when(is_event, F.col("actor_role")),
        "actor_label": F.when(F.col("claim_type") == "actor", F.col("actor_label")), "status": F.lit("validated"),
    })
    claims = claims.withColumn("raw_value", C.raw_value()).withColumn("normalized_value", C.normalized_value())
    hashed = X.sha256(F.col("quote_text"))
    parents = paras.select("paragraph_id", F.col("source_span_id").alias("parent_evidence_id"))
    spans = claims.join(parents, "paragraph_id").select(
        "deal_slug", "evidence_id", "filing_id", "paragraph_id", F.lit("raw_md").alias("span_basis"), F.lit("llm_extract").alias("span_kind"), "parent_evidence_id", F.lit("extract").alias("created_by_stage"),
        "char_start", "char_end", "quote_text", hashed.alias("quote_text_hash"), X.fingerprint(F.col("filing_id"), F.col("char_start"), F.col("char_end"), hashed).alias("evidence_fingerprint"),
    )
    return Extracted(claims, spans, C.coverage_results(obligations, claims), refused.distinct())


def _claim_order():
    from pyspark.sql import Window

    return Window.partitionBy("deal_slug").orderBy("request_id", "type_order", "pos")


def run(spark: SparkSession, filings: DataFrame, provider: Provider, out: str, run_id: str, on_error: str = "raise") -> dict:
    """All stages for filings (deal_slug, source_path, text, form_type) into Parquet tables and artifacts below `out`.

    on_error: `raise` stops at a filing without background, a refused request or a failed check; `quarantine` goes
    on without what failed, and the verdict says so. Gives the proof. Tables are overwritten: a run may be repeated.
    """
    digest = config_hash({"run_id": run_id, "on_error": on_error})
    check_resume(out, digest)
    with locked(out):
        kept: dict[str, DataFrame] = {}

        def keep(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{out}/{name}")
            kept[name] = spark.read.parquet(f"{out}/{name}")
            return kept[name]

        def stop(bad: DataFrame, what: str, column: str) -> None:
            if on_error == "raise" and (row := bad.select(column).first()):
                raise ValueError(f"{what}: {row[0]}")

        sinks.write_json(Path(out) / "manifest.json", {"run_id": run_id, "config_hash": digest, "started_at": clock(run_id, digest)})
        keep("filings", I.filings_summary(filings))
        paras = keep("paragraphs", I.paragraphs(filings))
        seeds = I.seed_spans(paras)
        stop(E.without_background(paras), "no background section", "deal_slug")
        regions = keep("evidence_regions", E.regions(paras))
        duties = keep("coverage_obligations", E.obligations(regions))
        windows = E.windows(regions, E.window_paragraphs(regions, paras, seeds), duties)
        requests = keep("requests", windows.join(E.prompt_text(windows), "request_id").withColumn("schema", K.schema_of(F.col("coverage_obligations"))))
        payloads = keep("payloads", provider(requests))
        faults = keep("payload_faults", K.payload_faults(payloads.select("request_id", "payload")))
        found = extract(requests, payloads, duties, faults)
        stop(keep("refused", found.refused), "request refused", "violation")
        claims, spans = keep("claims", found.claims), keep("spans", seeds.unionByName(found.spans))
        coverage = keep("coverage_results", found.coverage)
        if claims.isEmpty():
            raise ValueError("no claims to reconcile")
        graph = {name: df if name in kept else keep(name, df) for name, df in R.reconcile(claims, keep).items()}
        keep("claims_disposed", sinks.disposed(claims, graph["claim_dispositions"]))
        watched, seen = O.observed(checks(claims, spans, filings, duties, coverage, graph), CHECKS)
        failures = keep("validation_failures", watched)
        sinks.write_json(Path(out) / "validation_report.json", {"passed": seen.get["hard_failures"] == 0, **seen.get})
        O.ambiguity_queue(failures).write.mode("overwrite").option("header", "true").csv(f"{out}/ambiguity_queue")
        stop(failures, "validation failed", "detail")
        rows = keep("bidder_rows", P.bidder_rows(graph["events"], graph["event_actor_links"], graph["actors"]))
        keep("projection_units", P.projection_units(rows))
        keep("projection_judgments", P.projection_judgments(rows))
        canonical = {n: graph[n] for n in R.CANONICAL}
        proof = P.proof(P.facts(claims, duties, coverage, graph["claim_dispositions"], canonical, graph["row_evidence"], rows, failures)).first().asDict()
        sinks.write_json(Path(out) / "proof_summary.json", proof)
        sinks.write_text(Path(out) / "memo.md", sinks.memo(run_id, proof))
        return proof


#: The names that checks() gives its failures.
CHECKS = ["claim_disposition", "coverage_result", "claim_evidence", "semantic_claim_evidence", "row_evidence", "source_truth", "evidence_fingerprint"]


def checks(claims: DataFrame, spans: DataFrame, filings: DataFrame, duties: DataFrame, coverage: DataFrame, graph: dict[str, DataFrame]) -> DataFrame:
    """All hard checks of a run as one table of failures."""
    sources = filings.select(make_id(F.col("deal_slug"), "filing", F.lit(1)).alias("filing_id"), "text", X.sha256(F.col("text")).alias("raw_sha256"))
    parts = [
        Q.exactly_one(claims.select("claim_id"), graph["claim_dispositions"], "claim_id", "claim_disposition", "claims", "disposition"),
        Q.exactly_one(duties.where("current").select("obligation_id"), coverage, "obligation_id", "coverage_result", "coverage_obligations", "result"),
        Q.without(claims.where("evidence_id is null").select("claim_id"), claims.limit(0).select("claim_id"), "claim_id", "claim_evidence", "claims", "claim has no evidence"),
        Q.bid_semantics(claims.where("claim_type = 'bid'")),
        Q.relation_semantics(claims.where("claim_type = 'actor_relation'")),
        Q.canonical_without_evidence({n: graph[n] for n in R.CANONICAL}, graph["row_evidence"]),
        Q.source_truth(spans, sources),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The artifacts of a corpus run's skeleton.
CORPUS_ARTIFACTS = ["corpus_manifest.jsonl", "shard_plan.jsonl", "attempt_ledger.jsonl", "failure_ledger.jsonl", "progress_ledger.jsonl", "cost_runtime_summary.json", "cost_runtime_summary.csv", "aggregate_proof_summary.json"]


def corpus_skeleton(folder: str, run_id: str, slugs: list[str], envelope: list[dict], shard_size: int = 1) -> None:
    """Writes the ledgers of a corpus run before its deals; refuses to overwrite any, repeated slugs, and sizes below one."""
    if not slugs or len(set(slugs)) < len(slugs) or shard_size < 1:
        raise ValueError("slugs must be there and differ, and shards hold one or more")
    root = Path(folder)
    if there := [n for n in CORPUS_ARTIFACTS if (root / n).exists()]:
        raise FileExistsError(f"there already: {', '.join(there)}")
    shards = [slugs[i : i + shard_size] for i in range(0, len(slugs), shard_size)]
    name = {s: f"shard-{i:04d}" for i, part in enumerate(shards, 1) for s in part}
    sinks.write_jsonl(root / CORPUS_ARTIFACTS[0], [{"run_id": run_id, "deal_slug": s, "source_order": i, "shard_id": name[s], "status": "queued"} for i, s in enumerate(slugs, 1)])
    sinks.write_jsonl(root / CORPUS_ARTIFACTS[1], [{"run_id": run_id, "shard_id": name[p[0]], "deal_slugs": p} for p in shards])
    for n in CORPUS_ARTIFACTS[2:5]:
        sinks.write_text(root / n, "")
    sinks.write_json(root / CORPUS_ARTIFACTS[5], {"run_id": run_id, "projections": envelope})
    sinks.write_csv(root / CORPUS_ARTIFACTS[6], envelope)
    sinks.write_json(root / CORPUS_ARTIFACTS[7], {"run_id": run_id, "verdict": "BLOCKED", "reason": "no deal was imported yet", "deals_planned": len(slugs), "deals_completed": 0})
