"""Queries over filings made of the documents: lines, paragraphs, sections, spans, regions, windows, quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V
from claimloom.operators import claims as C
from claimloom.operators import evidence as E
from claimloom.operators import ingest as I
from claimloom.operators import sections as W
from claimloom.operators import validate as Q
from claimloom.plans import adaptors as A
from claimloom.plans import incremental as N

_GAP = "[ \\t\\n\\r\\f\\v]"
LINES = """lin0 AS (
  SELECT deal_slug, i AS n, CASE WHEN i < len(parts) THEN parts[i] || chr(10) ELSE parts[i] END AS line
  FROM (SELECT deal_slug, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM fil)),
lin1 AS (SELECT *, CAST(coalesce(sum(length(line)) OVER (PARTITION BY deal_slug ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS char_start,
    regexp_replace(line, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g') AS bare FROM lin0 WHERE line <> ''),
lin AS (SELECT *, CAST(char_start + length(line) AS INTEGER) AS char_end, CASE WHEN bare LIKE 'ZEQ.=%' THEN 'zeq_banner' WHEN bare = 'Table of Contents' THEN 'table_of_contents' WHEN bare = 'TOC_END' THEN 'toc_end'
    WHEN regexp_full_match(bare, '[0-9]{1,4}') THEN 'isolated_folio' WHEN bare LIKE 'COMMAND=%' AND NOT contains(bare, ' Background of ') THEN 'printer_command' END AS rule FROM lin1)"""
_HEADINGS = " ".join(f"WHEN starts_with(head, '{h.lower()}') THEN '{h}'" for h in V.SECTION_HEADINGS)
PARAS = f"""kep AS (SELECT *, regexp_matches(line, '<!--\\s*PAGE\\s+[0-9]+\\s*-->') AS marker, bare = '' AS blank FROM lin WHERE rule IS NULL),
blk0 AS (SELECT *, CASE WHEN marker OR blank OR lag(n) OVER w IS NULL OR lag(marker) OVER w OR lag(blank) OVER w OR lag(char_end) OVER w <> char_start THEN 1 ELSE 0 END AS opens FROM kep WINDOW w AS (PARTITION BY deal_slug ORDER BY n)),
blk AS (SELECT *, sum(opens) OVER w AS block, last_value(CASE WHEN marker THEN CAST(regexp_extract(line, 'PAGE\\s+([0-9]+)', 1) AS INTEGER) END IGNORE NULLS) OVER w AS page FROM blk0
  WINDOW w AS (PARTITION BY deal_slug ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
par0 AS (SELECT deal_slug, min(char_start) AS char_start, max(char_end) AS char_end, string_agg(line, '' ORDER BY n) AS paragraph_text, max(page) AS page_hint, arg_min(bare, n) AS first_bare FROM blk WHERE NOT blank GROUP BY deal_slug, block),
par1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY deal_slug ORDER BY char_start) AS INTEGER) AS n,
  lower(trim(regexp_replace(regexp_replace(regexp_replace(first_bare, 'COMMAND=[^\\s*]+', ' ', 'g'), '[*_`#]', ' ', 'g'), '\\s+', ' ', 'g'))) AS head FROM par0),
par2 AS (SELECT *, CASE {_HEADINGS} END AS heading FROM par1),
par AS (SELECT *, deal_slug || '_para_' || n AS paragraph_id, deal_slug || '_filing_1' AS filing_id,
  coalesce(last_value(heading IGNORE NULLS) OVER (PARTITION BY deal_slug ORDER BY char_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'unknown_section') AS section, sha256(paragraph_text) AS paragraph_hash FROM par2)"""
FILED = f"WITH {A.FIL}, {LINES}, {PARAS} "
REGION = f"reg AS (SELECT deal_slug || '_region_1' AS region_id, filing_id, deal_slug, array_agg(paragraph_id ORDER BY char_start) AS ids FROM par WHERE section = '{V.BACKGROUND}' GROUP BY filing_id, deal_slug)"


def _paragraphs(s, d):
    return I.paragraphs(A.filings(s, d))


def _with_spans(s, d):
    paras = _paragraphs(s, d)
    return paras, I.seed_spans(paras), E.regions(paras)


def line_spans(s, d):
    docs = A.table(s, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("deal_slug"), "text")
    return I.lines(docs).select("deal_slug", "char_start", "char_end", X.sha256(F.col("line")).alias("line_hash"))


def removal_log(s, d):
    return I.removals(A.filings(s, d))


def paragraphs(s, d):
    return _paragraphs(s, d).select("paragraph_id", "char_start", "char_end", "page_hint", "paragraph_hash")


def sections(s, d):
    return _paragraphs(s, d).groupBy("deal_slug", "section").agg(F.count("*").alias("n"), F.min("char_start").alias("first_char"))


def seed_spans(s, d):
    return I.seed_spans(_paragraphs(s, d)).select("evidence_id", "filing_id", "paragraph_id", "span_kind", "char_start", "char_end", "quote_text_hash", "evidence_fingerprint")


def filings_summary(s, d):
    return I.filings_summary(A.filings(s, d)).select("filing_id", "raw_sha256", "page_count", "section_count", "process_scope")


def evidence_regions(s, d):
    return E.regions(_paragraphs(s, d)).select("region_id", "filing_id", "region_kind", "start_paragraph_id", "end_paragraph_id", F.to_json("paragraph_ids").alias("paragraph_ids_json"), F.to_json("expected_claim_types").alias("types_json"))


def coverage_obligations(s, d):
    return E.obligations(E.regions(_paragraphs(s, d))).select("obligation_id", "region_id", "expected_claim_type", "obligation_label", "importance", "current")


def window_paragraphs(s, d):
    paras, spans, regions = _with_spans(s, d)
    return E.window_paragraphs(regions, paras, spans).select("region_id", F.col("pos").cast("int").alias("pos"), "paragraph_id", "source_span_id", "char_start", "char_end")


def window_prompts(s, d):
    paras, spans, regions = _with_spans(s, d)
    made = E.windows(regions, E.window_paragraphs(regions, paras, spans), E.obligations(regions))
    return E.prompt_text(made).select("request_id", F.length("prompt").cast("int").alias("n_chars"), F.sha2("prompt", 256).alias("prompt_hash"))


def _quotes(s, d):
    """Every benchmark text as a quote of every window, which is a block of 1,000 documents: the query set in blocks against all rows."""
    docs = A.table(s, d, "documents")
    quotes = A.table(s, d, "benchmark").select(F.col("item_id"), F.col("text").alias("quote_text"))
    # Windows by quotes is what is asked; dealt by a key, it is made by as many tasks as there are cores.
    deal = F.pmod("window_id", F.lit(64)).cast("int")
    windows = docs.select(F.floor(F.col("doc_id") / 1000).alias("window_id")).distinct().withColumn("deal", deal)
    asked = windows.join(quotes.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(63)))), "deal").select("window_id", F.concat_ws(":", F.col("window_id").cast("string"), F.col("item_id").cast("string")).alias("claim_key"), "quote_text")
    paras = docs.select(F.floor(F.col("doc_id") / 1000).alias("window_id"), F.col("doc_id").alias("paragraph_id"), F.lit(0).alias("char_start"), F.col("text").alias("paragraph_text"))
    return C.bind_quotes(asked, paras)


def quote_binding(s, d):
    return _quotes(s, d)


def quote_status(s, d):
    return _quotes(s, d).groupBy(C.quote_status(F.col("hits")).alias("status")).agg(F.count("*").alias("n"))


QUOTES = """win AS (SELECT DISTINCT doc_id // 1000 AS window_id FROM documents),
hit AS (SELECT w.window_id || ':' || b.item_id AS claim_key, d.doc_id, strpos(d.text, b.text) AS pos, length(b.text) AS size,
    CASE WHEN strpos(d.text, b.text) = 0 THEN 0 WHEN strpos(substr(d.text, strpos(d.text, b.text) + 1), b.text) > 0 THEN 2 ELSE 1 END AS n
  FROM win w, benchmark b, documents d WHERE d.doc_id // 1000 = w.window_id),
bound AS (SELECT claim_key, CAST(sum(n) AS INTEGER) AS hits, CASE WHEN sum(n) = 1 THEN min(doc_id) FILTER (n > 0) END AS paragraph_id,
    CASE WHEN sum(n) = 1 THEN CAST(min(pos - 1) FILTER (n > 0) AS INTEGER) END AS char_start, CASE WHEN sum(n) = 1 THEN CAST(min(pos - 1 + size) FILTER (n > 0) AS INTEGER) END AS char_end FROM hit GROUP BY claim_key)"""


def quote_metrics(s, d):
    """For each window the number of quotes found, and of those not unique."""
    b = _quotes(s, d).withColumn("window_id", F.split("claim_key", ":")[0])
    return b.groupBy("window_id").agg(F.count("*").alias("quotes"), F.count_if(F.col("hits") > 0).alias("found"), F.count_if(F.col("hits") > 1).alias("not_unique"), F.round(F.avg((F.col("hits") > 0).cast("double")), 4).alias("found_rate"))


def _spans_with_defects(s, d):
    docs = A.table(s, d, "documents")
    n = F.col("doc_id")
    start, size = (n % 50).cast("int"), F.least(F.lit(40), F.length("text"))
    end = F.when(n % 17 == 0, F.length("text") + 5).otherwise(F.least(start + size, F.length("text")))
    start = F.least(start, F.length("text"))
    fid, quote = F.concat(F.lit("f"), n.cast("string")), F.substring(F.col("text"), start + 1, end - start)
    quote = F.when(n % 19 == 0, F.concat(quote, F.lit("!"))).otherwise(quote)
    spans = docs.select(F.concat(F.lit("e"), n.cast("string")).alias("evidence_id"), fid.alias("filing_id"), start.alias("char_start"), end.cast("int").alias("char_end"), quote.alias("quote_text"), F.when(n % 23 == 0, "0").otherwise(X.sha256(quote)).alias("quote_text_hash"))
    spans = spans.withColumn("evidence_fingerprint", F.when(F.col("char_start") == 29, "0").otherwise(X.fingerprint(F.col("filing_id"), F.col("char_start"), F.col("char_end"), F.col("quote_text_hash"))))
    sources = docs.select(fid.alias("filing_id"), F.when(n % 31 != 0, F.col("text")).alias("text"), F.when(n % 37 == 0, "0").otherwise(X.sha256(F.col("text"))).alias("raw_sha256"))
    return spans, sources


SPANS = """spn0 AS (SELECT doc_id, text, least(doc_id % 50, length(text)) AS cs, CASE WHEN doc_id % 17 = 0 THEN length(text) + 5 ELSE least(doc_id % 50 + least(40, length(text)), length(text)) END AS ce FROM documents),
spn1 AS (SELECT *, substr(text, cs + 1, ce - cs) || CASE WHEN doc_id % 19 = 0 THEN '!' ELSE '' END AS q FROM spn0),
spn2 AS (SELECT *, 'e' || doc_id AS evidence_id, 'f' || doc_id AS filing_id, CASE WHEN doc_id % 23 = 0 THEN '0' ELSE sha256(q) END AS qh FROM spn1),
spn AS (SELECT *, CASE WHEN cs = 29 THEN '0' ELSE sha256(filing_id || chr(0) || cs || chr(0) || ce || chr(0) || qh) END AS fp, CASE WHEN doc_id % 31 = 0 THEN NULL ELSE text END AS src, CASE WHEN doc_id % 37 = 0 THEN '0' ELSE sha256(text) END AS rh FROM spn2)"""


def val_source_truth(s, d):
    return Q.source_truth(*_spans_with_defects(s, d))


def validate_quote(s, d):
    spans, sources = _spans_with_defects(s, d)
    j = spans.join(sources, "filing_id")
    return j.groupBy(X.quote_is_valid(F.col("text"), F.col("char_start"), F.col("char_end"), F.col("quote_text_hash")).alias("valid")).agg(F.count("*").alias("n"), F.min("evidence_id").alias("first_id"))


LABELS = ["thing", "tion", "ough", "the and", "O’Neil", "aux"]


def labels_in_text(s, d):
    docs = A.table(s, d, "documents")
    return docs.select("doc_id", F.array_join(X.labels_in(F.col("text"), F.array(*map(F.lit, LABELS))), "|").alias("labels"))


CHUNK, TERMS, BEFORE, AFTER = 700, ["thing", "ough", "NICHT", "license"], 40, 60


def section_windows(s, d):
    return W.section_windows(_paragraphs(s, d))


def text_chunks(s, d):
    """The paragraphs of every filing's sections in chunks of at most 700 characters."""
    return W.chunks(W.windowed(_paragraphs(s, d)), CHUNK, ("deal_slug", "window"))


def term_context(s, d):
    docs = A.table(s, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("deal_slug"), "text")
    return W.term_context(docs, TERMS, BEFORE, AFTER)


def filing_sources(s, d):
    """Filings whose source paths are absolute, below the root, a name alone or missing, against files that may lie elsewhere or have changed."""
    n, name = F.col("doc_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".md"))
    docs = A.table(s, d, "documents").select(n, F.coalesce("text", F.lit("")).alias("text"), name.alias("name"))
    files = docs.where(n % 11 != 4).select(F.concat(F.when(n % 10 == 2, "/r/").otherwise("/r/in/"), "name").alias("path"), "text")
    path = F.when(n % 5 == 0, F.concat(F.lit("file:/r/in/"), "name")).when(n % 5 == 1, F.concat(F.lit("in/"), "name")).when(n % 5 == 2, F.concat(F.lit("old/"), "name")).when(n % 5 == 3, F.concat(F.lit("/r/in/"), "name"))
    filings = docs.select(F.concat(F.lit("f"), n.cast("string")).alias("filing_id"), path.alias("source_path"), F.when(n % 7 == 0, "0").otherwise(X.sha256(F.col("text"))).alias("raw_sha256"))
    return N.source_failures(N.resolved(filings, files, "/r"))


QUERIES = {f.__name__: f for f in (section_windows, text_chunks, term_context, filing_sources, line_spans, removal_log, paragraphs, sections, seed_spans, filings_summary, evidence_regions, coverage_obligations, window_paragraphs, window_prompts, quote_binding, quote_status, quote_metrics, val_source_truth, validate_quote, labels_in_text)}

_SCOPE = "CASE upper(coalesce(form_type, '')) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.PROCESS_SCOPES.items()) + " WHEN '' THEN 'target_full_proxy' END"
_TYPES = '["event","participation_count","actor","bid","actor_relation"]'
_DUTY = ", ".join(f"({i}, '{t}', '{label}', '{w}')" for i, (t, label, w) in enumerate(V.OBLIGATIONS, 1))
_BY_TYPE = "||chr(10)||".join(
    [f"'{t}:'||chr(10)||" + "||chr(10)||".join(f"'- '||deal_slug||'_obligation_{i}: {w} | {label}'" for i, (kind, label, w) in enumerate(V.OBLIGATIONS, 1) if kind == t) for t in dict.fromkeys(t for t, _, _ in V.OBLIGATIONS)]
)
ORACLE_SQL = {
    "line_spans": f"WITH fil AS (SELECT 'd' || doc_id AS deal_slug, text FROM documents), {LINES} SELECT deal_slug, char_start, char_end, sha256(line) AS line_hash FROM lin",
    "removal_log": f"WITH {A.FIL}, {LINES} SELECT deal_slug, rule AS rule_id, char_start, char_end, line AS removed_text FROM lin WHERE rule IS NOT NULL",
    "paragraphs": FILED + "SELECT paragraph_id, char_start, char_end, page_hint, paragraph_hash FROM par",
    "sections": FILED + "SELECT deal_slug, section, count(*) AS n, min(char_start) AS first_char FROM par GROUP BY ALL",
    "seed_spans": FILED + "SELECT deal_slug || '_evidence_' || n AS evidence_id, filing_id, paragraph_id, 'paragraph_seed' AS span_kind, char_start, char_end, paragraph_hash AS quote_text_hash, sha256(filing_id || chr(0) || char_start || chr(0) || char_end || chr(0) || paragraph_hash) AS evidence_fingerprint FROM par",
    "filings_summary": FILED + f"SELECT deal_slug || '_filing_1' AS filing_id, sha256(text) AS raw_sha256, CAST((length(text) - length(replace(text, '<!-- PAGE ', ''))) / 10 AS INTEGER) AS page_count, CAST((SELECT count(DISTINCT section) FROM par WHERE par.deal_slug = fil.deal_slug AND section <> 'unknown_section') AS INTEGER) AS section_count, {_SCOPE} AS process_scope FROM fil",
    "evidence_regions": FILED + f", {REGION} SELECT region_id, filing_id, 'sale_process_narrative' AS region_kind, ids[1] AS start_paragraph_id, ids[-1] AS end_paragraph_id, '[\"' || array_to_string(ids, '\",\"') || '\"]' AS paragraph_ids_json, '{_TYPES}' AS types_json FROM reg",
    "coverage_obligations": FILED + f", {REGION}, duty(n, t, label, w) AS (VALUES {_DUTY}) SELECT deal_slug || '_obligation_' || n AS obligation_id, region_id, t AS expected_claim_type, label AS obligation_label, w AS importance, true AS current FROM reg, duty",
    "window_paragraphs": FILED + f"SELECT deal_slug || '_region_1' AS region_id, CAST(row_number() OVER (PARTITION BY deal_slug ORDER BY char_start) - 1 AS INTEGER) AS pos, paragraph_id, deal_slug || '_evidence_' || n AS source_span_id, char_start, char_end FROM par WHERE section = '{V.BACKGROUND}'",
    "window_prompts": FILED + f", {REGION}, txt AS (SELECT deal_slug, string_agg('[' || paragraph_id || ']' || chr(10) || paragraph_text, chr(10) || chr(10) ORDER BY char_start) AS t FROM par WHERE section = '{V.BACKGROUND}' GROUP BY deal_slug), pr AS (SELECT deal_slug, 'deal: ' || deal_slug || chr(10) || 'filing: ' || filing_id || chr(10) || 'region: ' || region_id || chr(10) || 'Coverage obligations:' || chr(10) || {_BY_TYPE} || chr(10) || chr(10) || 'Window paragraphs:' || chr(10) || t AS prompt FROM reg JOIN txt USING (deal_slug)) SELECT deal_slug || '_llmrequest_1' AS request_id, CAST(length(prompt) AS INTEGER) AS n_chars, sha256(prompt) AS prompt_hash FROM pr",
    "quote_binding": f"WITH {QUOTES} SELECT * FROM bound",
    "quote_status": f"WITH {QUOTES} SELECT CASE hits WHEN 0 THEN 'absent' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status, count(*) AS n FROM bound GROUP BY 1",
    "quote_metrics": f"WITH {QUOTES} SELECT split_part(claim_key, ':', 1) AS window_id, count(*) AS quotes, count(*) FILTER (hits > 0) AS found, count(*) FILTER (hits > 1) AS not_unique, round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 4) AS found_rate FROM bound GROUP BY 1",
    "val_source_truth": f"""WITH {SPANS}, f AS (
      SELECT evidence_id, 'source_truth' AS check_name, 'source file is missing' AS detail FROM spn WHERE src IS NULL
      UNION ALL SELECT evidence_id, 'source_truth', 'source hash differs' FROM spn WHERE sha256(src) <> rh
      UNION ALL SELECT evidence_id, 'source_truth', 'span lies outside the source' FROM spn WHERE ce > length(src) OR ce < cs
      UNION ALL SELECT evidence_id, 'source_truth', 'quote differs from the source' FROM spn WHERE ce <= length(src) AND ce >= cs AND substr(src, cs + 1, ce - cs) <> q
      UNION ALL SELECT evidence_id, 'evidence_fingerprint', 'quote hash does not recompute' FROM spn WHERE sha256(q) <> qh
      UNION ALL SELECT evidence_id, 'evidence_fingerprint', 'fingerprint does not recompute' FROM spn WHERE sha256(filing_id || chr(0) || cs || chr(0) || ce || chr(0) || qh) <> fp)
      SELECT check_name, 'spans' AS table_name, evidence_id AS row_id, detail FROM f""",
    "validate_quote": f"WITH {SPANS} SELECT coalesce(ce <= length(src) AND ce >= cs AND sha256(substr(src, cs + 1, ce - cs)) = qh, false) AS valid, count(*) AS n, min(evidence_id) AS first_id FROM spn GROUP BY 1",
    "labels_in_text": "WITH l(label) AS (VALUES " + ", ".join(f"('{x}')" for x in LABELS) + "), h AS (SELECT doc_id, label, strpos(text, label) AS pos FROM documents, l) SELECT doc_id, coalesce(string_agg(label, '|' ORDER BY pos, length(label) DESC, label) FILTER (pos > 0), '') AS labels FROM h GROUP BY doc_id",
    "section_windows": FILED + ", win0 AS (SELECT *, CASE WHEN section <> lag(section) OVER w THEN 1 WHEN lag(section) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM par WINDOW w AS (PARTITION BY deal_slug ORDER BY char_start)), win AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY deal_slug ORDER BY char_start) AS INTEGER) AS w FROM win0) SELECT deal_slug, w AS window, first(section) AS section, min(n) AS n_first, max(n) AS n_last, min(char_start) AS char_start, max(char_end) AS char_end FROM win GROUP BY deal_slug, w",
    "text_chunks": FILED.replace("WITH ", "WITH RECURSIVE ", 1) + f""", win0 AS (SELECT *, CASE WHEN section <> lag(section) OVER w THEN 1 WHEN lag(section) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM par WINDOW w AS (PARTITION BY deal_slug ORDER BY char_start)),
      win AS MATERIALIZED (SELECT deal_slug, n, char_start, char_end, CAST(sum(opens) OVER (PARTITION BY deal_slug ORDER BY char_start) AS INTEGER) AS w FROM win0),
      walk(deal_slug, n, w, start, char_end, first_start, chunk) AS (
        SELECT deal_slug, n, w, char_start, char_end, char_start, 1 FROM win WHERE n = 1
        UNION ALL SELECT x.deal_slug, x.n, x.w, x.char_start, x.char_end, CASE WHEN x.w <> k.w OR x.char_end - first_start > {CHUNK} THEN x.char_start ELSE first_start END, CASE WHEN x.w <> k.w THEN 1 WHEN x.char_end - first_start > {CHUNK} THEN chunk + 1 ELSE chunk END
        FROM walk k JOIN win x ON x.deal_slug = k.deal_slug AND x.n = k.n + 1)
      SELECT deal_slug, w AS window, CAST(chunk AS INTEGER) AS chunk, min(n) AS n_first, max(n) AS n_last, min(start) AS char_start, max(char_end) AS char_end, max(char_end) - min(start) > {CHUNK} AS over_long FROM walk GROUP BY deal_slug, w, chunk""",
    "term_context": f"""WITH t(term) AS (VALUES {", ".join(f"('{t.lower()}')" for t in TERMS)}), p AS (SELECT doc_id, length(text) AS size, term, string_split(translate(text, '{W._UPPER}', '{W._LOWER}'), term) AS parts FROM documents, t WHERE text IS NOT NULL),
      q AS (SELECT doc_id, size, term, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i, len(parts) AS last FROM p WHERE len(parts) > 1),
      r AS (SELECT doc_id, size, term, i, last, CAST(sum(length(part) + length(term)) OVER (PARTITION BY doc_id, term ORDER BY i) - length(term) AS INTEGER) AS beg FROM q),
      h AS (SELECT doc_id, term, greatest(0, beg - {BEFORE}) AS a, least(size, beg + length(term) + {AFTER}) AS z FROM r WHERE i < last),
      o AS (SELECT *, CASE WHEN a <= max(z) OVER (PARTITION BY doc_id ORDER BY a, z, term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM h),
      g AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY a, z, term) AS island FROM o)
      SELECT 'd' || doc_id AS deal_slug, CAST(min(a) AS INTEGER) AS char_start, CAST(max(z) AS INTEGER) AS char_end, count(*) AS hits, string_agg(DISTINCT term, '|' ORDER BY term) AS terms FROM g GROUP BY doc_id, island""",
    "filing_sources": """SELECT 'source_truth' AS check_name, 'filings' AS table_name, 'f' || doc_id AS row_id, CASE WHEN doc_id % 5 = 4 THEN 'missing source_path' WHEN doc_id % 11 = 4 OR (doc_id % 5 = 2) <> (doc_id % 10 = 2) THEN 'source file is missing' ELSE 'raw_sha256 differs from the source file' END AS detail
      FROM documents WHERE doc_id % 5 = 4 OR doc_id % 11 = 4 OR (doc_id % 5 = 2) <> (doc_id % 10 = 2) OR doc_id % 7 = 0""",
}
