"""Queries over pages, index rows, seeds and mined texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.operators import markdown as D
from claimloom.operators import mining as M
from claimloom.operators import scan as N
from claimloom.plans import adaptors as A
from claimloom.sources import tables as S

c = F.col
BASE = "https://filings.example.com/data"


def _addresses(s, d):
    p = A.table(s, d, "pages").select("page_id")
    cik, n = (c("page_id") % 9000 + 100).cast("string"), F.lpad((c("page_id") * 7919 % 1_000_000).cast("string"), 18, "0")
    dashed = F.concat_ws("-", F.substring(n, 1, 10), F.substring(n, 11, 2), F.substring(n, 13, 6))
    root = F.concat(F.lit(BASE + "/"), cik, F.lit("/"), n)
    kind = c("page_id") % 4
    return p.select("page_id", F.when(kind == 0, F.concat(root, F.lit("/"), dashed, F.lit("-index.htm#top"))).when(kind == 1, F.concat(root, F.lit("/?x=1"))).when(kind == 2, root).otherwise(F.concat(F.lit(BASE + "/"), cik)).alias("url"))


def filing_addresses(s, d):
    a = _addresses(s, d).withColumn("a", X.accession(c("url")))
    return a.select("page_id", "a.cik", "a.accession", X.index_url(BASE, c("a.cik"), c("a.accession")).alias("index_url"))


def page_links(s, d):
    """Every page's links, with the number of each page's links to its own site."""
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return A.table(s, d, "pages").select("page_id", F.explode(links).alias("href")).groupBy("page_id").agg(F.count("*").alias("links"), F.count_if(c("href").startswith("/")).alias("own"), F.max("href").alias("last_href"))


FORMS = ["DEFM14A", "EX-10", "SC TO-T", "425", "10-K", "S-4", "EX-99.(A)(1)(A)"]


def _index_pages(s, d):
    """Each page id as a filing's index of three documents, whose forms follow from the id."""
    form = lambda i: F.element_at(F.array(*map(F.lit, FORMS)), ((c("page_id") * (i + 1) + i) % len(FORMS) + 1).cast("int"))
    row = lambda i: F.concat(F.lit(f'<tr><td><a href="/doc{i}.htm">Doc {i}</a> </td> <td>'), form(i), F.lit("</td><td>"), F.when(c("page_id") % 3 == i, "n/a").otherwise((c("page_id") * 10 + i).cast("string")), F.lit("</td></tr>"))
    return A.table(s, d, "pages").select(c("page_id").alias("filing"), F.concat(*(row(i) for i in range(3))).alias("html"))


def index_documents(s, d):
    return S.index_rows(_index_pages(s, d), site="https://x.example").select("filing", c("pos").cast("int").alias("pos"), "name", "form_type", "size_bytes", "url")


def primary_documents(s, d):
    return S.primary_documents(S.index_rows(_index_pages(s, d), site="https://x.example"))


def _mined_text():
    k = c("event_id") % 6
    v = F.round(c("value"), 2).cast("string")
    return (
        F.when(k == 0, F.concat(F.lit("They offered $"), v, F.lit(" per share and later $10 to $12.50 per share.")))
        .when(k == 1, F.lit("Eleven financial buyers entered into confidentiality agreements, and the adviser contacted a total of 30 parties; two bidders left."))
        .when(k == 2, F.lit("On March 3, 2014, Mr. A. Smith of J.P. Row bid $3.50 per share. He left. On May 9, 2014, the board met"))
        .when(k == 3, F.lit("Party A and The Northern Capital Partners submitted a proposal; B&C remained active with Northern Capital Partners."))
        .otherwise("nothing")
    )


def mined_matches(s, d):
    """Bids, counts, dated events and actors in texts by template."""
    rows = A.table(s, d, "events").select("event_id", _mined_text().alias("text"))
    return M.mined({"bid": M.bids, "count": M.counts, "event": M.dated_events, "actor": M.actors}, rows)


def _woven(s, d):
    """Every document's and page's whole text with a sentence by template in its middle.

    A full stop parts the sentence from what stands before it, which white space would not: a half that ends with
    `all` would become part of a count.
    """
    docs = A.table(s, d, "documents").select(F.concat(F.lit("d"), c("doc_id").cast("string")).alias("row"), c("doc_id").alias("n"), F.coalesce("text", F.lit("")).alias("body"))
    pages = A.table(s, d, "pages").select(F.concat(F.lit("p"), c("page_id").cast("string")).alias("row"), c("page_id").alias("n"), F.coalesce("html", F.lit("")).alias("body"))
    k, v, half = c("n") % 6, F.concat((c("n") % 90 + 10).cast("string"), F.lit(".5")), F.floor(F.length("body") / 2).cast("int")
    sentence = (
        F.when(k == 0, F.concat(F.lit("They offered $"), v, F.lit(" per share and later $10 to $12.50 per share.")))
        .when(k == 1, F.lit("Eleven financial buyers entered into confidentiality agreements, and the adviser contacted a total of 30 parties; two bidders left."))
        .when(k == 2, F.lit("On March 3, 2014, Mr. A. Smith of J.P. Row bid $3.50 per share. He left. On May 9, 2014, the board met."))
        .when(k == 3, F.lit("Party A and The Northern Capital Partners submitted a proposal; B&C remained active with Northern Capital Partners."))
        .otherwise("nothing.")
    )
    return docs.unionByName(pages).select("row", F.concat(F.substring("body", F.lit(1), half), F.lit("."), sentence, F.lit("\n"), F.substring(c("body"), half + 1, F.length("body"))).alias("text"))


def mined_documents(s, d):
    """Bids, counts, dated events and actors of every document and page, found in one pass over each whole text."""
    found = _woven(s, d).select("row", N.scanned(c("text")).alias("m"))
    tagged = lambda k: F.transform(c("m")[k], lambda x: F.struct(F.lit(k).alias("kind"), x.alias("m")))
    return found.select("row", F.explode(F.concat(*map(tagged, N.KINDS))).alias("x")).select("row", "x.kind", "x.m.raw_value", "x.m.normalized_value", "x.m.start", "x.m.end")


def joined_pages(s, d):
    turns = A.table(s, d, "conversations").select(c("conv_id").cast("string").alias("deal_slug"), c("turn").alias("page_no"), "text")
    return S.joined_pages(turns).select("deal_slug", F.sha2("text", 256).alias("text_hash"))


def page_markdown(s, d):
    """Every page converted whole: its links, headings, list items and markers."""
    made = D.converted(A.table(s, d, "pages"))
    count = lambda pattern: F.regexp_count("markdown", F.lit(pattern)).alias
    return made.select("page_id", count(r"\]\([^)]*\)")("links"), count(r"(?m)^# \S")("headings"), count(r"(?m)^- \[")("items"), count("<!-- PAGE [0-9]+ -->")("pages"))


def title_names(s, d):
    return A.table(s, d, "supplier").select("s_suppkey", X.title_name(F.upper(F.replace(F.replace(c("s_name"), F.lit("#"), F.lit(" & ")), F.lit("0"), F.lit("o")))).alias("title"), X.token_estimate(c("s_name")).alias("tokens"))


QUERIES = {f.__name__: f for f in (filing_addresses, page_links, index_documents, primary_documents, mined_matches, mined_documents, page_markdown, joined_pages, title_names)}

_FORMS = "[" + ", ".join(f"'{f}'" for f in FORMS) + "]"
_IDX = f"idx AS (SELECT page_id AS filing, i AS pos, 'Doc ' || i AS name, {_FORMS}[(page_id * (i + 1) + i) % {len(FORMS)} + 1] AS form_type, CASE WHEN page_id % 3 = i THEN NULL ELSE CAST(page_id * 10 + i AS INTEGER) END AS size_bytes, 'https://x.example/doc' || i || '.htm' AS url FROM pages, (SELECT CAST(unnest(range(3)) AS INTEGER) AS i))"
_SHARE = "'They offered $' || CAST(round(value, 2) AS VARCHAR)"
ORACLE_SQL = {
    "filing_addresses": f"WITH a AS (SELECT page_id, CASE WHEN page_id % 4 < 3 THEN CAST(page_id % 9000 + 100 AS VARCHAR) END AS cik, CASE WHEN page_id % 4 < 3 THEN lpad(CAST(page_id * 7919 % 1000000 AS VARCHAR), 18, '0') END AS accession FROM pages) SELECT *, '{BASE}/' || cik || '/' || accession || '/' || accession[1:10] || '-' || accession[11:12] || '-' || accession[13:] || '-index.htm' AS index_url FROM a",
    "page_links": "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages) SELECT page_id, count(*) AS links, count(*) FILTER (href LIKE '/%') AS own, max(href) AS last_href FROM l GROUP BY 1",
    "index_documents": f"WITH {_IDX} SELECT * FROM idx",
    "primary_documents": f"""WITH {_IDX}, g AS (SELECT filing, arg_min(form_type, pos) FILTER (form_type IN ('DEFM14A', 'PREM14A', 'SC TO-T', 'SC TO-T/A', 'S-4', 'S-4/A')) AS mf, arg_min(url, pos) FILTER (form_type IN ('DEFM14A', 'PREM14A', 'SC TO-T', 'SC TO-T/A', 'S-4', 'S-4/A')) AS mu,
      arg_min(form_type, pos) FILTER (NOT form_type LIKE 'EX-%') AS xf, arg_min(url, pos) FILTER (form_type LIKE 'EX-99%') AS ou FROM idx GROUP BY filing),
      o AS (SELECT *, CASE WHEN coalesce(mf, xf) IS NULL THEN 'no_primary' WHEN coalesce(mf, xf) = '425' THEN 'excluded' WHEN mf IS NULL THEN 'unknown_form' WHEN mf LIKE 'SC TO-T%' THEN CASE WHEN ou IS NULL THEN 'no_exhibit' ELSE 'exhibit' END ELSE 'primary' END AS outcome FROM g)
      SELECT filing, outcome, CASE outcome WHEN 'primary' THEN mu WHEN 'exhibit' THEN ou END AS url FROM o""",
    "mined_matches": f"""WITH e AS (SELECT event_id, event_id % 6 AS k, CAST(round(value, 2) AS VARCHAR) AS v FROM events)
      SELECT event_id, 'bid' AS kind, '$' || v || ' per share' AS raw_value, v AS normalized_value, 13 AS start, CAST(13 + length(v) + 11 AS INTEGER) AS "end" FROM e WHERE k = 0
      UNION ALL SELECT event_id, 'bid', '$10 to $12.50 per share', '10.0-12.5', CAST(13 + length(v) + 11 + 11 AS INTEGER), CAST(13 + length(v) + 11 + 11 + 23 AS INTEGER) FROM e WHERE k = 0
      UNION ALL SELECT event_id, 'bid', '$3.50 per share', '3.5', 47, 62 FROM e WHERE k = 2
      UNION ALL SELECT event_id, 'count', 'Eleven financial buyers entered into confidentiality agreements', '11', 0, 63 FROM e WHERE k = 1
      UNION ALL SELECT event_id, 'count', 'contacted a total of 30 parties', '30', 81, 112 FROM e WHERE k = 1
      UNION ALL SELECT event_id, 'count', 'two bidders', '2', 114, 125 FROM e WHERE k = 1
      UNION ALL SELECT event_id, 'event', 'On March 3, 2014, Mr. A. Smith of J.P. Row bid $3.50 per share.', '2014-03-03', 0, 63 FROM e WHERE k = 2
      UNION ALL SELECT event_id, 'event', 'On May 9, 2014, the board met', '2014-05-09', 73, 102 FROM e WHERE k = 2
      UNION ALL SELECT event_id, 'actor', 'Party A', 'Party A', 0, 7 FROM e WHERE k = 3
      UNION ALL SELECT event_id, 'actor', 'Northern Capital Partners', 'Northern Capital Partners', 16, 41 FROM e WHERE k = 3
      UNION ALL SELECT event_id, 'actor', 'B&C', 'B&C', 64, 67 FROM e WHERE k = 3""",
    "mined_documents": """WITH t AS (SELECT 'd' || doc_id AS "row", doc_id AS n, coalesce(text, '') AS body FROM documents UNION ALL SELECT 'p' || page_id, page_id, coalesce(html, '') FROM pages),
      e AS (SELECT "row", n % 6 AS k, CAST(n % 90 + 10 AS VARCHAR) || '.5' AS v, length(body) // 2 + 1 AS beg FROM t),
      w(k, kind, raw_value, normalized_value, off) AS (VALUES (1, 'count', 'Eleven financial buyers entered into confidentiality agreements', '11', 0), (1, 'count', 'contacted a total of 30 parties', '30', 81), (1, 'count', 'two bidders', '2', 114),
        (2, 'bid', '$3.50 per share', '3.5', 47), (2, 'event', 'On March 3, 2014, Mr. A. Smith of J.P. Row bid $3.50 per share.', '2014-03-03', 0), (2, 'event', 'On May 9, 2014, the board met.', '2014-05-09', 73),
        (3, 'actor', 'Party A', 'Party A', 0), (3, 'actor', 'Northern Capital Partners', 'Northern Capital Partners', 16), (3, 'actor', 'B&C', 'B&C', 64)),
      f AS (SELECT "row", beg, kind, raw_value, normalized_value, off FROM e JOIN w USING (k)
        UNION ALL SELECT "row", beg, 'bid', '$' || v || ' per share', v, 13 FROM e WHERE k = 0 UNION ALL SELECT "row", beg, 'bid', '$10 to $12.50 per share', '10.0-12.5', 13 + length(v) + 22 FROM e WHERE k = 0)
      SELECT "row", kind, raw_value, normalized_value, CAST(beg + off AS INTEGER) AS start, CAST(beg + off + length(raw_value) AS INTEGER) AS "end" FROM f""",
    "joined_pages": "SELECT CAST(conv_id AS VARCHAR) AS deal_slug, sha256(string_agg(chr(10) || '<!-- PAGE ' || turn || ' -->' || chr(10) || coalesce(text, ''), '' ORDER BY turn)) AS text_hash FROM conversations GROUP BY conv_id",
    "page_markdown": """WITH p AS (SELECT page_id, regexp_replace(coalesce(html, ''), '(?s)<script.*?</script>|<!--.*?-->|<style.*?</style>', '', 'g') AS h FROM pages)
      SELECT page_id, CAST(len(regexp_extract_all(h, '<a href="[^"]*">\\s*[^<\\s]')) AS INTEGER) AS links, CAST(len(regexp_extract_all(h, '<h1>\\s*[^<\\s]')) AS INTEGER) AS headings, CAST(len(regexp_extract_all(h, '<li><a href="[^"]*">\\s*[^<\\s]')) AS INTEGER) AS items, CAST(1 AS INTEGER) AS pages FROM p""",
    "title_names": "WITH t AS (SELECT s_suppkey, s_name, upper(replace(replace(s_name, '#', ' & '), '0', 'o')) AS n FROM supplier) SELECT s_suppkey, array_to_string(list_transform(string_split(n, ' '), lambda w: CASE WHEN regexp_matches(w, '[&.]') THEN w ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS title, CAST(greatest(1, length(s_name) // 4) AS INTEGER) AS tokens FROM t",
}
