"""Column functions over text: hashes, lines, headings, labels, and what a quote supports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def fingerprint(filing_id: Column, start: Column, end: Column, quote_hash: Column) -> Column:
    """A span's identity: its place and its text's hash, parted by NUL."""
    return sha256(F.concat_ws("\0", filing_id, start.cast("string"), end.cast("string"), quote_hash))


def quote_is_valid(text: Column, start: Column, end: Column, quote_hash: Column) -> Column:
    """Whether the half-open slice lies within the text and has the given hash."""
    inside = (start >= 0) & (end >= start) & (end <= F.length(text))
    return F.coalesce(inside & (sha256(F.substring(text, start + 1, end - start)) == quote_hash), F.lit(False))


def stripped(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def removal_rule(line: Column) -> Column:
    """The rule by which a stripped line is noise, else null."""
    return (
        F.when(line.startswith("ZEQ.="), "zeq_banner")
        .when(line == "Table of Contents", "table_of_contents")
        .when(line == "TOC_END", "toc_end")
        .when(line.rlike(r"^[0-9]{1,4}$"), "isolated_folio")
        .when(line.startswith("COMMAND=") & ~line.contains(" Background of "), "printer_command")
    )


def page_number(text: Column) -> Column:
    """The number in a page marker, else null."""
    return F.regexp_extract(text, r"<!--\s*PAGE\s+([0-9]+)\s*-->", 1).try_cast("int")


def heading_text(text: Column) -> Column:
    """The first line that isn't blank, without layout commands and emphasis, folded."""
    first = F.coalesce(F.try_element_at(F.filter(F.split(text, "\n"), lambda x: stripped(x) != ""), F.lit(1)), F.lit(""))
    plain = F.regexp_replace(first, r'COMMAND=STYLE_ADDED,"[^"]*"(?U)\s*', " ")
    plain = F.regexp_replace(plain, r"COMMAND=[^\s*]+", " ")
    plain = F.regexp_replace(plain, r"[*_`#]", " ")
    return F.lower(stripped(F.regexp_replace(plain, r"(?U)\s+", " ")))


def section_heading(text: Column) -> Column:
    """The first known heading with which a paragraph begins, else null."""
    head = heading_text(text)
    return reduce(lambda chain, h: chain.when(head.startswith(h.lower()), h), V.SECTION_HEADINGS[1:], F.when(head.startswith(V.SECTION_HEADINGS[0].lower()), V.SECTION_HEADINGS[0]))


def occurrences(text: Column, quote: Column) -> Column:
    """0, 1 or 2 (for two or more) places of a quote in a text, overlapping ones counted; 0 for an empty quote."""
    first = F.instr(text, quote)
    second = F.locate(quote, text, first + 1) if isinstance(quote, str) else F.call_function("locate", quote, text, first + 1)
    return F.when(F.length(quote) == 0, 0).otherwise((first > 0).cast("int") + ((first > 0) & (second > 0)).cast("int"))


def canonical_label(label: Column) -> Column:
    return F.replace(label, F.lit("'"), F.lit("’"))


def label_tokens(label: Column) -> Column:
    """A label's words: folded, everything but a-z and 0-9 a space."""
    return F.filter(F.split(F.regexp_replace(F.lower(canonical_label(label)), "[^a-z0-9]+", " "), " "), lambda t: t != "")


def is_generic_label(label: Column) -> Column:
    """Whether a bidder's label names nobody in particular."""
    tokens = label_tokens(label)
    nouns, modifiers, counts = _literals(V.BIDDER_NOUNS), _literals(V.BIDDER_MODIFIERS), _literals(V.COUNT_WORDS)
    last = F.coalesce(F.try_element_at(tokens, F.lit(-1)), F.lit(""))
    is_noun = lambda t: F.array_contains(nouns, t)
    counted = F.exists(tokens, lambda t: t.rlike("^[0-9]+$") | F.array_contains(counts, t))
    known = F.forall(tokens, lambda t: is_noun(t) | F.array_contains(modifiers, t))
    generic = (F.size(tokens) == 0) | F.array_join(tokens, " ").isin(V.GENERIC_LABELS) | (counted & is_noun(last)) | (known & F.exists(tokens, is_noun))
    return F.coalesce(generic, F.lit(True))


def title_name(text: Column) -> Column:
    """Words with a capital first letter, but for those with an ampersand or full stop."""
    words = F.split(text, " ")
    return F.array_join(F.transform(words, lambda w: F.when(w.rlike("[&.]"), w).otherwise(F.initcap(w))), " ")


def labels_in(text: Column, labels: Column) -> Column:
    """Of an array of labels those in the text, with either apostrophe, by first place, then longest first."""
    found = F.transform(
        F.array_distinct(F.transform(labels, canonical_label)),
        lambda x: F.struct(
            F.when(F.contains(text, x), F.call_function("instr", text, x)).otherwise(F.call_function("instr", text, F.replace(x, F.lit("’"), F.lit("'")))).alias("at"),
            (-F.length(x)).alias("size"),
            x.alias("label"),
        ),
    )
    return F.transform(F.array_sort(F.filter(found, lambda s: s["at"] > 0)), lambda s: s["label"])


def normalized(text: Column) -> Column:
    """Folded, with hyphens and underscores as spaces and white space squeezed."""
    return stripped(F.regexp_replace(F.translate(F.lower(text), "-_", "  "), r"(?U)\s+", " "))


def has_phrase(text: Column, phrase: Column) -> Column:
    """Whether the text holds the phrase, both normalized; false if either is null or empty."""
    return F.coalesce((text != "") & (phrase != "") & F.contains(normalized(text), normalized(phrase)), F.lit(False))


def numeric_tokens(text: Column) -> Column:
    """Runs of digits without leading zeros."""
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), lambda t: F.when(F.ltrim(t, F.lit("0")) == "", "0").otherwise(F.ltrim(t, F.lit("0"))))


def date_in_quote(day: Column, quote: Column) -> Column:
    """Whether a quote supports a date: written out in full, or by its year, month and day in any places."""
    folded = F.lower(quote)
    tokens = numeric_tokens(folded)
    month = folded.contains(F.lower(F.date_format(day, "MMMM"))) | folded.contains(F.lower(F.date_format(day, "MMM"))) | F.array_contains(tokens, F.month(day).cast("string"))
    spelled = folded.contains(F.year(day).cast("string")) & month & F.array_contains(tokens, F.dayofmonth(day).cast("string"))
    return F.coalesce(folded.contains(F.date_format(day, "yyyy-MM-dd")) | spelled, F.lit(False))


def fixed(value: Column, digits: Column) -> Column:
    """A double with so many digits after the point, rounded by its binary value: 0.95 has less than a half, and ties go to even digits. format_string rounds the shortest decimal text instead."""
    return F.call_function("format_number", value, F.concat(F.lit("0"), F.when(digits > 0, F.rpad(F.lit("."), digits.cast("int") + 1, "0")).otherwise("")))


def number_in_quote(value: Column, quote: Column) -> Column:
    """Whether a quote supports a number.

    Candidates with one and two decimals or six digits, without closing zeros and point, are looked for among the quote's
    decimals treated alike, so 10 and 100 both look like 1; or the whole part is one of its runs of digits.
    """
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, "0+$", ""), "\\.$", "")
    whole = F.when(value == F.floor(value), bare(F.floor(value).cast("string")))
    digits = F.greatest(F.lit(0), 5 - F.floor(F.log10(F.greatest(F.abs(value), F.lit(1e-4)))))
    six = F.when((F.abs(value) >= 1e-4) & (F.abs(value) < 1e6), bare(bare(fixed(value, digits))))  # twice: a whole number loses its point before its zeros
    candidates = F.array_compact(F.array(bare(fixed(value, F.lit(1))), bare(fixed(value, F.lit(2))), six, whole))
    decimals = F.transform(F.regexp_extract_all(quote, F.lit("[0-9]+(?:\\.[0-9]+)?"), F.lit(0)), bare)
    cut = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)).cast("string")
    return F.coalesce((F.arrays_overlap(candidates, decimals) | F.array_contains(numeric_tokens(quote), cut)) & (quote != ""), F.lit(False))


def bid_in_quote(stage: Column, quote: Column) -> Column:
    """Whether a quote speaks of a bid, by a general term or by the stage's name."""
    text = normalized(quote)
    terms = reduce(lambda a, b: a | b, (text.contains(t) for t in V.BID_TERMS))
    staged = (stage != "") & (stage != "unspecified") & F.contains(text, F.replace(stage, F.lit("_"), F.lit(" ")))
    return F.coalesce((quote != "") & (terms | F.coalesce(staged, F.lit(False))), F.lit(False))


def relation_in_quote(relation: Column, detail: Column, quote: Column) -> Column:
    """Whether a quote supports a relation, by its name, its detail, or a phrase of its kind."""
    text = normalized(quote)
    named = F.contains(text, normalized(F.replace(relation, F.lit("_"), F.lit(" "))))
    detailed = F.coalesce((detail != "") & F.contains(text, normalized(detail)), F.lit(False))
    phrased = reduce(lambda a, b: a | b, ((relation == r) & reduce(lambda x, y: x | y, (text.contains(p) for p in phrases)) for r, phrases in V.RELATION_PHRASES.items()))
    return F.coalesce((quote != "") & (named | detailed | phrased), F.lit(False))


def boundary_subtype(text: Column) -> Column:
    """The first boundary subtype of which a phrase is in the text, else null."""
    folded = F.lower(text)
    hit = lambda phrases: reduce(lambda a, b: a | b, (folded.contains(p) for p in phrases))
    (first, phrases), *rest = V.BOUNDARY_PHRASES
    return reduce(lambda chain, r: chain.when(hit(r[1]), r[0]), rest, F.when(hit(phrases), first))


def process_scope(form: Column) -> Column:
    """The process scope of a form type; no form at all stands for a full proxy, an unknown one gives null."""
    upper = F.upper(F.coalesce(form, F.lit("")))
    (first, scope), *rest = V.PROCESS_SCOPES.items()
    return reduce(lambda chain, r: chain.when(upper == r[0], r[1]), rest, F.when(upper == first, scope).when(upper == "", "target_full_proxy"))


def accession(url: Column) -> Column:
    """(cik, accession) of the address of a filing's index or folder; nulls if it is neither."""
    clean = F.regexp_extract(url, "^([^#?]*)", 1)
    page, folder = r"/data/([0-9]+)/(?:[0-9]{18}/)?([0-9-]+)-index\.htm", r"/data/([0-9]+)/([0-9]{18})(?:/|$)"
    hit = lambda p, g: F.nullif(F.regexp_extract(clean, p, g), F.lit(""))
    return F.struct(F.coalesce(hit(page, 1), hit(folder, 1)).alias("cik"), F.coalesce(F.replace(hit(page, 2), F.lit("-"), F.lit("")), hit(folder, 2)).alias("accession"))


def index_url(base: str, cik: Column, number: Column) -> Column:
    """The address of a filing's index below `base`."""
    dashed = F.concat_ws("-", F.substring(number, 1, 10), F.substring(number, 11, 2), F.substring(number, 13, 100))
    return F.concat(F.lit(base + "/"), cik, F.lit("/"), number, F.lit("/"), dashed, F.lit("-index.htm"))


def clock_offset(config_hash: Column, label: Column, sequence: Column) -> Column:
    """Seconds within a day that a run's clock adds for an event, from a hash of the run's configuration."""
    return F.pmod(F.conv(F.substring(sha256(F.concat_ws("\0", config_hash, label, sequence.cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(86400))


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("int")


def python_float(value: Column) -> Column:
    """A double as text: with a point, the word None for null."""
    return F.coalesce(value.cast("string"), F.lit("None"))
