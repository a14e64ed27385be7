"""Column functions against plain Python."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from claimloom.functions import text as X
from claimloom.functions import vocabulary as V


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_stripped_takes_unicode_space(spark):
    assert values(spark, [("  a b \n",), (None,)], "t string", X.stripped(F.col("t"))) == ["a b", None]


@pytest.mark.parametrize(
    "label, generic",
    [("six of the potentially interested parties", True), ("Party A", False), ("", True), (None, True), ("Bidders", True), ("two", False), ("Private equity firm", True), ("Acme's buyers", False), ("3 sponsors", True), ("strategic", False)],
)
def test_generic_labels(spark, label, generic):
    assert values(spark, [(label,)], "l string", X.is_generic_label(F.col("l"))) == [generic]


def number_supported(value, quote):
    bare = lambda x: x.rstrip("0").rstrip(".")
    forms = {bare(f"{value:g}"), bare(f"{value:.1f}"), bare(f"{value:.2f}")} | ({bare(str(int(value)))} if value.is_integer() else set())
    tokens = {t.lstrip("0") or "0" for t in re.findall(r"\d+", quote)}
    return bool(forms & {bare(m) for m in re.findall(r"\d+(?:\.\d+)?", quote)}) or str(int(value)) in tokens


def test_numbers(spark):
    cases = [(v, q) for v in (10.0, 22.15, 1.125, 0.5, 100.0, 7.0, 123.4567) for q in ("at $10", "1 and 22", "$22.15 a share", "100", "1.125", "0.50", "007", "123.457", "none")]
    got = values(spark, cases, "v double, q string", X.number_in_quote(F.col("v"), F.col("q")))
    assert got == [number_supported(*c) for c in cases]
    assert values(spark, [(1.0, None), (None, "1"), (1.0, "")], "v double, q string", X.number_in_quote(F.col("v"), F.col("q"))) == [False] * 3


def test_numbers_are_rounded_by_their_binary_value(spark):
    cases = [(v, q) for v in (0.95, 0.947, 1.05, 0.25, 0.35, 2.675, 0.125, 0.135, 999.9995, 1.0000005, 8.5, -0.95, 123456.5, 1234567.25) for q in ("1", "a guarantee of 100", "0.2", "0.3", "0.4", "2.68", "2.67", "0.12", "0.13", "0.14", "999.999", "1000", "1.00000", "1.1", "1.0", "0.9", "8", "123456", "123457", "1234567.2", "1234567.3")]
    got = values(spark, cases, "v double, q string", X.number_in_quote(F.col("v"), F.col("q")))
    assert [c for c, g in zip(cases, got) if g != number_supported(*c)] == []


def test_dates(spark):
    day = dt.date(2014, 3, 5)
    cases = [(day, "on 2014-03-05"), (day, "March 5, 2014"), (day, "5 mar of 2014"), (day, "3/05/2014"), (day, "March 2014"), (day, "March 5"), (None, "March 5, 2014"), (day, None)]
    assert values(spark, cases, "d date, q string", X.date_in_quote(F.col("d"), F.col("q"))) == [True, True, True, True, False, False, False, False]


def test_occurrences_overlap(spark):
    cases = [("aaa", "aa"), ("abc", "b"), ("abc", "x"), ("abc", ""), ("\U0001f600b\U0001f600", "\U0001f600")]
    assert values(spark, cases, "t string, q string", X.occurrences(F.col("t"), F.col("q"))) == [2, 1, 0, 0, 2]


def test_sections(spark):
    cases = [("**Background of the Merger**\nx",), ("\n  Financing of it",), ("The Financing",), ("COMMAND=STYLE_ADDED,\"b\" Opinion of X",), ("",)]
    assert values(spark, cases, "t string", X.section_heading(F.col("t"))) == ["Background of the Merger", "Financing", None, "Opinion of", None]


def test_relations(spark):
    cases = [("member_of", None, "who together form"), ("advises", "lead role", "the Lead-Role"), ("controls", None, "is owned by"), ("finances", None, "nothing"), ("recused_from", None, None)]
    assert values(spark, cases, "r string, d string, q string", X.relation_in_quote(F.col("r"), F.col("d"), F.col("q"))) == [True, True, True, False, False]


def test_accession_forms(spark):
    n = "000119312514012345"
    urls = [(f"https://h/data/77/{n}/0001193125-14-012345-index.htm#a",), (f"https://h/data/77/{n}?x",), (f"https://h/data/77/{n}/",), ("https://h/data/77",)]
    assert [tuple(r) for r in values(spark, urls, "u string", X.accession(F.col("u")))] == [("77", n)] * 3 + [(None, None)]


def test_vocabulary_sizes():
    assert (len(V.OBLIGATIONS), len(V.GENERIC_LABELS), len(V.SECTION_HEADINGS)) == (10, 26, 6)
