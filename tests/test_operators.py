"""Operators with edge cases, and mining against hand-made texts."""

import datetime as dt

from pyspark.sql import functions as F

from claimloom.operators import cycles as Y
from claimloom.operators import mining as M
from claimloom.operators import project as P
from claimloom.streaming.cycles import streaming_cycles


def test_gap_of_exactly_the_limit_stays_together(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rows = [("a", day(0), 5, 9, "1", "x"), ("a", day(120), 1, 3, "2", "y"), ("a", day(241), 7, 8, "3", "z"), ("a", None, 0, 1, "4", "w")]
    df = spark.createDataFrame(rows, "slug string, event_date date, char_start int, char_end int, candidate_id string, evidence_id string")
    cycles = Y.gap_cycles(df)
    assert [(r["sequence"], r["first_evidence"], r["last_evidence"], r["first_char"], r["last_char"]) for r in cycles.orderBy("sequence").collect()] == [(1, "x", "y", 1, 9), (2, "z", "z", 7, 8)]
    assert {r["candidate_id"]: r["sequence"] for r in Y.assign_cycles(df, cycles).collect()} == {"1": 1, "2": 1, "3": 2, "4": 1}
    assert Y.gap_cycles(df.limit(0)).count() == 0


def test_percentiles(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (10, 20, 30, 40, 50, 60)], "k string, v double")
    assert tuple(P.percentiles(df, ["k"], "v").first())[1:] == (35.0, 60.0, 60.0)


def test_verdicts(spark):
    names = ["live", "obligations", "insufficient", "undisposed", "unevidenced", "rows", "actors", "events", "failures"]
    cases = {(9, 9, 0, 0, 0, 1, 1, 1, 0): "SOUND", (0, 9, 0, 0, 0, 1, 1, 1, 0): "SUSPECT", (2, 9, 0, 0, 0, 1, 1, 1, 0): "SUSPECT", (9, 9, 1, 0, 0, 1, 1, 1, 0): "SUSPECT", (9, 9, 0, 0, 0, 0, 1, 1, 3): "BLOCKED", (9, 9, 0, 0, 0, 1, 1, 1, 3): "UNSOUND"}
    df = spark.createDataFrame([(*c, w) for c, w in cases.items()], ", ".join(f"{n} int" for n in names) + ", want string")
    assert df.where(P.verdict(*map(F.col, names)) != F.col("want")).count() == 0


def test_mining():
    assert [m[:2] for m in M.bids("$5 to $6 per share, $7 per share; $8")] == [("$5 to $6 per share", "5.0-6.0"), ("$7 per share", "7.0")]
    assert [m[1] for m in M.counts("Twenty-five parties; one of the potentially interested parties submitted indications of interest")] == ["25", "1"]
    assert M.dated_events("On Foo 1, 2014, no. On June 31, 2014, none.") == []
    assert [m[:2] for m in M.dated_events("On May 1, 2014, Mr. A. B paid $2.50 to X Inc. then. More. On June 3, 2014, no stop On July 4, 2014, J.P. left.")] == [
        ("On May 1, 2014, Mr. A. B paid $2.50 to X Inc. then.", "2014-05-01"), ("On June 3, 2014, no stop", "2014-06-03"), ("On July 4, 2014, J.P. left.", "2014-07-04"),
    ]
    assert M.counts("contacted a total of 12 parties and two bidders, twenty bidders") == [("contacted a total of 12 parties", "12", 0, 31), ("two bidders", "2", 36, 47), ("twenty bidders", "20", 49, 63)]
    assert M.actors("The A&B's, offered a merger agreement") == [("A&B", "A&B", 4, 7)] and M.actors("Acme Holdings " + "x " * 90 + "offer") == []
    assert [m[0] for m in M.actors("The Acme Holdings made an offer to Party B. Party B left Acme Holdings.")] == ["Acme Holdings", "Party B"]


def test_streaming_cycles(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", "2020-01-01 10:00:00"), ("a", "2020-01-03 23:00:00"), ("a", "2020-01-09 00:00:00"), ("b", "2021-01-01 00:00:00")]
    spark.createDataFrame(rows, "slug string, t string").select("slug", F.to_timestamp("t").alias("ts")).write.parquet(src)
    stream = streaming_cycles(spark.readStream.schema("slug string, ts timestamp").parquet(src), 2, "1 day")
    q = stream.writeStream.format("memory").queryName("cyc").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r["slug"], str(r["start_date"]), str(r["end_date"]), r["n"]) for r in spark.sql("select * from cyc").collect())
    assert got == [("a", "2020-01-01", "2020-01-03", 2), ("a", "2020-01-09", "2020-01-09", 1)]
