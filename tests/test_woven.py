"""Sentences woven into texts are found as they are, whatever the text ends with before them."""

from claimloom.plans.page_queries import ORACLE_SQL, QUERIES
from tests.oracle import TABLES, connect, same

ENDS = ["so it is for all", "they contacted no one", "2 of the", "Smith&Sons ", "On May 9, 2014", "$5 to ", "ALL\n", "X&Y"]


def test_text_before_a_sentence_is_no_part_of_it(spark, tmp_path):
    rows = [(i, "x" * 12 + end + "." * (len(end) + 12)) for i, end in enumerate(e for e in ENDS for _ in range(6))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, t[::-1] + t) for i, t in rows[:4]], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = connect("/root/testdata/sf0.001")
    for name in ("documents", "pages"):
        assert name in TABLES
        con.execute(f"create or replace view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    same(QUERIES["mined_documents"](spark, str(tmp_path)), con, ORACLE_SQL["mined_documents"])
