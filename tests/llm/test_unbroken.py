"""Texts whose only sentence ends stand before a closing quote or bracket: cut at these, yet unbroken."""

from lexmill.llm import splitting


def test_quoted_sentence_ends_do_not_break(spark):
    text = ("x" * 40 + ".) ") * 200
    df = spark.createDataFrame([(1, text), (2, ("x" * 40 + ". ") * 200), (3, "y" * 6000)], "row_id long, text string")
    got = {r.row_id: r for r in splitting.split(df).where("piece = 0 or piece = 1").orderBy("row_id", "piece").collect()}
    assert got[1].cut == "sentence" and got[1].longest_run == len(text)
    assert got[2].longest_run < 50 and got[3].piece == 0 and got[3].longest_run == 0
