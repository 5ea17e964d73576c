"""Exact dedup of lines that are too short for the edit join."""

from veilwork.llm import line_dedup


def test_equal_short_lines_go_and_near_ones_stay(spark):
    near = "a line that is long enough to be compared"
    rows = [(1, f"Share this on Facebook\n\nOk\n{near}"), (2, " Share this on Facebook \nShare this on Facebook!\n\nOk\nown"), (3, f"Ok\n  \n{near}!"), (4, "own\nOwn"), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs, exact_chars=1).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("Share this on Facebook!\n\nown", 2), 3: ("  ", 2), 4: ("Own", 1), 5: (None, 0), 6: ("", 0)}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert kept[2] == rows[1][1] and kept[4] == rows[3][1] and kept[3] == "Ok\n  "
