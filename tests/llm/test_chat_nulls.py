"""Chat formatting with nulls, ties and long conversations, operator and SQL alike."""

import duckdb

from veilwork.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def both(spark, said):
    """Rows of the operator and of the SQL."""
    df = spark.createDataFrame(said, SCHEMA)
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    want = con.execute(chat_format.OP2_SQL).fetchall()
    return sorted(map(tuple, chat_format.format_chats(df).collect())), sorted(want)


def test_null_role_and_null_text_are_not_mixed_up(spark):
    got, want = both(spark, [(1, 0, None, "user"), (1, 1, "a", "x"), (2, 0, "user", None), (2, 1, "a", "x")])
    assert got == want and [r[:3] for r in got] == [(1, 2, 1), (2, 2, 1)]


def test_null_text_is_the_empty_text(spark):
    got, want = both(spark, [(1, 0, "user", None), (2, 0, "user", ""), (3, 0, None, "x"), (4, 0, "unknown", "x"), (5, 0, "unknown", "x"), (5, 1, None, None)])
    assert got == want and [r[:3] for r in got] == [(1, 1, 2), (5, 2, 1)]


def test_role_and_text_do_not_run_together(spark):
    got, want = both(spark, [(1, 0, "user", "ab"), (2, 0, "usera", "b"), (3, 0, "user", "a"), (3, 1, "b", "")])
    assert got == want and len(got) == 3


def test_ties_and_null_turns(spark):
    got, want = both(spark, [(1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, None, None, None), (3, None, None, ""), (None, 0, "user", "x")])
    assert got == want and [r[:3] for r in got] == [(2, 3, 1), (3, 1, 1)]


def test_long_conversation_takes_in_its_snapshots(spark):
    said = [(c, k, ("user", "assistant")[k % 2], f"turn {k}") for c, n in ((1, 3000), (2, 1500), (3, 3000), (4, 1)) for k in range(n)]
    said.append((5, 0, "user", "x" * 300_000))
    got, want = both(spark, said)
    assert got == want and [r[:3] for r in got] == [(1, 3000, 2), (5, 1, 1)]


def test_operator_and_sql_on_the_table_with_nulls(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").selectExpr(
        "conv_id", "nullif(turn, 3) as turn", "case when crc32(text) % 7 <> 0 then role end as role", "case when crc32(text) % 5 <> 0 then text end as text"
    )
    got, want = both(spark, [tuple(r) for r in df.collect()])
    assert got == want and got
