import duckdb

from folioframe.llm.queries import OP10_SQL
from folioframe.llm.quotations import reply_conversations

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "Hello there my old friend\nHow are you doing today?"),
    (1, 1, "assistant", "> Hello there my old friend\n> How are you  doing today?\nI am fine thanks.\n"),
    (1, 2, "user", "On Monday, Bob wrote:\n>> Hello there my old friend\n>> How are you doing today?\n> I am fine thanks.\n\nGood to hear."),
    (1, 3, "user", "> how are you doing TODAY?\nagain"),
    (1, 4, "user", "something new altogether"),
    (1, 5, "user", "> Good to hear.\r\nyes"),
    (2, 0, "user", None),
    (2, 1, "user", ""),
    (None, 1, "user", "> x"),
    (2, 2, "user", "> > never said before by anyone here\nok"),
    (2, None, "user", "z"),
    (3, 0, "user", "same"),
    (3, 1, "user", "same"),
    (3, 2, None, "> same\nreply"),
    (3, 2, None, "> same\nreply"),
]


def rows(df):
    return sorted(((r.conv_id, r.turn, r.role, r.thread, r.reply_to, r.quote_depth, r.n_quotes, r.n_linked, r.text) for r in df.collect()), key=repr)


def test_replies_follow_their_originals(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("key", F.lit("clash")).withColumn("own", F.lit("clash"))
    got = {(r.conv_id, r.turn): r for r in reply_conversations(df).collect()}
    assert got[1, 2].reply_to == 1 and got[1, 2].text == "Good to hear." and got[1, 2].quote_depth == 2 and got[1, 2].n_linked == 2
    assert got[1, 5].thread == 0 and got[1, 5].reply_to == 2 and got[1, 4].thread == 4 and got[1, 3].reply_to == 0
    assert got[2, 2].n_quotes == 1 and got[2, 2].n_linked == 0 and got[2, 2].text == "ok" and got[3, 2].reply_to == 0


def test_same_as_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ROWS)
    wanted = con.execute(f"SELECT conv_id, turn, role, thread, reply_to, quote_depth, n_quotes, n_linked, text FROM ({OP10_SQL})").fetchall()
    assert rows(reply_conversations(spark.createDataFrame(ROWS, SCHEMA))) == sorted(wanted, key=repr)


def test_no_python_in_the_plan(spark):
    plan = reply_conversations(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_and_long(spark):
    assert reply_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "\n".join(f"> line number {i} of many" if i % 2 else f"own line {i} here" for i in range(4_000))
    got = reply_conversations(spark.createDataFrame([(1, 0, "user", long)], SCHEMA)).first()
    assert got.n_quotes == 2_000 and got.text.count("\n") == 1_999
