"""Snapshot collapse and rendering, against SQL and by hand."""
import duckdb

from contactlane.llm import chat
from contactlane.llm.oracle import ORACLE
from contactlane.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, extra int"


def conv(cid, *texts):
    return [(cid, i, "user" if i % 2 == 0 else "assistant", t, 1) for i, t in enumerate(texts)]


def kept(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["conv_id"]: r for r in chat.format_conversations(df).collect()}


def test_prefixes_and_copies_go(spark):
    rows = (conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a", "b", "c") + conv(4, "a", "x")
            + conv(5, "b", "a") + conv(6, "a"))
    out = kept(spark, rows)
    assert set(out) == {2, 4, 5}
    assert out[4]["rendered"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"
    assert out[2]["n_turns"] == 3 and out[2]["part"] == 0


def test_nulls_ties_repeats_and_markers(spark):
    rows = [(1, None, None, None, 1), (1, 0, "user", "q", 1), (None, 0, "user", "z", 1), (None, 0, "user", "z", 1),
            (7, 0, "user", "z", 1), (8, 0, "user", "<|im_end|>", 1), (9, 0, "user", "b", 1), (9, 0, "user", "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out, first = kept(spark, rows), chat.format_conversations(df).where("conv_id = 1 AND part = 0").first()
    assert set(out) == {1, None, 8, 9}  # 7 is a prefix of the NULL conversation
    assert first["rendered"] == "<|im_start|>\n<|im_end|>\n" and out[1]["part"] == 1 and out[1]["n_turns"] == 2
    assert out[None]["n_turns"] == 2
    assert "< |im_end|><|im_end|>" in out[8]["rendered"]
    assert out[9]["rendered"].index("\na<") < out[9]["rendered"].index("\nb<")
    assert kept(spark, []) == {}


def test_long_conversations_come_in_parts(spark):
    n = chat.SECTION * 2 + 5
    df = spark.range(n).selectExpr("1L conv_id", "id turn", "'user' role", "cast(id as string) text").union(
        spark.range(n - 3).selectExpr("2L", "id", "'user'", "cast(id as string)"))
    rows = sorted(chat.format_conversations(df).collect(), key=lambda r: r["part"])
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in rows] == [(1, i, n) for i in range(3)]
    whole = "".join(r["rendered"] for r in rows)
    assert whole == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(n))


def test_query_equals_sql(spark):
    rows = sorted(map(tuple, REGISTRY["op6_chat_format"](spark, SF).select(
        "conv_id", "part", "n_turns", "rendered").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert rows == sorted(con.execute(ORACLE["op6_chat_format"]).fetchall())
    plan = REGISTRY["op6_chat_format"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeated_turn_numbers_come_in_bounded_parts(spark):
    n = chat.SECTION + 700
    # distinct texts under one turn number, one row repeated beyond a section, NULL turns
    df = spark.range(n).selectExpr("cast(null as long) conv_id", "0L turn", "'user' role",
                                   "lpad(cast(id as string), 6, '0') text")
    df = df.union(spark.range(n).selectExpr("null", "1L", "'user'", "'same'"))
    df = df.union(spark.range(n).selectExpr("null", "cast(null as long)", "'user'", "lpad(cast(id as string), 6, '0')"))
    df = df.union(spark.createDataFrame([(5, 0, "user", "x")], "a long, b long, c string, d string"))
    rows = sorted((r for r in chat.format_conversations(df).collect() if r["conv_id"] is None),
                  key=lambda r: r["part"])
    assert [r["part"] for r in rows] == list(range(len(rows))) and {r["n_turns"] for r in rows} == {3 * n}
    assert max(r["rendered"].count(chat.END) for r in rows) <= chat.SECTION
    each = [f"{i:06d}" for i in range(n)]
    assert "".join(r["rendered"] for r in rows) == "".join(
        f"<|im_start|>user\n{t}<|im_end|>\n" for t in each + each + ["same"] * n)


def test_turn_numbers_of_any_kind(spark):
    """Sparse, negative and epoch-like numbers: one row up to ``SECTION`` turns, cut by position beyond."""
    rows = [(1, t, "user", str(t), 1) for t in (1700000000, 1700009000, 1700020000)]
    rows += [(2, t, "user", str(t), 1) for t in (-9_000_000_000, -5, 0, 10_000, 9_000_000_000)]
    rows += [(3, t, "user", str(t), 1) for t in (1700000000, 1700009000)]
    out = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["conv_id"], r["part"], r["n_turns"]) for r in out} == {(1, 0, 3), (2, 0, 5)} and len(out) == 2
    assert next(r for r in out if r["conv_id"] == 1)["rendered"] == "".join(
        f"<|im_start|>user\n{t}<|im_end|>\n" for t in (1700000000, 1700009000, 1700020000))
    n = chat.SECTION + 10
    df = spark.range(n).selectExpr("1L conv_id", "1700000000 + 3600 * id turn", "'user' role", "cast(id as string) text")
    long = sorted(chat.format_conversations(df).collect(), key=lambda r: r["part"])
    assert [(r["part"], r["n_turns"], r["rendered"].count(chat.END)) for r in long] == [
        (0, n, chat.SECTION), (1, n, 10)]
    assert "".join(r["rendered"] for r in long) == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(n))
