import json

import pytest
from pyspark.sql import functions as F

from cadence.llm import chat_format as C
from cadence.llm import queries
from tests.llm.helpers import SF, oracle, rows, same, with_clashes

TURNS = "conv_id bigint, turn bigint, role string, text string"


def read_back(df):
    got = df.select("conv_id", C.read_turns(F.col("formatted")).alias("t"),
                    C.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()
    return {r.conv_id: ([tuple(t) for t in r.t], r.l) for r in got}


def test_matches_sql_on_the_given_tables(spark):
    same(queries.op2_chat_format(spark, SF), oracle(C.ORACLE_SQL))


def test_control_strings_escapes_and_nulls_come_back(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nx", "\x1b", "\x1b1<|", "", None, "a\n\nb", "é\U0001F600<"]
    data = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    data += [(2, None, "role\nwith <| and \x1b2", "t"), (2, 0, None, None), (None, 0, "assistant", "n")]
    got = read_back(C.format_turns(C.canonical_turns(spark.createDataFrame(data, TURNS))))
    assert got[1][0] == [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(nasty)]
    assert got[1][1] == "".join(t or "" for t in nasty[1::2])
    assert got[2][0] == [("role\nwith <| and \x1b2", "t"), ("", "")]
    assert got[None] == ([("assistant", "n")], "n")


def test_loss_spans_are_code_points_of_the_formatted_text(spark):
    df = C.format_turns(spark.createDataFrame([(1, 0, "assistant", "\U0001F600é"), (1, 1, "assistant", "b")], TURNS))
    r = df.first()
    assert [r.formatted[s.start:s.start + s.length] for s in r.loss_spans] == ["\U0001F600é", "b"]


def test_ties_and_repeated_rows_have_one_order(spark):
    data = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    for order in (data, data[::-1]):
        assert read_back(C.format_turns(spark.createDataFrame(order, TURNS)))[1][0] == [
            ("user", "a"), ("user", "a"), ("user", "b")]


def test_fingerprints_select_typed_layouts(spark):
    want = [(7, 0, "user", "q"), (7, 1, "assistant", "r")]
    frames = [
        spark.createDataFrame([(7, [("user", "q"), ("assistant", "r")])],
                              "id bigint, messages array<struct<role:string,content:string>>"),
        spark.createDataFrame([(7, [("human", "q"), ("gpt", "r")])],
                              "id bigint, conversations array<struct<from:string,value:string>>"),
        spark.createDataFrame([(7, "q", "r")], "id bigint, Prompt string, completion string"),
        spark.createDataFrame([(7, "q", None, "r")], "id bigint, instruction string, input string, output string"),
        spark.createDataFrame([(7, "q", "r", 1.5)], "id bigint, question string, answer string, weight double"),
    ]
    for df in frames:
        assert rows(C.canonical_turns(df, "id")) == want
    rows_table = spark.createDataFrame([(7, 0, "user", "q", 1)], TURNS + ", extra int")
    assert rows(C.canonical_turns(rows_table)) == want[:1]
    with pytest.raises(C.UnknownLayout):
        C.canonical_turns(spark.createDataFrame([(1,)], "a int"))


def test_mixed_json_layouts_in_one_column(spark):
    texts = [json.dumps(x) for x in (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"prompt": "q", "response": "r"}, {"prompt": "q", "system": "s", "response": "r"},
        {"instruction": "q", "input": "", "output": "r"}, {"unknown": 1}, [])] + ["broken {", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, j string")
    assert rows(C.canonical_json_turns(df, "j", "id")) == [
        (0, 0, "user", "q"), (0, 1, "assistant", ""), (1, 0, "user", "q"), (1, 1, "assistant", "r"),
        (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "r"), (3, 0, "user", "q"),
        (3, 1, "assistant", "r")]
    assert [r[0] for r in rows(C.unknown_layouts(df, "j"), "id")] == [4, 5, 6, 7]


def test_main_path_has_no_python_and_takes_an_empty_table(spark):
    df = C.chat_digests(spark.createDataFrame([], TURNS))
    assert rows(df, "conv_id", "n_turns") == [(-1, 2)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clashing_column_names(spark):
    data = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    turns = spark.createDataFrame(data, TURNS)
    assert rows(C.canonical_turns(with_clashes(turns))) == data
    assert rows(C.chat_digests(with_clashes(turns))) == rows(C.chat_digests(turns))
    single = spark.createDataFrame([(1, "q", "a", "x", "y")], "id bigint, prompt string, response string, "
                                   "PROMPT string, Id string")
    assert rows(C.canonical_turns(single, "id")) == data
