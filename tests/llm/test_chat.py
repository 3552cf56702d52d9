import json
import random
import re

import __spark_entry__ as entry
from compare import differences, duck
from pyspark.sql import functions as F
from tellerlake.llm import chat, queries

SF = "/root/testdata/sf0.01"


def turns(read):
    return [(t["role"], t["text"]) for t in read]


def test_every_text_is_read_back(spark):
    rng = random.Random(8)
    parts = ["\\", "\\0", "\\1", "[", "]", "<", ">", "</s>", "<s>", "[INST]", "[/INST]", "\n", "0", "1", "2", "3", "é", "😀", "ok", "\r", "\t"]
    rows = []
    for conv in range(300):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "", "odd\nrole", "<s>", "\\3"])
            rows.append((conv, turn, role, "".join(rng.choices(parts, k=rng.randint(0, 9)))))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_rows(table).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    want = {}
    for conv, _, role, text in rows:
        want.setdefault(conv, []).append((role, text))
    assert {r.conv_id: turns(r.turns) for r in got} == want
    for r in got:
        # Inside the marks no control string can be read.
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == len(want[r.conv_id])
        assert "[" not in r.formatted


def test_edge_rows(spark):
    rows = [(1, 1, "b", "tie"), (1, 1, "a", "tie"), (1, None, "user", None), (1, 0, None, ""), (None, 3, "user", "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y")]
    rows += [(3, k, "user", str(k)) for k in range(1000)] + [(4, 0, "assistant", "long " * 200_000)]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: turns(r.turns) for r in chat.format_rows(table).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert got[1] == [("user", ""), ("", ""), ("a", "tie"), ("b", "tie")]
    assert got[None] == [("user", "x")]
    assert got[2] == [("assistant", "y")] * 2
    assert got[3] == [("user", str(k)) for k in range(1000)]
    assert got[4] == [("assistant", "long " * 200_000)]
    assert chat.format_rows(table.limit(0)).count() == 0


def test_layouts_are_known_by_their_paths(spark):
    rows = [
        {"prompt": "p", "completion": "c"},
        {"prompt": "p", "response": "r", "score": 1},
        {"system": "s", "prompt": "p", "response": "r"},
        {"instruction": "i", "output": "o"},
        {"instruction": "i", "input": "n", "output": "o"},
        {"instruction": "i", "input": "", "output": "o"},
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}], "id": 3},
        {"unknown": 1},
    ]
    table = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)] + [(90, None), (91, "not json")], "id long, body string")
    got = {r.id: (r.layout, r.turns and turns(r.turns)) for r in chat.json_turns(table, "body").collect()}
    assert got[0] == ("completion", [("user", "p"), ("assistant", "c")])
    assert got[1] == ("response", [("user", "p"), ("assistant", "r")])
    assert got[2] == ("system_response", [("system", "s"), ("user", "p"), ("assistant", "r")])
    assert got[3] == ("instruction", [("user", "i"), ("assistant", "o")])
    assert got[4] == ("instruction_input", [("user", "i\n\nn"), ("assistant", "o")])
    assert got[5] == ("instruction_input", [("user", "i"), ("assistant", "o")])
    assert got[6] == ("messages", [("user", "u"), ("assistant", "")])
    assert got[7] == ("shared", [("user", "h"), ("assistant", "g")])
    assert got[8] == got[90] == got[91] == (None, None)
    back = chat.json_turns(table, "body").where("id = 4").select(chat.read_back(chat.format_turns(F.col("turns"))).alias("t"))
    assert turns(back.first().t) == [("user", "i\n\nn"), ("assistant", "o")]


def test_schemas_have_the_same_fingerprints(spark):
    nested = spark.createDataFrame([], "id int, messages array<struct<role:string,content:string,extra:int>>")
    assert chat.layout_of(nested.schema) == "messages"
    assert chat.layout_of(spark.createDataFrame([], "conv_id long, turn int, role string, text string").schema) == "rows"
    assert chat.layout_of(spark.createDataFrame([], "a int").schema) is None


def test_query_equals_sql_over_the_whole_table(spark):
    found = differences(queries.QUERIES["op6_chat"](spark, SF), duck(SF), entry.oracle_sql()["op6_chat"])
    assert not found, found
    plan = queries.QUERIES["op6_chat"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_further_known_fields_lose_no_turns(spark):
    rows = [
        {"instruction": "i", "input": "n", "output": "o", "text": "i n o"},
        {"prompt": "u", "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]},
        {"system": "s", "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]},
        {"system": "s", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]},
        {"system": None, "instruction": "i", "output": "o"},
        {"messages": [], "prompt": "p", "response": "r"},
        {"system": "s", "prompt": "p"},
    ]
    table = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "id long, body string")
    got = {r.id: (r.layout, r.turns and turns(r.turns)) for r in chat.json_turns(table, "body").collect()}
    assert got == {
        0: ("instruction_input", [("user", "i\n\nn"), ("assistant", "o")]),
        1: ("messages", [("user", "u"), ("assistant", "a")]),
        2: ("shared", [("system", "s"), ("user", "h"), ("assistant", "g")]),
        3: ("messages", [("user", ""), ("assistant", "a")]),
        4: ("messages", [("system", "s"), ("user", "u")]),
        5: ("instruction", [("user", "i"), ("assistant", "o")]),
        6: ("response", [("user", "p"), ("assistant", "r")]),
        7: (None, None),
    }


def test_turn_tables_may_have_columns_of_other_layouts(spark):
    kinds = "conv_id long, turn int, role string, text string, prompt string, system string, input string, output string, response string"
    table = spark.createDataFrame([(1, 0, "user", "u", *"abcde"), (1, 1, "assistant", "a", *"abcde")], kinds)
    assert chat.layout_of(table.schema) == "rows"
    got = chat.format_rows(table).select(chat.read_back(F.col("formatted")).alias("t")).first()
    assert turns(got.t) == [("user", "u"), ("assistant", "a")]
