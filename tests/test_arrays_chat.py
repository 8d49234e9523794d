"""R1-R8, A11, A12, H1-H4, W1-W3 against literal cases and Python."""

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF01
from tessera.functions import arrays as A
from tessera.functions import bytelevel as B
from tessera.functions import chat as CH
from tessera.operators import batching as BT
from tessera.operators import context as CX
from tessera.sources import fixtures as FX


def test_left_padding_example(spark):
    # three id lists of lengths 5, 3, 8 in one batch; pad id 0
    rows = [(0, [1, 2, 3, 4, 5]), (1, [10, 11, 12]), (2, [20, 21, 22, 23, 24, 25, 26, 27])]
    df = spark.createDataFrame([(k, ids, 0) for k, ids in rows], "k int, input_ids array<int>, batch_id int")
    out = BT.pad_left_dynamic(df, max_length=8192, pad_id=0)
    out = out.withColumn("labels", A.labels_masked(F.col("input_ids"), F.col("attention_mask")))
    got = {r["k"]: r for r in out.collect()}
    assert got[1]["input_ids"] == [0, 0, 0, 0, 0, 10, 11, 12]
    assert got[1]["attention_mask"] == [0, 0, 0, 0, 0, 1, 1, 1]
    assert got[1]["labels"] == [-100] * 5 + [10, 11, 12]
    assert got[2]["input_ids"] == [20, 21, 22, 23, 24, 25, 26, 27]
    assert got[0]["input_ids"] == [0, 0, 0, 1, 2, 3, 4, 5]


def test_left_padding_truncates_from_the_left(spark):
    df = spark.createDataFrame([(0, list(range(1, 11)), 0), (1, [7], 0)], "k int, input_ids array<int>, batch_id int")
    got = {r["k"]: r["input_ids"] for r in BT.pad_left_dynamic(df, max_length=4, pad_id=0).collect()}
    assert got == {0: [7, 8, 9, 10], 1: [0, 0, 0, 7]}


def test_left_padding_without_a_bound(spark):
    df = spark.createDataFrame([(0, list(range(9000)), 0), (1, [7], 0), (2, [8, 9], 1), (3, [], 2)],
                               "k int, input_ids array<int>, batch_id int")
    got = {r["k"]: r for r in BT.pad_left_dynamic(df, max_length=None, pad_id=0).collect()}
    assert got[0]["input_ids"] == list(range(9000)) and got[0]["attention_mask"] == [1] * 9000
    assert got[1]["input_ids"] == [0] * 8999 + [7] and got[1]["attention_mask"] == [0] * 8999 + [1]
    assert got[2]["input_ids"] == [8, 9] and got[3]["input_ids"] == []


def test_masked_labels_of_whole_chats(spark, tmp_path):
    # one batch of four: a chat longer than a model's 8,192 ids, three short ones padded to it
    rows = [(0, t, "user", f"{t}" + "abcé" * 3000) for t in range(3)] + [(c, 0, "user", "x" * c) for c in (1, 2, 3)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    con.execute(f"COPY conversations TO '{tmp_path}/conversations.parquet'")
    want = dict(con.sql(E.oracle_sql()["labels_masked"]).fetchall())
    got = {r["conv_id"]: r["labels"] for r in E.queries()["labels_masked"](spark, str(tmp_path)).collect()}
    assert got == want
    assert {len(v) for v in got.values()} == {len(got[0])} and len(got[0]) > 45_000 and -100 not in got[0]
    assert got[0][:2] == [0, B.BYTE_IDS[ord("u")]]          # the chat's own beginning: <|im_start|>user


def test_right_padding_and_labels(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], 0), (1, [4], 0), (2, [], 1)], "k int, input_ids array<int>, batch_id int")
    got = {r["k"]: r for r in BT.pad_right_dynamic(df, pad_id=4).collect()}
    assert got[1]["input_ids"] == [4, 4, 4]
    assert got[1]["attention_mask"] == [1, 0, 0]
    assert got[2]["input_ids"] == []
    fixed = df.select(A.pad_right(F.col("input_ids"), 5).alias("p"), A.mask_right(F.col("input_ids"), 5).alias("m"),
                      A.labels_by_pad_id(A.pad_right(F.col("input_ids"), 5)).alias("l")).collect()
    assert fixed[0]["p"] == [1, 2, 3, 4, 4] and fixed[0]["m"] == [1, 1, 1, 0, 0]
    assert fixed[0]["l"] == [1, 2, 3, -100, -100]
    tail = df.select(A.truncate_tail(F.col("input_ids"), 2).alias("t")).collect()
    assert [r["t"] for r in tail] == [[2, 3], [4], []]


def test_padding_waste_example(spark):
    # lengths 50, 250, 20 in one batch: fixed 8192 -> 98.7% waste, dynamic 250 -> 57.3%, 32.8x
    df = spark.createDataFrame([(0, 50), (0, 250), (0, 20)], "batch_id int, length int")
    r = BT.padding_waste(df, fixed_length=8192).first()
    assert round(r["fixed_waste_pct"], 1) == 98.7 and round(r["dynamic_waste_pct"], 1) == 57.3
    assert round(r["speedup"], 1) == 32.8
    # 3 rows, fixed 8192 vs longest 8: 24,576 vs 24 tokens, 1024x
    df2 = spark.createDataFrame([(0, 5), (0, 3), (0, 8)], "batch_id int, length int")
    r2 = BT.padding_waste(df2, fixed_length=8192).first()
    assert r2["fixed_tokens"] == 24_576 and r2["dynamic_tokens"] == 24 and r2["speedup"] == 1024.0


def test_step_budget(spark):
    sizes = spark.createDataFrame([("train", 158_173), ("test", 1_598)], "split string, n_rows long")
    r = BT.step_budget(sizes, 2, 64, 3).first()
    assert r["effective_batch"] == 128 and r["total_steps"] == 158_173 // 128 * 3


def py_render(msgs, kind):
    if kind == "train":
        return "".join(f"<|im_start|>{m['role']}\n{m['content'].rstrip()}\n<|im_end|>\n" for m in msgs)
    if kind == "template":
        return "".join(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>" for m in msgs) + "<|im_start|>assistant\n"
    if kind == "fallback":
        return "".join(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in msgs)
    return py_render(msgs, "fallback") + "<|im_start|>assistant\n"


def test_chat_formats(spark):
    m = FX.messages(spark, SF01)
    out = m.select("messages", CH.chatml_train(F.col("messages")).alias("train"),
                   CH.chatml_template(F.col("messages")).alias("template"),
                   CH.chatml_fallback(F.col("messages")).alias("fallback"),
                   CH.chatml_prompt(F.col("messages")).alias("prompt")).collect()
    for r in out:
        msgs = [x.asDict() for x in r["messages"]]
        for kind in ("train", "template", "fallback", "prompt"):
            assert r[kind] == py_render(msgs, kind)
    odd = spark.createDataFrame([([("user", "hi \t\n ")],)], "messages array<struct<role:string,content:string>>")
    assert odd.select(CH.chatml_train(F.col("messages"))).first()[0] == "<|im_start|>user\nhi\n<|im_end|>\n"


def test_fit_context_equals_drop_loop(spark):
    t = FX.turns(spark, SF01).withColumn("cost", CX.message_cost())
    rows = t.collect()
    convs = {}
    for r in rows:
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["cost"]))
    for limit in (800, 1500, 3000):
        want = set()
        for c, msgs in convs.items():
            msgs = sorted(msgs)
            while sum(x[1] for x in msgs) + 11 > limit and len(msgs) > 2:
                msgs.pop(1)
            want |= {(c, x[0]) for x in msgs}
        got = {(r["conv_id"], r["turn"]) for r in CX.fit_context(t, limit).collect()}
        assert got == want


def test_trim_and_seed(spark):
    turns = FX.turns(spark, SF01)
    rows = turns.collect()
    convs = {}
    for r in rows:
        convs.setdefault(r["conv_id"], []).append(r["turn"])
    want = set()
    for c, ts in convs.items():
        ts = sorted(ts)
        if len(ts) > 4:
            ts = [ts[0]] + ts[-3:]
        want |= {(c, x) for x in ts}
    assert {(r["conv_id"], r["turn"]) for r in CX.trim_history(turns, 3).collect()} == want
    seeded = CX.seed_system(FX.messages(spark, SF01)).collect()
    assert all(r["messages"][0]["role"] == "system" for r in seeded)
    empty = spark.createDataFrame([(1, [])], "conv_id int, messages array<struct<role:string,content:string>>")
    assert [m["role"] for m in CX.seed_system(empty).first()["messages"]] == ["system"]
