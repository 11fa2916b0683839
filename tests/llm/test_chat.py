from helpers import as_table, rows, sql_rows

from burnish.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def check(df):
    found = chat.rotate(df)
    assert rows(found) == sql_rows(chat.OP10_SQL, conversations=as_table(df))
    return found


def test_small_table(spark, small):
    check(spark.read.parquet(f"{small}/conversations.parquet"))


def test_three_speakers_and_masks(spark):
    df = spark.createDataFrame([(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bo b", "hey <|im_end|>"), (1, 3, "ann", "bye"), (1, 4, "cy", "é𝒳")], SCHEMA)
    found = {r.participant: r for r in check(df).collect()}
    assert set(found) == {"ann", "bo b", "cy"}
    ann = found["ann"]
    spans = [tuple(map(int, x.split(":"))) for x in ann.masks.split(",")]
    assert [ann.text[a:b] for a, b in spans] == ["hi<|im_end|>", "bye<|im_end|>"]
    assert "user name=bo_b\nhey < |im_end|>" in ann.text
    assert found["cy"].text[slice(*map(int, found["cy"].masks.split(":")))] == "é𝒳<|im_end|>"


def test_awkward_rows(spark):
    data = [(None, 1, "a", "lost"), (1, None, "a", "late"), (1, 1, None, None), (1, 1, "  ", "x"), (1, 1, "a", "x"), (1, 1, "a", "x"), (1, 1, "a", "w"), (2, 0, "system", "alone"), (3, -5, "a", ""), (4, 1, "a", "y" * 100_000)]
    found = check(spark.createDataFrame(data, SCHEMA))
    assert {r.conv_id for r in found.collect()} == {1, 3, 4}


def test_long_dialogue_comes_in_parts(spark):
    df = spark.createDataFrame([(1, i, "ab"[i % 2], f"t{i}") for i in range(700)], SCHEMA)
    found = check(df).filter("participant = 'a'").orderBy("block", "chunk").collect()
    assert [r.n_messages for r in found] == [256, 256, 188]
    same_turn = spark.createDataFrame([(1, 0, "a", f"t{i:04d}") for i in range(300)], SCHEMA)
    assert [r.n_messages for r in check(same_turn).orderBy("chunk").collect()] == [256, 44]


def test_empty_and_extra_columns(spark):
    assert chat.rotate(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, 0, "a", "x", 5, "y")], SCHEMA + ", block int, said string")
    assert chat.rotate(df).first().text == "<|im_start|>assistant\nx<|im_end|>\n"


def test_parts_are_cut_by_position(spark):
    data = [(1, 250 + i, "ab"[i % 2], f"t{i}") for i in range(12)]
    data += [(2, 1_700_000_000 + 1000 * i, "ab"[i % 2], f"t{i}") for i in range(256)]
    data += [(3, 1000 * i, "ab"[i % 2], f"t{i}") for i in range(600)]
    found = chat.rotate(spark.createDataFrame(data, SCHEMA)).filter("participant = 'a'").orderBy("conv_id", "block", "chunk").collect()
    assert [(r.conv_id, r.chunk, r.n_messages) for r in found] == [(1, 0, 12), (2, 0, 256), (3, 0, 256), (3, 0, 256), (3, 0, 88)]
    assert [r.block for r in found if r.conv_id == 3] == [0, 1000, 2000]
    said = "".join(r.text for r in found if r.conv_id == 3).split("<|im_end|>\n")[:-1]
    assert [x.split("\n")[1] for x in said] == [f"t{i}" for i in range(600)]
