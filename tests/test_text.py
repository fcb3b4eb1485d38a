"""Prompt and chat columns."""

from pyspark.sql import functions as F

from variantflow.functions.text import (
    PLAIN_DIALECT,
    TAGGED_DIALECT,
    chat_messages,
    chat_prompt,
    chat_render,
    key_uniform,
    normal_path,
    null_if_na,
    prompt_template,
)

TEXTS = ["plain", "", " ", "100% {x} %s", "two\nlines", None]


def test_both_forms_of_a_chat_prompt_agree(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for dialect in (PLAIN_DIALECT, TAGGED_DIALECT):
        general = chat_render(chat_messages(F.col("t"), dialect), "<tag>", dialect)
        rows = df.select("t", general.alias("a"), chat_prompt(F.col("t"), "<tag>", dialect).alias("b")).collect()
        for r in rows:
            if r["t"] is None:
                assert r["b"] is None
            else:
                assert r["a"] == r["b"]
    assert rows[0]["b"] == "<|User|>: plain\n\n<|Assistant|>:<tag>"
    assert rows[1]["b"] == "<|User|>:<|Assistant|>:<tag>"


def test_many_turns(spark):
    turns = [("User", "a"), ("Assistant", "b"), ("User", "c"), ("Assistant", "")]
    df = spark.createDataFrame([(turns,)], "m array<struct<role:string,content:string>>")
    got = df.select(chat_render(F.col("m"), "!")).first()[0]
    assert got == "User: a\n\nAssistant: b\n\nUser: c\n\nAssistant:!"


def test_prompt_keeps_the_text_as_it_is(spark):
    df = spark.createDataFrame([("100% {x} %s",)], "t string")
    got = df.select(prompt_template(F.col("t"), F.lit("negative"))).first()[0]
    assert ":\n\n100% {x} %s. Be faithful" in got


def test_paths_markers_and_uniform_numbers(spark):
    df = spark.createDataFrame([("file:///a/b", "NA"), ("/a/b", "text"), ("s3://x/a", "")], "p string, t string")
    rows = df.select(normal_path(F.col("p")), null_if_na(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("/a/b", None), ("/a/b", "text"), ("s3://x/a", None)]
    u = spark.range(2000).select(key_uniform(F.col("id")).alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.03


def test_paths_agree_whatever_their_store_is_called(spark):
    from variantflow.functions.text import qualified_path

    paths = ["/a/2.jpg", "hdfs://nn:8020/a/2.jpg", "s3a://b/k", "s3://b/k", "file:///a", "file:/a", "out/x", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    on_hdfs = [r[0] for r in df.select(qualified_path(F.col("p"), "hdfs://nn:8020")).collect()]
    assert on_hdfs == ["hdfs://nn:8020/a/2.jpg"] * 2 + ["s3://b/k"] * 2 + ["file:/a"] * 2 + ["out/x", None]
    local = [r[0] for r in df.select(qualified_path(F.col("p"), "file:")).collect()]
    assert local[0] == "file:/a/2.jpg" and local[4] == "file:/a"
