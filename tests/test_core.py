import importlib
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkloom import catalogue
from sparkloom.functions import text as T
from sparkloom.functions import udf as U
from sparkloom.operators import chat, clean, dedup, evaluate, label, sample, store
from sparkloom.sources import readers, sinks
from sparkloom.streaming import streams

SF = "/root/testdata/sf0.001"


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column(F.col("text")).alias("x")).first()["x"]


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    norm = lambda rows: sorted(repr(tuple(round(x, 4) if isinstance(x, float) else x for x in r)) for r in rows)
    want = con.sql("select " + ", ".join(f'"{c}"' for c in columns) + f" from ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert norm(df.select(*columns).collect()) == norm(want)


def test_entry_contract(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    ("text", "replace", "mask", "hashed"),
    [
        ("mail bob@example.com or 13812345678", "mail [EMAIL_ADDRESS] or [PHONE_NUMBER]", "mail bo***********om or 13*******78", "mail [EMAIL_ADDRESS_4b9bb806] or [PHONE_NUMBER_4c0115d3]"),
        ("card 1381234567890123 end", "card [PHONE_NUMBER]90123 end", "card 13*******7890123 end", "card [PHONE_NUMBER_4c0115d3]90123 end"),
        ("id 110101199003078888 ip 999.1.2.3", "id [ID_CARD] ip [IP_ADDRESS]", "id 11**************88 ip 99*****.3", "id [ID_CARD_2a87cdc3] ip [IP_ADDRESS_71bea474]"),
        ("张三丰表示同意 8.8.8.8", "[PERSON]同意 [IP_ADDRESS]", "张三*表示同意 8.***.8", "[PERSON_0aa59755]同意 [IP_ADDRESS_40ff44d9]"),
        ("plain", "plain", "plain", "plain"),
    ],
)
def test_pii(text, replace, mask, hashed):
    assert (U.anonymized(text, "replace"), U.anonymized(text, "mask"), U.anonymized(text, "hash")) == (replace, mask, hashed)


def test_repetitions(spark):
    assert [len(one(spark, T.cut_char_runs, "x" * n)) for n in (10, 11, 50, 51, 60)] == [10, 11, 50, 50, 50]
    runs = {n: U.shorten_runs(" ".join(["go"] * n)) for n in range(4, 9)}
    assert [len(runs[n].split()) for n in range(4, 9)] == [4, 5, 6, 5, 5]
    assert U.shorten_runs("go   go   go   go   go") == "go go go go go"
    assert U.first_lines("  a\n  a\nb\nb\n\n\nc") == "  a\n  a\nb\n\nc"


@pytest.mark.parametrize(
    ("text", "want"),
    [("hello world", (True, None, 0.0, 1.0)), ("I hate this chateau", (True, "hate_speech", 0.3, 0.7)), ("Sussex nude death", (True, "nsfw", 0.3, 0.7)), ("kill death violent bloody 杀 死", (False, "violence", 0.9, 0.9)), ("自杀", (True, "violence", 0.3, 0.7))],
)
def test_safety(spark, text, want):
    r = label.safety(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (r["is_safe"], r["primary_risk"], r["worst"], r["confidence"]) == want


@pytest.mark.parametrize(
    ("text", "dims", "overall"),
    [("The research method is sound. However the result is weak.", (0.95, 0.8, 0.7, 0.68, 1.0), 0.826), ("a a a a", (0.5, 0.5, 0.6, 0.7, 1.0), 0.66), ("porn and gambling", (0.8, 0.5, 0.6, 0.8, 0.25), 0.59), ("...", (0.0, 0.5, 0.6, 1.0, 1.0), 0.62)],
)
def test_scorer(spark, text, dims, overall):
    r = label.quality(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert tuple(round(r[k], 4) for k in ("fluency", "relevance", "coherence", "informativeness", "safety")) == dims
    assert round(r["overall"], 4) == overall


def test_qa_and_vqa(spark):
    s = one(spark, T.sentences, "Marie Curie discovered radium in 1898. it was hard work for years. Paris was her home for decades.")
    assert len(s) == 3 and [one(spark, T.entities, x) for x in s] == [["Marie Curie", "数字1898"], [], ["Paris"]]
    rows = [("Red", ["red", "dark red", "blue", "green"]), ("red", ["red"] + ["q"] * 9), ("x", ["y"] * 4)]
    got = spark.createDataFrame(rows, "p string, a array<string>").select(evaluate.vqa_score(F.col("p"), F.col("a")).alias("s")).collect()
    assert [round(r["s"], 6) for r in got] == [1.0, 0.3, 0.0]


def test_chat(spark):
    turns = spark.createDataFrame([(1, 3, "assistant", "A"), (1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "tool", "T")], "conv_id int, turn bigint, role string, text string")
    get = lambda t: chat.rendered(turns, t).first()["prompt"]
    assert get("chatml") == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\nA<|im_end|>\n<|im_start|>assistant\n"
    assert get("default") == "User: U\nAssistant: A\nAssistant: "
    assert get("llama3").count("<|begin_of_text|>") == 1
    r = chat.sft_samples(turns).first()
    assert r["response"] == "A" and r["prompt"].endswith("<|im_start|>assistant\n")


def test_cleaner(spark):
    rows = [(1, "<p>Hello &amp; welcome</p> " + "word and more text " * 5), (2, ""), (3, None), (4, "short"), (5, "<b>" * 30)]
    got = {r["doc_id"]: r for r in clean.clean(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1]["status"] == "success" and got[1]["content"].startswith("Hello & welcome") and got[1]["metadata"]["length"] == len(got[1]["content"])
    assert [got[i]["reason"] for i in (2, 3, 4, 5)] == ["empty_text", "empty_text", "validation_failed", "division by zero"] and got[5]["status"] == "failed"


def test_minhash(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, " ".join(f"v{i}" for i in range(60))), (4, ""), (5, None)]
    got = {r["doc_id"]: r["component"] for r in dedup.minhash(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_store(spark):
    old = spark.createDataFrame([("a", "x", "raw", 0.1), ("b", "x", "raw", 0.2)], "item_id string, data_type string, status string, quality_score double")
    new = spark.createDataFrame([("b", "y", "done", None), ("c", "z", "done", 0.9)], old.schema)
    got = {r["item_id"]: tuple(r)[1:] for r in store.upsert(old, new, "item_id", ["status", "quality_score"]).collect()}
    assert got == {"a": ("x", "raw", 0.1), "b": ("x", "done", None), "c": ("z", "done", 0.9)}


def test_sampling(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id")
    parts = {r["split"]: r["count"] for r in sample.split(docs, "doc_id", {"train": 0.8, "test": 0.2}).groupBy("split").count().collect()}
    assert set(parts) == {"train", "test"} and 350 < parts["train"] < 450
    assert sample.shard(docs, "doc_id", 4).select("shard").distinct().count() == 4


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "img").mkdir()
    (tmp_path / "img/a.jsonl").write_text(json.dumps({"text": "t"}) + "\n")
    assert readers.jsonl_tree(spark, str(tmp_path), "text string").first()["data_type"] == "image_text"
    (tmp_path / "u.json").write_text('{"url": "u", "caption": "c"}\nbad\n{"url": "", "caption": "c"}\n')
    assert readers.url_list(spark, str(tmp_path / "u.json")).count() == 1
    body = b"HTTP/1.1 200 OK\r\n\r\n<html><script>x</script><p>" + b"Some page text here. " * 5 + b"</p></html>"
    (tmp_path / "c.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x.org/\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    r = readers.crawl(spark, str(tmp_path)).first()
    assert r["url"] == "http://x.org/" and "script" not in r["text"] and r["language"] == "en"
    df = spark.createDataFrame([("1", "text", "a")], "item_id string, data_type string, text string")
    assert sinks.save_items(df, str(tmp_path / "out")).first()["saved"] == 1
    assert "| 1 |" in sinks.markdown(df)
    assert readers.collect(spark, "unknown").count() == 0


def test_stream(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "in"))
    q = streams.dedup(streams.documents(spark, str(tmp_path / "in"), docs.schema)).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen").count() == 2
