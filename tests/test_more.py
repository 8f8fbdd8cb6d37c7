import bz2
import gzip
import hashlib
import json
import math
import random
import re
import struct
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from test_media import png

from sparkloom import catalogue
from sparkloom.functions import text as T
from sparkloom.functions import udf as U
from sparkloom.operators import audio, chat, checks, clean, dedup, evaluate, hooks, image, label, store, tokenize
from sparkloom.plans import stages
from sparkloom.sources import readers, sinks, warc
from sparkloom.streaming import streams


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column(F.col("text")).alias("x")).first()["x"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "text", "a")], "item_id string, data_type string, text string")
    bad = spark.createDataFrame([("2", "text", None), (None, "text", "b"), ("3", "text", "c")], df.schema)
    assert tuple(sinks.save_items(bad, str(tmp_path / "out")).first()) == (3, 1, 2) and spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert sinks.delete(spark, [str(tmp_path / "out"), str(tmp_path / "none")]) == {str(tmp_path / "out"): True, str(tmp_path / "none"): False}
    sinks.export(df, str(tmp_path / "json"), "json")
    assert json.loads(spark.read.text(str(tmp_path / "json")).first()[0]) == [{"item_id": "1", "data_type": "text", "text": "a"}]
    assert json.loads(sinks.report({"t": df})["json"])["t"][0]["item_id"] == "1"


def regex_runs(text, most=5):
    return re.sub(r"(\S+)(\s+\1){3,}", lambda m: " ".join([m[1]] * most) if len(m[0]) // (len(m[1]) + 1) > most else m[0], text)


def test_word_runs_are_the_pattern():
    r = random.Random(2)
    for _ in range(20_000):
        text = "".join(r.choice(["a", "b", "ab", " ", " ", "  ", "\n"]) for _ in range(r.randint(0, 40)))
        assert U.shorten_runs(text) == regex_runs(text), text
    began = time.time()
    U.shorten_runs("x" * 1_000_000 + " y" * 100_000)
    assert time.time() - began < 5


def test_exact_with_null_and_repeated_ids(spark):
    rows = [(None, "a", 1), (None, "a", 2), (1, "b", 3), (1, "c", 4), (2, "b", 5), (1, "b", 6), (3, None, 7), (4, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int").coalesce(1)
    assert sorted(x["row"] for x in dedup.exact(docs).collect()) == [1, 3, 4, 7]
    got = {x["row"]: (x["duplicate_of"], x["is_duplicate"]) for x in dedup.marked(docs.select("*")).join(docs, ["doc_id", "text", "row"], "left").collect() if x["row"]}
    assert got == {1: (None, False), 2: (None, True), 3: (None, False), 4: (None, False), 5: (1, True), 6: (1, True), 7: (None, False), 8: (3, True)}


@pytest.mark.parametrize("most", [2000, 1])
def test_hamming_links(spark, most):
    r = random.Random(4)
    base = [r.getrandbits(63) for _ in range(20)]
    hashes = sorted({b ^ sum(1 << k for k in r.sample(range(63), r.randint(0, 5))) for b in base for _ in range(5)})
    df = spark.createDataFrame(list(enumerate(hashes)), "doc_id bigint, hash bigint")
    for distance in (3, 10):
        got = {tuple(x) for x in dedup.hamming_links(df, distance, most).collect()}
        assert got == {(i, j) for i in range(len(hashes)) for j in range(i) if (hashes[i] ^ hashes[j]).bit_count() <= distance}


def test_simhash(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away from the bear "
    rows = [(1, line * 9), (2, line.upper() * 9), (3, "other words entirely, with no letter in common order"), (4, ""), (5, None)]
    got = {x["doc_id"]: x["component"] for x in dedup.simhash_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    grams = ["abcd", "bcde"]
    votes = [sum(xxhash.xxh64_intdigest(g) >> k & 1 for g in grams) for k in range(64)]
    assert dedup.simhash("A b-c,d.E") & (1 << 64) - 1 == sum(1 << k for k in range(64) if 2 * votes[k] > 2)
    assert sorted(x["doc_id"] for x in dedup.batch_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), near="simhash").collect()) == [1, 3, 4]


def test_cleaner_rules_of_scores(spark):
    text = "plain words of a text that is long enough to pass the first rules of the cleaner"
    docs = spark.createDataFrame([(1, text), (2, text + " analysis of research 1.5")], "doc_id int, text string")
    got = {x["doc_id"]: x for x in clean.clean(docs, perplexity=lambda c: F.length(c) * 10.0, education=0.55).collect()}
    assert [got[i]["reason"] for i in (1, 2)] == ["quality_filtered", "perplexity_filtered"]
    assert got[1]["cleaning_steps"][4:] == ["language_detection:en", "perplexity_filter:%.2f" % (len(text) * 10), "education_score:0.50"] and len(got[2]["cleaning_steps"]) == 6
    scored = clean.batch_stats(spark.createDataFrame([("success", 0.5), ("filtered", 0.3), ("success", None)], "status string, s double"), "s").first()
    assert scored["average_quality"] == 0.4


def test_rewriting_in_python_is_the_columns_steps(spark):
    texts = ["<p>a&nbsp;b</p> Subscribe  to our newsletter now", "x" * 80 + "\n\n" + "y" * 20, "go " * 9 + "on", "ﬁ １２ Cookie Policy ... Accept"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    steps = U.dedup_lines(U.cut_word_runs(T.cut_char_runs(U.nfkc(T.drop_boilerplate(T.strip(U.unescape(T.strip_tags(F.col("text")))))))))
    assert [x[0] for x in df.select(steps).collect()] == [U.rewritten(t) for t in texts]


def test_toxicity_and_redaction(spark):
    get = lambda text, **k: spark.createDataFrame([(text,)], "text string").select(*[v.alias(n) for n, v in T.toxicity(F.col("text"), **k).items()]).first().asDict()
    assert get("fine")["is_toxic"] is False and get("a threat")["threat"] == 0.9 and get("hate these people")["identity_attack"] == 0.8
    assert get("Damn it", en=["damn"])["profanity"] == 0.9 and get("Damn it", en=["damn"])["is_toxic"]
    assert one(spark, lambda t: T.redact(t, ["坏"], ["damn"]), "DAMN 坏 damned") == "**** * ****ed"
    out = spark.createDataFrame([("i will kill",), ("",), ("ok",)], "text string").select(*[v.alias(n) for n, v in T.toxicity_outcome(F.col("text")).items()]).collect()
    assert [tuple(x) for x in out] == [("filtered", "toxic_content"), ("success", "skipped"), ("success", None)]


def test_labels(spark):
    items = label.unlabelled(spark.createDataFrame([(1, "The research method is sound. However the result is weak."), (2, "kill death violent bloody 杀 死 " * 3)], "doc_id int, text string"))
    out = {x["doc_id"]: x for x in label.chained(items, {"q": label.quality_labels, "s": label.safety_labels}).collect()}
    assert [x["label_type"] for x in out[1]["labels"]] == ["quality", "safety"] and out[1]["label_status"] == "completed" and out[2]["label_status"] == "needs_review"
    qa = label.question_arrays(spark.createDataFrame([(1, "short"), (2, "x. y. z. still not a valid answer here"), (3, "Paris is a town in France. Paris is a town in France! it rains there very often. Rome is far away from there.")], "doc_id int, text string"))
    got = {x["doc_id"]: x for x in qa.collect()}
    assert [got[i]["qa_status"] for i in (1, 2, 3)] == ["failed", "failed", "completed"]
    assert [p["question"] for p in got[3]["pairs"]] == ["What is Paris?", "What does this sentence mean: it rains there very often...?"]
    images = spark.createDataFrame([(1, b"x"), (2, None)], "image_id int, data binary")
    assert {x["image_id"]: x["status"] for x in label.captions(images, "llava").collect()} == {1: "completed", 2: "failed"}


def test_bleu_and_rouge(spark):
    rows = [("the cat sat on the mat", ["the cat is on the mat", "there is a cat on the mat"]), ("a b", ["c d e"])]
    df = spark.createDataFrame(rows, "prediction string, references array<string>")

    def counts(n):
        hit = total = 0
        for p, refs in rows:
            g = Counter(tuple(p.split()[i : i + n]) for i in range(len(p.split()) - n + 1))
            best = Counter()
            for ref in refs:
                best |= Counter(tuple(ref.split()[i : i + n]) for i in range(len(ref.split()) - n + 1))
            hit, total = hit + sum((g & best).values()), total + sum(g.values())
        return hit / total

    got = evaluate.bleu(df).first()
    penalty = math.exp(1 - 9 / 8)  # 8 words of predictions, closest references 6 and 3
    assert got["bleu_1"] == round(penalty * counts(1), 6) and got["bleu_2"] == round(penalty * math.sqrt(counts(1) * counts(2)), 6)

    def lcs(a, b):
        return 0 if not a or not b else lcs(a[:-1], b[:-1]) + 1 if a[-1] == b[-1] else max(lcs(a[:-1], b), lcs(a, b[:-1]))

    pairs = [("a b c d", "a x c d"), ("x", "y"), ("", "a"), ("the cat sat", "cat the sat down")]
    out = spark.createDataFrame(pairs, "p string, r string").select(evaluate.rouge_l(F.col("p"), F.col("r")).alias("f")).collect()
    for (p, r), x in zip(pairs, out):
        n = lcs(p.split(), r.split())
        want = 0 if not n else (1 + 1.44) * (n / len(p.split())) * (n / len(r.split())) / (n / len(r.split()) + 1.44 * n / len(p.split()))
        assert abs(x["f"] - want) < 1e-9


def test_benchmark_scores(spark):
    rows = [("vqa", "Red", ["red", "dark red", "blue"]), ("gqa", "Yes", ["yes"]), ("mmlu", " b) because", ["B"]), ("mmbench", "E", ["A"]), ("other", "x", ["x"])]
    got = spark.createDataFrame(rows, "benchmark string, p string, a array<string>").select(evaluate.benchmark_score(F.col("benchmark"), F.col("p"), F.col("a")).alias("s")).collect()
    assert [x["s"] for x in got] == [1.0, 1.0, 1.0, 0.0, None]
    boxes = spark.sql("select named_struct('x', 0.0D, 'y', 0.0D, 'width', 2.0D, 'height', 2.0D) as a, named_struct('x', 1.0D, 'y', 1.0D, 'width', 2.0D, 'height', 2.0D) as b")
    assert abs(boxes.select(evaluate.overlap(F.col("a"), F.col("b")).alias("o")).first()["o"] - 1 / 7) < 1e-9


def test_pipeline_resumes_and_graph(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id bigint, text string")

    def keep(df):
        return df.withColumn("status", F.lit("success"))

    p = stages.CleaningPipeline([stages.Stage("two", keep, 2), stages.Stage("one", keep, 1)])
    p.run(docs, str(tmp_path / "s"))
    (tmp_path / "s/02-two/_SUCCESS").unlink()  # as if it had been stopped while writing
    out, traced = p.run(docs, str(tmp_path / "s"))
    assert out.count() == 3 and [n for n, _ in traced] == ["one", "two"] and (tmp_path / "s/02-two/_SUCCESS").exists()
    assert {tuple(x) for x in stages.stage_totals(stages.stage_counts(traced)).collect()} == {("one", 3, 3, 0, 0), ("two", 3, 3, 0, 0)}
    assert p.remove("one").add(stages.Stage("zero", keep, 0)).get("zero").order == 0 and p.get("one") is None

    def fails(df):
        raise ValueError("no")

    nodes = [stages.Node("c", lambda b: b, ["b"]), stages.Node("b", fails, ["a"], "skip"), stages.Node("a", lambda d: d.where("doc_id > 1"), ["docs"])]
    tables, states = stages.run_graph(spark, nodes, str(tmp_path / "g"), {"docs": docs})
    assert states == {"a": "done", "b": "failed", "c": "skipped"} and tables["a"].count() == 2
    assert stages.run_graph(spark, nodes[2:], str(tmp_path / "g"), {"docs": docs})[1] == {"a": "read"}
    with pytest.raises(ValueError, match="need each other"):
        stages.run_graph(spark, [stages.Node("x", keep, ["y"]), stages.Node("y", keep, ["x"])], str(tmp_path / "h"))


def test_more_sources(spark, tmp_path):
    article = "<page><title>Granite rock</title><ns>0</ns><revision><text>'''Granite''' is a [[rock (stone)|rock]] {{cite}} that is found nearly everywhere on the continents.</text></revision></page>"
    (tmp_path / "wiki.xml.bz2").write_bytes(bz2.compress(f"<mediawiki>{article}{article.replace('<ns>0', '<ns>1')}</mediawiki>".encode()))
    row = readers.collect(spark, "wikipedia", str(tmp_path / "wiki.xml.bz2")).collect()
    assert [(x["title"], x["url"]) for x in row] == [("Granite rock", "https://en.wikipedia.org/wiki/Granite_rock")] and row[0]["text"].startswith("Granite is a rock  that is found")
    entry = '<entry><id>u{0}</id><title>T{0}</title><summary>{1}</summary><category term="{2}"/><category term="z"/></entry>'
    (tmp_path / "feed.xml").write_text("<feed>" + entry.format(1, "s" * 60, "cs.CL") + entry.format(2, "s" * 60, "math") + entry.format(3, "s", "cs.CL") + "</feed>")
    assert [x["text"] for x in readers.papers(spark, str(tmp_path / "feed.xml"), ["cs.CL"]).collect()] == ["T1\n\n" + "s" * 60]
    repos = [{"full_name": f"r{i}", "description": None, "language": "C" if i % 2 else "Go", "stargazers_count": i, "html_url": f"h{i}"} for i in range(8, 14)]
    (tmp_path / "repos.json").write_text(json.dumps({"items": repos}))
    got = readers.collect(spark, "github", str(tmp_path / "repos.json"), languages=["C"]).collect()
    assert [x["full_name"] for x in got] == ["r13", "r11"] and got[0]["text"] == "\nRepository: r13\nDescription: None\nLanguage: C\nStars: 13\nURL: h13\n"
    (tmp_path / "books").mkdir()
    (tmp_path / "books/a.txt").write_text("one\ntwo")
    assert [x["text"] for x in readers.books(spark, str(tmp_path / "books")).collect()] == ["one\ntwo"]
    (tmp_path / "tree").mkdir()
    (tmp_path / "tree/a.jsonl").write_text('{"text": "1"}\n')
    (tmp_path / "tree/b.jsonl").write_text('{"text": "2"}\n')
    assert readers.indexed(spark, str(tmp_path / "tree"), "text string").count() == 2
    (tmp_path / "tree/index.json").write_text('[{"path": "b.jsonl"}]')
    assert [x["text"] for x in readers.indexed(spark, str(tmp_path / "tree"), "text string").collect()] == ["2"]
    (tmp_path / "chat.json").write_text('[{"image": "i", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}]')
    assert [tuple(m) for m in readers.shared_conversations(spark, str(tmp_path / "chat.json")).first()["messages"]] == [("user", "q"), ("assistant", "a")]


def test_compressed_warc_of_many_members(spark, tmp_path):
    def record(kind, url, body):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Target-URI: " + url + b"\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"

    records = [record(b"warcinfo", b"", b"x"), *(record(b"response", b"http://a/%d" % i, b"HTTP/1.1 200 OK\r\n\r\nWARC/1.0 page %d" % i) for i in range(5)), record(b"request", b"http://a/1", b"GET")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = {(x["url"], x["html"]) for x in warc.records(spark, str(tmp_path)).collect()}
    assert got == {(f"http://a/{i}", f"WARC/1.0 page {i}") for i in range(5)}


def test_fetch(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"p" * 2000)
    (tmp_path / "b.txt").write_bytes(b"t" * 2000)
    urls = [f"file://{tmp_path}/{n}" for n in ("a.png", "b.txt", "none.png")]
    got = {x["url"]: x for x in readers.fetched(spark.createDataFrame([(u,) for u in urls], "url string"), readers.read_local, wait=0.0).collect()}
    assert [len(got[u]["data"] or b"") for u in urls] == [2000, 0, 0] and "NotFound" in got[urls[2]]["error"]


def test_checks(spark):
    df = spark.createDataFrame([("1", None), ("x", 2.0)], "a string, b double")
    assert checks.schema_problems(df, "a int, c string") == ["missing: c", "type: a is string, not int", "extra: b"]
    assert [tuple(x) for x in checks.converted(df, "a int").collect()] == [(1,), (None,)]
    rules = {"b": F.col("b") > 1, "a": F.col("a") == "x"}
    assert [x["issues"] for x in checks.issues(df, rules).collect()] == [["b", "a"], []] and checks.passing(df, rules).count() == 1
    assert one(spark, lambda t: checks.digest_matches(t.cast("binary"), F.lit(hashlib.md5(b"q").hexdigest())), "q")


def test_annotation_formats(spark):
    box = "array<struct<label:string,x:double,y:double,width:double,height:double>>"
    images = spark.createDataFrame([(7, "a.jpg", 100, 50, [("cat", 10.0, 5.0, 20.0, 10.0)])], f"image_id bigint, file_name string, width int, height int, boxes {box}")
    assert tuple(sinks.yolo(images, ["dog", "cat"]).first()) == ("a.txt", "1 0.200000 0.200000 0.200000 0.200000")
    _, annotations, categories = sinks.coco(images, ["dog", "cat"])
    assert annotations.first()["bbox"] == [10.0, 5.0, 20.0, 10.0] and annotations.first()["category_id"] == 2 and categories.count() == 2
    assert "<xmax>30</xmax><ymax>15</ymax>" in sinks.voc(images).first()["text"]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"create database loom_tests location '{tmp_path}/db'")
    try:
        store.create_tables(spark, "loom_tests")
        assert spark.table("loom_tests.data_items").columns[0] == "item_id"
    finally:
        spark.sql("drop database if exists loom_tests cascade")


def test_near_dedup_of_a_stream(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    schema = "doc_id bigint, text string"
    parts = [[(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (6, "")], [(3, " ".join([*words[:-1], "third"])), (4, "something else entirely")]]
    for rows in parts:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.near_dedup(streams.documents(spark, str(tmp_path / "in"), df.schema), str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(x["doc_id"] for x in spark.read.parquet(str(tmp_path / "out/kept")).collect()) == [1, 4, 6]
    q = streams.running_counts(streams.documents(spark, str(tmp_path / "in"), df.schema), "text").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").count() == 5


def test_image_cleaner_and_loader(spark):
    rng = np.random.default_rng(2)
    rows = [(1, png(rng.integers(0, 256, (300, 400)).astype(np.uint8))), (2, png(np.full((300, 300), 9, np.uint8) + rng.integers(0, 2, (300, 300)).astype(np.uint8))), (3, png(rng.integers(0, 256, (300, 20)).astype(np.uint8))), (4, None), (5, b"\xff\xd8\xff\xc0\x00\x11\x08" + struct.pack(">HH", 600, 700) + b"\x03" * 2000)]
    out = {x["id"]: x for x in image.clean(spark.createDataFrame(rows, "id int, data binary"), score_aesthetic=True).collect()}
    assert [out[i]["reason"] for i in range(1, 6)] == [None, "blur_filtered", "resolution_filtered", "no_image_data", None]
    assert (out[1]["width"], out[1]["height"], out[1]["quality_score"]) == (400, 300, 0.55) and (out[5]["width"], out[5]["height"]) == (700, 600)
    assert 100 < out[1]["brightness"] < 155
    items = spark.createDataFrame([(1, "p", None, None), (2, None, "u", "eA=="), (3, "gone", None, "eA=="), (4, None, None, "?")], "id int, path string, url string, inline string")
    files = spark.createDataFrame([("p", b"1"), ("u", b"2")], "path string, content binary")
    assert {x["id"]: x["data"] and bytes(x["data"]) for x in image.loaded(files, items).collect()} == {1: b"1", 2: b"2", 3: b"x", 4: None}
    v = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>").select(image.cosine(F.col("a"), F.col("b")).alias("c")).collect()
    assert abs(v[0]["c"] - 0.5**0.5) < 1e-9 and v[1]["c"] is None
    assert clean.image_text_validity(spark.createDataFrame([(b"x" * 2000, "a caption of some length"), (b"x", "a caption of some length"), (None, None)], "image binary, caption string")).select("valid").collect() == [(True,), (False,), (False,)]


def test_tokenizer_interface(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([(1, "hello world, hello"), (2, "")], "id int, text string")
    out = {x["id"]: x for x in tokenize.tokenized(df, path, F.col("text"), 8, pad=0).collect()}
    n = out[1]["token_count"]
    assert len(out[1]["input_ids"]) == 8 and sum(out[1]["attention_mask"]) == n and out[1]["error"] is None and (out[2]["input_ids"], out[2]["error"]) == ([], "empty text")
    back = df.select(tokenize.decoder(path)(tokenize.encoder(path)("text")).alias("t"), tokenize.offsets(path)("text").alias("o")).collect()
    assert back[0]["t"].replace(" ", "").replace("</w>", "") == "helloworld,hello" and (back[0]["o"][0]["start"], back[0]["o"][-1]["end"]) == (0, 18)
    some = tokenize.vocabulary(spark, path).where("not special").orderBy("id").first()
    assert tokenize.token_id(path, some["token"]) == some["id"] and tokenize.token_id(path, "no such token at all", "nor this") == 0
    assert spark.sql("select array(1, 9, 2) as ids").select(tokenize.spliced(F.col("ids"), 9, F.array(F.lit(7), F.lit(7))).alias("x")).first()["x"] == [1, 7, 7, 2]
    turns = spark.createDataFrame([(1, 0, "user", "hello")], "conv_id int, turn bigint, role string, text string")
    row = chat.tokenized(turns, "tagged", tokenize.encoder(path), opener=False).first()
    assert row["prompt"] == "<|user|>\nhello\n" and row["ids"]
    assert chat.rendered(turns, "closed").first()["prompt"] == "<|user|>\nhello\n</|user|>\n<|assistant|>\n"


def test_hooks(spark):
    df = spark.createDataFrame([("a",), ("bb",), ("bad",)], "text string")

    def score(model, batch):
        if (batch == "bad").any():
            raise ValueError("no")
        return batch.str.len() * model

    length = hooks.model_udf(lambda: 2.0, score, "double")
    assert [x["s"] for x in df.select(length("text").alias("s")).collect()] == [2.0, 4.0, None]
    found = spark.createDataFrame([("Bob at bob@example.com",)], "text string").select(hooks.find_entities(lambda t: [("NAME", "Bob", 0, 3, 0.9), ("NAME", "at", 4, 6, 0.2)])("text").alias("e")).first()["e"]
    assert [x["entity_type"] for x in found] == ["NAME", "EMAIL_ADDRESS"]
    answers = ['x [{"question": "q", "answer": "a"}] y', "none", None]
    got = spark.createDataFrame([(a,) for a in answers], "a string").select(hooks.parsed_pairs(F.col("a")).alias("p")).collect()
    assert [len(x["p"]) for x in got] == [1, 0, 0]
    hooks.register(spark)
    assert [tuple(x) for x in spark.sql("select * from sentence_rows('One. Two!')").collect()] == [(0, "One"), (1, "Two")]
    seen, counts = hooks.observed(df, "rows", n=F.count(F.lit(1)))
    seen.collect()
    heard = []
    with pytest.raises(ValueError):
        hooks.run_with_callbacks(lambda: int("x"), on_error=heard.append)
    assert counts.get["n"] == 3 and hooks.run_with_callbacks(lambda: 1, heard.append) == 1 and len(heard) == 2


def test_audio(spark):
    import io
    import wave

    def clip(x, rate=8000):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())
        return out.getvalue()

    t = np.arange(16000) / 8000
    speech = np.sin(2 * np.pi * 440 * t) * np.where(t % 0.5 < 0.3, 0.5, 0.001)
    rows = [(1, clip(speech)), (2, clip(speech[:800])), (3, clip(speech * 0)), (4, clip(0.3 * np.sin(2 * np.pi * 440 * t))), (5, b"no wave"), (6, None)]
    out = {x["id"]: x for x in audio.clean(spark.createDataFrame(rows, "id int, data binary")).collect()}
    assert [out[i]["reason"] for i in range(1, 7)] == [None, "duration_filtered", "silence_filtered", "snr_filtered", "invalid_format", "invalid_format"]
    assert abs(out[1]["seconds"] - 2.0) < 1e-9 and out[1]["rate"] == 8000


def test_benchmark_runs_and_objects(spark, tmp_path):
    rows = spark.createDataFrame([("red", ["red"]), ("x", ["y"])], "predicted string, answers array<string>")

    def fails():
        raise ValueError("no file")

    got = evaluate.run_benchmarks({"gqa": lambda: rows, "mmlu": fails}).collect()
    assert [tuple(x) for x in got] == [("gqa", 2, 1, 0.5)] and evaluate.run_benchmarks({"mmlu": fails}) is None
    assert sinks.put(spark, str(tmp_path / "a/b.PNG"), b"123") == ("image/png", 3) and (tmp_path / "a/b.PNG").read_bytes() == b"123"


def test_tokenizer_holds_few_encodings(spark, monkeypatch):
    """An Arrow batch is encoded piece by piece, and counts are those of the ids."""
    import pandas as pd
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    real, given = tokenize._tokenizer(path), []

    class Watched:
        def encode_batch(self, texts, **options):
            given.append(sum(map(len, texts)))
            return real.encode_batch(texts, **options)

        encode_batch_fast = encode_batch

    texts = ["some words of a text, " * 2000, None, "", *["a shorter text of 42 chars, or so it seems"] * 40000, "x " * 300000]
    monkeypatch.setattr(tokenize, "_tokenizer", lambda _: Watched())
    ids = tokenize.encoder(path).func(pd.Series(texts))
    assert max(given) <= 600000 and len(given) > 5  # the one long text is a piece of its own
    counts = tokenize.counter(path).func(pd.Series(texts))
    assert [len(x) for x in ids] == list(counts) and list(counts[1:3]) == [0, 0]
    assert list(ids[3]) == real.encode(texts[3], add_special_tokens=False).ids


def test_statistics_of_counts(spark):
    """Counts of ids give the statistics that the ids themselves give."""
    rows = spark.createDataFrame([([1, 2, 3],), ([],), ([4],)], "ids array<int>").withColumn("n", F.size("ids"))
    assert tokenize.statistics(rows, length=2, n=F.col("n")).collect() == tokenize.statistics(rows, "ids", 2).collect()


@pytest.mark.parametrize("name", ["qa_pairs", "label_distribution", "scorer_chosen_dimensions", "schema_issues"])
def test_exploded_arrays_are_made_once(spark, name):
    """No filter by an array's size below the projections that make the array."""
    if name == "schema_issues":
        found = checks.issue_counts(spark.createDataFrame([("a",), (None,)], "x string"), {"x is there": F.col("x").isNotNull(), "x is long": F.length("x") > 3})
        assert sorted(map(tuple, found.collect())) == [("x is long", 2), ("x is there", 1)]
    else:
        found = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert "Filter " not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rate_limit_rounds_seconds_as_its_sql(spark, tmp_path):
    """Fractions count by the nearest second, halves by the even one."""
    import duckdb

    times = ["00:00:00.4", "00:01:00.6", "00:02:00.5", "00:03:01.5", "00:04:01.4", "00:05:02.5", "00:06:03.5"]
    rows = ", ".join(f"({i}, 1, timestamp '2024-01-01 {t}')" for i, t in enumerate(times))
    duckdb.sql(f"copy (select * from (values {rows}) t(event_id, user_id, ts)) to '{tmp_path}/events.parquet' (format parquet)")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    want = con.sql(f"select event_id, user_id, n from ({catalogue.ORACLE_SQL['rate_limit_window']}) order by 1").fetchall()
    got = catalogue.QUERIES["rate_limit_window"](spark, str(tmp_path)).orderBy("event_id")
    assert [tuple(r) for r in got.select("event_id", "user_id", "n").collect()] == want and len({n for *_, n in want}) > 1


def test_page_text_leaves_open_entities_as_its_sql(spark, tmp_path):
    """Only entities with their semicolon are resolved, each once."""
    import duckdb

    html = ["<p>a &amp; b &amp c &ampx; &copyright &quot;d&quot;</p>", "<p>cut &amp</p>&amp;copy; &amp;amp; &&&amp; &middot;", "", None]
    spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "page_id int, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"select page_id, url, text from ({catalogue.ORACLE_SQL['page_main_text']}) order by 1").fetchall()
    got = catalogue.QUERIES["page_main_text"](spark, str(tmp_path)).orderBy("page_id").select("page_id", "url", "text")
    assert [tuple(r) for r in got.collect()] == want and want[1][2] == "cut &amp &copy; &amp; &&& ·"
    assert U.closed_references("&lt;&#65;&#x42;&nosuch;&notit; &lt") == "<AB&nosuch;&notit; &lt"


@pytest.mark.parametrize("most", [2000, 1])
def test_hamming_forest(spark, most):
    """Few pairs connect what all near pairs connect, whatever the batches that lists are cut by."""
    r = random.Random(5)
    base = [r.getrandbits(64) - (1 << 63) for _ in range(12)]
    near = lambda b: b ^ sum(1 << k for k in r.sample(range(63), r.randint(0, 3)))
    hashes = sorted({near(near(b)) for b in base for _ in range(40)})
    df = spark.createDataFrame([*enumerate(hashes), (None, 7)], "doc_id bigint, hash bigint")
    bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    up = list(range(len(hashes)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(hashes)):
        for j in range(i):
            if bits(hashes[i], hashes[j]) <= 3:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = [tuple(x) for x in dedup.hamming_forest(df, 3, most).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(i > j and bits(hashes[i], hashes[j]) <= 3 for i, j in found)
    got = {x["doc_id"]: x["component"] for x in dedup.by_hash(df.where("doc_id is not null"), 3).collect()}
    assert got == {i: top(i) for i in range(len(hashes))}


def test_dense_lists_give_few_ties():
    """2000 hashes that are all near each other: 1999 ties, not two millions."""
    hashes = np.unique(np.array([(1 << a) ^ (1 << b) for a in range(64) for b in range(64)], np.uint64))
    ties = [(at, x) for at, near in dedup.spanning(hashes, 4) for x in near]
    assert len(ties) == len(hashes) - 1 and len({x for _, x in ties}) == len(ties)


def test_simhash_of_wide_and_short_texts():
    """Hashing shingles all at once gives what hashing each gives."""
    for text in ("", "abc", "abcd", "héllo wörld, naïve", "日本語のテキスト mixed in", "a😀bcd😀", "x" * 70000):
        chars = "".join(re.findall(r"\w", text.lower()))
        grams = [chars[i : i + 4] for i in range(max(1, len(chars) - 3))]
        assert dedup._shingle_hashes(chars, 4).tolist() == [xxhash.xxh64_intdigest(g) for g in grams]


def test_texts_without_runs_or_personal_data_are_passed_over(monkeypatch):
    """A text that can hold neither is not walked word by word, nor searched by each pattern; what is found stays the same."""
    r = random.Random(6)
    parts = ["go", "go ", "go go go ", "ago", " ", "a", ".", "13812345678", "1", "9", "٣", "@", "b.com", "8.8.8.8", "张三", "表示", "110101199003078888"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(3000)]
    plain = [sorted(((m.start(), k, m.end()) for k, p in U._PII.items() for m in p.finditer(t)), key=lambda x: x[0]) for t in texts]

    def kept(found):
        out, reach = [], 0
        for start, kind, end in found:
            if start >= reach:
                out.append((kind, start, end))
                reach = end
        return out

    assert [[(k, a, b) for k, _, a, b, _ in U.pii_entities(t)] for t in texts] == [kept(f) for f in plain]
    fast = [U.shorten_runs(t) for t in texts]
    with monkeypatch.context() as m:
        m.setattr(U, "_may_run", lambda words, least: True)
        assert fast == [U.shorten_runs(t) for t in texts] and fast != texts

    class Refuses:
        def finditer(self, text):
            raise AssertionError("walked")

    monkeypatch.setattr(U, "_WORD", Refuses())
    monkeypatch.setattr(U, "_PII", dict.fromkeys(U._PII, Refuses()))
    assert U.shorten_runs("of of the the text") == "of of the the text" and U.pii_entities("call 12 3.") == []
