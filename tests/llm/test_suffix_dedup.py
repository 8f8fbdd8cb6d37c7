import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sparkloom.llm import suffix_dedup as sd


@pytest.mark.parametrize("step", [1, 3, 1024])
def test_suffix_array_and_prefixes(monkeypatch, step):
    monkeypatch.setattr(sd, "STEP", step)
    r = random.Random(3)
    for _ in range(400):
        t = [r.randint(1, r.choice([1, 2, 8, 40])) for _ in range(r.randint(0, 60))] + [0]
        order = sd.suffix_array(np.array(t)).tolist()
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        shared = sd.common_prefixes(np.array(t), np.array(order))
        for i, j in zip(order[1:], order):
            n = 0
            while max(i, j) + n < len(t) and t[i + n] == t[j + n]:
                n += 1
            assert shared[i] == n


def brute(texts, length):
    seen = {}
    for k, text in enumerate(texts):
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i : i + length], []).append((k, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + length))
    out = []
    for text, g in zip(texts, gone):
        b = (text or "").encode()
        runs = sum(1 for i in g if i - 1 not in g)
        out.append((len(b), len(g), runs, hashlib.sha256(bytes(c for i, c in enumerate(b) if i not in g)).hexdigest()))
    return out


def check(spark, texts, length):
    got = {r["doc_id"]: tuple(r)[1:5] for r in sd.query(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), length).collect()}
    want = brute(texts, length)
    assert [got[i] for i in range(len(texts))] == want


def test_against_brute_force(spark):
    r = random.Random(5)
    line = lambda n: "".join(r.choice("abcde é") for _ in range(n))
    passages = [line(r.randint(30, 300)) for _ in range(6)]
    texts = []
    for _ in range(120):
        t = "".join(r.choice(passages) if r.random() < 0.4 else line(r.randint(1, 90)) for _ in range(r.randint(0, 6)))
        if t and r.random() < 0.3:
            i = r.randrange(len(t))
            t = t[:i] + r.choice("xyz") + t[i + 1 :]
        texts.append(t)
    texts += [None, "", "a" * 200, "a" * 45, "ab" * 60, texts[0], texts[0], texts[3]]
    check(spark, texts, 46)


def test_length_400_and_empty(spark):
    r = random.Random(6)
    p = "".join(r.choice("abcdefgh ") for _ in range(1000))
    check(spark, [p[:399], p[:400], p[200:700], p + p[::-1], "x" + p[5:450], "z" * 900], 400)
    assert sd.query(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_keep_with_more_columns(spark):
    p = "é" * 300
    docs = spark.createDataFrame([(1, p, "en", 300, 7), (1, "aé" + p, None, 302, 8), (None, None, "fr", None, 9)], "doc_id bigint, text string, lang string, n_chars bigint, row bigint")
    rows = sd.keep(docs).orderBy("row").collect()
    assert [r["row"] for r in rows] == [7, 8, 9] and rows[2]["text"] is None
    assert [r["text"] for r in rows[:2]] == ["", "aé"[: len(rows[1]["text"])]] and rows[0]["n_chars"] == 0


def test_passages_of_over_50_words(spark):
    import corpus_pipeline

    r = random.Random(8)
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(n))
    p, short, tiny, unspaced = words(51), words(50), " ".join(r.choice("abcdefghij") for _ in range(51)), "".join(r.choice("abcdefghij") for _ in range(400))
    parts = [words(30), words(30)]
    assert 280 < len(p) < 350 and len(tiny) == 101
    texts = [(words(80), p, words(80)), ("", p.replace(" ", "\n"), words(9)), (words(80), short, words(80)), (words(9), short, ""), (words(3), tiny, "é"), ("é", tiny, words(60)), ("1 ", unspaced, " 2"), ("3 ", unspaced, " 4")]
    texts += [(words(5), " ".join(parts), words(5)), (words(5), parts[0], words(5)), (words(5), parts[1], words(5))]  # repeated halves are no passage
    docs = spark.createDataFrame([(i, " ".join(t), "en", 0) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, n_chars bigint")
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.passage_stage(spark, docs, "").collect()}
    left = [(a, "" if b.split() in (p.split(), tiny.split(), [unspaced]) else b, c) for a, b, c in texts]
    assert ["".join(got[i].split()) for i in range(len(texts))] == ["".join(" ".join(x).split()) for x in left]


@pytest.mark.parametrize("busy", [2, 4000])
def test_passages_against_brute_force(spark, monkeypatch, busy):
    monkeypatch.setattr(sd, "BUSY", busy)
    r = random.Random(7)
    pieces = [[r.choice("abcdefgh") for _ in range(r.randint(10, 40))] for _ in range(8)]
    texts = [[w for _ in range(r.randint(0, 4)) for w in (r.choice(pieces) if r.random() < 0.5 else [r.choice("abcdefgh") for _ in range(20)])] for _ in range(60)]
    seen = Counter(tuple(t[i : i + 21]) for t in texts for i in range(len(t) - 20))
    want = {(k, j) for k, t in enumerate(texts) for i in range(len(t) - 20) if seen[tuple(t[i : i + 21])] > 1 for j in range(i, i + 21)}
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "row bigint, text string")
    got = {(x["row"], j) for x in sd.spans(rows, 400, 21).collect() for a, b in zip(x["word_spans"][::2], x["word_spans"][1::2]) for j in range(a, b)}
    assert want and got == want


def test_a_busy_core_is_split(spark, monkeypatch):
    """A passage that many texts quote, all other bytes of which differ, or end and begin in a few ways."""
    monkeypatch.setattr(sd, "BUSY", 5)
    r = random.Random(11)
    line = lambda n, of="abcdefgh ": "".join(r.choice(of) for _ in range(n))
    p = line(70)
    texts = [line(r.randint(0, 30), "abc") + p + line(r.randint(0, 30), "abc") for _ in range(150)] + [line(40) + p + line(40) for _ in range(40)]
    check(spark, texts + texts[:9], 46)


def test_very_long_text_across_chunks(spark, monkeypatch):
    from sparkloom.llm import anchors

    monkeypatch.setattr(anchors, "CHUNK", 50)
    r = random.Random(12)
    line = lambda n: "".join(r.choice("ab cd") for _ in range(n))
    p = line(300)
    for length in (46, 100):
        data = [line(500) + p + line(200) + p[20:280], p]
        own = [anchors.stretches(t.encode(), length) for t in data]
        assert all((x[1] - length + 1).sum() == len(t.encode()) - length + 1 for x, t in zip(own, data))
        check(spark, data, length)


def test_clashing_names(spark):
    p = "word " * 100
    docs = spark.createDataFrame([(1, p, 7, "a"), (2, p, 8, "b"), (3, "x", 9, "c")], "doc_id bigint, text string, _row bigint, spans string")
    rows = sd.keep(docs).orderBy("doc_id").collect()
    assert [(r["_row"], r["spans"], r["text"]) for r in rows] == [(7, "a", ""), (8, "b", ""), (9, "c", "x")]

def test_a_line_that_texts_repeat_is_one_row_a_text(spark, monkeypatch):
    """Stretches that a text holds several times meet those of other texts once, and all of their places go."""
    joined = []

    def counting(left, right, keys, n):
        joined.append((left.count(), right.agg({n: "sum"}).first()[0] or 0, left.join(right, keys).count()))
        return join_counted(left, right, keys, n)

    join_counted = sd.join_counted
    r = random.Random(13)
    line = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    texts = [line(r.randint(0, 60)) + "Is onhe. " * r.randint(60, 80) + line(r.randint(0, 60)) + "Is onhe. " * k for k in (0, 9, 40) for _ in range(8)]
    texts += [line(90), "Is onhe. " * 6, "once more " * 30]
    check(spark, texts, 46)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "row bigint, text string")
    monkeypatch.setattr(sd, "join_counted", counting)
    sd.spans(rows, 46, 21).count()
    assert joined[0][0] < 50 * len(texts) and joined[1][2] < 10 * len(texts)
    assert all(made == n for _, n, made in joined)
