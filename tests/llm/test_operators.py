import cProfile
import hashlib
import math
import random
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkloom.llm import bpe, common, components, embedding_dedup, fingerprints, language_id, lm_scoring, packing, quality, queries, simhash_dedup, suffix_dedup, tokens, url_filter

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, row string, score string, n string"
PATTERN = common.WORD_PATTERN


def texts():
    r = random.Random(2)
    words = ["alpha", "Beta", "gämma", "δ", "the", "of", "x1", "don't", "中文", "end."]
    out = [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(40)]
    return [*out, out[0], out[0], "", None, "  \n\t", "a", "no" * 3000, "x " * 5000, "!!! 123", "<|endoftext|> a<|startoftext|>", "tail \u00a0 space\u2003here\x1c", "A\u0301e\u0301 ﬁ"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else "de", "s", None, "c", "c", "c", "c") for i, t in enumerate(texts())]
    rows += [(0, "again an id", None, None, 1, None, None, None, None), (None, "no id at all", "en", None, 1, None, None, None, None), (0, "again an id", None, None, 1, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


def test_bpe_is_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip_digests(docs, path).collect())) == want
    assert bpe.round_trip_digests(empty, path).count() == 0
    coder = bpe.TrieBPE(path)
    assert all(coder.encode_words([w])[w] == [i] for w, i in list(coder.ids.items())[::50])


def test_bpe_learns_new_words_in_few_calls():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    t, r, coder = Tokenizer.from_file(path), random.Random(4), bpe.TrieBPE(path)
    parts = [*"abcXYZ019 '.,!-_$\n\t\r\x0b\x00", "  ", "é", "ß", "ª", "²", "×", "\xa0", "\x85", "中", "δ", "\u0301", "\u3000", "'s", "'ll", "<|endoftext|>", " the"]
    odd = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    odd += ["ab" * 500 + end for end in ("", "c", "d", "cd")]  # words that share more than is compared at once
    for text, pieces in zip(odd, coder.encode_many(odd)):
        ids = t.encode(text, add_special_tokens=False).ids
        assert ",".join(x for x, _ in pieces) == ",".join(map(str, ids)), text
        assert coder.decode(pieces) == t.decode(ids, skip_special_tokens=False), text
    words = list({"".join(r.choice(["ka", "lo", "mir", "ent", "su", "é"]) for _ in range(r.randint(2, 6))) + r.choice(["", ",", "."]) for _ in range(8000)})
    profile = cProfile.Profile()
    profile.enable()
    coder.encode_many([" ".join(words)])
    profile.disable()
    calls = sum(x.callcount for x in profile.getstats())
    assert coder.encode(" ".join(words)) == ",".join(map(str, t.encode(" ".join(words), add_special_tokens=False).ids))
    assert calls < 40 * len(words), calls / len(words)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rows = packing.pack(docs.where("doc_id > 0"), path, with_ids=True).collect()
    of, sequences = {}, {}
    for r in rows:
        of.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"])) and len(r["ids"]) == r["length"]
    for r in docs.where("doc_id > 0").collect():
        pieces = sorted(of[r["doc_id"]], key=lambda x: x["start"])
        ids = [i for p in pieces for i in p["ids"]]
        assert ids == [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        assert [p["start"] for p in pieces] == np.cumsum([0, *[p["length"] for p in pieces[:-1]]]).tolist()
        assert {p["doc_tokens"] for p in pieces} == {len(ids)}
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda x: x["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *[p["length"] for p in pieces[:-1]]]).tolist()
        n = sum(p["length"] for p in pieces)
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding == 0
    assert packing.pack(empty, path).count() == 0 and packing.pack(docs, path).count() > 0


def test_packing_encodes_signs_by_stretch_as_the_library():
    from tokenizers import Tokenizer

    path, r = queries.vocabulary("word_bpe_49k.json"), random.Random(6)
    t, coder = Tokenizer.from_file(path), packing.WordIds(path, 1)
    parts = [*"abcXYZ019 '.,!-_$<|>/w\n\t\r\x0b", "é", "ß", "À", "ª", "²", "×", "\xa0", "\xad", "'s", "'LL", "</w>", " the"]
    plain = ["a | b <c> d", *("".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000))]
    odd = ["x<|endoftext|>y", "<|startoftext|>", "<|STARTOFTEXT|>", "\x00 a", "İ", "中 δ", "A\u0301"]
    for text in plain + odd:
        assert coder(text) == struct.pack(f"<{len(ids := [*t.encode(text, add_special_tokens=False).ids, 1])}I", *ids), text
    want = [coder(text) for text in plain]
    coder.whole = None  # texts without a special token or a character beyond Latin-1 don't need it
    assert [coder(text) for text in plain] == want


def test_closest_fill_takes_long_lengths_at_once():
    counts, profile = {n: 1 for n in range(600, 2048)}, cProfile.Profile()
    profile.enable()
    used = packing.closest_fill(counts, 2048)
    profile.disable()
    assert sum(n * k for n, k in used.items()) == 2048 and all(k == 1 for k in used.values())
    assert sum(x.callcount for x in profile.getstats()) < 100


def test_closest_fill_against_brute_force():
    r = random.Random(1)
    for _ in range(300):
        counts = {r.randint(1, 12): r.randint(1, 3) for _ in range(r.randint(1, 4))}
        capacity = r.randint(1, 30)
        sums = {0}
        for n, k in counts.items():
            sums = {s + n * j for s in sums for j in range(k + 1)}
        used = packing.closest_fill(counts, capacity)
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= capacity)


class PlainModel:
    """The same model by dictionaries of tuples of words, scored word by word by its formula."""

    def __init__(self, learnt, masses):
        self.grams, self.masses = Counter(), masses
        for words in learnt:
            x = [None, *words, None]
            for n in range(1, len(masses) + 2):
                self.grams.update(tuple(x[i : i + n]) for i in range(n == 1, len(x) - n + 1))
        self.total = sum(n for g, n in self.grams.items() if len(g) == 1)
        self.room = self.total + sum(len(g) == 1 for g in self.grams) + 1

    def p(self, history, word):
        if not history:
            return (self.grams[(word,)] + 1) / self.room
        m, seen = self.masses[len(history) - 1], self.grams[(*history, word)]
        return (seen + m * self.p(history[1:], word)) / (self.grams[history] + m)

    def score(self, words):
        x = [None, *words, None]
        return sum(math.log10(self.p(tuple(x[max(0, i - len(self.masses)) : i]), x[i])) for i in range(1, len(x)))


@pytest.mark.parametrize(("block", "lane", "masses"), [(8_000_000, 512, lm_scoring.MASSES), (300, 3, (5.0, 2.0, 1.0, 0.5)), (40, 7, (5.0,))])
def test_lm(docs, empty, spark, monkeypatch, block, lane, masses):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_scoring, "LANE", lane)
    r = random.Random(3)
    phrases = [[r.choice("abcdefgh") for _ in range(r.randint(1, 9))] for _ in range(12)]
    more = [(1000 + i, " ".join(w for _ in range(r.randint(0, 8)) for w in r.choice(phrases))) for i in range(90)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows, given = lm_scoring.score(both, common.remainder(7) != 2, masses).collect(), both.collect()
    trains = [g["doc_id"] is not None and zlib.crc32(str(g["doc_id"]).encode()) % 7 != 2 for g in given]
    plain = PlainModel([common.words_of(g["text"]) for g, t in zip(given, trains) if t], masses)
    want = Counter()
    for g in given:
        words = common.words_of(g["text"])
        c = [plain.grams[(w,)] for w in [*words, None]]
        want[g["doc_id"], len(c), sum(n > 0 for n in c), plain.total, round(sum(math.log10((n + 1) / plain.room) for n in c), 6), round(plain.score(words), 6)] += 1
    assert Counter((x["doc_id"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 6), round(x["score"], 6)) for x in rows) == want
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 7 == 2) for x in lm_scoring.query(both).collect() if x["doc_id"] is not None)
    assert lm_scoring.query(empty).count() == 0


def test_lm_without_training_texts(docs):
    rows = lm_scoring.score(docs, F.lit(False)).collect()
    assert all(x["score"] == x["base_score"] == 0 and x["n_known"] == 0 for x in rows)


def test_memory_of_a_scoring_block():
    """A block's arrays take so many bytes a token at most while its automaton is built."""
    r = random.Random(17)
    kinds = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(30_000)]
    texts = pa.chunked_array([pa.array([" ".join(r.choice(kinds) for _ in range(500)) for _ in range(400)])])
    block = lm_scoring.Block(texts, pa.chunked_array([pa.array([True] * 400)]))
    answers = {}
    for order in (1, 2, 3):
        at, by_key, heads, _ = block.asked(order)
        answers[order] = np.add.reduceat(block.learnt[at][by_key].astype(np.int64), heads)
    del at, by_key, heads
    tracemalloc.start()
    try:
        block.hear(answers)
        automaton = lm_scoring.Automaton(block, len(block.tokens), len(answers[1]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(automaton.to) > 300_000 and peak < 180 * len(block.tokens), peak / len(block.tokens)


def test_lm_is_a_distribution():
    plain = PlainModel([list("abcabd"), list("abce"), list("ab")], (5.0, 2.0, 1.0))
    words = ["a", "b", "c", "d", "e", None, "never seen"]
    for history in [(None, "a"), ("a", "b"), ("c", "a", "b"), ("a", "b", "c"), ("x",), ("x", "a"), ()]:
        assert abs(sum(plain.p(history, w) for w in words) - 1) < 1e-12, history


def test_scoring_packs_keys_and_counts():
    r = np.random.default_rng(1)
    for n in (1, 3, 4, 5, 6, 1000):
        for keys in (np.sort(r.integers(0, 1 << 63, n).astype(np.uint64)), np.sort(r.integers(0, 1 << 40, n).astype(np.uint64))):
            assert (lm_scoring._unpack_keys(lm_scoring._pack_keys(keys), n) == keys).all()
        counts = r.integers(0, 1 << int(r.integers(1, 40)), n)
        assert (lm_scoring._unpack_counts(lm_scoring._pack_counts(counts)) == counts).all()


def test_words_are_hashed_alike():
    r = random.Random(6)
    texts_ = [*texts(), "z" * 511, "z" * 512, "z" * 513, " ".join("w%d" % r.randrange(500) for _ in range(400_000))]
    got, counts = tokens.words_of_texts(texts_)
    words = [w for t in texts_ for w in common.words_of(t)]
    assert counts.tolist() == [len(common.words_of(t)) for t in texts_] and len(set(got.tolist())) == len(set(words))
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(words, got.tolist()))
    some = got[:3000]
    for k in (1, 2, 5, 51):
        runs, at = tokens.runs_of(some, k), {}
        assert len(runs) == len(some) - k + 1 and all(at.setdefault(tuple(some[i : i + k].tolist()), h) == h for i, h in enumerate(runs.tolist()))
        assert len(set(at.values())) == len(at)
    keys = r.choices(range(50), k=1000)
    order, heads = tokens.grouped(np.array(keys, np.uint64))
    assert [keys[i] for i in order] == sorted(keys) and len(heads) == len(set(keys))
    assert tokens.numbered(order, heads).tolist() == np.unique(keys, return_inverse=True)[1].tolist()


def test_fingerprints(docs, empty):
    rows = fingerprints.edited_fingerprints(docs).collect()
    order = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""), reverse=True)
    fps = [fingerprints.fingerprint(r["text"]) for r in order]
    want = Counter()
    for r, after in zip(order, [*order[1:], order[0]]):
        a, b = r["text"] or "", after["text"] or ""
        e = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        fa, fe, fb = map(fingerprints.fingerprint, (a, e, b))
        within = sum((fa ^ f).bit_count() <= 3 for f in fps) - 1
        want[r["doc_id"], len(a), hashlib.sha256(e.encode()).hexdigest(), f"{fa:016x}", f"{fe:016x}", fingerprints.likeness(fa, fe), fingerprints.likeness(fa, fb), within] += 1
    assert Counter(map(tuple, rows)) == want
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert fingerprints.edited_fingerprints(docs.where("doc_id = 5")).count() == 1


def test_fingerprint_is_a_weighted_vote():
    """Against votes counted bit by bit over a dictionary of terms."""
    for text in texts():
        words = tokens.words_of_texts([text])[0]
        n = min(3, len(words))
        terms = Counter(tokens.mix(tokens.runs_of(words, n)).tolist()) if n else {}
        weight = {t: round(1024 * (1 + math.log(c))) for t, c in terms.items()}
        want = sum(1 << b for b in range(64) if sum(w if t >> b & 1 else -w for t, w in weight.items()) > 0)
        assert fingerprints.fingerprint(text) == want


@pytest.mark.parametrize("most", [500, 2])
def test_permuted_tables(spark, monkeypatch, most):
    monkeypatch.setattr(fingerprints, "MOST_POSTED", most)
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(50)]
    fps = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base]
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "id bigint, fp bigint")
    got = {tuple(x) for x in fingerprints.find_within(df.toDF("query_id", "fp"), df, 3).collect()}
    assert got == {(i, j, (a ^ b).bit_count()) for i, a in enumerate(fps) for j, b in enumerate(fps) if (a ^ b).bit_count() <= 3}
    kinds = {f: i for i, f in enumerate(fps)}
    pairs = {frozenset(x) for x in fingerprints.pairs_within(df.where(F.col("id").isin(list(kinds.values()))), 3).collect()}
    assert pairs == {frozenset((i, j)) for a, i in kinds.items() for b, j in kinds.items() if 0 < (a ^ b).bit_count() <= 3}


@pytest.mark.parametrize("most", [500, 2])
def test_simhash_pairs_and_components(spark, monkeypatch, most):
    monkeypatch.setattr(simhash_dedup, "MOST_POSTED", most)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(6)})
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "id bigint, fp bigint")
    got = [tuple(sorted(x)) for x in simhash_dedup.near_pairs(df).collect()]
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want
    # the index is whole and the tally filters: exactly what shares five positional bytes passes, more than is near
    met = [(tuple(sorted(x[:2])), x["shared"]) for x in simhash_dedup.tallied(df).collect()]
    alike = lambda a, b: sum((a ^ b) >> 8 * k & 255 == 0 for k in range(8))
    five = {(i, j): alike(fps[i], fps[j]) for i in range(len(fps)) for j in range(i + 1, len(fps)) if alike(fps[i], fps[j]) >= 5}
    assert set(met) == set(five.items()) and set(five) > want
    forest = components.Forest()
    for i, j in want:
        forest.join(i, j)
    tied = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(sorted(want), "u bigint, v bigint")).collect()}
    assert tied == {i: forest.root(i) for p in want for i in p}


def test_components_of_a_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)], "u bigint, v bigint").repartition(7)
    assert {r["component"] for r in components.components(pairs).collect()} == {0}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_simhash_dedup(docs, empty):
    rows = simhash_dedup.query(docs).collect()

    def fp(text):
        w = common.words_of(text)
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    given = docs.select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in rows) == Counter((r["doc_id"], f"{fp(r['text']):016x}") for r in given)
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] not in (0, None)}
    rows = [(i, fp(t)) for i, t in ((r["doc_id"], r["text"]) for r in given) if i is not None]
    forest = components.Forest()
    for i, a in rows:
        for j, b in rows:
            if (a ^ b).bit_count() <= 3:
                forest.join(i, j)
    assert of == {i: forest.root(i) for i, _ in rows if i}
    assert simhash_dedup.query(empty).count() == 0


def test_language(docs, empty, spark):
    rows = language_id.query(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by[41 + 1] == "und" and by[43] == "und" and by[48] == "und"  # empty, null, no letter
    assert language_id.query(empty).count() == 0
    r = random.Random(1)
    make = lambda alphabet: " ".join("".join(r.choice(alphabet) for _ in range(5)) for _ in range(40))
    train = spark.createDataFrame([(i, make("abcdef") if i % 2 else make("uvwxyz"), "ab" if i % 2 else "uv") for i in range(200)], "doc_id bigint, text string, lang string")
    got = language_id.query(train).where("held_out").join(train, "doc_id").where("lang = lang_pred").count()
    assert got == language_id.query(train).where("held_out").count()
    assert set(language_id.keep(docs).columns) == set(docs.columns)


def test_quality(docs, empty, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (999, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.query(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert quality.query(empty, labels).count() == 0
    assert {round(r["score"], 9) for r in quality.query(docs, labels.limit(0)).collect()} == {0.5}
    r = random.Random(1)
    junk = lambda: " ".join(r.choice(["lorem", "ipsum", "dolor"]) + "###" for _ in range(50))
    good = lambda: " ".join(r.choice(["lorem", "ipsum", "dolor", "sit.", "amet,"]) for _ in range(50))
    d = spark.createDataFrame([(i, junk() if i % 4 == 0 else good()) for i in range(200)], "doc_id bigint, text string")
    y = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)], "doc_id bigint, quality int")
    assert quality.query(d, y).join(y, "doc_id").where("predicted <> quality").count() == 0


def held_out(sf, name):
    return f"/root/testdata/{sf}/{name}.parquet"


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(held_out("sf0.01", "documents"))
    rows = language_id.query(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    kept = language_id.keep(docs).count()
    assert kept >= 0.9 * docs.count()


def test_language_across_chunks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    whole = language_id.counts_of(text)
    monkeypatch.setattr(language_id, "CHUNK", 1000)
    cut = language_id.counts_of(text)
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])
    assert len(language_id.counts_of(text, 5)[0]) == 5


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MAX_SAMPLE", 3)
    rows = [(i, f"text {i}", f"l{i}") for i in range(20)]
    with pytest.raises(ValueError, match="languages"):
        language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(held_out("sf0.1", n)) for n in ("documents", "labels"))
    rows = quality.query(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(rows) > 500 and wins >= 0.98 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_quality_of_tied_labels(spark):
    docs = spark.createDataFrame([(i, "good words here." if i % 2 else "### !!! ###") for i in range(40)], "doc_id bigint, text string")
    once = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    twice = once.union(spark.createDataFrame([(0, 1), (2, 1), (0, 0)], once.schema))  # an id with both labels counts as 0
    a, b = (sorted(map(tuple, quality.query(docs, y).collect())) for y in (once, twice))
    assert a == b


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(30):
        center = rng.normal(size=8)
        rows += [(len(rows) + j, (center + rng.normal(size=8) * r).astype(np.float32).tolist(), k % 3) for j, r in enumerate((0, 0.05, 0.2, 0.4))]
    n = len(rows)
    rows += [(n + j, rows[j][1], rows[j][2]) for j in range(20)]
    rows += [(n + 30, None, 1), (n + 31, [0.0] * 8, 1), (n + 32, [float("nan")] * 8, 1), (n + 33, [float("inf")] * 8, 1), (n + 34, rows[0][1], None), (n + 35, [1.0, None] + [0.0] * 6, 1), (n + 36, rows[0][1][:4], 0), (n + 37, [x * 3 for x in rows[0][1]], 0), (n + 38, [], 0)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("block", [5, 256])
def test_embeddings(vectors, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    given = {r["vec_id"]: r for r in vectors.collect()}
    v = {i: np.array(r["embedding"], float) for i, r in given.items() if r["label"] is not None and r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and any(r["embedding"])}
    forest, links = components.Forest(), Counter()
    for i in v:
        for j in v:
            if i < j and given[i]["label"] == given[j]["label"] and len(v[i]) == len(v[j]) and v[i] @ v[j] / np.sqrt((v[i] @ v[i]) * (v[j] @ v[j])) >= 0.98:
                links[i] += 1
                links[j] += 1
                forest.join(i, j)
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.query(vectors).collect()}
    assert got == {i: (links[i], forest.root(i), forest.root(i) == i) for i in given}
    assert embedding_dedup.query(vectors.limit(0)).count() == 0


def test_urls(spark):
    weights = url_filter.train(url_filter.labelled_table(spark))
    cases = [
        ("http://A.Example.com/fr/x?q#f", "a.example.com", "/fr/x", "com/", "allow"), ("https://m.example.com/en/1", "m.example.com", "/en/1", "example.com/en/", "block"),
        ("https://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"), ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
        ("http://net/fr/9", "net", "/fr/9", "net/fr/", "block"), ("http://example.com", "example.com", "", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None),
        ("x://notcom/", "notcom", "/", None, None), ("a://b://c/d", "b:", "//c/d", None, None), ("", "", "", None, None), ("h://é.COM?x", "é.com", "", None, None),
    ]
    df = spark.createDataFrame([(i, c[0], 1, "x") for i, c in enumerate(cases)], "page_id bigint, url string, n int, host string")
    got = url_filter.judge(df.select("page_id", "url"), weights).orderBy("page_id").collect()
    for r, c in zip(got, cases):
        assert (r["host"], r["path"], r["rule"]) == c[1:4] and r["verdict"] in (c[4:] if c[4] else ("allow", "block"))
    seen = url_filter.judge(url_filter.labelled_table(spark).select(F.monotonically_increasing_id().alias("page_id"), "url", "label").drop("label"), weights, rules=[]).collect()
    right = sum((r["verdict"] == "allow") == bool(y) for r, (_, y) in zip(sorted(seen, key=lambda r: r["page_id"]), url_filter.LABELLED))
    assert right >= 0.9 * len(url_filter.LABELLED)
    assert url_filter.judge(df.select("page_id", "url").limit(0), weights).count() == 0
    unseen = [
        ("https://library.museum.org/guide/collection", 1), ("https://research.university.edu/paper/77", 1), ("https://news.science.org/report/2023", 1), ("https://wiki.gardeners.net/species/rose", 1),
        ("https://docs.school.edu/lessons/history/2", 1), ("https://www.recipes.org/bread/soup.html", 1), ("http://casino-win.biz/free-bonus?ref=1", 0), ("http://buy-pills.shop/viagra/cheap", 0),
        ("http://free-crack.click/download/keygen", 0), ("http://poker.bonus.win/play/slots", 0), ("http://seo-spam.top/click/backlinks", 0), ("http://adult-video.club/watch/free", 0),
    ]
    judged = url_filter.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(unseen)], "page_id bigint, url string"), weights, rules=[]).collect()
    assert sum((r["verdict"] == "allow") == bool(unseen[r["page_id"]][1]) for r in judged) >= 0.9 * len(unseen)


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline as p

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    nothing = tmp_path / "nothing"
    docs.limit(0).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(nothing / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(nothing / "labels.parquet"))
    assert p.run(spark, str(nothing)).count() == 0
    assert [n for n, _ in p.STAGES] == ["quality", "language", "near_duplicates", "passages", "packing"]
    out = p.run(spark, str(tmp_path))
    assert out.count() > 0 and "sequence_id" in out.columns
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in p.STAGES[:4]:
        step = common.written(stage(spark, step, str(tmp_path)))
        assert step.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("rows_of_a_chunk", [3, 1000])
def test_similar_groups(spark, monkeypatch, rows_of_a_chunk):
    monkeypatch.setattr(simhash_dedup, "CHUNK_ROWS", rows_of_a_chunk)
    r = random.Random(9)
    rows, family = [], {}
    for k in range(12):
        base = [f"w{r.randrange(5000)}" for _ in range(300)]
        for j in range(6):
            words = list(base)
            for i in r.sample(range(300), j):
                words[i] = "edit"
            family[len(rows)] = k
            rows.append((len(rows), " ".join(words)))
    rows += [(1000, ""), (1001, None), (1002, "one"), (1003, "one")]
    got = {x["doc_id"]: x["component_id"] for x in simhash_dedup.group(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=5, similarity=0.8).collect()}
    assert all(got[i] == 6 * k for i, k in family.items())
    assert (got[1000], got[1001], got[1002], got[1003]) == (1000, 1000, 1002, 1002)


@pytest.mark.parametrize("rows_of_a_chunk", [2, 1000])
def test_similar_groups_against_brute_force(spark, monkeypatch, rows_of_a_chunk):
    """Families around a base at all similarities, some of whose members are linked with each other alone."""
    monkeypatch.setattr(simhash_dedup, "CHUNK_ROWS", rows_of_a_chunk)
    r = random.Random(14)
    rows = []
    for _ in range(6):
        base = [f"w{r.randrange(5000)}" for _ in range(200)]
        for _ in range(12):
            words = list(base)
            for i in r.sample(range(190), r.choice([0, 1, 2, 4, 6, 10, 20])):
                words[i] = f"x{r.randrange(9)}"
            rows.append((len(rows), " ".join(words)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(196)} for _, t in rows]
    forest, links = components.Forest(), 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                forest.join(i, j)
                links += sets[i] != sets[j]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x["doc_id"]: x["component_id"] for x in simhash_dedup.group(docs, shingle=5, similarity=0.8).collect()}
    assert links > 20 and got == {i: forest.root(i) for i in range(len(rows))}


def test_keep_similar_judges_rows(spark):
    text = " ".join(f"w{i}" for i in range(100))
    near, other = text + " end", " ".join(f"v{i}" for i in range(100))
    rows = [(5, other, 1), (5, near, 2), (2, text, 3), (None, text, 4), (None, "alone", 5), (5, other, 6), (7, None, 7), (6, "", 8), (None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row bigint").coalesce(1)
    assert sorted(x["row"] for x in simhash_dedup.keep_similar(docs, 5, 0.8).collect()) == [1, 3, 5, 8]
    assert simhash_dedup.keep_similar(docs.limit(0), 5, 0.8).count() == 0


def most_workers(plan, above=0):
    """The most Python workers that a task of a physical plan runs at once."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return most_workers(plan.initialPlan(), above)
    here = 0 if "Exchange" in plan.nodeName() else above + ("MapInArrow" in plan.nodeName())
    below = plan.children()
    return max([here, *(most_workers(below.apply(i), here) for i in range(below.size()))])


def test_a_task_of_the_pipeline_runs_one_worker(spark, monkeypatch):
    """Workers stay with an executor, so one that runs two in a task has twice as many in all stages after that."""
    import corpus_pipeline

    found = []

    def seen(df):
        found.append((most_workers(df._jdf.queryExecution().executedPlan()), df.columns))
        return common.written(df)

    for module in (simhash_dedup, components, suffix_dedup):
        monkeypatch.setattr(module, "written", seen)
    r = random.Random(14)
    line = lambda n: " ".join(r.choice("abcdefghij") * r.randint(1, 9) for _ in range(n))
    base, passage = line(200), line(120)
    rows = [(i, base + f" {i}" if i % 2 else line(9) + passage + line(9), "en", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint")
    for stage, left in ((corpus_pipeline.near_duplicate_stage, 7), (corpus_pipeline.passage_stage, 12)):
        done = stage(spark, docs, "")
        found.append((most_workers(done._jdf.queryExecution().executedPlan()), done.columns))
        assert done.count() == left
    assert max(n for n, _ in found) == 1, [c for n, c in found if n > 1]


def test_similar_groups_are_verified(spark):
    r = random.Random(12)
    jaccard = lambda a, b: len(a & b) / len(a | b)
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    rows, apart = [], 0
    for k in range(40):
        base = [f"w{r.randrange(50000)}" for _ in range(304)]
        tail = 304 - r.choice([34, 36, 45, 60, 75])  # about 0.8, 0.79, 0.74, 0.67 and 0.6
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:tail] + [f"x{r.randrange(50000)}" for _ in range(304 - tail)]))]
    line = "one line of boilerplate text here " * 60  # equal fingerprints, other shingles
    rows += [(1000, line + " ".join(f"a{i}" for i in range(40))), (1001, line + " ".join(f"b{i}" for i in range(40)))]
    got = {x["doc_id"]: x["component_id"] for x in simhash_dedup.group(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=5, similarity=0.8).collect()}
    of = {i: shingles(t.split()) for i, t in rows}
    for i in [*range(0, 80, 2), 1000]:
        near = jaccard(of[i], of[i + 1])
        apart += 0.7 <= near < 0.8
        assert (got[i], got[i + 1]) == (i, i if near >= 0.8 else i + 1), near
    assert apart > 5


def test_sql_of_queries(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, sf)
        columns = sorted(df.columns)
        assert sorted(map(tuple, df.select(*columns).collect())) == sorted(con.sql("select " + ", ".join(columns) + f" from ({sql})").fetchall())
