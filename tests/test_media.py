import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from sparkloom.operators import image, tokenize


def png(x):
    h, w = x.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + x[y].tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images(spark):
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 256, (300, 300)).astype(np.uint8)
    flat = np.full((300, 300), 7, np.uint8)
    wave = (128 + 100 * np.sin(np.arange(300)[:, None] / 40 + np.arange(300)[None, :] / 25)).astype(np.uint8)
    near = np.clip(wave.astype(int) + rng.integers(-3, 4, wave.shape), 0, 255).astype(np.uint8)
    rows = [(1, png(noise)), (2, png(flat)), (3, png(wave)), (4, png(near)), (5, b"junk" * 500), (6, None)]
    df = spark.createDataFrame(rows, "id int, data binary").withColumns({"blur": image.sharpness("data"), "hash": image.perceptual_hash("data"), "format": image.image_format(F.col("data"))})
    got = {r["id"]: r for r in df.withColumn("reason", image.outcome(F.lit(300), F.lit(300), F.col("data"), F.col("blur"))).collect()}
    assert got[1]["reason"] is None and got[1]["format"] == "PNG" and got[5]["reason"] == "invalid_format" and got[6]["reason"] == "no_image_data"
    assert got[2]["blur"] == 0 and np.array_equal(image.pixels(rows[0][1]), noise)
    assert {tuple(r) for r in image.near_images(df.select("id", "hash").where("id in (1, 3, 4)")).collect()} == {(3, 4)}


def test_tokens(spark):
    df = spark.createDataFrame([(1, 0, [5, 6, 7]), (2, 0, [8]), (3, 1, [])], "id int, batch int, ids array<int>")
    got = {r["id"]: r for r in df.withColumns(tokenize.sized(F.col("ids"), 3, pad=9, bos=1)).collect()}
    assert got[1]["input_ids"] == [1, 5, 6] and got[1]["truncated"] and got[2]["input_ids"] == [1, 8, 9] and got[2]["attention_mask"] == [1, 1, 0]
    c = {r["id"]: r for r in tokenize.collate(df, "batch", "ids").collect()}
    assert c[2]["padded_ids"] == [8, 0, 0] and c[2]["labels"] == [8, -100, -100] and c[3]["padded_ids"] == []
    s = tokenize.statistics(df, "ids", 2).first()
    assert (s["total"], s["tokens"], s["max_tokens"], s["truncated"], s["padded"]) == (3, 4, 3, 1, 2)
    m = spark.createDataFrame([([("user", [1, 2]), ("assistant", [3])],)], "m array<struct<role:string,ids:array<int>>>")
    assert m.select(tokenize.masked_labels(F.col("m")).alias("l")).first()["l"] == [-100, -100, 3]
    x = df.select(*[v.alias(k) for k, v in tokenize.multimodal(F.col("ids"), F.lit(1), F.lit(0), 100, 200).items()]).first()
    assert len(x["input_ids"]) == 259 and x["token_type_ids"][-1] == 1
