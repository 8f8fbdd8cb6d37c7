"""Image checks on bytes: format, size, shape, blur, perceptual hash. Pixels are read from PNG and PNM files with numpy."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

# Limits of a valid image, and the first bytes of the formats.
LEAST_BYTES, MOST_BYTES, LEAST_SIDE, MOST_SIDE, LEAST_ASPECT, MOST_ASPECT, LEAST_SHARPNESS = 1024, 50 * 1024 * 1024, 256, 8192, 0.1, 10.0, 100.0
DISTANCE, LEAST_AESTHETIC, CLIP_LIMIT = 10, 5.0, 0.2
MAGIC = {"JPEG": "FFD8FF", "PNG": "89504E470D0A1A0A", "GIF": "47494638", "BMP": "424D"}


def image_format(data: Column) -> Column:
    start = F.hex(F.substring(data, 1, 12))
    out = F.when(start.startswith("52494646") & F.substring(start, 17, 8).eqNullSafe("57454250"), "WEBP")
    for name, magic in MAGIC.items():
        out = out.when(start.startswith(magic), name)
    return out


def pixels(data: bytes | None) -> np.ndarray | None:
    """Grey levels of a PNG (8 bits, not interlaced) or binary PNM; None if it can't be read."""
    try:
        if data[:2] in (b"P5", b"P6"):
            kind, w, h, _, rest = data.split(maxsplit=4)[0], *map(int, data.split(maxsplit=4)[1:4]), None
            body = data[len(data) - w * h * (1 if kind == b"P5" else 3) :]
            x = np.frombuffer(body, np.uint8).reshape(h, w, -1)
        else:
            at, idat, head = 8, [], None
            while at < len(data):
                n, kind = struct.unpack(">I4s", data[at : at + 8])
                if kind == b"IHDR":
                    head = struct.unpack(">IIBBBBB", data[at + 8 : at + 21])
                elif kind == b"IDAT":
                    idat.append(data[at + 8 : at + 8 + n])
                at += 12 + n
            w, h, depth, colour, _, _, laced = head
            if depth != 8 or laced or colour == 3:
                return None
            c = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
            raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(h, 1 + w * c)
            x = np.zeros((h, w * c), np.uint8)
            for y in range(h):
                line, above = raw[y, 1:].astype(int), x[y - 1].astype(int) if y else np.zeros(w * c, int)
                if raw[y, 0] == 0:
                    x[y] = line
                elif raw[y, 0] == 2:
                    x[y] = (line + above) % 256
                else:
                    for i in range(w * c):
                        a, b, d = int(x[y, i - c]) if i >= c else 0, above[i], above[i - c] if i >= c else 0
                        p = a + b - d
                        near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
                        x[y, i] = (line[i] + {1: a, 3: (a + b) // 2, 4: near}[raw[y, 0]]) % 256
            x = x.reshape(h, w, c)
            x = x[:, :, :3] if c in (3, 4) else x[:, :, :1]
        return x.astype(float).mean(axis=2)
    except Exception:
        return None


@F.pandas_udf(DoubleType())
def sharpness(data: pd.Series) -> pd.Series:
    """Variance of the Laplacian; null where the pixels can't be read."""

    def of(d):
        x = pixels(d)
        if x is None or min(x.shape) < 3:
            return None
        return float((x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]).var())

    return data.map(of)


def hash_of(x: np.ndarray) -> int:
    """64 bits: low frequencies of a 32 x 32 cosine transform over their median."""
    rows = np.linspace(0, x.shape[0], 33).astype(int)
    cols = np.linspace(0, x.shape[1], 33).astype(int)
    small = np.array([[x[rows[i] : max(rows[i + 1], rows[i] + 1), cols[j] : max(cols[j + 1], cols[j] + 1)].mean() for j in range(32)] for i in range(32)])
    k, n = np.arange(8)[:, None], np.arange(32)[None, :]
    basis = np.cos(np.pi * k * (2 * n + 1) / 64)
    low = basis @ small @ basis.T
    return int(np.packbits((low > np.median(low)).reshape(-1)).view(">i8")[0])


@F.pandas_udf(LongType())
def perceptual_hash(data: pd.Series) -> pd.Series:
    return data.map(lambda d: None if (x := pixels(d)) is None else hash_of(x))


@F.pandas_udf(StructType([StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("brightness", DoubleType()), StructField("sharpness", DoubleType())]))
def measured(data: pd.Series) -> pd.DataFrame:
    """Width, height, mean grey level and sharpness of each image, read once; nulls where the pixels can't be read.

    Sizes of JPEG, GIF and BMP come from their headers.
    """
    out = []
    for d in data:
        x = pixels(d)
        if x is None:
            out.append((*(header_size(d) or (None, None)), None, None))
            continue
        blur = None if min(x.shape) < 3 else float((x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]).var())
        out.append((x.shape[1], x.shape[0], float(x.mean()), blur))
    frame = pd.DataFrame(out, columns=["width", "height", "brightness", "sharpness"], index=data.index)
    return frame.astype({"width": "Int32", "height": "Int32", "brightness": "float64", "sharpness": "float64"})


def header_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) that the header of a PNG, GIF, BMP or JPEG file tells."""
    if not data or len(data) < 26:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return struct.unpack(">II", data[16:24])
    if data[:3] == b"GIF":
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM":
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    at = 2
    while data[:2] == b"\xff\xd8" and at + 9 < len(data) and data[at] == 0xFF:
        kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        at += 2 + size
    return None


def aesthetic(width: Column, height: Column) -> Column:
    """Heuristic from 1 to 10: 5, more for many pixels and for usual shapes."""
    area, shape = width.cast("long") * height, F.try_divide(width, height)
    more = F.when(area > 1920 * 1080, 1.0).when(area > 1280 * 720, 0.5).otherwise(0.0)
    usual = F.when((shape > 1.3) & (shape < 1.9), 0.5).when((shape > 0.9) & (shape < 1.1), 0.3).otherwise(0.0)
    return F.least(F.lit(10.0), F.greatest(F.lit(1.0), 5.0 + more + usual))


def outcome(width: Column, height: Column, data: Column, blur: Column, nsfw: Column | None = None, beauty: Column | None = None, watermark: Column | None = None) -> Column:
    """The first rule that fails, or null. Rules of models (nsfw, aesthetic, watermark scores) hold where a score is given."""
    aspect = F.try_divide(width, height)
    out = (
        F.when(data.isNull(), "no_image_data").when(image_format(data).isNull(), "invalid_format").when(~F.length(data).between(LEAST_BYTES, MOST_BYTES), "invalid_size")
        .when((F.least(width, height) < LEAST_SIDE) | (F.greatest(width, height) > MOST_SIDE), "resolution_filtered").when(~aspect.between(LEAST_ASPECT, MOST_ASPECT), "aspect_ratio_filtered").when(blur < LEAST_SHARPNESS, "blur_filtered")
    )
    if nsfw is not None:
        out = out.when(nsfw > 0.5, "nsfw_filtered")
    if beauty is not None:
        out = out.when(beauty < LEAST_AESTHETIC, "aesthetic_filtered")
    if watermark is not None:
        out = out.when(watermark > 0.5, "watermark_filtered")
    return out


def clean(images: DataFrame, score_aesthetic: bool = False) -> DataFrame:
    """images (data binary, ...) with size, brightness, sharpness, status, reason and quality_score (aesthetic / 10, or null)."""
    out = images.withColumn("_m", measured("data"))
    out = out.select(*images.columns, "_m.*")
    beauty = aesthetic(F.col("width"), F.col("height")) if score_aesthetic else None
    out = out.withColumn("reason", outcome(F.col("width"), F.col("height"), F.col("data"), F.col("sharpness"), beauty=beauty))
    score = (beauty / 10) if score_aesthetic else F.lit(None).cast("double")
    return out.withColumns({"status": F.when(F.col("reason").isNull(), "success").otherwise("filtered"), "quality_score": score})


def quality_predicate(width: Column, height: Column, data: Column, blur: Column) -> Column:
    """Whether an image passes all rules (the cleaner's filter_quality, the collector's verification)."""
    return outcome(width, height, data, blur).isNull()


def clip_gate(similarity: Column, limit: float = CLIP_LIMIT) -> Column:
    """Whether a given image-text similarity reaches the limit; without one the gate is open."""
    return F.coalesce(similarity >= limit, F.lit(True))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def loaded(files: DataFrame, items: DataFrame) -> DataFrame:
    """items with ``data``: bytes of the file at ``path``, else of the one at ``url``, else inline (base64). files: (path, content)."""
    one = files.select(F.col("path").alias("_p"), F.col("content").alias("_a"))
    two = files.select(F.col("path").alias("_u"), F.col("content").alias("_b"))
    out = items.join(one, F.col("path") == F.col("_p"), "left").join(two, F.col("url") == F.col("_u"), "left")
    return out.withColumn("data", F.coalesce("_a", "_b", F.try_to_binary(F.col("inline"), F.lit("base64")))).select(*items.columns, "data")


def near_images(hashes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of images whose hashes differ in at most ``distance`` bits: they agree in one of distance + 1 blocks."""
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    blocks = F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned("hash", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)).alias("v")) for i in range(distance + 1)])
    posted = hashes.where("hash is not null").select("id", "hash", F.explode(blocks).alias("k"))
    a, b = posted.alias("a"), posted.alias("b")
    met = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.id") < F.col("b.id")) & (F.bit_count(F.col("a.hash").bitwiseXOR(F.col("b.hash"))) <= distance))
    return met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
