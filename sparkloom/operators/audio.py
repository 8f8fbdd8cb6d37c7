"""Audio checks on WAV bytes (16-bit PCM): duration, level, silence, a rough signal-to-noise ratio, and the outcome of the rules."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

LEAST_SECONDS, MOST_SECONDS, LEAST_RATIO, MOST_SILENCE = 0.5, 3600.0, 10.0, 0.8
#: Milliseconds of a frame, and the level under which one is silent.
FRAME_MS, SILENT = 20, 0.01
MEASURES = StructType([StructField("seconds", DoubleType()), StructField("rate", IntegerType()), StructField("channels", IntegerType()), StructField("silence", DoubleType()), StructField("ratio", DoubleType())])


def samples(data: bytes | None) -> tuple[np.ndarray, int, int] | None:
    """(mono samples from -1 to 1, rate, channels); None for what is no 16-bit WAV file."""
    try:
        with wave.open(io.BytesIO(data)) as w:
            if w.getsampwidth() != 2:
                return None
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
            return x.mean(axis=1) / 32768, w.getframerate(), w.getnchannels()
    except (wave.Error, EOFError, TypeError, ValueError):
        return None


def measures(data: bytes | None) -> tuple:
    found = samples(data)
    if found is None:
        return (None,) * 5
    x, rate, channels = found
    size = max(1, rate * FRAME_MS // 1000)
    frames = x[: len(x) // size * size].reshape(-1, size)
    if not len(frames):
        return len(x) / rate, rate, channels, None, None
    level = np.sqrt((frames**2).mean(axis=1))
    low, high = np.percentile(level, (10, 90))
    return len(x) / rate, rate, channels, float((level < SILENT).mean()), float(20 * np.log10((high + 1e-9) / (low + 1e-9)))


@F.pandas_udf(MEASURES)
def measured(data: pd.Series) -> pd.DataFrame:
    rows = pd.DataFrame([measures(d) for d in data], columns=MEASURES.names, index=data.index)
    return rows.astype({"rate": "Int32", "channels": "Int32", "seconds": "float64", "silence": "float64", "ratio": "float64"})


def outcome(m: Column) -> Column:
    """The first rule that fails, or null."""
    return (
        F.when(m["seconds"].isNull(), "invalid_format").when(~m["seconds"].between(LEAST_SECONDS, MOST_SECONDS), "duration_filtered")
        .when(m["silence"] > MOST_SILENCE, "silence_filtered").when(m["ratio"] < LEAST_RATIO, "snr_filtered")
    )


def clean(clips: DataFrame) -> DataFrame:
    """clips (data binary, ...) with their measures, status and reason."""
    out = clips.withColumn("_m", measured("data"))
    out = out.select(*clips.columns, "_m.*", outcome(F.col("_m")).alias("reason"))
    return out.withColumn("status", F.when(F.col("reason").isNull(), "success").otherwise("filtered"))
