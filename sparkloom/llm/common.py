"""What the training-data operators share: tables, shared storage and text helpers."""

from __future__ import annotations

import atexit
import ctypes
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.skew import join_counted, pin_splits

__all__ = ["arrow_map", "batch_of", "give_back", "join_counted", "pin_splits", "remainder", "shared_folder", "ship", "table", "unused", "words_of", "written"]

#: A word: a run of bytes that are no ASCII white space (``bytes.split`` cuts at the same six bytes).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows of a record batch that are Python objects at one time.
SLICE_ROWS = 1000

_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8 with A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_UPPER).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that they need no shared folder for code."""
    context = spark.sparkContext
    if getattr(context, "_sparkloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"{root.name}/{path.relative_to(root)}")
    folder = Path(tempfile.mkdtemp(prefix="ship-"))
    (folder / "sparkloom_code.zip").write_bytes(packed.getvalue())
    context.addPyFile(str(folder / "sparkloom_code.zip"))
    context._sparkloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="sparkloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    except Exception:  # the session may have ended before
        pass


def written(df: DataFrame) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/sparkloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=1)
def _trimmer() -> Callable[[int], int]:
    """The C library's malloc_trim, where it has one."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def give_back() -> None:
    """Return a worker's unused memory to the machine: workers are used again, and arrays of one stage would stay in the next."""
    pa.default_memory_pool().release_unused()
    _trimmer()(0)


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """Map record batches, SLICE_ROWS rows at a time; a result of None adds nothing."""
    ship(df.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                if (out := each(batch.slice(at, SLICE_ROWS))) is not None:
                    yield out
            give_back()

    return df.mapInArrow(over, schema)


def unused(name: str, taken: list[str]) -> str:
    """A column name like the given one that is not taken (names differ in more than their case)."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batch_of(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)


def remainder(modulus: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo: the folds of the contracts. A null id is in fold null."""
    return F.crc32(F.col(column).cast("string")) % modulus
