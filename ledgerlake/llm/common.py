"""Helpers shared by the operators: table access, shared scratch tables, batches, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows and bytes that one Arrow batch may hold: bounds a Python worker's memory whatever
# the length of the texts.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 * 1024 * 1024

# ASCII bytes that end a word: everything but digits and letters. Bytes from 0x80 on (all
# non-ASCII characters in UTF-8) belong to words.
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
WORD_BYTES = bytes(
    32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers (a smaller session value stays)."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        try:
            now = int(spark.conf.get(key).rstrip("bB"))
        except ValueError:
            now = 0
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, as the cluster names it in spark.checkpoint.dir.
    Only a local session without that setting gets a scratch folder of its own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        path = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, from a table written in the shared folder: later steps neither
    recompute them nor depend on the executors that made them."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def byte_batches(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `most` characters each (one text at least)."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8 bytes; a null text has none."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix): the same on every machine and in every process."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def map_texts(docs: DataFrame, carry: list[str], text_col: str, fields: str,
              make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """Rows (doc, *fields): `doc` is a struct of the columns `carry`, so their names cannot
    clash with results; `make()` is called once per task and gives the function from a list
    of texts to one list per field of `fields` (a DDL string)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"),
                         F.col(f"`{text_col}`").alias("text"))
    results = StructType.fromDDL(fields)
    kinds = to_arrow_schema(results)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            got = f(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, k.type) for x, k in zip(got, kinds)]],
                names=["doc", *kinds.names])

    return source.mapInArrow(work, StructType([source.schema["doc"], *results.fields]))
