"""Helpers the operators share: durable intermediates, row-wise Arrow passes."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanpack.checkpoint import checkpoint_dir

#: Texts are handed to Python in slices of about this many bytes.
SLICE_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.
    Only a local session without one gets a temporary folder."""
    folder = checkpoint_dir(spark)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spanpack-ckpt-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost
    executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with about ``most`` bytes in column
    ``text`` (one row at least), so memory follows bytes and not row counts."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i in range(n):
        held += int(sizes[i])
        if held >= most:
            yield batch.slice(at, i + 1 - at)
            at, held = i + 1, 0
    if at < n:
        yield batch.slice(at)


def texts_of(batch: pa.RecordBatch, name: str) -> list[str]:
    """The column as Python strings; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's UTF-8 bytes; null counts as empty."""
    c = batch.column(name)
    c = c.cast(pa.large_binary()) if pa.types.is_large_string(c.type) else c.cast(pa.binary())
    return [b or b"" for b in c.to_pylist()]


def keep_rows(df: DataFrame, text: str, verdict: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows of ``df`` (all its columns, as they are) whose text is judged
    True. ``verdict()`` is called once per task and gives the judge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = verdict()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(judge(texts_of(part, text)), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def row_key(doc_id: str = "doc_id", text: str = "text"):
    """A string that names a row: its text's SHA-256 and its id, if it has one.
    Only rows that repeat both have one name."""
    return F.concat(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), F.coalesce(F.concat(F.lit(":"), F.col(doc_id).cast("string")), F.lit("")))
