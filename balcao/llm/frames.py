"""What the operators share: the shared checkpoint folder and the bytes of Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from balcao.session import ensure_checkpoint_dir

# Words are separated by the six white-space characters of ASCII, as bytes.split() does.
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """Written once to the shared checkpoint folder; lost executors do not lose it."""
    ensure_checkpoint_dir(df.sparkSession, local_fallback=True)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls and the bounds of its values, without a copy."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 1 << 19) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about `size` bytes of text; one row at least. A row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
            at = to


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of each word, and the word index at which each text begins (one more at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~SPACES[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    # A text begins a word of its own even where the text before it ends with one.
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    begins[cuts] = inside[cuts + 1]
    ends[cuts - 1] = inside[cuts]
    begin = np.flatnonzero(begins)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, bounds)


def joined_words(data: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words with one blank behind each, where each begins and ends there, and the first word of each text."""
    begin, end, first = words(data, bounds)
    blank = SPACES[data]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    place = np.cumsum(keep) - 1
    text = np.where(blank, 32, data).astype(np.uint8)[keep].tobytes()
    return (text, place[begin], place[end - 1] + 1, first) if len(begin) else (b"", begin, end, first)


def stored(df: DataFrame) -> DataFrame:
    """Written as Parquet to a folder of its own below the shared checkpoint folder, and read again."""
    ensure_checkpoint_dir(df.sparkSession, local_fallback=True)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
