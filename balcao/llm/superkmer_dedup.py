"""Removal of word windows that occur more than once, counted in super-k-mer buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import repeats
from balcao.llm.frames import joined_words, pieces

WINDOW = 35


def _read(data: np.ndarray, bounds: np.ndarray):
    text, begin, end, first = joined_words(data, bounds)
    if not len(begin):
        empty = np.zeros(0, np.uint64)
        return empty, np.zeros(1, np.uint64), first, lambda at, to: []
    word = repeats.span_hash(repeats.running(np.frombuffer(text, np.uint8)), begin, end)
    pairs = repeats.mixed(word + np.append(word[1:], np.uint64(0)) * np.uint64(0x9E3779B97F4A7C15))
    return pairs, repeats.running(word), first, lambda at, to: [text[a:b] for a, b in zip(begin[at].tolist(), end[to - 1].tolist())]


def kind(window: int) -> repeats.Kind:
    """Minimisers are pairs of words, so a window has two words at least."""
    if window < 2:
        raise ValueError("a window has two words or more")
    return repeats.Kind(window, max(1, window * 7 // 10), (max(1, window // 8), 1), 2, 1 << 18, _read)


def _judge(bucket: np.ndarray, packed: list[bytes], far: np.ndarray, count: np.ndarray, rank: np.ndarray):
    """Sorts the windows of the buckets and counts equal ones: neighbours that agree in every word."""
    numbers: dict[bytes, int] = {}
    symbols, starts = [], []
    for string, n in zip(packed, count):
        at = len(symbols)
        symbols += [numbers.setdefault(w, len(numbers) + 1) for w in string.split()]
        starts.append(np.arange(at, at + n))
    window = (len(symbols) - int(count.sum())) // len(packed) + 1  # every string has `count + window - 1` words
    starts, owner = np.concatenate(starts), np.repeat(np.arange(len(packed)), count)
    rows = np.empty((len(starts), window + 1), dtype=">u4")
    rows[:, 0] = bucket[owner] + 1
    rows[:, 1:] = np.lib.stride_tricks.sliding_window_view(np.array(symbols, dtype=">u4"), window)[starts]
    order = np.argsort(rows.view(f"S{4 * (window + 1)}").ravel(), kind="stable")
    new = np.append(True, (rows[order[1:]] != rows[order[:-1]]).any(axis=1))
    group = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(order)))
    least = np.minimum.reduceat(rank[owner[order]], head)
    other, earlier = np.empty(len(order), bool), np.empty(len(order), bool)
    other[order] = size[group] > 1
    earlier[order] = rank[owner[order]] > least[group]
    return other, earlier


def removed(
    docs: DataFrame, window: int = WINDOW, keep: str = "none", outputs: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, spans, and the kept words (or `outputs` made of `kept`).

    A word is removed when a window that covers it has its word sequence elsewhere too, in another text or the same
    one. With keep="first" the first place of each window keeps it: by document id, then position. Windows are judged
    on the input. `spans` are the word ranges removed, begin and end one after the other.

    Null and empty texts have no words and lose none, nor do texts shorter than a window, however often they occur.
    Of equal texts all have the same result, but with keep="first" the one of the least id; rows that repeat it with
    its id have its result. Other columns are not read.
    """
    kept_first = {"none": False, "first": True}[keep]
    outputs = outputs or {"kept": F.col("kept")}
    texts = repeats.distinct_texts(docs)
    spanned = repeats.repeated(texts, kind(window), _judge, kept_first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t1", "t2", "id", "n_words", "n_removed", "spans", "kept"]
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        for batch, data, bounds in pieces(batches):
            raw, rows = data.tobytes(), []
            for i, (copies, spans) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5))):
                own = raw[bounds[i] : bounds[i + 1]].split()
                whole = len(own) >= window and copies > 1
                gone = repeats.covered(np.array(spans.as_py() or [], dtype=np.int64), len(own))
                if whole and not kept_first:
                    gone[:] = True
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).tolist()
                if edge:
                    own = [w for w, x in zip(own, gone.tolist()) if not x]
                rows.append((len(gone), int(gone.sum()), edge, b" ".join(own)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *columns], names=names)

    judged = spanned.select("t1", "t2", "text", "id", "copies", "spans").mapInArrow(
        run, "t1 long, t2 long, id long, n_words long, n_removed long, spans array<long>, kept binary"
    )
    return repeats.attached(docs, judged, outputs, window, kept_first, "n_words")
