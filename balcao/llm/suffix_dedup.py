"""Removal of byte strings that occur more than once, by longest previous and next factors in suffix order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm import repeats
from balcao.llm.frames import pieces

WINDOW = 400
GRAM = 8


def _read(data: np.ndarray, bounds: np.ndarray):
    n = len(data)
    padded = np.concatenate((data, np.zeros(GRAM, np.uint8)))
    grams = repeats.mixed(np.ndarray((n,), "<u8", padded, strides=(1,)).astype(np.uint64))
    raw = data.tobytes()
    return grams, repeats.running(data), bounds, lambda at, to: [raw[a:b] for a, b in zip(at.tolist(), to.tolist())]


def kind(window: int) -> repeats.Kind:
    """Minimisers are grams of GRAM bytes, so a window has as many at least."""
    if window < GRAM:
        raise ValueError(f"a window has {GRAM} bytes or more")
    lead = max(1, min(window * 3 // 4, window - GRAM + 1))
    return repeats.Kind(window, lead, (max(1, window // 6), 1), 2, 1 << 20, _read)


def _common(contexts: list[bytes], order: list[int], bucket: list[int]) -> np.ndarray:
    """Length of the common prefix of each context with the one before it in order; -1 where a bucket begins."""
    out = np.full(len(order), -1, dtype=np.int64)
    for place in range(1, len(order)):
        i, j = order[place - 1], order[place]
        if bucket[i] == bucket[j]:
            a, b = contexts[i], contexts[j]
            n = min(len(a), len(b))
            if a[:n] != b[:n]:
                # The first difference lies where the leading equal bytes of the exclusive-or end.
                n -= (int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7 >> 3
            out[place] = n
    return out


class _Least:
    """Least of any stretch of an array."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            step = 1 << len(self.rows) - 1
            self.rows.append(np.minimum(self.rows[-1][:-step], self.rows[-1][step:]))

    def of(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Over [at, to), which holds one value at least."""
        out = np.empty(len(at), dtype=np.int64)
        level = np.frexp((to - at).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.rows[k][at[own]], self.rows[k][to[own] - (1 << int(k))])
        return out

    def before(self, limit: np.ndarray) -> np.ndarray:
        """For each place the nearest one before it whose value is below `limit`; -1 where there is none."""
        to = np.arange(len(self.rows[0]), dtype=np.int64)
        for k in range(len(self.rows) - 1, -1, -1):
            at = to - (1 << k)
            step = at >= 0
            step[step] = self.rows[k][at[step]] >= limit[step]
            to = np.where(step, at, to)
        return to - 1


def _factors(rank: np.ndarray, group: np.ndarray, common: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Longest previous factors of places in suffix order: the longest prefix shared with a place of smaller rank.

    The previous and the next place of smaller rank in suffix order share the most, as common prefixes only shrink with
    distance. `common` gives the length that two places, left and right, share. -1 where a group has no smaller rank.
    """
    n = len(rank)
    left = _Least(rank).before(rank)
    right = n - 1 - _Least(rank[::-1]).before(rank[::-1])[::-1]
    out = np.full(n, -1, dtype=np.int64)
    here = np.arange(n)
    for at, to in ((left, here), (here, right)):
        pair = np.flatnonzero((at >= 0) & (to < n))
        pair = pair[group[at[pair]] == group[to[pair]]]
        out[pair] = np.maximum(out[pair], common(at[pair], to[pair]))
    return out


def _judge(window: int):
    def judge(bucket: np.ndarray, packed: list[bytes], far: np.ndarray, count: np.ndarray, rank: np.ndarray):
        """Longest previous and next factors of the windows of the buckets, and what follows from them.

        The strings of a bucket agree around their minimiser, so windows can only be equal at the same distance from
        it. For each distance the windows are put in suffix order: those that share the bytes before the minimiser are
        a stretch of the order of left contexts, and within it the order of right contexts holds; common prefixes are
        the least value between two places of it. The longest previous factor of a window is what it shares with the
        nearest places of smaller rank, before and behind it in suffix order; with ranks turned round, the longest next
        factor. A window whose previous factor has its whole length occurs earlier; it occurs elsewhere if either has.
        """
        n = len(packed)
        keys = bucket.tolist()
        right = [s[f:] for s, f in zip(packed, far.tolist())]
        left = [s[:f][::-1] for s, f in zip(packed, far.tolist())]
        by_right = sorted(range(n), key=lambda i: (keys[i], right[i]))
        by_left = sorted(range(n), key=lambda i: (keys[i], left[i]))
        common = _Least(_common(right, by_right, keys))
        shared = _common(left, by_left, keys)
        place = np.empty(n, dtype=np.int64)
        place[by_right] = np.arange(n)
        lefts = np.array(by_left)
        near, base = far - count + 1, np.cumsum(count) - count
        other, earlier = np.zeros(int(count.sum()), bool), np.zeros(int(count.sum()), bool)
        for distance in range(int(near.min()), int(far.max()) + 1):
            group = np.cumsum(shared < distance)
            here = np.flatnonzero((near[lefts] <= distance) & (far[lefts] >= distance))
            if len(here) < 2:
                continue
            own, group = lefts[here], group[here]
            order = np.argsort(group * n + place[own], kind="stable")
            own, group = own[order], group[order]
            same = group[1:] == group[:-1]
            if not same.any():
                continue
            # Only groups of two or more are searched.
            some = np.append(same, False) | np.append(False, same)
            own, group = own[some], group[some]
            at = place[own]
            shared_by = lambda i, j: common.of(at[i] + 1, at[j] + 1)  # noqa: B023, E731
            previous = _factors(rank[own], group, shared_by) >= window - distance
            following = _factors(-rank[own], group, shared_by) >= window - distance
            flat = base[own] + far[own] - distance
            other[flat] = previous | following
            earlier[flat] = previous
        return other, earlier

    return judge


def removed(docs: DataFrame, window: int = WINDOW, keep: str = "first", outputs: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, spans, and the kept bytes (or `outputs` made of `kept`).

    A byte is removed when a string of `window` bytes that covers it begins elsewhere too, in another text or the same
    one; strings may overlap. With keep="first" the first place of each string keeps it: by document id, then
    position; with keep="none" every place loses it. Strings are judged on the input. `spans` are the byte ranges
    removed, begin and end one after the other; a character may be cut.

    Null and empty texts have no bytes and lose none, nor do texts shorter than a window, however often they occur.
    Of equal texts all have the same result, but with keep="first" the one of the least id; rows that repeat it with
    its id have its result. Other columns are not read.
    """
    kept_first = {"none": False, "first": True}[keep]
    outputs = outputs or {"kept": F.col("kept")}
    texts = repeats.distinct_texts(docs)
    spanned = repeats.repeated(texts, kind(window), _judge(window), kept_first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t1", "t2", "id", "n_bytes", "n_removed", "spans", "kept"]
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        for batch, data, bounds in pieces(batches):
            rows = []
            for i, (copies, spans) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5))):
                own = data[bounds[i] : bounds[i + 1]]
                gone = repeats.covered(np.array(spans.as_py() or [], dtype=np.int64), len(own))
                if len(own) >= window and copies > 1 and not kept_first:
                    gone[:] = True
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).tolist()
                rows.append((len(own), int(gone.sum()), edge, own[~gone].tobytes()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), *columns], names=names)

    judged = spanned.select("t1", "t2", "text", "id", "copies", "spans").mapInArrow(
        run, "t1 long, t2 long, id long, n_bytes long, n_removed long, spans array<long>, kept binary"
    )
    return repeats.attached(docs, judged, outputs, window, kept_first, "n_bytes")
