"""Strings of a fixed length that occur more than once, found in buckets of equal minimisers.

A window is `length` consecutive symbols (bytes or words) of one text. Its minimiser is the least gram, by hash, among
its first `lead` positions; equal windows have the same one at the same place. The key of a bucket is a hash of the
`length - lead + 1` symbols from the minimiser on, which every window of that minimiser holds. Consecutive windows with
the same minimiser travel as one packed string. Hashes only decide where strings meet; whether two windows are equal
is decided on the symbols, by the operator that calls this module.

Equal texts are one text here, named by half of their SHA-256. Only minimisers whose key occurs twice send strings.
Equal strings are counted before the shuffle. Where a key has more than CROWD different strings its windows are dealt
anew, in narrower classes of the distance between window and minimiser, by the symbols that all windows of the class
share; the narrowest class is a single window, and then all that meet are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import pieces

CROWD = 1024
#: Bytes of distinct strings a task remembers while it counts equal ones.
HELD = 32 << 20
LAST = (1 << 63) - 1

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` takes the hash of any span."""
    if len(_powers[0]) < len(values):
        size = max(len(values), 1 << 20)
        for i, base in enumerate((_B, _B_INVERSE)):
            full = np.full(size, base, dtype=np.uint64)
            full[0] = 1
            _powers[i] = np.cumprod(full, dtype=np.uint64)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers[0][: len(values)], dtype=np.uint64)))


def span_hash(sums: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    # A span has one symbol at least, so `at` is an index of the powers.
    return mixed((sums[to] - sums[at]) * _powers[1][at])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of `width` values from each position on; the values are completed by the largest number."""
    n = len(values)
    padded = np.full(-(-(n + width) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


@dataclass(frozen=True)
class Runs:
    """Consecutive windows with one minimiser: text, first window, windows, minimiser (in symbols of the slice)."""

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray


def runs(grams: np.ndarray, first: np.ndarray, length: int, lead: int) -> Runs:
    """`grams` are hashes per symbol; text i has the symbols first[i] to first[i + 1]."""
    n = len(grams)
    place = np.arange(n, dtype=np.uint64)
    # The leftmost of equal grams wins, which is the same in equal windows.
    least = sliding_least((grams >> np.uint64(32) << np.uint64(32)) | place, lead) & np.uint64(0xFFFFFFFF)
    change = np.zeros(n + 1, dtype=np.int64)
    long = np.flatnonzero(np.diff(first) >= length)
    np.add.at(change, first[long], 1)
    np.add.at(change, first[long + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    anchor = least[starts].astype(np.int64)
    head = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(starts) else np.zeros(0, np.int64)
    begin = starts[head]
    return Runs(np.searchsorted(first, begin, side="right") - 1, begin, np.diff(np.append(head, len(starts))), anchor[head])


#: From first symbols and symbols after the last to the packed strings.
Pack = Callable[[np.ndarray, np.ndarray], list[bytes]]


@dataclass(frozen=True)
class Kind:
    """What a symbol is. `read` gives grams, running sums, first symbols and a function that packs spans."""

    length: int
    lead: int
    classes: tuple[int, int]  # widths of the narrower classes
    crowds: int  # times `crowd`, strings of a key up to which the wider of them holds
    block: int  # windows that a task judges at one time
    read: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, Pack]]
    crowd: int = field(default_factory=lambda: CROWD)  # set where the query is built, so that tasks get it

    def widths(self, times: np.ndarray) -> np.ndarray:
        """Widths of the classes for minimisers whose keys have so many different strings."""
        return np.where(times <= self.crowd, self.lead, np.where(times <= self.crowd * self.crowds, *self.classes))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(t1, t2, text, copies, id): each text once, named by two halves of 64 bits, with its least id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return named(docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))).groupBy("t1", "t2").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("id")
    )


def named(rows: DataFrame) -> DataFrame:
    sha = F.sha2(F.col("text").cast("binary"), 256)
    # Never null, so that no join adds a filter below the shared shuffle of the texts.
    half = lambda at: F.coalesce(F.conv(F.substring(sha, at, 16), 16, -10).cast("long"), F.lit(0))
    return rows.withColumns({"t1": half(1), "t2": half(17)})


def _common_key(kind: Kind, sums: np.ndarray, found: Runs) -> np.ndarray:
    return span_hash(sums, found.anchor, found.anchor + kind.length - kind.lead + 1).view(np.int64)


def _hits(texts: DataFrame, kind: Kind) -> DataFrame:
    """(t1, t2, hits): the minimisers of each text whose key occurs twice, with the number of its different strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in pieces(batches):
            grams, sums, first, _ = kind.read(data, bounds)
            found = runs(grams, first, kind.length, kind.lead)
            t1, t2 = (batch.column(i).to_numpy()[found.text] for i in (0, 1))
            at = (found.anchor - first[found.text]).astype(np.int64)
            whole = span_hash(sums, found.start, found.start + found.count - 1 + kind.length)
            whole = (whole + mixed((found.anchor - found.start).astype(np.uint64))).view(np.int64)
            columns = [pa.array(x) for x in (_common_key(kind, sums, found), whole, t1, t2, at)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "whole", "t1", "t2", "at"])

    # All columns are read, so that every reader of the distinct texts shares one shuffle of them.
    rows = texts.mapInArrow(run, "key long, whole long, t1 long, t2 long, at long")
    kinds = rows.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("times"))
    often = kinds.groupBy("key").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n")).filter("times > 1")
    # The join is on another form of the key, so both sides are shuffled for it and a frequent key can be split.
    often = often.select(F.bitwise_not("key").alias("turned"), "n")
    hits = rows.withColumn("turned", F.bitwise_not("key")).join(often, "turned")
    return hits.groupBy("t1", "t2").agg(F.collect_list(F.struct("at", "n")).alias("hits"))


@dataclass(frozen=True)
class Parts:
    """Packed strings with their text, bucket, greatest and least distance to the minimiser, and its place."""

    text: np.ndarray
    key: np.ndarray
    far: np.ndarray
    low: np.ndarray
    at: np.ndarray
    strings: list[bytes]


def _classed(hits: pa.ListArray, kind: Kind, data: np.ndarray, bounds: np.ndarray) -> Parts:
    """The runs whose minimiser was hit, cut into narrower classes where its key has too many strings."""
    grams, sums, first, packed = kind.read(data, bounds)
    found = runs(grams, first, kind.length, kind.lead)
    ats = found.anchor - first[found.text]
    flat = hits.flatten()
    owner = np.repeat(np.arange(len(hits)), hits.value_lengths().to_numpy())
    code = owner << 40 | flat.field("at").to_numpy()
    by = np.argsort(code)
    code, times = code[by], flat.field("n").to_numpy()[by]
    own = found.text << 40 | ats
    place = np.minimum(np.searchsorted(code, own), len(code) - 1)
    hit = np.flatnonzero(code[place] == own)
    text, anchor, at, times = found.text[hit], found.anchor[hit], ats[hit], times[place[hit]]
    common = _common_key(kind, sums, found)[hit]
    far = anchor - found.start[hit]
    near = far - found.count[hit] + 1
    width = kind.widths(times)
    count = far // width - near // width + 1
    run = np.repeat(np.arange(len(hit)), count)
    which = (far // width)[run] - (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count))
    far, low = np.minimum(far[run], which * width[run] + width[run] - 1), np.maximum(near[run], which * width[run])
    text, anchor, at, key, width = text[run], anchor[run], at[run], common[run], width[run]
    cut = np.flatnonzero(width < kind.lead)
    if len(cut):
        # The symbols that all windows of a class share, whichever of them are here.
        begin = anchor[cut] - which[cut] * width[cut]
        shared = span_hash(sums, begin, begin - width[cut] + 1 + kind.length)
        key[cut] = mixed(key[cut].view(np.uint64) * np.uint64(31) + which[cut].astype(np.uint64) + shared).view(np.int64)
    return Parts(text, key, far, low, at, packed(anchor - far, anchor - low + kind.length))


def _strings(hit: DataFrame, kind: Kind, members: bool) -> DataFrame:
    """The packed strings of the minimisers that were hit.

    With `members`, where each string occurs: (digest, t1, t2, at). Else each string, once for a stretch of a task:
    (key, digest, far, count, packed, times, id, at), `far` being the distance from its first window to the minimiser
    and (id, at) its first place.
    """
    names = ["digest", "t1", "t2", "at"] if members else ["key", "digest", "far", "count", "packed", "times", "id", "at"]
    kinds = {"digest": pa.binary(), "packed": pa.binary()}
    ddl = ", ".join(f"{n} {'binary' if n in kinds else 'long'}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: dict[bytes, list] = {}
        size = 0

        def handed() -> pa.RecordBatch:
            nonlocal size
            rows = out if members else [tuple(x) for x in held.values()]
            columns = list(zip(*rows)) or [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names=names)
            out.clear()
            held.clear()
            size = 0
            return batch

        for batch, data, bounds in pieces(batches):
            part = _classed(batch.column("hits"), kind, data, bounds)
            t1, t2, ids = (batch.column(c).to_numpy()[part.text].tolist() for c in ("t1", "t2", "id"))
            head = np.column_stack([part.key, part.far, part.low]).tobytes()
            fields = zip(part.strings, t1, t2, ids, *(x.tolist() for x in (part.at, part.key, part.far, part.low)))
            for i, (string, a, b, own, at, key, far, low) in enumerate(fields):
                digest = hashlib.blake2b(head[24 * i : 24 * i + 24] + string, digest_size=16).digest()
                if members:
                    out.append((digest, a, b, at))
                elif digest in held:
                    known = held[digest]
                    known[5] += 1
                    known[6:] = min(known[6:], [own, at])
                else:
                    held[digest] = [key, digest, far, far - low + 1, string, 1, own, at]
                    size += len(string) + 200
                if size > HELD or len(out) > 50_000:
                    yield handed()
        yield handed()

    return hit.withColumn("id", F.coalesce("id", F.lit(LAST))).mapInArrow(run, ddl)


#: From rows of one bucket after another to a flag for every window of every string: occurs elsewhere; occurs earlier.
Judge = Callable[[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _verdicts(strings: DataFrame, kind: Kind, judge: Judge, first_stays: bool) -> DataFrame:
    """(digest, id, at, spans, all_spans): the spans of repeated windows around the minimiser of each string.

    `spans` holds for the string's first place (id, at), `all_spans` for its other places.
    """

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        # Equal strings of several tasks, which the sort has put side by side.
        merged: list[list] = []
        for row in rows:
            if merged and merged[-1][1] == row[1]:
                merged[-1][5] += row[5]
                merged[-1][6:] = min(merged[-1][6:], list(row[6:]))
            else:
                merged.append(list(row))
        key, digest, far, count, packed, times, ids, at = (list(c) for c in zip(*merged))
        place = np.lexsort((np.array(at), np.array(ids)))
        rank = np.empty(len(place), dtype=np.int64)
        rank[place] = np.arange(len(place))
        bucket = np.unique(np.array(key), return_inverse=True)[1]
        far, count, times = np.array(far), np.array(count), np.array(times)
        other, earlier = judge(bucket, packed, far, count, rank)
        owner = np.repeat(np.arange(len(merged)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) - far[owner]
        many = times[owner] > 1
        spans = _spans(owner, offset, earlier if first_stays else other | many, len(merged), kind.length)
        rest = _spans(owner, offset, np.ones(len(owner), bool), len(merged), kind.length) if first_stays else spans
        keep = [i for i in range(len(merged)) if spans[i] or (first_stays and times[i] > 1)]
        span = pa.list_(pa.int64())
        typed = ((digest, pa.binary()), (ids, pa.int64()), (at, pa.int64()), (spans, span), (rest, span))
        columns = [pa.array([x[i] for i in keep], t) for x, t in typed]
        return pa.RecordBatch.from_arrays(columns, names=["digest", "id", "at", "spans", "all_spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns))
            if sum(r[3] for r in rows) > kind.block:
                cut = next((i for i in range(len(rows) - 1, 0, -1) if rows[i][0] != rows[i - 1][0]), 0)
                if cut:
                    yield judged(rows[:cut])
                    rows = rows[cut:]
        if rows:
            yield judged(rows)

    return (
        strings.repartition("key")
        .sortWithinPartitions("key", "digest")
        .mapInArrow(run, "digest binary, id long, at long, spans array<long>, all_spans array<long>")
    )


def _spans(owner: np.ndarray, offset: np.ndarray, flag: np.ndarray, n: int, length: int) -> list[list[int]]:
    """For each string the spans of its flagged windows, from the minimiser: begin and end, one after the other."""
    out: list[list[int]] = [[] for _ in range(n)]
    at = np.flatnonzero(flag)
    if len(at):
        head = np.append(True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]]))
        stop = np.append(np.flatnonzero(head)[1:], len(at)) - 1
        for i, a, b in zip(owner[at[head]].tolist(), offset[at[head]].tolist(), offset[at[stop]].tolist()):
            out[i] += (a, b + length)
    return out


def repeated(texts: DataFrame, kind: Kind, judge: Judge, first_stays: bool) -> DataFrame:
    """`texts` with `spans`: begins and ends, in symbols, of the repeated windows of each; null where there are none."""
    hit = texts.join(_hits(texts, kind), ["t1", "t2"])
    verdicts = _verdicts(_strings(hit, kind, members=False), kind, judge, first_stays)
    members = _strings(hit, kind, members=True)
    if first_stays:
        ids = texts.select("t1", "t2", F.coalesce("id", F.lit(LAST)).alias("own"))
        members = members.join(ids, ["t1", "t2"])
    v = verdicts.withColumnRenamed("at", "first_at")
    met = members.join(v, "digest")
    spans = F.col("spans")
    if first_stays:
        first = (F.col("own") == F.col("id")) & (F.col("at") == F.col("first_at"))
        spans = F.when(first, spans).otherwise(F.col("all_spans"))
    placed = met.select("t1", "t2", F.transform(spans, lambda x: x + F.col("at")).alias("spans"))
    gathered = placed.groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return texts.join(gathered, ["t1", "t2"], "left")


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Flags of the symbols within the spans (begin, end, begin, end, ...)."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, spans[0::2], 1)
    np.add.at(change, spans[1::2], -1)
    return np.cumsum(change[:-1]) > 0


def attached(docs: DataFrame, judged: DataFrame, outputs: dict[str, Column], window: int, kept_first: bool, total: str) -> DataFrame:
    """Each row of `docs` with the result of its text; with `kept_first` later copies lose all of theirs.

    `outputs` are made of the column `kept` before the copies of a text take them over.
    """
    results = judged.select("t1", "t2", "id", total, "n_removed", "spans", *(c.alias(n) for n, c in outputs.items()))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = named(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))).select("doc_id", "t1", "t2")
    out = rows.join(results, ["t1", "t2"])
    if not kept_first:
        return out.select("doc_id", total, "n_removed", "spans", *outputs)
    later = ~F.col("doc_id").eqNullSafe(F.col("id")) & (F.col(total) >= window)
    nothing = judged.sparkSession.range(1).select(F.lit(b"").alias("kept")).select(*outputs.values()).first()
    return out.select(
        "doc_id",
        total,
        F.when(later, F.col(total)).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(later, F.array(F.lit(0).cast("long"), F.col(total))).otherwise(F.col("spans")).alias("spans"),
        *(F.when(later, F.lit(v)).otherwise(F.col(n)).alias(n) for n, v in zip(outputs, nothing)),
    )
