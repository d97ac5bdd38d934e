"""Quality rules on counts and on the repetition that a suffix array shows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.frames import SPACES, pieces, words

SYMBOLS = b"#*$%&|<>"

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat", "n_bytes", "n_covered_bytes",
)
_SCHEMA = ", ".join(f"{name} long" for name in _COUNTS)


@dataclass(frozen=True)
class Limits:
    """Base limits, and the limits on maximal repeats within one text: of `repeat` words or more, and of bytes.

    Chance makes longer repeats in longer texts, by the logarithm of the length. Byte repeats count from
    `repeat_bytes` bytes in texts up to `repeat_bytes_to`, and from two bytes more for each doubling beyond.
    """

    least_words: int = 10
    base_window: int = 5
    base_percent: int = 20
    repeat: int = 13
    covered_percent: int = 10
    covered_words: int = 26  # one sequence of `repeat` words said twice
    longest_percent: int = 5
    longest_words: int = 40
    repeat_bytes: int = 10
    repeat_bytes_to: int = 4096
    covered_bytes_percent: int = 20
    covered_bytes: int = 256


#: Bytes that one number of `_byte_numbers` shows; the number of its text stands above them.
_WIDTH = 5


def suffix_order(symbols: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and, for each neighbouring pair in it, the length of the common prefix.

    Prefix doubling; only suffixes that share their prefix so far with another are sorted again. The ranks of every
    round are kept, and common prefixes are read off them from the longest step down. Two suffixes may not share a
    prefix up to the end of `symbols`: the last symbol of each text must be unique. With a `width`, each number shows
    that many bytes from its place on, and the first round sorts by all of them.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks = []
    waiting, key = order, symbols[order]
    base, rank = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    step = width
    while True:
        # `waiting` holds whole groups of equal rank, in order; `base` is the rank of each group's first member.
        new = np.ones(len(waiting), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        at = np.arange(len(waiting))
        first = np.maximum.accumulate(np.where(new, at, 0))
        if ranks:
            group = np.ones(len(waiting), dtype=bool)
            group[1:] = base[1:] != base[:-1]
            first = first - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[waiting] = base + first
        ranks.append(rank)
        alone = new & np.append(new[1:], True)
        waiting = waiting[~alone]
        if not len(waiting):
            break
        key = rank[waiting] * (n + 1) + rank[np.minimum(waiting + step, n - 1)] + 1
        by = np.argsort(key, kind="stable")
        waiting, key = waiting[by], key[by]
        base = rank[waiting]
        step *= 2
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    common = np.zeros(max(n - 1, 0), dtype=np.int64)
    left, right = suffixes[:-1], suffixes[1:]
    for k in range(len(ranks) - 1, -1, -1):
        a, b = np.minimum(left + common, n - 1), np.minimum(right + common, n - 1)
        common += width * ((ranks[k][a] == ranks[k][b]).astype(np.int64) << k)
    if width > 1:
        differ = symbols[np.minimum(left + common, n - 1)] ^ symbols[np.minimum(right + common, n - 1)]
        for equal in range(1, width):
            common += differ < 1 << 8 * (width - equal)
    return suffixes, common


def repeats(symbols: np.ndarray, width: int = 1) -> np.ndarray:
    """For each position the length of the longest string from there that also begins elsewhere.

    It is the value of the innermost common-prefix interval around the suffix, the larger of the two values beside it.
    """
    suffixes, common = suffix_order(symbols, width)
    out = np.empty(len(symbols), dtype=np.int64)
    edge = np.concatenate(([0], common, [0]))
    out[suffixes] = np.maximum(edge[:-1], edge[1:])
    return out


def covered(longest: np.ndarray, least: int | np.ndarray) -> np.ndarray:
    """Positions in the union of the spans of all maximal repeats of at least `least` symbols, given for all or each."""
    at = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.cumsum(change[:-1]) > 0


def _word_numbers(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A number for each distinct word of each text, and one behind each text; no two texts share a number."""
    raw, numbers, base = data.tobytes(), [], 0
    for at, to in zip(bounds[:-1], bounds[1:]):
        seen: dict[bytes, int] = {}
        numbers += [base + seen.setdefault(w, len(seen)) for w in raw[at:to].split()]
        base += len(seen) + 1
        numbers.append(base - 1)
    return np.array(numbers, dtype=np.int64)


def _byte_numbers(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte, and for an end behind each text, the number of the text and the next _WIDTH bytes.

    The end is a byte that UTF-8 does not use, so a number that shows it is found once in its text.
    """
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) + 1)
    ends = np.zeros(len(text) + _WIDTH, dtype=bool)
    ends[bounds[1:] + np.arange(len(bounds) - 1)] = True
    shown = np.full(len(ends), 255, dtype=np.int64)
    shown[: len(text)][~ends[: len(text)]] = data
    numbers = text.astype(np.int64)
    for i in range(_WIDTH):
        numbers = numbers << 8 | shown[i : len(text) + i]
    return numbers


def _least_bytes(size: np.ndarray, limits: Limits) -> np.ndarray:
    doublings = np.log2(np.maximum(size, 1) / limits.repeat_bytes_to)
    return limits.repeat_bytes + np.ceil(2 * np.maximum(doublings, 0)).astype(np.int64)


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


def measures(data: np.ndarray, bounds: np.ndarray, limits: Limits) -> list[np.ndarray]:
    """The counts of each text, in the order of _COUNTS."""
    _, _, first = words(data, bounds)
    n_words = np.diff(first)

    def total(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[edges])

    chars = total(~SPACES[data] & (data & 0xC0 != 0x80), bounds)
    table = np.zeros(256, dtype=bool)
    table[list(SYMBOLS)] = True
    symbols = total(table[data], bounds)
    raw = data.tobytes()
    lines = np.array([_repeated_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], dtype=np.int64)
    longest = repeats(_word_numbers(data, bounds))
    edges = first + np.arange(len(first))  # each text has one symbol more than words
    base = total(covered(longest, limits.base_window), edges)
    spans = total(covered(longest, limits.repeat), edges)
    size = np.diff(bounds)
    least = np.repeat(_least_bytes(size, limits), size + 1)
    own = total(covered(repeats(_byte_numbers(data, bounds), _WIDTH), least), bounds + np.arange(len(bounds)))
    return [n_words, chars, symbols, lines, base, spans, np.maximum.reduceat(longest, edges[:-1]), size, own]


def _measured(rows: DataFrame, limits: Limits) -> DataFrame:
    """`rows` of _row and _text with the counts in place of _text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in pieces(batches, "_text"):
            counts = [pa.array(c, pa.int64()) for c in measures(data, bounds, limits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts], names=["_row", *_COUNTS])

    base = (F.col("n_words") < limits.least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * limits.base_percent)
    repeated = (
        (F.col("n_covered_words") > limits.covered_words)
        & (F.col("n_covered_words") * 100 > F.col("n_words") * limits.covered_percent)
    ) | (
        (F.col("longest_repeat") > limits.longest_words) & (F.col("longest_repeat") * 100 > F.col("n_words") * limits.longest_percent)
    ) | (
        (F.col("n_covered_bytes") > limits.covered_bytes)
        & (F.col("n_covered_bytes") * 100 > F.col("n_bytes") * limits.covered_bytes_percent)
    )
    return (
        rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, {_SCHEMA}")
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & ~repeated)
    )


def assess(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, kept.

    Counts are taken over whole texts. n_repeat_words counts words in windows of `base_window` words that occur twice
    in the text; n_covered_words the words in the union of all maximal repeats of `repeat` words or more; and
    longest_repeat is the longest of them. n_covered_bytes counts bytes in the union of all maximal repeats of bytes, as
    long as Limits asks for a text of n_bytes. A text that passes the base rules is rejected when its repeats cover more
    than `covered_percent` of it and more than `covered_words` words, or when the longest is over `longest_words` and over
    `longest_percent` of it, or when byte repeats cover over `covered_bytes` bytes and over `covered_bytes_percent` of it.

    Null, empty and white-space texts have no words: all counts but n_symbols are 0 and the base rules fail. Repeated
    rows and null ids are judged row by row. A text is held by one task as a whole. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    return _measured(rows, limits).select(F.col("_row").alias("doc_id"), *_COUNTS, "base_failed", "kept")


def filtered(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The kept rows of `docs` with all their columns, whatever their names."""
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    return _measured(rows, limits).filter("kept").select("_row.*")
