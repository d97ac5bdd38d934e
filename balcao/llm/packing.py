"""Packing of token sequences by minimum bin slack."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 2048
END = 1
#: Remainders that a task holds while it chooses among them.
WINDOW = 4096
#: Sequences are numbered within a task; the task's number stands above these bits.
SEQUENCE_BITS = 40

# Between a letter and a space before a letter the tokenizer always cuts, so long texts may be encoded in parts there.
_CUT = re.compile("(?<=[A-Za-z])(?= [A-Za-z])")
_PART = 1 << 18
# Unbroken words beyond this go to the slower library, whose time stays in proportion to their length.
_LONG_WORD = re.compile(r"\S{2000}|\s{2000}")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Function from a text to its ids, for a byte-level vocabulary file.

    The vocabulary of the file is run by the faster of two libraries; a test holds both to the same ids. The strings of
    the file's special tokens have the ids of these tokens, as the plain call of the slower library gives them.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    added = [token.content for token in slow.get_added_tokens_decoder().values()]
    # The files write bytes as characters: printable ones as themselves, the others in order from 256 on.
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - plain))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in slow.get_vocab(with_added_tokens=False).items()}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        ids: list[int] = []
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + _PART) if len(text) - at > _PART else None
            part = text[at : cut.start()] if cut else text[at:]
            at += len(part)
            other = _LONG_WORD.search(part) or any(token in part for token in added)
            ids += slow.encode(part, add_special_tokens=False).ids if other else fast.encode_ordinary(part)
        return np.array(ids, dtype="<u4")

    return encode


class MinimumSlack:
    """The remainders of a window by length; `fill` takes out the multiset nearest to the capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, (1 << capacity + 1) - 1
        self.held: dict[int, list] = {}
        self.size = 0

    def add(self, length: int, item) -> None:
        self.held.setdefault(length, []).append(item)
        self.size += 1

    def fill(self) -> list[tuple[int, object]]:
        """The longest remainder and the others that leave the least slack beside it.

        Bit s of `reach` is set when the lengths seen so far can sum to s. Lengths enter one by one, with their
        count cut into powers of two; the search ends when the capacity itself is reached. Going back through the
        states gives how many of each length were used.
        """
        lengths = sorted(self.held, reverse=True)
        room = self.capacity - lengths[0]
        taken = {lengths[0]: 1}
        mask = self.mask >> lengths[0]
        reach, states = 1, []
        for length in lengths:
            if length > room:
                continue
            left = min(len(self.held[length]) - taken.get(length, 0), room // length)
            if left <= 0:
                continue
            states.append((length, reach))
            step = 1
            while left:
                step = min(step, left)
                reach |= reach << step * length & mask
                left -= step
                step *= 2
            if reach >> room & 1:
                break
        total = reach.bit_length() - 1
        for length, before in reversed(states):
            while not before >> total & 1:
                total -= length
                taken[length] = taken.get(length, 0) + 1
        out = []
        for length, count in taken.items():
            items = self.held[length]
            out += [(length, items.pop()) for _ in range(count)]
            if not items:
                del self.held[length]
        self.size -= len(out)
        return out


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, window: int = WINDOW, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds ids.

    A document is the ids of its text and then `end`. Whole sequences are cut off its front; the remainder stays in
    one piece. A task packs the remainders of its own partition, `window` of them at a time, and what a window leaves
    goes on to the next, so nothing is shuffled and each partition ends with at most a few sequences that are not full.

    Null and empty texts are documents of one id. A special token's string in a text is that token. Repeated rows are packed once each; a null id is handed on. Very
    long texts are encoded in parts. Other columns are not read. An empty table gives no rows.
    """
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = pa.schema([*((n, pa.int64()) for n in names), *[("ids", pa.list_(pa.int32()))] * with_ids])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        waiting = MinimumSlack(capacity)
        out: list[tuple] = []

        def sequence(members) -> None:
            nonlocal number
            offset = 0
            for length, (doc, start, crc, tokens, *ids) in members:
                out.append((doc, start, length, crc, tokens, number, offset, *ids))
                offset += length
            number += 1

        def handed() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(schema)
            batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.array([end], dtype="<u4"))
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    item = (doc.as_py(), start, zlib.crc32(part.tobytes()), len(ids), *([part.astype("i4")] * with_ids))
                    if len(part) == capacity:
                        sequence([(capacity, item)])
                    else:
                        waiting.add(len(part), item)
                while waiting.size >= window:
                    while waiting.size > window // 2:
                        sequence(waiting.fill())
                if len(out) >= 4096:
                    yield handed()
        while waiting.size:
            sequence(waiting.fill())
        yield handed()

    ddl = ", ".join(f"{n} long" for n in names) + ", ids array<int>" * with_ids
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, ddl)
