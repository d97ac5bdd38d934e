"""How far the sources of a language differ in their terms: an exact recount through minimal perfect hashes."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.frames import checkpointed, stored

SCALE = 1_000_000_000
#: Terms of a shard, at most; fewer where a language has many sources, so that sources times terms stay bounded.
SHARD = 4096
CELLS = 1 << 22
#: Bytes of perfect hashes that are broadcast at a time; a larger vocabulary takes one pass over the documents for each.
BROADCAST_BYTES = 64 << 20
#: Bytes of text whose different terms a task remembers at most before it hands their counts on or looks them up.
HELD = 32 << 20
#: Bytes of dense slots in a task, above which it hands them on.
SLOT_BYTES = 64 << 20

#: Letters of ASCII in lower case and all bytes beyond ASCII; every other byte parts two terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))


def frequent(rows: DataFrame, least: int) -> DataFrame:
    """(lang, term): terms that occur in `least` rows of the language or more. Exact; counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, Counter] = defaultdict(Counter)
        size = 0

        def handed() -> pa.RecordBatch:
            out = [(lang, term, n) for lang, terms in held.items() for term, n in terms.items()]
            held.clear()
            types = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 3, types)], names=["lang", "term", "n"])

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[lang].update(set(_terms(text)))
                size += len(text)
                if size > HELD:
                    yield handed()
                    size = 0
        yield handed()

    counted = rows.select("text", "lang").mapInArrow(run, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _digests(terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits a term: one deals it to a shard and a bucket, the other finds its slot."""
    pairs = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t) for t in terms), ">u8").reshape(-1, 2).astype(np.uint64)
    return pairs[:, 0], pairs[:, 1]


@dataclass(frozen=True)
class Perfect:
    """A minimal perfect hash of some terms: a displacement for each bucket, and the terms themselves by slot."""

    shift: np.ndarray
    bounds: np.ndarray
    keys: bytes

    @staticmethod
    def build(terms: list[bytes]) -> Perfect:
        """Buckets, largest first, each take the least displacement that sends its terms to free slots."""
        n = len(terms)
        first, second = _digests(terms)
        if len(np.unique(np.column_stack([first, second]), axis=0)) < n:
            raise ValueError("two terms of a shard have one digest of 128 bits")
        bucket = Perfect._bucket(first, n)
        shift = np.zeros(n, dtype=np.int64)
        slot = np.empty(n, dtype=np.int64)
        free = np.ones(n, dtype=bool)
        by = np.argsort(bucket, kind="stable")
        head = np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))
        groups = np.split(by, head[1:])
        groups.sort(key=len, reverse=True)
        single = next((i for i, g in enumerate(groups) if len(g) == 1), len(groups))
        for group in groups[:single]:
            step = 1
            while True:
                at = Perfect._slot(second[group], np.full(len(group), step), n)
                if free[at].all() and len(np.unique(at)) == len(at):
                    break
                step += 1
            free[at] = False
            slot[group], shift[bucket[group[0]]] = at, step
        # A term alone in its bucket takes a free slot as such: below zero the displacement names it.
        for group, at in zip(groups[single:], np.flatnonzero(free).tolist()):
            slot[group], shift[bucket[group[0]]] = at, -1 - at
        stored_at = np.argsort(slot)
        keys = [terms[i] for i in stored_at]
        return Perfect(shift, np.cumsum([0, *map(len, keys)]), b"".join(keys))

    @staticmethod
    def _bucket(first: np.ndarray, n: int) -> np.ndarray:
        return (_mixed(first) % np.uint64(n)).astype(np.int64)

    @staticmethod
    def _slot(second: np.ndarray, step: np.ndarray, n: int) -> np.ndarray:
        return (_mixed(second + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)

    def find(self, terms: list[bytes], first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each term; -1 for one that is not the key stored there."""
        n = len(self.shift)
        step = self.shift[self._bucket(first, n)]
        at = np.where(step < 0, -1 - step, self._slot(second, np.maximum(step, 0), n))
        begin, end, keys = self.bounds[at].tolist(), self.bounds[at + 1].tolist(), self.keys
        same = [keys[a:b] == t for a, b, t in zip(begin, end, terms)]
        return np.where(same, at, -1)

    def terms(self) -> list[bytes]:
        bounds = self.bounds.tolist()
        return [self.keys[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.shift.astype(np.int32).tobytes(), self.bounds.astype(np.int32).tobytes(), self.keys

    @staticmethod
    def unpacked(shift: bytes, bounds: bytes, keys: bytes) -> Perfect:
        return Perfect(np.frombuffer(shift, np.int32).astype(np.int64), np.frombuffer(bounds, np.int32).astype(np.int64), keys)


def _shard_of(first: np.ndarray, shards: int) -> np.ndarray:
    # Other bits than those that choose a bucket.
    return ((first >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def perfect_hashes(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, shard, n, shift, bounds, keys): the terms of each language, dealt by hash into shards, hashed perfectly.

    `sizes` has lang, shards. A shard is built by one task from the terms that meet there.
    """
    ddl = "lang string, shard long, n long, shift binary, bounds binary, keys binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                first, _ = _digests(batch.column(1).to_pylist())
                shard = (first >> np.uint64(20)) % batch.column(2).to_numpy().astype(np.uint64)
                columns = [batch.column(0), batch.column(1), pa.array(shard.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "shard"])

    def build(table: pa.Table) -> pa.Table:
        terms = sorted(table.column("term").to_pylist())
        row = (table.column("lang")[0].as_py(), table.column("shard")[0].as_py(), len(terms), *Perfect.build(terms).packed())
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[f.split()[0] for f in ddl.split(", ")])

    dealt = kept.join(sizes, "lang").select("lang", "term", "shards").mapInArrow(deal, "lang string, term binary, shard long")
    return dealt.groupBy("lang", "shard").applyInArrow(build, ddl)


def _narrow(counts: np.ndarray) -> tuple[int, bytes]:
    """Counts of 0 or more in the narrowest type."""
    width = next((w for w in (1, 2, 4) if counts.max(initial=0) < 1 << 8 * w), 8)
    return width, counts.astype(f"u{width}").tobytes()


def _wide(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{width}").astype(np.int64)


_COUNTED = "lang string, source string, shard long, salt long, n long, at binary, width int, counts binary"


def _packed(key: tuple, slots: np.ndarray) -> tuple:
    """The slots of a shard as they are, or only those above zero where that is shorter."""
    used = np.flatnonzero(slots)
    sparse = len(used) * 4 < len(slots)
    width, data = _narrow(slots[used] if sparse else slots)
    return (*key, len(slots), used.astype(np.int32).tobytes() if sparse else None, width, data)


def _add(slots: np.ndarray, at: bytes | None, width: int, data: bytes) -> None:
    if at is None:
        slots += _wide(width, data)
    else:
        slots[np.frombuffer(at, np.int32)] += _wide(width, data)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _COUNTED.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 8, types)], names=names)


def recount(rows: DataFrame, hashes: dict[str, tuple[int, dict[int, Perfect]]], salts: int) -> DataFrame:
    """(lang, source, shard, salt, n, at, width, counts): occurrences by slot, several rows for one group and shard.

    `hashes` has for each language the number of its shards and those that this pass looks up. A task keeps dense
    slots for the groups and shards it has met, and hands them on when they take SLOT_BYTES.
    """
    shared = rows.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % salts
        waiting: defaultdict[tuple[str, str], Counter] = defaultdict(Counter)
        slots: dict[tuple[str, str, int], np.ndarray] = {}
        pending = 0

        def looked_up() -> None:
            for (lang, source), counter in waiting.items():
                shards, own = shared.value[lang]
                terms = list(counter)
                counts = np.fromiter(counter.values(), np.int64, len(terms))
                first, second = _digests(terms)
                shard = _shard_of(first, shards)
                by = np.argsort(shard, kind="stable")
                head = np.flatnonzero(np.append(True, shard[by][1:] != shard[by][:-1])) if len(by) else []
                for part in np.split(by, head[1:]) if len(by) else []:
                    s = int(shard[part[0]])
                    if s not in own:
                        continue
                    at = own[s].find([terms[i] for i in part], first[part], second[part])
                    found = at >= 0
                    if found.any():
                        if (lang, source, s) not in slots:
                            slots[lang, source, s] = np.zeros(len(own[s].shift), dtype=np.int64)
                        slots[lang, source, s][at[found]] += counts[part][found]  # a term is once in a counter
            waiting.clear()

        def handed() -> Iterator[pa.RecordBatch]:
            items = list(slots.items())
            slots.clear()
            for at in range(0, len(items), 500):
                yield _batch([_packed((*key, salt), x) for key, x in items[at : at + 500]])

        for batch in batches:
            for text, lang, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if lang in shared.value:
                    waiting[lang, source].update(_terms(text))
                    pending += len(text)
                if pending > HELD or len(waiting) > 10_000:
                    looked_up()
                    pending = 0
                    if sum(x.nbytes for x in slots.values()) > SLOT_BYTES:
                        yield from handed()
        looked_up()
        yield from handed()

    return rows.mapInArrow(run, _COUNTED)


def _merged(parts: DataFrame, salts: int) -> DataFrame:
    """Equal (lang, source, shard, salt) added, row by row in sorted order, so that a task holds one set of slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, slots, out = None, None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != key:
                    if key is not None:
                        out.append(_packed(key, slots))
                    key, slots = row[:4], np.zeros(row[4], dtype=np.int64)
                _add(slots, *row[5:])
                if len(out) == 500:
                    yield _batch(out)
                    out = []
        if key is not None:
            out.append(_packed(key, slots))
        yield _batch(out)

    keys = ["lang", "source", "shard", "salt"]
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _COUNTED)


def _scaled(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact for counts of any size."""
    if int(counts.max(initial=0)) < (1 << 63) // SCALE - 1:
        return 1 + SCALE * (counts + 1) // total
    return np.array([1 + SCALE * (int(c) + 1) // total for c in counts.ravel()], dtype=np.int64).reshape(counts.shape)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); p and q are at most SCALE + 1, so all fits 64 bits."""
    gap = p - q
    return gap * gap // q


_SCORED = "lang string, source string, part string, item string, value long"


def _scored(top: int):
    """The sums over a shard's terms for every pair of sources, and each source's best terms in the shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hashed = right.to_pylist()[0]
        size, vocabulary, lang = hashed["n"], hashed["vocabulary"], hashed["lang"]
        names = hashed["sources"]
        place = {s: i for i, s in enumerate(names)}
        counts = np.zeros((len(names), size), dtype=np.int64)
        for row in left.to_pylist():
            _add(counts[place[row["source"]]], row["at"], row["width"], row["counts"])
        totals = hashed["totals"]
        p = np.vstack([_scaled(c, t + vocabulary) for c, t in zip(counts, totals)])
        q = _scaled(counts.sum(axis=0), sum(totals) + vocabulary)
        terms = Perfect.unpacked(hashed["shift"], hashed["bounds"], hashed["keys"]).terms()
        sources, part, items, values = [], [], [], []
        for i, name in enumerate(names):
            sums = _apart(p, p[i]).sum(axis=1)  # this source is the other one, q
            sums = [int(x) for x in sums]
            others = [j for j in range(len(names)) if j != i]
            sources += [names[j] for j in others]
            part += ["pair"] * len(others)
            items += [name.encode("utf-8", "surrogatepass")] * len(others)
            values += [sums[j] for j in others]
            own = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = _apart(p[i, own], q[own])
            best = sorted(zip((-value).tolist(), (terms[t] for t in own)))[:top]
            sources += [name] * len(best)
            part += ["term"] * len(best)
            items += [t for _, t in best]
            values += [-v for v, _ in best]
        strings = pa.array(items, pa.binary()).cast(pa.string())
        return pa.Table.from_arrays(
            [pa.array([lang] * len(items), pa.string()), pa.array(sources, pa.string()), pa.array(part, pa.string()), strings, pa.array(values, pa.int64())],
            names=["lang", "source", "part", "item", "value"],
        )

    return run


def _passes(hashes: DataFrame) -> list[list[tuple[str, int]]]:
    """The shards of each pass, so that no pass broadcasts more than BROADCAST_BYTES (or one shard)."""
    sized = hashes.select("lang", "shard", (F.length("shift") + F.length("bounds") + F.length("keys")).alias("b"))
    out: list[list[tuple[str, int]]] = []
    left = 0
    for lang, shard, size in sized.orderBy("lang", "shard").collect():
        if size > left:
            out.append([])
            left = max(size, BROADCAST_BYTES)
        out[-1].append((lang, shard))
        left -= size
    return out


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): each source of a language against the others and against the language.

    Part `pair` has a row for every other source of the language, part `term` the first `top` terms that the source
    uses more than its language; `value` is exact, as is `rank` (by value, then by the bytes of the item).

    First the terms in `least` rows of a language or more are found exactly. They are dealt into shards, each hashed
    perfectly onto its slots with the terms kept beside them. A second pass over the documents broadcasts these hashes
    and increments dense slots for each source; a term whose bytes are not those stored at its slot is not a kept one.
    Hashes of over BROADCAST_BYTES go out in several passes. The slots of a group are added in salted parts, then by
    shard, where all sources are compared: a task holds the sources of one language times the terms of one shard.

    Null text, language and source count as empty strings. Every (language, source) that occurs has its pairs, without
    a term too; a language without kept terms has pairs of value 0; one with a single source has no rows. Repeated rows
    and null ids count row by row. An empty table has no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = _rows(docs)
    groups = checkpointed(rows.select("lang", "source").distinct())
    kept = stored(frequent(rows, least))
    cells = F.greatest(F.lit(64), F.least(F.lit(SHARD), F.floor(F.lit(CELLS) / F.col("sources"))))
    sizes = (
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"))
        .join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang")
        .select("lang", "vocabulary", F.ceil(F.col("vocabulary") / cells).cast("long").alias("shards"))
    )
    sizes = checkpointed(sizes)
    hashes = stored(perfect_hashes(kept, sizes.select("lang", "shards")))
    shards = {r["lang"]: r["shards"] for r in sizes.collect()}
    salts = max(1, round(rows.rdd.getNumPartitions() ** 0.5))
    counted = None
    for chosen in _passes(hashes):
        wanted = spark.createDataFrame(chosen, "lang string, shard long")
        own: dict[str, tuple[int, dict[int, Perfect]]] = {}
        for r in hashes.join(F.broadcast(wanted), ["lang", "shard"], "left_semi").collect():
            own.setdefault(r["lang"], (shards[r["lang"]], {}))[1][r["shard"]] = Perfect.unpacked(r["shift"], r["bounds"], r["keys"])
        found = stored(_merged(recount(rows, own, salts), salts))
        counted = found if counted is None else counted.unionByName(found)
    pairs = groups.alias("a").join(groups.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
    none = pairs.select(
        "a.lang", "a.source", F.lit("pair").alias("part"), F.col("b.source").alias("item"), F.lit(0).cast("long").alias("value")
    )
    scored = none
    if counted is not None:
        totals = _totals(counted, groups)
        met = hashes.join(sizes, "lang").join(totals, "lang").select("lang", "shard", "n", "shift", "bounds", "keys", "vocabulary", "sources", "totals")
        parts = counted.select("lang", "shard", "source", "at", "width", "counts").groupBy("lang", "shard")
        scored = none.union(parts.cogroup(met.groupBy("lang", "shard")).applyInArrow(_scored(top), _SCORED))
    summed = scored.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, None).unionByName(_ranked(scored.filter("part = 'term'"), top))


def _totals(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, sources, totals): all sources of a language with the number of their kept terms' occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(_wide(w, c).sum()) for w, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.int64())], names=["lang", "source", "total"])

    each = counted.select("lang", "source", "width", "counts").mapInArrow(run, "lang string, source string, total long")
    each = each.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    listed = F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total"))))
    per = groups.join(each, ["lang", "source"], "left").groupBy("lang").agg(listed.alias("x"))
    return per.select("lang", F.col("x.source").alias("sources"), F.col("x.total").alias("totals"))


def _ranked(rows: DataFrame, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if top is None else out.filter(F.col("rank") <= top)
