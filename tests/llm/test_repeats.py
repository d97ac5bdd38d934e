"""Operators 1 and 4 against brute force, on small windows and on all planted rows."""

from __future__ import annotations

from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from balcao.llm import repeats, suffix_dedup, superkmer_dedup


def _flags(sequence, window, gone):
    out = [False] * len(sequence)
    for at in range(len(sequence) - window + 1):
        if gone(at, tuple(sequence[at : at + window])):
            out[at : at + window] = [True] * window
    return out


def _spans(flags):
    edges = [i for i in range(len(flags) + 1) if (i < len(flags) and flags[i]) != (i > 0 and flags[i - 1])]
    return edges


def brute(rows, window, split, join, keep):
    sequences = {}
    for doc, text in rows:
        sequences.setdefault((doc, text or ""), split((text or "").encode()))
    count, first = Counter(), {}
    for doc, text in rows:
        own = sequences[doc, text or ""]
        for at in range(len(own) - window + 1):
            count[tuple(own[at : at + window])] += 1
    order = sorted(sequences, key=lambda k: (1 << 62 if k[0] is None else k[0], k[1]))
    for name in order:
        own = sequences[name]
        for at in range(len(own) - window + 1):
            first.setdefault(tuple(own[at : at + window]), (name[0], at))
    out = []
    for doc, text in rows:
        own = sequences[doc, text or ""]
        if keep == "none":
            flags = _flags(own, window, lambda at, w: count[w] > 1)
        else:
            flags = _flags(own, window, lambda at, w: first[w] != (doc, at))
        out.append((doc, len(own), sum(flags), _spans(flags), join(x for x, gone in zip(own, flags) if not gone)))
    return sorted(out, key=repr)


def found(df, total):
    return sorted(((r["doc_id"], r[total], r["n_removed"], list(r["spans"]), bytes(r["kept"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window,keep", [(35, "none"), (35, "first"), (3, "none"), (2, "none")])
def test_words(docs, rows, window, keep):
    expected = brute([r[:2] for r in rows], window, bytes.split, b" ".join, keep)
    assert found(superkmer_dedup.removed(docs, window, keep), "n_words") == expected


@pytest.mark.parametrize("window,keep", [(400, "none"), (400, "first"), (40, "none"), (8, "none")])
def test_bytes(docs, rows, window, keep):
    short = [r[:2] for r in rows if len(r[1] or "") < 3000]
    frame = docs.filter("text IS NULL OR length(text) < 3000")
    expected = brute(short, window, list, bytes, keep)
    assert found(suffix_dedup.removed(frame, window, keep), "n_bytes") == expected


@pytest.mark.parametrize("crowd", [1, 3])
def test_crowded_keys_are_dealt_anew(docs, rows, monkeypatch, crowd):
    """Every class of windows, down to single ones, gives the same result."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    expected = brute([r[:2] for r in rows], 35, bytes.split, b" ".join, "none")
    assert found(superkmer_dedup.removed(docs, 35, "none"), "n_words") == expected


def test_empty_table(empty):
    assert superkmer_dedup.removed(empty).count() == 0
    assert suffix_dedup.removed(empty).count() == 0


@pytest.mark.parametrize(
    "operator,window,split,join,crowd,total",
    [
        (superkmer_dedup, 35, bytes.split, b" ".join, 1, "n_words"),
        (superkmer_dedup, 35, bytes.split, b" ".join, 0, "n_words"),
        (suffix_dedup, 100, list, bytes, 1, "n_bytes"),
        (suffix_dedup, 100, list, bytes, 0, "n_bytes"),
    ],
)
@pytest.mark.parametrize("keep", ["none", "first"])
def test_tasks_deal_crowded_keys_anew(docs, rows, monkeypatch, operator, window, split, join, crowd, total, keep):
    """Tasks get the limit; more than one class is used, and every one gives the result of brute force."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    built, make = [], operator.kind

    def kind(size):
        # The wider of the narrow classes holds up to three strings, so that the fixture meets both.
        built.append(replace(make(size), crowds=3))
        return built[-1]

    monkeypatch.setattr(operator, "kind", kind)
    short = [r[:2] for r in rows if len(r[1] or "") < 3000]
    frame = docs.filter("text IS NULL OR length(text) < 3000")
    expected = brute(short, window, split, join, keep)
    assert found(operator.removed(frame, window, keep), total) == expected
    # The limit as a task sees it, and the classes of the fixture's keys.
    (used,) = built
    sent = frame.sparkSession.sparkContext.parallelize([0], 1).map(lambda _: used.crowd).first()
    assert sent == crowd
    times = [r["n"] for r in repeats._hits(repeats.distinct_texts(frame), used).selectExpr("inline(hits)").collect()]
    assert len(set(used.widths(np.array(times)).tolist()) - {used.lead}) >= (2 if crowd else 1)
