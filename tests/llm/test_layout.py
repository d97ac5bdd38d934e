"""Operators 2, 9 and 10, and the registered queries."""

from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import compare
from balcao.llm import packing, queries, sharding, url_filter

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@given
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLES[name]) == []


URLS = {
    "http://a.example.net/en/x": ("a.example.net", "/en/x", "example.net/en/", "allow"),
    "http://EXAMPLE.net/En/": ("example.net", "/En/", "net/", "block"),
    "http://example.net/en": ("example.net", "/en", "net/", "block"),
    "https://x.org/fr/?a": ("x.org", "/fr/", "org/fr/", "allow"),
    "https://x.org?/fr/": ("x.org", "", None, "allow"),
    "http://net": ("net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://internet/": ("internet", "/", None, "allow"),
    "http://x.example.com/de/#f": ("x.example.com", "/de/", "example.com/de/", "block"),
    "http://shop.at/a?PHPSESSID=1": ("shop.at", "/a", None, "block"),
    "http://shop.at/get.exe": ("shop.at", "/get.exe", None, "block"),
    "http://the-casino.at/": ("the-casino.at", "/", None, "block"),
    "http://casinos.at/": ("casinos.at", "/", None, "allow"),
    "no scheme.net/": ("", "", None, "allow"),
    "http://x.net/é\n/y?q": ("x.net", "/é\n/y", "net/", "block"),
    "a://b://c.net/d": ("b:", "//c.net/d", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, "http://a.example.net/en/x", "x"), (None, "http://net/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.verdicts(pages).collect()]
    assert sorted(found, key=repr) == sorted(((i, *URLS[u]) for i, u, _ in rows), key=repr)
    assert url_filter.verdicts(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.verdicts(pages, patterns=(url_filter.Rule("all", "block", ".", ()),))


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(["net", "example", "en"],), (["net", "example"],), (["net"],)], "tokens array<string>")
    rule = url_filter.site_rule("allow", "example.net/en/")
    assert [r["token"] for r in url_filter.index(urls, (rule,)).collect()] == ["en"]


def test_minimum_slack_is_the_best_subset():
    rng = random.Random(3)
    for _ in range(100):
        capacity = rng.choice([20, 64])
        lengths = [rng.randrange(1, capacity) for _ in range(rng.randrange(1, 12))]
        bin_ = packing.MinimumSlack(capacity)
        for x in lengths:
            bin_.add(x, x)
        used = [x for x, _ in bin_.fill()]
        sums = {max(lengths)}
        rest = sorted(lengths)[:-1]
        for x in rest:
            sums |= {s + x for s in sums if s + x <= capacity}
        assert sum(used) == max(sums) and max(used) == max(lengths)
        assert bin_.size == len(lengths) - len(used)


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


TEXTS = [
    "", " ", "it's  we'll\n\n  end \t", "x" * 5000, "naïve Äpfel 漢字 🙂 \u00a0\u2003x", "<|endoftext|> a<|endoftext|>",
    "word and word " * 40_000, "a1b2 33 444.5,6!?\r\n", "\x00\x01 \u0130\u200d",
]


def test_both_libraries_give_the_same_ids(tokenizer):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer)
    encode = packing.encoder(tokenizer)
    for text in TEXTS:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids
    assert 50256 in encode("a <|endoftext|> b")


@pytest.mark.parametrize("window", [4, 4096])
def test_packing_round_trip(docs, rows, tokenizer, window):
    encode = packing.encoder(tokenizer)
    whole = defaultdict(list)
    for doc, text, *_ in rows:
        whole[doc].append([*encode(text or "").tolist(), 1])
    pieces = packing.pack(docs, tokenizer, capacity=256, window=window, with_ids=True).collect()
    sequences, by = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    for doc, texts in whole.items():
        if len(texts) == 1:
            assert [i for _, ids, _ in sorted(by[doc]) for i in ids] == texts[0]
            assert {n for *_, n in by[doc]} == {len(texts[0])}
        else:
            assert sum(len(ids) for _, ids, _ in by[doc]) == sum(map(len, texts))
    tokens = sum(len(t) for texts in whole.values() for t in texts)
    assert tokens / 256 <= len(sequences) <= tokens / 256 * 1.1 + 6


def test_shards(docs, rows):
    found = sharding.shard(docs.drop("shard"), 4, columns=("source",)).collect()
    expected = sorted(((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == expected
    home, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in found:
        home[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in home.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    biggest = max(x["size"] for x in found)
    assert max(load.values()) - min(load.values()) <= biggest


def test_even_shards_beside_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, "hot " * 20) for i in range(600)] + [(600 + i, f"{rng.random()} " * 5) for i in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    load = sorted(r["sum(size)"] for r in sharding.shard(frame, 2).groupBy("shard").sum("size").collect())
    assert len(load) == 2 and load[1] - load[0] < 400
    assert sharding.shard(frame.limit(0), 2).count() == 0


def test_splitters_are_exact(spark):
    rng = random.Random(2)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(500)] + [5, 5, 5]
    rows = spark.createDataFrame([(k, 1) for k in keys], "key long, size long")
    found = sharding.splitters(rows, [100, 250, 502], 0)
    assert [sum(k + (1 << 63) < b for k in keys) for b in found] == [100, 250, 502]
