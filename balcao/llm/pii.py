"""Personal data: four exact forms, and identifiers found through the words that precede them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.frames import stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The forms, written so that a long run of signs is tried once: a match begins where no earlier sign could begin it, and
# nothing that was taken is given back. \G is the end of the match before.
_FORMS = {
    EMAIL: r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # Runs of 12 to 19 digits with at most one sign between two: others are no cards.
    CARD: r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}(?![ -]?[0-9])",
    PHONE: r"\+[0-9][ ().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# What may be an identifier in another form: around an at sign, between colons, or 7 to 19 digits.
_LOOSE = (
    r"(?<!\S)[^\s@]{1,64}(?:@|\x20?[\[(]at[\])]\x20?)[^\s@]{1,255}(?<=[A-Za-z0-9])"
    r"|(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])"
    r"|(?<![0-9A-Za-z.+-])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])"
)
_AT = r"@|[\[(]at[\])]"
_DIGITS = "[^0-9]"
#: Code points before an identifier that are searched for its words.
REACH = 80
_WORD = r"\p{L}+"
_ONE = r"(\p{L}+)\P{L}{0,5}$"
_TWO = r"(\p{L}+\P{L}{1,5}\p{L}+)\P{L}{0,5}$"
#: Confidences are whole millionths, so that sums do not depend on their order.
SURE = 1_000_000
_BLOCK = 64


@dataclass(frozen=True)
class Trust:
    """A pattern needs so many different accepted identifiers of a kind, such a share of them among all identifiers it
    precedes, and among all its occurrences in the corpus; an identifier needs such a pattern. Shares in percent.

    An identifier that is not accepted yet but has the kind's shape speaks less against a pattern than other things:
    one in `doubt` of its occurrences counts."""

    support: int = 3
    purity: int = 80
    confidence: int = 60
    doubt: int = 4
    rounds: int = 3


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _running(steps: Column) -> Column:
    """Running sums of an array: over blocks first, then within each, so that long arrays are not copied per element."""

    def within(x: Column) -> Column:
        block = F.slice(x["steps"], x["b"] * _BLOCK + 1, F.lit(_BLOCK))
        return _let(
            F.struct(block.alias("block"), x["before"].alias("before")),
            lambda y: F.transform(F.sequence(F.lit(1), F.size(y["block"])), lambda i: y["before"] + _total(F.slice(y["block"], F.lit(1), i))),
        )

    def over(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(s, b * _BLOCK + 1, F.lit(_BLOCK))))
        before = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return _let(
            F.struct(before.alias("before"), s.alias("steps")),
            lambda x: F.flatten(
                F.transform(
                    F.sequence(F.lit(0), F.size(x["before"]) - 2),
                    lambda b: _let(F.struct(x["steps"].alias("steps"), b.alias("b"), F.get(x["before"], b).alias("before")), within),
                )
            ),
        )

    return F.when(F.size(steps) > 0, _let(steps, over)).otherwise(F.array().cast("array<int>"))


def _found(text: Column, form: str) -> Column:
    """Matches of a form as structs (start, end, raw), in code points; what lies between them gives their places."""
    raw = F.regexp_extract_all(text, F.lit(form), F.lit(0))

    def placed(x: Column) -> Column:
        steps = F.transform(
            x["raw"], lambda m, i: F.char_length(F.get(x["gaps"], i)) + F.when(i > 0, F.char_length(F.get(x["raw"], i - 1))).otherwise(0)
        )
        return _let(
            F.struct(_running(steps).alias("start"), x["raw"].alias("raw")),
            lambda y: F.transform(
                y["raw"],
                lambda m, i: F.struct(F.get(y["start"], i).alias("start"), (F.get(y["start"], i) + F.char_length(m)).alias("end"), m.alias("raw")),
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,raw:string>>")
    return _let(
        F.struct(raw.alias("raw"), text.alias("text")),
        lambda x: F.when(F.size(x["raw"]) == 0, none).otherwise(
            _let(F.struct(x["raw"].alias("raw"), F.split(x["text"], form).alias("gaps")), placed)
        ),
    )


def _luhn(digits: Column) -> Column:
    def doubled(d: Column) -> Column:
        return d * 2 - F.when(d > 4, 9).otherwise(0)

    def value(d: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(d, F.char_length(d) - i + 1, F.lit(1))) - 48
        return F.when(i % 2 == 0, doubled(digit)).otherwise(digit)

    each = F.transform(F.sequence(F.lit(1), F.char_length(digits)), lambda i: value(digits, i))
    return _total(each) % 10 == 0


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, _DIGITS, "")


def _passes(kind: int, raw: Column) -> Column:
    if kind == IP:
        return F.regexp_like(raw, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == CARD:
        return _luhn(_digits(raw))
    if kind == PHONE:
        return F.char_length(_digits(raw)).between(9, 15)
    return F.lit(True)


def _value(kind: Column, raw: Column) -> Column:
    """What names an identifier however it is written."""
    text = F.coalesce(kind, F.lit(-1)).isin(EMAIL, IP) | F.regexp_like(raw, F.lit(_AT + "|:"))
    return F.when(text, F.lower(raw)).otherwise(_digits(raw))


def base_spans(text: Column) -> Column:
    """The spans of the four forms that pass their tests: array of (start, end, raw, kind)."""

    def of(kind: int) -> Column:
        good = F.filter(_found(text, _FORMS[kind]), lambda x: _passes(kind, x["raw"]))
        return F.transform(good, lambda x: x.withField("kind", F.lit(kind)))

    return F.concat(*(of(kind) for kind in range(len(KINDS))))


def _with_words(spans: Column, text: Column) -> Column:
    """Each span with the one and the two words before it, in lower case; null where there are none."""

    def words(x: Column) -> Column:
        at = F.greatest(x["start"] - REACH, F.lit(0))
        before = F.lower(F.substring(text, at + 1, x["start"] - at))
        two = F.regexp_replace(F.regexp_extract(before, _TWO, 1), r"\P{L}+", " ")
        return x.withField("words", F.filter(F.array(F.regexp_extract(before, _ONE, 1), two), lambda w: w != ""))

    return F.transform(spans, words)


def scanned(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, base, loose): all that the texts are read for. `loose` are spans that may be identifiers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = "array<struct<start:int,end:int,raw:string,kind:int>>"
    named = rows.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))
    found = named.select("doc_id", "text", "digest", base_spans(F.col("text")).cast(kinds).alias("base"), _found(F.col("text"), _LOOSE).alias("loose"))
    return found.select("doc_id", "digest", *(_with_words(F.col(c), F.col("text")).alias(c) for c in ("base", "loose")))


def mentions(texts: DataFrame) -> DataFrame:
    """(digest, copies, start, end, kind, value, fits, words): identifiers of each different text; kind is null for loose ones.

    A loose span that meets a base span is dropped: the bases before it in the text must end, and the next begin, outside.
    """
    once = texts.groupBy("digest").agg(F.first("base").alias("base"), F.first("loose").alias("loose"), F.count(F.lit(1)).alias("copies"))
    seeds = once.select("digest", "copies", F.inline("base"))
    loose = once.select("digest", "copies", F.inline("loose")).withColumn("kind", F.lit(None).cast("int"))
    both = seeds.unionByName(loose)
    seed_end, seed_start = (F.when(F.col("kind").isNotNull(), F.col(c)) for c in ("end", "start"))
    by = Window.partitionBy("digest").orderBy("start")
    before = F.max(seed_end).over(by.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(seed_start).over(by.rangeBetween(0, Window.unboundedFollowing))
    free = F.col("kind").isNotNull() | (
        (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    )
    n = F.char_length(_digits(F.col("raw")))
    at, colon = F.regexp_like("raw", F.lit(_AT)), F.col("raw").contains(":")
    number = ~at & ~colon
    fits = F.filter(
        F.array(F.when(at, EMAIL), F.when(~at & colon, IP), F.when(number & n.between(12, 19), CARD), F.when(number & n.between(7, 15), PHONE)),
        lambda x: x.isNotNull(),
    )
    return (
        both.withColumns({"before": before, "after": after})
        .filter(free)
        .select("digest", "copies", "start", "end", "kind", _value(F.col("kind"), F.col("raw")).alias("value"), fits.alias("fits"), "words")
    )


def occurrences(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern's words occur in all texts, before whatever follows."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(_WORD), F.lit(0))
    listed = rows.select(words.alias("w"))
    one = F.col("w")
    two = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.concat_ws(" ", a, b))
    said = listed.select(F.explode(F.concat(one, two)).alias("pattern"))
    return said.join(patterns, "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))


def bootstrap(rows: DataFrame, found: DataFrame, trust: Trust) -> DataFrame | None:
    """(value, kind, score): loose identifiers that patterns vouch for; None where there are none.

    The graph has a pattern, an identifier and how often they meet. Identifiers of a form are accepted from
    the start. In each round patterns are scored by the accepted identifiers they precede, against all
    identifiers and all their occurrences in the corpus; the best pattern's score is the identifier's, and identifiers
    that reach `confidence` are accepted in the next round. Scores are whole millionths.
    """
    edges = found.withColumn("pattern", F.explode("words")).groupBy("pattern", "value", "kind", "fits").agg(F.sum("copies").alias("times"))
    edges = stored(edges)
    seeds = found.filter("kind IS NOT NULL").select("value", "kind").distinct().withColumn("score", F.lit(SURE))
    accepted, known = seeds, 0
    totals: DataFrame | None = None
    discovered: DataFrame | None = None
    mentioned = edges.groupBy("pattern").agg(F.sum("times").alias("mentions"))
    unknown = edges.filter("kind IS NULL").select("pattern", "value", F.explode("fits").alias("kind"), "times")
    for _ in range(trust.rounds):
        # A value may be accepted as two kinds; the edges of a value are told apart by kind before they are summed.
        met = edges.drop("kind", "fits").join(accepted, "value").groupBy("pattern", "value", F.col("kind")).agg(
            F.sum("times").alias("times"), F.max("score").alias("score")
        )
        scored = met.groupBy("pattern", "kind").agg(F.sum(F.col("times") * F.col("score")).alias("mass"), F.count(F.lit(1)).alias("support"))
        open_ = unknown.join(accepted, ["value", "kind"], "left_anti").groupBy("pattern", "kind").agg(F.sum("times").alias("open"))
        enough = scored.filter(F.col("support") >= trust.support).join(mentioned, "pattern").join(open_, ["pattern", "kind"], "left")
        # In parts of one in `doubt`: what of an unknown identifier does not count.
        enough = enough.withColumn("spared", F.coalesce("open", F.lit(0)) * (trust.doubt - 1)).drop("open")
        against = F.col("mentions") * trust.doubt - F.col("spared")
        likely = stored(enough.filter(F.col("mass") * (100 * trust.doubt) >= against * (SURE * trust.purity)))
        new = likely.select("pattern").distinct()
        if totals is not None:
            new = new.join(totals, "pattern", "left_anti")
        new = stored(new)
        if not new.isEmpty():
            counted = stored(occurrences(rows, new))
            totals = counted if totals is None else totals.unionByName(counted)
        if totals is None:
            break
        all_ = (F.greatest("total", "mentions") + 1) * trust.doubt - F.col("spared")
        score = F.expr("mass * doubt div against")
        strong = likely.join(totals, "pattern").withColumns({"doubt": F.lit(trust.doubt), "against": all_}).withColumn("trust", score).filter(F.col("trust") * 100 >= SURE * trust.confidence)
        reached = (
            edges.filter("kind IS NULL").drop("kind")
            .join(strong.select("pattern", "kind", "trust"), "pattern")
            .filter("array_contains(fits, kind)")
            .groupBy("value", "kind")
            .agg(F.max("trust").alias("score"))
        )
        discovered = stored(reached)
        n = discovered.count()
        if n == known:
            break
        known = n
        accepted = seeds.unionByName(discovered).groupBy("value", "kind").agg(F.max("score").alias("score"))
    return discovered if known else None


def _printed(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kind = lambda x: F.element_at(F.array(*(F.lit(k) for k in KINDS)), x["kind"] + 1)
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    return F.concat_ws(",", F.transform(ordered, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string"))))


def spans(docs: DataFrame, trust: Trust = Trust()) -> DataFrame:
    """One row per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_found.

    `base` and `spans` are arrays of (start, end, kind) in code points, end exclusive. The counts are those of the
    base spans, found by their forms in whole texts; `spans` has these and `n_found` more that the words before them
    gave away. The texts are read once, and once more in each round that counts the occurrences of new patterns.

    Null and empty texts have no spans. Texts that repeat have the same spans; a pattern's support counts different identifiers. Rows with
    null or repeated ids are rows of their own. Without any span nothing is learnt. Other columns are not read.
    """
    rows = docs.select("doc_id", "text")
    texts = stored(scanned(rows))
    found = stored(mentions(texts.filter((F.size("base") > 0) | (F.size("loose") > 0))))
    short = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, lambda x: x == F.lit(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    each = texts.select("doc_id", "digest", *counts, short(F.col("base")).alias("base"))
    learnt = bootstrap(rows, found, trust)
    if learnt is None:
        return each.withColumns({"spans": F.col("base"), "n_found": F.lit(0).cast("long")}).drop("digest")
    # An identifier that fits two kinds is the one with the better score, the first listed where they are as good.
    kind = learnt.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    more = found.filter("kind IS NULL").drop("kind").join(kind, "value").groupBy("digest").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("more")
    )
    joined = each.join(more, "digest", "left")
    return joined.select(
        *(c for c in each.columns if c != "digest"),
        F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more")).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"),
    )


def printed(found: DataFrame) -> DataFrame:
    """The rows of `spans` with the base spans as a digest and all spans as text."""
    digest = F.sha2(_printed(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), digest, _printed(F.col("spans")).alias("spans"), "n_found")
