"""Accent- and case-insensitive text, with built-in functions only."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

# Combining marks dropped from decomposed text.
MARKS = "[\u0300-\u036f]"
BLANKS = " \t\n\r\u000b\f\u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(chr(c) for c in range(0x2000, 0x200B))


def strip_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not "\u0300" <= c <= "\u036f")


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Every BMP letter whose canonical decomposition is one letter plus marks."""
    pairs = []
    for code in range(0xC0, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        plain = strip_marks(chr(code))
        if len(plain) == 1 and plain != chr(code) and ord(plain) < 0x10000:
            pairs.append((chr(code), plain))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def normalized(text: Column) -> Column:
    """Without accents, lower case, trimmed; NULL counts as empty."""
    source, target = accent_table()
    unmarked = F.regexp_replace(F.coalesce(text, F.lit("")), MARKS, "")
    return F.btrim(F.lower(F.translate(unmarked, source, target)), F.lit(BLANKS))


def normalized_term(term: str | None) -> str:
    """The term as `normalized` would write it: letter by letter, so nothing else is taken apart."""
    source, target = accent_table()
    unmarked = re.sub(MARKS, "", term or "")
    return unmarked.translate(str.maketrans(source, target)).lower().strip(BLANKS)


def search_text(*parts: Column) -> Column:
    """One searchable text out of several columns, NULL parts left empty."""
    return normalized(F.concat_ws(" ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def blank_to_null(text: Column) -> Column:
    value = text.cast("string")
    return F.when(value == "", F.lit(None)).otherwise(value)


def locale_order(name: Column) -> Column:
    """Sort key in Portuguese alphabetical order."""
    return F.collate(name, "pt")


def with_place(names: DataFrame, name: str, ident: str, place: str) -> DataFrame:
    """Adds `place`, a number that grows with the Portuguese order of `name` and then `ident`; it has gaps.

    Names are compared letter by letter here, once; rows that carry the place are then sorted by a number.
    """
    ordered = names.orderBy(locale_order(F.col(name)), ident)
    return ordered.withColumn(place, F.monotonically_increasing_id())
