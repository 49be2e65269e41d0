"""Compatibility decomposition (NFKD) without combining marks, as a column: a table of code points in pages, looked up by place.

Every code point decomposes by itself and marks are left out, so their order does not matter and no
character needs its neighbours. The table is made from the interpreter's Unicode data, once.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between entries, and for a code point that stays as it is.
SEPARATOR, SAME = "\x1f", "\x00"


def bare(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@cache
def pages() -> tuple[list[int], list[str]]:
    """The number of each 256 code points' page, 0 for those that all stay, and the entries of the pages one after the other."""
    index, entries = [], [SAME] * 256
    for high in range(0x1100):
        page = [SAME if 0xD800 <= cp <= 0xDFFF or cp < 0x80 or (d := bare(chr(cp))) == chr(cp) else d for cp in range(high << 8, (high + 1) << 8)]
        if set(page) == {SAME}:
            index.append(0)
        else:
            index.append(len(entries) // 256)
            entries += page
    return index, entries


def decomposed(text: Column) -> Column:
    """text with each character taken apart and its marks left out; null for null."""
    index, entries = pages()
    # constants, folded once
    numbers = F.split(F.lit(",".join(map(str, index))), ",").cast("array<int>")
    table = F.split(F.lit(SEPARATOR.join(entries)), SEPARATOR, -1)

    def one(c: Column) -> Column:
        cp = F.ascii(c)
        got = F.get(table, F.get(numbers, F.shiftright(cp, 8)) * 256 + cp.bitwiseAND(F.lit(255)))
        return F.when(got == SAME, c).otherwise(got)

    each = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one)
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(F.array_join(each, ""))
