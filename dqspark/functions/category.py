"""Accent- and punctuation-insensitive key for category values.

The compatibility decomposition works character by character once the marks
are dropped, so tables of the characters that leave letters, digits or nothing
carry it; all of it runs in the JVM, the tables only for values beyond ASCII.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqspark.functions import text as tx

BEYOND_ASCII = r"[^\x00-\x7f]"


@functools.cache
def tables() -> tuple[str, str, dict[str, str]]:
    """What NFKD without its marks (characters with a combining class) leaves of each character.

    Characters that become one of A-Z and 0-9 and then those that vanish, what
    the former become, and those that become several characters with what they
    become.  All others count as separators, decomposed or not.
    """
    single, gone, several = [], [], {}
    for c in map(chr, (x for x in range(0x80, sys.maxunicode + 1) if not 0xD800 <= x < 0xE000)):
        left = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        left = re.sub("[^A-Z0-9]", " ", left)
        if not left:
            gone.append(c)
        elif len(left) > 1 and left.strip():
            several[c] = left
        elif left.strip():
            single.append((c, left))
    return "".join(c for c, _ in single) + "".join(gone), "".join(x for _, x in single), several


def without_marks(c) -> Column:
    """``c`` decomposed and without marks, as far as A-Z and 0-9 are concerned."""
    mapped, to, several = tables()
    c = F.col(c) if isinstance(c, str) else c
    long = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelt = F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)."), 0),
                                     lambda x: F.coalesce(F.element_at(long, x), x)), "")
    return F.translate(F.when(c.rlike("[" + "".join(several) + "]"), spelt).otherwise(c), mapped, to)


def category_key(c) -> Column:
    upper = F.upper(tx.ws_strip(c))
    folded = F.when(upper.rlike(BEYOND_ASCII), without_marks(upper)).otherwise(upper)
    return F.btrim(F.regexp_replace(folded, "[^A-Z0-9]+", " "))
