"""Folding of place names to a match key: no accents, upper case, only A-Z, 0-9 and space.

The fold works character by character, so it can be written with `translate` and stay in the JVM.
The tables are generated once from the Unicode database of the Python that plans the job.
"""

from __future__ import annotations

import string
import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_IN_KEY = "[^A-Z0-9 ]"
IN_KEY = frozenset(string.ascii_uppercase + string.digits + " ")

# Blocks whose unwanted characters are deleted by `translate` too: ASCII and Latin letters,
# punctuation and currency signs. Text in these scripts then needs no regular expression.
_COMMON_BLOCKS = ((0x0000, 0x024F), (0x0300, 0x036F), (0x2000, 0x206F), (0x20A0, 0x20CF))


def fold_plain(text: str | None) -> str | None:
    """The definition, for one string: what of its upper-cased decomposition may stand in a key."""
    upper = unicodedata.normalize("NFKD", text or "").upper()
    return None if text is None else "".join(filter(IN_KEY.__contains__, upper))


@cache
def _tables() -> tuple[str, str, dict[str, str]]:
    """`translate` arguments for folds to one or no character, and a map of the longer ones."""
    source, target, several, deleted = [], [], {}, []
    for code in (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF):
        ch = chr(code)
        plain = code > 0x7F and not unicodedata.decomposition(ch) and ch.upper() == ch
        folded = "" if plain else fold_plain(ch)
        if len(folded) > 1:
            if ch != "ß":  # `upper` already gives SS
                several[ch] = folded
        elif folded and code > 0x7F:
            source.append(ch)
            target.append(folded)
        elif not folded and any(low <= code <= high for low, high in _COMMON_BLOCKS):
            deleted.append(ch)  # beyond the end of the target: `translate` drops it
    return "".join(source + deleted), "".join(target), several


def _char_class(chars: list[str]) -> str:
    """Regular-expression class with runs of neighbours written as ranges."""
    codes = sorted(map(ord, chars))
    starts = [c for c in codes if c - 1 not in set(codes)]
    ends = [c for c in codes if c + 1 not in set(codes)]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def fold_text(c: Column) -> Column:
    """Match key of a text column, without Python workers."""
    source, target, several = _tables()
    folded = F.upper(F.translate(c, source, target))
    pairs = ";".join(f"{ch}={key}" for ch, key in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit(";"), F.lit("="))
    found = F.regexp_extract_all(folded, F.lit(f"({_char_class(list(several))})"), F.lit(1))
    expanded = F.aggregate(
        F.array_distinct(found), folded, lambda text, ch: F.replace(text, ch, table[ch])
    )
    # Whatever is left beyond ASCII (other scripts, ligatures, fractions) takes the slower way.
    return F.when(F.octet_length(folded) == F.length(folded), folded).otherwise(
        F.regexp_replace(expanded, NOT_IN_KEY, "")
    )


@F.pandas_udf(T.StringType())
def fold_text_udf(texts: pd.Series) -> pd.Series:
    """Same key through Arrow batches; kept as the reference form of `fold_text`."""
    return texts.map(fold_plain, na_action="ignore")
