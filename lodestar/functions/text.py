"""Column -> Column text rules.  All are native Spark expressions, so they run
inside whole-stage codegen and work on batch and streaming DataFrames alike."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by a Python-style strip(): ASCII whitespace plus the
# ideographic space that model answers in Chinese often carry.
_WS = "[ \\t\\n\\r\\f\\x0B\\u3000]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading/trailing whitespace including newlines (Spark's trim
    only removes spaces)."""
    return F.regexp_replace(_c(c), f"^{_WS}+|{_WS}+$", "")


def blank(c) -> Column:
    """True when the value is NULL or empty after strip (a falsy field)."""
    return F.coalesce(F.length(strip(_c(c))) == 0, F.lit(True))


def falsy(c) -> Column:
    """Python truthiness of a string field: NULL or '' is falsy, ' ' is not."""
    return F.coalesce(F.length(_c(c)) == 0, F.lit(True))


def prefix_match(c, prefixes: Iterable[str]) -> Column:
    """Upper-cased value starts with any prefix; NULL -> false."""
    up = F.upper(_c(c))
    conds = [up.startswith(p.upper()) for p in prefixes]
    return F.coalesce(reduce(lambda a, b: a | b, conds), F.lit(False))


def keyword_match(c, keywords: Iterable[str]) -> Column:
    """Lower-cased value contains any keyword; NULL -> false."""
    low = F.lower(_c(c))
    conds = [low.contains(k.lower()) for k in keywords]
    return F.coalesce(reduce(lambda a, b: a | b, conds), F.lit(False))


def cut_with_marker(c, max_chars: int, marker: str, always: bool = False) -> Column:
    """First ``max_chars`` characters; the marker is appended only when the
    text was cut (or always, for the hit preview)."""
    col = _c(c)
    cut = F.concat(F.substring(col, 1, max_chars), F.lit(marker))
    if always:
        return cut
    return F.when(F.length(col) > max_chars, cut).otherwise(col)


def html_unescape(c) -> Column:
    """Decode the five predefined XML entities (``&amp;`` last)."""
    col = _c(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        col = F.replace(col, F.lit(ent), F.lit(ch))
    return col


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), "<[^>]*>", "")


def file_stem(c) -> Column:
    """Base name without its last extension: ``a.b.c.txt`` -> ``a.b.c``."""
    base = F.regexp_extract(_c(c), "([^/]*)$", 1)
    return F.regexp_replace(base, "\\.[^.]*$", "")
