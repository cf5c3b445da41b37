"""Search-result record extraction from stored HTML pages: one record per
result block with title, link, snippet and PDF link, each with a literal
default when missing.  Regular-expression extraction runs JVM-side; pages
are independent rows, so the work is embarrassingly parallel."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import selectors as SEL
from ..functions.text import html_unescape, strip, strip_tags

# Defaults written when a field is missing, as in the reference.
NO_TITLE = "No title available"
NO_LINK = "No link available"
NO_SNIPPET = "No snippet available"
NO_PDF = "No PDF link available"
RECORD_FIELDS = ["title", "link", "snippet", "pdf_link"]
# A result page's blocks, and per field its selector, attribute (None: text) and default.
RESULT_BLOCK = ".gs_r.gs_or.gs_scl"
RESULT_FIELDS = {"title": (".gs_rt a", None, NO_TITLE), "link": (".gs_rt a", "href", NO_LINK),
                 "snippet": (".gs_rs", None, NO_SNIPPET), "pdf_link": (".gs_or_ggsm a", "href", NO_PDF)}

BLOCK_RE = "(?s)<article[^>]*>(.*?)</article>"
TITLE_RE = "(?s)<h1[^>]*>(.*?)</h1>"
LINK_RE = "<a\\s[^>]*href=\"([^\"]*)\""
SNIPPET_RE = "(?s)<p[^>]*>(.*?)</p>"
PDF_RE = "<a\\s[^>]*href=\"([^\"]*\\.pdf)\""


def _text(c) -> "F.Column":
    return strip(html_unescape(strip_tags(c)))


def _default(c, value: str) -> "F.Column":
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(value))


def extract_records(pages: DataFrame, html_col: str = "html", keep=("page_id",), block_re: str = BLOCK_RE,
                    title_re: str = TITLE_RE, link_re: str = LINK_RE, snippet_re: str = SNIPPET_RE,
                    pdf_re: str = PDF_RE) -> DataFrame:
    """One row per result block.  The link is the title's own anchor; only a
    title without one takes the block's first anchor.  Every pattern is a
    parameter with one group, so other page shapes need no code."""
    blocks = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(block_re), 1))
                          .alias("pos", "_b"))
    blocks = blocks.withColumn("_t", F.regexp_extract("_b", title_re, 1))
    own = F.nullif(F.regexp_extract("_t", link_re, 1), F.lit(""))
    return blocks.select(
        *keep, "pos",
        _default(_text(F.col("_t")), NO_TITLE).alias("title"),
        F.coalesce(own, _default(F.regexp_extract("_b", link_re, 1), NO_LINK)).alias("link"),
        _default(_text(F.regexp_extract("_b", snippet_re, 1)), NO_SNIPPET).alias("snippet"),
        _default(F.regexp_extract("_b", pdf_re, 1), NO_PDF).alias("pdf_link"))


def select_records(pages: DataFrame, block: str = RESULT_BLOCK,
                   fields: Mapping[str, tuple[str, str | None, str | None]] = RESULT_FIELDS, html_col: str = "html",
                   keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """(``keep``..., pos, fields..., error): one row per element that the
    selector ``block`` finds, numbered from 0 in document order; blocks inside
    blocks are rows of their own.

    A field is (selector, attribute, default): of the first element below the
    block that fits, the attribute, or its whole text (white space as it
    stands, scripts and styles left out) if the attribute is None; the default
    where no element fits, or the element has no such attribute.  Selectors
    read ``tag``, ``#id``, ``.class``, ``[attr]``, ``[attr="value"]``, blanks,
    ``>`` and commas; others are refused before any page is read.  Elements
    nest as the page's tags do: an end tag closes the innermost open element
    of its name, one that closes nothing is skipped, void elements have no
    inside, what is never closed reaches to the page's end.

    Null and empty pages have no rows.  A page whose mark-up cannot be read on
    has its records so far with an ``error``, and one more row of nulls with
    it if it had none.  Pages are independent rows; a page is read once from
    front to back, with its open elements in memory."""
    chains = SEL.parse_selector(block)
    wanted = [(name, SEL.parse_selector(selector), attr) for name, (selector, attr, _) in fields.items()]
    defaults = [d for _, _, d in fields.values()]
    base = pages.select(*keep, F.col(html_col).alias("__html"))
    schema = T.StructType([*base.schema.fields[:-1], T.StructField("pos", T.IntegerType()),
                           *[T.StructField(name, T.StringType()) for name in fields], T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cells = [], []
            for i, html in enumerate(batch.column(len(keep))):
                records, error = SEL.select_records(html.as_py() or "", chains, wanted)
                for pos, r in enumerate(records):
                    at.append(i)
                    cells.append((pos, *[d if v is None else v for v, d in zip(r.values(), defaults)], error))
                if error and not records:
                    at.append(i)
                    cells.append((None, *[None] * len(defaults), error))
            columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:len(keep)]]
            columns += [pa.array([c[0] for c in cells], pa.int32())]
            columns += [pa.array([c[j] for c in cells], pa.string()) for j in range(1, len(defaults) + 2)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return base.mapInArrow(run, schema)
