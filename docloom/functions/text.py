"""Text expressions: tokens, pages, HTML to text, keyword tags."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_CHARS = 2000

_INVISIBLE = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
_BREAKS = r"(?is)</?(?:p|div|h[1-6]|li|ul|ol|br|tr|table|nav|article|title|head|body)(?:\s[^>]*)?/?>"
_TAGS = r"(?s)<[^>]+>"
# The entities decoded, the ampersand last so that nothing is decoded twice.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def html_to_text(html: Column) -> Column:
    visible = F.regexp_replace(html, _INVISIBLE, " ")
    text = F.regexp_replace(F.regexp_replace(visible, _BREAKS, "\n"), _TAGS, "")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r" ?\n[ \n]*", "\n")
    return F.trim(text, F.lit(" \n"))


def page_array(text: Column, chars: int = PAGE_CHARS) -> Column:
    """Whole text as an array of page structs of at most ``chars`` characters; NULL or '' gives NULL.

    One regular-expression pass cuts all pages, so time grows with the text; a substring per page
    would walk the text from its start every time.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))

    def pages(cut: Column) -> Column:
        return F.transform(cut, lambda piece, i: F.struct(
            (i + 1).alias("page_number"), piece.alias("page_text"), F.size(cut).alias("total_pages")))

    # Wrapping binds the cut pages to a variable: named twice, evaluated once.
    bound = F.transform(F.array(pieces), pages)[0]
    return F.when(F.length(text) > 0, bound)


def explode_pages(df: DataFrame, pages: str, *keep: str) -> DataFrame:
    """One row per page, its struct in ``_page``; NULL or empty arrays give no rows.

    The outer form with a filter after it: for an inner explode the optimiser adds a size test that
    it pushes down to the scan, and pages cut in the same query would then be cut twice.
    """
    return df.select(*keep, F.explode_outer(pages).alias("_page")).filter(F.col("_page").isNotNull())


def keyword_tags(text: Column, keywords: Sequence[str]) -> Column:
    """The keywords that occur in ``text``, case kept, each once, in order of first use."""
    longest_first = sorted(keywords, key=len, reverse=True)
    pattern = "(" + "|".join(re.escape(k) for k in longest_first) + ")"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
