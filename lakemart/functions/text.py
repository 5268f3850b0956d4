"""Text expressions: markup removal, words, search terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markup that carries no text, removed in this order.
MARKUP = (
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
    r"(?is)<(?:nav|header|footer)\b.*?</(?:nav|header|footer)\s*>",
    r"(?is)<!--.*?-->",
    r"(?is)<[^>]*>",
)
# Entities, the ampersand last so that none is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
BLANKS = r"[ \t\r\n]+"
NON_TERM = r"[^\p{L}\p{N}]+"


def html_text(html: Column) -> Column:
    """Visible text of a page, blanks collapsed."""
    bare = reduce(lambda c, pattern: F.regexp_replace(c, pattern, " "), MARKUP, html)
    plain = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, bare)
    return F.trim(F.regexp_replace(plain, BLANKS, " "))


def words(text: Column) -> Column:
    """Blank-separated words of the whole text."""
    return F.array_remove(F.split(text, BLANKS), "")


def terms(text: Column) -> Column:
    """Lower-case runs of letters and digits, repeats kept."""
    return F.array_remove(F.split(F.lower(text), NON_TERM), "")
