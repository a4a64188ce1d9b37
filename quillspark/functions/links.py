"""Links and permalinks as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import strip_ws

SELF = r"^/?\?ts="


def is_self(href: Column) -> Column:
    return href.rlike(SELF)


def is_external(href: Column) -> Column:
    return strip_ws(href).rlike("^https?://")


def domain(href: Column) -> Column:
    """What follows the last ``//`` up to a slash, without any ``www``; ``self`` for links to the archive itself."""
    host = F.split_part(F.element_at(F.split(href, "//"), -1), F.lit("/"), F.lit(1))
    return F.when(is_self(href), F.lit("self")).otherwise(F.regexp_replace(host, r"www[\p{Nd}.]*", ""))


def code(href: Column) -> Column:
    """The time code of a permalink, null without one."""
    return F.nullif(F.regexp_extract(href, r"\?ts=(.*)", 1), F.lit(""))


def permalink(href: Column, base: str) -> Column:
    return F.concat(F.lit(base), href)


def hrefs(html: Column) -> Column:
    """The quoted targets of all anchors of a page in order; for anchors of any form use the parsed nodes."""
    return F.regexp_extract_all(html, F.lit('<a [^>]*?href="([^"]*)"'), F.lit(1))


def without_quotes(html: Column) -> Column:
    """A page without its closed, unnested quotations; for others use the parsed nodes."""
    return F.regexp_replace(html, "(?s)<blockquote[^>]*>.*?</blockquote>", "")
