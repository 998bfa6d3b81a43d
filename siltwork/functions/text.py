"""Text expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased tokens between white space, punctuation kept; empty for null."""
    trimmed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s+"))


def words(text: Column) -> Column:
    """Tokens in their own case."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s+"))


def content_hash(content: Column) -> Column:
    """SHA-256 of the UTF-8 content, in hex."""
    return F.sha2(content, 256)


def has_text(text: Column) -> Column:
    """Whether there is anything but white space."""
    return F.coalesce(text.rlike(r"\S"), F.lit(False))


def point_id(hash_: Column, index: Column) -> Column:
    """The same chunk has the same id in every run, so writing it again replaces it."""
    return F.sha2(F.concat_ws(":", hash_, index.cast("string")), 256)


#: Elements whose content is no text, for pages from the web and for files.
PAGE_STRIP = ("script", "style", "nav", "header", "footer")
FILE_STRIP = ("script", "style")
#: Entities in the order of replacement, the ampersand last.
ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&nbsp;", " "), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def html_text(html: Column, strip: tuple[str, ...] = PAGE_STRIP) -> Column:
    """The text of a page: comments and stripped elements go, tags become line ends, entities are replaced, blank lines and the white space at line ends go."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    for tag in strip:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}>", "")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "\n")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(out, r"\s*\n\s*", "\n"), r"^\s+|\s+$", "")


def html_title(html: Column, otherwise: Column) -> Column:
    """The text of <title>, or ``otherwise`` where it is missing or blank."""
    title = F.regexp_replace(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>([^<]*)</title>", 1), r"^\s+|\s+$", "")
    return F.when(title == "", otherwise).otherwise(title)
