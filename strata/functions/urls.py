"""Resolving links against the address of the page they stand on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _without_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of an absolute path; a trailing one leaves a slash."""
    segments = F.split(path, "/")

    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", kept)
            .when((segment == "..") & (F.size(kept) <= 1), kept)
            .when(segment == "..", F.slice(kept, F.lit(1), F.size(kept) - 1))
            .otherwise(F.concat(kept, F.array(segment)))
        )

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    joined = F.array_join(kept, "/")
    ends_in_dots = F.element_at(segments, -1).isin(".", "..") & ~joined.endswith("/")
    return F.when(ends_in_dots, F.concat(joined, F.lit("/"))).otherwise(joined)


def _before(text: Column, *marks: str) -> Column:
    """The part of a text in front of the first of some characters."""
    for mark in marks:
        text = F.substring_index(text, mark, 1)
    return text


def absolute_url(href: Column, base: Column | str) -> Column:
    """``href`` as seen from the page ``base``: RFC 3986, with slashes merged in relative paths.

    Plain text functions come first; a pattern is only tried where it can match.
    """
    base = F.lit(base) if isinstance(base, str) else base
    plain_base = _before(base, "#", "?")
    scheme = F.concat(F.substring_index(plain_base, ":", 1), F.lit(":"))
    origin = F.substring_index(plain_base, "/", 3)
    base_path = F.substring(plain_base, F.length(origin) + 1, F.length(plain_base))
    last_part = F.substring_index(base_path, "/", -1)
    folder = F.when(base_path == "", F.lit("/")).otherwise(
        F.substring(base_path, F.lit(1), F.length(base_path) - F.length(last_part))
    )

    path = _before(href, "#", "?")
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    joined = F.concat(folder, path)
    below = F.when(F.contains(joined, F.lit("//")), F.regexp_replace(joined, "/{2,}", "/")).otherwise(joined)
    rooted = F.when(path.startswith("/"), path).otherwise(below)
    return (
        F.when(F.contains(href, F.lit(":")) & href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(_before(base, "#"), href))
        .when(path == "", F.concat(plain_base, rest))
        .when(F.contains(rooted, F.lit("/.")), F.concat(origin, _without_dots(rooted), rest))
        .otherwise(F.concat(origin, rooted, rest))
    )
