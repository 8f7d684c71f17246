"""Finding sources: files in a landing folder, rows of directory listings, links of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import base_name
from strata.functions.urls import absolute_url

# The shapes of a listing row and of a plain link.
LISTING_ROW = (
    r"(?i)(\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}\s+[AP]M)"
    r"\s+(\d+)"
    r'\s+<a\s+href="([^"]+)">([^<]+)</a>'
)
LINK = r'(?i)<a\s+href="([^"]+)">([^<]+)</a>'


def discover_files(spark: SparkSession, folder: str, ignored: Sequence[str] = (), recursive: bool = False) -> DataFrame:
    """``file_name, path, size_bytes, modified_at`` of the files in a folder, without reading them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return found.select(
        base_name(F.col("path")).alias("file_name"),
        "path",
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    ).where(~F.col("file_name").isin(*ignored) if ignored else F.lit(True))


def _last_per_name(pages: DataFrame, keep: Sequence[str], html: str, pattern: str, name_group: int) -> DataFrame:
    """Matches of every page, with their name; of several with one name the last on the page stays.

    A page is one row and is dealt with in that row: its matches are sorted by name and
    place, and those followed by another name are the last ones. Nothing is shuffled.
    """
    matches = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    placed = F.transform(
        matches,
        lambda text, place: F.struct(
            F.trim(F.regexp_extract(text, pattern, name_group)).alias("file_name"), place.alias("place"), text.alias("text")
        ),
    )
    by_name = pages.select(*keep, F.sort_array(placed).alias("_by_name"))
    last = F.filter(
        "_by_name",
        lambda match, i: ~F.get("_by_name", i + 1)["file_name"].eqNullSafe(match["file_name"]),
    )
    found = by_name.select(*keep, F.explode(last).alias("_match"))
    return found.select(*keep, "_match.file_name", F.col("_match.text").alias("_text"))


def listing_rows(pages: DataFrame, base: str, page: str = "page_id", html: str = "html") -> DataFrame:
    """Files named by directory listings: ``page, file_name, source_url, source_last_modified, source_size_bytes``."""
    return _listed(_last_per_name(pages, [page], html, LISTING_ROW, 4), page, base)


def _listed(rows: DataFrame, page: str, base: str) -> DataFrame:
    """The fields of listing rows (``file_name``, ``_text``)."""
    def group(number: int) -> Column:
        return F.regexp_extract("_text", LISTING_ROW, number)

    rows = rows.withColumn("_href", group(3))
    return rows.select(
        page,
        "file_name",
        absolute_url(F.col("_href"), base).alias("source_url"),
        F.trim(group(1)).alias("source_last_modified"),
        group(2).try_cast("bigint").alias("source_size_bytes"),
    )


def listing_rows_of_files(spark: SparkSession, path: str, base: str, separator: str = "<br>") -> DataFrame:
    """:func:`listing_rows` of pages that are files, cut where the listing breaks its lines and not held as one value.

    ``separator`` is the page's own line break, which the reader splits files at, so one page of millions of entries
    is many rows in many tasks. ``page`` is the file's path. Of several rows with one name the one that stands last in
    the file counts, by its block and its place in it; rows of a name are merged per task first.
    """
    pieces = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("page"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"), F.regexp_extract_all("value", F.lit(LISTING_ROW), F.lit(0)).alias("_found"))
    rows = pieces.select("page", "_block", "_row", F.posexplode("_found").alias("_place", "_text"))
    named = rows.withColumn("file_name", F.trim(F.regexp_extract("_text", LISTING_ROW, 4)))
    last = named.groupBy("page", "file_name").agg(F.max_by("_text", F.struct("_block", "_row", "_place")).alias("_text"))
    return _listed(last, "page", base)


def page_links(pages: DataFrame, page: str = "page_id", html: str = "html", address: str = "url") -> DataFrame:
    """Links of pages, with their text as name and their address made absolute."""
    links = _last_per_name(pages, [page, address], html, LINK, 2)
    href = links.withColumn("_href", F.regexp_extract("_text", LINK, 1))
    return href.select(page, "file_name", absolute_url(F.col("_href"), F.col(address)).alias("source_url"))


def empty_listings(pages: DataFrame, html: str = "html", pattern: str = LISTING_ROW) -> DataFrame:
    """Pages on which no file is listed; any is a sign that the source changed its layout."""
    return pages.where(~F.col(html).rlike(pattern) | F.col(html).isNull())
