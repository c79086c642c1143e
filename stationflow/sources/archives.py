"""Archive sources (A13, A13b, A15), re-aimed at stored pages and archives.

The reference fetches one web page, finds the quarterly zip links, downloads
the missing ones and unpacks the trip CSV from each. Here the pages are a
table (``page_id, url, html``) and the archives are files in a shared folder:

* ``page_links``: every ``<a href>`` of every page with its position,
  resolved against the page URL (RFC 3986), and the file name of its path.
* ``discover_archives``: the trip archive links among them, the first link
  per (year, quarter) in page order, with the expected CSV name.
* ``expand_archives``: each archive is opened by one task (zip files are not
  splittable), its first trip CSV member streamed to ``out_dir`` under the
  expected name; many archives are unpacked in parallel.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .local import rows_frame
from .trips import TRIP_FILE_PREFIX, quarter_columns, trip_file_quarter

# Archive naming and the link pattern.
ARCHIVE_SUFFIX = ".zip"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
# An <a> tag, its attributes before href, then the value with its quotes.
HREF_PATTERN = (
    r"""(?i)<a(?:\s+(?!href\s*=)[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?)*+"""
    r"""\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*)"""
)
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'", "&amp;": "&"}
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_URL_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, _URL_PARTS, i)


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 5.2.4 on an absolute path: '.' dropped, '..' pops."""
    segs = F.slice(F.split(path, "/"), 2, 1 << 30)
    kept = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    trailing = F.element_at(segs, -1).isin(".", "..")
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(trailing & (F.size(kept) > 0), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_url(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base`` (absolute, network-path, absolute-
    path, query, fragment, empty and relative references)."""
    scheme, authority = _part(base, 1), _part(base, 2)
    bpath, bquery = _part(base, 3), _part(base, 4)
    origin = F.concat(scheme, F.lit(":"), authority)
    hpath = _part(href, 3)
    htail = F.concat(_part(href, 4), _part(href, 5))
    base_dir = F.regexp_extract(bpath, r"^(.*/)", 1)
    merged = F.when((authority != "") & (bpath == ""), F.concat(F.lit("/"), hpath)).otherwise(
        F.concat(base_dir, hpath))
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, remove_dot_segments(hpath), htail))
        .when(href.startswith("?"), F.concat(origin, bpath, href))
        .when(href.startswith("#"), F.concat(origin, bpath, bquery, href))
        .when(href == "", base)
        .otherwise(F.concat(origin, remove_dot_segments(merged), htail))
    )


def url_file_name(url: Column) -> Column:
    """Last non-empty segment of the URL path ('' when none)."""
    segs = F.filter(F.split(_part(url, 3), "/"), lambda s: (s != "") & (s != "."))
    return F.coalesce(F.element_at(segs, -1), F.lit(""))


def attribute_value(raw: Column) -> Column:
    """An attribute's text: without its quotes, character references decoded."""
    value = F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")
    for entity, char in ENTITIES.items():
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, link_pos, href, url, file_name) for every link of every page;
    links inside comments do not count."""
    html = F.regexp_replace("html", COMMENT_PATTERN, "")
    links = pages.select(
        "page_id", F.col("url").alias("page_url"),
        F.posexplode(F.regexp_extract_all(html, F.lit(HREF_PATTERN), 1)).alias("link_pos", "href"),
    )
    href = attribute_value(F.col("href"))
    resolved = links.withColumn("href", href).withColumn("url", resolve_url(F.col("page_url"), F.col("href")))
    return resolved.select(
        "page_id", (F.col("link_pos") + 1).cast("bigint").alias("link_pos"), "href", "url",
        url_file_name(F.col("url")).alias("file_name"),
    )


def discover_archives(pages: DataFrame, prefix: str = TRIP_FILE_PREFIX,
                      suffix: str = ARCHIVE_SUFFIX) -> DataFrame:
    """Archive links by quarter, first link per (year, quarter) in
    page order, with url, file_name, csv_file_name, year, quarter, sorted."""
    links = page_links(pages).filter(
        F.col("file_name").startswith(prefix) & F.col("file_name").endswith(suffix))
    year, quarter = quarter_columns(F.col("file_name"), strict=False)
    dated = links.withColumn("year", year).withColumn("quarter", quarter)
    first = Window.partitionBy("year", "quarter").orderBy("page_id", "link_pos")
    return (
        dated.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1")
        .select(
            "url", "file_name",
            F.format_string("metro-trips-%d-q%d.csv", "year", "quarter").alias("csv_file_name"),
            "year", "quarter",
        )
        .orderBy("year", "quarter")
    )


def require_archives(links: DataFrame) -> DataFrame:
    """``links`` itself; an error when no archive link was found."""
    if links.isEmpty():
        raise ValueError("the pages hold no link to a trip archive")
    return links


def expand_archives(spark: SparkSession, archives: "Sequence[str] | DataFrame", out_dir: str,
                    prefix: str = TRIP_FILE_PREFIX) -> DataFrame:
    """Unpack the first '<prefix>*.csv' member of each archive to
    ``out_dir/<csv_file_name>``; error for an archive without one.

    ``archives`` is a list of archive paths or a DataFrame with ``archive``
    (path) and ``csv_file_name`` columns. Returns one row per archive
    (archive, member, csv_path, bytes); the work runs when it is evaluated.
    Each archive is streamed through one task in bounded memory."""
    if not isinstance(archives, DataFrame):
        rows = []
        for path in archives:
            y, q = trip_file_quarter(path.rsplit("/", 1)[-1], strict=False)
            rows.append((path, f"metro-trips-{y}-q{q}.csv"))
        archives = rows_frame(spark, rows, "archive string, csv_file_name string")
        n = len(rows)
    else:
        n = archives.count()
    target_dir = out_dir.rstrip("/")

    def unpack(batches):
        import posixpath
        import shutil
        import uuid
        import zipfile

        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            out = []
            for archive, csv_name in zip(pdf["archive"], pdf["csv_file_name"]):
                fs, path = pafs.FileSystem.from_uri(archive)
                with fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as zf:
                    members = [n for n in zf.namelist()
                               if posixpath.basename(n).startswith(prefix) and posixpath.basename(n).endswith(".csv")]
                    if not members:
                        raise FileNotFoundError(f"Could not find a trip CSV inside {archive}")
                    target = f"{target_dir}/{csv_name}"
                    tfs, tpath = pafs.FileSystem.from_uri(target)
                    tfs.create_dir(posixpath.dirname(tpath), recursive=True)
                    partial = f"{tpath}.__part-{uuid.uuid4().hex[:8]}"
                    with zf.open(members[0]) as src, tfs.open_output_stream(partial) as dst:
                        shutil.copyfileobj(src, dst, 1 << 20)
                    tfs.move(partial, tpath)
                    out.append((archive, members[0], target, tfs.get_file_info(tpath).size))
            yield pd.DataFrame(out, columns=["archive", "member", "csv_path", "bytes"])

    return archives.repartition(max(1, n)).mapInPandas(
        unpack, "archive string, member string, csv_path string, bytes long")
