import os
import zipfile
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from stationflow.operators import manifest as MF
from stationflow.sources import archives as AR


def test_resolve_url_matches_rfc3986(spark):
    bases = ["http://h.example/a/b/page.html?x=1#f", "https://h.example", "http://h.example/dir/"]
    hrefs = ["https://o.example/z.zip", "//cdn.example/p/q.zip", "/data/../files/./metro-trips-2024-q1.zip",
             "?page=2", "#top", "", "sub/../x.zip", "../up.zip", "./here.zip", "g/", ".", ".."]
    rows = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "base string, href string")
    got = [r[0] for r in df.select(AR.resolve_url(F.col("base"), F.col("href"))).collect()]
    assert got == [urljoin(b, h) for b, h in rows]


def test_discover_archives_first_link_per_quarter(spark):
    html = (
        '<html><body><a href="/files/metro-trips-2024-q1.zip">Q1</a>'
        '<A class="x" HREF="metro-trips-2024-q2.zip">Q2</A>'
        '<a href="https://mirror.example/metro-trips-2024-q1.zip">mirror</a>'
        "<a href='/files/metro-trips-2023-4-final.zip'>Q4</a>"
        '<a href="/files/metro-bike-share-stations.csv">stations</a>'
        '<a name="no-href">x</a></body></html>'
    )
    pages = spark.createDataFrame([(1, "https://site.example/about/data/", html)], "page_id long, url string, html string")
    got = [tuple(r) for r in AR.discover_archives(pages).collect()]
    assert got == [
        ("https://site.example/files/metro-trips-2023-4-final.zip", "metro-trips-2023-4-final.zip",
         "metro-trips-2023-q4.csv", 2023, 4),
        ("https://site.example/files/metro-trips-2024-q1.zip", "metro-trips-2024-q1.zip",
         "metro-trips-2024-q1.csv", 2024, 1),
        ("https://site.example/about/data/metro-trips-2024-q2.zip", "metro-trips-2024-q2.zip",
         "metro-trips-2024-q2.csv", 2024, 2),
    ]
    existing = spark.createDataFrame([("metro-trips-2024-q1.csv",)], "csv_file_name string")
    found = AR.discover_archives(pages)
    assert [r["csv_file_name"] for r in MF.select_new(found, existing).orderBy("year", "quarter").collect()] == [
        "metro-trips-2023-q4.csv", "metro-trips-2024-q2.csv"]
    assert tuple(MF.selection_counts(found, existing).first()) == (3, 2, 1)


def test_bad_archive_name_raises(spark):
    pages = spark.createDataFrame([(1, "http://h/", '<a href="/metro-trips-20x4-q1.zip">x</a>')],
                                  "page_id long, url string, html string")
    with pytest.raises(Exception, match="not the name of a quarter.s trip file"):
        AR.discover_archives(pages).collect()


def test_expand_archives(spark, tmp_path):
    good = tmp_path / "metro-trips-2024-q1.zip"
    with zipfile.ZipFile(good, "w") as zf:
        zf.writestr("readme.txt", "x")
        zf.writestr("folder/metro-trips-2024-q1-raw.csv", "trip_id\n1\n")
        zf.writestr("metro-trips-other.csv", "trip_id\n2\n")
    out = tmp_path / "raw"
    rows = AR.expand_archives(spark, ["file://" + str(good)], "file://" + str(out)).collect()
    assert rows[0]["member"] == "folder/metro-trips-2024-q1-raw.csv"
    assert (out / "metro-trips-2024-q1.csv").read_text() == "trip_id\n1\n"
    assert sorted(os.listdir(out)) == ["metro-trips-2024-q1.csv"]
    empty = tmp_path / "metro-trips-2024-q2.zip"
    with zipfile.ZipFile(empty, "w") as zf:
        zf.writestr("readme.txt", "x")
    with pytest.raises(Exception, match="Could not find a trip CSV"):
        AR.expand_archives(spark, ["file://" + str(empty)], "file://" + str(out)).collect()


def test_link_values_follow_html_quoting(spark):
    html = ('<!-- <a href="/commented.zip">x</a> -->'
            '<a data-href="/x.zip" href="/y.zip">1</a><a href="my file.zip">2</a><a href="o\'hara.zip">3</a>'
            "<a title='a > b' HREF = '/q.zip?a=1&amp;b=&quot;2'>4</a><a-b href=\"/no.zip\">5</a><a\nhref=bare.zip>6</a>"
            '<a href="">7</a><a href>8</a>')
    pages = spark.createDataFrame([(1, "http://h/d/", html), (2, "http://h/", None)], "page_id long, url string, html string")
    got = [r["href"] for r in AR.page_links(pages).orderBy("link_pos").collect()]
    assert got == ["/y.zip", "my file.zip", "o'hara.zip", '/q.zip?a=1&b="2', "bare.zip", ""]


def test_no_archive_link_raises(spark):
    pages = spark.createDataFrame([(1, "http://h/", '<a href="/x.csv">x</a>')], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="no link to a trip archive"):
        AR.require_archives(AR.discover_archives(pages))
