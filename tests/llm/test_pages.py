import base64
import hashlib
import os

import pytest
import zstandard

from barline.llm.html_text import extract, render
from barline.llm.warc import read_archives, write_archives


def test_archives_round_trip(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    pages = pages.union(pages.selectExpr("page_id + 100000", "url", "html").limit(20))
    write_archives(pages.repartition(3), f"file://{tmp_path}/a")
    rows = {r.page_id: r for r in read_archives(spark, f"file://{tmp_path}/a").collect()}
    html = {r.page_id: r.html.encode() for r in pages.collect()}
    largest = {}
    for i, body in html.items():
        largest[body] = max(i, largest.get(body, i))
    assert rows.keys() == html.keys()
    for i, body in html.items():
        first = largest[body]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (rows[i].payload_bytes, rows[i].payload_digest) == (len(body), digest)
        assert (rows[i].record_type, rows[i].refers_to) == (("response", None) if first == i else ("revisit", first))
        assert rows[i].payload == (body if first == i else None)


def test_an_archive_is_plain_zstandard_after_its_dictionary(spark, sf, tmp_path):
    write_archives(spark.read.parquet(f"{sf}/pages.parquet").coalesce(1), f"file://{tmp_path}/b")
    part = next(f for f in os.listdir(tmp_path / "b") if f.startswith("part-"))
    data = (tmp_path / "b" / part).read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).stream_reader(data, read_across_frames=True)
    assert reader.read().startswith(b"WARC/1.1\r\n")


def test_odd_pages(spark, tmp_path):
    rows = [(1, "http://a/\r\nb c", "x" * 300_000), (2, None, None), (3, "u", ""), (None, "u", "lost"), (None, None, "lost"), (4, "u", "y"), (4, "u", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'k' as key", "'f' as frame")
    write_archives(pages, f"file://{tmp_path}/c")
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in read_archives(spark, f"file://{tmp_path}/c").collect())
    assert got == sorted([
        ("1", "response", "None", 300_000), ("2", "revisit", "3", 0), ("3", "response", "None", 0), ("None", "response", "None", 4),
        ("None", "response", "None", 4), ("4", "response", "None", 1), ("4", "response", "None", 1),
    ])
    write_archives(pages.limit(0), f"file://{tmp_path}/d")
    assert read_archives(spark, f"file://{tmp_path}/d").count() == 0
    write_archives(pages, f"file://{tmp_path}/e", least_bytes=1)
    assert read_archives(spark, f"file://{tmp_path}/e").filter("record_type = 'revisit'").count() == 0


@pytest.mark.parametrize(
    "page,expected",
    [
        ("<p>One<p>two &amp; <b>three</b>", "One\n\ntwo & three"),
        ("<head><title>T</title>Hello <b>x</b>", "Hello x"),
        ("<head><meta charset=utf-8> \n<title>T</title><span>a<div>b</div></span>c", "a\nb\nc"),
        ("<html><head><script>no</script><img alt=pic>yes", "picyes"),
        ("<head><title>T</title><noscript>no</noscript><style>no</style></head>yes", "yes"),
        ("<title>no</title><style>a</style><body>yes<script>if (a<b) x</script>", "yes"),
        ("<div hidden>no</div><span style='display: none'>no</span><div>yes</div>", "yes"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>after", "- a\n- b\n  3. c\n  4. d\n\nafter"),
        ("<table><tr><th>k<th>value<tr><td>longer<td>1</table>", "k       value\nlonger  1"),
        ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"),
        ("a<br>b<hr>c", "a\nb\n---\nc"),
        ("x <i> y </i> z\n\n w", "x y z w"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("</p>a</b></div><b>c", "ac"),
        ("<img alt='pic'><input type=hidden value=x>", "pic"),
        ("", ""),
    ],
)
def test_rendering(page, expected):
    assert render(page) == expected


def test_deep_and_long_pages():
    assert render("<div>" * 20_000 + "x") == "x"
    assert render("<p>word " * 50_000).count("word") == 50_000


def test_pages_with_odd_rows(spark):
    rows = [(1, "<p>a</p><p>b"), (None, None), (2, ""), (2, "<b>x"), (2, "<b>x")]
    pages = spark.createDataFrame(rows, "page_id long, html string").selectExpr("*", "'t' as text", "1 as id")
    got = sorted((str(r.page_id), r.text, r.n_lines) for r in extract(pages).collect())
    assert got == [("1", "a\n\nb", 3), ("2", "", 0), ("2", "x", 1), ("2", "x", 1), ("None", "", 0)]
    assert extract(pages.limit(0)).count() == 0
