"""HTML extraction and WARC archives."""

import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tillroll.llm import html_text, warc


def test_article_is_kept_and_the_rest_dropped():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
    <div id="cookie-notice"><p>We use cookies to improve what you see on this site, please accept them all.</p></div>
    <main><article><header><h1>A &amp; B</h1></header><!-- note --><p>First   paragraph with <b>bold</b> and <a href="#">a link</a>.
    <p>Short.<p>Line<br>break &lt;tag&gt; &eacute;&#x4e2d;</p><ul><li>one<li>two</ul><div class="ad">Buy now</div>
    <aside>Related stories</aside><section class="comments"><p>Great post, I agree with every single word of it.</p></section>
    </article></main><form>Name <input></form><footer>&copy; us</footer></body></html>"""
    assert html_text.main_text(page) == (
        "A & B\nFirst paragraph with bold and a link.\nShort.\nLine break <tag> é中\none\ntwo")


def test_page_without_article_element():
    page = ("<body><div class='top-menu'><a>x</a> <a>y</a></div><div id=story><h2>Head</h2>"
            + "".join(f"<p>Sentence {i} of the story, which goes on for a while.</p>" for i in range(4))
            + "<p>End.</p></div><div class=sidebar><p>A long side remark which is not part of the story at all.</p></div></body>")
    want = "Head\n" + "\n".join(f"Sentence {i} of the story, which goes on for a while." for i in range(4)) + "\nEnd."
    assert html_text.main_text(page) == want


LONG = "<p>A long paragraph of the story, which goes on for quite a while and then some more.</p>"
SAID = "A long paragraph of the story, which goes on for quite a while and then some more."


@pytest.mark.parametrize("page,want", [
    (f"<body><main><h1>Head</h1><article>{LONG}</article><p>x</p><article>{LONG}</article></main></body>", f"Head\n{SAID}\n{SAID}"),
    (f"<body><div class='has-sidebar no-comments'><article>{LONG}</article></div><div>foot</div></body>", SAID),
    (f"<body><div class='sidebar-layout'><main>{LONG}</main></div><div class=sidebar>{LONG}</div><div>foot</div></body>", SAID),
    (f"<body><div class='widget'>{LONG}</div></body>", SAID),
    (f"<body><div id=a><h1>Head</h1>{LONG * 4}</div><article><p>More to read</p></article></body>", "\n".join(["Head"] + [SAID] * 4)),
    (f"<body><article><h1>Head</h1>{LONG}</article><div class=comments>{LONG * 9}</div></body>", f"Head\n{SAID}"),
])
def test_cluster_chooses_the_region(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page,want", [
    (f"<head><title>t</title><body><article>{LONG}</article>", SAID),                       # the head's end tag is optional
    (f"<html><head><title>t<body><p>{LONG}", SAID),
    (f"<head><script>x</script><noscript><img src=a></noscript><meta name=b><p>{LONG}", SAID),
    (f"<body><form id=aspnetForm><div><h1>H</h1>{LONG * 3}</div><input></form></body>", "\n".join(["H"] + [SAID] * 3)),
    (f"<body><form><main><article>{LONG}</article></main></form></body>", SAID),            # a form around the page
    (f"<body><article>{LONG}</article><form>{LONG * 5}</form></body>", SAID),               # and one beside the article
    (f"<body><div>{LONG * 3}<form>{LONG}</form></div></body>", "\n".join([SAID] * 3)),
    (f"<body><div class='article-widget'>{LONG * 3}</div><div>short</div></body>", "\n".join([SAID] * 3)),
    (f"<body><div>{LONG * 2}</div><div class=comments>{LONG * 9}</div></body>", "\n".join([SAID] * 2)),
    (f"<body><div>{LONG * 2}</div><div class='cookie-notice'>{LONG * 9}</div></body>", "\n".join([SAID] * 2)),
])
def test_pages_whose_tags_or_names_mislead(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page", ["<body>" + "<div>some text in a block" * 60_000, "<body>" + "<b>x " * 30_000 + "</i>" * 30_000 + "</section>" * 30_000])
def test_broken_nesting_takes_linear_time(page):
    import time
    start = time.perf_counter()
    assert html_text.main_text(page)
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("page", [None, "", "   ", "<nav>only a menu</nav>", "<p></p>", "<!-- x -->"])
def test_pages_without_content(page):
    assert html_text.main_text(page) == ""


@pytest.mark.parametrize("page", ["plain text", "<p>unclosed", "</p></div>plain", "<p>a<b>c", "<br/><p/>x"])
def test_broken_markup_does_not_fail(page):
    assert html_text.main_text(page)


def test_extract_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "<article><p>x y</p></article>", "t"), (1, None, None), (None, "<p>" + "long " * 50000, "t")],
                               "page_id bigint, html string, text string")
    got = html_text.extract(df).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 249999), (1, 0), (1, 3)]
    assert html_text.extract(df.limit(0)).count() == 0


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def write_and_read(spark, df, folder, **how):
    warc.write(df, folder, **how)
    return warc.read(spark, folder)


def test_round_trip_of_given_pages(spark, scratch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {str(r.page_id): r.html for r in df.collect()}
    got = write_and_read(spark, df, f"{scratch}/w", roll_bytes=20_000).collect()
    assert len(got) == len(html)
    for r in got:
        assert r.payload_digest == digest(html[r.page_id]) and r.payload_bytes == len((html[r.page_id] or "").encode())
        assert r.record_type == "revisit" or bytes(r.payload).decode() == (html[r.page_id] or "")
    files = warc.manifest(spark, f"{scratch}/w").collect()
    assert len(files) > 1 and sum(f.records for f in files) == len(html)
    assert not [x for x in os.listdir(f"{scratch}/w") if x.startswith("_tmp")]


def test_copies_nulls_and_repeats(spark, scratch):
    rows = [(5, "u", "same"), (2, "u", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (7, "u", "own"), (7, "u", "own"),
            (None, "u", "lone"), (8, "u\n v", "é" * 100_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("refers_to", F.lit("clash"))
    got = sorted((r.page_id, r.record_type, r.refers_to or "") for r in write_and_read(spark, df, f"{scratch}/w").collect())
    assert got == [("", "response", ""), ("2", "response", ""), ("3", "response", ""), ("4", "revisit", "3"), ("5", "revisit", "2"),
                   ("7", "response", ""), ("7", "revisit", "7"), ("8", "response", ""), ("9", "revisit", "2")]
    long = write_and_read(spark, df, f"{scratch}/x", least_bytes=4).filter("record_type = 'revisit'").collect()
    assert sorted(r.page_id for r in long) == ["5", "9"]


def test_same_rows_give_the_same_bytes_in_any_order(spark, scratch):
    df = spark.createDataFrame([(i, f"u{i}", "x" * (i % 50)) for i in range(500)], "page_id bigint, url string, html string")
    one = warc.write(df.coalesce(1), f"{scratch}/a", roll_bytes=5000)
    two = warc.write(df.orderBy(F.rand(1)).coalesce(1), f"{scratch}/b", roll_bytes=5000)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_reader_trusts_only_the_manifest(spark, scratch):
    df = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    warc.write(df, f"{scratch}/w")
    name = warc.manifest(spark, f"{scratch}/w").first().file
    with open(f"{scratch}/w/part-99999-00000.warc.gz", "wb") as f:
        f.write(b"left over")
    assert warc.read(spark, f"{scratch}/w").count() == 1
    with open(f"{scratch}/w/{name}", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="differs"):
        warc.read(spark, f"{scratch}/w").collect()
    os.remove(f"{scratch}/w/{name}")
    with pytest.raises(ValueError, match="missing"):
        warc.read(spark, f"{scratch}/w")


def test_empty_table(spark, scratch):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert write_and_read(spark, df, f"{scratch}/w").count() == 0
