"""Vectors for text, HTML and date functions."""

import email.utils
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from webtide.functions import dates, text
from webtide.functions.outcome import is_permanent
from webtide.params import Params


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip(spark):
    cases = ["\x1c a b  　", "\n\n", "a", "", "​x​", " \x85a\x0b", "a \nb\r\n"]
    assert run(spark, text.strip, cases) == [c.strip() for c in cases]


def test_html_to_text(spark):
    cases = {
        "<p>a&amp;b</p><p>c&lt;d&#62;e&#x41;</p>": "a&b c<d>eA",
        "<!-- <p>x</p> -->a<script>var t='</p>';</script>b<style>p{}</style>c": "a b c",
        "a&nbsp;&nbsp;b\n\t c": "a b c",
        "&amp;lt; &#38;gt; &#128512; &#0; &#xD800;": "&lt; &gt; \U0001f600 � �",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "a &#x26;lt;b &amp;eacute; caf&eacute; &#000000065; &#146; &hellip;&nosuch; &": "a &lt;b &eacute; caf\u00e9 A \u2019 \u2026&nosuch; &",
        '<a title="x>y">k</a>': "k",
        "<script>never closed": "",
        "&#; &#x; &#12": "&#; &#x; &#12",
        "": "",
    }
    assert run(spark, text.html_to_text, cases) == list(cases.values())


def test_strip_hidden(spark):
    hid = '<div class="x" style="Display : none;">'
    cases = {
        f"a{hid}b<div>c</div>d</div>e": "ae",
        f"a<div>{hid}b</div>c</div>d": "a<div>c</div>d",
        f"a{hid}b</div>{hid}c{hid}d</div></div>e": "ae",
        "<div style='color:red'>a</div>": "<div style='color:red'>a</div>",
        "<div style=display:none>a</div>b": "b",
        "<p style='display:none'>a</p>": "<p style='display:none'>a</p>",
        f"a<!-- {hid} -->b<script>'{hid}'</script>c": f"a<!-- {hid} -->b<script>'{hid}'</script>c",
        f"a{hid}<!-- </div> --><script>'</div>'</script>b</div>c": "ac",
        f"a{hid}never closed": "a",
        "<DIV STYLE='DISPLAY:NONE'>a</DIV>b": "b",
        '<div title="use style=display:none here">a</div>': '<div title="use style=display:none here">a</div>',
        "<div id=x title='a>b'style='display:none'>a</div>b": "b",
        "<div hidden>a</div><div data-style='display:none'>b</div>": "<div hidden>a</div><div data-style='display:none'>b</div>",
        "</div></div><div style='dis play:none'>x</div>y": "</div></div>y",
        "<divx style='display:none'>a</divx>": "<divx style='display:none'>a</divx>",
        "": "",
    }
    assert run(spark, text.strip_hidden, cases) == list(cases.values())


def test_references_like_the_standard_library(spark):
    import html
    import random

    r = random.Random(8)
    parts = ["&amp;", "&lt;", "&eacute;", "&#233;", "&#xE9;", "&#146;", "&copy;", "a", ";", "& ", "lt;", "#38;", "&#0065;", "&quot;"]
    cases = ["".join(r.choice(parts) for _ in range(8)) for _ in range(400)]
    # the library also reads some names without their end
    cases = [c for c in cases if not __import__("re").search(r"&#?[a-z0-9]+(?![a-z0-9]*;)", c, 2)]
    assert len(cases) > 100
    assert run(spark, text.unescape, cases) == [html.unescape(c) for c in cases]


@pytest.mark.parametrize("size,overlap", [(5, 2), (4, 0), (7, 6), (1, 0), (3, 1)])
def test_chunks(spark, size, overlap):
    values = ["", "a", "abcde", "abcdefghij", "\U0001f600" * 11, "x" * 6 + "yz", "0123456789" * 97]
    step = size - overlap
    want = [
        [v[s:s + size] for s in range(0, len(v), step) if s == 0 or s + overlap < len(v)] for v in values
    ]
    assert run(spark, lambda c: text.chunks(c, size, overlap), values) == want


def test_chunk_bounds():
    for bad in ((4, 4), (4, 5), (0, 0)):
        with pytest.raises(ValueError):
            text.chunks(F.col("x"), *bad)
        with pytest.raises(ValueError):
            Params(chunk_size=bad[0], chunk_overlap=bad[1])


def test_chunk_filter(spark):
    good = lambda src: lambda c: text.is_good_chunk(c, F.lit(src), 3)
    cases = {
        "ab": (False, False),
        "aaa": (False, True),
        "a a a": (False, True),
        "   ": (True, True),
        "(cid:12) \n(cid:3)": (False, True),
        "x (cid:1) y": (True, True),
        "...a": (True, True),
        "$$$": (False, True),
    }
    assert run(spark, good("http://x/A.PDF"), cases) == [p for p, _ in cases.values()]
    assert run(spark, good("http://x/a.html"), cases) == [h for _, h in cases.values()]


def test_empty_content(spark):
    cases = [
        (None, True), ("", True), (" " * 200 + "x", True), ("x" * 100, False),
        ("<TITLE>Access Denied</title>" + "x" * 100, True),
        ("CAPTCHA" + "x" * 2992, True), ("CAPTCHA" + "x" * 2993, False),
    ]
    assert run(spark, text.is_empty_content, [c for c, _ in cases]) == [w for _, w in cases]


ISO = {
    "2024-01-05": 1704412800, " 2024-1-5 ": 1704412800, "2024-01-05T03:04:05Z": 1704423845,
    "2024-01-05T03:04:05+0100": 1704420245, "2024-01-05T03:04:05+01:00": 1704420245,
    "2024-01-05T03:04:05": 1704423845, "2024-01-05T03:04:05.5Z": None, "2024-01-05T03:04Z": None,
    "2024-02-30": None, "2024-001-05": None, "x": None, "": None, "2024-01-05T03:04:05-00:30": 1704425645,
    "2024-01-05T24:00:00": None, "24-01-05": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_iso(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert run(spark, lambda c: F.unix_seconds(dates.parse_iso(c)), ISO) == list(ISO.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_http_date(spark):
    good = [
        "Wed, 21 Oct 2015 07:28:00 GMT", "21 Oct 2015 07:28:00 GMT", "Wed, 21 Oct 2015 07:28:00 +0200",
        "Wed, 21 Oct 2015 07:28:00 -0000", "Wed, 1 Oct 2015 7:28 EST", "Sunday, 06-Nov-94 08:49:37 GMT",
        "Sun Nov  6 08:49:37 1994", "Wed, 21 Oct 15 07:28:00 UTC",
    ]
    want = []
    for g in good:
        d = email.utils.parsedate_to_datetime(g)
        want.append(int((d if d.tzinfo else d.replace(tzinfo=timezone.utc)).timestamp()))
    bad = ["yesterday", "", "32 Oct 2015 00:00:00 GMT", None]
    got = run(spark, lambda c: F.unix_seconds(dates.parse_http_date(c)), good + bad)
    assert got == want + [None] * len(bad)


def test_changefreq(spark):
    values = ["Always", "hourly", "DAILY", "weekly", "monthly", "yearly", "never", "", None]
    assert run(spark, dates.changefreq_seconds, values) == [
        0, 3600, 86400, 604800, 2592000, 31536000, None, None, None
    ]


def test_permanent(spark):
    values = ["HTTP 404", "Not Found", "timeout", "bad Request x", "http://e.com/400", "is not supported", "500"]
    assert run(spark, is_permanent, values) == [True, True, False, True, True, True, False]
