"""HTML extraction and WARC archives."""

import hashlib
import os
import struct
import time

import pytest
import zstandard

from rivulet.llm import html_text, warc
from rivulet.llm.html_text import main_text
from tests.conftest import SF_SMALL

LONG = "A paragraph of some length, with commas, about things that matter, and more of it."
PAGES = [
    (None, ""), ("", ""), ("plain   text\n here", "plain text here"),
    ("<p>a &lt; b &amp;amp; &#233; &nbsp;c<div>x<p>y", "a < b &amp; é c\n\nx\n\ny"),
    ("<script>if(a<b){'</p>'}</script>x<style>p{}</style> y<!-- <p>no --> z", "x y z"),
    ("<ul><li>one<li>two <b>bold</b>\n\n</ul>", "one\n\ntwo bold"),
    ("<article><h1>T</h1><header>h</header><p>p1</p><aside>a</aside><form>f</form><p>p2</article>"
     "<footer>f</footer>", "T\n\np1\n\np2"),
    (f"<body class='has-sidebar'><div class=menu><a href=1>m</a></div><div id=content><h2>H</h2>"
     f"<p>{LONG}</p><p>s</p></div><div class='site-footer'>c</div><div class=comment-list><p>{LONG}"
     f"</p></div>", f"H\n\n{LONG}\n\ns"),
    (f"<div id=main><div><p>{LONG}</p></div><div><p>{LONG}{LONG}</p></div></div>"
     f"<div class='cookie-notice'>{LONG}</div><div class=ad>buy</div>", f"{LONG}\n\n{LONG}{LONG}"),
    (f"<main><p>{LONG}</p><ul><li><a href=1>aaa</a><li><a href=2>bbb</a><li><a href=3>ccc</a>"
     f"</ul><p hidden>{LONG}</p><table><tr><td>1<td>2</table></main>", f"{LONG}\n\n1\n\n2"),
    ("<article><p>short</article><nav>" + "<a href=1>link text, much longer</a>" * 9, "short"),
    ("<a title='x>y' href=\"a'b\">q</a> r <img alt='>'> s", "q r s"),
    ("<p>unclosed <b>bold<p>next <!-- open", "unclosed bold\n\nnext"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_main_text(html, text):
    assert main_text(html) == text


STORY = "<p>A long story, told in full, with more than a few words in it.</p>" * 3
TOLD = "\n\n".join(["A long story, told in full, with more than a few words in it."] * 3)


@pytest.mark.parametrize("html", [
    f"<div class='layout sidebar-right'><article>{STORY}</article></div><p>Rest of page</p>",
    f"<form action=x><div><main>{STORY}</main></div></form>",
    f"<form>{STORY}</form>",
    f"<section id=discussion><article>{STORY}</article></section><div class=ad>Buy</div>",
    f"<div>{STORY}</div><aside><article><p>Another post, a teaser of it only.</p></article></aside>",
    f"<article>{STORY}</article><section class=comments><article><p>I do not agree with this, "
    f"not at all, not one word.</p></article></section>",
    f"<div>{STORY}</div><form><p>Your name, your mail, your opinion on all of this.</p></form>",
    f"<div>{STORY}</div><div style='display:none'><article><p>Hidden.</p></article></div>",
])
def test_wrappers_do_not_take_the_article(html):
    assert main_text(html) == TOLD


def test_long_and_deep_pages():
    assert main_text("<div>" * 30000 + "deep") == "deep"
    words = " ".join(f"w{k}" for k in range(60000))
    assert main_text(f"<article><p>{words}</p></article>") == words


@pytest.mark.parametrize("opening, closing", [
    ("<div>", "</div>"), ("<span><div>", "</p></b></i>"), ("<ul><li>", "</li></ul>")])
def test_time_grows_with_the_page_not_with_its_depth(opening, closing):
    """20,000 nested blocks with text of their own; closings that match nothing."""
    html = (opening + "words of a block, and more of them") * 20000 + closing * 20000
    began = time.process_time()
    text = main_text(html)
    assert time.process_time() - began < 2
    assert text.count("words of a block") == 20000


def plain_points(page):
    """Points of every element, each block handing its score up on its own."""
    points = {}
    for (k, text, in_links) in page.blocks:
        score = 1 + text.count(",") + min(len(text) / 100, 3) if len(text) >= 25 else len(text) / 50
        score *= 1 - min(1.0, in_links / len(text))
        box = page.parent[k] if page.tag[k] in html_text.PARAGRAPHS else k
        for level, e in enumerate(page.above(box)):
            points[e] = points.get(e, 0) + score * (
                1 if not level else 0.5 if level == 1 else (2 / 3) ** (level - 2) / 6)
    return points


def test_points_are_those_of_a_walk_per_block(spark):
    pages = spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet")).collect()
    for row in pages:
        page = html_text._Page(row["html"] or "", by_name=True)
        got, want = page.points()[0], plain_points(page)
        assert got == pytest.approx([want.get(e, 0) for e in range(len(got))])


def test_extract_keeps_every_row(spark):
    pages = spark.createDataFrame([(k, "u", h, 1, "t") for k, (h, _) in enumerate(PAGES)]
                                  + [(None, None, "x", 1, "t"), (0, "u", None, 1, "t")],
                                  "page_id long, url string, html string, n_chars int, text string")
    got = html_text.extract(pages).collect()
    assert len(got) == len(PAGES) + 2
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] is not None:
            assert r["text"] == PAGES[r["page_id"]][1]
    assert html_text.extract(pages.limit(0)).count() == 0


# --- archives --------------------------------------------------------------------------

def test_round_trip_matches_plain_python(spark):
    rows = [(3, "u3", "same"), (1, "u1", "same"), (2, None, None), (7, "u7", ""), (5, "u\n5", "é" * 9),
            (6, "u6", "x" * 3_000_000), (1, "u1", "same"), (None, "n", "same"), (8, "u8", "<p>")]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows],
                                  "page_id long, url string, html string, sha1 string, n int")
    for least in (0, 1):
        got = sorted((r.asDict() for r in warc.round_trip(pages, least).collect()), key=str)
        first = {}
        for i, _, h in rows:
            b = (h or "").encode()
            if i is not None and len(b) >= least:
                first[b] = min(i, first.get(b, i))
        want = []
        for i, u, h in rows:
            b = (h or "").encode()
            refers = first.get(b) if b in first and i != first[b] else None
            want.append({"page_id": i, "url": "".join((u or "").splitlines()),
                         "record_type": "response" if refers is None else "revisit",
                         "payload_bytes": len(b), "payload_digest": warc.digest(b),
                         "refers_to": refers, "payload": b if refers is None else None})
        for g in got:
            g["payload"] = None if g["payload"] is None else bytes(g["payload"])
        assert got == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive():
    records = [warc.encode_record(k, "u", f"page {k} ".encode() * 50, warc.digest(
        f"page {k} ".encode() * 50), None) for k in range(30)]
    return warc.encode_archive(records, records), records


def test_archive_layout():
    data, records = archive()
    assert struct.unpack_from("<I", data)[0] == warc.DICTIONARY_FRAME
    dictionary, at = warc.load_dictionary(data)
    assert dictionary is not None
    assert list(warc.decode_archive(data)) == records
    one = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(
        data[at:warc.frame_end(data, at)])
    assert one == records[0]  # one frame holds one record
    plain = b"".join(zstandard.ZstdCompressor().compress(r) for r in records[:3])
    assert list(warc.decode_archive(plain)) == records[:3]  # no dictionary frame
    assert list(warc.decode_archive(b"")) == []


def test_bad_archives_are_refused():
    data, records = archive()
    for bad in (data[:-3], data[:20], data + b"xx", data[:200] + b"\0" + data[201:]):
        with pytest.raises(warc.WarcError):
            list(warc.decode_archive(bad))
    r = records[0]
    for bad in (r[:-1], r.replace(b"page 0", b"page 9"), r.replace(b"WARC/1.1", b"WARX/1.1"),
                r.replace(b"WARC-Type", b"WARC-Kind"), b""):
        with pytest.raises(warc.WarcError):
            warc.decode_record(bad)


def test_archives_are_read_from_files(spark, tmp_dir):
    data, records = archive()
    with open(os.path.join(tmp_dir, "a.warc.zst"), "wb") as f:
        f.write(data)
    files = spark.read.format("binaryFile").load(tmp_dir)
    got = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(files).collect()}
    assert got == {k: f"page {k} ".encode() * 50 for k in range(30)}


def test_digest_column_is_base32(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = pages.select("html", warc.base32_sha1(pages["html"].cast("binary")).alias("d")).collect()
    for r in rows:
        assert r["d"] == warc.digest(r["html"].encode()) and len(r["d"]) == 32
        assert hashlib.sha1(r["html"].encode()).digest()
