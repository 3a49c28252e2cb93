"""WARC archives and main-text extraction."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json

import pytest

from wreckline.llm.html_text import extract_main_text, main_blocks, smoothed, threshold
from wreckline.llm.registry import op1_warc
from wreckline.llm.warc import inflate, normalise_archives, read_archives, split_records, write_archives

SF = "/root/testdata/sf0.001"
PAGES = [
    (5, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://b\r\nX: y", ""),
    (3, "http://c", None), (4, "http://d", "é\r\n\r\nWARC/1.1\r\n" * 3), (6, "u", "x" * 3_000_000), (7, "u", "solo"),
    (None, "n", "<p>same</p>"),
]


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def expected(pages):
    first = {}
    for i, _, h in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault((h or "").encode(), i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        refers = first.get(raw) if i is not None and first.get(raw) != i else None
        out.append((i, len(raw), digest(raw), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def fields(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 3])
def test_archives_come_back_whole(spark, tmp_path, parts):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(parts)
    files = write_archives(df, str(tmp_path))
    index = normalise_archives(files)
    back = read_archives(index)
    assert fields(back) == expected(PAGES)
    assert back.where("NOT digest_ok").count() == 0
    whole = 0
    for f in files.collect():
        raw = gzip.open(f.path).read()
        whole += len(list(split_records(iter([raw]))))
        member = f.path.removesuffix(".warc.gz") + ".members.warc.gz"
        assert gzip.open(member).read() == raw  # the same records, as members
        entries = [json.loads(x) for x in open(member.removesuffix(".warc.gz") + ".idx")]
        data = open(member, "rb").read()
        assert all(gzip.decompress(data[a:a + n]).startswith(b"WARC/1.1\r\n") for a, n, *_ in entries)
        assert sum(n for _, n, *_ in entries) == len(data)
    assert whole == len(PAGES)
    assert not [p for p in tmp_path.iterdir() if ".part" in p.name]


def test_least_revisit_size_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    back = read_archives(normalise_archives(write_archives(df, str(tmp_path), min_revisit_bytes=1)))
    kinds = {r.page_id: r.record_type for r in back.collect()}
    assert kinds[1] == kinds[3] == "response" and kinds[5] == "revisit"
    assert read_archives(normalise_archives(write_archives(df.limit(0), str(tmp_path / "none")))).count() == 0


def test_query_matches_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert fields(op1_warc(spark, SF)) == expected(pages)


def test_stream_pieces_do_not_matter():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    packed = gzip.compress(record * 3) + gzip.compress(record)
    for n in (1, 7, 1000):
        chunks = (packed[i:i + n] for i in range(0, len(packed), n))
        assert [r for _, r in split_records(inflate(chunks))] == [record] * 4
    with pytest.raises(ValueError):
        list(split_records(iter([record[:-6]])))


ARTICLE = "<article><h1>Head &amp; line</h1><p>First paragraph with\n  enough words in it to count.</p><p>Ok.</p><p>Last &#233;nd.</p></article>"
CASES = {
    f"<html><head><title>T</title><script>var a='<p>x</p>'</script></head><body><nav><a>m</a></nav>{ARTICLE}<footer>f</footer>":
        ["Head & line", "First paragraph with enough words in it to count.", "Ok.", "Last énd."],
    f"<body><div class='ad'>Buy this now it is a very good product for you</div><aside>side bar text</aside>{ARTICLE}"
    "<section id=comments><p>I think this comment is long enough to look like text.</p></section>":
        ["Head & line", "First paragraph with enough words in it to count.", "Ok.", "Last énd."],
    "<div id=top><ul><li><a>a</a><li><a>b</a></ul></div><div><p>The body of a page without an article element, long enough.<p>Two.</div>":
        ["The body of a page without an article element, long enough.", "Two."],
    "<article><p><b>bold text here<br>goes on<p>next one": ["bold text here goes on", "next one"],
    "<form><p>only a form</p></form>": [], "": [], "   ": [], "plain text only": ["plain text only"],
    "<article><p>cut &am": ["cut &am"],
}


def test_main_text_of_fixture_pages():
    for html, blocks in CASES.items():
        assert main_blocks(html) == blocks, html


def test_extraction_of_a_table(spark):
    rows = [(i, f"u{i}", h, 1) for i, h in enumerate(CASES)] + [(100, None, None, 1), (0, "u0", next(iter(CASES)), 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT int")
    got = sorted(extract_main_text(df).collect(), key=lambda r: r.page_id)
    assert len(got) == len(rows)
    for r in got:
        want = "\n".join(list(CASES.values())[r.page_id]) if r.page_id < 100 else ""
        assert r.text == want and r.n_chars == len(want)
    assert extract_main_text(df.limit(0)).count() == 0
    long = "<article>" + "<p>word and word again</p>" * 20_000 + "</article>"
    assert len(main_blocks(long)) == 20_000


def test_smoothing_and_clusters():
    assert smoothed([3.0]) == [3.0]
    assert smoothed([2.0] * 6) == pytest.approx([2.0] * 6)
    assert 1 < threshold([1, 1, 2, 90, 100]) < 90
    assert threshold([5.0, 5.0]) == 5.0


