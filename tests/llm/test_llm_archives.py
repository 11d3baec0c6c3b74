"""WARC bundles: exact round trip, revisits, single records by index."""

import base64
import hashlib

import zstandard

from offermill.llm import warc
from offermill.session import scratch_path

PAGES = [
    (1, "http://a.example/x?q=1&r=%20 ü", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b.example", None), (4, "", ""),
    (5, "line\r\nbreak", "text\r\n\r\nWARC/1.1\r\n"), (6, "u", "é漢" * 3000), (7, "u", "<p>one</p>"), (7, "u", "<p>one</p>"),
    (None, "v", "<p>one</p>"), (None, "w", "alone"),
]


def _want(pages, least=0):
    out = []
    for page, url, html in pages:
        payload = (html or "").encode()
        twins = [p for p, _, h in pages if (h or "").encode() == payload and p is not None]
        revisit = len(payload) >= least and bool(twins) and page != max(twins)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "revisit" if revisit else "response"
        out.append((page, len(payload), digest, kind, max(twins) if revisit else None, url, None if revisit else payload))
    return sorted(out, key=str)


def _frame(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string").withColumnRenamed("x", "x")


def _rows(df):
    return sorted(((*r[:6], None if r[6] is None else bytes(r[6])) for r in df.collect()), key=str)


def test_round_trip(spark):
    assert _rows(warc.round_trip(_frame(spark, PAGES))) == _want(PAGES)
    assert _rows(warc.round_trip(_frame(spark, PAGES), min_revisit=5)) == _want(PAGES, 5)
    assert warc.round_trip(_frame(spark, [])).count() == 0


def test_records_by_index(spark):
    folder = scratch_path(spark, "warc-test")
    pages = [(k, f"http://h/{k}", f"page {k} " * 50) for k in range(200)]
    index = warc.write_bundles(_frame(spark, pages), folder, frame_bytes=2000, bundle_bytes=4000)
    assert index.select("bundle").distinct().count() > 3
    wanted = spark.createDataFrame([(3,), (77,), (150,), (999,)], "page_id long")
    got = _rows(warc.read_pages(spark, folder, index, wanted))
    assert got == _want([p for p in pages if p[0] in (3, 77, 150)])


def test_bundle_is_plain_zstandard(spark):
    folder = scratch_path(spark, "warc-plain")
    index = warc.write_bundles(_frame(spark, PAGES), folder, frame_bytes=500)
    for row in spark.read.format("binaryFile").load(folder).collect():
        data = bytes(row.content)
        with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as reader:
            plain = reader.read()
        frames = warc.frames_of(data)
        assert len(plain) == sum(size for _, _, size in frames) and plain.startswith(b"WARC/1.1\r\n")
        assert frames[-1][0] + frames[-1][1] + 8 + 9 + 8 * len(frames) == len(data)
    assert index.count() == len(PAGES)
