import base64
import hashlib

import pytest
import zstandard

from timewise.llm import warc

from .helpers import same_as_duckdb


def frame(spark, rows):
    """Pages with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, u, h, "x", 1, 2, b"z") for i, u, h in rows],
                                 "page_id long, url string, html string, sha string, n long, least long, payload binary")


def round_trip(spark, tmp_path, rows, **kw):
    folder = str(tmp_path / "archives")
    warc.write_archives(frame(spark, rows), folder, **kw)
    return folder, warc.read_archives(spark, folder).collect()


PAGES = [(1, "http://a.org/x", "<p>one</p>"), (5, "http://a.org/y", "same"), (3, None, "same"), (4, "http://b.org/ü \r\nInjected: 1", "same"),
         (9, "", None), (8, "http://c.org/", ""), (7, "http://c.org/", "é\r\n\r\nx" * 9000), (None, "http://n.org/", "same"), (None, "u", "alone"),
         (11, "http://t.org", "twin"), (11, "http://t.org", "twin"), (12, "http://t.org/2", "twin")]


def test_round_trip(spark, tmp_path):
    _, got = round_trip(spark, tmp_path, PAGES, archive_bytes=600)
    assert len(got) == len(PAGES) and all(r.error is None for r in got)
    least = {}
    for i, _, h in PAGES:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    for i, url, h in PAGES:
        mine = [r for r in got if r.record_id == (None if i is None else str(i)) and r.url == (None if url is None else warc._uri(url))]
        data = (h or "").encode()
        kind = "response" if least.get(h or "", i) == i else "revisit"
        assert any(r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() and r.record_type == kind
                   and r.refers_to == (None if kind == "response" else str(least[h or ""])) and (kind == "revisit" or r.payload == data) for r in mine)
    assert sum(r.record_type == "response" for r in got) == 7


def test_small_payloads_are_all_responses(spark, tmp_path):
    _, got = round_trip(spark, tmp_path, PAGES, min_bytes=5)
    assert all(r.record_type == "response" for r in got)


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, tmp_path, [])[1] == []


def test_file_layout(spark, tmp_path):
    """Dictionary in the leading skippable frame, a frame a record, and a
    file that any Zstandard reader takes as a whole."""
    rows = [(i, f"http://a.org/{i}", f"<html><body class='page'><p>some words of page {i % 90}</p></body></html>" * 3) for i in range(300)]
    folder, got = round_trip(spark, tmp_path, rows, archive_bytes=20_000)
    assert len(got) == 300 and sum(r.record_type == "revisit" for r in got) == 210
    files = [p for p in (tmp_path / "archives").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    for p in files:
        data = p.read_bytes()
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY
        words = data[8:8 + int.from_bytes(data[4:8], "little")]
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        found = list(warc.frames(data))
        assert [d for _, d, _ in found] == [words] * len(found) and len(found) == sum(r.path.endswith(p.name) for r in got)
        whole = b"".join(reader.decompress(f) for _, _, f in found)
        assert whole == reader.stream_reader(data, read_across_frames=True).read()
        assert all(zstandard.get_frame_parameters(f).content_size and zstandard.get_frame_parameters(f).has_checksum for _, _, f in found)


def test_compressed_dictionary_and_no_dictionary():
    words = zstandard.train_dictionary(1024, [f"<p>some page with words {i}</p>".encode() * 4 for i in range(200)]).as_bytes()
    record = warc.record_bytes("1", "http://a.org", b"abc", None, "2020-01-01T00:00:00Z")
    packed = zstandard.ZstdCompressor().compress(words)
    body = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)).compress(record)
    (_, d, f), = warc.frames(warc.skippable(len(packed), warc.DICTIONARY) + packed + body)
    assert d == words and f == body
    streamed = zstandard.ZstdCompressor().compressobj()            # no content size in its header
    (_, d, f), = warc.frames(streamed.compress(record) + streamed.flush())
    assert d is None and zstandard.ZstdDecompressor().decompressobj().decompress(f) == record


@pytest.mark.parametrize("size", [0, 1, 127, 128, 300, 70_000, 300_000])
def test_frame_end(size):
    import os
    for data in (b"a" * size, os.urandom(size)):
        f = zstandard.ZstdCompressor(write_checksum=True).compress(data)
        assert warc.frame_end(f + b"tail of other bytes", 0) == (warc.FRAME, len(f))
        for cut in {1, 5, len(f) // 2, len(f) - 1}:
            with pytest.raises(warc.BadArchive):
                warc.frame_end(f[:cut], 0)


GOOD = warc.record_bytes("1", "http://a.org", b"abc", None, "2020-01-01T00:00:00Z")


@pytest.mark.parametrize("bad,says", [
    (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "version"), (GOOD.replace(b"WARC-Date", b"WARC-Dote"), "warc-date"),
    (GOOD.replace(b"abc", b"abcd"), "block"), (GOOD.replace(b"abc", b"abd"), "digest"), (GOOD[:-4] + b"\n\n\n\n", "block"),
    (GOOD.replace(b"Content-Length: 3", b"Content-Length: 4"), "payload"), (GOOD.replace(b"HTTP/1.1", b"HTPP/1.1"), "status"),
    (GOOD.replace(b"WARC-Date: ", b": "), "name"), (GOOD.replace(b"Content-Length: 3", b"Content-Length: x"), "number"),
    (GOOD.replace(b"WARC-Type: response", b"WARC-Type: revisit\r\nX: y"), "revisit")])
def test_broken_records(bad, says):
    assert warc.parse_record(GOOD)["payload"] == b"abc"
    with pytest.raises(warc.BadArchive, match=says):
        warc.parse_record(bad)


def test_broken_files(spark, tmp_path):
    """A broken frame is reported, and the reader goes on behind it."""
    ok = zstandard.ZstdCompressor(write_checksum=True).compress(GOOD)
    wrong = zstandard.ZstdCompressor(write_checksum=True).compress(GOOD.replace(b"abc", b"abd"))
    flipped = wrong[:-1] + bytes([wrong[-1] ^ 1])
    (tmp_path / "a.warc.zst").write_bytes(ok + wrong + flipped + ok + ok[:-3])
    got = warc.read_archives(spark, str(tmp_path), strict=False).orderBy("offset").collect()
    assert [r.error is None for r in got] == [True, False, False, True, False]
    with pytest.raises(Exception, match="digest differs"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_same_as_duckdb(spark, sf):
    same_as_duckdb(spark, sf, "op13_zstd_warc")
