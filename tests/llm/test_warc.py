"""WARC archives: exact round trip, format and revisits."""

import hashlib
import os
import random
import struct

import zstandard

from cinerank.llm import warc
from tests.llm.conftest import prose


def page(rng, n):
    return "<html><body>" + prose(rng, n) + " é</body></html>"


def test_round_trip_and_revisits(spark, tmp_path):
    rng = random.Random(16)
    same = page(rng, 300)
    rows = [(i, f"http://x/{i}", page(rng, rng.randint(1, 400)), "clash") for i in range(120)]
    rows += [(200 + i, "http://y", same, "clash") for i in range(30)]
    rows += [(300, None, None, "c"), (301, "u", "", "c"), (302, "u\r\nWARC-Type: x", "tiny", "c"), (303, "u", "tiny", "c"),
             (None, "u", same, "c"), (304, "u", "x" * 999, "c"), (305, "u", "x" * 999, "c"), (306, "u", "é" * 500, "c"),
             (307, "u", "é" * 500, "c"), (308, "u", "big " * 300_000, "c"), (309, "u", same + "!", "c"), (309, "u", same + "!", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(warc.mark_revisits(df), folder, archive_bytes=50_000)
    assert manifest.count() > 1 and {r.path for r in manifest.collect()} == set(os.listdir(tmp_path / "a"))
    (tmp_path / "a" / "pages-of-a-lost-attempt.warc.zst").write_bytes(b"junk")  # in no manifest
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    html = {i: (h or "").encode() for i, _, h, _ in rows}
    last = {}
    for i, _, h, _ in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(i, last.get(h, i))
    for r in got:
        raw = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        target = last.get(raw.decode())
        if target is not None and r.page_id != target:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", target, None)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, raw)
    assert {r.url for r in got if r.page_id == 302} == {"u%0D%0AWARC-Type: x"}
    assert [r.url for r in got if r.page_id == 300] == [None]


def test_archive_format():
    rng = random.Random(17)
    records = [warc.record(i, f"http://x/{i}", page(rng, 120).encode(), "00" * 20, None) for i in range(60)]
    data = warc.encode_archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    raw = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    own = zstandard.ZstdCompressionDict(raw)
    assert own.dict_id() > 0
    first = zstandard.get_frame_parameters(data[8 + size:])
    assert first.dict_id == own.dict_id() and first.content_size == len(records[0])
    assert list(warc.decode_archive(data)) == records
    assert len(data) < sum(len(zstandard.compress(r)) for r in records)


def test_archives_of_few_or_uniform_records_have_a_dictionary():
    """Where training isn't possible the dictionary is raw content; any reader starts at any record."""
    rng = random.Random(19)
    make = lambda i, n: warc.record(i, f"http://x/{i}", page(rng, n).encode(), "00" * 20, None)
    few, one = [make(i, 120) for i in range(5)], [make(1, 30)]
    uniform = [b"a" * 4000] * 40
    for records in (few, one, uniform, [make(i, 40_000) for i in range(3)]):
        data = warc.encode_archive(records)
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D and 0 < size < 1 << 17
        raw = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
        own = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        assert own.decompressobj().decompress(data[8 + size:]) == records[0]
        assert list(warc.decode_archive(data)) == records


def test_few_records_need_no_dictionary():
    assert list(warc.decode_archive(warc.encode_archive([b"one", b"", b"three"]))) == [b"one", b"", b"three"]
    assert list(warc.decode_archive(b"")) == []


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
