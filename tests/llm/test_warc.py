import struct

import zstandard

from auric.llm import warc as m
from auric.session import scratch_path
from tests.llm.conftest import PAGES, SF, multiset, table


def brute(pages, least=0):
    last = {}
    for i, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    for i, h in pages:
        raw = (h or "").encode()
        to = last.get(h or "") if len(raw) >= least else None
        first = to is None or to == i
        yield i, len(raw), m.digest32(raw), "response" if first else "revisit", None if first else to


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def edge_pages():
    return [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (2, "u", "<p>x</p>"),
            (None, "u", "<p>x</p>"), (None, "u", "only null ids"), (None, "u", "only null ids"),
            (3, "sp ace\r\nWARC-Type: x", None), (4, "u", ""), (5, "é漢", "é漢\r\n\r\nWARC/1.1\r\n"),
            (-7, "u", "y" * 400_000), (8, "u", "\x00\x01")]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", 1, 2, "t") for i, u, h in rows], PAGES)


def test_round_trip(spark):
    pages = table(spark, "pages").collect()
    got = m.op3_warc(spark, SF).select(COLUMNS).collect()
    assert multiset(got) == multiset(brute([(r.page_id, r.html) for r in pages]))


def test_payloads_come_back(spark):
    folder = scratch_path(spark, "warc")
    pages = frame(spark, edge_pages()).repartition(3, "url")
    manifest = m.write_warc(pages, folder, archive_bytes=1000)
    back = m.read_warc(manifest).collect()
    assert multiset((*(r[c] for c in COLUMNS),) for r in back) == multiset(
        brute([(i, h) for i, _, h in edge_pages()]))
    assert manifest.count() > 3
    bodies = multiset((r.page_id, bytes(r.payload)) for r in back if r.record_type == "response")
    assert (5, "é漢\r\n\r\nWARC/1.1\r\n".encode()) in bodies and (-7, b"y" * 400_000) in bodies
    assert all(r.payload is None for r in back if r.record_type == "revisit")
    assert {r.url for r in back if r.page_id == 3} == {"sp%20ace%0D%0AWARC-Type:%20x"}


def test_small_payloads_can_stay_responses(spark):
    manifest = m.write_warc(frame(spark, edge_pages()), scratch_path(spark, "warc"), min_bytes=9)
    got = m.read_warc(manifest, payload=False).select(COLUMNS).collect()
    assert multiset(got) == multiset(brute([(i, h) for i, _, h in edge_pages()], 9))


def test_archive_layout(tmp_path):
    """A leading skippable frame with the dictionary; each record a frame that needs
    only the dictionary."""
    records = [m.record(k, "u", (f"<p>page {k}</p>" * 50).encode(), None) for k in range(300)]
    path, n, size = m.write_archive(str(tmp_path), records)
    raw = open(path, "rb").read()
    magic, length = struct.unpack("<II", raw[:8])
    assert (magic, n, size) == (0x184D2A5D, 300, len(raw))
    known = zstandard.ZstdCompressionDict(raw[8:8 + length])
    assert known.dict_id() != 0                      # trained, not raw content
    rest, found = raw[8 + length:], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
        found.append(one.decompress(rest))
        rest = one.unused_data
    assert found[1:] == records and found == list(m.read_archive(path))
    assert m.parse(found[0])[0]["WARC-Type"] == "warcinfo"


def test_too_few_records_for_training(tmp_path):
    records = [m.record(1, "u", b"", None)]
    path, _, _ = m.write_archive(str(tmp_path), records)
    assert list(m.read_archive(path))[1:] == records


def test_damage_is_noticed(spark):
    folder = scratch_path(spark, "warc")
    bad = m.record(1, "u", b"payload", None).replace(b"payload", b"PAYLOAD")
    path, n, size = m.write_archive(folder, [bad])
    manifest = spark.createDataFrame([(path, n, size)], "path string, records bigint, bytes bigint")
    try:
        m.read_warc(manifest).collect()
    except Exception as e:                           # raised in a task
        assert "damaged" in str(e)
    else:
        raise AssertionError("not noticed")


def test_empty_table(spark):
    manifest = m.write_warc(frame(spark, []), scratch_path(spark, "warc"))
    assert m.read_warc(manifest).collect() == []
