import hashlib
import os
import zlib

import pytest

from tessera.llm import op6_warc as m


def pages(spark):
    body = "<p>" + "é" * 80 + "</p>"
    rows = [(5, "http://a.example/1", body), (3, "http://a.example/2\r\nX: y", body), (9, None, body), (1, "u", None),
            (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", "x" * 300_000), (None, "u", body),
            (8, "u", "\x1f\x8b\x08" * 50), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("split", [1, 1000, 1 << 22])
def test_round_trip_at_any_split(spark, scratch, split):
    src = pages(spark)
    folder = scratch("warc")
    archives = m.write_archives(spark, src.coalesce(2), folder)
    if split == 1:   # every byte a range of its own: small archives only
        src = src.filter("length(coalesce(html, '')) < 1000")
        folder = scratch("warc")
        archives = m.write_archives(spark, src.coalesce(1), folder)
    got = m.read_archives(archives, split_bytes=split).collect()
    html = {r.page_id: (r.html or "").encode() for r in src.collect()}
    assert sorted(str(r.page_id) for r in got) == sorted(map(str, html))
    for r in got:
        body = html[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert r.payload == (None if r.record_type == "revisit" else body)
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {5: 3, 9: 3, None: 3}
    listed = {(r.path.split("/")[-1], r.bytes) for r in m.list_archives(spark, folder).collect()}
    assert {(r.path.split("/")[-1], r.bytes) for r in archives.collect()} <= listed


def test_member_inside_a_member_is_no_record(tmp_path):
    inner = m.record("response", {"WARC-Record-ID": "<urn:page:1>"}, b"inner")
    squeeze = zlib.compressobj(0, zlib.DEFLATED, 31)   # stored: the inner member's bytes appear as they are
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(inner)
    outer = squeeze.compress(head + inner + b"\r\n\r\n") + squeeze.flush()
    path = os.path.join(tmp_path, "x.warc.gz")
    with open(path, "wb") as f:
        f.write(b"junk" + outer + m.record("response", {}, b"last"))
    found = [(at, content is None) for s in range(0, os.path.getsize(path), 7) for at, content in m._Archive(path).records(s, s + 7)]
    assert found == [(0, True), (4, False), (4 + len(outer), False)]


def archive(spark, path, data):
    with open(path, "wb") as f:
        f.write(data)
    return spark.createDataFrame([(str(path), len(data))], "path string, bytes bigint")


def response(i, body, digest=None):
    headers = {"WARC-Record-ID": f"<urn:page:{i}>"} | ({"WARC-Payload-Digest": digest} if digest else {})
    return m.record("response", headers, b"HTTP/1.1 200 OK\r\n\r\n" + body)


@pytest.mark.parametrize("split", [50, 300, 1 << 22])
def test_padding_loses_no_record(spark, tmp_path, split):
    parts = [response(i, b"x%d" % i * 90) for i in range(6)]
    data = parts[0] + b"\0" * 700 + parts[1] + parts[2] + b"\0" + parts[3] + parts[4] + parts[5] + b"\0" * 2000
    got = m.read_archives(archive(spark, tmp_path / "p.warc.gz", data), split).collect()
    assert sorted(r.page_id for r in got) == list(range(6))


@pytest.mark.parametrize("split", [40, 300, 1 << 22])
def test_each_damaged_place_is_found_once(spark, tmp_path, split):
    parts = [bytearray(response(i, bytes(range(33, 120)) * 3 + b"%d" % i)) for i in range(7)]
    parts[0][40] ^= 0xFF                     # the first, one inside, a torn magic, a cut last one
    parts[3][60] ^= 0xFF
    parts[5][0] ^= 0xFF
    at = [sum(len(p) for p in parts[:i]) for i in range(8)]
    archives = archive(spark, tmp_path / "d.warc.gz", b"".join(parts)[:-9])
    got = m.read_archives(archives, split, damaged="report").collect()
    assert sorted(r.page_id for r in got if r.record_type == "response") == [1, 2, 4]
    assert sorted(r.at for r in got if r.record_type == "damaged") == [at[0], at[3], at[5]]
    with pytest.raises(Exception, match="no valid member"):
        m.read_archives(archives, split).collect()


def test_foreign_digests(spark, tmp_path):
    data = (response(1, b"a", "sha1:ABCDEF") + response(2, b"b") + response(3, b"c", "sha256:" + hashlib.sha256(b"c").hexdigest())
            + m.record("revisit", {"WARC-Record-ID": "<urn:page:4>", "WARC-Payload-Digest": "sha1:ABCDEF", "WARC-Refers-To": "<urn:page:1>"}, b""))
    got = {r.page_id: r for r in m.read_archives(archive(spark, tmp_path / "f.warc.gz", data)).collect()}
    assert [got[i].payload_digest for i in (1, 2, 3)] == [hashlib.sha256(x).hexdigest() for x in (b"a", b"b", b"c")]
    assert (got[4].payload_digest, got[4].payload_bytes, got[4].refers_to) == ("sha1:ABCDEF", None, 1)
    wrong = archive(spark, tmp_path / "w.warc.gz", response(3, b"c", "sha256:" + "0" * 64))
    with pytest.raises(Exception, match="digest"):
        m.read_archives(wrong).collect()


def test_ranges_are_read_by_many_tasks(spark):
    archives = spark.createDataFrame([(f"/nowhere/{i}", 1 << 30) for i in range(3)], "path string, bytes bigint")
    assert m.read_archives(archives).rdd.getNumPartitions() == 3 * 256
    assert m.read_archives(archives, 1 << 12).rdd.getNumPartitions() == m.MAX_TASKS


def test_no_rows(spark, scratch):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    archives = m.write_archives(spark, none, scratch("warc"))
    assert m.read_archives(archives).count() == 0
