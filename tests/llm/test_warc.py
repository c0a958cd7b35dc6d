import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard as zstd

from tidewatch.llm import warc


def pages(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("sha", "last", "n", "kind", "refers_to", "payload_bytes")})


def brute(rows):
    last = {}
    for i, _, html in rows:
        h = html or ""
        last[h] = max(last.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, html in rows:
        h = html or ""
        first = (-1 if i is None else i) == last[h]
        out.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                    "response" if first else "revisit", None if first else last[h]))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    rng = random.Random(3)
    bodies = ["<html>" + " ".join(rng.choice(["alpha", "beta", "gämma", "\U0001f600"]) for _ in range(n)) for n in (0, 5, 400, 60_000)]
    rows = [(i, f"http://x/{i}\r\nHost: evil", rng.choice(bodies)) for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (None, "http://n", "only me"), (None, "http://m", bodies[0]), (302, "u", "a\r\n\r\nb\x00")]
    got = warc.round_trip(pages(spark, rows)).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == brute(rows)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_payloads_under_the_minimum_are_never_revisits(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")]
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages(spark, rows), min_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


class Kept(io.BytesIO):
    def close(self):
        pass


@pytest.fixture()
def archive():
    rng = random.Random(1)
    recs = [warc.record(i, f"http://h/{i}", " ".join(rng.choice(["the", "of", "a", f"w{rng.randrange(99)}"]) for _ in range(300)).encode(),
                        "response", None) for i in range(400)]
    out = Kept()
    a = warc.Archive(out)
    for r in recs:
        a.add(r)
    a.close()
    return recs, out.getvalue(), a


def test_dictionary_leads_and_records_are_frames_of_their_own(archive):
    recs, data, a = archive
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_FRAME and 0 < size <= warc.DICTIONARY_BYTES
    packer = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(data[8:8 + size]))
    at, rest = 8 + size, []
    while at < len(data):  # any frame can be read from its own offset
        one = packer.decompressobj()
        rest.append(one.decompress(data[at:]))
        at = len(data) - len(one.unused_data)
    assert rest == recs
    plain = sum(len(zstd.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in recs)
    assert len(data) - at <= 0 and a.stored - size < plain


def test_reader_meets_chunk_borders_and_damage(archive, monkeypatch):
    recs, data, _ = archive

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(n if n == 8 or n > 1 << 30 else min(n, 70_001))
    assert len(list(warc.read_archive(io.BytesIO(data)))) == len(recs)
    with pytest.raises((ValueError, zstd.ZstdError)):
        list(warc.read_archive(io.BytesIO(data[:-5])))
    assert list(warc.read_archive(io.BytesIO(b""))) == []


def test_every_archive_leads_with_a_dictionary():
    for recs in ([warc.record(1, "u", b"x" * 300, "response", None)], [warc.record(i, "u", b"y" * 40, "response", None) for i in range(3)],
                 [bytes([65 + i % 7]) * (900 << 10) for i in range(3)]):
        out = Kept()
        a = warc.Archive(out)
        for r in recs:
            a.add(r)
        a.close()
        magic, size = struct.unpack("<II", out.getvalue()[:8])
        assert magic == warc.DICTIONARY_FRAME and 8 <= size <= warc.DICTIONARY_BYTES
        if recs[0].startswith(b"WARC"):
            assert len(list(warc.read_archive(io.BytesIO(out.getvalue())))) == len(recs)


def test_archives_are_read_by_a_task_each(spark):
    from functools import reduce

    from pyspark.sql import functions as F
    folder = warc.scratch_path(spark, "warc-tasks")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    manifest = reduce(lambda a, b: a.unionByName(b), [
        warc.write_archives(pages(spark, [(k, f"http://x/{k}", f"page {k} " * 20) for k in range(20 * i, 20 * i + 20)]), folder) for i in range(6)])
    read = warc.read_archives(manifest, folder)
    tasks = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == manifest.count() == 6 and sum(t["count"] for t in tasks) == 120
