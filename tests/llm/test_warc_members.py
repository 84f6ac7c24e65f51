"""Salvage inside gzip members, cut members and damaged lengths."""

import gzip
import io
import random
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from sigflow.llm import warc


def records(n, size=3000):
    r = random.Random(2)
    return [warc.page_record(i, f"http://h/{i}", r.randbytes(size), None, "2024-01-01T00:00:00Z") for i in range(n)]


def read(data):
    found = list(warc.salvage(io.BytesIO(data)))
    return [x.headers["x-page-id"] for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


def test_a_damaged_record_of_a_whole_file_member():
    parts = records(6)
    parts[2] = parts[2][:-100] + b"?" * 50 + parts[2][-50:]
    keys, gaps = read(gzip.compress(b"".join(parts)))
    assert keys == ["0", "1", "3", "4", "5"]
    assert len(gaps) == 1 and f"{len(parts[2])} bytes from byte {len(parts[0] + parts[1])}" in gaps[0].reason


@pytest.mark.parametrize("cut", [5, 2000, 40_000])
def test_a_cut_member_keeps_what_precedes_the_cut(cut):
    parts = records(100)
    keys, gaps = read(gzip.compress(b"".join(parts))[:-cut])
    assert len(keys) >= 100 - cut // 3000 - 1
    assert keys == [str(i) for i in range(len(keys))] and len(gaps) == 1


def test_damaged_bytes_in_a_member_and_a_member_after_it():
    first = bytearray(gzip.compress(b"".join(records(100)), 1))
    first[len(first) // 2] ^= 0xFF
    keys, gaps = read(bytes(first) + warc.compressed(records(1)[0]))
    assert keys[:40] == [str(i) for i in range(40)] and keys[-1] == "0" and len(keys) > 40 and gaps


@pytest.mark.parametrize("length", ["9" * 16, "9" * 6000, "100000000"])
def test_a_huge_length(length):
    class File(io.BytesIO):
        def read(self, n=-1):
            if n > 1 << 30:
                raise MemoryError
            return super().read(n)

    a, b, c = records(3)
    bad = b.replace(b"Content-Length: 3", b"Content-Length: " + length.encode() + b"3", 2)
    for pack in (bytes, gzip.compress):
        found = list(warc.salvage(File(pack(a + bad + c))))
        assert [x.headers["x-page-id"] for x in found if isinstance(x, warc.Record)] == ["0", "2"]


def test_a_member_is_not_held(monkeypatch):
    monkeypatch.setattr(warc, "KEPT_BYTES", 20_000)
    keys, gaps = read(gzip.compress(b"".join(records(300))))
    assert keys == [str(i) for i in range(300)] and gaps == []
    z = zlib.compressobj(9, zlib.DEFLATED, 31)
    assert read(z.compress(b"x" * (5 << 20)) + z.flush() + warc.compressed(records(1)[0]))[0] == ["0"]


def plain(i, size, digest):
    block = random.Random(i).randbytes(size)
    data = warc.encode_record([("WARC-Type", "resource"), ("X-Page-ID", str(i))], block)
    return data if digest else data.replace(b"WARC-Block-Digest", b"X-Block-Digest", 1)


@pytest.mark.parametrize("size", [1000, 100_000, 1_000_000])
@pytest.mark.parametrize("digest", [True, False])
def test_one_rule_for_records_of_a_damaged_member(size, digest):
    """The checksum at the end of the member is damaged, and nothing else."""
    member = bytearray(gzip.compress(b"".join(plain(i, size, digest) for i in range(20)), 1))
    whole = [x for x in warc.salvage(io.BytesIO(bytes(member))) if isinstance(x, warc.Record)]
    member[-6] ^= 0xFF
    found = list(warc.salvage(io.BytesIO(bytes(member))))
    assert [x.headers["x-page-id"] for x in found[:-1]] == [str(i) for i in range(20)] and isinstance(found[-1], warc.Gap)
    assert {x.verified for x in [*whole, *found[:-1]]} == {digest}


def test_an_only_record_is_verified_by_its_member():
    record = warc.encode_record([("WARC-Type", "resource")], b"some words " * 500).replace(b"WARC-Block-Digest", b"X-Block-Digest", 1)
    data = bytearray(gzip.compress(record))
    assert [x.verified for x in warc.salvage(io.BytesIO(bytes(data)))] == [True]
    data[-6] ^= 0xFF
    assert [type(x) for x in warc.salvage(io.BytesIO(bytes(data)))] == [warc.Gap]
    assert [x.verified for x in warc.salvage(io.BytesIO(plain(1, 50, False) + plain(2, 50, True)))] == [False, True]


@pytest.mark.parametrize("pack", [bytes, lambda x: gzip.compress(x, 1)])
def test_a_wrong_length_holds_little(pack):
    bad = plain(0, 100, True).replace(b"Content-Length: 100", b"Content-Length: 2000000000")
    data = pack(bad + b"".join(plain(i, 2_000_000, True) for i in range(1, 26)))
    tracemalloc.start()
    keys = [x.headers["x-page-id"] for x in warc.salvage(io.BytesIO(data)) if isinstance(x, warc.Record)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert keys == [str(i) for i in range(1, 26)] and peak < 24 << 20


def test_rows_of_one_payload_and_short_ones_are_dealt(spark):
    rows = spark.range(4000).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat('x', if(id % 2 = 0, 2000, 10)) AS html")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = warc.with_revisits(rows.repartition(8), "page_id", "url", "html")
        sizes = found.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    assert sizes.sum() == 4000 and sizes.max() <= 1200
    assert found.filter("refers_to IS NULL").count() == 2001 and found.filter("refers_to <> 3998").count() == 0
