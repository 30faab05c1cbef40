from __future__ import annotations

import base64
import hashlib

import pytest

from dealspark.llm import warc
from dealspark.llm.common import scratch, ship, table

SF = "/root/testdata/sf0.001"

ROWS = [(1, None, None), (None, "http://a/\n%41 é", ""), (2, "u", "x" * 100), (2, "u", "x" * 100), (3, "v", "x" * 100),
        (-5, "neg", "y"), (8, "long", "z" * 300_000)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 50])
def test_round_trip(spark, least):
    ship(spark)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(2)
    got = sorted(((r.page_id is None, r.page_id or 0), r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                 for r in warc.round_trip(pages, least).collect())
    value = lambda i: -2 ** 63 if i is None else i
    want = []
    for i, url, html in ROWS:
        size = len((html or "").encode())
        top = max(value(j) for j, _, h in ROWS if (h or "") == (html or ""))
        revisit = size >= least and top > value(i)
        want.append(((i is None, i or 0), url, size, digest(html), "revisit" if revisit else "response", top if revisit else None))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_pages_and_payloads(spark):
    pages = table(spark, SF, "pages")
    folder = scratch(spark, "warc-test")
    manifest = warc.write(pages, folder, archive_bytes=20_000).collect()
    assert sum(m.records for m in manifest) == pages.count() and len(manifest) > 3
    back = {r.page_id: r for r in warc.read(spark, folder).collect()}
    for r in pages.collect():
        held = back[r.page_id]
        source = back[held.refers_to] if held.record_type == "revisit" else held
        assert held.error is None and bytes(source.payload) == r.html.encode() and held.url == r.url


def records(n=60):
    return [warc.build_record(k, "u", b"hello %d " % k * 30, None, False) for k in range(n)]


def test_archive_layout():
    data = warc.build_archive(records())
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    assert data[8:12] == bytes.fromhex("37a430ec") and size <= warc.DICT_BYTES
    got = list(warc.read_archive(data))
    assert [f["page_id"] for _, f, e in got] == list(range(60)) and not any(e for _, _, e in got)
    assert warc.build_archive(records(1))[4:8] == b"\0\0\0\0"  # too little to train a dictionary
    assert next(warc.read_archive(warc.build_archive(records(1))))[2] is None


def test_damage_is_reported():
    import zstandard
    data = warc.build_archive(records())
    errors = lambda d: [e for _, _, e in warc.read_archive(d) if e]
    assert errors(data[:-3]) and errors(data[:6]) and errors(data + b"junk")
    good = records(1)[0]
    bad = [good.replace(b"hello", b"jello", 1), good[:-1], good.replace(b"Content-Length: ", b"Content-Length: 9", 1),
           good.replace(b"WARC-Type", b"WARC-Kind"), good.replace(b"WARC/1.1", b"WARD/1.1"), good[:-4] + b"abcd"]
    frames = [zstandard.compress(b) for b in [*bad, good]]
    got = list(warc.read_archive(b"".join(frames)))
    assert [e is None for _, _, e in got] == [False] * len(bad) + [True]


def test_compressed_dictionary():
    import struct
    import zstandard
    data = warc.build_archive(records())
    size = int.from_bytes(data[4:8], "little")
    packed = zstandard.compress(data[8:8 + size])
    again = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(packed)) + packed + data[8 + size:]
    assert sum(e is None for _, _, e in warc.read_archive(again)) == 60


def test_archives_of_lost_attempts_are_passed_over(spark):
    """A surplus archive in the folder is not read; one that the manifest names and that is gone is an error."""
    import os
    import shutil
    ship(spark)
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    folder = scratch(spark, "warc-surplus")
    manifest = warc.write(pages, folder)
    paths = [r.path for r in manifest.collect()]
    local = paths[0].removeprefix("file://")
    shutil.copy(local, local.replace("part-", "part-9"))
    assert warc.read(spark, folder, manifest=manifest).count() == pages.count() < warc.read(spark, folder).count()
    named = manifest.unionByName(manifest.limit(1).selectExpr("concat(path, '-gone.warc.zst') path", "records", "bytes"))
    with pytest.raises(FileNotFoundError, match="gone"):
        warc.read(spark, folder, manifest=named)
