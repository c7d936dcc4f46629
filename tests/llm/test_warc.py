"""WARC: exact round trip, determinism, commit."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import os
import re

import pytest

from gridsky.llm.warc import read_manifest, read_warc, write_warc
from gridsky.session import fresh_dir

SCHEMA = "page_id long, url string, html string, sha string, range int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "n") for r in rows], SCHEMA)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [(i, f"http://h{i % 3}.example/ä?{i}", f"<p>{'same' if i % 4 == 0 else i}</p>\r\n\r\né") for i in range(120)]
ROWS += [(500, None, None), (501, "u", ""), (502, "u", "x" * 300_000), ((1 << 60) + 1, "u", "big id"), ((1 << 60) + 3, "u", "big id"), (None, "u", "null id"), (None, "v", "null id")]


def files(path):
    found = sorted(glob.glob(f"{path}/data/*.warc.gz"))
    return {os.path.basename(f): open(f, "rb").read() for f in found}


def test_round_trip(spark):
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, ROWS).repartition(5), path, roll_bytes=500, range_bytes=20_000)
    got = read_warc(spark, path).collect()
    firsts = {}
    for i, _, html in ROWS:
        if i is not None:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    want = []
    for i, _, html in ROWS:
        first = firsts.get(html or "")
        response = i == first
        if i is None:
            continue
        want.append((i, len((html or "").encode()), sha(html), "response" if response else "revisit", None if response else first))
    assert sorted(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got if r.page_id is not None
    ) == sorted(want)
    payload = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response" and r.page_id is not None}
    assert payload == {i: html or "" for i, _, html in ROWS if i is not None and firsts[html or ""] == i}
    assert sorted(r.record_type for r in got if r.page_id is None) == ["response", "revisit"]
    stored = files(path)
    manifest = {r["name"]: r for r in read_manifest(spark, path).collect()}
    assert stored.keys() == manifest.keys() and len(stored) > 4  # several ranges
    assert all(hashlib.sha256(raw).hexdigest() == manifest[n]["sha256"] for n, raw in stored.items())
    # Pages rise from file to file, and every file is plain gzip.
    text = [gzip.decompress(raw) for raw in stored.values()]
    ids = [int(x) for raw in text for x in re.findall(rb"WARC-Record-ID: <urn:page:(\d+)>", raw)]
    assert len(ids) == len(ROWS) - 2


def test_the_same_pages_give_the_same_bytes(spark):
    one, two = fresh_dir(spark, "warc"), fresh_dir(spark, "warc")
    write_warc(frame(spark, ROWS).repartition(2), one, range_bytes=20_000)
    write_warc(frame(spark, ROWS[::-1]).repartition(9), two, range_bytes=20_000)
    assert files(one) == files(two)


def test_small_payloads_are_all_responses(spark):
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, [(1, "a", "xx"), (2, "a", "xx"), (3, "a", "long one"), (4, "a", "long one")]), path, min_revisit=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in read_warc(spark, path, payload=False).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_repeated_rows_are_all_written(spark):
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, [(1, "a", "xx")] * 3 + [(2, "b", "y")]), path)
    got = sorted((r.page_id, r.record_type, r.refers_to or 0) for r in read_warc(spark, path).collect())
    assert got == [(1, "response", 0), (1, "revisit", 1), (1, "revisit", 1), (2, "response", 0)]


def test_one_id_may_hold_many_rows(spark):
    path = fresh_dir(spark, "warc")
    rows = [(7, "u", f"{k}" * 50) for k in range(200)] + [(8, "u", "z")]
    write_warc(frame(spark, rows), path, range_bytes=3000)
    assert read_warc(spark, path, payload=False).count() == 201 and len(files(path)) > 3


def record_ids(path):
    raw = b"".join(gzip.decompress(x) for x in files(path).values())
    return [int(x) for x in re.findall(rb"WARC-Record-ID: <urn:page:(-?\d+)", raw)]


@pytest.mark.parametrize("far", [1 << 60, (1 << 63) - 1, -(1 << 63)])
def test_ids_rise_over_all_files(spark, far):
    """Two hundred crowded ids and one far off; the ends may be more than 2**63 apart."""
    rows = [(k, f"http://h/{k % 7}", f"{k}" * 40) for k in range(-100, 100)] + [(far, "u", "far"), (-far - 1, "u", "far too")]
    one, two = fresh_dir(spark, "warc"), fresh_dir(spark, "warc")
    write_warc(frame(spark, rows).repartition(3), one, range_bytes=3000)
    write_warc(frame(spark, rows[::-1]).repartition(7), two, range_bytes=3000)
    assert record_ids(one) == sorted(r[0] for r in rows) and len(files(one)) > 20
    assert files(one) == files(two)


def test_one_crowded_id_goes_by_url_then_digest(spark):
    rows = [(7, f"http://same.example/long/path/{k % 40:02d}", f"{k}" * 50) for k in range(400)] + [(6, "a", "x"), (8, "a", "x")]
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, rows).repartition(5), path, range_bytes=4000)
    raw = b"".join(gzip.decompress(x) for x in files(path).values())
    urls = re.findall(rb"WARC-Record-ID: <urn:page:7[:>].*?\r\nWARC-Target-URI: (.*?)\r\n", raw)
    assert urls == sorted(urls) and len(urls) == 400 and len(files(path)) > 30
    assert read_warc(spark, path, payload=False).count() == 402


def test_each_range_has_its_task(spark):
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, [(k, "u", "x" * 900 + str(k)) for k in range(300)]), path, range_bytes=10_000)
    manifest = read_manifest(spark, path).collect()
    assert len({r.range for r in manifest}) > 25 and max(r.records for r in manifest) <= 2 * min(r.records for r in manifest) + 8


def test_empty_table_and_second_write(spark):
    path = fresh_dir(spark, "warc")
    write_warc(spark.createDataFrame([], SCHEMA), path)
    assert read_warc(spark, path).count() == 0
    with pytest.raises(FileExistsError):
        write_warc(frame(spark, ROWS), path)


def test_a_changed_archive_is_refused(spark):
    path = fresh_dir(spark, "warc")
    write_warc(frame(spark, [(1, "a", "xx")]), path)
    (name,) = glob.glob(f"{path}/data/*.gz")
    raw = bytearray(gzip.decompress(open(name, "rb").read()))
    raw[-6] ^= 1
    with open(name, "wb") as out:
        out.write(gzip.compress(bytes(raw)))
    with pytest.raises(Exception, match="differs"):
        read_warc(spark, path).collect()
