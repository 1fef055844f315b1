"""WARC round trips, and range reads against every split of an archive."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leaseflow.llm import queries as Q
from leaseflow.llm import warc as W
from tests.conftest import SMALL
from tests.oracle_compare import compare, connect

SCHEMA = "page_id bigint, url string, html string"


def member(raw, level=6):
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


@pytest.mark.parametrize("step", [1, 7, 333, 5000, 10**7])
def test_every_split_gives_each_record_once(step, monkeypatch):
    """Payloads full of gzip magic, some stored uncompressed; reads of a few bytes."""
    rng = random.Random(1)
    n = 8 if step < 10 else 40
    records = [W.record(i, "http://x/", bytes(rng.choice(W.MAGIC + b"ab") for _ in range(
        rng.randrange(600))), None) for i in range(n)]
    archive = b"".join(member(r, rng.choice((0, 1, 9))) for r in records)
    monkeypatch.setattr(W, "READ_BYTES", 97)
    got = [r for at in range(0, len(archive), step)
           for r in W.members(io.BytesIO(archive), len(archive), at, min(at + step, len(archive)))]
    assert got == records


def test_damaged_and_foreign_members_are_passed_over():
    good = [member(W.record(i, None, b"x" * 50, None)) for i in range(3)]
    archive = good[0] + member(b"no archive record") + good[1][:-9] + b"junk" + good[2]
    got = [W.parse(r)["page_id"] for r in W.members(io.BytesIO(archive), len(archive), 0, len(archive))]
    assert got[0] == 0 and got[-1] == 2


def brute(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        some = [p for p in groups[payload] if p is not None]
        top = max(some) if some and len(payload) >= least else None
        visit = top is not None and page_id != top
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if visit else "response", top if visit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip_of_edge_cases(spark, tmp_path, least):
    rows = [(1, "http://a/", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, "u\r\nX: y", None),
            (4, "", ""), (None, "http://c/", "<p>é</p>"), (None, "d", "alone"), (5, "e", "tiny"),
            (6, "f", "tiny"), (7, "g", "z" * 300_000), (8, "h", "\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"digest": F.lit(1), "refers_to": F.lit(2)})
    manifest = W.write_archives(pages, str(tmp_path / "w"), least, file_bytes=400)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    back = W.read_archives(spark, manifest, range_bytes=100, with_payload=True)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in back.collect()), key=str)
    assert got == brute(rows, least)
    texts = {r.page_id: bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()}
    assert all(texts[i] == (h or "") for i, _, h in rows if i in (7, 8))


def test_empty_table(spark, tmp_path):
    manifest = W.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert W.read_archives(spark, manifest).count() == 0


def test_query_equals_sql(spark):
    rows, _, problem = compare(Q.QUERIES["op3_warc"](spark, SMALL), connect(SMALL), Q.ORACLE["op3_warc"])
    assert rows and not problem
