"""Archives: round trips, magic inside payloads, blocks that cut records, odd rows."""

import base64
import hashlib

from tidemill.llm import warc
from tidemill.session import fresh_path

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (3, None, None), (4, "u\r\nWARC/1.1\r\nv", ""), (5, "e", "é" * 10),
         (6, "m", "before WARC/1.1\r\nafter"), (7, "f", "x" + FAKE + "y"), (8, "g", FAKE), (9, "h", FAKE + FAKE), (None, "n", "<p>null</p>"),
         (10, "l", "z" * 200_000), (11, "w", "WARC/1.1\r\n"), (12, "t", "tail\r\n\r\nWARC/1.1\r\n\r\n"), (13, "c", FAKE)]
PAGES += [(100 + i, f"p{i}", f"<p>{i}</p>" + "q" * (i * 37 % 500)) for i in range(60)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, id string, digest int, bytes string")


def expected(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None:
            first[b] = min(first.get(b, i), i)
        else:
            first.setdefault(b, None)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        same = first[b] == i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if same else "revisit", None if same else first[b]))
    return sorted(out, key=str)


def test_round_trip(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # blocks end inside headers, payloads and version lines
    try:
        got = sorted((tuple(r) for r in warc.round_trip(pages(spark, PAGES)).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == expected(PAGES)


def test_payloads_come_back(spark):
    path = fresh_path(spark, "test-archive")
    warc.write_archives(pages(spark, PAGES).coalesce(1), path)
    got = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, path).where("type = 'response'").collect()}
    want = {f"<urn:page:{'' if i is None else i}>": (h or "").encode() for i, _, h in PAGES if i not in (2, 4, 13)}
    assert got == want


def test_small_payloads_are_all_responses(spark):
    path = fresh_path(spark, "test-archive")
    warc.write_archives(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), path, least=3)
    assert sorted(r.type for r in warc.read_archives(spark, path).collect()) == ["response"] * 3 + ["revisit"]


def test_repeated_and_empty(spark):
    got = warc.round_trip(pages(spark, [(1, "u", "a"), (1, "u", "a")])).collect()
    assert [r.record_type for r in got] == ["response"] * 2
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_chain_of_many_records(spark):
    rows = [("f", i, i + 1) for i in range(300)] + [("f", 1000, 5), ("g", 7, 8)]
    live = warc.reachable(spark.createDataFrame(rows, "file string, off long, next long")).collect()
    assert {r.off for r in live} == set(range(300)) and {r.file for r in live} == {"f"}
