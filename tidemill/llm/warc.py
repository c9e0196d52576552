"""Web archives: writing records with revisits, and reading them back by boundary-chain verification.

Writing: payloads are compared by digest; the row with the smallest id is the response, the other rows revisit it and carry
no payload. Records go through Spark's text writer, so an archive file is one task's output and commits like any output.

Reading: archives are split at every occurrence of the version line, wherever Spark cuts the files into blocks. Each
occurrence with a complete header is a candidate (offset -> offset of its successor). Starting from offset 0, pointer
jumping doubles the known part of every chain in each round, so a file of n records takes log2(n) rounds of joins of small
rows. Candidates that no chain reaches lie inside payloads; their bytes go back to the record that holds them.

Defined cases: a null payload is empty; empty payloads are equal to each other; a null id is written as an empty one, read
back as null and ranks last; rows equal in id and payload are all responses; line ends in a target are percent-encoded; an
empty table gives an empty archive; a chain that meets anything but a record ends there.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import q, ready
from tidemill.session import fresh_path, settled

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: five hex digits are four base32 digits."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _http(length: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length.cast("string"), F.lit(END))


def _record(kind: str, date: str) -> Column:
    """One record without its end, from id, url, digest, bytes, refers_to and (for responses) payload."""
    block = _http(F.col("bytes"))
    if kind == "response":
        block = F.concat(block, F.col("payload").cast("string"))
    lines = [f"{VERSION}WARC-Type: {kind}\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:page:", F.coalesce(F.col("id").cast("string"), F.lit("")),
             ">\r\nWARC-Target-URI: ", F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
             "\r\nWARC-Payload-Digest: sha1:", F.col("digest"), "\r\n"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:", F.coalesce(F.col("refers_to").cast("string"), F.lit("")), ">\r\n"]
    lines += ["Content-Type: application/http;msgtype=response\r\nContent-Length: ", F.octet_length(block).cast("string"), END, block]
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in lines]).alias("value")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   least: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row to archive files under ``path``; payloads of fewer than ``least`` bytes are never revisits."""
    rows = pages.select(q(id_col).cast("bigint").alias("id"), q(url_col).cast("string").alias("url"),
                        F.coalesce(q(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload").cast("bigint")})
    light = settled(rows.drop("payload"), "page-digests")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id"))
    groups = light.where(F.col("bytes") >= least).groupBy("digest").agg(first.alias("first"))
    groups = settled(groups.select("digest", F.col("first.id").alias("refers_to")), "first-pages")
    # written out, so that payload rows are exchanged only if the repeats are too many to send to every task
    repeats = settled(light.join(groups, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))), "repeats")
    not_first = repeats.select(F.col("digest").alias("d"), F.col("id").alias("i")).distinct()
    responses = rows.join(not_first, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left_anti")
    out = responses.select(_record("response", date)).unionByName(repeats.select(_record("revisit", date)))
    out.write.text(path, lineSep=END)


SEGMENT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("size", pa.int64()), ("head", pa.int64()),
                     ("length", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target", pa.string()),
                     ("refers_to", pa.string()), ("claimed", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("payload", pa.binary()), ("part", pa.binary())])
SEGMENT_DDL = ("file string, block long, rel long, size long, head long, length long, type string, record_id string, target string, "
               "refers_to string, claimed string, payload_bytes long, payload_digest string, payload binary, part binary")


def _header(segment: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of the header with its blank line, and its fields; None if this is no record's beginning."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].decode("utf-8", "replace").split("\r\n"):
        name, sep, value = line.partition(":")
        if not sep or not re.fullmatch(r"[A-Za-z0-9-]+", name):
            return None
        fields[name.lower()] = value.strip()
    return (end + 4, fields) if re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")) else None


def _body(block: bytes, fields: dict[str, str]) -> bytes:
    """The payload of a block: what follows the HTTP header, if there is one."""
    return block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, int, int, bytes]]]:
    """(file, block, bytes since the block's first segment, segment) in reading order, batch by batch."""
    at, rel = None, 0
    for batch in batches:
        out = []
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != at:
                at, rel = (file, block), 0
            out.append((file, block, rel, value))
            rel += len(value) + len(VERSION)
        yield out


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for placed in _placed(batches):
        yield pa.RecordBatch.from_pylist([{"file": f, "block": b, "rel": r, "part": v} for f, b, r, v in placed], schema=pa.schema([SEGMENT.field(n) for n in ("file", "block", "rel", "part")]))


def _segments(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for placed in _placed(batches):
            out = []
            for file, block, rel, value in placed:
                row = dict.fromkeys(SEGMENT.names) | {"file": file, "block": block, "rel": rel, "size": len(value)}
                if found := _header(value):
                    head, fields = found
                    n = int(fields["content-length"])
                    row |= {"head": head, "length": n, "type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                            "target": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"), "claimed": fields.get("warc-payload-digest")}
                    if len(value) == head + n + len(END):  # nothing of the record lies beyond the next version line
                        body = _body(value[head:head + n], fields)
                        row |= {"payload_bytes": len(body), "payload_digest": base64.b32encode(hashlib.sha1(body).digest()).decode(),
                                "payload": body if with_payload else None}
                if row["payload_digest"] is None:
                    row["part"] = value
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=SEGMENT)
    return run


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, off) of the candidates (file, off, next) on the chain that starts at offset 0 of their file."""
    t = candidates.select("file", "off", F.col("next").alias("jump"), (F.col("off") == 0).alias("live"))
    while True:
        hops = t.select("file", F.col("off").alias("jump"), F.col("jump").alias("far"))
        marks = t.where("live").select("file", F.col("jump").alias("off"), F.lit(True).alias("hit")).where("off is not null").distinct()
        t = settled(t.join(hops, ["file", "jump"], "left").join(marks, ["file", "off"], "left")
                    .select("file", "off", F.col("far").alias("jump"), (F.col("live") | F.coalesce("hit", F.lit(False))).alias("live")), "chain")
        if t.where("live and jump is not null").isEmpty():
            return t.where("live").select("file", "off")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all archive files under ``path``.

    Columns: file, off, type, record_id, target, refers_to, claimed (the digest in the header), payload_bytes, payload_digest
    (of the bytes read) and payload. Only bytes around a version line inside a payload are exchanged.
    """
    ready(spark)
    raw = spark.read.text(path, lineSep=VERSION).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))
    seg = settled(raw.mapInArrow(_segments(with_payload), SEGMENT_DDL), "segments")
    blocks = seg.groupBy("file", "block").agg(F.sum(F.col("size") + len(VERSION)).alias("total"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    seg = seg.join(base, ["file", "block"]).withColumn("off", F.col("base") + F.col("rel") - len(VERSION)).where("off >= 0")
    start = F.col("off") + len(VERSION)
    live = reachable(seg.where("head is not null").select("file", "off", (start + F.col("head") + F.col("length") + len(END)).alias("next")))
    seg = seg.join(live.withColumn("live", F.lit(True)), ["file", "off"], "left").withColumn("live", F.coalesce("live", F.lit(False)))
    fields = ["file", "off", "type", "record_id", "target", "refers_to", "claimed"]
    whole = seg.where("live and payload_digest is not null").select(*fields, "payload_bytes", "payload_digest", "payload")
    # what lies between a record cut by version lines and the next live record belongs to it
    cut = seg.where("not live or payload_digest is null")
    if not (lost := cut.where("part is null").select("file", "block", "rel")).isEmpty():  # whole records inside payloads: read their bytes again
        again = raw.mapInArrow(_bytes, "file string, block long, rel long, part binary").join(lost, ["file", "block", "rel"], "left_semi")
        again = again.withColumnRenamed("part", "found")
        cut = cut.join(again, ["file", "block", "rel"], "left").withColumn("part", F.coalesce("part", "found")).drop("found")
    cut = settled(cut, "cut")
    order = W.partitionBy("file").orderBy("off").rowsBetween(W.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("live"), F.struct("off", (start + F.col("head") + F.col("length")).alias("end"))), ignorenulls=True).over(order)
    rest = F.col("part").cast("string")
    owned = cut.withColumn("owner", owner).where("off < owner.end")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("off", rest.alias("part")))), lambda x: x.part)
    joined = owned.groupBy("file", F.col("owner.off").alias("off")).agg(F.array_join(texts, VERSION).cast("binary").alias("bytes"))
    block = F.expr("substring(bytes, head + 1, length)")
    http = F.col("type").isNotNull() & (F.instr(F.expr("cast(substring(bytes, 1, head) as string)"), "application/http") > 0)
    body = F.expr("substring(block, octet_length(substring_index(cast(block as string), '\\r\\n\\r\\n', 1)) + 5)")
    mended = (cut.where("live").drop("payload", "payload_bytes", "payload_digest", "part").join(joined, ["file", "off"])
              .withColumn("block", block).withColumn("payload", F.when(http, body).otherwise(F.col("block")))
              .select(*fields, F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
                      (F.col("payload") if with_payload else F.lit(None).cast("binary")).alias("payload")))
    return whole.unionByName(mended)


def page_id(urn: Column) -> Column:
    return F.regexp_extract(urn, "urn:page:(-?[0-9]+)", 1).try_cast("bigint")


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload size and digest of the response that a revisit refers to; a dangling revisit has nulls."""
    own = settled(records.select("record_id", "type", "refers_to", "payload_bytes", "payload_digest"), "records")
    there = own.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    there = settled(there.dropDuplicates(["refers_to"]), "responses")
    back = own.where("type = 'revisit'").drop("payload_bytes", "payload_digest").join(there, "refers_to", "left")
    return own.where("type = 'response'").unionByName(back.withColumnsRenamed({"b": "payload_bytes", "d": "payload_digest"}))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    write_archives(pages, path := fresh_path(spark, "archives"))
    return resolved(read_archives(spark, path, with_payload=False)).select(
        page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page_id(F.col("refers_to")).alias("refers_to"))
