"""WARC archives: writing with revisits for equal payloads, and reading by verified record boundaries."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from conceptlink.llm.chains import reached
from conceptlink.llm.common import slices, texts
from conceptlink.operators.staging import written

MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "html")):
        digests = [_digest(p) for p in texts(batch, "html")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, "digest"])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = 20_000) -> None:
    """Write one record per row of ``pages`` (page_id, url, html, ...) as gzipped WARC files below ``path``.

    Among equal payloads of at least ``least_bytes`` bytes the one with the largest page_id is a response, the others
    are revisits that name it and hold no payload. Smaller payloads are all responses. Null html is empty, a null url becomes
    a urn; rows without page_id are responses unless a row with one has the payload; rows that repeat the largest page_id
    are all responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    hashed = rows.mapInArrow(_digests, "page_id long, url string, html string, digest string").withColumn("size", F.octet_length("html"))
    firsts = (
        hashed.filter(F.col("size") >= least_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "size", "first")
    )
    both = hashed.join(firsts, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    uri = F.coalesce(F.nullif(F.regexp_replace("url", r"[\x00-\x20\x7F]", ""), F.lit("")), F.concat(F.lit("urn:page:"), name))
    http = F.concat(F.lit(_HTTP), F.col("size").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    header = F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("first").cast("string"), F.lit(">"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(END),
    )
    record = F.concat(header, http, F.when(revisit, "").otherwise(F.col("html")))
    both.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"([A-Za-z-]+): *([^\r\n]*)")


def _parse(segment: bytes) -> dict | None:
    """Header fields of what follows a magic, where its block begins and where its record should end."""
    stop = segment.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {k.lower(): v for k, v in _FIELD.findall(segment[:stop])}
    size = fields.get(b"content-length", b"")
    if not size.isdigit() or len(size) > 18:
        return None
    return {"fields": fields, "block": stop + 4, "end": stop + 4 + int(size) + 4}


def _content(segment: bytes, found: dict) -> tuple:
    """Type, page, target, payload length and digest, referred page and whether the digest holds, of a whole record."""
    fields, end = found["fields"], found["end"] - 4
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    page = re.fullmatch(rb"<urn:page:(-?[0-9]{1,19})>", fields.get(b"warc-record-id", b""))
    refers = re.fullmatch(rb"<urn:page:(-?[0-9]{1,19})>", fields.get(b"warc-refers-to", b""))
    stated = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("utf-8", "replace")
    if kind == "revisit":
        size, digest = int(fields.get(b"x-payload-length", b"0")), stated
    else:
        payload = segment[found["block"] : end]
        if fields.get(b"content-type", b"").startswith(b"application/http"):
            payload = payload.partition(b"\r\n\r\n")[2]
        size, digest = len(payload), _digest(payload)
    uri = fields.get(b"warc-target-uri", b"").decode("utf-8", "replace")
    return kind, int(page[1]) if page else None, uri, size, digest, int(refers[1]) if refers else None, digest == stated


_FIELDS = ("record_type", "page_id", "uri", "payload_bytes", "payload_digest", "refers_to", "verified")
_CONTENT = "record_type string, page_id long, uri string, payload_bytes long, payload_digest string, refers_to long, verified boolean"
_KINDS = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())


def _segments(path: str, spark: SparkSession) -> DataFrame:
    """What stands between magics, in reading order within each split. Files of any size are read in splits."""
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """(file, split, start relative to the split, bytes) of each segment."""
    key, start = None, 0
    for batch in batches:
        for value, *own in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "split"))):
            if own != key:
                key, start = own, 0
            yield *own, start, value or b""
            start += len(value or b"") + len(MAGIC)


def _batches(rows: Iterator[tuple], names: list[str], kinds: list, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for file, split, start, value in _placed(batches):
            found = _parse(value)
            whole = found is not None and found["end"] == len(value)
            content = _content(value, found) if whole else (None,) * len(_FIELDS)
            yield file, split, start, len(value), found and start + found["end"], whole, *content

    names = ["file", "split", "start", "size", "successor", "whole", *_FIELDS]
    return _batches(rows(), names, [*[pa.int64()] * 5, pa.bool_(), *_KINDS])


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(_placed(batches), ["file", "split", "start", "value"], [pa.int64()] * 3 + [pa.binary()], 256)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose payload holds magics, put together again."""

    def rows():
        for batch in batches:
            for file, owner, parts in zip(*(batch.column(c).to_pylist() for c in ("file", "owner", "parts"))):
                value = MAGIC.join(p["value"] for p in parts)
                found = _parse(value)
                if found and found["end"] <= len(value):
                    yield file, owner, *_content(value, found)

    return _batches(rows(), ["file", "owner", *_FIELDS], [pa.int64(), pa.int64(), *_KINDS])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below ``path``: file, owner (offset) and what their headers and payloads say.

    Every magic in a file is a candidate that names its successor by its length. Only candidates
    that the chain from the start of the file reaches are records; a magic inside a payload is not reached, even if a whole
    record stands there. Tasks emit (offset, successor) pairs, pointer jumping over the table of pairs finds the chain. A
    record with magics in its payload is put together from its segments. A chain that breaks off (a cut file) ends there; an
    empty folder's files give no record. ``verified`` tells whether the payload has the stated digest.
    """
    names = "file long, split long, start long, size long, successor long, whole boolean, "
    segments = written(_segments(path, spark).mapInArrow(_candidates, names + _CONTENT))
    ends = segments.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("length"))
    by_split = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("file", "split", F.coalesce(F.sum("length").over(by_split), F.lit(0)).alias("base"))
    placed = written(
        segments.join(base, ["file", "split"])
        .withColumn("offset", F.col("base") + F.col("start") - len(MAGIC))
        .withColumn("next", F.col("base") + F.col("successor"))
        .drop("successor", "base")
    )
    links = placed.filter("next is not null and offset >= 0").select(F.struct("file", "offset").alias("node"), F.struct("file", F.col("next").alias("offset")).alias("next"))
    true_starts = reached(links.filter("node.offset = 0").select("node"), links).select("node.file", "node.offset")
    flagged = placed.join(true_starts.withColumn("real", F.lit(True)), ["file", "offset"], "left").filter("offset >= 0")

    within = Window.partitionBy("file", "split").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    last = flagged.groupBy("file", "split").agg(F.max(F.when(F.col("real"), F.col("offset"))).alias("last"))
    carried = last.select("file", "split", F.max("last").over(by_split).alias("carried"))
    owned = (
        flagged.withColumn("own", F.max(F.when(F.col("real"), F.col("offset"))).over(within))
        .join(carried, ["file", "split"])
        .withColumn("owner", F.coalesce("own", "carried"))
    )
    whole = flagged.filter("real and whole").select("file", F.col("offset").alias("owner"), *_FIELDS)
    broken = owned.filter("real and not whole and next is not null").select("file", "owner")
    parts = written(owned.join(broken, ["file", "owner"], "left_semi").select("file", "split", "start", "owner", "offset"))
    texts = _segments(path, spark).mapInArrow(_bytes, "file long, split long, start long, value binary").join(parts, ["file", "split", "start"])
    mended = texts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
    return whole.unionByName(mended.mapInArrow(_joined, "file long, owner long, " + _CONTENT))
