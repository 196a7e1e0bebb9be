"""WARC archives of web pages: a deterministic sharded writer, and a reader.

Records are sorted by page id and cut into shards of about equal payload at ids that depend on the
table alone. Each shard rolls its files by compressed size. A task writes under temporary names of
its own; the names that a written manifest lists are made final, so a lost or repeated task leaves
no half file behind the final names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import column, scratch, written

#: Payload bytes of a shard, and compressed bytes after which a shard begins its next file.
SHARD_BYTES, FILE_BYTES = 8 << 20, 64 << 20
LEVEL = 5
# The format's version and the date of all records, so that equal tables give equal files.
VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "part string, final string, records long, bytes long"
_NULL_ID = -(1 << 63)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _urn(page: int | None, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{place}')}>"


def _record(page: int | None, place: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; a revisit has no payload of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    uri = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page, place)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_digest(block)}",
        f"X-Page-Id: {'' if page is None else page}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to, 0)}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Files:
    """The files of one task, under temporary names."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.limit, self.attempt = limit, uuid.uuid4().hex[:12]
        self.shard, self.number, self.out, self.done = -1, 0, None, []

    def add(self, shard: int, data: bytes) -> None:
        if self.out is not None and (shard != self.shard or self.bytes + len(data) > self.limit):
            self.end()
        if shard != self.shard:
            self.shard, self.number = shard, 0
        if self.out is None:
            self.final = f"{self.folder}/shard-{shard:06d}-{self.number:04d}.warc.gz"
            self.part = f"{self.folder}/_temporary/{self.attempt}-{shard:06d}-{self.number:04d}"
            self.out, self.records, self.bytes = self.fs.open_output_stream(self.part, compression=None), 0, 0
        self.out.write(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)

    def end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.part, self.final, self.records, self.bytes))
            self.number, self.out = self.number + 1, None


def _write_rows(batches: Iterator[pa.RecordBatch], folder: str, limit: int, least: int) -> Iterator[pa.RecordBatch]:
    """Writes rows sorted by shard, page and kind; ``refers`` rows name the first page of a payload that occurs again."""
    files = _Files(folder, limit)
    page, place, known, taken = None, 0, {}, set()
    for batch in batches:
        for row in batch.to_pylist():
            if row["place"] != page:
                page, place, known, taken = row["place"], 0, {}, set()
            if row["sha1"] is not None:
                known[row["sha1"]] = row["refers"]
                continue
            payload = (row["html"] or "").encode("utf-8")
            digest, sha1 = _digest(payload), hashlib.sha1(payload).hexdigest()
            refers = known.get(sha1) if len(payload) >= least else None
            if refers is not None and refers == row["page_id"] and sha1 not in taken:
                taken.add(sha1)
                refers = None
            files.add(row["shard"], _record(row["page_id"], place, row["url"] or "", payload, digest, refers))
            place += 1
    files.end()
    part, final, records, size = ([x[i] for x in files.done] for i in range(4))
    yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(final, pa.string()), pa.array(records, pa.int64()), pa.array(size, pa.int64())], names=["part", "final", "records", "bytes"])


def _bounds(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """First id of each shard: where the payload of smaller ids passes another ``shard_bytes``.

    Ids are summed in groups of neighbours, groups of groups, and so on, by exact integer sums in
    tables that shrink by a thousand, so the cuts depend on the data alone and no task orders them all.
    """
    levels = [sizes.groupBy("place").agg(F.sum("bytes").alias("bytes"))]
    shift = 0
    while levels[-1].limit(200_001).count() > 200_000:
        shift += 10
        levels.append(written(levels[-1].groupBy(F.shiftright("place", 10).alias("place")).agg(F.sum("bytes").alias("bytes")), "op8-sizes"))
    rows = levels[-1].orderBy("place").toArrow()  # at most 200,000
    place, size = rows.column("place").to_numpy(), rows.column("bytes").to_numpy()
    before = np.cumsum(size) - size
    first = np.unique(before // shard_bytes, return_index=True)[1]
    return [int(place[i]) << shift for i in first]


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, least: int = 0) -> DataFrame:
    """Writes a record per page below ``folder`` and gives the manifest (part, final, records, bytes).

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest page_id is a
    response and the others are revisits of it. Rows that repeat a page_id have a record each, and
    of those with the same payload the first is the response. A null html is an empty payload, a
    null url an empty one; a page without an id is always a response and comes first. An empty
    table gives no file and an empty manifest; other columns are not read.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    html = F.coalesce("html", F.lit(""))
    source = source.withColumn("place", F.coalesce("page_id", F.lit(_NULL_ID)))
    narrow = written(source.select("page_id", "place", F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).cast("long").alias("bytes")), "op8-digests")
    bounds = _bounds(narrow.select("place", (F.col("bytes") + 512).alias("bytes")), shard_bytes)
    again = narrow.where(F.col("page_id").isNotNull() & (F.col("bytes") >= least)).groupBy("sha1").agg(F.min("page_id").alias("refers"), F.count("*").alias("n")).where("n > 1").select("sha1", "refers")
    refers = narrow.join(written(again, "op8-again"), "sha1").where("page_id IS NOT NULL").select("place", "sha1", "refers").distinct()

    starts = np.array(bounds or [0], np.int64)

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(starts, column(batch, "place").to_numpy(zero_copy_only=False), side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.maximum(at, 0).astype(np.int32))], names=[*batch.schema.names, "shard"])

    none = F.lit(None)
    rows = source.select("place", none.cast("string").alias("sha1"), none.cast("long").alias("refers"), "page_id", "url", "html")
    rows = rows.unionByName(refers.select("place", "sha1", "refers", none.cast("long").alias("page_id"), none.cast("string").alias("url"), none.cast("string").alias("html")))
    dealt = rows.mapInArrow(shard_of, "place long, sha1 string, refers long, page_id long, url string, html string, shard int").repartition(len(starts), "shard")
    dealt = dealt.sortWithinPartitions("shard", "place", F.col("sha1").isNull(), "sha1", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(f"{root}/_temporary", recursive=True)
    manifest = written(dealt.mapInArrow(lambda it: _write_rows(it, folder, file_bytes, least), _MANIFEST), "op8-manifest")
    for row in manifest.toLocalIterator():
        fs.move(row["part"], row["final"])
    return manifest


def _read_rows(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, _ = pafs.FileSystem.from_uri(folder)
    for batch in batches:
        for name in column(batch, "final").to_pylist():
            out: list[tuple] = []
            with fs.open_input_stream(name, compression=None) as stream:
                for raw in _members(stream):
                    head, _, rest = raw.partition(b"\r\n\r\n")
                    fields = dict(x.split(": ", 1) for x in head.decode("ascii").split("\r\n")[1:])
                    block = rest[: int(fields["Content-Length"])]
                    if f"sha1:{_digest(block)}" != fields["WARC-Block-Digest"]:
                        raise ValueError(f"damaged record in {name}")
                    page, refers = fields["X-Page-Id"].strip(), fields.get("X-Refers-To-Page-Id")
                    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
                    size = int(fields["X-Payload-Length"]) if payload is None else len(payload)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:") if payload is None else _digest(payload)
                    out.append((int(page) if page else None, size, digest, fields["WARC-Type"], int(refers) if refers else None, payload))
                    if sum(len(x[5] or b"") for x in out[-100:]) > 4 << 20 or len(out) >= 1000:
                        yield _read_batch(out)
                        out = []
            if out:
                yield _read_batch(out)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def _members(stream: pa.NativeFile) -> Iterator[bytes]:
    """Records of a file, one gzip member each, without the whole file in memory."""
    data = b""
    while True:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                data = stream.read(1 << 20)
                if not data:
                    return
            out.append(unpacker.decompress(data))
            data = unpacker.unused_data
        yield b"".join(out)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the manifest's files: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    Digests and lengths of responses are made anew from the payload; those of revisits, which have
    none, are what the record says. A block that does not fit its digest is an error.
    """
    files = manifest.select("final").repartition("final")
    return files.mapInArrow(lambda it: _read_rows(it, folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    folder = folder if ":/" in folder else f"file://{folder}"
    return read_archives(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder).drop("payload")


# Base 32 digits of a digest are five bits each: eight of them to five bytes.
OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, row_number() OVER () AS r FROM pages),
q AS (SELECT page_id, r, octet_length(b) AS n, sha1(b) AS h FROM p),
m AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first, row_number() OVER (PARTITION BY h ORDER BY page_id, r) AS k
  FROM q),
d AS (
  SELECT r, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1), '' ORDER BY i) AS digest
  FROM q, range(32) AS u(i) GROUP BY r)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NULL OR k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NULL OR k = 1 THEN NULL ELSE first END AS refers_to
FROM m JOIN d USING (r)
"""
