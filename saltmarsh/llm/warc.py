"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by page id and written by partition into files of gzip members (one a record)
that roll by compressed size. Headers and digests are made anew from the payload. Of records with
equal payloads the one with the smallest id is a response, the others are revisits that refer to
it and carry no payload; a revisit's own length and digest stand in its headers. Files are written under
temporary names and renamed, then a manifest (one row a file: name, records, bytes, SHA-256) is written and renamed last;
a reader takes only files of the manifest. Nothing depends on the clock or on attempts: equal input and
partitioning give equal bytes.

The choice of responses runs on narrow rows (id, digest); each page meets its own choice in the one range
shuffle that sorts the pages, so pages are shuffled once.

Nulls: a null html is an empty payload, a null url an empty target, null ids sort first and are the last
choice for a response. Repeated rows are records of their own (the first, in the order read, is the response).
Payloads below `least_bytes` are always responses. Payloads are streamed record by record, of any length.
An empty table gives no files and an empty result. The input must be read again in the same order (a file scan).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, scratch_path, ship_package, stored, text_or_empty
from .exact import steady, tagged
from .remote import Committed, at, write_whole

ROLL_BYTES, DATE = 64 << 20, "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, tag: int) -> str:
    """A URN made of the id and the row's tag."""
    h = hashlib.sha1(f"{page_id} {tag}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}>"


def record(page_id: int | None, tag: int, url: str, payload: bytes, refers_to: int | None, refers_tag: int | None) -> bytes:
    """One record; a revisit where `refers_tag` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_tag is None else http
    target = "".join(c for c in url if c > " ") or "about:blank"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_tag is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, tag)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(body)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_tag is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, refers_tag)}", *([f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else [])]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """row_tag, refers_to, refers_tag of the rows that are revisits; narrow rows only."""
    narrow = stored(pages.select("page_id", "row_tag", F.unhex(F.sha1(F.encode("payload", "UTF-8"))).alias("digest"), F.octet_length("payload").alias("size")), "warc-digests")
    own = narrow.filter(F.col("size") >= least_bytes)
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row_tag"))
    groups = stored(own.groupBy("digest", "size").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "size", "first"), "warc-groups")
    met = own.join(groups, ["digest", "size"]).filter("row_tag <> first.row_tag")
    return met.select("page_id", "row_tag", F.col("first.page_id").alias("refers_to"), F.col("first.row_tag").alias("refers_tag"))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes archives of (page_id, url, html) below `folder` and its manifest; the manifest: path, records, bytes, sha256."""
    spark = pages.sparkSession
    ship_package(spark)
    rows = tagged(steady(pages), "row_tag").select(F.col("page_id").cast("long").alias("page_id"), "row_tag", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), text_or_empty("html").alias("payload"))
    choice = stored(responses(rows, least_bytes), "warc-revisits")
    nothing = F.lit(None)
    both = choice.select("page_id", "row_tag", nothing.cast("string").alias("url"), nothing.cast("string").alias("payload"), "refers_to", "refers_tag").unionByName(rows.select("*", nothing.cast("long").alias("refers_to"), nothing.cast("long").alias("refers_tag")))
    both = both.repartitionByRange(F.col("page_id").asc_nulls_first(), "row_tag").sortWithinPartitions(F.col("page_id").asc_nulls_first(), "row_tag", F.col("refers_tag").desc_nulls_last())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part, attempt, made, out, sha, revisit = task.partitionId(), str(task.taskAttemptId()), [], None, None, None

        def close() -> None:
            out.close()
            made[-1][2], made[-1][3] = out.size, sha.hexdigest()

        for batch in batches:
            for piece in chunks(batch, "payload"):
                for page, tag, url, payload, to, to_tag in zip(*[piece.column(c).to_pylist() for c in ("page_id", "row_tag", "url", "payload", "refers_to", "refers_tag")], strict=True):
                    if payload is None:  # the choice for the page that follows
                        revisit = (tag, to, to_tag)
                        continue
                    to, to_tag = revisit[1:] if revisit and revisit[0] == tag else (None, None)
                    if out is None:
                        path = f"{folder}/part-{part:06d}-{len(made):05d}.warc.gz"
                        out, sha = Committed(path, attempt), hashlib.sha256()
                        made.append([path, 0, 0, ""])
                    data = member(record(page, tag, url, payload.encode("utf-8"), to, to_tag))
                    out.write(data)
                    sha.update(data)
                    made[-1][1] += 1
                    if out.size >= roll_bytes:
                        close()
                        out = None
        if out is not None:
            close()
        for row in made:
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("path", "records", "bytes", "sha256"), row, strict=True)})

    manifest = stored(both.mapInArrow(run, "path string, records long, bytes long, sha256 string"), "warc-manifest")
    _commit(manifest, folder)
    return manifest


def _commit(manifest: DataFrame, folder: str) -> None:
    """The manifest as one text file, renamed into place by a single task (one line a file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = sorted("\t".join(map(str, r.values())) for b in batches for r in b.to_pylist())
        write_whole(f"{folder}/MANIFEST.tsv", "".join(f"{x}\n" for x in lines).encode(), "commit")
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(lines)], pa.int64())})

    manifest.coalesce(1).mapInArrow(run, "files long").collect()


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a stream of gzip members, one record in memory at a time."""
    buffer = b""
    while True:
        z, data, fed = zlib.decompressobj(31), [], False
        while not z.eof:
            if not buffer:
                buffer = stream.read(1 << 20)
                if not buffer:
                    if fed:
                        raise ValueError("an archive ends within a record")
                    return
            data.append(z.decompress(buffer))
            buffer, fed = z.unused_data, True
        whole = b"".join(data)
        head, _, rest = whole.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        if len(rest) != size + 4:
            raise ValueError("a record's length is not that of its header")
        yield headers, rest[:size]


def read_warc(spark: SparkSession, manifest: DataFrame, payload: bool = False) -> DataFrame:
    """Per record of the manifest's files: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, and the payload if asked for.

    Digests of blocks, and of payloads that are there, are made anew and must be those of the headers.
    """
    ship_package(spark)
    files = manifest.select("path").repartition(max(1, manifest.count()))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [*kinds, pa.binary()][: len(rows[0])], strict=True)]
            return pa.RecordBatch.from_arrays(cols, [*names, "payload"][: len(cols)])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, name = at(path)
                rows, held = [], 0
                with where.open_input_stream(name, compression=None) as stream:
                    for h, block in read_records(stream):
                        http, _, body = block.partition(b"\r\n\r\n")
                        digest, kind = h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"]
                        if h["warc-block-digest"] != f"sha1:{base32_sha1(block)}" or kind == "response" and digest != base32_sha1(body):
                            raise ValueError(f"a digest does not fit in {path}")
                        size = int(http.decode("latin-1").lower().partition("content-length:")[2].split("\r\n")[0])
                        page, to = h.get("x-page-id"), h.get("x-refers-to-page-id")
                        rows.append((None if page is None else int(page), size, digest, kind, None if to is None else int(to), h["warc-target-uri"], *([body if kind == "response" else None] if payload else [])))
                        held += len(body) if payload else 200
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string" + ", payload binary" * payload)


def warc_digest(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    manifest = write_warc(pages, folder or scratch_path(spark, "warc"))
    return read_warc(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
