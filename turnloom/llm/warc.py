"""WARC archives of captures: writing, reading, and assembling transactions.

A capture is a transaction of three records: the request, the response (or a
revisit, when an earlier capture has the same payload), and a metadata record.
Request and metadata name the response by WARC-Concurrent-To.  Every record is a
gzip member of its own.  Reading parses the archives as a stream; assembling
joins the records of a transaction through their concurrent-to identifiers and
gives one nested row per capture.

Payloads are equal when their SHA-1 is; the digests are grouped, not the
payloads.  The join of pages with the first of each digest leaves hot digests to
adaptive skew splitting; payloads of revisits are not written.  A task writes its
rows in order of digest, page_id and url, so an attempt that repeats it writes
the same bytes.

* A null html is an empty payload, a null url an empty target.
* Rows that share the smallest page_id of a payload are all responses.
* An empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from uuid import UUID

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import file_system, publish, scan_splits
from turnloom.session import cut_lineage, scratch_path

MIN_REVISIT_BYTES = 0
FILE_BYTES = 64 << 20
DATE = "2026-01-01T00:00:00Z"  # archives of a table have no clock
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "file string, offset long, record_id string, type string, concurrent_to string, refers_to string, target string, "
    "payload_digest string, payload_bytes long, block binary"
)


def _urn(*parts: object) -> str:
    return UUID(bytes=hashlib.md5("\x1f".join(map(str, parts)).encode()).digest(), version=5).urn


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: dict[str, str], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    packer = zlib.compressobj(1, wbits=31)
    return packer.compress(head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def transaction(page_id: int | None, url: str | None, html: str | None, first: int | None, at: str, again: bool = False) -> bytes:
    """The three records of a capture; ``first`` is the page it revisits, ``again`` marks a repeated response."""
    payload = (html or "").encode()
    digest = digest_of(payload)
    # Line breaks would end a header.
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    # A page without an id is revisited by none, and others like it have responses of their own.
    own = _urn("response", page_id, digest) if first is None and not again and page_id is not None else _urn("other", page_id, at)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = {"WARC-Date": DATE, "WARC-Target-URI": target}
    main = {"WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": f"<{own}>", **common}
    main |= {"WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
    if first is not None:
        main |= {"WARC-Profile": REVISIT, "WARC-Refers-To": f"<{_urn('response', first, digest)}>"}
    near = {**common, "WARC-Concurrent-To": f"<{own}>"}
    request = {"WARC-Type": "request", "WARC-Record-ID": f"<{_urn('request', page_id, at)}>", **near, "Content-Type": "application/http;msgtype=request"}
    metadata = {"WARC-Type": "metadata", "WARC-Record-ID": f"<{_urn('metadata', page_id, at)}>", **near, "Content-Type": "application/warc-fields"}
    fields = f"pageId: {'' if page_id is None else page_id}\r\npayloadBytes: {len(payload)}\r\n".encode()
    records = [
        _record(request, f"GET {target} HTTP/1.1\r\n\r\n".encode()),
        _record(main, http + (payload if first is None else b"")),
        _record(metadata, fields),
    ]
    return b"".join(records)


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one transaction per row of (page_id, url, html) into the folder: (file, n_records)."""
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = rows.withColumn("_digest", F.sha1(body))
    long_enough = rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
    firsts = long_enough.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    firsts, _ = cut_lineage(firsts.where("_n > 1").select("_digest", "_first"), "payload-firsts")
    joined = rows.join(firsts, "_digest", "left").withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")))

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        task = TaskContext.get()
        held: list[bytes] = []
        heads: set[int | None] = set()  # pages whose payload others share and whose response is written
        size = made = seen = 0

        def flush() -> pd.DataFrame:
            name = f"captures-{task.partitionId():06d}-{made:05d}.warc.gz"
            publish(fs, root, name, task.taskAttemptId(), iter(held))
            return pd.DataFrame({"file": [name], "n_records": [3 * len(held)]})

        for batch in batches:
            for page, url, html, first, shared in zip(batch["page_id"], batch["url"], batch["html"], batch["first"], batch["shared"]):
                page = None if pd.isna(page) else int(page)
                first = None if pd.isna(first) else int(first)
                again = bool(shared) and first is None and page in heads
                if shared and first is None:
                    heads.add(page)
                data = transaction(page, url, html, first, f"{task.partitionId()}:{seen}", again)
                held.append(data)
                size += len(data)
                seen += 1
                if size >= file_bytes:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    # A task that runs again must write the same files, in whatever order its rows arrive.
    placed = joined.sortWithinPartitions("_digest", "page_id", "url", F.octet_length("html"))
    files = placed.select("page_id", "url", "html", "first", F.col("_first").isNotNull().alias("shared")).mapInPandas(written, "file string, n_records long")
    return cut_lineage(files, "warc-files")[0]


class _Members:
    """Records of an archive, one gzip member after the other."""

    def __init__(self, fs: pafs.FileSystem, path: str, chunk: int = 1 << 20):
        self.file = fs.open_input_stream(path, compression=None)
        self.chunk = chunk

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        rest, at = b"", 0
        while rest or (rest := self.file.read(self.chunk)):
            unpack = zlib.decompressobj(wbits=31)
            out, used = [], 0
            while not unpack.eof:
                if not rest:
                    rest = self.file.read(self.chunk)
                    if not rest:
                        raise ValueError("an archive ends inside a record")
                out.append(unpack.decompress(rest))
                used += len(rest) - len(unpack.unused_data)
                rest = unpack.unused_data
            yield at, b"".join(out)
            at += used


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


def read(files: DataFrame, folder: str, blocks: bool = True) -> DataFrame:
    """Every record of the archives; payload digest and size are taken from the bytes where there are any."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for name in batch["file"]:
                for at, record in _Members(fs, f"{root}/{name}"):
                    fields, block = parse(record)
                    kind = fields["warc-type"]
                    digest = n = None
                    if kind in ("response", "revisit"):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        n = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (digest_of(payload) != digest or len(payload) != n):
                            raise ValueError(f"{name}: a payload is not what its record says")
                    rows.append((
                        name, at, fields["warc-record-id"], kind, fields.get("warc-concurrent-to"), fields.get("warc-refers-to"),
                        fields.get("warc-target-uri"), digest, n, block if blocks or kind == "metadata" else None,
                    ))
                    size += len(block)
                    if size > 8 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    names = [x.split()[0] for x in RECORDS.split(", ")]
    spread = files.select("file").repartition(scan_splits(files), "file")
    return spread.mapInPandas(parsed, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata.

    The records of a transaction are those of one archive that are, or are
    concurrent to, the same response.
    """
    one = F.struct("record_id", "target", "block")
    main = F.struct("record_id", "type", "target", "refers_to", "payload_digest", "payload_bytes", "block")
    kind = F.col("type")
    return records.groupBy("file", F.coalesce("concurrent_to", "record_id").alias("anchor")).agg(
        F.first(F.when(kind.isin("response", "revisit"), main), ignorenulls=True).alias("response"),
        F.first(F.when(kind == "request", one), ignorenulls=True).alias("request"),
        F.first(F.when(kind == "metadata", one), ignorenulls=True).alias("metadata"),
    )


def captures(assembled: DataFrame) -> DataFrame:
    """Page, payload and what it revisits of each assembled capture."""
    text = F.col("metadata.block").cast("string")
    page = F.regexp_extract(text, r"(?m)^pageId: (-?\d+)", 1).try_cast("bigint")
    flat = assembled.select(
        page.alias("page_id"), F.col("response.record_id").alias("record_id"), F.col("response.refers_to").alias("refers_to_record"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
    )
    flat, _ = cut_lineage(flat, "captures")
    revisits = flat.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("_wanted")).distinct()
    first = flat.where("record_type = 'response'").join(revisits, F.col("record_id") == F.col("_wanted"), "left_semi")
    named, _ = cut_lineage(first.groupBy(F.col("record_id").alias("refers_to_record")).agg(F.min("page_id").alias("refers_to")), "revisited")
    joined = flat.join(named, "refers_to_record", "left")
    return joined.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives in the shared folder, reads them back and assembles them."""
    folder = scratch_path(pages.sparkSession, "warc")
    return captures(assemble(read(write(pages, folder), folder, blocks=False)))
