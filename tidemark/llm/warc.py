"""Deterministic WARC archives of pages, written in shards and read back."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.sources.session import run_folder

MIN_REVISIT_BYTES = 1000
SHARD_BYTES = 32 << 20
ROLL_BYTES = 8 << 20
# Ids read to place the shard bounds.
MAX_SAMPLE = 200_000
# Fixed value: archives carry one date, so that equal pages give equal bytes.
DATE = "2024-01-01T00:00:00Z"
NULL_ID = "none"
READ_BYTES = 1 << 20


@dataclass(frozen=True)
class Limits:
    min_revisit_bytes: int = MIN_REVISIT_BYTES
    shard_bytes: int = SHARD_BYTES
    roll_bytes: int = ROLL_BYTES


def payload_sizes(pages: DataFrame) -> DataFrame:
    """page_id, payload size and digests, as a written table."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    sizes = pages.select(
        "page_id",
        F.octet_length(payload).cast("long").alias("n_bytes"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("sha256"),
    )
    return saved(sizes, "payloads")


def revisits(sizes: DataFrame, limits: Limits) -> DataFrame:
    """page_id and payload digest of the records that revisit another, and which.

    Only digests are shuffled; a payload that many pages share is added up before.
    """
    long = sizes.where((F.col("n_bytes") >= limits.min_revisit_bytes) & F.col("page_id").isNotNull())
    newest = long.groupBy("sha256", "n_bytes").agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("n")
    )
    # Written, so that Spark can split the rows of a payload that many pages share.
    newest = saved(newest.where("n > 1").drop("n"), "newest")
    joined = long.join(newest, ["sha256", "n_bytes"]).where("page_id < refers_to")
    return saved(joined.select("page_id", "sha1", "refers_to").distinct(), "revisits")


def shard_bounds(judged: DataFrame, limits: Limits) -> list[int]:
    """First page ids of the shards but the first, about ``shard_bytes`` of payload apart.

    At most MAX_SAMPLE / 8 shards are made. The bounds come from a sample by hash of about
    MAX_SAMPLE ids at most, so they depend on the pages
    only and not on how the rows are partitioned.
    """
    row = judged.agg(F.count("page_id").alias("n"), F.sum("n_bytes").alias("bytes")).first()
    n_shards = min(-(-(row["bytes"] or 0) // limits.shard_bytes), MAX_SAMPLE // 8)
    if n_shards < 2:
        return []
    share = min(1.0, MAX_SAMPLE / row["n"])
    drawn = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = judged.where(F.col("page_id").isNotNull() & drawn).select("page_id", "n_bytes")
    table = sample.toPandas().sort_values(["page_id", "n_bytes"])
    heavy = np.cumsum(table["n_bytes"].to_numpy(dtype=float))
    cuts = np.searchsorted(heavy, heavy[-1] * np.arange(1, n_shards) / n_shards) if len(heavy) else []
    return sorted({int(table["page_id"].iloc[min(c, len(table) - 1)]) for c in cuts})


def _header(lines: list[tuple[str, object]]) -> bytes:
    return ("".join(f"{name}: {value}\r\n" for name, value in lines)).encode() + b"\r\n"


def _one_line(url: str | None) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url or "")


def _base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """One compressed record; headers and digests are made anew from the page."""
    http = b"HTTP/1.1 200 OK\r\n" + _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    )
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{NULL_ID if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{_base32(sha1)}"),
        ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).hexdigest())}"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    plain = b"WARC/1.1\r\n" + _header(fields) + block + b"\r\n\r\n"
    return packer.compress(plain) + packer.flush()


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


_MANIFEST = {
    "shard": "long",
    "part": "long",
    "temporary": "string",
    "records": "long",
    "bytes": "long",
    "sha256": "string",
}
_ROW = ("shard", "page_id", "is_page", "sha1", "refers_to", "url", "html")


class _Roller:
    """Writes records to files of one shard, a new one where the next record would pass the limit."""

    def __init__(self, folder: str, limits: Limits) -> None:
        self.store, self.base = _filesystem(folder)
        self.limit = limits.roll_bytes
        self.attempt = uuid.uuid4().hex
        self.stream = None
        self.shard, self.part = None, 0
        self.lines: list[tuple] = []

    def write(self, shard: int, data: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        elif self.stream is not None and self.size + len(data) > self.limit:
            self.close()
            self.part += 1
        if self.stream is None:
            self.name = f"{self.base}/tmp/shard-{shard:06d}-{self.part:05d}.{self.attempt}"
            self.stream = self.store.open_output_stream(self.name)
            self.records, self.size, self.digest = 0, 0, hashlib.sha256()
        self.stream.write(data)
        self.digest.update(data)
        self.records += 1
        self.size += len(data)

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        self.stream = None
        self.lines.append(
            (self.shard, self.part, self.name, self.records, self.size, self.digest.hexdigest())
        )


def _write_shards(folder: str, limits: Limits):
    """Archives of a sorted partition under temporary names; yields one line for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _Roller(folder, limits)
        page, known = None, {}
        for batch in batches:
            columns = [batch.column(name) for name in _ROW]
            for row in zip(*columns, strict=True):
                shard, page_id, is_page, sha1, refers_to, url, html = (v.as_py() for v in row)
                if page_id != page:
                    page, known = page_id, {}
                if not is_page:
                    known[sha1] = refers_to
                    continue
                payload = (html or "").encode()
                roller.write(shard, record(page_id, url, payload, sha1, known.get(sha1)))
        roller.close()
        if roller.lines:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*roller.lines, strict=True)], list(_MANIFEST)
            )

    return run


def _commit(folder: str):
    """Moves the listed files to their final names; a repeated move of one file is harmless."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _filesystem(folder)
        for frame in frames:
            names = []
            for line in frame.itertuples():
                name = f"{base}/shard-{line.shard:06d}-{line.part:05d}.warc.gz"
                if store.get_file_info(line.temporary).type == fs.FileType.File:
                    store.move(line.temporary, name)
                names.append(name)
            yield frame.drop(columns="temporary").assign(file=names)

    return run


def write_archives(pages: DataFrame, folder: str, limits: Limits = Limits()) -> DataFrame:
    """Writes the archives below ``folder``; the manifest: one row per file, sorted names.

    Shards are ranges of page_id and records are sorted inside, so the same pages and limits give
    the same bytes, however Spark deals the rows out. A file is closed before it would
    pass ``roll_bytes`` compressed, so only a single larger record makes a larger file. Tasks write
    under names of their own; when all have ended, the files that the winning attempts
    reported get their final names, and the manifest, written last, lists them. A reader follows
    the manifest, so a lost or repeated task leaves nothing to see.

    A NULL html is an empty payload, a NULL url an empty one. Rows without page_id come first, are
    always responses and are never referred to. Rows that share page_id and payload are written
    each. Other columns are not read. An empty table gives an empty manifest. The folder must be
    one that pyarrow opens on every executor (a shared path, HDFS or an object store).
    """
    sizes = payload_sizes(pages)
    bounds = np.array(shard_bounds(sizes, limits), dtype=np.int64)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(dtype=np.int64), "right"))

    columns = ["page_id", "sha1", "refers_to", "url", "html", "is_page"]
    rows = pages.select(
        "page_id", "url", "html",
        F.sha1(F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")).alias("sha1"),
        F.lit(None).cast("long").alias("refers_to"),
        F.lit(True).alias("is_page"),
    ).select(columns)
    other = revisits(sizes, limits).withColumns(
        {
            "url": F.lit(None).cast("string"),
            "html": F.lit(None).cast("string"),
            "is_page": F.lit(False),
        }
    )
    rows = rows.unionByName(other.select(columns))
    lowest = F.lit(-(1 << 63)).cast("long")
    rows = rows.withColumn("shard", shard_of(F.coalesce(F.col("page_id").cast("long"), lowest)))
    placed = rows.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "is_page", "sha1", "url"
    )
    kind = ", ".join(f"{name} {kind}" for name, kind in _MANIFEST.items())
    store, base = _filesystem(folder)
    store.create_dir(f"{base}/tmp", recursive=True)
    written = saved(placed.select(*_ROW).mapInArrow(_write_shards(folder, limits), kind), "written")
    final = written.drop("temporary").withColumn("file", F.lit("")).schema
    manifest = saved(written.mapInPandas(_commit(folder), final), "manifest")
    store.delete_dir(f"{base}/tmp")
    return manifest


def _records(stream) -> Iterator[bytes]:
    """The uncompressed records of an archive, one in memory at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    while data := stream.read(READ_BYTES):
        while data:
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def parsed(plain: bytes) -> tuple:
    """(page_id, payload size, payload digest, record type, refers_to) of one record.

    A response's payload is measured and digested anew and compared with its headers.
    """
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_fields(http)["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page_id, refers_to = (
        fields[name][len("<urn:page:") : -1] if name in fields else NULL_ID
        for name in ("WARC-Record-ID", "WARC-Refers-To")
    )
    numbers = [None if value == NULL_ID else int(value) for value in (page_id, refers_to)]
    return numbers[0], size, digest, fields["WARC-Type"], numbers[1]


_PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the files that the manifest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _filesystem(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with store.open_input_stream(name, compression=None) as stream:
                    for plain in _records(stream):
                        rows.append(parsed(plain))
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    files = manifest.select("file").repartition(_spread(manifest), "file")
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string"
    return files.mapInArrow(run, f"{kinds}, refers_to long")


def _spread(manifest: DataFrame) -> int:
    return max(1, min(manifest.count(), 10_000))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kind.type) for c, kind in zip(columns, _PARSED, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARSED)


def archive_and_read(pages: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Writes ``pages`` to a new folder below the shared one and reads the archives back."""
    folder = run_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, limits), folder)
