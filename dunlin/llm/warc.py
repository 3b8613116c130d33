"""Deterministic sharded WARC writer and reader.

Records are sorted by id into shards of equal raw size, one task each; files roll by compressed
size, and every record is a gzip member of its own. Tasks write under temporary names; the manifest
lists what the successful attempts wrote, and only that gets a final name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.llm.mixing import BUCKET_ROWS, running_start
from dunlin.operators.joins import salted_join
from dunlin.operators.ordering import ranked
from dunlin.session import materialize

SHARD_BYTES = 64 << 20  # raw bytes of a shard
HEAD_BYTES = 512  # of a record beside its payload, about
MOST_TASKS = 1 << 16  # beyond so many shards a task writes several, one after the other
ROLL_BYTES = 32 << 20  # compressed bytes after which a file is closed
DATE = "1970-01-01T00:00:00Z"  # of all records: pages carry no time, and reruns must agree

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:dunlin:page:"


def _base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record(page_id: int | None, url: str | None, body: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP header only."""
    digest = _base32(hashlib.sha1(body).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_NAME}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_NAME}{refers_to}>"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _packed(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without a time
    return z.compress(record) + z.flush()


def _store(uri: str):
    """File system and path of a shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _revisits(rows: DataFrame) -> DataFrame:
    """Rows ``(id, sha, refers_to)`` of the records that repeat the payload of a larger id."""
    last = rows.groupBy("sha").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
    last = materialize(last.where("n > 1 and refers_to is not null").drop("n"), "warc-last")
    narrow = materialize(rows.select("id", "sha").distinct(), "warc-ids")
    found = salted_join(narrow, last, ["sha"])
    return found.where(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "sha", "refers_to")


def _cuts(rows: DataFrame, shard_bytes: int) -> list[int]:
    """First id of every shard but the first: one number per shard comes to the driver.

    A shard begins at the first record with a multiple of ``shard_bytes`` before it.
    """
    rows = rows.select("id", "sha", (F.col("size") + HEAD_BYTES).alias("size"))
    at = ranked(rows, ["id", "sha"]).withColumn("bucket", F.floor(F.col("row_id") / BUCKET_ROWS))
    at = running_start(at, [], "bucket", ["row_id"], "size", "before")
    firsts = at.groupBy(F.floor(F.col("before") / shard_bytes).alias("shard")).agg(F.min("id").alias("id"))
    found = firsts.where("shard > 0 and id is not null").select("id").distinct()
    return sorted(r["id"] for r in found.toLocalIterator())


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write a record per row into ``folder`` (a URI all executors reach); returns the manifest.

    Of rows with equal payloads the one with the largest id is a response, the others are
    revisits that refer to it. The manifest has ``file, shard, part, records, bytes, sha1``.
    Files depend on the rows only, not on how they are partitioned.

    A null payload is empty. A null url has no target header. A null id sorts first, and is
    a response only if no row of its payload has an id. Repeated rows are separate records;
    rows that share the largest id and the payload are all responses. An empty table gives
    an empty manifest. Other columns are ignored.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"),
        F.sha1(body.cast("binary")).alias("sha"),
    )
    # Ids and digests without payloads, computed once.
    narrow = materialize(rows.select("id", "sha", F.octet_length("body").cast("long").alias("size")), "warc-digests")
    cuts = np.array(_cuts(narrow, shard_bytes), np.int64)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        place = np.searchsorted(cuts, ids.where(known, 0).to_numpy().astype(np.int64), "right")
        return pd.Series(np.where(known, place, 0).astype(np.int32))

    # A revisit's target travels beside its row: one wide shuffle, no wide join.
    none = F.lit(None).cast("string")
    notes = _revisits(narrow).select("id", none.alias("url"), none.alias("body"), "sha", "refers_to", F.lit(0).alias("kind"))
    whole = rows.select("*", F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("kind"))
    every = notes.unionByName(whole).withColumn("shard", shard_of("id"))
    attempt = f".tmp-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        store.create_dir(f"{top}/{attempt}")
        out = name = shard = note = digest = None
        part = records = size = 0

        def close():
            out.close()
            return (f"warc-{shard:06d}-{part:04d}.warc.gz", name, shard, part, records, size, digest.hexdigest())

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("shard", "id", "sha", "kind", "refers_to", "url"))
            bodies = batch.column("body").cast(pa.binary()).to_pylist()
            for new, page, sha, kind, refers, url, payload in zip(*columns, bodies):
                if kind == 0:
                    note = (page, sha, refers)
                    continue
                if out is not None and (new != shard or size >= roll_bytes):
                    done.append(close())
                    out = None
                    part = part + 1 if new == shard else 0
                if out is None:
                    part = part if new == shard else 0
                    shard, records, size, digest = new, 0, 0, hashlib.sha1()
                    name = f"{attempt}/{uuid.uuid4().hex}"
                    out = store.open_output_stream(f"{top}/{name}")
                target = note[2] if note is not None and note[:2] == (page, sha) else None
                packed = _packed(_record(page, url, payload, target))
                out.write(packed)
                digest.update(packed)
                records, size = records + 1, size + len(packed)
            if done:
                yield _manifest_batch(done)
        if out is not None:
            yield _manifest_batch([close()])

    kinds = "file string, temporary string, shard int, part int, records long, bytes long, sha1 string"
    shards = len(cuts) + 1
    tasks = min(shards, MOST_TASKS)
    dealt = every.repartitionById(tasks, F.floor(F.col("shard").cast("long") * tasks / shards).cast("int"))
    ordered = dealt.sortWithinPartitions("shard", "id", "sha", "kind", "url")
    # Written before anything is renamed: it lists one attempt of each task.
    manifest = materialize(ordered.mapInArrow(write, kinds), "warc-manifest")

    def publish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(folder)
        from pyarrow import fs

        for frame in frames:
            for r in frame.itertuples():
                # A lost task may have renamed already.
                if store.get_file_info(f"{top}/{r.temporary}").type != fs.FileType.NotFound:
                    store.move(f"{top}/{r.temporary}", f"{top}/{r.file}")
            yield frame.drop(columns="temporary")

    final = manifest.mapInPandas(publish, kinds.replace("temporary string, ", ""))
    final.write.parquet(f"{folder.rstrip('/')}/_manifest")
    return spark.read.schema(final.schema).parquet(f"{folder.rstrip('/')}/_manifest")


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "temporary", "shard", "part", "records", "bytes", "sha1"]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _members(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            piece = data[at : at + 65536]
            if not piece:
                raise ValueError("archive ends inside a record")
            out.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        yield b"".join(out)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    page = fields["WARC-Record-ID"][1:-1].removeprefix(_NAME)
    refers = fields.get("WARC-Refers-To")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    whole = _base32(hashlib.sha1(block).digest()) == fields["WARC-Block-Digest"].removeprefix("sha1:")
    if kind == "response":
        whole = whole and size == len(payload) and _base32(hashlib.sha1(payload).digest()) == digest
    return (
        None if page == "none" else int(page), size, digest, kind,
        int(refers[1:-1].removeprefix(_NAME)) if refers else None, whole,
    )


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(id, payload_bytes, payload_digest, record_type, refers_to, intact)`` of the records.

    Only files with final names are read, a file per task step; ``intact`` tells whether the
    digests in the headers fit the blocks. An empty folder gives no rows.
    """
    kinds = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for record in _members(content.as_py()):
                    rows.append(_parsed(record))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("content").mapInArrow(read, kinds)
