"""WARC archives: writing, normalising monolithic gzip files, reading by a sidecar index.

``write_archives`` streams records into files that are one gzip stream each, as careless
tools make them. ``normalise`` inflates such a file once, front to back, cuts it into records, writes every record
as a gzip member of its own and, beside the archive, an index with one line per record: offset,
length, type, record id. ``read_archives`` seeks by the index and inflates member by
member. Files are streamed; a task holds one record at a time. Each attempt of a task writes files of its
own, and the stored manifests name those that count.

Of pages with equal payloads, that of the largest page_id is a response, the others are revisits that
refer to it. Equal payloads are found by a grouping over digests only; payloads move once, to meet their group.

Defined results: null html is an empty payload, null url an empty URI; a null page_id is smaller than any other; rows
that repeat the largest page_id with the same payload are responses too; an empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.words import files_at
from merchlens.session import scratch_path

FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
GZIP = 31
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed record; a revisit has the payload's digest and size but not the payload."""
    body = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%')}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    head = "\r\n".join([*lines, "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""])
    return head.encode() + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:] if line)


def inflated(read, size: int = READ_BYTES) -> Iterator[bytes]:
    """The content of a file of one or several gzip members, part by part."""
    machine = zlib.decompressobj(GZIP)
    while data := read(size):
        while data:
            yield machine.decompress(data, size)
            while machine.unconsumed_tail:
                yield machine.decompress(machine.unconsumed_tail, size)
            data = machine.unused_data
            if machine.eof:
                machine = zlib.decompressobj(GZIP)


def records_in(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of an uncompressed stream."""
    held = bytearray()
    head: dict[str, str] | None = None
    need = 0
    seen = 0
    for part in parts:
        held += part
        while True:
            if head is None:
                at = held.find(b"\r\n\r\n", max(0, seen - 3))
                if at < 0:
                    seen = len(held)
                    break
                head = parse_head(bytes(held[:at]))
                need = at + 8 + int(head["Content-Length"])
            if len(held) < need:
                break
            yield head, bytes(held[:need])
            del held[:need]
            head, seen = None, 0
    if held:
        raise ValueError("the archive ends within a record")


class _File:
    """A file of this attempt."""

    def __init__(self, uri: str, name: str):
        fs, path = files_at(uri)
        fs.create_dir(path, recursive=True)
        self.name, self.size = f"{name}-{uuid.uuid4().hex[:12]}", 0
        self.out = fs.open_output_stream(f"{path}/{self.name}")

    def write(self, data: bytes) -> int:
        self.out.write(data)
        self.size += len(data)
        return self.size

    def close(self) -> str:
        self.out.close()
        return self.name


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html, revisit, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.unhex(F.sha1("html")))
    copies = rows.groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).filter("n > 1").select("digest", "keep", F.lit(True).alias("copied"))
    revisit = F.coalesce("copied", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return rows.join(copies, "digest", "left").select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("keep")).alias("refers_to"))


def write_archives(pages: DataFrame, uri: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one gzip stream per file; pages as of ``with_references``. Returns the manifest (file, n_records)."""
    def run(batches):
        part, number, file, machine, n, size = TaskContext.get().partitionId(), 0, None, None, 0, 0

        def close() -> pa.RecordBatch:
            file.write(machine.flush())
            return pa.RecordBatch.from_pydict({"file": [file.close()], "n_records": [n]})

        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    file, machine, n, size = _File(uri, f"pages-{part:06d}-{number:04d}.warc.gz"), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0, 0
                data = record(row["page_id"], row["url"], row["html"].encode("utf-8", "surrogatepass"), row["refers_to"], row["revisit"])
                file.write(machine.compress(data))
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    yield close()
                    file, number = None, number + 1
        if file:
            yield close()

    return pages.mapInArrow(run, "file string, n_records bigint")


def normalise(manifest: DataFrame, uri: str, into: str) -> DataFrame:
    """Rewrites each file record by record, with its index. Returns the manifest (file, index, n_records)."""
    def run(batches):
        fs, path = files_at(uri)
        for batch in batches:
            for row in batch.to_pylist():
                archive, index, n = _File(into, f"{row['file']}.members"), _File(into, f"{row['file']}.index"), 0
                with fs.open_input_stream(f"{path}/{row['file']}", compression=None) as source:
                    for head, whole in records_in(inflated(source.read)):
                        at = archive.size
                        machine = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        archive.write(machine.compress(whole) + machine.flush())
                        index.write(f"{at} {archive.size - at} {head['WARC-Type']} {head['WARC-Record-ID']}\n".encode())
                        n += 1
                if n != row["n_records"]:
                    raise ValueError(f"{row['file']}: {n} records, {row['n_records']} written")
                yield pa.RecordBatch.from_pydict({"file": [archive.close()], "index": [index.close()], "n_records": [n]})

    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, "file string, index string, n_records bigint")


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(manifest: DataFrame, uri: str) -> DataFrame:
    """A row per record, by the index; a response's payload is held against its digest and size."""
    def one(whole: bytes) -> dict:
        head, body = next(records_in(iter([whole])))
        payload = body[-4 - int(head["Content-Length"]) : -4]
        digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
        if head["WARC-Type"] == "response" and (digest_of(payload), len(payload)) != (digest, size):
            raise ValueError(f"{head['WARC-Record-ID']}: the payload differs from its digest")
        return {"page_id": _page(head["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": head["WARC-Type"],
                "refers_to": _page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None}

    def run(batches):
        fs, path = files_at(uri)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as archive, fs.open_input_stream(f"{path}/{row['index']}", compression=None) as index:
                    held, rows = b"", []
                    while part := index.read(READ_BYTES):
                        *lines, held = (held + part).split(b"\n")
                        for line in lines:
                            offset, length = map(int, line.split(b" ", 2)[:2])
                            archive.seek(offset)
                            rows.append(one(zlib.decompress(archive.read(length), GZIP)))
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows = []

    return manifest.repartition(max(1, manifest.count())).mapInArrow(run, RECORD)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    uri, rough, clean = (scratch_path(spark, n) for n in ("warc", "warc-streams", "warc-members"))
    write_archives(with_references(spark.read.parquet(f"{sf_dir}/pages.parquet")), f"{uri}/streams").write.parquet(rough)
    normalise(spark.read.parquet(rough), f"{uri}/streams", f"{uri}/members").write.parquet(clean)
    return read_archives(spark.read.parquet(clean), f"{uri}/members")


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP2_SQL = f"""
with hashed as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), groups as (
  select h, max(page_id) as keep, count(*) as n from hashed group by h
)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: substr('{_BASE32}', ((('0x' || substr(h, (i // 4)::int * 5 + 1, 5))::int >> ((3 - i % 4) * 5)::int) & 31) + 1, 1)), lambda a, b: a || b) as payload_digest,
       case when n > 1 and page_id is distinct from keep then 'revisit' else 'response' end as record_type,
       case when n > 1 and page_id is distinct from keep then keep end as refers_to
from hashed join groups using (h)
"""
