"""WARC archives: write pages with an index, and read selected records back by byte range.

Each task writes one file after another, every record a gzip member of its own, and returns
the index: file, offset, length, URL and digest of each record. The index is written as a
table, so only files of tasks that succeeded are ever looked at; files of lost attempts have
other names and stay unread. To read, the selected index rows are sorted by file and offset,
neighbours are joined into one range request, and each record is cut out and parsed.

Records with equal payloads of ``min_bytes`` or more are stored once: the one with the
smallest id as ``response``, the others as ``revisit`` of it.

Defined cases: a null payload is an empty one; a null URL is left out of the record; a row
with a null id is a revisit wherever a row with an id has its payload, and else a response;
rows repeated whole are all responses if they bear the smallest id; an empty table gives an
empty result. Other columns are not looked at.
"""

import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from ..session import shared_dir
from .common import as_bytes, few, materialize, quoted

MIN_BYTES = 100
FILE_BYTES = 1 << 30
#: Neighbouring records at most this far apart share a request of at most this size.
GAP, REQUEST = 1 << 16, 8 << 20
TASK_BYTES = 32 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(place):
    """File system and path of a folder named by path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(place if re.match(r"\w+:/", place) else f"file://{place}")


def record(name, url, payload, digest, refers_to, date):
    """One WARC record; with ``refers_to`` a revisit, which leaves the payload out."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d"
             b"\r\n\r\n" % len(payload))
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:record:{quote(str(name))}>", f"WARC-Date: {date}",
             f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if url is not None:
        uri = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url)
        lines.append("WARC-Target-URI: " + uri.decode("utf-8", "surrogateescape"))
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:record:{quote(str(refers_to))}>"]
    lines.append(f"Content-Length: {len(block)}")
    head = "\r\n".join(lines).encode("utf-8", "surrogateescape")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data):
    """Headers of a record (names in lower case), the length its payload had, the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogateescape").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?mi)^content-length:\s*(\d+)", http)
    return fields, int(stated[1]), payload


def compressed(data, level):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Archive:
    """The files one task writes."""

    def __init__(self, folder, task, file_bytes):
        self.system, self.path = file_system(folder)
        self.task, self.file_bytes = task, file_bytes
        self.count, self.stream = 0, None

    def add(self, data):
        if self.stream is None or self.stream.tell() >= self.file_bytes:
            self.close()
            self.name = f"{self.task:06d}-{self.count:04d}-{uuid.uuid4().hex}.warc.gz"
            self.count += 1
            self.stream = self.system.open_output_stream(f"{self.path}/{self.name}",
                                                         compression=None)
        offset = self.stream.tell()
        self.stream.write(data)
        return self.name, offset, len(data)

    def close(self):
        if self.stream is not None:
            self.stream.close()


def planned(pages, id_col, url, payload, min_bytes):
    """id, url, payload, digest and the id it refers to, if it is stored elsewhere."""
    body = F.coalesce(quoted(payload).cast("string"), F.lit(""))
    rows = pages.select(quoted(id_col).alias("id"), quoted(url).cast("string").alias("url"),
                        body.alias("payload"), F.sha2(body, 256).alias("digest"))
    shared = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1 and first is not null").select("digest", "first")
    shared = few(materialize(shared, "shared-payloads"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")),
                    F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(pages, folder, id_col="page_id", url="url", payload="html",
                   min_bytes=MIN_BYTES, file_bytes=FILE_BYTES, level=6,
                   date="2026-01-01T00:00:00Z"):
    """Write all ``pages`` into ``folder``; the index of the records, as a written table."""
    rows = planned(pages, id_col, url, payload, min_bytes)
    schema = T.StructType([
        rows.schema["id"], T.StructField("url", T.StringType()),
        T.StructField("digest", T.StringType()), T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)

    def write(batches):
        from pyspark import TaskContext

        archive = Archive(folder, TaskContext.get().partitionId(), file_bytes)
        for batch in batches:
            places = []
            columns = [batch.column("id").to_pylist(), as_bytes(batch.column("url")),
                       as_bytes(batch.column("payload")), batch.column("digest").to_pylist(),
                       batch.column("refers_to").to_pylist()]
            for name, uri, body, digest, first in zip(*columns):
                made = record(name, uri, body, digest, first, date)
                places.append(archive.add(compressed(made, level)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), batch.column("digest"),
                 *[pa.array([p[k] for p in places], kind)
                   for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]],
                names=[f.name for f in schema])
        archive.close()

    return materialize(rows.mapInArrow(write, schema), "warc-index")


def requests(places):
    """Join sorted (file, offset, length) into requests: (file, start, stop, positions)."""
    made = []
    for i, (name, offset, length) in enumerate(places):
        if made:
            last = made[-1]
            if (last[0] == name and offset - last[2] <= GAP
                    and offset + length - last[1] <= REQUEST):
                last[2] = max(last[2], offset + length)
                last[3].append(i)
                continue
        made.append([name, offset, offset + length, [i]])
    return made


def read_records(index, folder, with_payload=True):
    """The records that ``index`` selects: id, record_id, url, record_type, refers_to (text),
    payload_bytes, payload_digest (of a response: computed from its bytes) and payload."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    rows = index.select("id", "file", "offset", "length").repartitionByRange(
        tasks, "file", "offset").sortWithinPartitions("file", "offset")
    texts = ["record_id", "url", "record_type", "refers_to"]
    schema = T.StructType([
        index.schema["id"], *[T.StructField(n, T.StringType()) for n in texts],
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        *([T.StructField("payload", T.BinaryType())] if with_payload else [])])

    def urn(value):
        return value and unquote(value.removeprefix("<urn:record:").removesuffix(">"))

    def read(batches):
        system, path = file_system(folder)
        opened, stream = None, None
        for batch in batches:
            places = list(zip(*[batch.column(n).to_pylist() for n in ("file", "offset", "length")]))
            for name, start, stop, at in requests(places):
                if name != opened:
                    opened, stream = name, system.open_input_file(f"{path}/{name}")
                data = memoryview(stream.read_at(stop - start, start))
                found = []
                for i in at:
                    _, offset, length = places[i]
                    part = data[offset - start:offset - start + length]
                    fields, size, payload = parsed(zlib.decompress(part, 31))
                    kind = fields["warc-type"]
                    stated = fields["warc-payload-digest"].removeprefix("sha256:")
                    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else stated
                    if digest != stated or (kind == "response" and len(payload) != size):
                        raise ValueError(f"record at {offset} of {name} is damaged")
                    found.append((urn(fields["warc-record-id"]), fields.get("warc-target-uri"),
                                  kind, urn(fields.get("warc-refers-to")), size, digest, payload))
                columns = list(zip(*found))[:7 if with_payload else 6]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at)),
                     *[pa.array(c, kind) for c, kind in zip(columns, [
                         *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()])]],
                    names=[f.name for f in schema])

    return rows.mapInArrow(read, schema)


def archived(pages, id_col="page_id", **options):
    """Write all pages, read every record back, and describe it."""
    folder = shared_dir(pages.sparkSession, "warc")
    index = write_archives(pages, folder, id_col, **options)
    kind = index.schema["id"].dataType
    return read_records(index, folder, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH sized AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest,
         octet_length(encode(coalesce(html, '')))::bigint AS payload_bytes
  FROM pages),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM firsts
"""
