"""WARC archives: a writer with payload deduplication, and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range of a file, looks for the gzip
magic in it, and takes a candidate only if it decodes to the end with a right checksum, begins with a
WARC header, and is as long as the header says. It owns the records that start in its range, reads past
the range's end to finish the last one, and so every record is read once whatever the ranges are.

Archives of others are read too (``manifest``): header names in any case, folded lines, records of any
type, payloads that are no HTTP messages, digests absent or of another kind (left as they are declared).
Nothing is skipped silently: where a member begins with a WARC header but is cut off or corrupt, or what
follows a record is no member, a row of type `damaged` gives the file and the place in `url`. A record
within a payload that is stored uncompressed cannot be told from one of the archive.

Of records with equal payloads of at least `min_bytes` bytes, the one with the largest id is a response
and the others revisit it. A null payload counts as empty. Defined results: repeated rows that share the
largest id are all responses; a row with a null id revisits an equal payload that has an id; null URLs
are left out; an empty table gives no file and an empty result; extra columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.arrowmap import arrow_schema
from weft.llm.common import shuffle_width, staged
from weft.session import ship

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, level: int = 6) -> bytes:
    """The gzip member of a response, or of a revisit where refers_to is given."""
    digest, again = _digest(payload), refers_to is not None
    head = {
        "WARC-Type": "revisit" if again else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>" if again or page_id is None else _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": "sha1:" + digest,
        "WARC-Profile": PROFILE if again else None,
        "WARC-Refers-To": _record_id(refers_to, digest) if again else None,
        "WARC-Refers-To-Date": date if again else None,
        "Weft-Page-ID": page_id,
        "Weft-Refers-To-Page-ID": refers_to,
        "Weft-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
    }
    block = HTTP + (b"" if again else payload)
    head["Content-Length"] = len(block)
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None) + "\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(lines.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def header(record: bytes) -> tuple[dict[str, str], int]:
    """A record's fields by lower-case name, and where its block begins. A line that begins with a blank goes
    on from the one before it."""
    end = record.find(b"\r\n\r\n")
    fields, last = {}, None
    for line in record[:end].decode("utf-8", "surrogateescape").split("\r\n")[1:] if end >= 0 else ():
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields, end + 4


def whole(record: bytes) -> bool:
    """A WARC header, and a block of the length that it declares."""
    fields, at = header(record)
    size = fields.get("content-length", "")
    return record.startswith(b"WARC/1.") and "warc-type" in fields and size.isdigit() and len(record) >= at + int(size)


def parse(record: bytes) -> dict:
    """The fields of RECORD and the payload of a decoded record: of an HTTP message what follows its header,
    of any other block all of it. Length and SHA-1 of a response's payload are taken from the payload, and
    the SHA-1 that it declares must be its own; of a revisit they are as declared."""
    fields, at = header(record)
    block, kind = record[at : at + int(fields["content-length"])], fields["warc-type"].lower()
    http = fields.get("content-type", "").lower().startswith("application/http")
    payload = block.partition(b"\r\n\r\n")[2] if http else block
    number = lambda k: int(fields[k]) if fields.get(k, "").removeprefix("-").isdigit() else None
    declared = fields.get("warc-payload-digest", "")
    out = {"page_id": number("weft-page-id"), "url": fields.get("warc-target-uri"), "payload_bytes": number("weft-payload-length"), "payload_digest": declared.removeprefix("sha1:") or None, "record_type": kind, "refers_to": number("weft-refers-to-page-id"), "payload": payload}
    if kind != "revisit":
        out |= {"payload_bytes": len(payload), "payload_digest": _digest(payload)}
        if kind == "response" and "weft-page-id" in fields and declared != "sha1:" + out["payload_digest"]:
            raise ValueError(f"the payload of page {out['page_id']} does not have its digest")
    return out


class Ranged:
    """A file's bytes from a start on, read in chunks as far as they are asked for."""

    def __init__(self, source, start: int, chunk: int = 1 << 20):
        self.source, self.start, self.chunk, self.data = source, start, chunk, bytearray()
        self.size = source.size()

    def upto(self, at: int) -> None:
        while self.start + len(self.data) < min(at, self.size):
            self.source.seek(self.start + len(self.data))
            self.data += self.source.read(self.chunk)

    def decoded(self, at: int) -> tuple[bytes, int] | bool:
        """The record that starts at `at` and its end; True if it has a WARC header but is damaged, else False."""
        unpack, out, i = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof:
                if i >= self.size:
                    return bool(out) and out[0].startswith(b"WARC/1.")
                self.upto(i + 65_536)
                piece = bytes(self.data[i - self.start : i - self.start + 65_536])
                out.append(unpack.decompress(piece))
                i += len(piece)
                if len(out) == 1 and len(out[0]) >= 7 and not out[0].startswith(b"WARC/1."):
                    return False
        except zlib.error:
            # What was unpacked of the failing piece is lost: unpack it again in small steps.
            head, unpack = b"".join(out)[:7], zlib.decompressobj(31)
            try:
                for k in range(at, min(at + 65_536, self.size), 64):
                    head += unpack.decompress(bytes(self.data[k - self.start : min(k + 64, self.size) - self.start])) if len(head) < 7 else b""
            except zlib.error:
                pass
            return head.startswith(b"WARC/1.")
        record = b"".join(out)
        return (record, i - len(unpack.unused_data)) if whole(record) else record.startswith(b"WARC/1.")


def records(source, start: int, end: int):
    """(offset, decoded record) of the records that start in [start, end); None for a damaged one, and for what
    follows a record and is no member."""
    part, at = Ranged(source, start), start
    while at < min(end, part.size):
        part.upto(min(end, part.size) + len(MAGIC) - 1 if at == start else at + part.chunk)
        found = part.data.find(MAGIC, at - start, end - start + len(MAGIC) - 1)
        if found < 0:
            covered = part.start + len(part.data)
            if covered >= min(end + len(MAGIC) - 1, part.size):
                return
            at = max(at, covered - len(MAGIC) + 1)
            continue
        at = start + found
        got = part.decoded(at)
        if isinstance(got, bool):
            if got:
                yield at, None
            at += 1
        else:
            yield at, got[0]
            at = got[1]
            part.upto(at + len(MAGIC))
            if at < part.size and bytes(part.data[at - start : at - start + len(MAGIC)]) != MAGIC:
                yield at, None


def manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, bytes) of archives by paths or globs, for read(); nothing of them is read."""
    return spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"))


def write(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write a .warc.gz file for each task's rows below `folder` (a URI that all executors reach) and
    return the manifest: path, bytes and records of the files of tasks that ended well. A lost or retried
    task leaves at most a file that the manifest does not name."""
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    long_enough = F.octet_length("html") >= min_bytes
    # Few rows: payloads that occur more than once. Staged, so that the join's skew can be split.
    kept = staged(rows.filter(long_enough).groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1 and kept is not null").select("digest", "kept"), "warc-kept")
    joined = rows.withColumn("_long", long_enough).join(kept, "digest", "left")
    refers = F.when(F.col("_long") & F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id")), F.col("kept"))
    schema = arrow_schema("path string, bytes long, records long")

    def files(batches):
        filesystem, path = pyarrow.fs.FileSystem.from_uri(folder)
        filesystem.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        n = size = 0
        sink = None
        for batch in batches:
            for row in batch.to_pylist():
                sink = sink or filesystem.open_output_stream(f"{path}/{name}", compression=None)
                data = member(row["page_id"], row["url"], row["html"].encode("utf-8", "surrogatepass"), row["refers_to"], date, level)
                sink.write(data)
                n, size = n + 1, size + len(data)
        if sink:
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((f"{folder}/{name}", size, n), schema)], schema=schema)

    return staged(joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(files, "path string, bytes long, records long"), "warc-manifest")


def read(manifest: DataFrame, split_bytes: int = 4 << 20, with_payload: bool = False) -> DataFrame:
    """RECORD of every record (and `payload`) of the files with `path` and `bytes` in the manifest, read in
    ranges of `split_bytes`."""
    spark: SparkSession = manifest.sparkSession
    ship(spark)
    ddl = RECORD + ", payload binary" * with_payload
    schema = arrow_schema(ddl)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)

    def ranges(batches):
        for splits in batches:
            for s in splits.to_pylist():
                filesystem, path = pyarrow.fs.FileSystem.from_uri(s["path"])
                with filesystem.open_input_file(path) as source:
                    rows = []
                    for at, record in records(source, s["start"], s["end"]):
                        rows.append(parse(record) if record is not None else dict.fromkeys(schema.names) | {"record_type": "damaged", "url": f"{s['path']}@{at}", "payload": None})
                        if not with_payload:
                            rows[-1]["payload"] = None
                        if len(rows) == 256:
                            yield batch(rows)
                            rows = []
                    if rows:
                        yield batch(rows)

    split = manifest.filter("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")).withColumn("end", F.col("start") + split_bytes)
    # Some 64 MB of archives a task, and as many tasks as a shuffle has at least.
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    return split.repartition(max(shuffle_width(spark), -(-total // (64 << 20)))).mapInArrow(ranges, ddl)
