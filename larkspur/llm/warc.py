"""WARC archives: written by tasks, read back as a table of chunks.

``write`` turns pages into WARC/1.1 records, one archive per task. Of records with equal payloads of at
least ``MIN_REVISIT`` bytes the one with the smallest page_id is a response, the others are revisits that
refer to it; smaller payloads are always responses. ``chunks`` reads archives as rows (record, chunk
number): no task ever holds more of a payload than one chunk, and each row carries the digest of the payload
up to its end, so that the last chunk of a record has the digest of the whole.

Archives go to the folder that all executors share (a path without a scheme lies in the cluster's default file system; ``s3a`` is
written as ``s3``; a file system that Arrow does not know is an error before any task runs), each under a name of its own attempt. Only those which a
task that ended well has reported are read, so a lost or repeated attempt leaves no double records.

Null html is an empty payload. Rows repeated in the input (equal page_id) are written repeatedly, each as
the response or revisit that its page_id makes it. A null page_id is written as an empty record id and read back as null. Other columns
are not read. An empty table gives no archives and no rows.
"""

import hashlib
import uuid
import zlib
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import functions as F

from larkspur.session import new_path

MIN_REVISIT = 100
CHUNK = 1 << 20
CHUNKS = ("record_id string, page_id long, record_type string, refers_to long, url string, content_length long, "
          "chunk long, offset long, bytes binary, digest_so_far string, is_last boolean, stated_digest string")
ID = "urn:page:"
S3 = ("s3", "s3a", "s3n")


def typed(pages):
    """page_id, url, payload, digest, record_type and refers_to of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    url = F.col("url") if "url" in pages.columns else F.lit("")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(url, F.lit("")).alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT
    # Only payloads that occur twice have to be looked up; the hot ones are summed up before the shuffle.
    first = rows.where(large).groupBy(F.col("digest").alias("d")).agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = rows.join(first, large & (F.col("digest") == F.col("d")), "left").drop("d")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return out.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response")
                      .alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def header(page_id, url, size, digest, kind, refers_to):
    """The header and the HTTP lines of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
             "WARC-Date: 2024-01-01T00:00:00Z", "WARC-Target-URI: " + " ".join(url.split()),
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{ID}{refers_to}>"]
    lines.append(f"Content-Length: {len(http) + (size if kind == 'response' else 0)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def qualified(spark, folder):
    """The folder with the scheme and authority that Spark itself would use: one without a scheme lies in the cluster's
    default file system, not on each executor's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.toUri().getScheme()
    if scheme in S3:
        return folder  # Known without Hadoop's own connector.
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString()


def arrow_uri(folder):
    """A qualified folder as Arrow names it; an error for a file system that Arrow cannot write."""
    scheme, _, rest = folder.partition(":")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    if scheme in S3:
        return "s3:" + rest
    if scheme not in ("hdfs", "viewfs", "gs", "abfs", "abfss"):
        raise ValueError(f"archives can't be written to {folder}")
    return folder


def filesystem(folder):
    from pyarrow import fs

    uri = arrow_uri(folder)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(uri.removeprefix("file://"))
    return fs.FileSystem.from_uri(uri)


def write(pages, folder, chunk=CHUNK):
    """Write archives below ``folder``; the table of those that count: archive, records."""
    folder = qualified(pages.sparkSession, folder)
    arrow_uri(folder)  # An unknown file system is an error here, not in the tasks.

    def archive(batches):
        out, name, n = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, payload, digest, kind, refers_to = (batch.column(c)[row] for c in range(6))
                if out is None:
                    store, path = filesystem(folder)
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                kind, body = kind.as_py(), memoryview(payload.as_buffer())
                z = zlib.compressobj(1, zlib.DEFLATED, 31)  # a gzip member for each record
                out.write(z.compress(header(page_id.as_py(), url.as_py(), len(body), digest.as_py(), kind,
                                            refers_to.as_py())))
                if kind == "response":
                    for a in range(0, len(body), chunk):
                        out.write(z.compress(body[a:a + chunk]))
                out.write(z.compress(b"\r\n\r\n") + z.flush())
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "records"])

    columns = ("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return pages.select(*columns).mapInArrow(archive, "archive string, records long")


class Unzipped:
    """The text of an archive of gzip members, read forward."""

    def __init__(self, stream, block=1 << 18):
        self.stream, self.block, self.z, self.held = stream, block, zlib.decompressobj(31), b""
        self.packed, self.ended = b"", False

    def more(self):
        """Take in some more bytes; False at the end."""
        while not self.ended:
            if self.z.eof:
                self.packed, self.z = self.z.unused_data, zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.stream.read(self.block)
                if not self.packed:
                    self.ended = True
                    rest = b"" if self.z.eof else self.z.flush()
                    self.held += rest
                    return bool(rest)
            got = self.z.decompress(self.packed, self.block)
            self.packed = b"" if self.z.eof else self.z.unconsumed_tail
            if got:
                self.held += got
                return True
        return False

    def take(self, n):
        while len(self.held) < n and self.more():
            pass
        out, self.held = self.held[:n], self.held[n:]
        return out

    def until(self, mark):
        """The bytes before ``mark``, which is dropped; None at the end."""
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                return None
        out, self.held = self.held[:at], self.held[at + len(mark):]
        return out


def fields(block):
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.split("\r\n")[1:])}


def number(ref):
    """The page_id in a record id, or None."""
    digits = ref.strip("<>").removeprefix(ID) if ref else ""
    return int(digits) if digits else None


def records(text, chunk=CHUNK):
    """The chunk rows of an archive, in order."""
    while (head := text.until(b"\r\n\r\n")) is not None:
        head = fields(head.decode("utf-8", "replace").lstrip("\r\n"))
        http = text.until(b"\r\n\r\n") or b""
        size = int(head["content-length"]) - len(http) - 4
        sums, offset, k = hashlib.sha256(), 0, 0
        about = (head["warc-record-id"].strip("<>"), number(head["warc-record-id"]), head["warc-type"],
                 number(head.get("warc-refers-to")), head["warc-target-uri"],
                 int(fields(http.decode()).get("content-length", size)))
        stated = head["warc-payload-digest"].removeprefix("sha256:")
        while True:
            part = text.take(min(chunk, size - offset))
            if offset < size and not part:
                raise ValueError(f"the archive ends inside {about[0]}")
            sums.update(part)
            last = offset + len(part) == size
            yield (*about, k, offset, part, sums.hexdigest(), last, stated)
            offset, k = offset + len(part), k + 1
            if last:
                break
        if text.take(4) != b"\r\n\r\n":
            raise ValueError(f"no end of record after {about[0]}")


def chunks(archives, folder, chunk=CHUNK, payloads=True):
    """The chunk table of the archives named in ``archives``; ``payloads=False`` leaves the bytes out. An archive that does not hold
    as many records as ``archives`` states is an error, also where it ends between two records."""
    folder = qualified(archives.sparkSession, folder)
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("content_length", pa.int64()),
                        ("chunk", pa.int64()), ("offset", pa.int64()), ("bytes", pa.binary()),
                        ("digest_so_far", pa.string()), ("is_last", pa.bool_()), ("stated_digest", pa.string())])

    def read(batches):
        for batch in batches:
            for name, written in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = 0
                store, path = filesystem(folder)
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    rows, held = [], 0
                    for row in records(Unzipped(stream), chunk):
                        held += len(row[8])
                        found += row[10]
                        rows.append(row if payloads else (*row[:8], None, *row[9:]))
                        if held >= 4 * chunk or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                if found != written:
                    raise ValueError(f"{name} holds {found} records, {written} were written")

    return archives.select("archive", "records").mapInArrow(read, CHUNKS)


def round_trip(pages):
    """Write the pages as archives and read these back: a row per record, digests worked out from the bytes
    read. A revisit has the digest of the response it refers to, which must be the one that it states."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    manifest = new_path(spark, "warc-manifest")
    write(typed(pages), folder).write.parquet(manifest)
    archives = spark.read.parquet(manifest)
    files = max(1, archives.count())
    read = chunks(archives.repartition(min(files, 10_000)), folder, payloads=False)
    last = read.where("is_last").select("page_id", "record_type", "refers_to", "content_length",
                                        "digest_so_far", "stated_digest")
    wrong = (F.col("record_type") == "response") & (F.col("digest_so_far") != F.col("stated_digest"))
    return last.select(
        "page_id", F.col("content_length").alias("payload_bytes"),
        F.when(wrong, F.raise_error(F.lit("a payload differs from its digest"))).otherwise(F.col("stated_digest"))
        .alias("payload_digest"), "record_type", "refers_to")


def op5_warc(spark, sf_dir):
    """Every page as a WARC record, read back from the archives."""
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
