"""WARC archives: written with an index, read back by coalesced byte ranges."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm.common import fresh, materialize, scratch_path

INDEX = "file string, offset long, length long, url string, digest string, id long, type string"
RECORD = "id long, url string, type string, refers_to long, digest string, payload_bytes long, payload binary"
VERSION, END = b"WARC/1.1", b"\r\n\r\n"


def record(ident: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One archive record as a gzip member. A revisit names the record it refers to and has no block of its own."""
    block = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if ident is None else ident}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(payload))), ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if kind == "revisit":
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in fields)])
    return gzip.compress(head + END + block + END, 1, mtime=0)


def parse(raw: bytes) -> tuple[int | None, str | None, str, int | None, str, int, bytes | None]:
    """The fields of one record in the order of ``RECORD``; the digest of a response is taken anew and must agree."""
    whole = gzip.decompress(raw)
    head, _, rest = whole.partition(END)
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not the start of a record")
    fields = dict(line.decode("utf-8", "surrogatepass").split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    payload, kind, digest = rest[:size], fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda urn: int(urn[len("<urn:page:") : -1]) if urn and len(urn) > len("<urn:page:>") else None
    url = fields.get("WARC-Target-URI")
    url = None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return number(fields["WARC-Record-ID"]), url, kind, number(fields.get("WARC-Refers-To")), digest, int(fields["WARC-Payload-Length"]), payload if kind == "response" else None


#: Schemes of the session's file systems and the names the archive reader and writer know them by.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with scheme and authority, by the session's Hadoop settings, so that all tasks mean the same place.

    A path without a scheme belongs to the default file system of the session. A
    folder whose file system the tasks can't reach by themselves is refused.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = store.makeQualified(path).toUri()
    if whole.getScheme() not in SCHEMES:
        raise ValueError(f"archives can't be kept in {whole}: name a folder in one of {', '.join(sorted(SCHEMES))}")
    return whole.toString()


def _store(place: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a qualified folder or file."""
    scheme, _, rest = place.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


def write(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", shortest: int = 100) -> DataFrame:
    """Write a record for each row and return the index: file, offset, length, url, digest, id and type of each record.

    Of the records with equal payloads of at least ``shortest`` bytes, those with
    the smallest key are responses and the others revisit it; rows without a key
    come last, and where no key is known all are responses. Null html is an empty
    payload. Every attempt of a task writes a file of its own; the index names
    only the files of attempts that ended well, so a lost executor leaves no gap.
    ``folder`` (by default a new one below the shared folder) is taken as the session's
    Hadoop settings read it and must be shared by all executors; see ``qualified``.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, "warc"))
    body = F.encode(F.coalesce(html, F.lit("")), "utf-8")
    rows = pages.select(F.col(key).cast("long").cast("string").alias("id"), F.col(url).alias("url"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    shared = pages.select(F.col(key).cast("long").alias("id"), body.alias("payload")).where(F.length("payload") >= shortest)
    shared = shared.select("id", F.sha2("payload", 256).alias("digest")).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = materialize(shared.where("n > 1 and first is not null").select("digest", "first"), "shared-payloads")
    # Numbers that may be missing travel as text: a data frame column would turn them into floats.
    rows = rows.join(shared.withColumn("first", F.col("first").cast("string")), "digest", "left")

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        file, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for frame in batches:
                index = []
                for ident, address, payload, digest, first in zip(frame.id, frame.url, frame.payload, frame.digest, frame["first"]):
                    ident, first = (None if pd.isna(x) else int(x) for x in (ident, first))
                    address = address if isinstance(address, str) else None
                    kind = "response" if first is None or ident == first else "revisit"
                    raw = record(ident, address, kind, first, digest, bytes(payload))
                    out = out or store.open_output_stream(f"{path}/{file}", compression=None)
                    out.write(raw)
                    index.append((f"{folder}/{file}", at, len(raw), address, digest, ident, kind))
                    at += len(raw)
                part = pd.DataFrame(index, columns=["file", "offset", "length", "url", "digest", "id", "type"])
                yield part.astype({"id": "Int64"})
        finally:
            if out:
                out.close()

    index = rows.select("id", "url", "payload", "digest", "first").mapInPandas(archive, INDEX)
    return materialize(index, "warc-index")


def read(index: DataFrame, gap: int = 65_536, chunk: int = 8 << 20, payload: bool = True) -> DataFrame:
    """The records that ``index`` (all of it or selected rows) points at, in the columns of ``RECORD``.

    Records are grouped by file and ``chunk`` bytes of it, sorted by offset, and
    neighbours at most ``gap`` bytes apart are fetched by one read.
    """
    group = fresh("chunk")
    columns = ["file", "offset", "length", group]
    sorted_ = index.withColumn(group, F.floor(F.col("offset") / chunk)).select(*columns)
    sorted_ = sorted_.repartition("file", group).sortWithinPartitions("file", "offset")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            begin, end = frame.offset, frame.offset + frame.length
            reach = end.groupby(frame.file).cummax()
            new = (frame.file != frame.file.shift()) | (begin > reach.shift() + gap) | (frame[group] != frame[group].shift())
            for _, run in frame.groupby(new.cumsum(), sort=False):
                low, high = int(run.offset.iloc[0]), int((run.offset + run.length).max())
                store, path = _store(run.file.iloc[0])
                with store.open_input_file(path) as source:
                    source.seek(low)
                    raw = source.read(high - low)
                found = [parse(raw[o - low : o - low + n]) for o, n in zip(run.offset, run.length)]
                out = pd.DataFrame(found, columns=["id", "url", "type", "refers_to", "digest", "payload_bytes", "payload"])
                if not payload:
                    out["payload"] = None
                yield out.astype({"id": "Int64", "refers_to": "Int64"})

    return sorted_.mapInPandas(fetch, RECORD)
