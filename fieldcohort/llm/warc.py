"""WARC archives of crawled pages: an index first, then coalesced reads of byte ranges.

Tasks write archives of gzip members, one per record, and return one index row
per record: file, offset, length, URL and digest. Readers select index rows,
sort them by place, join neighbouring ranges into single reads and parse the
records from those.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import sys
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import BROADCAST_ROWS, inside, numbered_rows, text_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: An archive is closed after this many bytes.
ARCHIVE_BYTES = 64 << 20
#: Ranges no further apart than this are read together, up to the read size.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def digest32(payload: bytes) -> str:
    """SHA-1 in base32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(uid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'record {uid}'.encode()).digest())}>"


def _plain(value: str | None) -> str:
    """A header value without control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def record(uid: int, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record: a response, or a revisit of the record numbered ``original`` without the payload."""
    block = f"{HTTP}Content-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.0", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {record_id(uid)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_plain(url)}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if original is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {record_id(original)}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, payload length as the HTTP header gives it) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.0":
        raise ValueError("no record starts here")
    headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    return headers, payload, length


def _writer(folder: str):
    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        place, top = fs.FileSystem.from_uri(folder)
        out, name, at, made = None, "", 0, 0
        for batch in batches:
            rows, names = {"archive": [], "at": [], "length": [], "url": [], "digest": []}, ["uid", "page_id", "refers_to", "original"]
            uids, urls, htmls, originals = (batch.column(c).to_pylist() for c in ("uid", "url", "html", "original"))
            for uid, url, html, original in zip(uids, urls, htmls, originals):
                if out is not None and at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                if out is None:
                    name, at, made = f"part-{task.partitionId():06d}-{task.taskAttemptId():08d}-{made:04d}.warc.gz", 0, made + 1
                    out = place.open_output_stream(f"{top}/{name}", compression=None)
                payload = (html or "").encode()
                digest = digest32(payload)
                member = gzip.compress(record(uid, url, payload, digest, original), LEVEL, mtime=0)
                out.write(member)
                for key, value in zip(rows, (name, at, len(member), url, digest)):
                    rows[key].append(value)
                at += len(member)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *[pa.array(v, k) for v, k in zip(rows.values(), kinds)]], [*names, *rows])
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Archives of all pages in ``folder``; returns the index, one row per record.

    uid, page_id, archive, at, length, url, digest, record_type, refers_to (the
    page of the response that a revisit names) and original (its uid).

    - Of pages with equal payloads of at least ``least_bytes`` bytes the one
      with the largest page_id is the response, of repeated rows with that id
      the first; a null id is the smallest. All others revisit it.
    - A null html is an empty payload, a null URL an empty one.
    - An archive belongs to one attempt of a task, and the index names only
      those of attempts that ended well, so a lost executor leaves at most files
      that nothing refers to.
    """
    text_batches(pages.sparkSession)
    rows = numbered_rows(pages, "pages")
    payload = F.coalesce(inside(html), F.lit("")).cast("binary")
    known = rows.select("uid", inside(page_id).alias("page_id"), F.sha1(payload).alias("same"), F.octet_length(payload).alias("bytes"))
    known = known.where(F.col("bytes") >= least_bytes)
    several = known.groupBy("same").agg(F.count(F.lit(1)).alias("held"), F.max("page_id").alias("last")).where("held > 1")
    heads = known.join(several, "same").where("page_id <=> last").groupBy("same").agg(F.min("uid").alias("original"), F.max("page_id").alias("refers_to"))
    heads = cut_lineage(heads, "heads")
    if heads.count() <= BROADCAST_ROWS:
        heads = F.broadcast(heads)
    chosen = rows.select("uid", inside(page_id).alias("page_id"), inside(url).alias("url"), inside(html).alias("html"), F.sha1(payload).alias("same"), F.octet_length(payload).alias("bytes"))
    chosen = chosen.join(heads, "same", "left")
    revisit = F.col("original").isNotNull() & (F.col("original") != F.col("uid")) & (F.col("bytes") >= least_bytes)
    chosen = chosen.select("uid", "page_id", "url", "html", F.when(revisit, F.col("original")).alias("original"), F.when(revisit, F.col("refers_to")).alias("refers_to"))

    place, top = fs.FileSystem.from_uri(folder)
    place.create_dir(top, recursive=True)
    fields = [chosen.schema[c] for c in ("uid", "page_id", "refers_to", "original")]
    fields += [T.StructField(c, k) for c, k in (("archive", T.StringType()), ("at", T.LongType()), ("length", T.LongType()), ("url", T.StringType()), ("digest", T.StringType()))]
    index = chosen.mapInArrow(_writer(folder), T.StructType(fields))
    kind = F.when(F.col("original").isNull(), "response").otherwise("revisit").alias("record_type")
    return cut_lineage(index.select("*", kind), "index")


#: Bytes of archives that a task reads back.
TASK_BYTES = 16 << 20


def read_plan(selected: DataFrame) -> DataFrame:
    """(archive, start, end, records): one row per read, its records in order.

    Records of an archive are joined into one read while the gap between them
    is small and the read stays near its size. An archive holds a bounded
    number of bytes, so its index rows fit in a task.
    """
    place = Window.partitionBy("archive").orderBy("at")
    gap = F.col("at") - F.lag(F.col("at") + F.col("length")).over(place)
    runs = selected.withColumn("new", F.coalesce((gap > GAP_BYTES).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(place)).withColumn("block", F.floor(F.col("at") / READ_BYTES))
    records = F.sort_array(F.collect_list(F.struct("at", "length", "uid")))
    return runs.groupBy("archive", "run", "block").agg(F.min("at").alias("start"), F.max(F.col("at") + F.col("length")).alias("end"), records.alias("records")).drop("run", "block")


READ = "uid long, record_type string, record string, refers string, payload_digest string, payload_bytes long, payload binary"


def _reader(folder: str, keep_payload: bool):
    names = [part.split()[0] for part in READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        place, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with place.open_input_file(f"{top}/{row['archive']}") as source:
                    data = source.read_at(row["end"] - row["start"], row["start"])
                out = []
                for r in row["records"]:
                    at = r["at"] - row["start"]
                    headers, payload, length = parse(zlib.decompress(data[at : at + r["length"]], 31))
                    told = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Type"] == "response" and (digest32(payload) != told or len(payload) != length):
                        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
                    out.append((r["uid"], headers["WARC-Type"], headers["WARC-Record-ID"], headers.get("WARC-Refers-To"), told, length, payload if keep_payload else None))
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    return read


def read_records(selected: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """The selected index rows' records as the archives have them.

    The reads are dealt out by their bytes, however small their plan is.
    Digests of responses are checked against their payloads. For a revisit
    digest and length are those of the full payload, and ``payload`` is empty.
    """
    plan = cut_lineage(read_plan(selected), "reads")
    held = plan.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    tasks = plan.repartition(max(1, -(-held // TASK_BYTES)), "archive", "start")
    return tasks.mapInArrow(_reader(folder, keep_payload), READ)
