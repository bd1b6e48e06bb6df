"""Operator 10: WARC archives, written and read back as captures.

``write_warc`` stores every page as one *transaction*: a request record, a
response (or a revisit of an equal payload) and a metadata record.  Request and
metadata name the response in ``WARC-Concurrent-To``.  ``read_warc`` reads any
list of archives into one row a record; ``assemble_captures`` joins the records
of a transaction through their concurrent-to identifiers and emits one nested
row for each capture.

Scale.  Which page is the response of a payload is decided on narrow rows
(digest, page, url) by combinable aggregates.  Equal rows are counted, never gathered.  Only digests held by two pages or more
return to those rows; they are copied ``SALTS`` times and the pages spread over the
copies, so a payload held by a third of all pages doesn't meet in one task.  Payloads move once, to the task that
writes their response, one of each group of equal rows from each task; a revisit needs its digest and length alone.  Rows
repeated often are numbered in runs of ``RUN``, spread over the tasks.
Tasks stream records to archives of ``roll_bytes`` with a name for each attempt;
only names that successful attempts return are read.  A reader holds one record.

Defined cases.  Null html is an empty payload, and empty payloads revisit each other like
any other.  A null url is the URI ``urn:none``; a null page_id is allowed (its
capture has a null page_id, and it never is the response while another
page has the payload).  Every row is a capture of its own, whether rows share
a page_id, or page_id, url and html.  Equal payloads with equal page_ids: the greatest url responds, one row of it, and
the others revisit that row.  An
empty table writes nothing and reads as no rows.  Extra columns are ignored.
Records whose transaction has no response or revisit form a row with a
null ``record_type``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from saltkv.session import scratch_path

from .common import open_fs, written

SALTS = 16
RUN = 10_000
ROLL_BYTES = 64 << 20
_DATE = "2024-01-01T00:00:00Z"  # pages carry no fetch time
_URI = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FILES = "path string, records long, bytes long"
RECORD = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ------------------------------------------------------------ writing


def _record(kind: str, rid: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", _DATE), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _one_line(s: str) -> str:
    return " ".join(s.split()) or "urn:none"


def transaction(rid: str, page_id: int | None, url: str | None, sha1: bytes, size: int, payload: bytes | None, refers_to: str | None) -> list[bytes]:
    """The three records of one page, as bytes; a revisit needs no payload."""
    uri = _one_line(url or "urn:none")
    host, path = _URI.match(uri).groups(default="") if _URI.match(uri) else ("", "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    digest = ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha1).decode()}")
    target, kind = ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response")
    ask = f"GET {path if path.startswith('/') else '/' + path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    concurrent = ("WARC-Concurrent-To", f"<{rid}>")
    if refers_to is None:
        main = _record("response", rid, [target, digest, kind], http + payload)
    else:
        main = _record("revisit", rid, [target, digest, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>"), kind], http)
    note = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
    return [
        _record("request", rid + ":request", [target, concurrent, ("Content-Type", "application/http; msgtype=request")], ask),
        main,
        _record("metadata", rid + ":metadata", [target, concurrent, ("Content-Type", "application/warc-fields")], note),
    ]


def write_warc(pages: DataFrame, out_dir: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``out_dir``;
    returns the list of files (``path, records, bytes``)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    p = p.withColumn("sha1", F.sha1(F.encode("html", "UTF-8"))).withColumn("size", F.octet_length("html"))
    rid = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"),
                   F.substring(F.sha1(F.concat_ws("|", F.coalesce("url", F.lit("")), "sha1")), 1, 20))
    p = p.withColumn("rid", rid)
    about = ["rid", "page_id", "url", "sha1", "size"]
    kinds = p.groupBy(*about).agg(F.count(F.lit(1)).alias("copies")).withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    who = F.struct("page_id", "url", "rid")
    held = kinds.groupBy("sha1").agg(F.max(who).alias("top"), F.min(who).alias("low"))
    shared = held.where("top != low").select("sha1", F.col("top.rid").alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    kinds = written(kinds.join(shared, ["sha1", "salt"], "left").withColumn("first", F.coalesce("first", "rid")), "warc-kinds")

    responds = F.col("rid") == F.col("first")
    bodies = p.groupBy("rid").agg(F.first("html").alias("html"))  # one of each group of equal rows from each task
    responses = kinds.where(responds).join(bodies, "rid").select(*about, "html", F.lit(None).cast("string").alias("refers_to"))
    # copy 0 of a row that responds is the response
    again = kinds.withColumn("from", F.when(responds, 1).otherwise(0).cast("long")).where("copies > from").withColumn("to", F.col("copies") - 1)
    few = again.where(F.col("copies") <= RUN)
    runs = again.where(F.col("copies") > RUN).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("to") / RUN))))
    runs = runs.withColumn("from", F.greatest("from", F.col("run") * RUN)).withColumn("to", F.least("to", F.col("run") * RUN + RUN - 1))
    runs = runs.where(F.col("from") <= F.col("to")).repartition("rid", "run").drop("run")
    copy = few.unionByName(runs).withColumn("copy", F.explode(F.sequence("from", "to")))
    name = F.when(F.col("copy") == 0, F.col("rid")).otherwise(F.concat("rid", F.lit(":"), F.col("copy").cast("string")))
    revisits = copy.select(name.alias("rid"), *about[1:], F.lit(None).cast("string").alias("html"), F.col("first").alias("refers_to"))
    rows = responses.unionByName(revisits)

    def write(batches):
        import pyarrow as pa

        fs, root = open_fs(out_dir)
        out, done, at = None, [], [0, 0]

        def close():
            out.close()
            done.append((name, at[0], at[1]))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", [0, 0]
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                rid, page_id, url, sha1, size, html, refers_to = row
                body = None if html is None else html.encode("utf-8", "surrogatepass")
                for raw in transaction(rid, page_id, url, bytes.fromhex(sha1), size, body, refers_to):
                    member = gzip.compress(raw, 6, mtime=0)  # one member for each record, as readers expect
                    out.write(member)
                    at = [at[0] + 1, at[1] + len(member)]
                if at[1] >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "records", "bytes"), map(list, zip(*done)))))

    rows.mapInArrow(write, _FILES).write.parquet(f"{out_dir.rstrip('/')}/_files")
    return spark.read.schema(_FILES).parquet(f"{out_dir.rstrip('/')}/_files")


# ------------------------------------------------------------ reading


def _headers(f) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in iter(f.readline, b""):
        line = line.rstrip(b"\r\n")
        if not line:
            break
        k, _, v = line.decode("utf-8", "replace").partition(":")
        out.setdefault(k.strip().lower(), v.strip())
    return out


def parse_records(f):
    """Records of an uncompressed stream, one at a time: ``(headers, block)``."""
    for line in iter(f.readline, b""):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        h = _headers(f)
        n = int(h["content-length"])
        block = f.read(n)
        if len(block) != n:
            raise ValueError("an archive ends inside a record")
        yield h, block


def _bare(uri: str | None) -> str | None:
    return uri.strip("<>") if uri else None


def record_row(h: dict[str, str], block: bytes, with_payload: bool) -> dict:
    """The columns of ``RECORD``.  Payload size and digest are those of the
    full payload: measured on a response, declared by a revisit."""
    kind, fields, payload = h.get("warc-type"), {}, None
    size = digest = None
    if kind in ("response", "revisit", "request") and "application/http" in h.get("content-type", ""):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, *rest = head.decode("utf-8", "replace").split("\r\n")
        fields = {"first-line": first} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}
    elif kind == "metadata":
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").splitlines()) if k}
    elif kind == "response":
        payload = block
    if kind == "response":
        size, digest = len(payload), base32_sha1(payload)
    elif kind == "revisit":
        size = int(fields["content-length"]) if fields.get("content-length", "").isdecimal() else None
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return {
        "record_id": _bare(h.get("warc-record-id")), "record_type": kind, "concurrent_to": _bare(h.get("warc-concurrent-to")),
        "refers_to": _bare(h.get("warc-refers-to")), "target_uri": h.get("warc-target-uri"), "payload_bytes": size,
        "payload_digest": digest, "fields": list(fields.items()), "payload": payload if with_payload and kind == "response" else None,
    }


def read_warc(files: DataFrame, root_dir: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives named in ``files.path`` (below
    ``root_dir``), plain or gzip."""
    n = max(1, files.count())
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def read(batches):
        import pyarrow as pa

        fs, root = open_fs(root_dir)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{path}", compression=None) as raw:
                    for h, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw)):
                        rows.append(record_row(h, block, with_payload))
                        size += len(block) if with_payload else 300
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("path").repartition(n, "path").mapInArrow(read, RECORD)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row for each capture: ``capture_id, record_type, main,
    request, metadata, n_metadata``.

    A request or metadata record joins the record named in its concurrent-to
    field; where that is itself a request, the request's own response.  Of several
    requests or metadata records the greatest record id is nested (``n_metadata``
    counts them all)."""
    main = F.col("record_type").isin("response", "revisit")
    r = records.drop("payload")
    hop = r.where("record_type = 'request' and concurrent_to is not null").select(
        F.col("record_id").alias("concurrent_to"), F.col("concurrent_to").alias("via")
    )
    side = r.where(~main & F.col("concurrent_to").isNotNull()).join(hop, "concurrent_to", "left")
    side = side.withColumn("capture_id", F.coalesce("via", "concurrent_to")).drop("via")
    rows = r.where(main).withColumn("capture_id", F.col("record_id")).unionByName(side)
    flat = F.struct("record_id", "record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest",
                    F.array_sort(F.map_entries("fields")).alias("fields"))
    out = rows.groupBy("capture_id").agg(
        F.max(F.when(main, flat)).alias("main"),
        F.max(F.when(F.col("record_type") == "request", flat)).alias("request"),
        F.max(F.when(F.col("record_type") == "metadata", flat)).alias("metadata"),
        F.count_if(F.col("record_type") == "metadata").alias("n_metadata"),
    )
    return out.withColumn("record_type", F.col("main.record_type"))


def capture_payloads(captures: DataFrame, records: DataFrame) -> DataFrame:
    """Captures with the payload bytes of their response; a revisit gets those
    of the record it refers to."""
    body = records.where("record_type = 'response'").select(F.col("record_id").alias("__body"), "payload")
    return captures.withColumn("__body", F.coalesce("main.refers_to", "capture_id")).join(body, "__body", "left").drop("__body")


def op10_warc_captures(spark: SparkSession, pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write ``pages`` and read the archives back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``, and the request's target."""
    out_dir = out_dir or scratch_path(spark, "warc")
    files = write_warc(pages, out_dir)
    captures = assemble_captures(written(read_warc(files, out_dir, with_payload=False), "warc-records")).where("record_type is not null")
    page = F.element_at(F.map_from_entries("metadata.fields"), "page-id")
    return captures.select(
        F.when(page != "", page).cast("long").alias("page_id"), F.col("main.payload_bytes").alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"), "record_type",
        F.regexp_extract("main.refers_to", r"^urn:page:(-?[0-9]+):", 1).try_cast("long").alias("refers_to"),
        F.col("request.target_uri").alias("target_uri"),
    )
