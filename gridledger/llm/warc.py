"""WARC archives: a writer, and a reader that splits compressed files.

Every page becomes one record in a gzip member of its own. Records whose payload
equals that of an earlier page are revisits and carry headers only.

Reading is split into byte ranges that no one has indexed. A task looks for gzip
magic from the start of its range, takes a candidate for a member only if it
decompresses to a WARC header, and then goes from member to member. It owns the
records that start inside its range and reads the last of them to its end.

Files are opened with pyarrow's file systems by URI, so executors share nothing but
the archive folder. A writing task names its files by a fresh id; only the files in
the written manifest are read, so a repeated or lost task leaves no trace.

Defined cases: a NULL html is an empty payload; payloads under MIN_REVISIT bytes are
always responses; NULL page ids sort last and have no id header, and a revisit of
them cannot occur unless another page has an id; equal rows with the smallest id are
all responses; NULL URLs have no URI header and read back as NULL, any other URL reads
back as it was; an empty table writes no archive; extra columns do not matter.
"""

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import slices
from gridledger.session import scratch_dir
from gridledger.sources.tables import materialize

MIN_REVISIT = 100
#: Bytes after which a task starts another archive, and bytes of a reading range.
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
LEVEL = 6

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _file_system(uri):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- records ----------------------------------------------------------------


def record_bytes(page_id, url, payload, digest, refers_to, date):
    """One record, uncompressed. ``refers_to`` None: a response with the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit")]
    if page_id is None:
        head.append(("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}>"))
    else:
        head.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if url is not None:
        plain = re.sub(r"[^!-~]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)
        head.append(("WARC-Target-URI", plain or "about:blank"))
        if plain != url or not plain:
            head.append(("X-Target-Base64", base64.b64encode(url.encode()).decode()))
    head.append(("WARC-Date", date))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        head.append(("WARC-Profile", REVISIT_PROFILE))
        head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head.append(("Content-Type", "application/http; msgtype=response"))
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"".join((VERSION, lines, b"\r\n", block, b"\r\n\r\n"))


def parse_record(data):
    """Fields of an uncompressed record; a response's payload must match its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (
        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest
    ):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name):
        found = re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))
        return int(found[1]) if found else None

    url = fields.get("WARC-Target-URI")
    if "X-Target-Base64" in fields:
        url = base64.b64decode(fields["X-Target-Base64"]).decode()
    return {
        "page_id": page("WARC-Record-ID"),
        "url": url,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "html": payload.decode() if kind == "response" else None,
    }


# --- writing ----------------------------------------------------------------


def classified(pages, min_revisit=MIN_REVISIT):
    """page_id, url, html, digest and refers_to (the page of which this one is a
    revisit)."""
    pages = common.with_columns(pages, {"page_id": "bigint", "url": "string", "html": "string"})
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    repeated = (
        rows.filter(F.octet_length("html") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    repeated = materialize(repeated, "warc-repeated")
    joined = rows.join(common.by_size(repeated, repeated.count()), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "html", "digest", F.when(again, F.col("first")).alias("refers_to")
    )


def _write_partition(folder, date, most):
    def write(batches):
        files, path = _file_system(folder)
        files.create_dir(path, recursive=True)
        done, out = [], None

        def close():
            out.close()
            done.append((f"{folder}/{name}", size, records))

        for batch in slices(batches):
            for row in batch.to_pylist():
                if out is None:
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                payload = row["html"].encode()
                data = record_bytes(
                    row["page_id"], row["url"], payload, row["digest"], row["refers_to"], date
                )
                coder = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = coder.compress(data) + coder.flush()
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= most:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(done, columns=["path", "bytes", "records"]),
            schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]),
            preserve_index=False,
        )

    return write


def write_archives(pages, folder, date="2000-01-01T00:00:00Z", min_revisit=MIN_REVISIT,
                   archive_bytes=ARCHIVE_BYTES):
    """Write the pages as archives under the shared folder; the written manifest has
    path, bytes and records of each."""
    return materialize(
        classified(pages, min_revisit).mapInArrow(
            _write_partition(folder, date, archive_bytes), "path string, bytes bigint, records bigint"
        ),
        "warc-manifest",
    )


# --- reading ----------------------------------------------------------------


class _Window:
    """Forward reads of a file through one buffer."""

    STEP = 1 << 20

    def __init__(self, file):
        self.file, self.base, self.data, self.size = file, 0, b"", file.size()

    def piece(self, at, length):
        """Up to ``length`` bytes from offset ``at``; short only at the file's end."""
        end = min(self.size, at + length)
        if at < self.base or end > self.base + len(self.data):
            self.base = at
            self.data = self.file.read_at(min(max(self.STEP, length), self.size - at), at)
        return self.data[at - self.base : end - self.base]


def _member(window, at):
    """(record, offset after it) of the gzip member at an offset, or None if none
    with a WARC header starts there."""
    coder, parts, place, step = zlib.decompressobj(31), [], at, 4096
    try:
        while not coder.eof:
            piece = window.piece(place, step)
            if not piece:
                return None
            parts.append(coder.decompress(piece))
            place += len(piece)
            step = min(step * 2, _Window.STEP)
            if len(parts) == 1 and not parts[0].startswith(VERSION[: len(parts[0])] or VERSION):
                return None
    except zlib.error:
        return None
    data = b"".join(parts)
    if not data.startswith(VERSION):
        return None
    return data, place - len(coder.unused_data)


def range_records(file, start, end):
    """Records of the members that start in [start, end) of an archive."""
    window, at, synced = _Window(file), start, start == 0
    while at < min(end, window.size):
        if not synced:
            piece = window.piece(at, _Window.STEP)
            found = piece.find(MAGIC)
            if found < 0:  # the magic may be cut by the end of the piece
                at += max(1, len(piece) - len(MAGIC) + 1)
                continue
            at += found
            if at >= end:
                return
        member = _member(window, at)
        if member is None:
            if synced:
                raise ValueError(f"no record at byte {at}")
            at += 1
            continue
        synced = True
        yield member[0]
        at = member[1]


RECORD = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint"
)


def _read_ranges(with_html):
    names = [x.split()[0] for x in RECORD.split(", ")] + ["html"] * with_html
    kinds = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        + [("html", pa.string())] * with_html
    )

    def read(batches):
        for batch in batches:
            for split in batch.to_pylist():
                files, path = _file_system(split["path"])
                rows, held = [], 0
                with files.open_input_file(path) as file:
                    for data in range_records(file, split["start"], split["stop"]):
                        record = parse_record(data)
                        rows.append({n: record[n] for n in names})
                        held += len(data) if with_html else 100
                        if held >= 8_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return read


def read_archives(archives, split_bytes=SPLIT_BYTES, html=False):
    """Records of the archives (path, bytes): page_id, url, payload_bytes,
    payload_digest, record_type, refers_to, and html (NULL for revisits) if asked."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    splits = archives.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    splits = splits.select(
        "path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("stop")
    )
    count = max(1, splits.count())
    # One split per task: a range is a task's work, however many files there are.
    dealt = splits.repartition(count, "path", "start")
    return dealt.mapInArrow(_read_ranges(html), RECORD + ", html string" * html)


def round_trip(pages, split_bytes=SPLIT_BYTES):
    """Write all pages as archives in the shared folder and read them back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), split_bytes)
