"""WARC archives with a two-level capture index.

Archives: every row becomes one WARC/1.1 record, a gzip member of its own, in
files that each task writes to a shared folder.  Payloads that are equal and
have ``least`` bytes or more are stored once: the record of the largest id is
the ``response``, the others are ``revisit`` records that name it.

Index: captures are range-sorted by (reversed-host URL key, id) and written as
compressed blocks of ``lines`` captures.  Every index file ends with a sparse
directory, the first key of each of its blocks; a second table, one row for
each index file, holds the files' first and last keys.  A look-up searches
that table (one row for each task that sorted captures, the only thing sent
to all tasks), goes to the file, binary-searches its directory and then the
block, and the captures found are read from the archives by range.

Files are named anew by every attempt of a task and only a successful
attempt's rows name them, so a lost executor leaves files nobody reads.
Folders are reached through ``pyarrow.fs`` by their URI, from all executors.

Defined cases: a null html is an empty payload; a null url has the empty key
and its record no target URI; control characters and spaces of a url are
percent-encoded in the record, not in the key; rows of a null id revisit the
group's largest id and are responses where the group has no other id; rows
that repeat the largest id are responses all; an empty table writes nothing
and every look-up finds nothing.  Further columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .base import ascii_lower, slices

LEAST = 1000            # payloads of fewer bytes are always stored
ARCHIVE = 64 << 20      # bytes after which a task opens another archive
LINES = 1024            # captures in an index block
NEAR = 16 << 20         # bytes of an archive that one read group covers
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, id bigint, path string, offset bigint, length bigint"


def url_key(url: Column) -> Column:
    """Host labels from the right, then the rest of the url: ``https://a.example.org/x?y`` is ``org,example,a)/x?y``."""
    scheme = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    after = F.when(scheme.isNull(), F.lit("")).otherwise(F.substr(url, F.length(scheme) + 4))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    labels = F.array_join(F.reverse(F.split(ascii_lower(host), r"\.")), ",")
    key = F.concat(labels, F.lit(")"), F.substr(after, F.length(host) + 1))
    return F.when(url.isNull(), "").when(scheme.isNull(), F.concat(F.lit(")"), url)).otherwise(key)


def record(capture, url: str | None, payload: bytes, digest: str, size: int, refers, date: str) -> bytes:
    """One WARC record; ``refers`` (an id, or False) makes it a revisit without the payload."""
    revisit = refers is not False
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:capture:{'null' if capture is None else capture}>", f"WARC-Date: {date}"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:capture:{refers}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return b"\r\n".join(["\r\n".join(head).encode(), b"", block, b"", b""])


def parsed(data: bytes) -> dict:
    """The fields of one record, with ``payload`` (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if not version.startswith("WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")

    def number(name):
        text = fields.get(name, "<urn:capture:null>")[len("<urn:capture:"):-1]
        return None if text == "null" else int(text)

    return {"id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "uri": fields.get("WARC-Target-URI"), "digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
            "payload": payload if fields["WARC-Type"] == "response" else None}


class _Files:
    """Files a task writes one after another, each under a name of its own."""

    def __init__(self, folder: str, ending: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.ending, self.out, self.name, self.at = ending, None, "", 0

    def write(self, data: bytes) -> int:
        """Offset of the data in the current file."""
        if self.out is None:
            self.fs.create_dir(self.root, recursive=True)
            self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{self.ending}"
            self.out, self.at = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None), 0
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _opened(folder: str):
    """A function that opens a file of a folder, keeping the last one open."""
    fs, root = pafs.FileSystem.from_uri(folder)
    held = [None, None]

    def opened(name: str):
        if held[0] != name:
            if held[1] is not None:
                held[1].close()
            held[:] = [name, fs.open_input_file(f"{root}/{name}")]
        return held[1]

    return opened


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = LEAST, date: str = "2000-01-01T00:00:00Z", archive: int = ARCHIVE) -> DataFrame:
    """Write the archives; returns their captures (key, id, path, offset, length), a written table."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), body.alias("body"),
                        F.octet_length(body).cast("bigint").alias("size"), F.sha1(body.cast("binary")).alias("digest"))
    same = (rows.where(F.col("size") >= least).groupBy("digest", "size")
            .agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "size", "first"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    rows = rows.join(same, ["digest", "size"], "left").select(
        url_key(F.col("url")).alias("key"), "id", "url", "digest", "size", refers.alias("refers"), "body")

    def run(batches):
        files = _Files(folder, ".warc.gz")
        for batch in slices(batches):
            names, places, lengths = [], [], []
            columns = [batch.column(i).to_pylist() for i in range(1, 7)]
            for capture, url, digest, size, refers, body in zip(*columns):
                data = record(capture, url, body.encode(), digest, size, False if refers is None else refers, date)
                packer = zlib.compressobj(6, wbits=31)
                data = packer.compress(data) + packer.flush()
                places.append(files.write(data))
                lengths.append(len(data))
                names.append(files.name)
                if files.at >= archive:
                    files.close()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()),
                                              pa.array(places, pa.int64()), pa.array(lengths, pa.int64())],
                                             names=["key", "id", "path", "offset", "length"])
        files.close()

    return materialize(rows.mapInArrow(run, CAPTURE), "captures")


def _sort_key(key: str, capture) -> tuple:
    return key, capture is not None, capture or 0     # a null id comes first, as in Spark's order


def index(captures: DataFrame, folder: str, lines: int = LINES, files: int | None = None) -> DataFrame:
    """Write the index files; returns (path, first, last, directory, length, n), one row for each, a written table.

    Without ``files`` their number is left to the shuffle's settings.
    """
    def run(batches):
        files = _Files(folder, ".cdx")
        held, directory, first, last, n = [], [], None, None, 0

        def flush():
            data = zlib.compress("\n".join(map(json.dumps, held)).encode())
            directory.append([held[0][0], held[0][1], files.write(data), len(data)])
            held.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                first, last, n = first or line[:2], line[:2], n + 1
                held.append(line)
                if len(held) == lines:
                    flush()
        if held:
            flush()
        if n:
            data = zlib.compress(json.dumps(directory).encode())
            at = files.write(data)
            files.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (files.name, json.dumps(first), json.dumps(last))]
                + [pa.array([x], pa.int64()) for x in (at, len(data), n)],
                names=["path", "first", "last", "directory", "length", "n"])

    ranged = captures.repartitionByRange(*[files] * bool(files), "key", "id").sortWithinPartitions("key", "id", "path", "offset")
    return materialize(ranged.mapInArrow(run, "path string, first string, last string, directory bigint, "
                                              "length bigint, n bigint"), "directory")


def lookup(wanted: DataFrame, parts: DataFrame, folder: str, by_id: bool = True) -> DataFrame:
    """Captures of the wanted keys: (key, id) pairs, or with ``by_id`` False all captures of a key.

    ``parts`` is what ``index`` returned for ``folder``: as many rows as
    tasks sorted the captures, so its bounds may go to every task.
    """
    table = sorted((_sort_key(*json.loads(r.first)), _sort_key(*json.loads(r.last)), r.path, r.directory, r.length)
                   for r in parts.collect())
    width = 3 if by_id else 1
    firsts, lasts = ([x[i][:width] for x in table] for i in (0, 1))
    place = wanted.sparkSession.sparkContext.broadcast((firsts, lasts, [x[2:] for x in table]))
    columns = ["key", "id"] if by_id else ["key", F.lit(None).cast("bigint").alias("id")]

    def to_files(batches):
        firsts, lasts, _ = place.value
        for batch in batches:
            part, row = [], []
            for i, (key, capture) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                at = _sort_key(key, capture)[:width]
                found = range(bisect_left(lasts, at), bisect_right(firsts, at))
                part.extend(found)
                row.extend([i] * len(found))
            picked = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), picked.column(0), picked.column(1)],
                                             names=["part", "key", "id"])

    def search(batches):
        opened, table = _opened(folder), place.value[2]
        part, directory, starts, block, lines, keys = None, [], [], None, [], []

        def load(number):
            nonlocal block, lines, keys
            if block != number:
                _, _, at, size = directory[number]
                lines = [json.loads(x) for x in zlib.decompress(opened(table[part][0]).read_at(size, at)).split(b"\n")]
                keys = [_sort_key(*x[:2])[:width] for x in lines]
                block = number

        for batch in batches:
            out = []
            for p, key, capture in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, block = p, None
                    name, at, size = table[p]
                    directory = json.loads(zlib.decompress(opened(name).read_at(size, at)))
                    starts = [_sort_key(*x[:2])[:width] for x in directory]
                at = _sort_key(key, capture)[:width]
                number = max(bisect_left(starts, at) - 1, 0)
                while number < len(starts) and starts[number] <= at:
                    load(number)
                    out.extend(lines[bisect_left(keys, at):bisect_right(keys, at)])
                    number += 1
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)],
                                             names=["key", "id", "path", "offset", "length"])

    asked = wanted.select(*columns).where(F.col("key").isNotNull()).distinct()
    return (asked.mapInArrow(to_files, "part bigint, key string, id bigint")
            .repartition("part", F.pmod(F.xxhash64("key"), F.lit(16)))
            .sortWithinPartitions("part", "key", "id").mapInArrow(search, CAPTURE))


def read(captures: DataFrame, folder: str) -> DataFrame:
    """(id, uri, record_type, refers_to, digest, payload) of captures, each read by its range of an archive.

    ``digest`` is the record's; a response whose payload has another one is an error.
    """
    def run(batches):
        import hashlib

        opened = _opened(folder)
        for batch in slices(batches):
            records = []
            for name, at, size in zip(*(c.to_pylist() for c in batch.columns)):
                got = parsed(zlib.decompress(opened(name).read_at(size, at), wbits=31))
                if got["payload"] is not None and hashlib.sha1(got["payload"]).hexdigest() != got["digest"]:
                    raise ValueError(f"{name} at {at}: the payload has another digest than the record")
                records.append(got)
            kinds = {"id": pa.int64(), "uri": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
                     "digest": pa.string(), "payload": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in kinds.items()],
                                             names=list(kinds))

    return (captures.select("path", "offset", "length").repartition("path", F.floor(F.col("offset") / NEAR))
            .sortWithinPartitions("path", "offset")
            .mapInArrow(run, "id bigint, uri string, record_type string, refers_to bigint, digest string, payload binary"))


def round_trip(pages: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Archive all rows, index them, look every one up and read it: (id, record_type, refers_to, payload_bytes,
    payload_digest) of each, a revisit's payload being that of the response it refers to."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write(pages, f"{folder}/archive", **names)
    parts = index(captures, f"{folder}/index")
    wanted = pages.select(url_key(F.col(names.get("url_col", "url"))).alias("key"),
                          F.col(names.get("id_col", "page_id")).cast("bigint").alias("id"))
    found = lookup(wanted, parts, f"{folder}/index")
    records = materialize(read(found, f"{folder}/archive").select(
        "id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest")), "records")
    full = ["payload_bytes", "payload_digest"]
    stored = records.where("record_type = 'response'").select(F.col("id").alias("refers_to"), "digest", *full).distinct()
    again = (records.where("record_type = 'revisit'").drop(*full).join(stored, ["refers_to", "digest"], "left"))
    columns = ["id", "record_type", "refers_to", *full]
    return records.where("record_type = 'response'").select(*columns).unionByName(again.select(*columns))
