"""WARC archives: a whole-file gzip stream rewritten as one member per record, with a sidecar offset index.

1. ``write_raw`` writes a response record per page into archives that are each one single gzip stream, as crawlers
   that compress the whole file leave them: no record can be read without inflating all before it.
2. ``verdicts`` finds the records whose payload an earlier page (smallest page id) already has.
3. ``normalise`` inflates such a stream once, in pieces of bounded size, and writes every record as a gzip member of
   its own; records with a verdict become revisits without a payload. Members of several streams in one file and
   files that are normalised already are taken as well. The sidecar lists offset, length, type, id and digest.
4. ``read_archives`` reads members by their offsets, all or those of the wanted pages, and checks every digest.

Payloads are shuffled nowhere: only ids and digests are grouped, so a payload that a third of the pages share costs
a small row each. Each task writes under a name of its own attempt, and a table lists the files that counted.

Cases: a null payload is empty, and empty payloads equal each other. Of repeated rows (same id and payload) one is
the response; which one does not show in the result. A null id comes after all others, so it is a response only
where no page with an id has that payload; revisits of it have a null ``refers_to``. A null url has no target field;
blanks, control and other than ASCII characters of a url are percent-encoded. Long payloads are copied in pieces. A
stream that ends inside a record, or a record whose end mark is missing, is an error. An empty table makes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from wardflow.llm.common import stored
from wardflow.session import new_work_dir

PIECE = 1 << 20
HEAD_LIMIT = 1 << 20
ARCHIVE_BYTES = 32 << 20
GZIP = 31
# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"
END = b"\r\n\r\n"

RAW = "path string, n int, record_id string, page_id long, payload string"
PAGES = "page_id long, target_uri string, record_type string, payload_digest string, payload_bytes long, refers_to long"


class GzipStream:
    """What a gzip file of one or many members holds, inflated in bounded pieces, once, from its start."""

    def __init__(self, file) -> None:
        self.file, self.inflate, self.input, self.held = file, None, b"", bytearray()

    def _more(self) -> bool:
        """Hold one more piece; false at the end of the file."""
        while True:
            if self.inflate is None or self.inflate.eof:
                self.input = (self.inflate.unused_data if self.inflate else b"") or self.file.read(PIECE)
                if not self.input:
                    return False
                self.inflate = zlib.decompressobj(GZIP)
            elif not self.input:
                self.input = self.file.read(PIECE)
            ended = not self.input
            piece = self.inflate.decompress(self.input, PIECE)
            self.input = self.inflate.unconsumed_tail
            if piece:
                self.held += piece
                return True
            if ended and not self.inflate.eof:
                raise ValueError("the gzip stream ends early")

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = bytes(self.held[:n])
            del self.held[: len(piece)]
            n -= len(piece)
            yield piece

    def head(self, limit: int = HEAD_LIMIT) -> bytes | None:
        """Everything up to and with the next blank line; None at the end of the archive."""
        at = 0
        while (found := self.held.find(END, at)) < 0:
            at = max(0, len(self.held) - len(END) + 1)
            if len(self.held) > limit:
                raise ValueError("no blank line ends the header")
            if not self._more():
                if self.held:
                    raise ValueError("the archive ends inside a header")
                return None
        return b"".join(self.take(found + len(END)))


class Members:
    """Writes gzip members one after the other and knows where each begins."""

    def __init__(self, out) -> None:
        self.out, self.size, self.start, self.deflate = out, 0, 0, None

    def write(self, data: bytes) -> None:
        if self.deflate is None:
            self.deflate = zlib.compressobj(6, zlib.DEFLATED, GZIP)
        self._put(self.deflate.compress(data))

    def close_member(self) -> tuple[int, int]:
        """(offset, length) of the member that ends here."""
        self._put(self.deflate.flush())
        place, self.start, self.deflate = (self.start, self.size - self.start), self.size, None
        return place

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a record header, names in lower case; the version line must lead."""
    first, *lines = head.decode("utf-8").rstrip("\r\n").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a record: {first[:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def record_head(named: dict[str, str]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in named.items())]
    return "\r\n".join(lines).encode() + END


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_of(record_id: str) -> int | None:
    """The page id that a record id carries."""
    number = re.fullmatch(r"<urn:page:(-?\d*):.*>", record_id)[1]
    return int(number) if number else None


def response(record_id: str, url: str | None, payload: bytes) -> Iterator[bytes]:
    """A response record: header, HTTP header and payload, end mark."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    named = {"WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Date": "1970-01-01T00:00:00Z"}
    if url is not None:
        named["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(33, 127))))
    named |= {"Content-Type": HTTP_TYPE, "WARC-Payload-Digest": f"sha1:{digest(payload)}", "Content-Length": str(len(http) + len(payload))}
    yield record_head(named) + http
    yield payload
    yield END


def normalise(source, out, revisits: dict[int, str]) -> Iterator[tuple[int, int, str, str, str]]:
    """Rewrite the archive ``source``, record by record, as members of ``out``; yields its index.

    ``revisits`` maps the places of records that repeat a payload to the id of the record that keeps it. An index row
    is (offset, length, type, record id, payload digest).
    """
    stream, members, n = GzipStream(source), Members(out), 0
    while (head := stream.head()) is not None:
        named = fields(head)
        length = int(named["content-length"])
        if n in revisits:
            http = stream.head()
            if http is None or len(http) > length:
                raise ValueError("the HTTP header does not end within its record")
            for _ in stream.take(length - len(http)):
                pass
            short = {"WARC-Type": "revisit", "WARC-Record-ID": named["warc-record-id"], "WARC-Date": named["warc-date"]}
            if "warc-target-uri" in named:
                short["WARC-Target-URI"] = named["warc-target-uri"]
            short |= {"WARC-Profile": PROFILE, "WARC-Refers-To": revisits[n], "Content-Type": named["content-type"]}
            short |= {"WARC-Payload-Digest": named["warc-payload-digest"], "Content-Length": str(len(http))}
            named["warc-type"] = "revisit"
            members.write(record_head(short) + http)
        else:
            members.write(head)
            for piece in stream.take(length):
                members.write(piece)
        if b"".join(stream.take(len(END))) != END:
            raise ValueError("a record does not end with its mark")
        members.write(END)
        yield *members.close_member(), named["warc-type"], named["warc-record-id"], named.get("warc-payload-digest", "-")
        n += 1


def index_line(row: tuple[int, int, str, str, str]) -> bytes:
    return (" ".join(map(str, row)) + "\n").encode()


def read_member(file, offset: int, length: int) -> tuple[dict[str, str], bytes, bytes]:
    """(fields, HTTP header, payload) of the record whose member lies there; nothing else is inflated."""
    file.seek(offset)
    inflate = zlib.decompressobj(GZIP)
    data = inflate.decompress(file.read(length))
    if not inflate.eof or inflate.unused_data:
        raise ValueError(f"the member at {offset} is not {length} bytes long")
    head, _, rest = data.partition(END)
    named = fields(head + END)
    block = rest[: int(named["content-length"])]
    http, _, payload = block.partition(END)
    return named, http, payload


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, t in zip(zip(*rows), types)], list(names))


def write_raw(pages: DataFrame, root: str) -> DataFrame:
    """Write a response record per page below ``root``, each archive one gzip stream; a row per record comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        out, deflate, rows, size, name = None, None, [], 0, ""

        def close() -> pa.RecordBatch:
            out.write(deflate.flush())
            out.close()
            return _batch(rows, RAW)

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
                if out is None:
                    name, rows, size = uuid.uuid4().hex, [], 0
                    out = store.open_output_stream(f"{folder}/raw-{name}.warc.gz", compression=None)
                    deflate = zlib.compressobj(1, zlib.DEFLATED, GZIP)
                page_id, payload = page_id.as_py(), html.as_py() or b""
                record_id = f"<urn:page:{'' if page_id is None else page_id}:{name}-{len(rows)}>"
                for piece in response(record_id, url.as_py(), payload):
                    out.write(deflate.compress(piece))
                    size += len(piece)
                rows.append((f"{folder}/raw-{name}.warc.gz", len(rows), record_id, page_id, hashlib.sha256(payload).hexdigest()))
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    store, folder = fs.FileSystem.from_uri(root)
    store.create_dir(folder, recursive=True)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary").alias("html"))
    return rows.mapInArrow(run, RAW)


def verdicts(records: DataFrame) -> DataFrame:
    """(path, n, keeper) for the records whose payload the record ``keeper`` keeps."""
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id")
    firsts = records.groupBy("payload").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    firsts = firsts.where("copies > 1").select("payload", F.col("first.record_id").alias("keeper"))
    return records.join(firsts, "payload").where("record_id <> keeper").select("path", "n", "keeper")


def normalise_archives(records: DataFrame, root: str) -> DataFrame:
    """(path, index, n_records) of the rewritten archives; ``records`` is what :func:`write_raw` told of the raw ones.

    An archive has a bounded size, so the verdicts on its records are a bounded list.
    """
    revisits = verdicts(records).groupBy("path").agg(F.collect_list(F.struct("n", "keeper")).alias("revisits"))
    archives = records.groupBy("path").agg(F.count("*").alias("records")).join(revisits, "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                found = {r["n"]: r["keeper"] for r in row["revisits"] or []}
                with (
                    store.open_input_stream(row["path"], compression=None) as source,
                    store.open_output_stream(path, compression=None) as out,
                    store.open_output_stream(f"{path}.idx", compression=None) as index,
                ):
                    n = 0
                    for entry in normalise(source, out, found):
                        index.write(index_line(entry))
                        n += 1
                if n != row["records"]:
                    raise ValueError(f"{row['path']} holds {n} records, not {row['records']}")
                yield _batch([(path, f"{path}.idx", n)], "path string, index string, n_records long")

    archives = stored(archives, "archives")
    # A row is a file here: each is a task's work, however few bytes the rows have.
    dealt = archives.repartitionByRange(max(1, archives.count()), "path")
    return dealt.mapInArrow(run, "path string, index string, n_records long")


def read_archives(archives: DataFrame, root: str, wanted: list[int] | None = None, payloads: bool = False) -> DataFrame:
    """A row per record of normalised archives, or per record of the ``wanted`` pages, whose members alone are inflated.

    A revisit has the digest and the size of the payload it repeats, and the page that keeps it in ``refers_to``. With
    ``payloads`` there is a column ``payload``, null for revisits.
    """
    schema = PAGES + (", payload binary" if payloads else "")
    asked = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(row["index"], compression=None) as index:
                    lines = index.read().decode().splitlines()
                held, size = [], 0
                with store.open_input_file(row["path"]) as file:
                    for offset, length, kind, record_id, expected in map(str.split, lines):
                        page_id = page_of(record_id)
                        if asked is not None and page_id not in asked:
                            continue
                        named, http, payload = read_member(file, int(offset), int(length))
                        n_bytes = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
                        if kind == "response" and (f"sha1:{digest(payload)}" != expected or n_bytes != len(payload)):
                            raise ValueError(f"{record_id} in {row['path']} fails its digest")
                        refers = page_of(named["warc-refers-to"]) if kind == "revisit" else None
                        values = (page_id, named.get("warc-target-uri"), kind, expected.removeprefix("sha1:"), n_bytes, refers)
                        held.append((*values, payload if kind == "response" else None) if payloads else values)
                        size += 200 + (len(payload) if payloads else 0)
                        if size >= 4 << 20:
                            yield _batch(held, schema)
                            held, size = [], 0
                if held:
                    yield _batch(held, schema)

    return archives.repartitionByRange(max(1, archives.count()), "path").mapInArrow(run, schema)


def archives_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as raw archives in the shared folder, normalise them, and read the result back."""
    root = new_work_dir(pages.sparkSession, "warc")
    records = stored(write_raw(pages, f"{root}/raw"), "warc-records")
    archives = stored(normalise_archives(records, f"{root}/records"), "warc-archives")
    return read_archives(archives, root)
