"""Archives: the normaliser on bytes, the round trip against its SQL, reads of single records, damaged files."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import duckdb
import pytest
from pyarrow import fs

from wardflow.llm import queries, warc
from wardflow.llm.common import stored

PAGES = "page_id long, url string, html string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}?q=a b&ü" if i != 4 else None, html) for i, html in rows], PAGES)


def expected(rows):
    first = {}
    for i, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", i)
    left = dict(first)
    out = []
    for i, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        leads = (html or "") in left
        left.pop(html or "", None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if leads else "revisit", None if leads else first[html or ""]))
    return sorted(out, key=str)


def digest_rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ROWS = [(5, "<p>one</p>"), (3, "<p>one</p>"), (9, "<p>one</p>"), (1, None), (2, ""), (4, "Grüße\r\n\r\nWARC/1.1\r\n\r\n" * 50),
        (7, "x" * 3_000_000), (8, "x" * 3_000_000), (8, "x" * 3_000_000), (None, "<p>one</p>"), (None, "alone"), (None, "alone"), (-6, "é")]


def test_round_trip(spark):
    pages = pages_of(spark, ROWS)
    back = warc.archives_round_trip(pages.repartition(3))
    assert digest_rows(back) == expected(ROWS)
    assert {r["target_uri"] for r in back.where("page_id = 5").collect()} == {"http://h/5?q=a%20b&%C3%BC"}
    assert back.where("page_id = 4").first()["target_uri"] is None


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    done = con.execute(queries.ORACLE["op12_warc"]).fetchall()
    got = queries.op12_warc(spark, sf)
    assert sorted(done, key=str) == digest_rows(got)
    assert {r["record_type"] for r in got.collect()} <= {"response", "revisit"}


def test_extra_columns_and_empty_table(spark):
    from pyspark.sql import functions as F

    extra = ["path", "n", "record_id", "payload", "keeper", "revisits", "records", "index", "first", "copies"]
    pages = pages_of(spark, ROWS).select("*", *(F.lit("own").alias(c) for c in extra))
    assert digest_rows(warc.archives_round_trip(pages)) == expected(ROWS)
    assert warc.archives_round_trip(pages_of(spark, [])).count() == 0


def written(spark, tmp_path, rows, monkeypatch=None):
    root = f"file://{tmp_path}/warc"
    records = stored(warc.write_raw(pages_of(spark, rows).coalesce(1), f"{root}/raw"), "records")
    return root, stored(warc.normalise_archives(records, f"{root}/records"), "archives")


def test_archives_roll_over_and_single_pages_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("abcdef <>", k=rng.randrange(900)))) for i in range(60)] + [(100, "")]
    root, archives = written(spark, tmp_path, rows)
    assert archives.count() > 5 and archives.agg({"n_records": "sum"}).first()[0] == len(rows)
    assert digest_rows(warc.read_archives(archives, root)) == expected(rows)
    some = {r["page_id"]: r["payload"].decode() for r in warc.read_archives(archives, root, wanted=[7, 41, 999], payloads=True).collect()}
    assert some == {7: dict(rows)[7], 41: dict(rows)[41]}
    # Every record is a member that any gzip reader takes by itself, and together they are one archive.
    row = archives.first()
    data = open(row["path"], "rb").read()
    lines = [line.split() for line in open(row["index"]).read().splitlines()]
    assert sum(int(length) for _, length, *_ in lines) == len(data)
    for offset, length, kind, record_id, _ in lines:
        member = gzip.decompress(data[int(offset) : int(offset) + int(length)])
        assert member.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and record_id.encode() in member and member.endswith(b"\r\n\r\n")
    # Normalising what is normalised already changes nothing.
    out = io.BytesIO()
    again = list(warc.normalise(io.BytesIO(data), out, {}))
    assert out.getvalue() == data and [list(map(str, r)) for r in again] == lines


def raw_archive(*payloads):
    return b"".join(b"".join(warc.response(f"<urn:page:{i}:t-{i}>", "http://x", p)) for i, p in enumerate(payloads))


def test_one_stream_many_members_and_pieces(monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 7)
    plain = raw_archive(b"one", b"", b"three" * 40)
    cut = plain.index(b"three") + 11
    sources = [gzip.compress(plain), gzip.compress(plain[:cut]) + gzip.compress(plain[cut:]), gzip.compress(b"") + gzip.compress(plain)]
    results = []
    for source in sources:
        out = io.BytesIO()
        index = list(warc.normalise(io.BytesIO(source), out, {2: "<urn:page:0:t-0>"}))
        results.append((out.getvalue(), index))
        assert [r[2] for r in index] == ["response", "response", "revisit"]
    assert results[0] == results[1] == results[2]
    data, index = results[0]
    named, http, payload = warc.read_member(io.BytesIO(data), *index[2][:2])
    assert named["warc-refers-to"] == "<urn:page:0:t-0>" and payload == b"" and b"Content-Length: 200" in http
    assert warc.read_member(io.BytesIO(data), *index[0][:2])[2] == b"one"
    assert list(warc.normalise(io.BytesIO(b""), io.BytesIO(), {})) == []


@pytest.mark.parametrize("damage", ["gzip cut", "record cut", "header cut", "no mark", "other text"])
def test_damaged_archives_are_errors(damage):
    plain = raw_archive(b"one", b"two" * 500)
    source = {
        "gzip cut": gzip.compress(plain)[:-9], "record cut": gzip.compress(plain[:-400]), "header cut": gzip.compress(plain + plain[:30]),
        "no mark": gzip.compress(plain[:-4] + b"abcd"), "other text": gzip.compress(b"hello: world\r\n\r\n"),
    }[damage]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.normalise(io.BytesIO(source), io.BytesIO(), {}))


def test_a_changed_payload_fails_its_digest(spark, tmp_path):
    root, archives = written(spark, tmp_path, [(1, "aaaa"), (2, "bbbb")])
    row = archives.first()
    store, _ = fs.FileSystem.from_uri(root)
    out = io.BytesIO()
    lines = [line.split() for line in open(row["index"]).read().splitlines()]
    members = [gzip.decompress(open(row["path"], "rb").read()[int(o) : int(o) + int(n)]) for o, n, *_ in lines]
    writer, entries = warc.Members(out), []
    for member, (_, _, *rest) in zip(members, lines):
        writer.write(member.replace(b"bbbb", b"bbbc"))
        entries.append((*writer.close_member(), *rest))
    with store.open_output_stream(row["path"], compression=None) as file:
        file.write(out.getvalue())
    with store.open_output_stream(row["index"], compression=None) as file:
        file.write(b"".join(map(warc.index_line, entries)))
    with pytest.raises(Exception, match="fails its digest"):
        warc.read_archives(archives, root).collect()


def test_long_records_are_copied_in_pieces():
    class Zeros(io.RawIOBase):
        """A record of 300 MB as a source that never holds it."""

        def __init__(self):
            self.deflate, self.left, self.state = zlib.compressobj(1, zlib.DEFLATED, 31), 300 << 20, 0

        def read(self, n):
            if self.state == 0:
                self.state = 1
                head = warc.record_head({"WARC-Type": "resource", "WARC-Record-ID": "<urn:page:1:t>", "Content-Length": str(self.left)})
                return self.deflate.compress(head) + self.deflate.flush(zlib.Z_SYNC_FLUSH)
            if self.left:
                self.left -= 1 << 20
                return self.deflate.compress(bytes(1 << 20)) + self.deflate.flush(zlib.Z_SYNC_FLUSH)
            if self.state == 1:
                self.state = 2
                return self.deflate.compress(warc.END) + self.deflate.flush()
            return b""

    import tracemalloc

    tracemalloc.start()
    assert [r[2] for r in warc.normalise(Zeros(), io.BytesIO(), {})] == ["resource"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
