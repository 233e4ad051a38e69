"""Token files and packing against whole-text encodings and exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import awkward, docs_of, empty, with_clashes
from wardflow.llm import packing, token_files
from wardflow.llm.queries import QUERIES, documents
from wardflow.llm.tokens import ChunkEncoder

SF = "/root/testdata/sf0.01"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {}


def plain(path, texts):
    """The ids of whole texts."""
    if path not in ENCODERS:
        tokenizer = Tokenizer.from_file(path)
        ENCODERS[path] = tokenizer, ChunkEncoder(path)
    found = ENCODERS[path][0].encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [list(e.ids) for e in found]


def chunked(path, texts):
    plain(path, [])
    return [np.frombuffer(b, "<u4").tolist() for b in ENCODERS[path][1].encode(pa.array(texts, pa.string()))]


def test_special_tokens_are_taken_as_loaded():
    for path, end in ((WORDS, 49407), (BYTES, 50256)):
        assert end in chunked(path, ["see <|endoftext|> here"])[0]


PIECES = st.sampled_from(
    [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "B", "é", "é", "́", "'s", "'", "12", "3", ".", ",!", " ",
     " ", "\x1c", "\x00", "<|endoftext|>", "<|startoftext|>", "漢字", "🙂", "Σ", "ß", "​", "the", "-", "ﬁ"]
)


@pytest.mark.parametrize("path", [WORDS, BYTES])
@given(texts=st.lists(st.lists(PIECES, max_size=14).map("".join), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chunks_encode_as_whole_texts(path, texts):
    assert chunked(path, texts) == plain(path, texts)


MARKS = st.sampled_from(
    ["a", "É", "ÿ", "×", "÷", "ŷ", "J", "5", "½", ".", ",", "'", "'s", "-", "_", "=", "<", "|>", "@", "~", "`", "%%%", "\u0338",
     "\u030c", "\x7f", "€", "漢", " ", "\n", "\n ", "\t", " Ġ", "Ċ"]
)


@pytest.mark.parametrize("path", [WORDS, BYTES])
@given(texts=st.lists(st.lists(MARKS, max_size=14).map("".join), max_size=5))
@settings(max_examples=500, deadline=None)
def test_chunks_cut_at_marks_encode_as_whole_texts(path, texts):
    assert chunked(path, texts) == plain(path, texts)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_a_word_is_encoded_once_whatever_mark_follows(path):
    encoder, sent = ChunkEncoder(path), []
    whole = encoder._whole
    encoder._whole = lambda chunks: sent.extend(map(str, chunks)) or whole(chunks)
    list(encoder.encode(pa.array(["x alpha alpha. alpha, alpha; été! été", "x été"])))
    assert sorted(sent) == sorted(["x", " alpha", ".", ",", ";", " été", "!"])
    sent.clear()
    list(encoder.encode(pa.array(["x alpha? été."])))
    assert sent == ["?"]


def test_memo_holds_its_bound(monkeypatch):
    monkeypatch.setattr("wardflow.llm.tokens.MEMO", 50)
    monkeypatch.setattr("wardflow.llm.tokens.SLICE_BYTES", 100)
    encoder = ChunkEncoder(BYTES)
    texts = [" ".join(f"w{i * k % 997}" for i in range(10)) + " " + "long" * 20 for k in range(200)]
    got = []
    for ids in encoder.encode(pa.array(texts)):
        got.append(np.frombuffer(ids, "<u4").tolist())
        assert len(encoder.memo) == len(encoder.memo_ids) <= 50
        assert max(map(len, encoder.memo.to_pylist())) <= 64
    assert got == plain(BYTES, texts)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_of_all_documents(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in documents(spark, SF).select("doc_id", "text").collect())
    want, start = [], 0
    for (doc_id, _), ids in zip(rows, plain(WORDS, [t for _, t in rows])):
        want.append((doc_id, start, len(ids) + 1, crc([*ids, 1])))
        start += len(ids) + 1
    got = QUERIES["op5_token_files"](spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == want


def test_token_files_of_awkward_rows(spark):
    docs = with_clashes(awkward(spark)).repartition(3)
    got = token_files.tokens_round_trip(docs, WORDS).collect()
    assert len(got) == 12
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])[:-1]]).tolist()
    assert sum(r["n_tokens"] == 1 for r in got) == 4  # null, null, empty, white space
    assert token_files.tokens_round_trip(empty(spark), WORDS).count() == 0


def test_reader_takes_only_the_frames_asked_for(spark, tmp_path):
    rng = np.random.default_rng(0)
    held = [rng.integers(0, 49408, n).astype("<u4").tobytes() for n in (0, 5, 9000, 1, 40_000, 3, 7000, 2)]
    path = str(tmp_path / "one.zst")
    store = fs.LocalFileSystem()
    with store.open_output_stream(path, compression=None) as out:
        writer = token_files.ShardWriter(out, frame_bytes=16_000)
        for k, ids in enumerate(held):
            writer.add(k if k else None, ids)
        writer.finish()
    with store.open_input_file(path) as file:
        reader = token_files.ShardReader(file)
        assert reader.document(4) == held[4] and reader.decompressed == 1
        assert [reader.document(k) for k in range(8)] == held
        assert reader.ids == [None, 1, 2, 3, 4, 5, 6, 7]
    raw = bytearray((tmp_path / "one.zst").read_bytes())
    raw[reader.file_at[1] - 3] ^= 1
    (tmp_path / "bad.zst").write_bytes(raw)
    with store.open_input_file(str(tmp_path / "bad.zst")) as file, pytest.raises(Exception):
        token_files.ShardReader(file).document(2)


def test_wanted_documents(spark):
    docs = documents(spark, SF)
    root = token_files.new_work_dir(spark, "tokens")
    manifest = token_files.write_tokens(docs.repartition(4), root, WORDS)
    all_rows = {r["doc_id"]: r for r in token_files.read_tokens(manifest, root).collect()}
    few = token_files.read_tokens(manifest, root, [3, 700, 999_999_999]).collect()
    assert {r["doc_id"] for r in few} == {3, 700}
    assert all(r == all_rows[r["doc_id"]] for r in few)
    assert token_files.read_tokens(manifest, root, []).count() == 0


def fewest(lengths, limit):
    """A lower bound: pieces over half a bin never share one, and pieces of at least k have only the room they leave."""
    best, big = -(-sum(lengths) // limit), [n for n in lengths if 2 * n > limit]
    for k in range(1, limit // 2 + 1):
        room = sum(limit - n for n in big if n <= limit - k)
        small = sum(n for n in lengths if k <= n and 2 * n <= limit)
        best = max(best, len(big) + max(0, -(-(small - room) // limit)))
    return best


def check_places(rows, limit):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins)


def test_packing_of_all_documents(spark):
    rows = documents(spark, SF).select("doc_id", "text").collect()
    want = set()
    for r, ids in zip(rows, plain(BYTES, [r["text"] for r in rows])):
        ids = [*ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.add((r["doc_id"], k, a, b - a, crc(ids[a:b])))
    got = QUERIES["op8_packing"](spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(want)
    assert check_places(got, 1024) <= fewest([r["length"] for r in got], 1024) + 2


def test_packing_of_awkward_rows(spark):
    got = packing.pack_documents(with_clashes(awkward(spark)), BYTES, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in got)
    assert sum(r["piece"] == 0 for r in got) == 12
    check_places(got, 1024)
    assert packing.pack_documents(empty(spark), BYTES).count() == 0


@pytest.mark.parametrize("shard, share", [(300, 1.01), (1500, 1.002)])
def test_packing_goes_through_several_shards(spark, monkeypatch, shard, share):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1025, 6000).tolist()
    rows = spark.createDataFrame([(k, 0, n) for k, n in enumerate(lengths)], "doc_id long, piece int, length long")
    in_one = check_places(packing.pack(rows, 1024).collect(), 1024)
    assert in_one <= 1.003 * fewest(lengths, 1024)
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    got = packing.pack(rows, 1024).collect()
    assert len(got) == 6000
    assert check_places(got, 1024) <= share * in_one
    # Lengths of which no two fit together: nothing is gained by more rounds, and no shard takes all.
    same = spark.createDataFrame([(k, 0, 600) for k in range(2000)], "doc_id long, piece int, length long")
    assert check_places(packing.pack(same, 1024).collect(), 1024) == 2000


@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_local_search_keeps_items_and_never_adds_bins(sizes):
    lengths = np.array(sizes)
    first = packing.best_fit(lengths, 50)
    assert sorted(i for b in first for i in b) == list(range(len(sizes)))
    done = packing.local_search([list(b) for b in first], lengths, 50)
    assert sorted(i for b in done for i in b) == list(range(len(sizes)))
    assert all(lengths[b].sum() <= 50 for b in done)
    assert -(-sum(sizes) // 50) <= len(done) <= len(first)


def test_local_search_exchanges_where_nothing_moves():
    lengths = np.array([30, 15, 20, 25, 10])  # only 30 + 20 and 15 + 25 + 10 fit into two bins
    done = packing.local_search([[0, 1], [2, 3], [4]], lengths, 50)
    assert len(done) == 2
