import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tidemark.llm import token_files as T
from tidemark.llm._shared import scratch
from tidemark.llm.queries import vocabulary


def expected(rows):
    encoder = T.encoder_of(vocabulary()).tokenizer
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def run(spark, df):
    folder = scratch(spark, "tokens")
    return sorted((tuple(r) for r in T.read_tokens(T.write_tokens(df, folder, vocabulary()), folder).collect()), key=lambda r: r[1])


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    assert run(spark, docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark):
    rows = [(2, None), (1, ""), (1, ""), (None, "it's"), (None, None), (5, "long words " * 60_000), (4, "<|endoftext|> x"), (1, "tie")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, id long")
    assert run(spark, df) == expected(rows)
    assert run(spark, df.limit(0)) == []


PIECES = ["'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'", " ", "  ", "\n", "\t", "\r\n", "a", "re", "x", "S", "É", "ß", "日", "١", "5", "!", "?", "...", "́", "😀", "\x00", "<|endoftext|>", "\x85", "​", "_", "　"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.lists(st.sampled_from(PIECES), max_size=12).map("".join)), min_size=1, max_size=6))
def test_pieces_give_the_library_s_ids(texts):
    encoder = T.encoder_of(vocabulary())
    ids, counts = encoder.encode(texts, 0)
    want = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


def test_full_store_is_emptied(monkeypatch):
    encoder = T.PieceEncoder(vocabulary())
    monkeypatch.setattr(encoder, "STORE", 50)
    random.seed(1)
    for _ in range(5):
        texts = [" ".join(str(random.random()) for _ in range(20)) for _ in range(5)]
        ids, _ = encoder.encode(texts, 0)
        assert ids.tolist() == [x for t in texts for x in [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0]]


def shard(n_docs=500, dtype=np.uint16):
    sink, generator = io.BytesIO(), np.random.default_rng(0)
    counts = generator.integers(0, 1000, n_docs)
    counts[3] = 100_000
    ids = generator.integers(0, 50_000, counts.sum())
    out = T.ShardWriter(sink, dtype)
    at = np.append(0, np.cumsum(counts))
    for a in range(0, n_docs, 50):
        out.add(list(range(a, a + 50)), ids[at[a] : at[a + 50]], counts[a : a + 50])
    out.close(pa.int64())
    return sink.getvalue(), ids, at


def test_random_access_reads_only_needed_frames():
    raw, ids, at = shard()
    source = io.BytesIO(raw)
    reader = T.ShardReader(source, len(raw))
    read = []
    whole = reader._frame
    reader._frame = lambda k: read.append(k) or whole(k)
    for k in (0, 3, 250, 499):
        read.clear()
        assert reader.document(k).tolist() == ids[at[k] : at[k + 1]].tolist()
        assert len(read) <= (at[k + 1] - at[k]) // T.FRAME_TOKENS + 2


def test_frames_are_independent_and_checked():
    raw, _, _ = shard()
    reader = T.ShardReader(io.BytesIO(raw), len(raw))
    for at, (packed, plain, _) in zip(reader.at, reader.table, strict=False):
        assert len(zstandard.ZstdDecompressor().decompress(raw[at : at + packed])) == plain
    damaged = bytearray(raw)
    damaged[reader.at[1] + reader.table[1][0] // 2] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        T.ShardReader(io.BytesIO(bytes(damaged)), len(damaged))._frame(1)
    with pytest.raises(ValueError, match="seek table"):
        T.ShardReader(io.BytesIO(raw[:-1]), len(raw) - 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), st.integers(1, 8))
def test_long_texts_in_stretches(text, limit):
    encoder, before = T.encoder_of(vocabulary()), T.LONG
    T.LONG = limit
    try:
        ids, counts = encoder.encode_long(text, 0)
    finally:
        T.LONG = before
    assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 0] and counts.tolist() == [len(ids)]


SPELLED = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "it'<|endoftext|>s  <|endoftext|>  ", "", "<|endoftext|", "|>", "plain"]


def test_added_tokens_are_those_of_an_untouched_tokenizer(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    want = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in SPELLED]
    assert want[0] == [64, 220, 50256, 275, 0]
    encoder = T.encoder_of(vocabulary())
    ids, counts = encoder.encode(SPELLED, 0)
    assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]
    df = spark.createDataFrame(list(enumerate(SPELLED)), "doc_id long, text string")
    assert [r[4] for r in run(spark, df)] == want


def test_added_tokens_in_long_texts(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    text = "one <|endoftext|> two<|endoftext|>three " * 50
    monkeypatch.setattr(T, "LONG", 30)
    ids, counts = T.encoder_of(vocabulary()).encode_long(text, 0)
    assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0] and counts.tolist() == [len(ids)]


def test_pieces_with_equal_hashes_are_told_apart(monkeypatch):
    mix = T.mix
    monkeypatch.setattr(T, "mix", lambda x: mix(x) & np.uint64(0x7000000000000000))
    encoder = T.PieceEncoder(vocabulary())
    random.seed(2)
    for _ in range(4):
        texts = [" ".join(random.choice(["alpha", "beta", "gamma", "delta", "eins", "zwei", "10", "?!"]) for _ in range(30)) for _ in range(6)]
        ids, counts = encoder.encode(texts, 0)
        want = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]
