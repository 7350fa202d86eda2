import hashlib
import random

import numpy as np
import pytest

from hourglass.llm import bpe as B

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(B.tokenizer_path("byte_bpe_50k.json"))


def expected(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    back = reference.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_whole_table_against_the_library(small_docs, reference):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.token_digest(small_docs).collect()}
    for r in small_docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == expected(reference, r.text), r.doc_id


def test_odd_rows(odd, empty, reference):
    got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.token_digest(odd).collect())
    assert got == sorted(expected(reference, r.text) for r in odd.select("text").collect())
    assert B.token_digest(empty).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_any_chunking_gives_the_same_ids(reference, bits):
    codec = B.ChunkCodec(B.tokenizer_path("byte_bpe_50k.tiktoken"), chunk_bits=bits)
    rng = random.Random(bits)
    pool = ["word", " the", "'ll", "'s", "\n", "\n\n", "  ", "\t", " ", "é", "漢字", "🙂", " ", "　", "\x1c", "12",
            "３", "!!", "<|endoftext|>", "<|endof", "text|>", "-", "x" * 40, "\r\n", " ", "A"]
    for _ in range(300):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(60)))
        ids = codec.encode(text)
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)
        assert codec.decode(ids) == reference.decode(ids.tolist(), skip_special_tokens=False) == text


def test_cache_limit_does_not_change_ids(reference, monkeypatch):
    monkeypatch.setattr(B, "CACHE_PIECES", 20)
    monkeypatch.setattr(B, "CACHE_PIECE_TOKENS", 2)
    codec = B.ChunkCodec(B.tokenizer_path("byte_bpe_50k.tiktoken"))
    rng = random.Random(2)
    for _ in range(30):
        text = " ".join(f"w{rng.randrange(40)}" for _ in range(50))
        assert codec.encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_shared_passages_are_encoded_once():
    codec = B.ChunkCodec(B.tokenizer_path("byte_bpe_50k.tiktoken"))
    passage = np.frombuffer(b" some passage that several documents hold, word for word." * 3, np.uint8)
    twice = np.concatenate([passage, passage])
    codec.encode_buffer(twice, np.array([0, len(passage), len(twice)]))
    again = codec.encode_buffer(twice, np.array([0, len(passage), len(twice)]))
    assert again[3] <= 1  # pieces encoded anew


def test_documents_round_trip(odd, small_docs):
    for df in (odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), small_docs):
        back = B.decode_documents(B.encode_documents(df)).withColumnRenamed("text", "back")
        assert df.join(back, "doc_id").filter("coalesce(text, '') <> back").count() == 0


def test_long_texts_in_parts(spark, reference, monkeypatch):
    monkeypatch.setattr(B, "SLICE_BYTES", 200)
    rng = random.Random(6)
    text = "".join(rng.choice(["word", " the", "'s", "\n", "\n\n", "  ", "\t", " é", "漢字", " 12", "!!", "x" * 30, " a"]) for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    assert b"".join(p.tobytes() for p in B.parts(data, 200)) == text.encode() and len(list(B.parts(data, 200))) > 10
    tool = B.ChunkCodec(B.tokenizer_path("byte_bpe_50k.tiktoken"))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([text, None, "short"])], ["doc_id", "text"])
    out = [(k.to_pylist(), ids.tolist()) for k, ids, _, _ in B._encoded(batch, tool)]
    assert out[0] == ([1], reference.encode(text, add_special_tokens=False).ids)
    assert [k for ks, _ in out for k in ks] == [1, 2, 3]
