"""BPE encoding and decoding by content-defined chunk reuse.

A rolling hash cuts every text into short chunks, so that words and passages shared by
documents give the same chunks wherever they stand. Distinct chunks are encoded once
(per worker, bounded cache) and their ids copied to every place. Tokens next to a cut
can be wrong, since the cut may fall inside a word: each join is widened to the nearest
*agreement point* on either side, and the bytes between the two points are encoded anew
(also once per distinct piece). An agreement point is a blank that follows a visible
ASCII character: the vocabulary's splitting pattern always breaks there, whatever
stands before or after, so tokens on both sides are those of the whole text. New pieces
are encoded in one string and its token boundaries are compared with the piece ends;
where they do not agree, the piece is encoded on its own. A chunk without an agreement
point is merged into its neighbour.

Map-only: no shuffle, memory bounded by the longest text and the cache size.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hourglass.llm.common import SubstringHash, map_arrow, slices, text_buffer

VOCABULARY = "byte_bpe_50k"   # files <name>.tiktoken (ranks) and <name>.json in the tokenizer folder
# Fixed values of that vocabulary: its special token and its splitting pattern.
SPECIAL = {"<|endoftext|>": 50256}
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

WINDOW = 8                    # bytes under the rolling hash
CHUNK_BITS = 3                # a cut after every 8th window on average: pieces of one or two words
CACHE_PIECES = 250_000        # distinct pieces kept by a worker, known by two 64-bit hashes
CACHE_PIECE_TOKENS = 32       # longer pieces are not kept between batches
SLICE_BYTES = 1 << 18        # encoded together; longer texts in parts that end at agreement points
KEY = np.dtype([("a", np.uint64), ("b", np.uint64)])
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_pieces long"


def tokenizer_path(name: str, folder: str | None = None) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkCodec:
    """Exact encoder and decoder of one vocabulary with a bounded cache of pieces."""

    def __init__(self, ranks_file: str, special: dict[str, int] = SPECIAL, pattern: str = PATTERN,
                 chunk_bits: int = CHUNK_BITS):
        import tiktoken
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        by_id = {rank: token for token, rank in ranks.items()} | {v: k.encode() for k, v in special.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.chunk_bits = chunk_bits
        self.hashes = SubstringHash(71), SubstringHash(72)
        self.known, self.known_ids = np.zeros(0, KEY), np.zeros(0, np.uint32)  # cache: keys by first hash
        self.known_n = self.known_at = np.zeros(0, np.int64)

    def encode_plain(self, text: bytes) -> np.ndarray:
        return self.encoding.encode_to_numpy(text.decode("utf-8"), allowed_special="all").astype(np.uint32)

    def pieces(self, data: np.ndarray, offsets: np.ndarray, prefix: np.ndarray):
        """(start, end) of pieces that tile every text: chunk cores and widened joins."""
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        point = agreement(data)
        point |= edge
        points = np.flatnonzero(point)
        at = np.arange(WINDOW, n + 1)
        rolled = self.hashes[0].of(prefix, at - WINDOW, at) if n >= WINDOW else np.zeros(0, np.uint64)
        cuts = at[rolled >> np.uint64(64 - self.chunk_bits) == 0] if self.chunk_bits else at
        left = points[np.searchsorted(points, cuts, side="right") - 1]
        right = points[np.searchsorted(points, cuts, side="left")]
        bounds = np.unique(np.concatenate([left, right, offsets]))
        return bounds[:-1], bounds[1:]

    def encode_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(flat ids, counts) of new pieces. Pieces between two agreement points are encoded as one
        string; where its token boundaries do not agree with the piece ends, a piece is encoded alone."""
        counts = np.zeros(len(start), np.int64)
        inner = np.isin(data[start], (0x20, 0x0A)) & (data[end - 1] > 0x20) & (data[end - 1] < 0x7F)
        size = (end - start)[inner]
        joint = self.encode_plain(gather(data, start[inner], size).tobytes())
        token_ends = np.concatenate([[0], np.cumsum(self.lengths[joint])])
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.searchsorted(token_ends, bounds)
        agreed = token_ends[np.minimum(at, len(token_ends) - 1)] == bounds
        fine = agreed[:-1] & agreed[1:]
        index = np.flatnonzero(inner)
        from_joint = np.zeros(len(start), bool)
        from_joint[index[fine]] = True
        counts[index[fine]] = np.diff(at)[fine]
        source = np.zeros(len(start), np.int64)
        source[index[fine]] = at[:-1][fine]
        alone, base = [joint], len(joint)
        for i in np.flatnonzero(~from_joint).tolist():
            ids = self.encode_plain(data[start[i]:end[i]].tobytes())
            source[i], counts[i] = base, len(ids)
            base += len(ids)
            alone.append(ids)
        return gather(np.concatenate(alone), source, counts), counts

    def encode_buffer(self, data: np.ndarray, offsets: np.ndarray):
        """Texts data[offsets[i]:offsets[i + 1]] -> (ids, id offsets, pieces per text, pieces encoded anew)."""
        n_docs = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(n_docs + 1, np.int64), np.zeros(n_docs, np.int64), 0
        prefix = self.hashes[0].prefix(data)
        start, end = self.pieces(data, offsets, prefix)
        keys = np.empty(len(start), KEY)
        keys["a"] = self.hashes[0].of(prefix, start, end)
        keys["b"] = self.hashes[1].of(self.hashes[1].prefix(data), start, end)
        order = np.lexsort((keys["b"], keys["a"]))
        ranked = keys[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(fresh) - 1
        first, distinct = order[fresh], ranked[fresh]
        at = np.minimum(np.searchsorted(self.known["a"], distinct["a"]), max(len(self.known) - 1, 0))
        hit = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~hit)
        flat, counts = self.encode_pieces(data, start[first[new]], end[first[new]])
        n, at_ids = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        n[new], at_ids[new] = counts, np.cumsum(counts) - counts + len(self.known_ids)
        n[hit], at_ids[hit] = self.known_n[at[hit]], self.known_at[at[hit]]
        flat = np.concatenate([self.known_ids, flat])
        out = gather(flat, at_ids[inverse], n[inverse])
        piece_at = np.searchsorted(start, offsets)
        id_offsets = np.concatenate([[0], np.cumsum(n[inverse])])[piece_at]
        self._keep(distinct[new], n[new], at_ids[new], flat)
        return out, id_offsets, np.diff(piece_at), len(new)

    def _keep(self, keys: np.ndarray, n: np.ndarray, at: np.ndarray, flat: np.ndarray) -> None:
        short = n <= CACHE_PIECE_TOKENS
        keys, n, at = keys[short], n[short], at[short]
        if len(self.known) + len(keys) <= CACHE_PIECES:
            keys = np.concatenate([self.known, keys])
            n, at = np.concatenate([self.known_n, n]), np.concatenate([self.known_at, at])
        else:  # start over with the latest pieces
            keys, n, at = keys[:CACHE_PIECES], n[:CACHE_PIECES], at[:CACHE_PIECES]
        order = np.argsort(keys["a"], kind="stable")
        self.known, self.known_n = keys[order], n[order]
        self.known_ids = gather(flat, at[order], self.known_n)
        self.known_at = np.cumsum(self.known_n) - self.known_n

    def decode_buffer(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.starts[ids], self.lengths[ids])

    def encode(self, text: str) -> np.ndarray:
        raw = text.encode()
        return self.encode_buffer(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]

    def decode(self, ids) -> str:
        return self.decode_buffer(np.asarray(ids, np.int64)).tobytes().decode("utf-8", errors="replace")


def agreement(data: np.ndarray) -> np.ndarray:
    """Whether a blank follows a visible ASCII character, for every place between bytes."""
    point = np.zeros(len(data) + 1, bool)
    point[1:len(data)] = ((data[1:] == 0x20) | (data[1:] == 0x0A)) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)
    return point


def parts(data: np.ndarray, size: int):
    """Parts of a text of about ``size`` bytes that end at agreement points (longer where there is none)."""
    lo = 0
    while lo < len(data):
        hi, step = len(data), size
        while lo + 2 * step < len(data):
            points = np.flatnonzero(agreement(data[lo + step:lo + 2 * step]))
            if len(points):
                hi = lo + step + int(points[0])
                break
            step *= 2
        yield data[lo:hi]
        lo = hi


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of flat[s:s + c]."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


@lru_cache(maxsize=2)
def codec(ranks_file: str) -> ChunkCodec:
    """One codec per Python worker: its cache is shared by all the tasks the worker runs."""
    return ChunkCodec(ranks_file)


def _encoded(batch: pa.RecordBatch, tool: ChunkCodec):
    """(documents, ids, id offsets, pieces a document) of slices of a batch."""
    data, offsets = text_buffer(batch.column(1))
    for lo, hi in slices(offsets, SLICE_BYTES):
        if hi - lo == 1 and offsets[hi] - offsets[lo] > 4 * SLICE_BYTES:
            found = [tool.encode_buffer(p, np.array([0, len(p)])) for p in parts(data[offsets[lo]:offsets[hi]], SLICE_BYTES)]
            ids = np.concatenate([f[0] for f in found])
            yield batch.column(0).slice(lo, 1), ids, np.array([0, len(ids)]), np.array([sum(int(f[2][0]) for f in found)])
            continue
        ids, at, n_pieces, _ = tool.encode_buffer(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        yield batch.column(0).slice(lo, hi - lo), ids, at, n_pieces


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     folder: str | None = None, name: str = VOCABULARY) -> DataFrame:
    """Token ids of every whole text: (id column, ids array<int>); a null text is empty."""
    ranks = tokenizer_path(f"{name}.tiktoken", folder)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tool = codec(ranks)
        for batch in batches:
            for key, ids, at, _ in _encoded(batch, tool):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([key, lists], [id_col, "ids"])
    return map_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", folder: str | None = None,
                     name: str = VOCABULARY) -> DataFrame:
    """Texts of token ids: (id column, text)."""
    ranks = tokenizer_path(f"{name}.tiktoken", folder)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        tool = codec(ranks)
        for batch in batches:
            texts = [tool.decode(i or ()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])
    return map_arrow(encoded.select(id_col, "ids"), run, f"`{id_col}` {kind}, text string")


def token_digest(docs: DataFrame, folder: str | None = None, name: str = VOCABULARY) -> DataFrame:
    """Encode and decode every whole text and return digests of both.

    Null and empty texts: 0 tokens and the digests of nothing. A null doc_id stays null;
    repeated rows give repeated rows; other columns of the input are ignored.
    """
    ranks = tokenizer_path(f"{name}.tiktoken", folder)

    def run(batches):
        tool = codec(ranks)
        for batch in batches:
            for key, ids, at, n_pieces in _encoded(batch, tool):
                raw, text = ids.astype("<u4").tobytes(), tool.decode_buffer(ids).tobytes()
                ends = np.concatenate([[0], np.cumsum(tool.lengths[ids])])[at]
                of_ids, of_text = [], []
                for a, b, c, d in zip(at[:-1].tolist(), at[1:].tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                    of_ids.append(hashlib.sha256(raw[4 * a:4 * b]).hexdigest())
                    decoded = text[c:d].decode("utf-8", errors="replace")
                    of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [key.cast(pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string()), pa.array(n_pieces, pa.int64())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_pieces"])
    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)
