"""Alignment of two tokenizers over the same texts by pointer jumping.

Tokenizer A is a byte-level BPE read from its JSON file and applied to a space and the text;
B is a sentencepiece model that adds the space itself. Both token sequences tile the same
bytes, and byte offsets where both end a token cut them into groups.

1. One stage tokenizes every whole text once and stores the ids. Neither vocabulary has a token
   that reaches over a space after a visible character, so texts are cut there
   and every distinct unit is encoded once per worker (bounded cache). This is checked when the
   vocabularies are read; their tokens are compared with the bytes of every unit.
2. Groups: every token points to the farthest-right token of the other side that overlaps it
   (the one that holds its last byte), or to itself if both end there. The pointers of all tokens
   of a slice of texts are doubled together (next = next[next]) until nothing changes; a
   token's terminal is the last token of its group. Long texts are taken in slices that end
   where both sides end a token, so memory does not grow with a text.
3. Links are pairs of an A and a B token that share a byte. The number of documents that hold
   an id pair linked is summed over the corpus, pre-aggregated per slice of texts. The
   pairs of the highest counts, down to a power of two that at most ``HEAD_PAIRS`` pairs
   reach, are broadcast and looked up where the document is; the others, which by then are the
   rare ones, are joined by pair. An A id's highest count is a table no longer than its vocabulary.

A text that is null or empty, or whose bytes differ from the joined token bytes of either
side (a text with U+2581, which B reads as a space), has no tokens. A null doc_id stays
null, repeated rows give repeated rows and count as documents, an empty table gives no row, other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import map_arrow, slices, text_buffer
from hourglass.session import materialize

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CACHE_UNITS = 300_000      # distinct units kept by a worker
CACHE_UNIT_CHARS = 64      # longer units are not kept
LONG_UNIT_CHARS = 1000     # longer units are encoded by the library with a heap of merges
SLICE_TOKENS = 1 << 18     # tokens of one side aligned together
HEAD_PAIRS = 1 << 21       # broadcast counts: 24 MB at most
SIDE = 1 << 20             # a pair as a long: A id * SIDE + B id
# Fixed value: the splitting pattern of the byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CROSSING = re.compile(r"\s ")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: printable bytes stand for themselves, the others for
    the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteBPE:
    """Tokenizer A: ids of texts as the library gives them without special tokens, and the bytes of every id."""

    def __init__(self, path: str):
        import tiktoken
        self.path = path
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        alphabet = byte_alphabet()
        added = {t["id"]: t["content"].encode() for t in model["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in model["model"]["vocab"].items() if i not in added}
        by_id = {i: t for t, i in ranks.items()} | added
        self.tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        order = [ranks[bytes(alphabet[c] for c in "".join(m))] for m in merges]
        if order != sorted(order):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        if any(re.search(rb"[!-~] ", t) for t in self.tokens):
            raise ValueError(f"{path}: a token reaches over a space")
        self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, special_tokens={}, mergeable_ranks=ranks)

    @cached_property
    def library(self):
        import tokenizers
        found = tokenizers.Tokenizer.from_file(self.path)
        found.encode_special_tokens = True
        return found

    def joint(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def alone(self, unit: str) -> list[int]:
        if len(unit) > LONG_UNIT_CHARS:
            return self.library.encode(unit, add_special_tokens=False).ids
        return self.fast.encode_ordinary(unit)


class PieceBPE:
    """Tokenizer B: ids of texts that begin with a space, which the model adds itself, and the bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError(f"{path}: a token reaches over a space")
        byte = re.compile(r"<0x([0-9A-F]{2})>$")
        self.tokens = [bytes([int(m[1], 16)]) if (m := byte.match(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.space = self.model.piece_to_id("▁")

    def joint(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:], num_threads=1), np.int64)

    def alone(self, unit: str) -> list[int]:
        return self.model.encode(unit[1:], num_threads=1) if unit != " " else [self.space]


class Side:
    """One tokenizer with the tokens of the units seen so far, as flat arrays."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.size = np.fromiter(map(len, tokenizer.tokens), np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokenizer.tokens), np.uint8)
        self.kind = "<u2" if len(self.size) <= 1 << 16 else "<u4"
        self.forget()

    def forget(self) -> None:
        self.flat, self.at, self.n = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, units: list[str], raw: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> np.ndarray:
        """Add the tokens of new units (bytes ``raw`` up to ``ends``); whether they spell each unit.

        ``plain`` units are encoded as one string; where its token ends do not agree with the ends
        of a unit, the unit is encoded on its own.
        """
        size = np.diff(ends, prepend=0)
        flat, counts, at = [], np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        fine = np.zeros(len(units), bool)
        index = np.flatnonzero(plain)
        if len(index):
            ids = self.tokenizer.joint("".join([units[i] for i in index.tolist()]))
            token_ends = np.concatenate([[0], np.cumsum(self.size[ids])])
            bounds = np.concatenate([[0], np.cumsum(size[index])])
            place = np.minimum(np.searchsorted(token_ends, bounds), len(token_ends) - 1)
            agreed = token_ends[place] == bounds
            good = agreed[:-1] & agreed[1:]
            fine[index[good]] = True
            at[index[good]], counts[index[good]] = place[:-1][good], np.diff(place)[good]
            flat.append(ids)
        base = sum(map(len, flat))
        for i in np.flatnonzero(~fine).tolist():
            ids = self.tokenizer.alone(units[i])
            at[i], counts[i] = base, len(ids)
            base += len(ids)
            flat.append(np.array(ids, np.int64))
        ids = gather(np.concatenate(flat), at, counts)
        spelt = np.add.reduceat(np.append(self.size[ids], 0), np.cumsum(counts) - counts) * (counts > 0)
        same = spelt == size
        if not same.all():  # compare the bytes of the others only
            token_of = np.repeat(np.arange(len(units)), counts)
            kept = ids[same[token_of]]
            raw = raw[same[np.repeat(np.arange(len(units)), size)]]
        else:
            kept = ids
        wrong = np.flatnonzero(gather(self.bytes, self.start[kept], self.size[kept]) != raw)
        if len(wrong):
            rows = np.flatnonzero(same)
            same[rows[np.searchsorted(np.cumsum(size[rows]), wrong, side="right")]] = False
        self.at = np.concatenate([self.at, np.cumsum(counts) - counts + len(self.flat)])
        self.n = np.concatenate([self.n, counts])
        self.flat = np.concatenate([self.flat, ids.astype(self.kind)])
        return same

    def ids_of(self, index: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.at[index], self.n[index])


class Tokenizers:
    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = Side(ByteBPE(a_path)), Side(PieceBPE(b_path))
        self.decimal = decimals(max(len(self.a.size), len(self.b.size)))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.same = np.zeros(0, bool)
        self.a.forget()
        self.b.forget()

    def units(self, text: str) -> list[str]:
        """Pieces of a space and the text, each from a space on; none is cut after white space."""
        words = text.split(" ")
        if not (text.startswith(" ") or "  " in text or _CROSSING.search(text)):
            return words
        out: list[list[str]] = []
        open_ = False  # a word after white space belongs to the one before
        for word in words:
            if open_:
                out[-1].append(word)
            else:
                out.append([word])
            open_ = word == "" or word[-1].isspace()
        return [" ".join(u) for u in out]

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(A ids, B ids) as little-endian integers; nothing where they do not spell a space and the text."""
        if len(self.index) > CACHE_UNITS:
            self.forget()
        units = [self.units(t) if t else [] for t in texts]
        new = list({u for words in units for u in words if u not in self.index})
        once = []  # units that are long are not kept
        if new:
            spaced = [" " + u for u in new]
            encoded = [u.encode() for u in spaced]
            plain = np.array([not u[-1].isspace() and len(u) <= CACHE_UNIT_CHARS and "\u2581" not in u for u in spaced])
            args = spaced, np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([len(u) for u in encoded]), plain
            base = len(self.same)
            self.same = np.concatenate([self.same, self.a.learn(*args) & self.b.learn(*args)])
            self.index.update((u, base + i) for i, u in enumerate(new))
            once = [u for u in new if len(u) > CACHE_UNIT_CHARS]
        index = np.array([self.index[u] for words in units for u in words], np.int64)
        ends = np.cumsum([len(words) for words in units])
        ids_a, ids_b = self.a.ids_of(index), self.b.ids_of(index)
        at = [np.concatenate([[0], np.cumsum(side.n[index])])[np.concatenate([[0], ends])].tolist() for side in (self.a, self.b)]
        fine = np.concatenate([[0], np.cumsum(~self.same[index])])[np.concatenate([[0], ends])]
        fine = np.diff(fine) == 0
        for u in once:
            del self.index[u]
        if once and len(self.a.flat) > 16 * CACHE_UNITS:
            self.forget()
        return [(ids_a[a0:a1].tobytes(), ids_b[b0:b1].tobytes()) if ok else (b"", b"")
                for a0, a1, b0, b1, ok in zip(at[0], at[0][1:], at[1], at[1][1:], fine)]


@lru_cache(maxsize=2)
def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    """One pair per Python worker: its cache is shared by the tasks the worker runs."""
    return Tokenizers(a_path, b_path)


def decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of the decimal digits of 0 .. n - 1, each with one byte of room."""
    text = [str(i).encode() + b"," for i in range(n)]
    size = np.fromiter(map(len, text), np.int64)
    return np.frombuffer(b"".join(text), np.uint8), np.cumsum(size) - size, size


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]


# --- alignment of arrays of token ends ---------------------------------------------------

def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """The last token of the group of every token (A tokens first, then B tokens), by pointer jumping.

    ``end_a`` and ``end_b`` are the rising end offsets of tokens that tile the same bytes.
    """
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)          # the B token that holds an A token's last byte
    over_b = np.searchsorted(end_a, end_b)
    after_b = np.where(end_a[over_b] > end_b, over_b, n + np.arange(len(end_b)))
    nxt = np.concatenate([n + over_a, after_b])     # a B token that ends with its A token is terminal
    while True:
        jumped = nxt[nxt]
        if np.array_equal(jumped, nxt):
            return nxt
        nxt = jumped


def links(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every pair that shares a byte: one per stretch between two neighbouring ends."""
    ends = np.union1d(end_a, end_b)
    return np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)


def slices_of(end_a: np.ndarray, end_b: np.ndarray, size: int):
    """((a0, a1), (b0, b1)) of token ranges of about ``size`` A tokens that end where both sides end."""
    a0 = b0 = 0
    while a0 < len(end_a):
        a1 = len(end_a)
        step = size
        while a0 + step < len(end_a):
            seen = end_a[a0 + step // 2:a0 + step]
            at = np.searchsorted(end_b, seen)
            both = np.flatnonzero(end_b[np.minimum(at, len(end_b) - 1)] == seen)
            if len(both):
                a1 = a0 + step // 2 + int(both[-1]) + 1
                break
            step *= 2
        b1 = int(np.searchsorted(end_b, end_a[a1 - 1])) + 1
        yield (a0, a1), (b0, b1)
        a0, b0 = a1, b1


def aligned(ids_a: np.ndarray, ids_b: np.ndarray, tool: Tokenizers):
    """((A ids, B ids, A ends, B ends)) of the slices of one or several texts joined."""
    end_a, end_b = np.cumsum(tool.a.size[ids_a]), np.cumsum(tool.b.size[ids_b])
    for (a0, a1), (b0, b1) in slices_of(end_a, end_b, SLICE_TOKENS):
        yield ids_a[a0:a1], ids_b[b0:b1], end_a[a0:a1], end_b[b0:b1]


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, last: np.ndarray, tool: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of 'a1,a2|b1;...;' , bytes up to each token, group number of every A token)."""
    n = len(ids_a)
    group_b = np.cumsum(np.concatenate([[0], (last[n:] == n + np.arange(len(ids_b)))[:-1]])).astype(np.int64)
    group_a = group_b[last[:n] - n]
    groups = int(group_b[-1]) + 1
    n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first = np.cumsum(n_a + n_b) - (n_a + n_b)
    ids = np.empty(n + len(ids_b), np.int64)
    at_a = first[group_a] + np.arange(n) - (np.cumsum(n_a) - n_a)[group_a]
    at_b = (first + n_a)[group_b] + np.arange(len(ids_b)) - (np.cumsum(n_b) - n_b)[group_b]
    ids[at_a], ids[at_b] = ids_a, ids_b
    flat, starts, size = tool.decimal
    out = gather(flat, starts[ids], size[ids])
    ends = np.cumsum(size[ids])
    out[ends[first + n_a - 1] - 1] = ord("|")
    out[ends[first + n_a + n_b - 1] - 1] = ord(";")
    return out, ends[first + n_a + n_b - 1], group_a


# --- stages ------------------------------------------------------------------------------------

def tokenized(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, k, ids_a, ids_b) of every document; no ids where it has no tokens."""
    def run(batches):
        tool = tokenizers_of(a_path, b_path)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets):
                part = batch.slice(lo, hi - lo)
                a, b = zip(*tool.encode(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                                 ["doc_id", "ids_a", "ids_b"])
    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids_a binary, ids_b binary")


def joined_texts(column_a, column_b, tool: Tokenizers):
    """Neighbouring documents whose tokens fill a slice: (first, last, A ids, B ids, byte ends of the documents)."""
    lo, size, a, b = 0, 0, [], []
    for i, (x, y) in enumerate(zip(column_a, column_b)):
        a.append(np.frombuffer(x.as_buffer(), tool.a.kind))
        b.append(np.frombuffer(y.as_buffer(), tool.b.kind))
        size += len(a[-1])
        if size >= SLICE_TOKENS // 4 or i == len(column_a) - 1:
            ends = np.cumsum([int(tool.a.size[x].sum()) for x in a])
            yield lo, i + 1, np.concatenate(a), np.concatenate(b), ends
            lo, size, a, b = i + 1, 0, [], []


def pair_counts(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair, n): documents that hold an id pair linked."""
    def run(batches):
        tool = tokenizers_of(a_path, b_path)
        for batch in batches:
            for _, _, ids_a, ids_b, doc_ends in joined_texts(batch.column(1), batch.column(2), tool):
                seen = []
                for x, y, end_a, end_b in aligned(ids_a, ids_b, tool):
                    i, j = links(end_a, end_b)
                    doc = np.searchsorted(doc_ends, end_a[i])
                    pair = x[i].astype(np.int64) * SIDE + y[j]
                    order = np.lexsort((pair, doc))
                    doc, pair = doc[order], pair[order]
                    fresh = np.ones(len(pair), bool)
                    fresh[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
                    seen.append((doc[fresh], pair[fresh]))
                if len(seen) > 1:  # a text over several slices: its pairs once
                    doc, pair = (np.concatenate(c) for c in zip(*seen))
                    order = np.lexsort((pair, doc))
                    doc, pair = doc[order], pair[order]
                    fresh = np.ones(len(pair), bool)
                    fresh[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
                    seen = [(doc[fresh], pair[fresh])]
                for _, pair in seen:
                    pairs, n = np.unique(pair, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])
    counted = map_arrow(rows, run, "pair long, n long")
    return materialize(counted.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")


class Counts:
    """Broadcast part of the pair counts: the head, and the highest count of every A id."""

    def __init__(self, pairs: DataFrame, head_pairs: int = HEAD_PAIRS):
        size = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
        bins = {r["b"]: r["c"] for r in pairs.groupBy(size.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}
        total, self.least = 0, 1 << 62   # counts from here on are in the head
        for b in sorted(bins, reverse=True):
            total += bins[b]
            if total > head_pairs:
                break
            self.least = 1 << b
        self.has_tail = sum(bins.values()) > sum(c for b, c in bins.items() if 1 << b >= self.least)
        head = pairs.filter(F.col("n") >= self.least).toArrow().combine_chunks()
        order = np.argsort(head["pair"].to_numpy())
        self.pair, self.n = head["pair"].to_numpy()[order], head["n"].to_numpy()[order]
        best = pairs.groupBy(F.floor(F.col("pair") / SIDE).alias("a")).agg(F.max("n").alias("n")).toArrow()
        self.best = np.zeros(SIDE, np.int64)
        self.best[best["a"].to_numpy()] = best["n"].to_numpy()

    def of(self, pair: np.ndarray) -> np.ndarray:
        """Count of every pair; 0 for those of the tail."""
        if not len(self.pair):
            return np.zeros(len(pair), np.int64)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        return np.where(self.pair[at] == pair, self.n[at], 0)


ROWS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
        "tail array<struct<pair:long,m:long,best:long>>")


def digests(rows: DataFrame, counts: Counts, a_path: str, b_path: str) -> DataFrame:
    """A row per document with the counts of its head pairs, and its tail pairs to be joined."""
    known = rows.sparkSession.sparkContext.broadcast(counts)
    tail_type = pa.list_(pa.struct([("pair", pa.int64()), ("m", pa.int64()), ("best", pa.int64())]))

    def run(batches):
        tool, table = tokenizers_of(a_path, b_path), known.value
        for batch in batches:
            for lo, hi, ids_a, ids_b, doc_ends in joined_texts(batch.column(1), batch.column(2), tool):
                docs = hi - lo
                n_groups, n_links, n_best, total = (np.zeros(docs, np.int64) for _ in range(4))
                digest = [hashlib.sha256() for _ in range(docs)]
                held: list[bytes] = [b""] * docs  # the last ';' of what was digested so far
                tails = [[] for _ in range(docs)]
                for x, y, end_a, end_b in aligned(ids_a, ids_b, tool):
                    text, text_ends, group_a = group_text(x, y, terminals(end_a, end_b), tool)
                    last_a = np.flatnonzero(np.append(group_a[1:] != group_a[:-1], True))
                    doc_of_group = np.searchsorted(doc_ends, end_a[last_a])
                    n_groups += np.bincount(doc_of_group, minlength=docs)
                    at = np.flatnonzero(np.append(doc_of_group[1:] != doc_of_group[:-1], True))
                    raw, start = text.tobytes(), 0
                    for d, end in zip(doc_of_group[at].tolist(), text_ends[at].tolist()):
                        digest[d].update(held[d] + raw[start:end - 1])
                        held[d], start = b";", end
                    i, j = links(end_a, end_b)
                    doc = np.searchsorted(doc_ends, end_a[i])
                    pair = x[i].astype(np.int64) * SIDE + y[j]
                    n = table.of(pair)
                    best = table.best[x[i]]
                    n_links += np.bincount(doc, minlength=docs)
                    n_best += np.bincount(doc[n == best], minlength=docs)
                    edge = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    total[doc[edge]] += np.add.reduceat(n, edge)
                    if table.has_tail:
                        rare = np.flatnonzero(n == 0)
                        order = rare[np.lexsort((pair[rare], doc[rare]))]
                        fresh = np.ones(len(order), bool)
                        fresh[1:] = (pair[order][1:] != pair[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                        first = np.flatnonzero(fresh)
                        for d, p, m, top in zip(doc[order][first].tolist(), pair[order][first].tolist(),
                                                np.diff(np.append(first, len(order))).tolist(), best[order][first].tolist()):
                            tails[d].append({"pair": p, "m": m, "best": top})
                some = [held[d] != b"" for d in range(docs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, docs),
                     pa.array([len(v.as_buffer()) // tool.a.flat.itemsize for v in batch.column(1).slice(lo, docs)], pa.int64()),
                     pa.array([len(v.as_buffer()) // tool.b.flat.itemsize for v in batch.column(2).slice(lo, docs)], pa.int64()),
                     *[pa.array(c) for c in (n_groups, n_links, n_best, total)],
                     pa.array([d.hexdigest() if s else "" for d, s in zip(digest, some)], pa.string()), pa.array(tails, tail_type)],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "tail"])
    return map_arrow(rows, run, ROWS)


def align(docs: DataFrame, folder: str | None = None, a_name: str = BYTE_FILE, b_name: str = PIECE_FILE,
          head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row."""
    a_path, b_path = tokenizer_path(a_name, folder), tokenizer_path(b_name, folder)
    rows = materialize(tokenized(docs, a_path, b_path), "align-ids")
    pairs = pair_counts(rows, a_path, b_path)
    counts = Counts(pairs, head_pairs)
    out = digests(rows, counts, a_path, b_path)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not counts.has_tail:
        return out.select(*columns)
    # rare pairs: joined by pair, summed per row; a row is known by its place in a written stage
    out = materialize(out.withColumn("row", F.monotonically_increasing_id()), "align-rows")
    rare = out.filter(F.size("tail") > 0).select("row", F.inline("tail"))
    met = rare.join(pairs.filter(F.col("n") < counts.least), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("m")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("m")).alias("more"))
    return out.join(met, "row", "left").select(
        *columns[:5], (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")


def overlap_table(docs: DataFrame, folder: str | None = None, a_name: str = BYTE_FILE, b_name: str = PIECE_FILE) -> DataFrame:
    """a_id, b_id, n_documents of every linked id pair of the corpus: a map between the vocabularies."""
    a_path, b_path = tokenizer_path(a_name, folder), tokenizer_path(b_name, folder)
    pairs = pair_counts(materialize(tokenized(docs, a_path, b_path), "align-ids"), a_path, b_path)
    return pairs.select(F.floor(F.col("pair") / SIDE).cast("int").alias("a_id"), F.pmod("pair", F.lit(SIDE)).cast("int").alias("b_id"),
                        F.col("n").alias("n_documents"))
