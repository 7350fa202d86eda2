"""Removal of repeated substrings by distributed prefix doubling over sampled positions.

Every byte covered by a string of ``length`` bytes that starts anywhere else too is removed.
Sorting a suffix at every byte would move many times the input, so the suffixes are
sampled: within every window of ``length`` bytes the position with the smallest hash of
its next k = length / 4 bytes is kept. Equal windows keep equal positions, so a window can
only be repeated if its sampled position is. Positions are then ranked as in prefix
doubling, with equal strings sharing a rank and unique ones dropped after every round:

1. rank by the first k bytes (offset 0); unique positions go;
2. rank by the pair (that rank, rank of the whole stretch of windows that share the
   position): up to 2 * length bytes and so past the threshold. Equal pairs are
   repeated and done; a position with a pair of its own stays open if others share its first
   rank;
3. each window start of an open position is ranked by the pair (first rank, rank of its
   ``length`` bytes), against one representative of every distinct stretch of the same
   first rank. These are compared in bounded buckets; a first rank with more stretches than
   that goes through a pre-aggregated count over all its window starts instead.

Ranks are 64-bit hashes and only ever compared in pairs. Repeats inside one text count
like any others. Texts travel only when they hold an open position or a removed byte (a
fixed-size bitmap tells, an exact join follows).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import SubstringHash, bitmap_blocks, known, map_arrow, pieces, text_buffer
from hourglass.session import materialize

LENGTH = 400
BUCKET_STRETCHES = 1000    # stretches compared in one bucket, about 600 bytes each
PIECE_BYTES = 1 << 17      # sampled together; longer texts in overlapping pieces
HOT_STRETCHES = 8192       # a first rank with more distinct stretches is counted by rows
_HASH = SubstringHash(41)

RUNS = "k1 long, k2 long, h long, x long, s int, c int"
SPANS = "k1 long, k2 long, a int, b int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: block-wise prefix and suffix minima."""
    n = len(x)
    if n < width:
        return x[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1:width - 1 + m])


def sampled_runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(document, first window start in it, windows, rank of the sampled k bytes, rank of the stretch):
    maximal runs of windows of a text that share their sampled position (the leftmost minimum)."""
    k = max(1, length // 4)
    width = length - k + 1
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    prefix = _HASH.prefix(data)
    at = np.arange(n - k + 1)
    gram = _HASH.of(prefix, at, at + k)
    low = sliding_min(gram, width)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(low)]
    p = np.flatnonzero(np.arange(len(low)) + length <= offsets[doc + 1])
    if not len(p):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    fresh = np.ones(len(p), bool)
    fresh[1:] = (p[1:] != p[:-1] + 1) | (low[p[1:]] != low[p[:-1]]) | (doc[p[1:]] != doc[p[:-1]])
    first = np.flatnonzero(fresh)
    s = p[first]
    e = s + np.diff(np.append(first, len(p)))
    # several positions of a run may hold the minimum (periodic text): cut after each of them
    split = []
    for lo in range(0, len(s), 4096):
        part = s[lo:lo + 4096]
        anchor = part + (gram[part[:, None] + np.arange(width)] == low[part][:, None]).argmax(1)
        split += (lo + np.flatnonzero(anchor < e[lo:lo + 4096] - 1)).tolist()
    if split:
        cuts = [s]
        for i in split:
            hits = s[i] + np.flatnonzero(gram[s[i]:e[i] - 1 + width] == low[s[i]])
            cuts.append(hits[hits < e[i] - 1] + 1)
        ends = e
        s = np.sort(np.concatenate(cuts))
        e = np.minimum(np.append(s[1:], n), ends[np.searchsorted(ends, s, side="right")])
    d = doc[s]
    return d, s - offsets[d], e - s, low[s], _HASH.of(prefix, s, e - 1 + length)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` after a 128-bit key of (doc_id, text) and the text."""
    keys = [F.xxhash64(F.lit(n), "doc_id", "text").alias(f"k{n}") for n in (1, 2)]
    return docs.select(*keys, F.coalesce("text", F.lit("")).alias("_text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)])


def position_runs(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_buffer(batch.column(2))
            # a window starts in one piece only; runs of a long text are cut where its pieces are
            for lo, part, ends, place in pieces(data, offsets, PIECE_BYTES, length - 1):
                d, s, c, h, x = sampled_runs(part, ends, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[lo + d]), pa.array(k2[lo + d]), _signed(h), _signed(x),
                     pa.array((place + s).astype(np.int32)), pa.array(c.astype(np.int32))], ["k1", "k2", "h", "x", "s", "c"])
    return map_arrow(texts.select("k1", "k2", "_text"), run, RUNS)


def stretches(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (h, k1, k2, s, c, n, ...) with the bytes of each stretch, cut from the texts."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "s", "c", "n", "hot")).alias("parts"))
    found = known(texts.select("k1", "k2", "_text"), bitmap_blocks(wanted, "k1"), "k1").join(lists, ["k1", "k2"])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                lists_, texts_ = part.column(3), part.column(2).cast(pa.large_binary())
                flat = lists_.flatten()
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists_.offsets.to_numpy()))
                s, c = flat.field("s").to_numpy(), flat.field("c").to_numpy()
                raw = [t.as_py() for t in texts_]
                cut = [raw[d][a:a + n - 1 + length] for d, a, n in zip(owner.tolist(), s.tolist(), c.tolist())]
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [flat.field("h"), part.column(0).take(take), part.column(1).take(take), flat.field("s"),
                     flat.field("c"), flat.field("n"), flat.field("hot"), pa.array(cut, pa.binary())],
                    ["h", "k1", "k2", "s", "c", "n", "hot", "bytes"])
    return map_arrow(found.select("k1", "k2", "_text", "parts"), run,
                     "h long, k1 long, k2 long, s int, c int, n long, hot boolean, bytes binary")


def window_ranks(h: np.ndarray, c: np.ndarray, column, length: int):
    """(stretch, offset, rank pair as one hash) of every window start of the stretches."""
    data, offsets = text_buffer(column)
    owner = np.repeat(np.arange(len(c)), c)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(c) - c, c)
    start = offsets[:-1][owner] + offset
    ranks = _HASH.of(_HASH.prefix(data), start, start + length)
    return owner, offset, ranks


def compare_bucket(table: pa.Table, length: int) -> pa.Table:
    """Spans of the open stretches (n = 1) of a bucket whose windows occur in another stretch of the
    same first rank, or in one that itself stands in several places."""
    table = table.combine_chunks()
    h, c = table["h"].to_numpy(), table["c"].to_numpy().astype(np.int64)
    n, s = table["n"].to_numpy(), table["s"].to_numpy()
    owner, offset, ranks = window_ranks(h, c, table["bytes"], length)
    order = np.lexsort((ranks, h[owner]))
    ho, ro = h[owner][order], ranks[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (ho[1:] != ho[:-1]) | (ro[1:] != ro[:-1])
    group = np.cumsum(fresh) - 1
    weight = np.bincount(group, np.minimum(n[owner][order], 2), minlength=1)
    repeated = np.zeros(len(order), bool)
    repeated[order] = weight[group] >= 2
    p = np.flatnonzero(repeated & (n[owner] == 1))
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1] + 1) | (owner[p[1:]] != owner[p[:-1]])
    first = p[new]
    last = p[np.append(np.flatnonzero(new)[1:], len(p)) - 1] if len(p) else p
    at = pa.array(owner[first])
    a = s[owner[first]] + offset[first]
    b = s[owner[first]] + offset[last] + length
    return pa.Table.from_arrays([table["k1"].take(at), table["k2"].take(at), pa.array(a.astype(np.int32)),
                                 pa.array(b.astype(np.int32))], ["k1", "k2", "a", "b"])


def window_rows(parts: DataFrame, length: int) -> DataFrame:
    """One row per window start of ``parts``: (h, r, k1, k2, p, n)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                h, c = part.column(0).to_numpy(), part.column(4).to_numpy().astype(np.int64)
                owner, offset, ranks = window_ranks(h, c, part.column(7), length)
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), _signed(ranks), part.column(1).take(take), part.column(2).take(take),
                     pa.array((part.column(3).to_numpy()[owner] + offset).astype(np.int32)), part.column(5).take(take)],
                    ["h", "r", "k1", "k2", "p", "n"])
    return map_arrow(parts, run, "h long, r long, k1 long, k2 long, p int, n long")


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, spans): byte ranges [a, b) to remove per text key; they may overlap."""
    runs = materialize(position_runs(texts, length), "suffix-runs")
    # round 1: rank by k bytes
    # (written first: a join of two plain exchanges lets Spark split a rank that many positions share)
    shared = materialize(runs.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("h"), "suffix-twice")
    runs = materialize(runs.join(shared, "h"), "suffix-shared")
    # round 2: rank by the whole stretch
    ranked = runs.groupBy("h", "x", "c").agg(F.count(F.lit(1)).alias("n"),
                                             F.min(F.struct("k1", "k2", "s")).alias("one"))
    ranked = materialize(ranked, "suffix-ranks")
    done = runs.join(ranked.filter("n > 1").select("h", "x", "c"), ["h", "x", "c"]).select(
        "k1", "k2", F.col("s").alias("a"), (F.col("s") + F.col("c") - 1 + length).alias("b"))
    # round 3: window starts of what is open
    still = (ranked.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("n") == 1).alias("u"))
             .filter("m > 1 AND u > 0").select("h", (F.col("m") > HOT_STRETCHES).alias("hot")))
    wanted = ranked.join(still, "h").select("h", "one.*", "c", "n", "hot")
    parts = materialize(stretches(texts, materialize(wanted, "suffix-open"), length), "suffix-stretches")
    buckets = max(1, -(-parts.count() // BUCKET_STRETCHES))
    cold = (parts.filter("NOT hot").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
            .groupBy("bucket").applyInArrow(lambda t: compare_bucket(t, length), SPANS))
    rows = window_rows(parts.filter("hot").select("h", "k1", "k2", "s", "c", "n", "hot", "bytes"), length)
    twice = rows.groupBy("h", "r").agg(F.sum(F.least("n", F.lit(2))).alias("w")).filter("w > 1").select("h", "r")
    hot = rows.filter("n = 1").join(twice, ["h", "r"]).select(
        "k1", "k2", F.col("p").alias("a"), (F.col("p") + length).alias("b"))
    spans = done.unionByName(cold).unionByName(hot)
    return materialize(spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "suffix-spans")


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges; ranges that touch are one run."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk so that no character is cut: what is left stays valid UTF-8."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _with_spans(docs: DataFrame, keep: list[str], length: int) -> list[DataFrame]:
    """[rows without spans, rows with them]: k1, k2, _text, kept columns, spans."""
    texts = keyed(docs, keep)
    spans = repeated_spans(texts, length)
    blocks = bitmap_blocks(spans, "k1")
    clean = known(texts, blocks, "k1", inside=False).withColumn("spans", F.lit(None).cast("array<struct<a:int,b:int>>"))
    return [clean, known(texts, blocks, "k1").join(spans, ["k1", "k2"], "left")]


def _texts_and_spans(batch: pa.RecordBatch):
    last = batch.num_columns - 1
    lists = batch.column(last)
    for i, raw in enumerate(batch.column(2).cast(pa.large_binary())):
        found = lists[i].as_py() if lists[i].is_valid else None
        yield raw.as_py(), merged((x["a"], x["b"]) for x in found) if found else []


def removal_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null and empty texts have no bytes. Rows are told apart by (doc_id, text): repeated rows
    repeat each other and lose their bytes if long enough; a null doc_id stays null; an empty
    table gives no row; other columns are ignored.
    """
    def run(batches):
        for batch in batches:
            out = []
            for raw, spans in _texts_and_spans(batch):
                out.append((len(raw), sum(b - a for a, b in spans), len(spans),
                            hashlib.sha256(cut(raw, spans)).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(3).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    a, b = (map_arrow(x, run, schema) for x in _with_spans(docs, ["doc_id"], length))
    return a.unionByName(b)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes of ``text`` removed (whole characters only; a null text stays null)."""
    keep = [c for c in docs.columns if c != "text"]
    schema = ", ".join(["text string", *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep], "had_text boolean"])

    def run(batches):
        for batch in batches:
            left = [cut(raw, whole_characters(raw, spans)).decode() for raw, spans in _texts_and_spans(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), *batch.columns[3:-1]], [*["text"], *keep, "had_text"])
    had = docs.withColumn("had_text", F.col("text").isNotNull())
    a, b = (map_arrow(x, run, schema) for x in _with_spans(had, [*keep, "had_text"], length))
    out = a.unionByName(b)
    return out.select(*[F.when(F.col("had_text"), F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`")
                        for c in docs.columns])
