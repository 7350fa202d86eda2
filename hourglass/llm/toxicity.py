"""Toxicity scores from a convolutional text classifier trained in numpy.

Words are hashed into small embedding tables by their whole form, their first four and
six bytes and their last four: a word is the sum of one row of each table, so inflected
forms share rows and two words are confused only if all their rows meet. Filters of widths 1, 2 and 3
slide over the words, the maximum of each over the whole text goes through a ReLU into a
logistic unit. The decision threshold is calibrated for each language guess; the guess
comes from function words of the text, never from a column. Scores are shifted so that
0.5 is the calibrated threshold. Training reads a bounded sample of labelled documents;
scoring is map-only over whole texts.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import LOWER, NON_LETTERS, SubstringHash, crc_mod, map_arrow, slices, text_buffer, words

SAMPLE_ROWS = 3000        # labelled documents per class (the documented training bound)
TRAINING_BYTES = 1 << 16  # of training texts hashed together
BITS = 15                 # rows of each embedding table: 2 ** BITS, 16 at most
VIEWS = 4                 # whole word, first 4, first 6, last 4 bytes
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8               # per width
EPOCHS = 8
MIN_STEPS = 800           # small samples are passed over more often
BATCH = 32
CALIBRATION_SHARE = 4     # every 4th sampled document only calibrates
MIN_CALIBRATION = 30      # a language with fewer documents of either class uses the common threshold
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, lang_guess string"

# Frequent function words by which the calibration language is guessed.
FUNCTION_WORDS = {
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat",
    "en": "the of and to in is that it was for on are with as at be this have from or had by not but what all were",
    "es": "el la los del se las por un para con una su al lo como más pero sus le ya este sí porque esta entre cuando",
    "fr": "le les des du un une est et dans qui que pour pas sur au plus par je avec tout faire son mais comme ou",
}
_HASH = SubstringHash(11)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(VIEWS x words array of 64-bit hashes of each lower-cased word and its parts, its document)."""
    low = LOWER[data]
    start, end, doc = words(low, offsets, NON_LETTERS)
    p = _HASH.prefix(low)
    views = [(start, end), (start, np.minimum(start + 4, end)), (start, np.minimum(start + 6, end)),
             (np.maximum(end - 4, start), end)]
    return np.stack([_HASH.of(p, a, b) for a, b in views]), doc


@functools.cache
def _language_table() -> tuple[np.ndarray, np.ndarray, list[str]]:
    langs = sorted(FUNCTION_WORDS)
    pairs: dict[int, set] = {}
    for k, lang in enumerate(langs):
        for w in FUNCTION_WORDS[lang].split():
            raw = np.frombuffer(w.encode(), np.uint8)
            h = int(word_hashes(raw, np.array([0, len(raw)]))[0][0, 0])
            pairs.setdefault(h, set()).add(k)
    own = sorted((h, min(k)) for h, k in pairs.items() if len(k) == 1)  # a word of two languages says nothing
    return np.array([h for h, _ in own], np.uint64), np.array([k for _, k in own]), langs


def guess_language(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Index of the language with most function words per document; the number of languages if none."""
    keys, of, langs = _language_table()
    whole = hashes[0]
    at = np.minimum(np.searchsorted(keys, whole), len(keys) - 1)
    hit = keys[at] == whole
    votes = np.zeros((n_docs, len(langs) + 1))
    votes[:, -1] = 0.5
    np.add.at(votes, (doc[hit], of[at[hit]]), 1)
    return votes.argmax(1)


def table_rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.uint16)


@dataclass
class ConvClassifier:
    """Weights; ``threshold`` and ``scale`` by language index (last: no guess)."""

    tables: np.ndarray      # (VIEWS, 2 ** BITS, DIM)
    filters: list           # per width: (width, DIM, FILTERS)
    bias: np.ndarray        # (len(WIDTHS) * FILTERS,)
    out: np.ndarray
    out_bias: float
    threshold: np.ndarray

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return sum(table[r] for table, r in zip(self.tables, rows))

    def pool(self, emb: np.ndarray, doc: np.ndarray, n_docs: int, with_places: bool = False):
        """Maximum of every filter over each document (0 without a place) and where it stands.

        Documents are contiguous runs of ``doc``; a width needs that many words.
        """
        best = np.zeros((n_docs, len(WIDTHS) * FILTERS), np.float32)
        place = np.full(best.shape, -1, np.int64)
        for k, width in enumerate(WIDTHS):
            n = len(emb) - width + 1
            if n <= 0:
                continue
            conv = sum(emb[j:n + j] @ self.filters[k][j] for j in range(width))
            ok = np.flatnonzero(doc[:n] == doc[width - 1:])
            if not len(ok):
                continue
            conv, owner = conv[ok], doc[ok]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            top = np.maximum.reduceat(conv, starts, axis=0)
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            best[owner[starts], cols] = top
            if with_places:
                for i, (lo, hi) in enumerate(zip(starts, np.append(starts[1:], len(conv)))):
                    place[owner[lo], cols] = ok[lo + conv[lo:hi].argmax(0)]
        return best, place

    def logits(self, rows: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        best, _ = self.pool(self.embed(rows), doc, n_docs)
        return np.maximum(best + self.bias, 0) @ self.out + self.out_bias

    def scores(self, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        hashes, doc = word_hashes(data, offsets)
        lang = guess_language(hashes, doc, n)
        z = self.logits(table_rows(hashes), doc, n) - self.threshold[lang]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), lang


def training_rows(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """(table rows of each text's words, index of its guessed language).

    The driver holds the sample as 2 bytes a word and view; hashes are made for a few texts at a time.
    """
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    rows, langs = [], []
    for lo, hi in slices(offsets, TRAINING_BYTES):
        data = np.frombuffer("".join(texts[lo:hi]).encode(), np.uint8)
        hashes, doc = word_hashes(data, offsets[lo:hi + 1] - offsets[lo])
        rows += np.split(table_rows(hashes), np.searchsorted(doc, np.arange(1, hi - lo)), axis=1)
        langs.append(guess_language(hashes, doc, hi - lo))
    return rows, np.concatenate(langs)


def train(texts: list[str], labels: list[int], seed: int = 5) -> ConvClassifier:
    """Adagrad on the logistic loss; classes are weighted evenly. Deterministic for a given order."""
    rng = np.random.default_rng(seed)
    n_langs = len(FUNCTION_WORDS) + 1
    n_out = len(WIDTHS) * FILTERS
    model = ConvClassifier(rng.normal(0, 0.07, (VIEWS, 1 << BITS, DIM)).astype(np.float32),
                           [rng.normal(0, 0.5 / width, (width, DIM, FILTERS)).astype(np.float32) for width in WIDTHS],
                           np.zeros(n_out, np.float32), rng.normal(0.3, 0.1, n_out).astype(np.float32), 0.0,
                           np.zeros(n_langs))
    if not texts or len(set(labels)) < 2:
        model.out[:] = 0
        model.out_bias = 5.0 if labels and labels[0] else -5.0
        return model
    docs, langs = training_rows(texts)
    y = np.asarray(labels, np.float32)
    fits = np.arange(len(docs)) % CALIBRATION_SHARE != 0
    if len(set(y[fits])) < 2:
        fits[:] = True
    weight = np.where(y == 1, 0.5 / max(y[fits].mean(), 1e-6), 0.5 / max(1 - y[fits].mean(), 1e-6))
    squares = [np.full_like(model.tables, 1e-3), [np.full_like(f, 1e-3) for f in model.filters],
               np.full_like(model.bias, 1e-3), np.full_like(model.out, 1e-3), 1e-3]
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // int(fits.sum())))
    for epoch in range(epochs):
        order = rng.permutation(np.flatnonzero(fits))
        for lo in range(0, len(order), BATCH):
            _step(model, squares, [docs[i] for i in order[lo:lo + BATCH]], y[order[lo:lo + BATCH]],
                  weight[order[lo:lo + BATCH]], rate=0.1 / (1 + 3 * epoch / epochs))
    _calibrate(model, docs, langs, y, ~fits if (~fits).any() else fits)
    return model


def _step(model: ConvClassifier, squares: list, docs: list, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
    n = len(docs)
    index = np.concatenate(docs, axis=1)
    doc = np.repeat(np.arange(n), [d.shape[1] for d in docs])
    emb = model.embed(index)
    best, place = model.pool(emb, doc, n, with_places=True)
    hidden = np.maximum(best + model.bias, 0)
    p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.out_bias, -30, 30)))
    dz = ((p - y) * weight / n).astype(np.float32)
    d_hidden = dz[:, None] * model.out[None] * (best + model.bias > 0)
    d_out, d_bias, d_out_bias = hidden.T @ dz, d_hidden.sum(0), float(dz.sum())
    rows, grads = [], []
    for k, width in enumerate(WIDTHS):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        g, at = d_hidden[:, cols], place[:, cols]
        used = at >= 0
        f = np.broadcast_to(np.arange(FILTERS), at.shape)[used]
        at, g = at[used], g[used]
        d_filter = np.zeros_like(model.filters[k])
        for j in range(width):
            np.add.at(d_filter[j].T, f, g[:, None] * emb[at + j])
            rows.append(at + j)
            grads.append(g[:, None] * model.filters[k][j].T[f])
        _adagrad(model.filters[k], squares[1][k], d_filter, rate)
    if rows:
        rows, grads = np.concatenate(rows), np.concatenate(grads)
        for t in range(VIEWS):
            hit, inverse = np.unique(index[t][rows], return_inverse=True)
            total = np.zeros((len(hit), DIM), np.float32)
            np.add.at(total, inverse, grads)
            squares[0][t][hit] += total ** 2
            model.tables[t][hit] -= rate * total / np.sqrt(squares[0][t][hit])
    _adagrad(model.bias, squares[2], d_bias, rate)
    _adagrad(model.out, squares[3], d_out, rate)
    squares[4] += d_out_bias ** 2
    model.out_bias -= rate * d_out_bias / squares[4] ** 0.5


def _adagrad(x: np.ndarray, square: np.ndarray, g: np.ndarray, rate: float) -> None:
    square += g ** 2
    x -= (rate * g / np.sqrt(square)).astype(x.dtype)


def _calibrate(model: ConvClassifier, docs: list, langs: np.ndarray, y: np.ndarray, use: np.ndarray) -> None:
    """Threshold by language: fewest errors on the calibration documents, middle of the best gap."""
    chosen = np.flatnonzero(use)
    rows = np.concatenate([docs[i] for i in chosen], axis=1)
    doc = np.repeat(np.arange(len(chosen)), [docs[i].shape[1] for i in chosen])
    z, lang, t = model.logits(rows, doc, len(chosen)), langs[chosen], y[chosen]
    common = best_threshold(z, t)
    for k in range(len(model.threshold)):
        own = lang == k
        enough = min((t[own] == 1).sum(), (t[own] == 0).sum()) >= MIN_CALIBRATION
        model.threshold[k] = best_threshold(z[own], t[own]) if enough else common


def best_threshold(z: np.ndarray, t: np.ndarray) -> float:
    order = np.argsort(z, kind="stable")
    z, t = z[order], t[order]
    errors = np.concatenate([[0], np.cumsum(t == 1)]) + (t == 0).sum() - np.concatenate([[0], np.cumsum(t == 0)])
    padded = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    gaps = np.where(errors == errors.min(), padded[1:] - padded[:-1], -1)
    k = int(gaps.argmax())
    return float((padded[k] + padded[k + 1]) / 2)


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], list[int]]:
    """At most ``sample_rows`` training documents of each class, by smallest id hash.

    Only the bounded id sample is broadcast; it then picks its rows from one scan of the documents.
    """
    labels = (labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)")
              .filter(crc_mod("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    h = F.xxhash64("doc_id")
    picked = None
    for c in (0, 1):
        part = labels.filter(F.col("toxic") == c).orderBy(h, "doc_id").limit(sample_rows)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select("doc_id", "text").filter("text <> ''").join(F.broadcast(picked), "doc_id")
            .select(F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"), "doc_id", "toxic", "text")
            .collect())
    rows.sort()
    return [r[3] for r in rows], [int(r[2]) for r in rows]


def score(docs: DataFrame, model: ConvClassifier) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_guess for every row of docs.

    Null and empty texts get the score of a text without words. A null doc_id stays
    null, repeated rows repeat, other columns are ignored.
    """
    def run(batches):
        langs = [*sorted(FUNCTION_WORDS), "none"]
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets):
                s, lang = model.scores(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                     pc.cast(batch.column(2).slice(lo, hi - lo), pa.bool_()), pa.array(s.astype(np.float64)),
                     pa.array((s >= 0.5).astype(np.int32)), pa.array([langs[i] for i in lang], pa.string())],
                    ["doc_id", "held_out", "score", "predicted", "lang_guess"])
    held_out = (crc_mod("doc_id", 5) == 0).alias("held_out")
    return map_arrow(docs.select("doc_id", "text", held_out), run, SCHEMA)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(*sample(docs, labels)))


def screen(docs: DataFrame, model: ConvClassifier) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept; map-only."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            for lo, hi in slices(offsets):
                s, _ = model.scores(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield batch.slice(lo, hi - lo).filter(pa.array(s < 0.5))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, schema)
