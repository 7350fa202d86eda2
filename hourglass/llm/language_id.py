"""Language identification by compression.

One raw-content zstandard dictionary per language is cut from a bounded sample of
labelled documents. A text is encoded in blocks with every dictionary; the language
whose dictionary gives the fewest bytes wins. A narrow margin is marked as rejected.
Texts are reduced to lower-case letter runs first, so digits, markup and upper case do
not decide. Scoring is map-only over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourglass.llm.common import crc_mod, import_path, map_arrow

SAMPLE_ROWS = 200          # labelled documents per language (the documented training bound)
GROUP = 64                 # dictionaries a task holds at once; more languages are scored in groups
BATCH = 512                # texts scored with one group before the next is built
DICT_BYTES = 96 * 1024
BLOCK_BYTES = 4096
MIN_MARGIN = 0.01          # relative to the smallest encoding; below it the answer is rejected
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean, held_out boolean"

# A-Z to lower case, every other ASCII byte but a-z to a blank; UTF-8 sequences stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold(raw: bytes) -> bytes:
    return b" ".join(raw.translate(_FOLD).split())


@dataclass
class CompressionModel:
    """Per-language dictionaries; pickled to the tasks, compressors are built there."""

    samples: dict[str, bytes]
    _tools: list = field(default=None, repr=False)

    def __getstate__(self):
        return {"samples": self.samples, "_tools": None}

    @property
    def languages(self) -> list[str]:
        return sorted(self.samples)

    def _groups(self):
        """(place of the first language, compressors) of GROUP languages at a time; a single group is kept."""
        if self._tools is not None:
            yield 0, self._tools
            return
        langs = self.languages
        for lo in range(0, len(langs), GROUP):
            tools = [compressor(self.samples[x]) for x in langs[lo:lo + GROUP]]
            if len(langs) <= GROUP:
                self._tools = tools
            yield lo, tools

    def sizes_of(self, raws: list[bytes]) -> np.ndarray:
        """Encoded bytes of each whole folded text (row), per language (column)."""
        out = np.zeros((len(raws), len(self.samples)), np.int64)
        texts = [fold(raw) for raw in raws]
        for lo, tools in self._groups():
            for i, text in enumerate(texts):
                for at in range(0, len(text), BLOCK_BYTES):
                    block = text[at:at + BLOCK_BYTES]
                    out[i, lo:lo + len(tools)] += [len(t.compress(block)) for t in tools]
        return out

    def sizes(self, raw: bytes) -> np.ndarray:
        return self.sizes_of([raw])[0]

    def predict(self, raw: bytes) -> tuple[str, float, bool]:
        return self.predict_all([raw])[0]

    def predict_all(self, raws: list[bytes]) -> list[tuple[str, float, bool]]:
        """(language, score 0..1, rejected) of each text; ties go to the first language by code point."""
        out = [(UNKNOWN, 0.0, True)] * len(raws)
        known = [i for i, raw in enumerate(raws) if raw and has_letter(raw)] if self.samples else []
        langs = self.languages
        for i, sizes in zip(known, self.sizes_of([raws[i] for i in known])):
            best = int(sizes.argmin())
            gap = (sizes - sizes[best]) / max(4.0, 0.02 * sizes[best])
            margin = np.delete(sizes, best).min() - sizes[best] if len(sizes) > 1 else sizes[best]
            out[i] = (langs[best], float(1 / np.exp(-gap).sum()), bool(margin < MIN_MARGIN * sizes[best]))
        return out


def compressor(sample: bytes):
    import zstandard
    d = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=3)
    return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def has_letter(raw: bytes) -> bool:
    return bool(raw.translate(_FOLD).strip()) and (any(97 <= c <= 122 for c in set(raw.translate(_FOLD)))
                                                   or any(c.isalpha() for c in raw.decode("utf-8")))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> CompressionModel:
    """Dictionaries from at most ``sample_rows`` distinct texts a language (smallest text hashes).

    The sample is thinned by hash and copies are merged before it is ranked, so no window holds a
    whole language. Dictionaries are cut in the tasks: the driver gets at most DICT_BYTES a language.
    """
    import_path(labelled.sparkSession)
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    data = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .filter("lang is not null and text <> ''").withColumn("h", h))
    per_lang = data.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    # one row a language: far smaller than the dictionaries that every task holds
    thin = (data.join(F.broadcast(per_lang), "lang")
            .filter(F.col("h") * F.col("n") <= F.lit((1 << 30) * 2.0 * sample_rows)).dropDuplicates(["lang", "text"]))
    ranked = thin.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))

    def cut(key: tuple, rows: pa.Table) -> pa.Table:
        order = rows.column("r").to_numpy().argsort()
        texts = [fold(rows.column("text")[int(i)].as_py().encode()) for i in order]
        return pa.table({"lang": [key[0].as_py()], "sample": pa.array([dictionary(texts)], pa.binary())})

    picked = ranked.filter(F.col("r") <= sample_rows).select("lang", "r", "text")
    rows = picked.groupBy("lang").applyInArrow(cut, "lang string, sample binary").collect()
    return CompressionModel({r["lang"]: bytes(r["sample"]) for r in rows})


def dictionary(texts: list[bytes]) -> bytes:
    """Up to DICT_BYTES of distinct text in equal shares; what the shares leave goes to longer texts."""
    texts = list(dict.fromkeys(t for t in texts if t))
    parts, left = [], DICT_BYTES
    for i, t in enumerate(sorted(texts, key=len)):
        part = t[:left // (len(texts) - i)]
        parts.append(part)
        left -= len(part)
    return b" ".join(parts)


def predict(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """One row per document. Null texts and texts without a letter are ``und`` with score 0;
    a null doc_id stays null, repeated rows repeat, other columns are ignored."""
    def run(batches):
        for batch in batches:
            texts, out = batch.column(1).cast(pa.large_binary()), []
            for lo in range(0, len(texts), BATCH):
                out += model.predict_all([t.as_py() or b"" for t in texts.slice(lo, BATCH)])
            lang, score, rejected = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_()), pc.cast(batch.column(2), pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected", "held_out"])
    return map_arrow(docs.select("doc_id", "text", "held_out"), run, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) mod 3 is not 1 and predict all."""
    docs = docs.select("doc_id", "text", "lang", (crc_mod("doc_id", 3) == 1).alias("held_out"))
    return predict(docs, fit(docs.filter(~F.col("held_out"))))
