import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from hourglass.llm import bpe, mixing, toxicity
from test_ngram_join import brute as brute_groups
from test_suffix_dedup import brute as _  # noqa: F401  the digest version; spans are needed here
from hourglass.llm.suffix_dedup import cut, whole_characters


def removed(texts, length=400):
    raw = [t.encode() for t in texts]
    count = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        spans = []
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append(cut(t, whole_characters(t, [tuple(s) for s in spans])).decode())
    return out


def test_stages_against_brute_force(spark):
    """Every stage on the rows its predecessor kept, by plain Python; the trained model and the mix plan are shared."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(*toxicity.sample(docs, labels))
    rows = {}
    for r in docs.collect():
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        if model.scores(raw, np.array([0, len(raw)]))[0][0] < 0.5:
            rows[r.doc_id] = r
    groups = brute_groups([(i, r.text) for i, r in sorted(rows.items())])
    ids = sorted(i for (i, n, c) in groups if n == 0 or c == i)
    texts = dict(zip(ids, removed([rows[i].text for i in ids])))
    left = spark.createDataFrame([(i, texts[i], rows[i].source) for i in ids], "doc_id long, text string, source string")
    want = Counter()
    reference = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.tokenizer_path("byte_bpe_50k.json"))
    for r in mixing.mix_counts(left).collect():
        tokens = reference.encode(texts[r.doc_id], add_special_tokens=False).ids
        want[(r.doc_id, len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest())] += len(r.shards)
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in P.run(spark, sf).collect())
    assert got == +want


def test_stages_keep_columns_and_order_of_the_contract():
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_join", "suffix_dedup", "mixing", "bpe"]


def test_stages_on_odd_and_empty_tables(odd, empty, spark):
    base = ["doc_id", "text", "lang", "source", "n_chars"]
    for df in (odd.select(*base), empty.select(*base)):
        n = df.count()
        for name, stage in P.STAGES:
            df = P.table.__globals__["materialize"](stage(spark, df, "/root/testdata/sf0.001"), f"t-{name}")
            if name != "bpe":
                assert df.columns == base
        assert df.count() <= 2 * n
