import zlib

import numpy as np
import pytest

from hourglass.llm import toxicity as T


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


@pytest.fixture(scope="module")
def model(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return T.train(*T.sample(docs, labels, sample_rows=500))


def test_held_out_rows(spark, labels, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    j = T.score(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out")
    toxic, clean = j.filter("toxic = 1"), j.filter("toxic = 0")
    # some labelled toxic rows of this table hold none of the words that mark the others
    assert toxic.filter("predicted = 1").count() / toxic.count() > 0.9
    assert clean.filter("predicted = 0").count() / clean.count() > 0.98


def test_sample_keeps_to_fold_and_bound(small_docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    texts, y = T.sample(small_docs, labels, sample_rows=7)
    assert y.count(0) <= 7 and y.count(1) <= 7 and len(texts) == len(y)
    held = {r.text for r in small_docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    other = {r.text for r in small_docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 0}
    assert all(t in other or t not in held for t in texts)


def test_odd_rows(odd, empty, model, spark):
    got = T.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert T.score(empty, model).count() == 0
    assert T.screen(odd, model).columns == odd.columns
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.classify(odd, none).filter("predicted = 1").count() == 0


def test_score_reads_the_text_only(odd, model):
    a = sorted((r.score for r in T.score(odd, model).collect()))
    b = sorted((r.score for r in T.score(odd.selectExpr("text", "doc_id + 1 as doc_id", "'q' as lang"), model).collect()))
    assert a == b


def test_training_is_deterministic_and_finds_a_word():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{rng.integers(500)}" for _ in range(30)) for _ in range(120)]
    labels = [i % 2 for i in range(120)]
    texts = [t + " badword" if y else t for t, y in zip(texts, labels)]
    a, b = T.train(texts, labels), T.train(texts, labels)
    raw = np.frombuffer(b"w3 w9 badword w1", np.uint8)
    clean = np.frombuffer(b"w3 w9 w8 w1", np.uint8)
    ends = lambda x: np.array([0, len(x)])
    assert a.scores(raw, ends(raw))[0][0] > 0.5 > a.scores(clean, ends(clean))[0][0]
    assert a.scores(raw, ends(raw))[0][0] == b.scores(raw, ends(raw))[0][0]


def test_training_holds_two_bytes_a_word_and_view():
    texts = ["der Hund und die Katze", "12 ?!", "été où", *[f"the word{i} of " * 4000 for i in range(5)], "end"]
    rows, langs = T.training_rows(texts)
    assert len(rows) == len(langs) == len(texts)
    for text, got, lang in zip(texts, rows, langs):
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, doc = T.word_hashes(raw, np.array([0, len(raw)]))
        assert (got == (hashes >> np.uint64(64 - T.BITS))).all() and got.shape == hashes.shape
        assert lang == T.guess_language(hashes, doc, 1)[0]
    assert sum(r.nbytes for r in rows) == sum(2 * r.size for r in rows)
