import zlib

import pytest

from hourglass.llm import language_id as L


@pytest.fixture(scope="module")
def answers(docs):
    return {r.doc_id: r for r in L.identify(docs).collect()}


def test_held_out_accuracy(docs, answers):
    rows = [r for r in docs.select("doc_id", "lang").collect() if answers[r.doc_id].held_out]
    right = sum(answers[r.doc_id].lang_pred == r.lang for r in rows)
    assert len(rows) > 200 and right / len(rows) > 0.95
    sure = [r for r in rows if not answers[r.doc_id].rejected]
    assert sum(answers[r.doc_id].lang_pred == r.lang for r in sure) / len(sure) >= right / len(rows)


def test_folds_and_ranges(docs, answers):
    langs = {r.lang for r in docs.select("lang").distinct().collect()}
    for i, r in answers.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in langs


def test_odd_rows(odd, empty, docs):
    model = L.fit(docs)
    got = L.predict(odd.drop("held_out").selectExpr("doc_id", "text", "true as held_out"), model).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id == 7} <= set(model.languages)
    assert L.identify(empty).count() == 0
    assert {r.lang_pred for r in L.identify(odd.filter("lang is null")).collect()} == {"und"}


def test_letters_and_block_sum():
    assert not L.has_letter(b"12 ... !!") and L.has_letter("字".encode()) and not L.has_letter("—…".encode())
    model = L.CompressionModel({"a": b"hello world this is english " * 20, "b": b"bonjour monde ceci est francais " * 20})
    assert model.predict(b"this is the world, hello")[0] == "a"
    assert model.predict(b"ceci est le monde")[0] == "b"
    assert (model.sizes(b"hello world " * 2000) > 0).all()


def test_sample_bound(docs):
    model = L.fit(docs, sample_rows=3)
    assert set(model.languages) == {"de", "en", "es", "fr"}
    assert all(len(s) <= L.DICT_BYTES + 64 for s in model.samples.values())


def test_more_languages_than_a_group(spark, monkeypatch):
    """Every learned language keeps its dictionary and can win, however many there are."""
    monkeypatch.setattr(L, "GROUP", 7)
    langs = [f"l{i:03d}" for i in range(230)]
    rows = [(k, " ".join(f"{'abcdefghij'[j % 10]}{chr(97 + i % 26)}{chr(97 + i // 26)}{'klmnopq'[j % 7]}" for j in range(60)), x)
            for k, (i, x) in enumerate(enumerate(langs))]
    model = L.fit(spark.createDataFrame(rows * 2, "doc_id long, text string, lang string"))
    assert model.languages == langs
    assert [p[0] for p in model.predict_all([t.encode() for _, t, _ in rows])] == langs


def test_copies_do_not_fill_the_sample(spark):
    rows = [(i, "the same words again", "en") for i in range(500)] + [(1000 + i, f"text number {chr(97 + i)} again", "en") for i in range(20)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=30)
    assert model.samples["en"].count(b"the same words again") == 1 and model.samples["en"].count(b"text number") == 20


def test_sizes_against_a_plain_loop(docs):
    """Encoded sizes of whole texts: every block of every folded text with every dictionary."""
    import zstandard
    model = L.fit(docs, sample_rows=20)
    for text in [r.text for r in docs.select("text").limit(40).collect()] + ["ab cd " * 5000]:
        raw = " ".join("".join(c.lower() if c.isascii() and c.isalpha() else " " if c.isascii() else c for c in text or "").split(" "))
        raw = b" ".join(raw.encode().split())
        want = []
        for lang in sorted(model.samples):
            d = zstandard.ZstdCompressionDict(model.samples[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            c = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            want.append(sum(len(c.compress(raw[i:i + L.BLOCK_BYTES])) for i in range(0, len(raw), L.BLOCK_BYTES)))
        assert model.sizes((text or "").encode()).tolist() == want
