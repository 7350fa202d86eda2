import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hourglass.llm import suffix_dedup as S


def brute(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check(df, length=S.LENGTH):
    rows = df.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *x) for r, x in zip(rows, brute([(r.text or "").encode() for r in rows], length)))
    got = Counter(tuple(r) for r in S.removal_digest(df, length).collect())
    assert got == want
    return want


def test_whole_table_against_brute_force(small_docs):
    assert sum(x[2] * n for x, n in check(small_docs).items()) > 0


@pytest.mark.parametrize("hot", [S.HOT_STRETCHES, 2])
@pytest.mark.parametrize("length", [8, 21, 40])
def test_periodic_and_repetitive_texts(spark, monkeypatch, hot, length):
    monkeypatch.setattr(S, "HOT_STRETCHES", hot)
    rng = random.Random(length)
    rows = [(i, "".join(rng.choice(["ab", "aab", "é", "x" * 5, "aba" * 4]) for _ in range(rng.randint(0, 60))))
            for i in range(150)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length)


def test_odd_rows(odd, empty):
    check(odd)
    assert S.removal_digest(empty).count() == 0


def test_overlapping_copies_of_one_text(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(0, base), (1, base[100:1500] + "#" + base[1400:2500]), (2, "q" * 401), (3, "q" * 400), (4, base[:399])]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_remaining_texts_are_whole_characters(odd, small_docs):
    left = S.remove_repeats(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert left.filter("text is null").count() == odd.filter("text is null").count()
    for length in (11, 400):
        for r in S.remove_repeats(small_docs, length).select("text").collect():
            r.text.encode()
    assert S.whole_characters("aéb".encode(), [(0, 2)]) == [(0, 1)]
    assert S.whole_characters("aéb".encode(), [(2, 4)]) == [(3, 4)]


def test_pieces_of_a_long_text_hold_every_window_once():
    from hourglass.llm.common import pieces
    rng = np.random.default_rng(3)
    sizes = [5, 0, 5000, 40, 1200, 399, 2600]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = rng.integers(0, 4, offsets[-1]).astype(np.uint8)
    starts = []
    for lo, part, ends, place in pieces(data, offsets, 500, 99):
        for d in range(len(ends) - 1):
            starts += [(lo + d, place + p) for p in range(0, ends[d + 1] - ends[d] - 99)]
            assert (part[ends[d]:ends[d + 1]] == data[offsets[lo + d] + place:][:ends[d + 1] - ends[d]]).all()
    want = [(d, p) for d, n in enumerate(sizes) for p in range(n - 99)]
    assert sorted(starts) == want


def test_a_text_of_20_mb(spark):
    rng = np.random.default_rng(9)
    long_text = bytes(rng.integers(97, 123, 20_000_000, dtype=np.uint8)).decode()
    passage = long_text[9_999_700:10_000_300]
    rows = [(1, long_text), (2, "short " + passage), (3, "other text " * 60)]
    got = {r.doc_id: r for r in S.removal_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_bytes, got[1].n_removed, got[1].n_spans) == (20_000_000, 600, 1)
    assert got[1].kept_sha256 == hashlib.sha256((long_text[:9_999_700] + long_text[10_000_300:]).encode()).hexdigest()
    assert (got[2].n_removed, got[3].n_removed) == (600, 660)
