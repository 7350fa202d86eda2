import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from hourglass.llm import align as A

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A.tokenizer_path(A.BYTE_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=A.tokenizer_path(A.PIECE_FILE))
    return a, b


def token_bytes(libraries, text):
    """[(id, bytes)] of both sides, whole text at once, from the libraries alone."""
    a, b = libraries
    alphabet = A.byte_alphabet()
    side_a = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        side_b.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    return side_a, side_b


def plain(libraries, texts):
    """Expected rows by plain loops over token ranges."""
    docs = []
    for text in texts:
        groups, links = [], []
        if text:
            a, b = token_bytes(libraries, text)
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) == raw and b"".join(x for _, x in b) == raw:
                i = j = at_a = at_b = 0
                group = ([], [])
                while i < len(a) or j < len(b):
                    if i < len(a) and at_a <= at_b:
                        group[0].append(a[i][0])
                        at_a, i = at_a + len(a[i][1]), i + 1
                    else:
                        group[1].append(b[j][0])
                        at_b, j = at_b + len(b[j][1]), j + 1
                    if at_a == at_b and group[0] and group[1]:
                        groups.append(group)
                        group = ([], [])
                ranges = []
                for side in (a, b):
                    at, out = 0, []
                    for t, x in side:
                        out.append((t, at, at + len(x)))
                        at += len(x)
                    ranges.append(out)
                lo = 0
                for t, s, e in ranges[0]:
                    while lo < len(b) and ranges[1][lo][2] <= s:
                        lo += 1
                    k = lo
                    while k < len(b) and ranges[1][k][1] < e:
                        links.append((t, ranges[1][k][0]))
                        k += 1
        docs.append((groups, links))
    count = Counter(p for _, links in docs for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def odd_texts(seed, n):
    rng = random.Random(seed)
    pool = ["word", " the", "'ll", "'s", "\n", "\n\n", "  ", "\t", " ", "é", "漢字", "🙂", " ", "　", "\x1c", "12", "３", "!!",
            "<|endoftext|>", "<|endof", "text|>", "-", "x" * 40, "\r\n", "\x85", "A", "▁", "<0x41>", "<s>", "</s>", "<unk>", "\0", "ﬁ", "Å"]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(50))) for _ in range(n)]


@pytest.mark.parametrize("head", [A.HEAD_PAIRS, 40, 0])
def test_against_plain_loops(spark, libraries, small_docs, head):
    rows = [r.text for r in small_docs.select("text").collect()][:120] + odd_texts(1, 150) + [None, "", " ", "   ", "a\n  b", "▁"]
    rows += rows[:7]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in A.align(df, head_pairs=head).select(COLUMNS).collect()}
    for i, want in enumerate(plain(libraries, rows)):
        assert got[i] == want, (i, rows[i])
    assert sum(w[0] == 0 and bool(t) for w, t in zip(plain(libraries, rows), rows)) > 0


def test_whole_table_against_plain_loops(spark, libraries, small_docs):
    rows = small_docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in A.align(small_docs).select(COLUMNS).collect()}
    want = plain(libraries, [r.text for r in rows])
    assert got == {r.doc_id: w for r, w in zip(rows, want)}


def test_odd_rows(odd, empty, libraries):
    rows = odd.select("doc_id", "text").collect()
    want = plain(libraries, [r.text for r in rows])
    got = [tuple(r) for r in A.align(odd).select(COLUMNS).collect()]
    assert sorted(map(str, got)) == sorted(str((r.doc_id, *w)) for r, w in zip(rows, want))
    assert A.align(empty).count() == 0


def test_slices_do_not_change_the_result(spark, libraries, monkeypatch):
    monkeypatch.setattr(A, "SLICE_TOKENS", 8)
    tool = A.tokenizers_of(A.tokenizer_path(A.BYTE_FILE), A.tokenizer_path(A.PIECE_FILE))
    for text in odd_texts(4, 60):
        x, y = tool.encode([text])[0]
        if not x:
            continue
        ids_a, ids_b = np.frombuffer(x, tool.a.kind), np.frombuffer(y, tool.b.kind)
        parts = list(A.aligned(ids_a, ids_b, tool))
        assert np.concatenate([p[0] for p in parts]).tolist() == ids_a.tolist()
        assert np.concatenate([p[1] for p in parts]).tolist() == ids_b.tolist()
        raw = b"".join(A.group_text(a, b, A.terminals(ea, eb), tool)[0].tobytes() for a, b, ea, eb in parts)
        groups = plain(libraries, [text])[0]
        assert hashlib.sha256(raw[:-1]).hexdigest() == groups[6]


def test_long_chain_of_pointers():
    """Tokens of two bytes against tokens shifted by one: one group, however long."""
    end_a = np.append(np.arange(2, 20_001, 2), 20_001)
    end_b = np.append(np.arange(1, 20_001, 2), 20_001)
    end_b = np.unique(end_b)
    last = A.terminals(end_a, end_b)
    assert len(np.unique(last)) == 1


def test_units_tile_the_text():
    tool = A.tokenizers_of(A.tokenizer_path(A.BYTE_FILE), A.tokenizer_path(A.PIECE_FILE))
    for text in odd_texts(9, 200):
        assert "".join(" " + u for u in tool.units(text)) == " " + text


def test_overlap_table(spark, libraries):
    texts = ["one two", "one two", "two three"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.a_id, r.b_id): r.n_documents for r in A.overlap_table(df).collect()}
    assert max(got.values()) == 3 and sum(got.values()) >= 6


def test_cache_limit_does_not_change_ids(libraries, monkeypatch):
    monkeypatch.setattr(A, "CACHE_UNITS", 5)
    monkeypatch.setattr(A, "CACHE_UNIT_CHARS", 6)
    tool = A.Tokenizers(A.tokenizer_path(A.BYTE_FILE), A.tokenizer_path(A.PIECE_FILE))
    for _ in range(2):
        texts = odd_texts(12, 120)
        for at in range(0, len(texts), 7):
            for text, (x, y) in zip(texts[at:at + 7], tool.encode(texts[at:at + 7])):
                if x:
                    a, b = token_bytes(libraries, text)
                    assert np.frombuffer(x, tool.a.kind).tolist() == [i for i, _ in a]
                    assert np.frombuffer(y, tool.b.kind).tolist() == [i for i, _ in b]
