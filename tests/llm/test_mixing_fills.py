from collections import defaultdict

from hourglass.llm import mixing as M
from hourglass.session import materialize


def test_a_long_document_does_not_end_the_mix(spark):
    rows = [(i, "w " * (300 + i), "a") for i in range(50)] + [(50, "w " * 20_000, "a")]
    rows += [(100 + i, "w " * (1 + 7 * i), "b") for i in range(60)] + [(200, "w " * 9_000, "b"), (201, "w " * 9_000, "b")]
    rows += [(300 + i, "w " * 40, "c") for i in range(30)] + [(None, "w " * 50, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # equal weights, so the rests of a and b meet their long documents; no unused text may fit what is left
    for seed in (9, 1):
        taken, target, unused = defaultdict(int), {}, defaultdict(list)
        of = {i: s for i, _, s in rows}
        for r in M.mix_counts(df, weights=(1.0,), total_share=0.5, seed=seed).collect():
            s = of[r.doc_id]
            taken[s] += r.taken
            target[s] = r.target
            if not r.taken:
                unused[s].append(r.size if r.doc_id is not None else 5 * r.size)
        for s, t in target.items():
            left = t - taken[s]
            assert left >= -1e-6
            assert not unused[s] or left < min(unused[s]), (s, left, sorted(unused[s])[:3])


def test_two_writes_a_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(M, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    sizes = (150, 150, 150, 30, 20, 9, 5, 3)  # first 150 + 150, then 9 + 5 + 3
    units = spark.createDataFrame([("a", n, n, n, w) for n, w in enumerate(sizes)], "s string, nth int, h1 long, h2 long, words long")
    got = M.fill(units, spark.createDataFrame([("a", 333)], "s string, left long"))
    assert sorted(r.words for r in got.join(units, ["s", "h1", "h2"]).collect()) == [3, 5, 9, 150, 150]
    rounds = written.count("mix-walk") - 1  # the last one finds nothing to take
    assert rounds == 2 and len(written) == 2 * rounds + 4
