from collections import Counter

from hourglass.llm import ngram_join as J
from test_ngram_join import near_copies, shingles


def brute(rows, size=5, percent=75):
    sets = [shingles(t, size) for _, t in rows]

    def links(i):
        return sum(1 for j, b in enumerate(sets) if j != i and sets[i] and 100 * len(sets[i] & b) >= percent * len(sets[i] | b))
    return Counter((d, len(sets[i]), links(i)) for i, (d, _) in enumerate(rows))


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in J.link_counts(df, **options).collect()) == brute(rows, *options.values())


def test_every_link_of_a_large_group(spark, monkeypatch):
    rows = near_copies(100, 3, edits=2)
    rows += [(1000 + i, t) for i, t in rows[:7]] + near_copies(40, 4) + [(None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, _, few = J.linked(df)
    monkeypatch.setattr(J, "PARTNERS", 16)  # many parts
    _, links = J.all_links(df)
    assert links.count() == links.distinct().count() > few.count()
    check(df)


def test_small_table_and_odd_rows(small_docs, odd):
    check(small_docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")))
