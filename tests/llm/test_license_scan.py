import re
from collections import Counter

from hourglass.llm import license_scan as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, templates=None, threshold=S.THRESHOLD):
    t = (text or "").translate(LOW)
    w = WORD.findall(t)
    places, base, more, best = [], set(), set(), 0.0
    for phrase, label in S.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    for label, words in (S.TEMPLATES if templates is None else templates).items():
        want = set(words.split())
        for line in t.split("\n"):
            both = len(want & set(WORD.findall(line)))
            if both >= S.needed(len(want), threshold):
                more.add(label)
                best = max(best, both / len(want))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), 1.0 if places else best)


def check(df, **options):
    rows = df.select("doc_id", "text").collect()
    assert (Counter(tuple(r) for r in S.scan(df, **options).collect())
            == Counter((r.doc_id, *brute(r.text, **options)) for r in rows))


def test_whole_table_against_brute_force(docs):
    check(docs)


def test_odd_rows(odd, empty):
    check(odd)
    assert S.scan(empty).count() == 0


def test_containment_thresholds(spark):
    texts = ["released under the mit", "Released under MIT license", "mit the under released license license",
             "under the the the", "apache license 2 0\nlicensed under the version", "a b c d e", "a b c x", "c d\na b",
             "CC BY cc-by CC\nby, general  public license", "e d c b a " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        check(df, threshold=threshold)
        check(df, templates={"t": "a b c d e", "u": "a b", "v": "e"}, threshold=threshold)


def test_native_plan(docs):
    read = S.read_once(docs, S.TEMPLATES)
    plan = S.matches(read, S.TEMPLATES)._jdf.queryExecution().toString() + S.scan(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)
