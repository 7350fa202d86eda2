"""Property tests against brute-force Python versions of the same rules (small fixtures)."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourglass.operators import clean as C
from hourglass.operators import joins as K

CELLS = st.sampled_from(["", "A", "x y", '"(40.1, -73.9)"', '"MAIN ST, APT 2"', "(1,2)", '"a,b"', "0", "-1"])
LINE = st.lists(CELLS, min_size=26, max_size=31).map(",".join)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_clean(key: int, line: str) -> str:
    """The cleaning rules spelled out in plain Python."""
    if line.count(",") > 28:
        if re.search(r"\(.*\)", line):
            line = re.sub(r"\(.*\)", "", line)
        else:
            line = re.sub(r'"(.*),(.*)"', r"\1\2", line)
    cells = line.split(",")
    if len(cells) != 29:
        kept = ["-1"] * 26
    else:
        kept = [c if c != "" else "-1" for i, c in enumerate(cells) if i not in (6, 10, 11)]
    return ",".join([str(key), *kept])


@SETTINGS
@given(st.lists(LINE, min_size=1, max_size=40))
def test_cleaner_matches_brute_force(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "k long, value string")
    got = {r.row_key: r.value for r in C.clean_crash_lines(df, key_col="k", keep_flag=True).collect()}
    assert got == {k: brute_clean(k, v) for k, v in enumerate(lines)}


KEYS = st.one_of(st.none(), st.integers(0, 5))
H0 = dt.datetime(2024, 1, 1)


def _ts(k):
    return None if k is None else H0 + dt.timedelta(hours=k)


@SETTINGS
@given(st.lists(KEYS, min_size=0, max_size=8), st.lists(KEYS, min_size=0, max_size=12), st.booleans())
def test_context_left_facts_matches_brute_force(spark, ctx_keys, fact_keys, broadcast):
    ctx = spark.createDataFrame([(_ts(k), i) for i, k in enumerate(ctx_keys)],
                                "hour_begin timestamp_ntz, ctx_id int")
    facts = spark.createDataFrame([(_ts(k), 100 + i) for i, k in enumerate(fact_keys)],
                                  "fact_hour timestamp_ntz, fact_id int")
    got = [(r.ctx_id, r.fact_id) for r in
           K.context_left_facts(ctx, facts, "hour_begin", "fact_hour", broadcast=broadcast)
           .select("ctx_id", "fact_id").collect()]
    want = []
    for i, ck in enumerate(ctx_keys):
        hits = [100 + j for j, fk in enumerate(fact_keys) if ck is not None and fk == ck]
        want += [(i, h) for h in hits] or [(i, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


WEATHER = st.sampled_from(["rain", "fog", None])
FACTOR = st.sampled_from(["A", "B", "-1", None])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), WEATHER), min_size=1, max_size=8),
       st.lists(st.tuples(KEYS, FACTOR), min_size=1, max_size=20), st.booleans())
def test_factor_share_matches_brute_force(spark, ctx_rows, fact_rows, broadcast):
    from hourglass.plans import analyses as Q
    ctx = spark.createDataFrame([(_ts(k), w) for k, w in ctx_rows], "hour_begin timestamp_ntz, weather_summary string")
    facts = spark.createDataFrame([(i, _ts(k), f, 1, 0) for i, (k, f) in enumerate(fact_rows)],
                                  "fact_id long, fact_hour timestamp_ntz, factor string, injured int, killed int")
    got = {(r.weather, r.factor): (r.weather_count, r.weather_factor_count)
           for r in Q.factor_share(facts, ctx, broadcast=broadcast).collect()}
    # brute force: every (fact, context row) pair with the same hour and a weather
    pairs = [(w, "Unspecified" if f == "-1" else f)
             for k, f in fact_rows for ck, w in ctx_rows if k is not None and k == ck and w is not None]
    want = {}
    for w, f in pairs:
        total = sum(1 for w2, _ in pairs if w2 == w)
        want[(w, f)] = (total, sum(1 for w2, f2 in pairs if w2 == w and f2 == f and f is not None))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=60, unique=True),
       st.floats(0.0, 1.0), st.integers(0, 10**6))
def test_hash_sample_matches_brute_force(spark, keys, fraction, seed):
    import hashlib

    from hourglass.operators import sample as B
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = sorted(r.k for r in B.hash_sample(df, "k", fraction, seed).collect())
    limit = int(fraction * 2**32)
    want = sorted(k for k in keys if int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16) < limit)
    assert got == want


@SETTINGS
@given(st.lists(KEYS, min_size=0, max_size=8), st.lists(KEYS, min_size=0, max_size=12),
       st.sampled_from(["auto", False]), st.sampled_from([0, 3]))
def test_joins_match_brute_force_on_every_path(spark, ctx_keys, fact_keys, broadcast, salt):
    ctx = spark.createDataFrame([(_ts(k), i) for i, k in enumerate(ctx_keys)],
                                "hour_begin timestamp_ntz, ctx_id int")
    facts = spark.createDataFrame([(_ts(k), 100 + i) for i, k in enumerate(fact_keys)],
                                  "fact_hour timestamp_ntz, fact_id int")
    k1 = [(r.ctx_id, r.fact_id) for r in K.context_left_facts(
        ctx, facts, "hour_begin", "fact_hour", broadcast=broadcast, salt=salt).select("ctx_id", "fact_id").collect()]
    want = []
    for i, ck in enumerate(ctx_keys):
        hits = [100 + j for j, fk in enumerate(fact_keys) if ck is not None and fk == ck]
        want += [(i, h) for h in hits] or [(i, None)]
    assert sorted(k1, key=repr) == sorted(want, key=repr)
    k4 = sorted(r.ctx_id for r in K.anti_join(ctx, facts, "hour_begin", "fact_hour", broadcast=broadcast).collect())
    assert k4 == sorted(i for i, ck in enumerate(ctx_keys) if ck is None or ck not in fact_keys)
