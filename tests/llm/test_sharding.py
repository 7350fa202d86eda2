import math

from pyspark.sql import functions as F

from hourglass.llm import sharding as S


def test_every_shard_fits_and_only_large_buckets_split(docs):
    limit = 40_000
    out = S.shard(docs, limit).cache()
    assert out.count() == docs.count()
    assert out.agg(F.sum("n_bytes")).first()[0] == docs.agg(F.sum(F.octet_length("text"))).first()[0]
    sizes = out.groupBy("shard", "chain").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.b <= limit or r.n == 1 for r in sizes)
    # the parent of every bucket is too large
    rows = S.hashed(docs).collect()
    for r in out.select("shard", "depth").distinct().collect():
        assert len(r.shard) == r.depth
        if r.depth:
            up = sum(x.n_bytes for x in rows if format(x.h, "060b").startswith(r.shard[:-1]))
            assert up > limit
    # shards are prefix-free and cover the hash space
    assert math.isclose(sum(2.0 ** -r.depth for r in out.select("shard", "depth").distinct().collect()), 1.0, abs_tol=0.2)


def test_deeper_bits_are_looked_at_again(docs, monkeypatch):
    monkeypatch.setattr(S, "EXTRA_BITS", 0)
    monkeypatch.setattr(S.math, "log2", lambda x: 0)
    rows = S.materialize(S.hashed(docs), "t")
    levels = S.directory(rows, 10_000)
    assert len(levels) > 1
    monkeypatch.undo()
    a = S.assign(rows, levels, 10_000).select("doc_id", "shard", "chain")
    b = S.shard(docs, 10_000).select("doc_id", "shard", "chain")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_repeated_rows_get_a_chain(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 25 + [(2, "y" * 5000), (3, None), (None, "")], "doc_id long, text string")
    out = S.shard(df, 1000)
    sizes = out.groupBy("shard", "chain").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.b <= 1000 or r.n == 1 for r in sizes) and sum(r.n for r in sizes) == 28


def test_odd_rows(odd, empty):
    assert S.shard(odd, 5000).count() == odd.count()
    assert S.shard(empty).count() == 0


def test_written_shards(odd, spark, tmp_path):
    S.write_shards(odd, str(tmp_path / "out"), 5000)
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()


def test_a_hot_row_is_counted_before_its_shuffle(spark):
    rows = [(7, "hot " * 50)] * 3000 + [(i, f"text {i}") for i in range(100, 300)] + [(None, "z" * 3000)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = S.shard(df, 1000)
    got = out.groupBy("doc_id", "shard", "chain").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    hot = [r for r in got if r.doc_id == 7]
    assert sum(r.n for r in hot) == 3000 and len(hot) == 600 and all(r.b <= 1000 for r in hot)
    assert sum(r.n for r in got) == len(rows)
    assert sorted(r.chain for r in got if r.doc_id is None) == [0, 1, 2]


def test_unlike_rows_of_one_hash(spark):
    """Text ids can collide: 'a' + 'b:c' and 'a:b' + 'c' hash alike, yet every shard stays within the limit."""
    rows = [("a", "b:" + "c" * 300)] * 5 + [("a:b", "c" * 300)] * 5
    out = S.shard(spark.createDataFrame(rows, "doc_id string, text string"), 1000)
    sizes = out.groupBy("shard", "chain").agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r.b <= 1000 for r in sizes) and sum(r.n for r in sizes) == 10 and len(sizes) == 4
