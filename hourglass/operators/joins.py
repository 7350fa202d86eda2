"""Equi-joins between facts and context (K1-K4).

The context side (one row per hour or day) is small next to the facts, but it is
only broadcast after a size check (``fits_broadcast``): one aggregate that counts
its rows and measures their bytes (partial per task, nothing gathered). When the
check fails the join falls back to a shuffle join, where adaptive execution
splits skewed keys; ``salt`` adds explicit salting on that path for clusters that
run without adaptive skew handling.

``context_left_facts`` (context LEFT JOIN facts) is rewritten as
``inner join  UNION ALL  context rows whose key never occurs in the facts``. The
inner join can stream the facts past a broadcast context (a plain left join could
only broadcast the facts side), and the anti part only needs the distinct fact
keys, which are de-duplicated map-side before any shuffle. The facts are never
shuffled, and a hot hour holding a third of all facts costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.session import materialize
from hourglass.sources.io import save_bucketed

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                   max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and at most ``max_bytes`` bytes.

    Runs one aggregate job over ``df`` (a count and the exact byte length of its
    string and binary columns; fixed-width columns at their width). A ``limit``
    probe is avoided on purpose: it gathers up to ``max_rows`` rows *per partition*
    into a single task.
    """
    fixed = 0
    var_cols = []
    for field in df.schema.fields:
        width = next((w for t, w in _FIXED_WIDTH.items() if isinstance(field.dataType, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            var_cols.append(field.name)
        else:
            fixed += 64
    row_width = fixed + 8 * (len(df.columns) + 1)
    cap = max_rows if max_rows is not None else max(1, max_bytes // row_width)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)).alias(f"b{i}")
             for i, c in enumerate(var_cols)]
    row = df.agg(*aggs).first()
    n = row["n"]
    size = n * row_width + sum(row[f"b{i}"] for i in range(len(var_cols)))
    return n <= cap and size <= max_bytes


def resolve_broadcast(df: DataFrame, broadcast="auto",
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """'auto' runs the size check; True/False are taken as given (True only where
    the caller knows a bound, e.g. a table it has just checked)."""
    if broadcast == "auto":
        return fits_broadcast(df, max_bytes)
    return bool(broadcast)


def _salted_join(facts: DataFrame, ctx: DataFrame, fact_key: str, ctx_key: str, how: str,
                 salt: int) -> DataFrame:
    """Equi-join with the hot-key load spread over ``salt`` tasks.

    Every fact gets a salt in [0, salt) from a hash of its row (map columns aside;
    deterministic, so a recomputed task picks the same salt, which a random salt would
    not guarantee), and every context row is repeated once per salt value. Joining on
    (key, salt) sends one key's facts to ``salt`` different tasks while each fact still
    meets every context row of its key exactly once. The context grows by ``salt``
    times, the facts do not.
    """
    hashable = [F.col(fl.name) for fl in facts.schema.fields if not isinstance(fl.dataType, T.MapType)]
    basis = F.xxhash64(*hashable) if hashable else F.monotonically_increasing_id()
    f = facts.withColumn("__f_salt", F.pmod(basis, F.lit(salt)))
    c = ctx.withColumn("__c_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))
    cond = (f[fact_key] == c[ctx_key]) & (f["__f_salt"] == c["__c_salt"])
    return f.join(c, cond, how).drop("__f_salt", "__c_salt")


def context_left_facts(ctx: DataFrame, facts: DataFrame, ctx_key: str, fact_key: str,
                       broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                       salt: int = 0, stage: bool = True) -> DataFrame:
    """K1: every context row with each of its facts, or once with nulls when it has none.

    Same rows as ``ctx.join(facts, ctx_key == fact_key, 'left')``; duplicate keys on
    either side multiply rows, as in the plain join.
    ``broadcast``: 'auto' (checked), True (caller guarantees a bound) or False.
    ``salt`` > 1 salts the shuffle join used when the context is not broadcast.
    ``stage`` (default): the context is written once, and the size check and all three
    uses of it read that stage instead of building it again. Column names must not occur
    on both sides; rename them first.
    """
    shared = sorted(set(ctx.columns) & set(facts.columns))
    if shared:
        raise ValueError(f"columns on both sides of the join: {', '.join(shared)}; rename one side")
    if stage:
        ctx = materialize(ctx, "context")
    small = resolve_broadcast(ctx, broadcast, max_broadcast_bytes)
    c = F.broadcast(ctx) if small else ctx
    if not small and salt > 1:
        inner = _salted_join(facts, ctx, fact_key, ctx_key, "inner", salt)
        matched = inner.select(*ctx.columns, *facts.columns)
    else:
        matched = c.join(facts, c[ctx_key] == facts[fact_key], "inner")
    hit = facts.select(F.col(fact_key).alias("__hit_key"))
    if small:
        # Keys that can match are bounded by the (checked) context size.
        ctx_keys = F.broadcast(ctx.select(F.col(ctx_key).alias("__hit_key")).distinct())
        hit = hit.join(ctx_keys, "__hit_key", "left_semi")
    hit = hit.distinct()
    hit = F.broadcast(hit) if small else hit
    unmatched = ctx.join(hit, ctx[ctx_key] == hit["__hit_key"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def facts_left_context(facts: DataFrame, ctx: DataFrame, fact_key: str, ctx_key: str,
                       drop_null: list[str] | None = None, broadcast="auto",
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, salt: int = 0) -> DataFrame:
    """K2: facts LEFT JOIN context, then optionally drop rows with nulls in ``drop_null``.

    With ``drop_null`` on a context column Catalyst turns the outer join into an
    inner join and pushes the not-null filter into the context side. ``salt`` > 1
    salts the shuffle join used when the context is not broadcast.
    """
    small = resolve_broadcast(ctx, broadcast, max_broadcast_bytes)
    if not small and salt > 1:
        out = _salted_join(facts, ctx, fact_key, ctx_key, "left", salt)
        return out.na.drop(subset=list(drop_null)) if drop_null else out
    c = F.broadcast(ctx) if small else ctx
    out = facts.join(c, facts[fact_key] == c[ctx_key], "left")
    return out.na.drop(subset=list(drop_null)) if drop_null else out


def facts_inner_context(facts: DataFrame, ctx: DataFrame, fact_key: str, ctx_key: str,
                        broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                        salt: int = 0) -> DataFrame:
    """K3: inner equi-join (``salt`` > 1 salts the shuffle join when not broadcast)."""
    small = resolve_broadcast(ctx, broadcast, max_broadcast_bytes)
    if not small and salt > 1:
        return _salted_join(facts, ctx, fact_key, ctx_key, "inner", salt)
    c = F.broadcast(ctx) if small else ctx
    return facts.join(c, facts[fact_key] == c[ctx_key], "inner")


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """K4: rows of ``left`` whose key does not occur in ``right`` (null keys are kept).

    When ``left`` (e.g. the context) passes the size check, only the right keys that
    can match are collected: semi-joined to the broadcast left keys and de-duplicated
    map-side, so they are bounded by the checked left side and can be broadcast. The
    right side (e.g. the facts) is then read once, key column only, and never
    shuffled. Otherwise the distinct right keys are checked and broadcast if small,
    or the anti join is a shuffle join.
    """
    keys = right.select(F.col(right_key).alias("__anti_key"))
    if resolve_broadcast(left, broadcast, max_broadcast_bytes):
        left_keys = F.broadcast(left.select(F.col(left_key).alias("__anti_key")).distinct())
        keys = F.broadcast(keys.join(left_keys, "__anti_key", "left_semi").distinct())
    else:
        keys = materialize(keys.distinct(), "anti-keys")  # read by the size check and by the join
        keys = F.broadcast(keys) if resolve_broadcast(keys, broadcast, max_broadcast_bytes) else keys
    return left.join(keys, left[left_key] == keys["__anti_key"], "left_anti")


def bucketed_pair(facts: DataFrame, ctx: DataFrame, fact_key: str, ctx_key: str, buckets: int,
                  salt: int = 1) -> tuple[DataFrame, DataFrame]:
    """K3 prepared once (S4): both sides bucketed and sorted on the time key, for ``join_buckets``.

    ``salt`` > 1 spreads the facts of one key over as many buckets; the context is repeated as often.
    """
    hashable = [F.col(f"`{f.name}`") for f in facts.schema.fields if not isinstance(f.dataType, T.MapType)]
    f = facts.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salt)).cast("int"))
    c = ctx.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return save_bucketed(f, [fact_key, "_salt"], buckets, "facts"), save_bucketed(c, [ctx_key, "_salt"], buckets, "context")


def join_buckets(facts: DataFrame, ctx: DataFrame, fact_key: str, ctx_key: str) -> DataFrame:
    """K3 on a ``bucketed_pair``: a merge join of sorted buckets, no shuffle on either side."""
    c = ctx.withColumnRenamed("_salt", "_ctx_salt").hint("merge")
    return facts.join(c, (facts[fact_key] == c[ctx_key]) & (facts["_salt"] == c["_ctx_salt"])).drop("_salt", "_ctx_salt")


def lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str | None = None,
           default=None, broadcast="auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, salt: int = 0) -> DataFrame:
    """X10 for mappings too large for a literal map: left join against a lookup table
    (broadcast after the size check), ``default`` for keys it lacks. The table must
    hold one row per key, or rows of ``df`` are repeated.

    Beyond the check the join is shuffled: rows without a key stay out of it (they would
    all meet in one task), and ``salt`` > 1 spreads the rows of a hot key.
    """
    t = table.select(F.col(key).alias("__lk_key"), F.col(value).alias("__lk_value"))
    small = resolve_broadcast(t, broadcast, max_broadcast_bytes)
    if small:
        t = F.broadcast(t)
        joined = df.join(t, df[col] == t["__lk_key"], "left")
    else:
        known = df.filter(F.col(col).isNotNull())
        joined = (_salted_join(known, t, col, "__lk_key", "left", salt) if salt > 1
                  else known.join(t, known[col] == t["__lk_key"], "left"))
        joined = joined.unionByName(df.filter(F.col(col).isNull()), allowMissingColumns=True)
    res = F.col("__lk_value") if default is None else F.coalesce(F.col("__lk_value"), F.lit(default))
    return joined.withColumn(out or f"{col}_code", res).drop("__lk_key", "__lk_value")
