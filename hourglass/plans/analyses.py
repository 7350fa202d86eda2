"""End-to-end analyses (Q1-Q7), composed of the library operators. Building one can start jobs:
size checks before a broadcast, written stages, model fits.

Column roles follow the look-alike views: facts have ``fact_id``, ``crash_ts``,
a time key (``fact_hour`` / ``fact_day``), ``zip_code``, ``factor``, ``injured``,
``killed``; context has a time key (``hour_begin`` / ``day_begin``),
``pedestrians``, ``weather_summary``, ``temperature``, ``precipitation`` and
``event_name``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import scalars as X
from hourglass.operators import aggregate as A
from hourglass.operators import filters as FL
from hourglass.operators import joins as K
from hourglass.operators import model as M
from hourglass.operators import sample as B
from hourglass.operators import scale as S
from hourglass.plans.lookalike import hour_key
from hourglass.session import materialize

# Parameters of the source project's runs.
FINAL_SAMPLE = dict(fraction=0.0166, seed=1823)   # keep no-crash hours, sample crash hours
AREA_SAMPLE = dict(fraction=0.23, seed=123)       # zip-narrowed: keep crash hours, sample the rest
FINAL_SPLIT_SEED = 1823
AREA_SPLIT_SEED = 5043
FINAL_FEATURES = ("temperature_norm", "precipitation_norm", "weather_norm", "day_norm",
                  "hour_norm", "pedestrians_norm")
AREA_FEATURES = ("pedestrians", "temperature", "precipitation", "has_event", "hour_group", "weather")


# --- Q1 / Q2: preparation ----------------------------------------------------

def prepare_facts(raw: DataFrame, borough: str, lo, hi, zip_code: str | None = None) -> DataFrame:
    """Q1: F1 -> X1 -> X2/X3 -> F2 -> J2 -> J3 -> X5 -> J0 -> X12 on raw crash strings."""
    df = FL.filter_eq(raw, "borough", borough)
    if zip_code is not None:
        df = FL.filter_eq(df, "zip_code", zip_code)
    df = df.withColumns({
        "crash_ts": X.parse_crash_ts(X.concat_date_time("crash_date", "crash_time")),
        "crash_day": X.parse_crash_date("crash_date"),
    })
    df = FL.filter_date_open(df, "crash_day", lo, hi)
    counts = ["ped_injured", "ped_killed", "cyc_injured", "cyc_killed", "mot_injured", "mot_killed"]
    df = FL.cast_cols(df, {c: "int" for c in counts})
    return df.select(
        F.col("row_id").alias("fact_id"),
        "crash_ts",
        X.trunc_time("crash_ts").alias("fact_hour"),
        "zip_code",
        X.row_sum(["ped_injured", "cyc_injured", "mot_injured"]).alias("injured"),
        X.row_sum(["ped_killed", "cyc_killed", "mot_killed"]).alias("killed"),
        X.sentinel_to_label("factor_1").alias("factor"),
    )


def prepare_context(raw: DataFrame) -> DataFrame:
    """Q2: X4 -> J1 -> F5 -> J2 -> X13 on raw context strings."""
    df = raw.withColumn("hour_begin", X.parse_context_ts("hour_beginning"))
    df = FL.drop_cols(df, ["hour_beginning", "location", "lat", "long", "location1",
                           "towards_manhattan", "towards_brooklyn", "ctx_key"])
    df = FL.drop_null_rows(df, ["weather_summary"])
    df = FL.cast_cols(df, {"pedestrians": "int", "temperature": "double", "precipitation": "double"})
    return df.select("hour_begin", "pedestrians", "weather_summary", "temperature", "precipitation",
                     F.col("events").alias("event_name"), X.null_flag("events").alias("has_event"))


# --- Q5 / Q6: grouped shares and sums ----------------------------------------

@dataclass(frozen=True)
class Keys:
    fact: str = "fact_hour"
    ctx: str = "hour_begin"


HOURLY = Keys()
DAILY = Keys("fact_day", "day_begin")


def _weathered_ctx(ctx: DataFrame, keys: Keys) -> DataFrame:
    return FL.drop_null_rows(ctx, ["weather_summary"]).select(keys.ctx, "weather_summary")


def crashes_with_weather(facts: DataFrame, ctx: DataFrame, keys: Keys = HOURLY,
                         broadcast="auto") -> DataFrame:
    """K2 + F5: facts with the weather of their time key, rows without weather dropped.

    Only the context's time key and weather take part, so other columns may share names."""
    facts = facts.withColumn("factor", X.sentinel_to_label("factor"))
    return K.facts_inner_context(facts, _weathered_ctx(ctx, keys), keys.fact, keys.ctx, broadcast=broadcast)


def factor_share(facts: DataFrame, ctx: DataFrame, keys: Keys = HOURLY, broadcast="auto") -> DataFrame:
    """Q5: K2 -> A1 in one query (instead of one job per weather/factor pair).

    Both paths read the same columns. Broadcast context (checked on its two columns): facts
    stream through a map-side join and are pre-summed per (weather, factor) in every task.
    Otherwise the facts are first reduced to one row per (time key, factor) with its row
    count, and only those rows take part in the shuffle join.
    """
    facts = facts.select(keys.fact, "factor")
    if K.resolve_broadcast(_weathered_ctx(ctx, keys), broadcast):
        return A.factor_share_by_weather(crashes_with_weather(facts, ctx, keys, True))
    pre = facts.groupBy(F.col(keys.fact), X.sentinel_to_label("factor").alias("factor")).agg(
        F.count(F.lit(1)).alias("_n"))
    joined = K.facts_inner_context(pre, _weathered_ctx(ctx, keys), keys.fact, keys.ctx, broadcast=False)
    return A.factor_share_by_weather(joined, weight="_n")


def factor_casualties(facts: DataFrame, ctx: DataFrame, keys: Keys = HOURLY,
                      broadcast="auto") -> DataFrame:
    """Q6: K2 -> J3 -> A2 in one query; the same columns on both paths, pre-aggregated before a
    shuffle join like Q5."""
    facts = facts.select(keys.fact, "factor", "injured", "killed")
    if K.resolve_broadcast(_weathered_ctx(ctx, keys), broadcast):
        joined = FL.row_sum(crashes_with_weather(facts, ctx, keys, True), ["injured", "killed"], "casualties")
        return A.casualties_by_weather_factor(joined, casualties="casualties")
    rowwise = FL.row_sum(facts, ["injured", "killed"], "casualties")
    pre = A.grouped_sums(rowwise.withColumn("factor", X.sentinel_to_label("factor")),
                         [keys.fact, "factor"], ["injured", "killed", "casualties"])
    joined = K.facts_inner_context(pre, _weathered_ctx(ctx, keys), keys.fact, keys.ctx, broadcast=False)
    return A.casualties_by_weather_factor(joined, casualties="casualties")


# --- Q3: training table ------------------------------------------------------

def hours_with_crashes(ctx: DataFrame, facts: DataFrame, keys: Keys = HOURLY,
                       broadcast="auto", salt: int = 0) -> DataFrame:
    """K1 plus the derived columns every model uses (one row per hour x crash)."""
    j = K.context_left_facts(ctx, facts, keys.ctx, keys.fact, broadcast=broadcast, salt=salt)
    t = F.col(keys.ctx)
    return j.withColumns({
        "weather": X.encode_weather("weather_summary"),
        "casualties": X.row_sum(["injured", "killed"]),
        "hour": X.hour_of(t),
        "hour_group": X.hour_group(t),
        "day": X.day_monday_first(t),
        "has_event": X.null_flag("event_name"),
        # rows without crash: the hour; hours whose text did not parse: a measured value
        "sample_key": F.coalesce(F.col("fact_id"), -hour_key(t), -F.col("pedestrians").cast("bigint"), F.lit(0)),
    }).withColumn("has_accident", X.label_any_match("casualties"))


def training_sample(ctx: DataFrame, facts: DataFrame, fraction: float = FINAL_SAMPLE["fraction"],
                    seed: int = FINAL_SAMPLE["seed"], keys: Keys = HOURLY, broadcast="auto",
                    sampling: str = "md5", stage: bool = True) -> DataFrame:
    """F5 -> K1 -> X11 -> J3 -> X15 -> X7 -> X9 -> B3: the balanced rows before scaling.

    Context rows without weather leave first, as in preparation. With ``stage`` (default) the
    sample, which is small next to the facts, is written once under the checkpoint root.
    """
    j = hours_with_crashes(FL.drop_null_rows(ctx, ["weather_summary"]), facts, keys, broadcast)
    sample = B.balance_classes(j, "has_accident", keep=0, fraction=fraction, seed=seed,
                               key="sample_key", method=sampling)
    sample = sample.select("sample_key", "temperature", "precipitation", "pedestrians", "weather",
                           "day", "hour_group", "has_accident")
    return materialize(sample, "training-sample") if stage else sample


def training_table(ctx: DataFrame, facts: DataFrame, **options) -> DataFrame:
    """Q3: training_sample -> X17/X18 -> J0.

    The ranges for scaling are measured on the balanced sample, and so is the scaling
    itself: two passes over the staged sample, one over the facts and the join behind it.
    """
    scaled = S.min_max_scale(training_sample(ctx, facts, **options), ["temperature", "precipitation", "pedestrians"])
    return scaled.select(
        "sample_key",
        "temperature_norm",
        "precipitation_norm",
        S.fixed_range_scale("weather", 0, 9).alias("weather_norm"),
        S.fixed_range_scale("day", 1, 7).alias("day_norm"),
        S.fixed_range_scale("hour_group", 0, 5).alias("hour_norm"),
        "pedestrians_norm",
        "has_accident",
    )


def norm_params_of(sample: DataFrame) -> DataFrame:
    """The six ranges used to scale a training sample."""
    return S.norm_params(
        sample,
        measured=[("temperature", "temperature"), ("precipitation", "precipitation"),
                  ("pedestrians", "pedestrians")],
        fixed=[("weather", 0, 9), ("day", 1, 7), ("hour", 0, 5)],
        order=["temperature", "precipitation", "weather", "day", "hour", "pedestrians"])


def training_norm_params(ctx: DataFrame, facts: DataFrame, **options) -> DataFrame:
    """X20 for Q3, from the same staged sample."""
    return norm_params_of(training_sample(ctx, facts, **options))


def scale_with(rows: DataFrame, params: DataFrame) -> DataFrame:
    """New rows (columns as in ``training_sample``) scaled with stored ranges (X20) instead of their own:
    what a saved model needs to score them. ``params`` has one row per variable; it is read back
    as a bounded lookup."""
    ranges = {r["variable"]: (r["min"], r["max"]) for r in params.limit(100).collect()}
    column = {"hour": "hour_group"}

    def scaled(name: str):
        lo, hi = ranges[name]
        out = F.lit(None).cast("double") if hi == lo else (
            (F.col(column.get(name, name)).cast("double") - F.lit(float(lo))) / F.lit(float(hi) - float(lo)))
        return out.alias(f"{name}_norm")
    return rows.select("sample_key", *[scaled(n) for n in ("temperature", "precipitation", "weather", "day", "hour",
                                                           "pedestrians")], "has_accident")


# --- Q4 / Q7: models ---------------------------------------------------------

def _raw_auc(pred: DataFrame) -> float | None:
    scored = pred.select("label", vector_to_array("rawPrediction")[1].alias("score"))
    return M.auc_ranks(scored, "score").first()["auc"]


def _metrics_rows(name: str, model, train: DataFrame, test: DataFrame, names,
                  with_coefficients: bool = False) -> list[tuple]:
    """Hard AUC and accuracy come from one aggregate per scored set, the raw AUC from exact ranks. A metric
    is null where it is undefined: no rows, or an AUC without both classes."""
    pred_test = M.score(model, test)
    on_test, on_train = M.hard_metrics(pred_test), M.hard_metrics(M.score(model, train))
    rows = [(name, "auc_hard_test", on_test["auc_hard"]),
            (name, "auc_hard_train", on_train["auc_hard"]),
            (name, "auc_raw_test", _raw_auc(pred_test)),
            (name, "accuracy_test", on_test["accuracy"])]
    if with_coefficients:
        rows += [(name, f"coef_{t}", v) for t, v in M.coefficients(model, names)]
    return rows


def model_input(table: DataFrame, features, name: str) -> DataFrame:
    """M1 -> M2 on ``table``, written once before iterative fitting. A null feature is an error."""
    data = M.index_label(M.assemble(table, list(features)), "has_accident")
    return materialize(data.select("sample_key", "features", "label"), name)


def split(data: DataFrame, seed: int) -> list[DataFrame]:
    """B4 on the row key, 70/30; independent of how the rows are stored."""
    return B.train_test_split(data, (0.7, 0.3), seed, key="sample_key", method="md5")


def train_crash_model(training: DataFrame, features=FINAL_FEATURES, seed: int = FINAL_SPLIT_SEED,
                      max_iter: int = 150, model_path: str | None = None, params: DataFrame | None = None):
    """Q4: M1 -> M2 -> B4 -> M3 -> M9 -> M11 (-> S7). Returns (model, metric rows).

    With ``params`` (X20) the scaling ranges are written next to the model, for ``scale_with``."""
    data = model_input(training, features, "crash-model-input")
    train, test = split(data, seed)
    model = M.fit_logistic(train, max_iter=max_iter)
    rows = [("logistic", "n_train", float(train.count())), ("logistic", "n_test", float(test.count()))]
    rows += _metrics_rows("logistic", model, train, test, list(features), with_coefficients=True)
    if model_path:
        from hourglass.sources.io import save_model
        save_model(model, model_path)
        if params is not None:
            params.write.mode("overwrite").parquet(f"{model_path}-ranges")
    return model, rows


def area_dataset(ctx: DataFrame, facts: DataFrame, zip_code: str, keys: Keys = HOURLY,
                 fraction: float = AREA_SAMPLE["fraction"], seed: int = AREA_SAMPLE["seed"],
                 broadcast="auto") -> DataFrame:
    """Q7 data: F5, zip-narrowed facts -> K1 -> X15 -> B3 (keep crash hours, sample the rest)."""
    narrowed = FL.filter_eq(facts, "zip_code", zip_code)
    j = hours_with_crashes(FL.drop_null_rows(ctx, ["weather_summary"]), narrowed, keys, broadcast)
    return B.balance_classes(j, "has_accident", keep=1, fraction=fraction, seed=seed, key="sample_key")


def area_model(ctx: DataFrame, facts: DataFrame, zip_code: str, features=AREA_FEATURES,
               seed: int = AREA_SPLIT_SEED, max_iter: int = 150, keys: Keys = HOURLY):
    """Q7: logistic (binomial and multinomial) and naive Bayes on the narrowed sample."""
    data = area_dataset(ctx, facts, zip_code, keys)
    data = model_input(data, features, "area-model-input")
    train, test = split(data, seed)
    rows = [("area", "n_train", float(train.count())), ("area", "n_test", float(test.count()))]
    rows += _metrics_rows("logistic", M.fit_logistic(train, max_iter=max_iter), train, test, list(features),
                          with_coefficients=True)
    rows += _metrics_rows("multinomial", M.fit_multinomial(train, max_iter=max_iter), train, test,
                          list(features))
    rows += _metrics_rows("naive_bayes", M.fit_naive_bayes(train), train, test, list(features))
    return rows
