
from __future__ import annotations

import datetime
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from fleetpulse.operators import degradation, ensembles, features, fleet, keys, learning, quality, scoring, survival
from fleetpulse.plans import load, reports, training
from fleetpulse.schema import CONSTANT_SENSORS, FEATURE_COLUMNS, SNAPSHOT, SNAPSHOT_KEY
from fleetpulse.session import settle, shared_folder
from fleetpulse.sources import csv_drops, run_to_failure, snapshot_store, tables
from oracle.queries import FIXED_NODES, ORACLE, SCORER_INTERCEPT, SCORER_WEIGHTS

# The training data part may be taken out; anything else that is missing is an error.
try:
    import corpus_pipeline
    from fleetpulse.llm.oracle import ORACLE as LLM_ORACLE
    from fleetpulse.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "fleetpulse.llm"):
        raise
    LLM, LLM_ORACLE = {}, {}
else:
    LLM = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}

Query = Callable[[SparkSession, str], DataFrame]

HEALTHY_DRIVES = 3000


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to ``places`` decimals, for comparison with another engine."""
    return df.select(
        *[F.round(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def on(table: Callable[[SparkSession, str], DataFrame], operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(operator(table(spark, sf_dir)))


def daily(operator) -> Query:
    return on(tables.smart_daily, operator)


def raw(operator) -> Query:
    return on(tables.smart_raw, operator)


def snapshots(operator) -> Query:
    return on(lambda s, d: tables.smart_raw(s, d).select(*SNAPSHOT.fieldNames()), operator)


def surv(operator) -> Query:
    return on(tables.smart_surv, operator)


def lives(operator) -> Query:
    return on(lambda s, d: survival.lifetimes(tables.smart_surv(s, d)), operator)


def engine(operator) -> Query:
    return on(tables.engine, operator)


def rul(operator) -> Query:
    return on(lambda s, d: degradation.remaining_life(tables.engine(s, d)), operator)


def _fits(lives_df: DataFrame, by: list[str] = (), **bounds) -> DataFrame:
    return survival.weibull_fit(survival.lifetime_histogram(lives_df, list(by)), list(by), **bounds)


def _curve(lives_df: DataFrame, by: list[str] = ()) -> DataFrame:
    return survival.kaplan_meier(survival.lifetime_histogram(lives_df, list(by)), list(by))


def _training(df: DataFrame) -> DataFrame:
    return features.training_set(df, HEALTHY_DRIVES)


def _matrix(df: DataFrame) -> DataFrame:
    return learning.with_split(features.training_matrix(_training(df)))


def _scorer() -> scoring.Scorer:
    return scoring.logistic_scorer(SCORER_WEIGHTS, SCORER_INTERCEPT)


def _scored(df: DataFrame) -> DataFrame:
    return scoring.score_batch(features.latest_features(df), _scorer(), F.lit("2002-01-01").cast("date"))


def _predicted(df: DataFrame) -> DataFrame:
    scored = _scorer()(_matrix(df))
    return scored.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


def _score_shift(df: DataFrame) -> DataFrame:
    saved = learning.confusion(_predicted(df))
    value = survival.alert_value(F.col("tp").cast("double"), F.col("fp").cast("double"))
    return saved.select("tp", "fp", value.alias("net_saving"))


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def _as_csv_drops(spark: SparkSession, sf_dir: str, narrow_line: int | None = 7) -> str:
    """The raw readings as CSV drops, one folder per year.

    The readings of ``narrow_line`` go to drops of their own that lack two columns.
    """
    path = _scratch(spark, "drops")
    readings = tables.smart_raw(spark, sf_dir)
    text = [F.col(c).cast("string").alias(c) for c in SNAPSHOT.fieldNames()]
    everything = readings.select(F.year("date").alias("year"), "l_linenumber", *text)
    parts = {"full": everything}
    if narrow_line is not None:
        parts["full"] = everything.where(F.col("l_linenumber") != narrow_line)
        narrow = everything.where(F.col("l_linenumber") == narrow_line)
        parts["narrow"] = narrow.drop("smart_5_raw", "smart_199_raw")
    for name, part in parts.items():
        part.drop("l_linenumber").write.option("header", True).partitionBy("year").csv(os.path.join(path, name))
    return path


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_drops.accepted(csv_drops.read_drops(spark, _as_csv_drops(spark, sf_dir), per="directory"))


def _stream_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, refused, state = (_scratch(spark, n) for n in ("stream-table", "stream-refused", "stream-state"))
    raw_path = _as_csv_drops(spark, sf_dir, narrow_line=None)
    load.load_new_drops(spark, raw_path, table, refused, state, SNAPSHOT.fieldNames())
    return snapshot_store.read_snapshots(spark, table).drop("quarter")


def _mixed_drops(spark: SparkSession, sf_dir: str) -> str:
    """The raw readings as drops of two headers, beside a folder with cut lines, one with a foreign header and an empty file."""
    path = _scratch(spark, "mixed")
    readings = tables.smart_raw(spark, sf_dir)
    text = [F.col(c).cast("string").alias(c) for c in SNAPSHOT.fieldNames()]
    rest = F.col("l_orderkey") % 500
    kind = F.when(rest == 1, "torn").when(rest == 2, "foreign").when(F.col("l_linenumber") == 7, "narrow").otherwise("full")
    everything = readings.select(kind.alias("kind"), "l_linenumber", *text)
    cut = F.col("l_linenumber") == 1
    torn = [(F.when(cut, F.left(c, F.lit(5))).otherwise(F.col(c)) if c == "date" else F.when(~cut, F.col(c))).alias(c) for c in SNAPSHOT.fieldNames()]
    parts = {
        "full": lambda df: df, "narrow": lambda df: df.drop("smart_5_raw", "smart_199_raw"),
        "foreign": lambda df: df.withColumnRenamed("date", "day"), "torn": lambda df: df.select(*torn),
    }
    for name, part in parts.items():
        rows = part(everything.where(F.col("kind") == name)).drop("kind", "l_linenumber")
        rows.write.option("header", True).csv(os.path.join(path, name))
    spark.createDataFrame([], SNAPSHOT).write.csv(os.path.join(path, "empty"))
    return path


def _mixed_load(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    table, refused, state = (_scratch(spark, n) for n in ("mixed-table", "mixed-refused", "mixed-state"))
    load.load_new_drops(spark, _mixed_drops(spark, sf_dir), table, refused, state)
    return table, refused


def _mixed_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = spark.read.parquet(_mixed_load(spark, sf_dir)[1])
    return refused.groupBy(csv_drops.REASON).agg(F.sum("copies").alias("copies"))


def _stored_daily(spark: SparkSession, sf_dir: str) -> str:
    path = _scratch(spark, "stored")
    snapshot_store.BucketedStore(spark, path, tables.reading_buckets(spark, sf_dir)).write(tables.smart_daily(spark, sf_dir), "given")
    return path


def _sql_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the stored table; the date range prunes its quarters."""
    name = f"readings_{uuid.uuid4().hex}"
    snapshot_store.register_view(spark, _stored_daily(spark, sf_dir), name)
    return spark.sql(f"SELECT {', '.join(SNAPSHOT.fieldNames())} FROM {name} WHERE date BETWEEN DATE '1995-02-10' AND DATE '1995-08-20'")


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot_store.read_snapshots(spark, _stored_daily(spark, sf_dir), datetime.date(1993, 11, 5), datetime.date(1994, 1, 20))
    return rows.select("quarter", *SNAPSHOT.fieldNames())


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    for name in names:
        tables.read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return quality.catalog_columns(spark, names).drop("is_nullable")


def _with_gaps(df: DataFrame) -> DataFrame:
    """Readings without those of the 13th and of one month, so that days are missing."""
    return df.where((F.dayofmonth("date") != 13) & (F.date_format("date", "yyyy-MM") != "1994-05"))


def _renamed_models(df: DataFrame) -> DataFrame:
    """Every fifth drive gets another model from 1996 on."""
    later = (F.year("date") >= 1996) & (F.substring("serial_number", 3, 18).cast("long") % 5 == 0)
    return df.withColumn("model", F.when(later, F.concat("model", F.lit(" R2"))).otherwise(F.col("model")))


def _wrong_types(df: DataFrame) -> DataFrame:
    return df.withColumns({"smart_9_raw": F.col("smart_9_raw").cast("string"), "failure": F.col("failure").cast("double")}).drop("model")


def _load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, refused = _scratch(spark, "loaded"), _scratch(spark, "refused")
    audit = load.load_drops(spark, _as_csv_drops(spark, sf_dir), table, refused, per="directory")
    stored = snapshot_store.read_snapshots(spark, table).agg(F.count("*").alias("n")).scalar()
    out = spark.read.parquet(refused).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).scalar()
    return csv_drops.audit_totals(audit).select(
        "total_rows", stored.alias("stored_rows"), out.alias("refused_rows")
    )


def _dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings as text with unreadable numbers, fractions and missing keys among them."""
    readings = tables.smart_raw(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in SNAPSHOT.fieldNames()}
    line = F.col("l_linenumber")
    text["date"] = F.when((line == 6) & (F.col("l_suppkey") % 10 == 0), "not a day").otherwise(text["date"])
    text["serial_number"] = F.when((line == 5) & (F.col("l_suppkey") % 10 == 0), F.lit(None)).otherwise(
        text["serial_number"]
    )
    text["smart_9_raw"] = F.when(line == 1, F.concat("smart_9_raw", F.lit(".75"))).otherwise(text["smart_9_raw"])
    text["smart_188_raw"] = F.when(line == 2, "n/a").otherwise(text["smart_188_raw"])
    text["failure"] = F.when(line == 3, "").otherwise(text["failure"])
    del text["smart_242_raw"]
    return readings.select(*[c.alias(n) for n, c in text.items()])


def _quarter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "quarters")
    snapshot_store.append_snapshots(tables.smart_daily(spark, sf_dir), path)
    return snapshot_store.read_snapshots(spark, path).groupBy("quarter").agg(F.count("*").alias("records"), F.sum("failure").alias("failures"))


def _exchange_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "exchange")
    snapshot_store.write_exchange(tables.smart_daily(spark, sf_dir), path)
    return snapshot_store.read_exchange(spark, path)


def _training_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = settle(_training(tables.smart_daily(spark, sf_dir)), "training")
    return features.class_distribution(stored)


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(settle(_training(tables.smart_daily(spark, sf_dir)), "training"))


def _null_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL cells that come back from the text form, per column."""
    back = _exchange_round_trip(spark, sf_dir)
    return back.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in ("capacity_bytes", "smart_5_raw", "smart_187_raw")])


def _metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "metrics")
    metrics = learning.classification_metrics(_predicted(tables.smart_daily(spark, sf_dir)))
    metrics.write.json(path)
    return rounded(spark.read.schema(metrics.schema).json(path).select(*metrics.columns))


def _stored_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of an ensemble that was stored as a table and read again."""
    nodes = settle(_fixed_ensemble(spark), "ensemble")
    inputs = _raw_inputs(tables.smart_daily(spark, sf_dir))
    return rounded(ensembles.score_from_table(nodes, inputs, ensembles.boosted_score).select(*SNAPSHOT_KEY, "probability"))


def in_order(df: DataFrame) -> DataFrame:
    """Add ``place``: where a sorted frame of a few rows has each row."""
    return df.withColumn("_id", F.monotonically_increasing_id()).withColumn("place", F.row_number().over(W.orderBy("_id"))).drop("_id")


def _series_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "series")
    series = tables.engine(spark, sf_dir)
    run_to_failure.write_series(series, path)
    return rounded(run_to_failure.read_series(spark, path, series.schema))


def _labelled_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "labelled")
    series = degradation.remaining_life(tables.engine(spark, sf_dir))
    run_to_failure.write_labelled(series, path)
    return rounded(run_to_failure.read_labelled(spark, path, series.schema))


def _engine_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return degradation.engine_tables(tables.engine(spark, sf_dir), "EVENTS")[0]


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    comparison, _ = training.compare_models(_training(tables.smart_daily(spark, sf_dir)))
    return rounded(settle(comparison, "comparison"))


def _auc_by_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC on the validation part after each of the boosted model's rounds; the other two models have no part in it."""
    matrix = settle(_matrix(tables.smart_daily(spark, sf_dir)), "matrix")
    model = learning.train(matrix.where(F.col("split") == "train"), "boosted")
    validation = matrix.where(F.col("split") == "validation")
    inputs = settle(ensembles.scaled_inputs(model, validation).select("label", "inputs"), "validation-inputs")
    return rounded(ensembles.auc_by_round(ensembles.ensemble_nodes(model), inputs))


def _fixed_ensemble(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(t, n, FEATURE_COLUMNS.index(c) if c else ensembles.LEAF, *rest) for t, n, c, *rest in FIXED_NODES], ensembles.NODES
    )


def _raw_inputs(df: DataFrame) -> DataFrame:
    return _matrix(df).withColumn("inputs", F.array(*FEATURE_COLUMNS))


def _fixed_scores(df: DataFrame) -> DataFrame:
    scored = ensembles.score_from_table(_fixed_ensemble(df.sparkSession), _raw_inputs(df), ensembles.boosted_score)
    return scored.select(*SNAPSHOT_KEY, "probability")


def _fixed_rounds(df: DataFrame) -> DataFrame:
    return ensembles.auc_by_round(_fixed_ensemble(df.sparkSession), _raw_inputs(df))


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = _matrix(tables.smart_daily(spark, sf_dir)).where(F.col("split") == "train")
    return rounded(learning.feature_importance(learning.train(settle(matrix, "train"), "forest")))


def _two_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions from one model per horizon."""
    df = tables.smart_daily(spark, sf_dir)
    table = settle(_training(df), "training")
    requests = settle(features.latest_features(df), "requests")
    day = F.lit("2002-01-01").cast("date")
    scored = []
    for target in ("will_fail_30d", "will_fail_60d"):
        matrix = settle(learning.with_split(features.training_matrix(table, target)).where(F.col("split") == "train"), "train")
        model = learning.train(matrix, "forest")
        scored.append(scoring.score_batch(requests, scoring.model_scorer(model), day))
    return rounded(scoring.prediction_rows(*scored, day, "forest").drop("created_at"))


def _model_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, store, load again, describe."""
    matrix = settle(_matrix(tables.smart_daily(spark, sf_dir)), "matrix")
    model = learning.train(matrix.where(F.col("split") == "train"), "forest")
    metrics = learning.evaluate(learning.predict(model, matrix.where(F.col("split") == "test")))
    path = _scratch(spark, "bundle")
    learning.save_bundle(model, path, "forest", metrics, FEATURE_COLUMNS)
    return rounded(learning.model_info(*learning.load_bundle(spark, path)))


def _study(part: str) -> Query:
    return surv(lambda df: reports.reliability_study(df)[part])


SOURCES: dict[str, Query] = {
    "S2_csv_round_trip": _csv_round_trip,
    "S3_normalize": lambda s, d: csv_drops.accepted(csv_drops.normalize(_dirty_text(s, d))),
    "S3_rejected": lambda s, d: csv_drops.rejected(csv_drops.normalize(_dirty_text(s, d)))
    .groupBy(csv_drops.REASON)
    .agg(F.count("*").alias("rows")),
    "S4_exchange_round_trip": _exchange_round_trip,
    "S5_quarter_scan": _quarter_scan,
    "S6_incremental_load": _stream_round_trip,
    "S6_mixed_drops": lambda s, d: snapshot_store.read_snapshots(s, _mixed_load(s, d)[0]).drop("quarter"),
    "S6_refused_lines": _mixed_refused,
    "S5_date_range": _date_range,
    "S9_sql_scan": _sql_scan,
    "S13_catalog_columns": _catalog,
    "S7_unique_rows": lambda s, d: tables.smart_daily(s, d),
    "S7_surplus_rows": raw(
        lambda df: keys.surplus_rows(
            df, SNAPSHOT_KEY, tables.TIE_BREAK, keys.few_repeated_keys(df, SNAPSHOT_KEY)
        ).select(*SNAPSHOT_KEY, *tables.TIE_BREAK, "copies")
    ),
    "S8_load_totals": _load_totals,
    "S10_training_round_trip": _training_round_trip,
    "S10_training_rows": _training_rows,
    "S14_metrics_file": _metrics_file,
    "S15_stored_ensemble": _stored_ensemble,
    "S16_null_markers": _null_markers,
    "S11_series_round_trip": _series_round_trip,
    "S12_labelled_round_trip": _labelled_round_trip,
}

REPORTS: dict[str, Query] = {
    "A1_overview": daily(fleet.overview),
    "A1_overview_dates": daily(lambda df: fleet.overview(df, places=6, with_dates=True)),
    "A2_monthly": daily(fleet.monthly),
    "O1_months_in_order": daily(lambda df: in_order(fleet.monthly(df))),
    "O4_capacities_in_order": daily(lambda df: in_order(fleet.failures_by_capacity(df, "fine", True, "capacity"))),
    "A3_failure_by_model": daily(fleet.failure_by_model),
    "A3_failure_by_model_short": daily(lambda df: fleet.failure_by_model(df, limit=15, places=2)),
    "A4_weekday": daily(fleet.failures_by_weekday),
    "A5_indicator_means": daily(fleet.indicator_means),
    "A5_indicator_means_unrounded": daily(lambda df: fleet.indicator_means(df, None)),
    "A6_annualized_failure_rate": surv(fleet.annualized_failure_rate),
    "A7_capacity_wide": daily(fleet.failures_by_capacity),
    "A7_capacity_fine": daily(lambda df: fleet.failures_by_capacity(df, "fine", True, "capacity")),
    "A7_capacity_coarse": daily(lambda df: fleet.failures_by_capacity(df, "coarse", True, "capacity", False)),
    "A8_daily": daily(fleet.daily),
    "A10_divergence": daily(fleet.divergence),
    "A20_drive_registry": daily(lambda df: fleet.drive_registry(df).drop("created_at")),
    "W1_failure_trend": daily(fleet.failure_trend),
    "P1_recent_failures": daily(fleet.recent_failures),
    "P2_watchlist": daily(fleet.watchlist),
    "P2_watchlist_population": daily(lambda df: fleet.watchlist(df, None)),
    "P20_pending_sector_alerts": daily(fleet.pending_sector_alerts),
    "P20_alerts_of_worn_drives": daily(lambda df: fleet.pending_sector_alerts(df.withColumn("smart_197_raw", F.col("smart_197_raw") * 3))),
}

QUALITY: dict[str, Query] = {
    "Q1_statistics": snapshots(quality.basic_statistics),
    "Q2_duplicate_keys": snapshots(quality.duplicate_keys),
    "Q3_missing_values": snapshots(quality.missing_values),
    "Q4_outliers": snapshots(quality.outliers),
    "Q6_continuity": snapshots(quality.continuity),
    "Q6_missing_days": snapshots(quality.missing_days),
    "Q6_missing_days_with_gaps": snapshots(lambda df: quality.missing_days(_with_gaps(df))),
    "Q6_continuity_with_gaps": snapshots(lambda df: quality.continuity(_with_gaps(df))),
    "Q5_wrong_types": snapshots(lambda df: quality.type_conformance(_wrong_types(df))),
    "Q7_daily_counts": snapshots(quality.daily_counts),
    "Q7_anomalous_days": snapshots(quality.anomalous_days),
    "Q8_labels": snapshots(quality.label_distribution),
    "Q9_multi_failure_drives": snapshots(quality.multi_failure_drives),
    "Q10_report": snapshots(quality.report),
}

FEATURES: dict[str, Query] = {
    "J1_never_failed": daily(keys.never_failed),
    "J2_failure_dates": daily(lambda df: keys.with_failure_date(df, keys.failure_dates(df)).select(*SNAPSHOT_KEY, "failure_date")),
    "J3_rows_of_failed": daily(lambda df: keys.rows_of(df, keys.failed_drives(df))),
    "A12_failed_drives": daily(keys.failed_drives),
    "O2_healthy_sample": daily(lambda df: keys.sample_keys(keys.never_failed(df), 500)),
    "W2_rolling_features": daily(features.rolling_features),
    "W2_rolling_days": daily(lambda df: features.rolling_features(df, by="days")),
    "W12_training_set": daily(_training),
    "W12_training_sample": daily(lambda df: features.training_set(df, 500)),
    "W13_feature_table": daily(features.feature_table),
    "P13_training_matrix": daily(lambda df: features.training_matrix(_training(df))),
    "A13_class_distribution": daily(lambda df: features.class_distribution(_training(df))),
}

SURVIVAL: dict[str, Query] = {
    "A9_lifetimes": surv(survival.lifetimes),
    "A11_largest_models": lives(fleet.largest_models),
    "A22_lifetime_histogram": lives(lambda df: survival.lifetime_histogram(df, ["model"])),
    "R1_weibull_fleet": lives(lambda df: survival.weibull_summary(_fits(df))),
    "R1_weibull_unbounded": lives(lambda df: _fits(df, scale_bounds=(1.0, 1e9))),
    "R2_weibull_by_model": _study("models"),
    "R3_kaplan_meier": lives(_curve),
    "R3_kaplan_meier_by_model": lives(lambda df: _curve(df, ["model"])),
    "R4_median_survival": lives(lambda df: survival.median_survival(_curve(df, ["model"]), ["model"])),
    "R5_survival_at": lives(lambda df: survival.survival_at(_curve(df))),
    "R5_survival_at_next": lives(lambda df: survival.survival_at(_curve(df), lookup="next")),
    "R6_reliability_at": lives(lambda df: survival.at_horizons(_fits(df))),
    "R11_compare_models": lives(lambda df: survival.compare_failure_rates(df, "LARGE", "STANDARD")),
    "J6_model_pairs": lives(lambda df: survival.compare_all_models(df, min_drives=1)),
    "R12_failure_counts": lives(survival.failure_counts),
    "R13_alert_value": daily(_score_shift),
    "D23_several_models": daily(quality.drives_with_several_models),
    "D23_renamed_models": daily(lambda df: quality.drives_with_several_models(_renamed_models(df))),
}

DEGRADATION: dict[str, Query] = {
    "W11_remaining_life": rul(lambda df: df),
    "A14_life_statistics": engine(degradation.life_statistics),
    "A15_target_summary": rul(degradation.target_summary),
    "A16_sensor_profile": engine(degradation.sensor_profile),
    "A16_most_varying": engine(lambda df: degradation.most_varying(degradation.sensor_profile(df))),
    "A17_correlations": rul(lambda df: degradation.target_correlations(df, degradation.sensor_columns(df))),
    "A17_extremes": rul(lambda df: degradation.extremes(degradation.target_correlations(df), 2, 1)),
    "A18_histogram": rul(degradation.equal_width_histogram),
    "A19_shape": engine(degradation.shape),
    "P17_useful_sensors": rul(lambda df: df.drop(*CONSTANT_SENSORS)),
    "P18_degradation_paths": rul(degradation.degradation_paths),
    "S9_engine_table": _engine_tables,
}

SCORING: dict[str, Query] = {
    "P9_risk_tiers": daily(lambda df: _scored(df).drop("timestamp")),
    "P11_impute": daily(
        lambda df: scoring.impute(scoring.as_requests(df.withColumnRenamed("smart_9_raw", "power_on_hours")))
    ),
    "P11_impute_features": daily(lambda df: scoring.impute(scoring.as_requests(features.latest_features(df)))),
    "P19_display": daily(lambda df: scoring.display(_scored(df))),
    "M11_score_batch": daily(_scored),
    "A21_batch_summary": daily(lambda df: scoring.batch_summary(_scored(df))),
    "A21_risk_distribution": daily(lambda df: scoring.risk_distribution(_scored(df))),
}

LEARNING: dict[str, Query] = {
    "M1_split": daily(lambda df: _matrix(df).groupBy("split", "label").agg(F.count("*").alias("samples"))),
    "M1_split_by_row": daily(
        lambda df: learning.with_split(features.training_matrix(_training(df)), by="row")
        .groupBy("split", "label")
        .agg(F.count("*").alias("samples"))
    ),
    "M1_stratified_rows": daily(
        lambda df: learning.with_stratified_split(features.training_matrix(_training(df)), by="row").select(*SNAPSHOT_KEY, "label", "split")
    ),
    "M1_stratified_drives": daily(
        lambda df: learning.with_stratified_split(features.training_matrix(_training(df))).select("serial_number", "split").distinct()
    ),
    "M2_scaler": daily(lambda df: learning.scaler_statistics(_matrix(df).where("split = 'train'"))),
    "M3_class_weights": daily(lambda df: learning.class_weights(_matrix(df))),
    "M3_positive_weight": daily(lambda df: learning.positive_weight(_matrix(df))),
    "M4_auc_by_round": _auc_by_round,
    "M4_auc_by_round_of_fixed_trees": daily(_fixed_rounds),
    "M7_scores_of_fixed_trees": daily(_fixed_scores),
    "M12_split_gains": daily(lambda df: learning.split_gains(_matrix(df))),
    "M8_metrics": daily(lambda df: learning.classification_metrics(_predicted(df))),
    "M9_confusion": daily(lambda df: learning.confusion(_predicted(df))),
    "M10_roc_auc": daily(lambda df: learning.roc_auc(_predicted(df))),
    "M12_feature_importance": _importance,
    "M13_model_comparison": _comparison,
    "M14_model_info": _model_bundle,
    "W14_two_horizons": _two_horizons,
}


def entry(spark: SparkSession) -> DataFrame:
    """Failure rate by model on the smallest tables, which have some 30 drives per model."""
    df = tables.smart_daily(spark, "/root/testdata/sf0.001")
    return fleet.failure_by_model(df, min_drives=10)


def queries() -> dict[str, Query]:
    return {**SOURCES, **REPORTS, **QUALITY, **FEATURES, **SURVIVAL, **DEGRADATION, **SCORING, **LEARNING, **LLM}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **LLM_ORACLE}
