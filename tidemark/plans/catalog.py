"""The registered queries: every operator of the inventory as (spark, sf_dir) -> DataFrame.

All queries read the driver tables (through the ``transactions`` fixture view
or ``events``) over their whole extent; the batch numbering is shared.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.columns import DEFAULT_COLUMNS as C
from tidemark.columns import Columns, data_columns
from tidemark.operators import batches, clean, drift, eda, features, model_tables, profile, rules, serve, sketches, train, trees, validate
from tidemark.plans import jobs
from tidemark.plans.positions import global_positions, group_quantiles
from tidemark.session import materialize, scratch_path
from tidemark.sources import csv_source, documents
from tidemark.sources import store as store_mod
from tidemark.sources.tables import read_table, transactions
from tidemark.streaming import csv_stream, micro, scoring, update
from tidemark.streaming.run import run_to_end

BATCH_SIZE = 2000


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.assign_batches(transactions(spark, sf_dir), BATCH_SIZE, C)


def q_assign_batches(spark, sf_dir):
    return batched(spark, sf_dir)


def q_batch_meta(spark, sf_dir):
    return profile.batch_meta(batched(spark, sf_dir), C)


def q_quality_report(spark, sf_dir):
    return profile.quality_report(batched(spark, sf_dir), C)


def q_quality_gate(spark, sf_dir):
    return profile.quality_gate(profile.quality_report(batched(spark, sf_dir), C), C)


def q_missing_per_column(spark, sf_dir):
    return profile.missing_per_column(batched(spark, sf_dir), C)


def q_dedupe(spark, sf_dir):
    return clean.dedupe(batched(spark, sf_dir), C)


def q_sparse_columns(spark, sf_dir):
    raw = batched(spark, sf_dir)
    data = data_columns(raw, C)
    miss = profile.missing_per_column(raw, C)
    rows = clean.dedupe(raw, C).groupBy(C.batch).agg(F.count(F.lit(1)).cast("long").alias("rows_after_dedupe"))
    share = F.try_divide(F.col("missing_count").cast("double"), F.col("rows_after_dedupe")) * 100.0
    return miss.join(rows, C.batch).select(
        C.batch, "column_name", "missing_count", "rows_after_dedupe",
        F.round(share, 4).alias("missing_pct"),
        F.coalesce(share > clean.DEFAULT_MAX_MISSING_PCT, F.lit(False)).alias("dropped"),
    )


def q_fill_missing(spark, sf_dir):
    raw = batched(spark, sf_dir)
    deduped = clean.dedupe(raw, C)
    return clean.fill_and_filter(deduped, clean.clean_params(raw, deduped, C), C, filter_invalid=False)


def q_invalid_rows(spark, sf_dir):
    return clean.invalid_rows(batched(spark, sf_dir), C)


def cleaned(spark, sf_dir):
    return clean.clean(batched(spark, sf_dir), C)


def q_clean(spark, sf_dir):
    return cleaned(spark, sf_dir).data


def q_clean_audit(spark, sf_dir):
    raw = batched(spark, sf_dir)
    return clean.clean_audit(raw, clean.clean(raw, C), C)


def q_profile_header(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return eda.profile_header(c.data, c.dropped, C)


def q_describe_numeric(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return eda.describe_numeric(c.data, c.dropped, C)


def q_top_categories(spark, sf_dir):
    return eda.top_categories(cleaned(spark, sf_dir).data, cols=C)


def q_category_counts(spark, sf_dir):
    return eda.category_counts(cleaned(spark, sf_dir).data, cols=C)


def q_correlation(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return eda.correlation(c.data, c.dropped, C)


def q_histogram(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return eda.histogram(c.data, c.dropped, cols=C)


def q_target_rate_by_category(spark, sf_dir):
    return eda.target_rate_by_category(cleaned(spark, sf_dir).data, C)


def features_and_deltas(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    feats = drift.drift_features(c.data, c.dropped, C)
    ref = drift.reference_features(feats, 0, C)
    return feats, drift.drift_deltas(feats, ref, cols=C)


def q_drift_features(spark, sf_dir):
    feats, _ = features_and_deltas(spark, sf_dir)
    return feats.withColumn("value", F.round("value", 4))


def q_drift_deltas(spark, sf_dir):
    return features_and_deltas(spark, sf_dir)[1]


def q_drift_summary(spark, sf_dir):
    return drift.drift_summary(features_and_deltas(spark, sf_dir)[1], C)


# The positive label is rare (about 3 %): rules about it need lower bounds.
TARGET_PARAMS = rules.RuleParams(min_support=0.01, min_confidence=0.1)


def itemsets(spark, sf_dir, params=rules.RuleParams()):
    return rules.frequent_itemsets(rules.baskets(cleaned(spark, sf_dir).data, C), params, C)


def q_baskets(spark, sf_dir):
    return rules.as_text(rules.baskets(cleaned(spark, sf_dir).data, C), None)


def q_frequent_itemsets(spark, sf_dir):
    return rules.as_text(itemsets(spark, sf_dir), None)


def table_baskets(spark, sf_dir):
    """The baskets of all cleaned rows as one batch."""
    return rules.baskets(cleaned(spark, sf_dir).data.withColumn(C.batch, F.lit(0)), C, bounded=False)


def q_table_itemsets(spark, sf_dir):
    """A4 over the whole table as one batch, block by block."""
    return rules.as_text(rules.frequent_itemsets_blocked(table_baskets(spark, sf_dir), cols=C), None)


def q_table_itemsets_fpgrowth(spark, sf_dir):
    """A4 over the whole table as one batch, by MLlib's FP-growth."""
    return rules.as_text(rules.frequent_itemsets_fpgrowth(table_baskets(spark, sf_dir), 0, cols=C), None)


def mined_rules(spark, sf_dir, params=rules.RuleParams(), holding=None):
    return rules.association_rules(itemsets(spark, sf_dir, params), params, C, holding)


def q_association_rules(spark, sf_dir):
    return rules.as_text(mined_rules(spark, sf_dir), None)


def q_top_rules(spark, sf_dir):
    return rules.as_text(rules.top_rules(mined_rules(spark, sf_dir), rules.RuleParams().n_rules, C), None)


def q_target_rules(spark, sf_dir):
    return rules.as_text(rules.target_rules(mined_rules(spark, sf_dir, TARGET_PARAMS, rules.target_item(C)), TARGET_PARAMS.n_target_rules, C), None)


def fit_batch(data):
    return data.filter(F.col(C.batch) == 0)


def q_impute(spark, sf_dir):
    return features.imputation_table(fit_batch(cleaned(spark, sf_dir).data), C)


def prepared(spark, sf_dir, params):
    data = cleaned(spark, sf_dir).data
    fitted = features.fit(fit_batch(data), params, C)
    wide = fitted.transform(data, keep=[C.batch, C.row])
    return fitted, wide


def q_features_ordinal_standard(spark, sf_dir):
    fitted, wide = prepared(spark, sf_dir, features.FeatureParams("standard", "ordinal"))
    return features.to_long(wide, fitted.output_columns(), [C.batch, C.row, "label"])


def q_features_onehot_minmax(spark, sf_dir):
    fitted, wide = prepared(spark, sf_dir, features.FeatureParams("minmax", "onehot"))
    return features.to_long(wide, fitted.output_columns(), [C.batch, C.row, "label"])


def q_features_onehot_sparse(spark, sf_dir):
    """P5 in sparse form: the entries of every cleaned row."""
    data = cleaned(spark, sf_dir).data
    fitted = features.fit(fit_batch(data), features.FeatureParams("minmax", "onehot"), C)
    return fitted.sparse_entries(data, [C.batch, C.row]).select(C.batch, C.row, "feature", F.round("value", 4).alias("value"))


# Two transparent scorers stand in for models where the result must be
# checked by SQL: a clipped amount ratio and a per-status constant.
SCORERS = ("amount", "status")
VALIDATION_MIN_BATCHES = 0  # the reference's own test configuration


def rule_scored(spark, sf_dir):
    """(batch, row, model, label, p1, prediction) on holdout rows."""
    ho = validate.holdout(cleaned(spark, sf_dir).data, validate.DEFAULT_VAL_SIZE, C).filter("is_holdout")
    amount = F.least(F.greatest(F.col(C.amount) / F.lit(500000.0), F.lit(0.0)), F.lit(1.0))
    status = (
        F.when(F.col(C.txn_type) == "F", F.lit(0.6)).when(F.col(C.txn_type) == "O", F.lit(0.3)).otherwise(F.lit(0.1))
    )
    entries = F.array(
        F.struct(F.lit("amount").alias("model"), amount.alias("p1"), F.lit(0.9).alias("thr")),
        F.struct(F.lit("status").alias("model"), status.alias("p1"), F.lit(0.5).alias("thr")),
    )
    long = ho.select(C.batch, C.row, F.col(C.target).alias("label"), F.inline(entries))
    return long.withColumn("prediction", F.when(F.col("p1") >= F.col("thr"), 1).otherwise(0)).drop("thr")


def q_holdout(spark, sf_dir):
    return validate.holdout(cleaned(spark, sf_dir).data, validate.DEFAULT_VAL_SIZE, C).select(C.batch, C.row, "is_holdout")


def q_cv_folds(spark, sf_dir):
    return validate.cv_folds(cleaned(spark, sf_dir).data, validate.DEFAULT_SPLITS, C).select(C.batch, C.row, "test_fold")


def q_binary_metrics(spark, sf_dir):
    return validate.binary_metrics(rule_scored(spark, sf_dir), [C.batch, "model"])


def q_roc_auc(spark, sf_dir):
    return validate.roc_auc(rule_scored(spark, sf_dir), [C.batch, "model"])


def q_holdout_evaluation(spark, sf_dir):
    return validate.evaluate(rule_scored(spark, sf_dir), C)


def q_best_model(spark, sf_dir):
    ev = validate.evaluate(rule_scored(spark, sf_dir), C)
    return validate.best_model(ev, "f1", VALIDATION_MIN_BATCHES, SCORERS, C)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "assign_batches": q_assign_batches,
    "batch_meta": q_batch_meta,
    "quality_report": q_quality_report,
    "quality_gate": q_quality_gate,
    "missing_per_column": q_missing_per_column,
    "dedupe": q_dedupe,
    "sparse_columns": q_sparse_columns,
    "fill_missing": q_fill_missing,
    "invalid_rows": q_invalid_rows,
    "clean": q_clean,
    "clean_audit": q_clean_audit,
    "profile_header": q_profile_header,
    "describe_numeric": q_describe_numeric,
    "top_categories": q_top_categories,
    "category_counts": q_category_counts,
    "correlation": q_correlation,
    "histogram": q_histogram,
    "target_rate_by_category": q_target_rate_by_category,
    "drift_features": q_drift_features,
    "drift_deltas": q_drift_deltas,
    "drift_summary": q_drift_summary,
    "baskets": q_baskets,
    "frequent_itemsets": q_frequent_itemsets,
    "table_itemsets": q_table_itemsets,
    "table_itemsets_fpgrowth": q_table_itemsets_fpgrowth,
    "association_rules": q_association_rules,
    "top_rules": q_top_rules,
    "target_rules": q_target_rules,
    "impute": q_impute,
    "features_ordinal_standard": q_features_ordinal_standard,
    "features_onehot_minmax": q_features_onehot_minmax,
    "features_onehot_sparse": q_features_onehot_sparse,
    "holdout": q_holdout,
    "cv_folds": q_cv_folds,
    "binary_metrics": q_binary_metrics,
    "roc_auc": q_roc_auc,
    "holdout_evaluation": q_holdout_evaluation,
    "best_model": q_best_model,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# ---------------------------------------------------------------- models (rows-only checks)

PIPELINE = jobs.PipelineConfig(min_batches=VALIDATION_MIN_BATCHES)


def training_table(spark, sf_dir):
    """Prepared features, written bucketed by batch: a fit reads the bucket of its batch and nothing is recomputed."""
    fitted, wide = prepared(spark, sf_dir, features.FeatureParams())
    return fitted, materialize(wide, "features", bucket_col=C.batch, in_order=True)


def batch_numbers(df):
    """The batch numbers in order, streamed."""
    return (r[0] for r in df.select(C.batch).distinct().orderBy(C.batch).toLocalIterator())


def trained(fitted, wide, models, each=None):
    """The models named, extended batch by batch; ``each(versions, batches)`` runs after every wave."""
    state = train.ModelState(fitted.output_columns(), PIPELINE.train_params)
    numbers = batch_numbers(wide)
    size = jobs.WAVE if "rf" in models else 16 * jobs.WAVE  # an MLP's version is some weights
    while wave := list(itertools.islice(numbers, size)):
        versions = state.extended([wide.filter(F.col(C.batch) == b) for b in wave], models, table=(wide, C.batch, wave, C.row), chained=True)
        state = versions[-1]
        if each:
            each(versions, wave)
    return state


def q_class_weights(spark, sf_dir):
    data = fit_batch(cleaned(spark, sf_dir).data).select(F.col(C.target).cast("double").alias("label"))
    return train.class_weights(data)


def scores(state, wide, model):
    return state.predict_proba(wide, model).select(C.batch, C.row, "label", "p1", "prediction")


def q_rf_scores(spark, sf_dir):
    fitted, wide = training_table(spark, sf_dir)
    state = train.ModelState(fitted.output_columns(), PIPELINE.train_params).fit(fit_batch(wide), ("rf",))
    return scores(state, wide, "rf")


def q_rf_ensemble_scores(spark, sf_dir):
    fitted, wide = training_table(spark, sf_dir)
    return scores(trained(fitted, wide, ("rf",)), wide, "rf")


def q_mlp_scores(spark, sf_dir):
    fitted, wide = training_table(spark, sf_dir)
    return scores(trained(fitted, wide, ("mlp",)), wide, "mlp")


def q_evaluate_models(spark, sf_dir):
    """V4: each batch's holdout rows are scored by the models of that moment; all batches are evaluated in one job."""
    fitted, wide = training_table(spark, sf_dir)
    path = scratch_path(spark, "holdout")

    def score(versions, wave):
        jobs.score_holdouts(versions, wave, wide, path, PIPELINE.val_size, C)

    trained(fitted, wide, validate.MODEL_ORDER, score)
    return validate.evaluate(spark.read.parquet(path), C)


def q_cv_scores(spark, sf_dir, wave: int = 4 * jobs.WAVE):
    """V5: expanding-window CV of fresh models per batch and fold. Folds are independent: a task each fits and scores one,
    the folds of ``wave`` batches in one job."""
    fitted, wide = training_table(spark, sf_dir)
    k, part = validate.DEFAULT_SPLITS, "__part"
    folds = validate.fold_membership(validate.cv_folds(wide, k, C), k, C).withColumn(part, F.col(C.batch) * k + F.col("fold"))
    folds = materialize(folds, "folds", bucket_col=C.batch, in_order=True)
    path, params = scratch_path(spark, "cv"), PIPELINE.train_params
    most = folds.filter("role = 'train'").groupBy(part).count().agg(F.max("count")).first()[0] or 0
    taken = spark.sparkContext.broadcast(trees.draws(params.seed, most, params.rf_trees))
    numbers = batch_numbers(folds)
    while some := list(itertools.islice(numbers, wave)):
        rows = folds.filter(F.col(C.batch).isin(some))
        found = train.fresh_scores(rows, part, [b * k + i for b in some for i in range(k)], C.row, fitted.output_columns(), params, taken)
        found.withColumn(C.batch, F.expr(f"int({part} div {k})")).withColumn("fold", F.expr(f"int({part} % {k})")).drop(part).write.mode("append").parquet(path)
    scored = validate.binary_metrics(spark.read.parquet(path), [C.batch, "model", "fold"])
    return scored.groupBy(C.batch, "model").agg(
        F.round(F.avg("f1"), 4).alias("mean_f1"), F.round(F.stddev_pop("f1"), 4).alias("std_f1"),
        F.count(F.lit(1)).cast("long").alias("n_folds"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "f1"))), lambda x: F.round(x["f1"], 4)).alias("fold_f1"),
    )


def _pipeline_root(spark, sf_dir):
    """J1 over every batch of the fixture into a fresh store, then J2 twice
    over the whole table (two logged scoring runs for the G5 summary)."""
    root = scratch_path(spark, "pipeline")
    jobs.run_update(spark, transactions(spark, sf_dir), root, PIPELINE, process_all=True)
    out = scratch_path(spark, "scored")
    jobs.run_inference(spark, transactions(spark, sf_dir), root, out + "/all", PIPELINE)
    jobs.run_inference(spark, transactions(spark, sf_dir), root, out + "/again", PIPELINE)
    return root


def q_inference(spark, sf_dir):
    root = _pipeline_root(spark, sf_dir)
    return jobs.run_inference(spark, transactions(spark, sf_dir), root, None, PIPELINE)


def q_scoring_summary(spark, sf_dir):
    root = _pipeline_root(spark, sf_dir)
    return serve.performance_summary(store_mod.BatchStore(spark, root).read("scoring_log"))


def q_summary(spark, sf_dir):
    return jobs.run_summary(spark, _pipeline_root(spark, sf_dir))


# ---------------------------------------------------------------- models in table form
# A fixed forest and a fixed network, so that SQL can follow every score. Each
# tree is complete with eight leaves; node i has the children 2i + 1 and 2i + 2.
RAW_FEATURES = (C.amount, C.balance, C.age)
FIXED_TREES = 6


def fixed_forest(thresholds) -> list[tuple]:
    """Nodes ``(tree, node, feature, threshold, left, right, weights)``; ``thresholds`` lists each feature's values."""
    nodes = []
    for t in range(FIXED_TREES):
        for i in range(7):
            f = (2 * t + i) % len(thresholds)
            nodes.append((t, i, f, float(thresholds[f][(t + i) % len(thresholds[f])]), 2 * i + 1, 2 * i + 2, [5.0, 5.0]))
        nodes += [(t, i, -1, 0.0, -1, -1, [(3 * t + i) % 7 + 0.31 * t, (5 * i + t) % 9 + 0.17 * i]) for i in range(7, 15)]
    return nodes


RAW_THRESHOLDS = ([30000.0, 90000.0, 160000.0, 250000.0], [-500.0, 1500.0, 4000.0, 8000.0], [18.0, 35.0, 60.0, 90.0])
#: Of prepared features: standardised numbers, then ordinal codes.
PREPARED_THRESHOLDS = ([-0.9, -0.2, 0.4, 1.3], [-1.1, 0.1, 0.8], [-0.7, 0.0, 1.0], [0.5, 1.5], [0.5, 2.5], [0.5], [1.5, 3.5], [6.5, 13.5], [0.5])


def fixed_mlp() -> list[tuple]:
    """Weights ``(layer, unit, input, weight)`` of a network of 3, 4, 3 and 2 units."""
    sizes, rows = (3, 4, 3, 2), []
    for layer, (inputs, units) in enumerate(zip(sizes, sizes[1:], strict=False)):
        rows += [(layer, j, i, ((5 * layer + 4 * j + 7 * i) % 11 - 5) / 2) for j in range(units) for i in range(-1, inputs)]
    return rows


def q_forest_table_scores(spark, sf_dir):
    """Every transaction's probability by a node table over raw columns (missing values go right)."""
    nodes = spark.createDataFrame(fixed_forest(RAW_THRESHOLDS), model_tables.NODES)
    model = model_tables.TableModels(list(RAW_FEATURES), nodes)
    return model.predict_proba(transactions(spark, sf_dir)).select(C.id, "p1", "prediction")


def q_mlp_table_scores(spark, sf_dir):
    """The same by a weight table over scaled columns."""
    scale = {C.amount: 250000.0, C.balance: 5000.0, C.age: 60.0}
    t = transactions(spark, sf_dir).select(C.id, *[(F.col(c) / F.lit(s)).alias(c) for c, s in scale.items()])
    model = model_tables.TableModels(list(RAW_FEATURES), None, spark.createDataFrame(fixed_mlp(), model_tables.WEIGHTS))
    return model.predict_proba(t, "mlp").select(C.id, "p1", "prediction")


def q_table_inference(spark, sf_dir):
    """A fixed forest over prepared features, registered, promoted and served; the scored table is written as CSV and read back."""
    root = table_model_root(spark, sf_dir)
    st = store_mod.BatchStore(spark, root)
    source = transactions(spark, sf_dir)
    jobs.run_inference(spark, source, root, st.path("scored"), PIPELINE, fmt="csv")
    back = spark.read.schema(T.StructType([*source.schema.fields, T.StructField("predict", T.IntegerType())])).option("header", True).csv(st.path("scored"))
    return back.select(C.id, C.amount, C.txn_type, "predict")


def table_model_root(spark, sf_dir):
    """A store whose production model is the fixed forest over prepared features."""
    fitted, _ = prepared(spark, sf_dir, features.FeatureParams())
    root = scratch_path(spark, "table-inference")
    st = store_mod.BatchStore(spark, root)
    fitted.save(spark, st.path("fitted_features"))
    nodes = spark.createDataFrame(fixed_forest(PREPARED_THRESHOLDS), model_tables.NODES)
    path = model_tables.TableModels(fitted.output_columns(), nodes).save(st.path("tables"))
    serve.register(spark, st.path("registry"), "best", "rf", path, None, "f1", 0)
    serve.promote(spark, st.path("registry"))
    return root


# ---------------------------------------------------------------- sources, store, stream
def q_read_all_batches(spark, sf_dir):
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    b = batched(spark, sf_dir)
    st.save_batches(b, profile.batch_meta(b, C))
    return st.load_all_batches()


def q_pending_batches(spark, sf_dir):
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    b = batched(spark, sf_dir)
    empty = spark.createDataFrame([], f"{C.batch} int")
    first = batches.next_batch(b, empty, C)
    st.save_batches(first, profile.batch_meta(first, C))
    return batches.pending_batches(b, st.read("batch_meta"), C)


def q_stream_quality(spark, sf_dir, files_per_trigger: int = 16):
    base = scratch_path(spark, "stream")
    b = batched(spark, sf_dir)
    micro.write_landing(b, base + "/landing")
    return micro.run_stream(
        spark, base + "/landing", b.schema,
        lambda df: profile.quality_report(df, C), base + "/quality", base + "/checkpoint", files_per_trigger,
    ).select(*profile.quality_report(b, C).columns)


CSV_TYPES = {
    "Transaction_ID": "bigint", "Customer_ID": "bigint", "Transaction_Date": "timestamp",
    "Transaction_Amount": "double", "Account_Balance": "double", "Age": "int",
    "Transaction_Type": "string", "Merchant_Category": "string", "Device_Type": "string",
    "Account_Type": "string", "State": "string", "Gender": "string", "Bank_Branch": "string", "Is_Fraud": "int",
}


CSV_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "yyyy/MM/dd", "yyyy-MM-dd'T'HH:mm:ss'Z'", "MMM d, yyyy", "d MMM yyyy")


def csv_text(t):
    """The fixture as text: columns in another order, a further column, six date layouts and missing-value tokens."""
    layout = F.pmod(F.col(C.id), F.lit(len(CSV_LAYOUTS)))
    day = F.coalesce(*[F.when(layout == i, F.date_format(C.time, fmt)) for i, fmt in enumerate(CSV_LAYOUTS)])
    return t.select(
        (F.col(C.id) % 7).cast("string").alias("Channel_Code"),
        *[day.alias(c) if c == C.time
          else F.coalesce(F.col(c).cast("string"), F.lit("NaN")).alias(c) if c == C.amount
          else F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) if c == C.device
          else F.col(c).cast("string").alias(c)
          for c in reversed(t.columns)],
    )


def q_csv_source(spark, sf_dir):
    """S1/S2 round trip of the fixture as CSV text, read back through the source."""
    path = scratch_path(spark, "csv")
    csv_text(transactions(spark, sf_dir)).write.mode("overwrite").option("header", True).csv(path)
    return csv_source.read_transactions_csv(spark, path, CSV_TYPES, C)


def q_stream_clean(spark, sf_dir):
    """The cleaned table produced by the streaming analytics (same as ``clean``)."""
    base = scratch_path(spark, "stream-analytics")
    b = batched(spark, sf_dir)
    micro.write_landing(b, base + "/landing")
    out = micro.stream_analytics(spark, base + "/landing", b.schema, base + "/reports", base + "/checkpoint", 16, C)
    return out["clean"].select(*b.columns)


SLICES = 5


def landed_slices(spark, df, path, slices: int = SLICES, write=lambda part, to: part.write.parquet(to)):
    """Rows in (time, id) order as ``slices`` deliveries, one folder after the other; returns their glob."""
    order = [F.col(C.time).asc_nulls_last(), F.col(C.id).asc_nulls_last()]
    placed = materialize(global_positions(df, order, "__at"), "arrivals")
    n = placed.count()
    for i in range(slices):
        part = placed.filter((F.col("__at") >= i * n // slices) & (F.col("__at") < (i + 1) * n // slices)).drop("__at")
        write(part.coalesce(1), f"{path}/delivery={i}")
    return f"{path}/*"


def arriving(spark, df, path, slices: int = SLICES):
    """A stream that gets the rows in ``slices`` micro-batches without numbers."""
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(landed_slices(spark, df, path, slices))


def q_stream_batches(spark, sf_dir):
    """Unnumbered rows arrive in five deliveries; each epoch is run twice, and the batches are those of ``assign_batches``."""
    base, source = scratch_path(spark, "arriving"), transactions(spark, sf_dir)
    counter = update.RowCounter(store_mod.BatchStore(spark, base + "/store"), base + "/checkpoint", PIPELINE)

    def twice(rows, epoch):
        counter.append(rows, epoch)
        counter.append(rows, epoch)

    run_to_end(arriving(spark, source, base + "/landing"), twice, base + "/checkpoint")
    return counter.store.read("raw")


STREAM_PIPELINE = jobs.PipelineConfig(min_batches=VALIDATION_MIN_BATCHES, train_params=train.TrainParams(rf_trees=8, rf_new_trees=2, rf_depth=4, mlp_layers=(8,)))


def streamed_update(spark, sf_dir):
    """J1 over arriving rows, every epoch run twice."""
    base, source = scratch_path(spark, "update-stream"), transactions(spark, sf_dir)
    counter = update.RowCounter(store_mod.BatchStore(spark, base + "/store"), base + "/checkpoint", STREAM_PIPELINE)

    def twice(rows, epoch):
        update.step(counter, rows, epoch, every=4)
        update.step(counter, rows, epoch, every=4)

    run_to_end(arriving(spark, source, base + "/landing", 2), twice, base + "/checkpoint")
    update.finish(counter, closed=True)
    return counter.store


def q_stream_update_drift(spark, sf_dir):
    """J1 on a stream: the drift table after drift, training, validation and promotion of every batch."""
    return streamed_update(spark, sf_dir).history("drift")


def q_stream_csv_source(spark, sf_dir):
    """S1/S2 as a stream: ``csv_source``'s text in five deliveries with two column orders, a file without the needed
    columns and a file of bad rows among them; what is good equals the table."""
    base, source = scratch_path(spark, "csv-stream"), csv_text(transactions(spark, sf_dir))
    put = lambda part, to: part.write.option("header", True).csv(to)
    mixed = lambda part, to: put(part if int(to[-1]) % 2 else part.select(*sorted(part.columns)), to)
    landed_slices(spark, source, base + "/landing", write=mixed)
    put(source.limit(3).select(C.id, C.amount), base + "/landing/short")
    put(source.limit(4).withColumn(C.amount, F.lit("many")), base + "/landing/wrong")
    good = base + "/good"
    csv_stream.stream_csv(spark, base + "/landing", CSV_TYPES, lambda rows, epoch: rows.write.mode("overwrite").parquet(f"{good}/epoch={epoch}"),
                          base + "/side", base + "/checkpoint", 2, C)
    return spark.read.parquet(good).drop("epoch")


def q_stream_inference(spark, sf_dir):
    """Arriving rows scored by the fixed forest in production, a log row for each epoch; rows and log totals."""
    root, source = table_model_root(spark, sf_dir), transactions(spark, sf_dir)
    base = scratch_path(spark, "score-stream")
    rows, log = scoring.score_stream(spark, arriving(spark, source, base + "/landing"), root, base, base + "/checkpoint")
    totals = log.agg(F.count("*").alias("n_calls"), F.sum("n_rows").alias("n_rows"))  # one row
    return rows.select(C.id, C.amount, C.txn_type, "predict").join(totals)


def q_meta_history(spark, sf_dir):
    """S5 + S7: stored batch metadata read back in batch order."""
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    b = batched(spark, sf_dir)
    st.save_batches(b, profile.batch_meta(b, C))
    return st.history("batch_meta").drop("saved_at")


def q_quality_history(spark, sf_dir):
    """The stored quality reports."""
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    st.write("quality", profile.quality_report(batched(spark, sf_dir), C))
    return st.history("quality")


def q_drift_history(spark, sf_dir):
    """The stored drift reports."""
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    st.write("drift", features_and_deltas(spark, sf_dir)[1])
    return st.history("drift")


def q_quality_documents(spark, sf_dir):
    """S7/S8 nested: quality documents written as JSON and read back, with a row for each column of their map."""
    raw, path = batched(spark, sf_dir), scratch_path(spark, "quality-documents")
    documents.write_documents(documents.quality_documents(profile.quality_report(raw, C), profile.missing_per_column(raw, C), C), path)
    back = documents.read_documents(spark, path, documents.QUALITY)
    return back.select(C.batch, "n_rows", "missing.pct_total", F.explode("missing.per_column").alias("column_name", "missing_count"),
                       "duplicates.count", "target.rate", "amount.std", "checks.missing_ok", "passed")


def q_rule_documents(spark, sf_dir):
    """S7/S8 nested: each batch's best rules as one document, written, read back and taken apart."""
    path = scratch_path(spark, "rule-documents")
    documents.write_documents(documents.rule_documents(rules.top_rules(mined_rules(spark, sf_dir), rules.RuleParams().n_rules, C), C), path)
    back = documents.read_documents(spark, path, documents.RULES).select(C.batch, F.posexplode("rules").alias("rank", "r"))
    return rules.as_text(back.select(C.batch, (F.col("rank") + 1).alias("rank"), "r.*"), None)


def q_update_reports(spark, sf_dir):
    """J1's report step over all batches; returns the stored category counts."""
    st = store_mod.BatchStore(spark, scratch_path(spark, "store"))
    raw = batched(spark, sf_dir)
    jobs.run_analytics(st, raw, raw.select(C.batch).distinct(), PIPELINE)
    return st.read("eda_counts")


def q_features_reloaded(spark, sf_dir):
    """Features prepared by a fitted state that was saved and loaded."""
    fitted, _ = prepared(spark, sf_dir, features.FeatureParams("standard", "ordinal"))
    path = scratch_path(spark, "state")
    fitted.save(spark, path)
    back = features.FittedFeatures.load(spark, path)
    wide = back.transform(cleaned(spark, sf_dir).data, keep=[C.batch, C.row])
    return features.to_long(wide, back.output_columns(), [C.batch, C.row, "label"])


def q_registered_model(spark, sf_dir):
    """V7/G1: the best scorer registered, promoted and read back."""
    path = scratch_path(spark, "registry")
    best = q_best_model(spark, sf_dir).first()
    serve.register(spark, path, "best", best["model_name"], "", float(best["score"]), best["metric"], best[C.batch])
    serve.promote(spark, path)
    return serve.registered(spark, path).filter("stage = 'production'").select("model_name", C.batch, "score", "metric")


def q_scoring_log_summary(spark, sf_dir):
    """G5 on a fixed log: one entry for each order, its price as the elapsed time."""
    return serve.performance_summary(read_table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("elapsed_ms")))


# ---------------------------------------------------------------- events table
def events_by_day(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn(C.batch, F.datediff(F.to_date("ts"), F.lit("1970-01-01")).cast("int"))


EVENT_COLS = Columns(time="ts", id="event_id", target="__no_target__")


def q_event_profile(spark, sf_dir):
    p = profile.column_profile(events_by_day(spark, sf_dir).drop("ts"), C.batch)
    for c in ("mean", "std", "min", "max", "median"):
        p = p.withColumn(c, F.round(c, 4))
    return p


def q_event_drift(spark, sf_dir):
    ev = events_by_day(spark, sf_dir).drop("ts")
    feats = drift.drift_features(ev, None, EVENT_COLS)
    first = ev.agg(F.min(C.batch)).first()[0]
    ref = drift.reference_features(feats, first, EVENT_COLS)
    return drift.drift_deltas(feats, ref, drift.DEFAULT_THRESHOLD, first, EVENT_COLS)


QUARTILES = (0.25, 0.5, 0.75)


def q_event_quantiles(spark, sf_dir):
    """E2/C3/P2 on groups of any size: exact quartiles of every day by positions in the range-partitioned order."""
    found = group_quantiles(events_by_day(spark, sf_dir), [C.batch], "value", QUARTILES)
    return found.select(C.batch, "prob", F.round("quantile", 4).alias("quantile"))


def q_event_quantile_sketches(spark, sf_dir):
    """The same by mergeable sketches, a stored one for each day and their merge for the whole history: whether
    each estimate's place among its rows is within the sketches' error."""
    st = store_mod.BatchStore(spark, scratch_path(spark, "sketches"))
    ev = events_by_day(spark, sf_dir).select(C.batch, F.col("value").cast("double").alias("value")).filter("value IS NOT NULL")
    st.write("sketches", sketches.quantile_sketches(ev, [C.batch], ["value"]))
    daily = st.read("sketches")
    every = sketches.merged(daily, []).withColumn(C.batch, F.lit(-1))
    estimates = sketches.quantiles(daily.unionByName(every), [C.batch], QUARTILES)
    # one row for each day, prob and, under -1, the history: joined by size
    rows = ev.unionByName(ev.withColumn(C.batch, F.lit(-1))).join(estimates, C.batch)
    place = rows.groupBy(C.batch, "column_name", "prob").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("up_to"))
    slack = F.lit(sketches.RANK_ERROR) * F.col("n") + 1
    near = (F.col("below") <= F.col("prob") * F.col("n") + slack) & (F.col("up_to") >= F.col("prob") * F.col("n") - slack)
    return place.select(C.batch, "column_name", "prob", "n", near.alias("near"))


QUERIES.update({
    "event_quantiles": q_event_quantiles,
    "event_quantile_sketches": q_event_quantile_sketches,
    "class_weights": q_class_weights,
    "rf_scores": q_rf_scores,
    "rf_ensemble_scores": q_rf_ensemble_scores,
    "mlp_scores": q_mlp_scores,
    "evaluate_models": q_evaluate_models,
    "cv_scores": q_cv_scores,
    "forest_table_scores": q_forest_table_scores,
    "mlp_table_scores": q_mlp_table_scores,
    "table_inference": q_table_inference,
    "inference": q_inference,
    "scoring_summary": q_scoring_summary,
    "summary": q_summary,
    "read_all_batches": q_read_all_batches,
    "pending_batches": q_pending_batches,
    "stream_quality": q_stream_quality,
    "stream_clean": q_stream_clean,
    "stream_batches": q_stream_batches,
    "stream_update_drift": q_stream_update_drift,
    "stream_csv_source": q_stream_csv_source,
    "stream_inference": q_stream_inference,
    "meta_history": q_meta_history,
    "csv_source": q_csv_source,
    "quality_history": q_quality_history,
    "drift_history": q_drift_history,
    "quality_documents": q_quality_documents,
    "rule_documents": q_rule_documents,
    "update_reports": q_update_reports,
    "features_reloaded": q_features_reloaded,
    "registered_model": q_registered_model,
    "scoring_log_summary": q_scoring_log_summary,
    "event_profile": q_event_profile,
    "event_drift": q_event_drift,
})
