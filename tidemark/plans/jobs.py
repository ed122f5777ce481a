"""The update, inference and summary jobs.

update: number the rows not stored yet -> store pending batches -> analytics for
all pending batches in one pass each (quality, cleaning, rules, profile, drift)
-> the training loop over the pending batches in order (forest members side by side, MLP passes in order)
-> validation of all of them in one job, best model, promotion -> progress.

A batch counts as done when its last step is written (the ``progress`` table),
so a run that stops anywhere is simply started again: the open batches are
taken from the store, every table replaces exactly their rows, and training
goes on from the model version of the last finished batch.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns
from tidemark.functions.exprs import nan_to_null
from tidemark.operators import batches, clean, drift, eda, features, profile, rules, serve, train, validate
from tidemark.session import discard, materialize
from tidemark.sources.store import BatchStore


#: Batches whose forest members are grown together.
WAVE = 128


@dataclass
class PipelineConfig:
    batch_size: int = batches.DEFAULT_BATCH_SIZE
    thresholds: profile.QualityThresholds = field(default_factory=profile.QualityThresholds)
    max_missing_pct: float = clean.DEFAULT_MAX_MISSING_PCT
    rule_params: rules.RuleParams = field(default_factory=rules.RuleParams)
    drift_threshold: float = drift.DEFAULT_THRESHOLD
    feature_params: features.FeatureParams = field(default_factory=features.FeatureParams)
    train_params: train.TrainParams = field(default_factory=train.TrainParams)
    val_size: float = validate.DEFAULT_VAL_SIZE
    metric: str = "f1"
    min_batches: int = validate.DEFAULT_MIN_BATCHES
    holdout: str = "in_sample"  # in_sample (reference) | out_of_sample
    cols: Columns = DEFAULT_COLUMNS


def unseen_rows(source: DataFrame, stored: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows of ``source`` that ``stored`` doesn't hold yet (as multisets).

    Rows after the latest stored time are new as they are. Only rows at that
    very time, or without a time, are compared one by one; older rows are
    compared only if their number or the sums of their hashes show that some
    came late or were corrected."""
    source = nan_to_null(source)
    stored = stored.select(*source.columns)
    text = stored.agg(F.max(cols.time).cast("string")).first()[0]  # as text: no time zone comes in
    t = F.col(cols.time)
    if text is None:
        return source.exceptAll(stored)
    latest = F.lit(text).cast(stored.schema[cols.time].dataType)
    fresh = source.filter(t > latest)
    border = (t == latest) | t.isNull()
    fresh = fresh.unionByName(source.filter(border).exceptAll(stored.filter(border)))
    old = source.filter(t < latest)
    known = stored.filter(t < latest)

    def fingerprint(rows: DataFrame) -> tuple:
        every = [F.xxhash64(F.lit(i), *rows.columns).cast("decimal(38,0)") for i in (0, 1)]
        return tuple(rows.agg(F.count(F.lit(1)), *map(F.sum, every)).first())

    if fingerprint(old) != fingerprint(known):
        fresh = fresh.unionByName(old.exceptAll(known))
    return fresh


def pending(source: DataFrame, store: BatchStore, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """``(numbered new rows, pending batch ids)``: stored batches that aren't finished, then new ones."""
    C = cfg.cols
    raw, done = store.read("raw"), store.read("progress")
    if raw is None:
        numbered = batches.assign_batches(source, cfg.batch_size, C)
        return numbered, numbered.select(C.batch).distinct()
    row = raw.agg(F.count(F.lit(1)), F.max(C.batch), F.max(C.row)).first()
    new = batches.assign_batches(unseen_rows(source, raw, C), cfg.batch_size, C, start_row=row[2] + 1, start_batch=row[1] + 1)
    stored = raw.select(C.batch).distinct()
    opened = stored if done is None else stored.join(done.select(C.batch), C.batch, "left_anti")
    return new, opened.union(new.select(C.batch).distinct())


def run_analytics(store: BatchStore, raw: DataFrame, ids: DataFrame, cfg: PipelineConfig) -> None:
    """Every report table of the batches in ``ids``: quality, cleaning, rules, profile, drift."""
    C = cfg.cols

    def put(kind: str, df: DataFrame) -> None:
        store.write(kind, df, ids=ids)

    put("quality", profile.quality_report(raw, C, cfg.thresholds))
    put("missing", profile.missing_per_column(raw, C))
    cl = clean.clean(raw, C, cfg.max_missing_pct)
    put("clean", cl.data)
    put("dropped", cl.dropped)
    put("clean_audit", clean.clean_audit(raw, cl, C))
    data, dropped = cl.data, cl.dropped

    mined = rules.association_rules(rules.frequent_itemsets(rules.baskets(data, C), cfg.rule_params, C), cfg.rule_params, C)
    mined = materialize(mined, "rules")
    put("rules", rules.as_text(rules.top_rules(mined, cfg.rule_params.n_rules, C)))
    put("target_rules", rules.as_text(rules.target_rules(mined, cfg.rule_params.n_target_rules, C)))
    put("eda_header", eda.profile_header(data, dropped, C))
    put("eda_numeric", eda.describe_numeric(data, dropped, C))
    put("eda_top3", eda.top_categories(data, cols=C))
    put("eda_hist", eda.histogram(data, dropped, cols=C))
    put("eda_corr", eda.correlation(data, dropped, C))
    put("eda_counts", eda.category_counts(data, cols=C))
    put("eda_rate", eda.target_rate_by_category(data, C))

    feats = materialize(drift.drift_features(data, dropped, C), "drift-features")
    put("drift_features", feats)
    reference = store.read("drift_reference")
    if reference is None or not feats.filter(F.col(C.batch) == 0).isEmpty():
        store.write("drift_reference", drift.reference_features(feats, 0, C), partitioned=False)
        reference = store.read("drift_reference")
    deltas = materialize(drift.drift_deltas(feats, reference, cfg.drift_threshold, 0, C), "drift-deltas")
    put("drift", deltas)
    put("drift_summary", drift.drift_summary(deltas, C))
    discard(mined, feats, deltas)


def run_update(spark: SparkSession, source: DataFrame, root: str, cfg: PipelineConfig = PipelineConfig(),
               n_batches: int | None = 1, process_all: bool = False) -> DataFrame:
    """Process the next ``n_batches`` pending batches (all with ``process_all``).
    Returns the numbers of the batches processed, as a table."""
    C = cfg.cols
    store = BatchStore(spark, root)
    numbered, ids = pending(source, store, cfg)
    if not process_all:
        ids = ids.orderBy(C.batch).limit(n_batches or 1)
    # the ids stay a table: every step selects its rows with a semi join
    ids = materialize(ids.select(C.batch), "pending")
    if ids.isEmpty():
        return ids
    new = numbered.join(ids, C.batch, "left_semi")
    new_ids = materialize(new.select(C.batch).distinct(), "new")
    if not new_ids.isEmpty():
        store.write("raw", new, ids=new_ids)
    process(spark, store, ids, cfg)
    discard(numbered, new_ids)
    return ids


def process(spark: SparkSession, store: BatchStore, ids: DataFrame, cfg: PipelineConfig) -> None:
    """Every step after a batch's rows are stored, for the batches in ``ids``; they count as done at the end."""
    C = cfg.cols
    raw = materialize(store.read_batches("raw", ids), "raw", bucket_col=C.batch)
    store.write("batch_meta", profile.batch_meta(raw, C).withColumn("saved_at", F.current_timestamp()), ids=ids)
    run_analytics(store, raw, ids, cfg)

    data = store.read_batches("clean", ids)
    state_path = store.path("fitted_features")
    if ids.filter(F.col(C.batch) == 0).isEmpty():
        fitted = features.FittedFeatures.load(spark, state_path)
    else:
        fitted = features.fit(data.filter(F.col(C.batch) == 0), cfg.feature_params, C)
        fitted.save(spark, state_path)
    # bucketed by batch: the training loop reads one bucket for each batch
    prepared = materialize(fitted.transform(data, keep=[C.batch, C.row]), "features", bucket_col=C.batch, in_order=True)
    store.write("features", prepared, ids=ids)

    train_batches(spark, store, prepared, ids, fitted.output_columns(), cfg)
    validate_batches(spark, store, ids, cfg)
    store.write("progress", ids.withColumn("finished_at", F.current_timestamp()), ids=ids)
    discard(raw, prepared)


def train_batches(spark: SparkSession, store: BatchStore, prepared: DataFrame, ids: DataFrame, feature_cols: list[str], cfg: PipelineConfig) -> None:
    """Extend the models batch by batch (T2-T5); each batch leaves a model version and its scored holdout rows.

    The forest's members are grown ``WAVE`` batches at a time, in one job; only the MLP waits for the batch before.
    A rerun starts from the version of the last finished batch and replaces what an unfinished run left."""
    C = cfg.cols
    models = store.path("models")
    finished = store.read("progress")
    done = 0 if finished is None else finished.count()
    state = train.ModelState.load(models, done) if done else train.ModelState(feature_cols, cfg.train_params)
    numbers = (r[0] for r in ids.orderBy(C.batch).toLocalIterator())
    while wave := list(itertools.islice(numbers, WAVE)):
        rows = prepared.filter(F.col(C.batch).isin(wave))
        if cfg.holdout != "in_sample":
            rows = validate.holdout(rows, cfg.val_size, C).filter(~F.col("is_holdout")).drop("is_holdout")
        versions = state.extended([rows.filter(F.col(C.batch) == b) for b in wave], table=(rows, C.batch, wave, C.row), chained=True, root=models)
        state = versions[-1]
        train.save_versions(versions, models)
        score_holdouts(versions, wave, prepared, store.path("holdout_scores"), cfg.val_size, C)


def score_holdouts(versions: list[train.ModelState], wave: list[int], rows: DataFrame, path: str, val_size: float, cols: Columns, parallel: int = 8) -> None:
    """Write the holdout rows of each batch of ``wave`` as scored by its version (replacing an earlier try), in one job:
    a version's forest is the first trees of the last one's, and a network goes to its batch's task."""
    held = validate.holdout(rows.filter(F.col(cols.batch).isin(wave)), val_size, cols).filter("is_holdout")
    last = versions[-1]
    if last.num_features or last.arrays().value is None:  # vectors and categories are left to MLlib

        def score(x) -> None:
            score_holdout(x[0], x[1], path, x[2], cols)

        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(inheritable_thread_target(score), [(v, held.filter(F.col(cols.batch) == b), b) for v, b in zip(versions, wave, strict=True)]))
        return
    at = F.array_position(F.array(*map(F.lit, wave)), F.col(cols.batch)).cast("int")
    trees = F.element_at(F.array(*[F.lit(sum(n for _, n in v.forest)) for v in versions]), at)
    scored = last.predict_proba(held, "rf", upto=trees).select(
        F.col(cols.batch).cast("int").alias(cols.batch), "label", "p1", "prediction", F.lit("rf").alias("model"), (at + F.lit(versions[0].batch_count - 1)).alias("version"))
    scored = scored.unionByName(train.network_scores(held, cols.batch, dict(zip(wave, versions, strict=True)), cols.row).withColumn("model", F.lit("mlp")))
    scored.coalesce(parallel).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(cols.batch).parquet(path)


def score_holdout(state: train.ModelState, hold: DataFrame, path: str, batch: int, cols: Columns, names=validate.MODEL_ORDER) -> None:
    """Write one batch's holdout rows as scored by the models of its version (replacing an earlier try)."""
    scored = None
    for m in names:
        if m == "mlp" and not state.num_features:
            part = train.network_scores(hold, cols.batch, {batch: state}, cols.row)
        else:
            part = state.predict_proba(hold, m).withColumn("version", F.lit(state.batch_count))
        part = part.select("label", "p1", "prediction", F.lit(m).alias("model"), "version")
        scored = part if scored is None else scored.unionByName(part)
    scored.write.mode("overwrite").parquet(f"{path}/{cols.batch}={batch}")


def validate_batches(spark: SparkSession, store: BatchStore, ids: DataFrame, cfg: PipelineConfig) -> None:
    """V4 for all processed batches in one job, V6 over the whole history, registry and promotion."""
    C = cfg.cols
    scored = spark.read.parquet(store.path("holdout_scores")).join(ids, C.batch, "left_semi")
    metrics = validate.evaluate(scored, C)
    versions = scored.groupBy(C.batch).agg(F.max("version").alias("version"))
    metrics = metrics.join(versions, C.batch).withColumn("can_use_model", F.col(C.batch) >= cfg.min_batches)
    store.write("validation", metrics, ids=ids)
    history = store.read("validation")
    best = validate.best_model(history, cfg.metric, cfg.min_batches, cols=C).join(history.select(C.batch, "version").distinct(), C.batch).first()
    if best is None:
        return
    registry = store.path("registry")
    vdir = train.ModelState.manifest(store.path("models"), best["version"])["folder"]
    serve.register(spark, registry, "best", best["model_name"], vdir, float(best["score"]), cfg.metric, best[C.batch])
    serve.promote(spark, registry)


def scored(table: DataFrame, fitted: features.FittedFeatures, serving: serve.Serving) -> DataFrame:
    """All columns of ``table`` and ``predict``: prepared and scored, a narrow map."""
    prefix = "__f_"
    prepared = fitted.transform(table, keep=table.columns, prefix=prefix)
    found = serving.predict(prepared, [prefix + c for c in fitted.output_columns()])
    return found.select(*[F.col(c) for c in table.columns], F.col("predict").cast("int").alias("predict"))


def run_inference(spark: SparkSession, table: DataFrame, root: str, out_path: str | None = None,
                  cfg: PipelineConfig = PipelineConfig(), fmt: str = "parquet") -> DataFrame:
    """Fitted preparation (no cleaning) + production model -> ``predict``.

    All input columns are kept; with ``out_path`` the result is written once
    as Parquet or, with ``fmt="csv"``, as text with a header (S9), and the run is logged (G4)."""
    store = BatchStore(spark, root)
    fitted = features.FittedFeatures.load(spark, store.path("fitted_features"))
    serving = serve.Serving.production(spark, store.path("registry"))
    out = scored(table, fitted, serving)
    if out_path:
        serve.write_scored(out, out_path, store.path("scoring_log"), fmt)
    return out


def _report(section: str, df: DataFrame, prefix: str | None = None) -> DataFrame:
    """Every column of a report as rows ``(section, batch_index, name, value, text)``; flags go to ``text``."""
    entries = []
    for f in df.schema.fields:
        if f.name in ("batch_index", prefix):
            continue
        name = F.concat(F.col(prefix), F.lit("." + f.name)) if prefix else F.lit(f.name)
        flag = f.dataType.simpleString() == "boolean"
        entries.append(F.struct(
            name.alias("name"),
            (F.lit(None) if flag else F.col(f.name)).cast("double").alias("value"),
            (F.col(f.name) if flag else F.lit(None)).cast("string").alias("text"),
        ))
    return df.select(F.lit(section).alias("section"), F.col("batch_index").cast("int").alias("batch_index"), F.inline(F.array(*entries)))


def run_summary(spark: SparkSession, root: str) -> DataFrame:
    """The whole quality and validation histories, production model and scoring
    performance as one long table ``(section, batch_index, name, value, text)``."""
    store = BatchStore(spark, root)
    parts = []
    q = store.read("quality")
    if q is not None:
        parts.append(_report("data_quality", q))
    m = store.read("missing")
    if m is not None:
        parts.append(m.select(F.lit("missing_per_column").alias("section"), F.col("batch_index").cast("int").alias("batch_index"),
                              F.col("column_name").alias("name"), F.col("missing_count").cast("double").alias("value"),
                              F.lit(None).cast("string").alias("text")))
    v = store.read("validation")
    if v is not None:
        parts.append(_report("model_metrics", v.drop("version"), "model"))
    reg = serve.registered(spark, store.path("registry"))
    if reg is not None:
        prod = reg.filter(F.col("stage") == "production").orderBy(F.desc("number")).limit(1)
        parts.append(prod.select(F.lit("best_model").alias("section"), F.col("batch_index").cast("int"),
                                 F.col("model_name").alias("name"), F.col("score").alias("value"), F.col("metric").alias("text")))
    log = store.read("scoring_log")
    if log is not None:
        perf = serve.performance_summary(log)
        parts.append(perf.select(F.lit("performance").alias("section"), F.lit(None).cast("int").alias("batch_index"),
                                 F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"),
                                                             F.lit(None).cast("string").alias("text"))
                                                    for c in ("n_calls", "avg_elapsed_ms", "max_elapsed_ms")]))))
    if not parts:
        return spark.createDataFrame([], "section string, batch_index int, name string, value double, text string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
