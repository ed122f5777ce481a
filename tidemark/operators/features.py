"""Feature preparation fitted on one batch and applied to every batch.

Fitting reads one batch (bounded by ``batch_size`` rows) and brings back only
fitted parameters: medians, modes, sorted vocabularies (at most one entry per
fit row) and scaler statistics. ``transform`` imputes with literals, scales, and
encodes ordinals by a left join with each column's vocabulary table, of any
size: broadcast if its bytes (known exactly) are under ``BROADCAST_BYTES``,
shuffled otherwise.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns

BROADCAST_BYTES = 64 << 20


@dataclass
class FeatureParams:
    num_strategy: str = "standard"  # standard | minmax
    cat_strategy: str = "ordinal"  # ordinal | onehot


@dataclass
class FittedFeatures:
    params: FeatureParams
    numeric: list[str]
    categorical: list[str]
    target: str
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    vocab: dict[str, list[str]] = field(default_factory=dict)
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    # ------------------------------------------------------------ transform
    def output_columns(self) -> list[str]:
        if self.params.cat_strategy == "onehot":
            cats = [f"{c}_{v}" for c in self.categorical for v in self.vocab.get(c, [])]
        else:
            cats = list(self.categorical)
        return list(self.numeric) + cats

    def transform(self, df: DataFrame, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
        """Imputed, encoded and scaled features (doubles) plus ``label`` when
        the target exists; ``keep`` columns (ids, batch) pass through.
        ``prefix`` renames the feature columns (to keep raw columns beside them)."""
        keep = [c for c in (keep or []) if c in df.columns]
        out: list[Column] = [F.col(c) for c in keep]
        codes: list[tuple[Column, list[str]]] = []
        for c in self.numeric:
            v = F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
            m = self.medians.get(c)
            if m is not None:
                v = F.coalesce(v, F.lit(float(m)))
            out.append(((v - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(prefix + c))
        for c in self.categorical:
            v = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
            m = self.modes.get(c)
            if m is not None:
                v = F.coalesce(v, F.lit(m))
            vocab = self.vocab.get(c, [])
            if self.params.cat_strategy == "onehot":
                for item in vocab:
                    out.append(F.coalesce((v == F.lit(item)).cast("double"), F.lit(0.0)).alias(f"{prefix}{c}_{item}"))
            else:
                n = len(codes)
                codes.append((v.alias(f"__v{n}"), vocab))
                out.append(F.coalesce(F.col(f"__c{n}"), F.lit(-1.0)).alias(prefix + c))
        if self.target in df.columns and "label" not in keep:
            out.append(F.col(self.target).cast("double").alias("label"))
        if codes:
            df = df.select("*", *[v for v, _ in codes])
        for n, (_, vocab) in enumerate(codes):
            table = df.sparkSession.createDataFrame([(x, float(i)) for i, x in enumerate(vocab)], f"__v{n} string, __c{n} double")
            if sum(len(x) for x in vocab) * 4 + 32 * len(vocab) <= BROADCAST_BYTES:
                table = F.broadcast(table)
            df = df.join(table, f"__v{n}", "left")
        return df.select(*out)

    # ------------------------------------------------------------ sparse form (P5)
    def _coded(self, df: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str], list[tuple[str, str, int, int]]]:
        """Scaled numbers and codes by the vocabulary join; numeric columns and ``(column, code column, offset, size)`` of the others."""
        ordinal = replace(self, params=FeatureParams(self.params.num_strategy, "ordinal"))
        numbers, parts, at = ["__s_" + c for c in self.numeric], [], len(self.numeric)
        for c in self.categorical:
            n = len(self.vocab.get(c, []))
            if n:
                parts.append((c, "__s_" + c, at, n))
                at += n
        return ordinal.transform(df, keep, "__s_"), numbers, parts

    def sparse_size(self) -> int:
        return len(self.numeric) + sum(len(self.vocab.get(c, [])) for c in self.categorical)

    def transform_sparse(self, df: DataFrame, keep: list[str] | None = None, out: str = "features") -> DataFrame:
        """One-hot features as one vector column, an entry for each number and each known category, whatever the size of the vocabularies.

        A value that the vocabulary lacks has no entry. The order of the positions is that of the wide one-hot form."""
        keep = [c for c in (keep or []) if c in df.columns]
        coded, numbers, parts = self._coded(df, keep)
        label = ["label"] if "label" in coded.columns and "label" not in keep else []
        hot = []
        if parts:
            # a code of ``n`` is one too many: an invalid one, whose own place is then dropped
            index = {f"__i_{c}": F.when(F.col(code) < 0, F.lit(float(n))).otherwise(F.col(code)) for c, code, _, n in parts}
            coded = coded.withColumns(index)
            hot = ["__h_" + c for c, *_ in parts]
            sizes = df.sparkSession.createDataFrame([tuple(float(n - 1) for *_, n in parts)], [*index])
            encoder = OneHotEncoder(inputCols=[*index], outputCols=hot, handleInvalid="keep", dropLast=True).fit(sizes)
            coded = encoder.transform(coded)
        coded = VectorAssembler(inputCols=[*numbers, *hot], outputCol="__v", handleInvalid="keep").transform(coded)
        return coded.select(*keep, *label, F.col("__v").alias(out))

    def sparse_entries(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The same as rows ``(keep..., position, feature, value)``, one for each entry."""
        keep = [c for c in (keep or []) if c in df.columns]
        coded, numbers, parts = self._coded(df, keep)
        cells = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(x).alias("value")) for i, (c, x) in enumerate(zip(self.numeric, numbers))]
        for c, code, at, _ in parts:
            name = F.get(F.split(F.lit("\x00".join(self.vocab[c])), "\x00"), F.col(code).cast("int"))
            cells.append(F.struct((F.lit(at) + F.col(code).cast("int")).alias("position"), F.concat(F.lit(c + "_"), name).alias("feature"),
                                  F.when(F.col(code) >= 0, F.lit(1.0)).alias("value")))
        return coded.select(*keep, F.inline(F.array(*cells))).filter(F.col("value").isNotNull())

    # ------------------------------------------------------------ persistence
    def to_json(self) -> str:
        d = asdict(self)
        return json.dumps(d, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "FittedFeatures":
        d = json.loads(text)
        d["params"] = FeatureParams(**d["params"])
        return FittedFeatures(**d)

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "state string").coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark, path: str) -> "FittedFeatures":
        row = spark.read.json(path).first()
        if row is None:
            raise FileNotFoundError(path)
        return FittedFeatures.from_json(row["state"])


def fit(df: DataFrame, params: FeatureParams = FeatureParams(), cols: Columns = DEFAULT_COLUMNS) -> FittedFeatures:
    """Fit imputers, encoder and scaler on ``df`` (one batch).

    Order as in the reference: impute -> encode -> scale, with the scaler
    statistics taken after imputation."""
    numeric = [c for c in cols.numeric_features if c in df.columns]
    categorical = [c for c in cols.categorical_features if c in df.columns]
    first = df.agg(
        *[F.median(F.col(c).cast("double")).alias(f"m_{c}") for c in numeric],
        *[F.mode(F.col(c).cast("string"), True).alias(f"o_{c}") for c in categorical],
    ).first()
    medians = {c: first[f"m_{c}"] for c in numeric}
    modes = {c: first[f"o_{c}"] for c in categorical}
    imputed = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) if medians[c] is not None
          else F.col(c).cast("double").alias(c) for c in numeric],
        *[F.coalesce(F.col(c).cast("string"), F.lit(modes[c])).alias(c) if modes[c] is not None
          else F.col(c).cast("string").alias(c) for c in categorical],
    )
    stats_aggs = []
    for c in numeric:
        if params.num_strategy == "minmax":
            stats_aggs += [F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}")]
        else:
            stats_aggs += [F.avg(c).alias(f"a_{c}"), F.stddev_pop(c).alias(f"b_{c}")]
    vocab_aggs = [F.array_sort(F.collect_set(c)).alias(f"v_{c}") for c in categorical]
    second = imputed.agg(*stats_aggs, *vocab_aggs).first() if (stats_aggs or vocab_aggs) else None
    center, scale = {}, {}
    for c in numeric:
        a, b = second[f"a_{c}"], second[f"b_{c}"]
        if params.num_strategy == "minmax":
            center[c] = float(a) if a is not None else 0.0
            rng = (float(b) - float(a)) if a is not None and b is not None else 0.0
            scale[c] = rng if rng != 0.0 else 1.0
        else:
            center[c] = float(a) if a is not None else 0.0
            scale[c] = float(b) if b not in (None, 0.0) else 1.0
    vocab = {c: list(second[f"v_{c}"] or []) for c in categorical}
    return FittedFeatures(params, numeric, categorical, cols.target, medians, modes, vocab, center, scale)


def imputation_table(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """P2/P3 as a table: (column_name, numeric_fill, text_fill), one aggregate."""
    numeric = [c for c in cols.numeric_features if c in df.columns]
    categorical = [c for c in cols.categorical_features if c in df.columns]
    wide = df.agg(
        *[F.median(F.col(c).cast("double")).alias(f"m_{c}") for c in numeric],
        *[F.mode(F.col(c).cast("string"), True).alias(f"o_{c}") for c in categorical],
    )
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("numeric_fill"),
                        F.lit(None).cast("string").alias("text_fill")) for c in numeric]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("double").alias("numeric_fill"),
                         F.col(f"o_{c}").alias("text_fill")) for c in categorical]
    return wide.select(F.inline(F.array(*entries)))


def to_long(features: DataFrame, value_cols: list[str], keys: list[str], digits: int | None = 4) -> DataFrame:
    """(keys..., feature, value) form of a wide feature table."""
    long = features.unpivot(keys, value_cols, "feature", "value")
    if digits is not None:
        long = long.withColumn("value", F.round("value", digits))
    return long
