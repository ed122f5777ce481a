"""Class weights, a growing random forest and a warm-started MLP (MLlib).

MLlib has no warm start for forests: each later batch fits a new small forest
whose trees are added to those before. Scoring puts all trees into one model
(MLlib averages its trees' class distributions), so it is one pass whatever the
number of batches; its nodes go to the tasks as arrays (``TreeArrays``), each tree
is walked by all rows of a batch of Arrow at once, and a row may be given the first
trees only. The MLP continues from the previous weights with one more pass per batch.

A forest member depends on its own batch and on batch 0's class weights only, so
members of many batches are fitted side by side (``forest_members``) and attached
in order; the MLP's passes follow one another, each one job (``operators.passes``). The data of one fit is one batch,
which fits in one partition by construction, and scoring is a narrow map over
any table. A batch of one class is no special case: the label column names both
classes.
"""

from __future__ import annotations

import copy
import itertools
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext, inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import passes, trees
from tidemark.operators.passes import Packed
from tidemark.session import delete_path, scratch_path
from tidemark.sources.commits import CommitLog, ConflictError

NETWORKS = "version int, weights array<double>"
AHEAD = 32  # batches that are read together for the MLP's passes

@dataclass(frozen=True)
class TrainParams:
    # Default model sizes.
    rf_trees: int = 100
    rf_new_trees: int = 20
    rf_depth: int = 10
    mlp_layers: tuple[int, ...] = (64, 32)
    seed: int = 42


class NotFittedError(RuntimeError):
    pass


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_class)`` for the k classes present."""
    from pyspark.sql import Window

    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("long").alias("count"))
    every = Window.partitionBy()  # over the per-class counts: at most a few rows
    tot = counts.withColumn("__n", F.sum("count").over(every)).withColumn("__k", F.count(F.lit(1)).over(every))
    return tot.select(
        F.col(label).alias("label"), "count",
        (F.col("__n").cast("double") / (F.col("__k").cast("double") * F.col("count").cast("double"))).alias("weight"),
    )


def assemble(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep").transform(df)


class Forest(RandomForestClassificationModel):
    """MLlib's forest. PySpark looks for a model's parameters in all its attributes but properties; ``trees`` is none
    there, so each fit, copy and load would wrap every tree in Python."""

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return [DecisionTreeClassificationModel(m) for m in self._call_java("trees")]

    @classmethod
    def load(cls, path: str) -> "Forest":
        package = SparkContext.getOrCreate()._jvm.org.apache.spark.ml.classification  # a thread may have no active session
        model = cls(package.RandomForestClassificationModel.load(path))
        model._transfer_params_from_java()
        return model


class StoredForest:
    """A forest that ``trees.grow`` has grown: one row of the table at ``path``. MLlib's form is made when it is asked for."""

    numClasses = 2

    def __init__(self, path: str, number: int, trees: int, features: int) -> None:
        self.path, self.number, self.numFeatures, self._trees, self._model = path, number, features, trees, None

    @property
    def getNumTrees(self) -> int:
        return self._trees

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return self.mllib().trees

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.mllib(), name)

    def mllib(self) -> RandomForestClassificationModel:
        if self._model is None:
            from tidemark.operators import model_tables

            t = stored_arrays([self])
            inner = t.child[0::2] != np.arange(len(t.feature))
            tree = np.repeat(np.arange(len(t.root)), np.diff(np.append(t.root, len(t.feature))))
            place = np.arange(len(tree)) - t.root[tree]
            sides = [np.where(inner, t.child[k::2] - t.root[tree], -1) for k in (0, 1)]
            nodes = pd.DataFrame({"tree": tree, "node": place, "feature": np.where(inner, t.feature, -1), "threshold": t.threshold, "left": sides[0], "right": sides[1], "weights": list(t.stats)})
            self._model = model_tables.forest_to_mllib(SparkSession.getActiveSession().createDataFrame(nodes, model_tables.NODES), self.numFeatures)
        return self._model


class ForestClassifier(RandomForestClassifier):
    def _create_model(self, java_model) -> Forest:
        return Forest(java_model)


def merged_forest(members: list[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One model of all trees of the members."""
    if len(members) == 1:
        return members[0]
    sc = SparkSession.getActiveSession().sparkContext
    package = sc._jvm.org.apache.spark.ml.classification
    parts = [m._java_obj.trees() for m in members]
    sizes = [len(p) for p in parts]
    array = sc._gateway.new_array(package.DecisionTreeClassificationModel, sum(sizes))
    for i, part in enumerate(parts):  # one call for each member, not for each tree
        sc._jvm.java.lang.System.arraycopy(part, 0, array, sum(sizes[:i]), sizes[i])
    uid = f"{members[0].uid}_{sum(sizes)}"
    return Forest(package.RandomForestClassificationModel(uid, array, members[0].numFeatures, members[0].numClasses))


class Network:
    """A network given by its weights and one like it, or its layers. MLlib's form is made when it is asked for."""

    def __init__(self, like: MultilayerPerceptronClassificationModel | list[int], values: np.ndarray) -> None:
        self.like, self.values, self._model = like, values, None

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        self._model = self._model or with_weights(self.like, self.values)
        return getattr(self._model, name)


def with_weights(model: MultilayerPerceptronClassificationModel | Network, weights: np.ndarray) -> MultilayerPerceptronClassificationModel:
    """A model like the one given, with other weights."""
    model = model.like if isinstance(model, Network) else model
    sc, out = SparkContext.getOrCreate(), copy.copy(model)
    kind = getattr(sc._jvm, "org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel")
    if isinstance(model, list):
        java = kind(f"mlpc_{uuid.uuid4().hex[:12]}", _py2java(sc, Vectors.dense(weights)))
        out = MultilayerPerceptronClassificationModel(java.set(java.layers(), passes.java_ints(sc, model)))
        out._transfer_params_from_java()
        return out
    out._java_obj = model._java_obj.copyValues(kind(model.uid, _py2java(sc, Vectors.dense(weights))), model._empty_java_param_map())
    out._paramMap, out._defaultParamMap = dict(model._paramMap), dict(model._defaultParamMap)
    return out


def weights_of(mlp: MultilayerPerceptronClassificationModel | Network) -> np.ndarray:
    return mlp.values if isinstance(mlp, Network) else mlp.weights.toArray()


@dataclass
class TreeArrays:
    """The nodes of a forest: a leaf is its own child, ``child`` lists left and right, ``share`` the classes' shares."""

    root: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    share: np.ndarray
    stats: np.ndarray

    @staticmethod
    def made(root: np.ndarray, feature: np.ndarray, threshold: np.ndarray, child: np.ndarray, stats: np.ndarray) -> "TreeArrays":
        """``child``: left and right of each node, itself for a leaf; ``stats``: the classes' weights of each node."""
        total = stats[:, 0] + stats[:, 1]
        share = np.where(total[:, None] != 0, stats / np.where(total == 0, 1.0, total)[:, None], 0.0)
        inner = child[:, 0] != np.arange(len(child))
        depth, level, tree = np.zeros(len(root), np.int64), root, np.arange(len(root))
        while (go := inner[level]).any():
            level, tree = child[level[go]].ravel(), np.repeat(tree[go], 2)
            depth[np.unique(tree)] += 1
        return TreeArrays(root, depth, np.maximum(feature, 0), threshold, child.ravel(), np.ascontiguousarray(share.T), stats)

    @staticmethod
    def joined(parts: Sequence["TreeArrays"]) -> "TreeArrays":
        """One forest of all of their trees."""
        if len(parts) == 1:
            return parts[0]
        at = np.cumsum([0] + [len(p.feature) for p in parts[:-1]])
        join = lambda name, axis=0: np.concatenate([getattr(p, name) for p in parts], axis)
        return TreeArrays(np.concatenate([p.root + n for p, n in zip(parts, at, strict=True)]), join("depth"), join("feature"), join("threshold"),
                          np.concatenate([p.child + n for p, n in zip(parts, at, strict=True)]), join("share", 1), join("stats"))

    @staticmethod
    def of(model: RandomForestClassificationModel) -> "TreeArrays | None":
        """Read from the stored form; None if a split is one of categories."""
        spark = SparkSession.getActiveSession()
        path = scratch_path(spark, "forest-arrays")
        model.write().save(path)
        n = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("nodeData.split.numCategories").alias("kinds"),
            F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"), F.col("nodeData.impurityStats").alias("stats"),
        ).toArrow()  # the model: it goes to every task
        delete_path(spark, path)
        tree, node, feature, kinds, left, right = (n[c].to_numpy().astype(np.int64) for c in ("tree", "node", "feature", "kinds", "left", "right"))
        stats = n["stats"].combine_chunks()
        if (kinds != -1).any() or not len(tree) or len(stats.flatten()) != 2 * len(tree):
            return None
        order = np.lexsort((node, tree))
        tree, node, feature, left, right = (x[order] for x in (tree, node, feature, left, right))
        threshold = n["threshold"].to_numpy().astype(float)[order]  # of leaves: NaN, and both children are the leaf
        stats = stats.flatten().to_numpy().reshape(-1, 2)[order]
        root = np.searchsorted(tree, np.arange(tree[-1] + 1))
        here, inner = np.arange(len(tree)), left >= 0
        child = np.where(inner[:, None], root[tree][:, None] + np.stack([left, right], 1), here[:, None])
        return TreeArrays.made(root, feature, threshold, child, stats)

    @staticmethod
    def grown(g: trees.Grown) -> "TreeArrays":
        here, inner = np.arange(len(g.left)), g.left >= 0
        child = np.where(inner[:, None], np.stack([g.left, g.right], 1), here[:, None]).astype(np.int64)
        return TreeArrays.made(g.root.astype(np.int64), g.feature.astype(np.int64), g.threshold, child, g.stats.reshape(-1, 2))

    def p1(self, x: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """P(class 1) of the rows of ``x``, each by its first ``upto`` trees, whose votes are added in order as MLlib adds them."""
        order = np.argsort(upto, kind="stable")
        n, upto = len(x), upto[order]
        values, every, base = np.ascontiguousarray(x[order].T).ravel(), np.arange(n), self.feature * n
        first = np.searchsorted(upto, np.arange(len(self.root)), side="right")  # the first row that has the tree
        votes = np.zeros((2, n))
        for i, lo in enumerate(first[first < n]):
            node = np.full(n - lo, self.root[i])
            for _ in range(self.depth[i]):
                right = ~(values.take(base.take(node) + every[lo:]) <= self.threshold.take(node))  # missing values go right
                node = self.child.take(2 * node + right)
            votes[:, lo:] += self.share.take(node, axis=1)
        total = votes[0] + votes[1]
        out = np.empty(n)
        out[order] = np.where(total != 0, votes[1] / np.where(total == 0, 1.0, total), 0.0)
        return out


def stored_arrays(members: Sequence[StoredForest]) -> TreeArrays:
    """The arrays of members that lie in tables, in their order."""
    spark, found = SparkSession.getActiveSession(), {}
    for path, some in itertools.groupby(members, key=lambda m: m.path):
        table = spark.read.schema(trees.MEMBER).parquet(path).filter(F.col("number").isin([m.number for m in some])).toArrow()  # the model: it goes to every task
        for i, number in enumerate(table["number"].to_pylist()):
            root, feature, threshold, left, right, stats = (table[c][i].values.to_numpy(zero_copy_only=False) for c in table.column_names[1:])
            found[path, number] = TreeArrays.grown(trees.Grown(root, feature, threshold, left, right, stats.reshape(-1, 2)))
    return TreeArrays.joined([found[m.path, m.number] for m in members])


@dataclass
class ModelState:
    """The two incrementally trained models of the pipeline."""

    feature_cols: list[str]
    params: TrainParams = field(default_factory=TrainParams)
    weights: dict[float, float] = field(default_factory=dict)
    forest: list[tuple[RandomForestClassificationModel, int]] = field(default_factory=list)
    mlp: MultilayerPerceptronClassificationModel | None = None
    batch_count: int = 0
    member_paths: list[str | None] = field(default_factory=list)
    num_features: int = 0  # if the features are vector columns: their sizes' sum
    _merged: RandomForestClassificationModel | None = field(default=None, repr=False)
    _arrays: tuple | None = field(default=None, repr=False)  # the merged forest's arrays, broadcast
    _known: tuple[int, TreeArrays] | None = field(default=None, repr=False)  # those of the first members

    # ----------------------------------------------------------------- fit
    def _data(self, batch: DataFrame) -> DataFrame:
        """Features, label and weight of one batch: at most batch_size rows, so one partition and no task overhead in MLlib's many passes."""
        w = F.lit(1.0)
        for lab, wt in self.weights.items():
            w = F.when(F.col("label") == lab, F.lit(wt)).otherwise(w)
        both = {"ml_attr": {"name": "label", "type": "nominal", "vals": ["0", "1"]}}  # a batch may lack one of the classes
        batch = batch.select(*self.feature_cols, "label").coalesce(1)
        return assemble(batch, self.feature_cols).select("features", F.col("label").alias("label", metadata=both), w.alias("__w"))

    def weigh(self, batch: DataFrame) -> None:
        """Class weights from the first batch."""
        rows = class_weights(batch.select("label")).collect()  # at most two rows
        self.weights = {float(r["label"]): float(r["weight"]) for r in rows}

    def forest_member(self, batch: DataFrame, number: int) -> RandomForestClassificationModel:
        """The trees that batch ``number`` adds."""
        data = self._cached(batch)
        try:
            return self._grown(data, number)
        finally:
            data.unpersist()

    def _grown(self, data: DataFrame, number: int) -> RandomForestClassificationModel:
        return ForestClassifier(
            numTrees=self.params.rf_new_trees if number else self.params.rf_trees, maxDepth=self.params.rf_depth, weightCol="__w",
            seed=self.params.seed + number, labelCol="label", featuresCol="features",
        ).fit(data)

    def forest_members(self, batches: Sequence[DataFrame], parallel: int = 8) -> list[RandomForestClassificationModel | StoredForest]:
        """The members of the next batches."""
        return [v.forest[-1][0] for v in self.extended(batches, ("rf",), parallel)]

    def extended(
        self, batches: Sequence[DataFrame], models: tuple[str, ...] = ("rf", "mlp"), parallel: int = 8, table: tuple | None = None, chained: bool = False, root: str | None = None,
    ) -> list["ModelState"]:
        """The versions after each of the next batches. The members are grown in one job, a task each, with the MLP's passes
        one after the other beside it. ``table``: the rows that hold all of the batches, their key, each batch's value of it and
        (if the rows have an order) the column to sort by; with it many batches are read at once. ``chained``: passes that follow
        one another share a job. ``root``: where the members are stored, as in ``save``."""
        if self.batch_count == 0 and batches:
            self.weigh(batches[0])
        versions, last = [], self
        with ThreadPoolExecutor(parallel) as pool:
            members = self._members(batches, table, root, pool) if "rf" in models else []
            for mlp in self._passes(batches, table, chained) if "mlp" in models else itertools.repeat(self.mlp, len(batches)):
                last = replace(last, mlp=mlp, batch_count=last.batch_count + 1, _merged=None, _arrays=None)
                versions.append(last)
            done = members() if members else []
        for i, v in enumerate(versions):
            v.forest = self.forest + [(m, m.getNumTrees) for m in done[:i + 1]]
            v.member_paths = self.member_paths + [f"{m.path}#{m.number}" if root and isinstance(m, StoredForest) else None for m in done[:i + 1]]
        return versions

    def _members(self, batches: Sequence[DataFrame], table: tuple | None, root: str | None, pool: ThreadPoolExecutor) -> Callable[[], list]:
        """Start fitting the members of the next batches; the function returned waits for them."""
        if not batches:
            return list
        numbers = range(self.batch_count, self.batch_count + len(batches))
        if self.num_features or any("ml_attr" in batches[0].schema[c].metadata for c in self.feature_cols):  # vectors and categories are left to MLlib
            fits = [pool.submit(inheritable_thread_target(self.forest_member), x, i) for x, i in zip(batches, numbers, strict=True)]
            return lambda: [f.result() for f in fits]
        spark = batches[0].sparkSession
        path = f"{root.rstrip('/')}/members/grown_{numbers[0]:06d}-{uuid.uuid4().hex[:8]}" if root else scratch_path(spark, "grown")
        job = pool.submit(inheritable_thread_target(self._grow), batches, numbers, table, path)

        def wait() -> list[StoredForest]:
            job.result()
            return [StoredForest(path, i, self._size(i), len(self.feature_cols)) for i in numbers]

        return wait

    def _size(self, number: int) -> int:
        return self.params.rf_new_trees if number else self.params.rf_trees

    def _grow(self, batches: Sequence[DataFrame], numbers: Sequence[int], table: tuple | None, path: str) -> None:
        """T2/T3 in one job: the forests of the batches ``numbers``, a task each, written as a row each."""
        cols, weights, params = self.feature_cols, dict(self.weights), self.params
        if table:
            rows, key, names, *order = table
        else:
            key, names, order = "__batch", numbers, ["__order"]
            rows = reduce(DataFrame.unionByName, [x.select(*cols, "label").coalesce(1).select("*", F.lit(i).cast("long").alias(key), F.monotonically_increasing_id().alias("__order")) for i, x in zip(numbers, batches, strict=True)])
        rows = rows.select(key, *order, *[F.col(c).cast("double") for c in cols], F.col("label").cast("double").alias("label"))
        held = dict(map(tuple, rows.filter(F.col(key).isin(list(names))).groupBy(key).count().collect()))
        if missing := [b for b in names if b not in held]:
            raise ValueError(f"batches without rows: {missing}")
        place = dict(zip(names, numbers, strict=True))
        with ThreadPoolExecutor(8) as pool:
            drawn = pool.map(inheritable_thread_target(lambda b: trees.draws(params.seed + place[b], held[b], self._size(place[b]))), names)
        taken = rows.sparkSession.sparkContext.broadcast(dict(zip(names, drawn, strict=True)))

        def run(name: int, batch: pa.Table) -> pa.RecordBatch:
            x, label = trees.matrix(batch, cols, order)
            weight = np.array([weights.get(v, 1.0) for v in (0.0, 1.0)])[(label == 1).astype(int)]
            return trees.grow(x, label, weight, taken.value[name], params.seed + place[name], params.rf_depth).row(place[name])

        trees.one_task_each(rows, key, names, run, trees.MEMBER).write.parquet(path)
        taken.unpersist()

    def _cached(self, batch: DataFrame) -> DataFrame:
        from pyspark import StorageLevel

        data = self._data(batch).persist(StorageLevel.MEMORY_AND_DISK)
        data.count()  # here, so that it may run beside another fit
        return data

    def _layers(self) -> list[int]:
        return [self.num_features or len(self.feature_cols), *self.params.mlp_layers, 2]

    def _mlp(self, data: DataFrame, mlp: MultilayerPerceptronClassificationModel | None = None) -> MultilayerPerceptronClassificationModel:
        """T4: a fit of one iteration by MLlib, from the weights of ``mlp`` if it is given."""
        trainer = MultilayerPerceptronClassifier(layers=self._layers(), maxIter=1, seed=self.params.seed, labelCol="label", featuresCol="features")
        if mlp is not None:
            trainer.setInitialWeights(mlp.weights)
        return trainer.fit(data)

    def _passes(self, batches: Sequence[DataFrame], table: tuple | None = None, chained: bool = False) -> Iterator[MultilayerPerceptronClassificationModel]:
        """T4/T5: the MLP after each of the next batches, one more pass each, while the ``AHEAD`` batches after them are read."""
        def fitted(batch: DataFrame) -> MultilayerPerceptronClassificationModel:
            data = self._cached(batch)
            try:
                return self._mlp(data, mlp)
            finally:
                data.unpersist()

        mlp, names = self.mlp, table[2] if table else range(len(batches))
        if mlp is None and batches:
            mlp = fitted(batches[0])
            yield mlp
            names, batches = names[1:], batches[1:]
        if not batches:
            return
        ahead_by = AHEAD * (4 if chained else 1)
        starts, weights = range(0, len(batches), ahead_by), weights_of(mlp)

        def read(start: int) -> Packed:
            some = slice(start, start + ahead_by)
            if table:
                rows = table[0].filter(F.col(table[1]).isin(list(names[some])))
                key = table[1]
            else:
                key = "__batch"
                rows = reduce(DataFrame.unionByName, [x.select(*self.feature_cols, "label", F.lit(i).alias(key)).coalesce(1) for i, x in zip(names[some], batches[some], strict=True)])
            order = list(table[3:]) if table else []
            return Packed.of(assemble(rows.select(key, *order, *self.feature_cols, "label"), self.feature_cols), key, order)

        with ThreadPoolExecutor(1) as ahead:
            coming = ahead.submit(inheritable_thread_target(read), 0)
            for start in starts:
                data = coming.result()
                if start + ahead_by < len(batches):
                    coming = ahead.submit(inheritable_thread_target(read), start + ahead_by)
                try:
                    here = names[start:start + ahead_by]
                    if chained and all(name in data.where for name in here):
                        for weights in data.walked(here, self._layers(), weights):
                            mlp = Network(mlp.like if isinstance(mlp, Network) else mlp, weights)
                            yield mlp
                        continue
                    for name, batch in zip(here, batches[start:start + ahead_by], strict=True):
                        if name not in data.where:  # no rows
                            mlp = fitted(batch)
                            weights = mlp.weights.toArray()
                        else:
                            weights = data.stepped(name, self._layers(), weights)
                            mlp = with_weights(mlp, weights)
                        yield mlp
                finally:
                    data.drop()

    def fit(self, batch: DataFrame, models: tuple[str, ...] = ("rf", "mlp"), member: RandomForestClassificationModel | None = None) -> "ModelState":
        """T2/T4 on the first call, T3/T5 afterwards. ``batch`` holds the
        feature columns and ``label``; ``models`` names those to fit; ``member``
        is the forest's part if it is fitted already."""
        if self.batch_count == 0:
            self.weigh(batch)
        data = self._cached(batch)
        try:
            if "rf" in models:
                member = member or self._grown(data, self.batch_count)
                self.forest.append((member, member.getNumTrees))
                self.member_paths.append(None)
                self._merged = self._arrays = None
            if "mlp" in models:
                self.mlp = self._mlp(data) if self.mlp is None else list(self._passes([batch]))[-1]
        finally:
            data.unpersist()
        self.batch_count += 1
        return self

    # ----------------------------------------------------------------- score
    def _get(self, name: str):
        if name == "rf":
            if not self.forest:
                raise NotFittedError("random forest is not fitted")
            return self.forest
        if name == "mlp":
            if self.mlp is None:
                raise NotFittedError("MLP is not fitted")
            return self.mlp
        raise ValueError(f"unknown model: {name}; available: rf, mlp")

    def arrays(self):
        """The broadcast arrays of the merged forest (of None if MLlib has to walk it)."""
        if self._arrays is None:
            members = [f for f, _ in self._get("rf")]
            n, parts = (self._known[0], [self._known[1]]) if self._known else (0, [])
            for stored, some in itertools.groupby(members[n:], key=lambda m: isinstance(m, StoredForest)):
                parts.append(stored_arrays(list(some)) if stored else TreeArrays.of(merged_forest(list(some))))
            found = None if any(p is None for p in parts) else TreeArrays.joined(parts)
            self._known = (len(members), found) if found is not None else None
            self._arrays = SparkSession.getActiveSession().sparkContext.broadcast(found)
        return self._arrays

    def predict_proba(self, df: DataFrame, model: str = "rf", feature_cols: list[str] | None = None, upto: Column | None = None) -> DataFrame:
        """Adds ``p1`` = P(class 1) and ``prediction`` (argmax, class 0 on ties).
        ``feature_cols`` names the input columns when they carry a prefix. ``upto``: each row's number of trees, the first ones."""
        m = self._get(model)
        data = assemble(df, feature_cols or self.feature_cols)
        if model == "rf":
            if (len(m) > 1 or upto is not None or isinstance(m[0][0], StoredForest)) and self.arrays().value is not None:
                trees = self._arrays

                @F.pandas_udf("double")
                def p1(x: pd.Series, upto: pd.Series) -> pd.Series:
                    return pd.Series(trees.value.p1(np.stack(x.to_numpy()), upto.to_numpy()) if len(x) else [], dtype="float64")

                upto = F.lit(len(trees.value.root)) if upto is None else upto
                out = data.withColumn("p1", p1(vector_to_array("features"), upto.cast("long")))
                return out.drop("features").withColumn("prediction", F.when(F.col("p1") > 0.5, 1).otherwise(0))
            if upto is not None:
                raise ValueError("a forest with splits of categories is scored whole")
            m = self._merged = self._merged or merged_forest([f for f, _ in m])
        out = m.setProbabilityCol("__prob").setPredictionCol("__pred").setRawPredictionCol("__raw").transform(data)
        out = out.withColumn("p1", vector_to_array("__prob")[1]).drop("__prob", "__pred", "__raw")
        return out.drop("features").withColumn("prediction", F.when(F.col("p1") > 0.5, 1).otherwise(0))

    def predict(self, df: DataFrame, model: str = "rf", feature_cols: list[str] | None = None) -> DataFrame:
        return self.predict_proba(df, model, feature_cols)

    # ----------------------------------------------------------------- store
    def save_members(self, path: str, parallel: int = 8) -> None:
        """Store the members that aren't stored yet, ``parallel`` at a time; ``save`` then finds them written."""
        root, attempt = path.rstrip("/"), uuid.uuid4().hex[:8]
        self.member_paths = [None] * (len(self.forest) - len(self.member_paths)) + list(self.member_paths)
        new, spark = [i for i, p in enumerate(self.member_paths) if p is None], SparkSession.getActiveSession()  # threads have none

        def put(i: int) -> str:
            if isinstance(m := self.forest[i][0], StoredForest):  # grown without a place to stay
                to = f"{root}/members/grown_{self.batch_count:06d}_{i:04d}-{attempt}"
                spark.read.schema(trees.MEMBER).parquet(m.path).filter(F.col("number") == m.number).write.parquet(to)
                return f"{to}#{m.number}"
            to = f"{root}/members/rf_{self.batch_count:06d}_{i:04d}-{attempt}"
            self.forest[i][0].write().save(to)
            return to

        with ThreadPoolExecutor(parallel) as pool:
            for i, to in zip(new, pool.map(inheritable_thread_target(put), new), strict=True):
                self.member_paths[i] = to

    def save(self, path: str) -> str:
        """Store version ``batch_count`` under ``path``; returns the version's folder.

        Models are written to folders of their own first; the version exists once
        its manifest is appended to the log ``_versions``, in one rename. A run that is
        killed between any two writes leaves the versions before. Forest members are
        written once (``members/``) and each manifest lists those it uses, so
        saving stays linear in the number of batches."""
        vdir = self._put(path)
        self._append(path, vdir)
        return vdir

    def _put(self, path: str, mlp: bool = True) -> str:
        """Write the models of this version (``mlp``: the network, too); returns its folder."""
        vdir = f"{path.rstrip('/')}/version={self.batch_count:06d}-{uuid.uuid4().hex[:8]}"
        self.save_members(path)
        if mlp and self.mlp is not None:
            self.mlp.write().save(f"{vdir}/mlp")
        return vdir

    def _append(self, path: str, vdir: str, mlp_at: str | None = None, after: int | None = None) -> int:
        """Commit the version; returns the entry's number."""
        manifest = {
            "version": self.batch_count, "folder": vdir,
            "feature_cols": self.feature_cols, "params": asdict(self.params),
            "weights": {str(k): v for k, v in self.weights.items()},
            "forest_trees": [n for _, n in self.forest], "member_paths": list(self.member_paths),
            "num_features": self.num_features, "batch_count": self.batch_count, "has_mlp": self.mlp is not None, "mlp_at": mlp_at,
        }
        return CommitLog(SparkSession.getActiveSession(), f"{path.rstrip('/')}/_versions").append(manifest, after)

    @staticmethod
    def manifest(path: str, version: int | None = None, folder: str | None = None) -> dict:
        """The newest manifest; that of ``version`` or of the version in ``folder`` if they are given."""
        log = CommitLog(SparkSession.getActiveSession(), f"{path.rstrip('/')}/_versions")
        found = log.newest(lambda m: (version is None or m["version"] == version) and (folder is None or m["folder"] == folder))
        if found is None:
            raise FileNotFoundError(f"no saved models in {path}" if version is None else f"no version {version} in {path}")
        return found[1]

    @staticmethod
    def load(path: str, version: int | None = None, folder: str | None = None) -> "ModelState":
        man = ModelState.manifest(path, version, folder)
        p = man["params"]
        p["mlp_layers"] = tuple(p["mlp_layers"])
        st = ModelState(man["feature_cols"], TrainParams(**p), num_features=man.get("num_features", 0))
        st.weights = {float(k): v for k, v in man["weights"].items()}
        st.member_paths = list(man["member_paths"])
        def member(at: str, n: int) -> RandomForestClassificationModel | StoredForest:
            folder, stored, number = at.partition("#")
            return StoredForest(folder, int(number), n, len(st.feature_cols)) if stored else Forest.load(folder)

        with ThreadPoolExecutor(8) as pool:
            members = list(pool.map(inheritable_thread_target(member), st.member_paths, man["forest_trees"]))
        st.forest = list(zip(members, man["forest_trees"], strict=True))
        if at := man.get("mlp_at"):  # a row of a table
            folder, _, number = at.partition("#")
            row = SparkSession.getActiveSession().read.schema(NETWORKS).parquet(folder).filter(F.col("version") == int(number)).first()
            st.mlp = Network(st._layers(), np.array(row["weights"]))
        else:
            st.mlp = MultilayerPerceptronClassificationModel.load(f"{man['folder']}/mlp") if man["has_mlp"] else None
        st.batch_count = man["batch_count"]
        return st


def network_scores(rows: DataFrame, key: str, versions: dict[int, ModelState], order: str) -> DataFrame:
    """Rows of many batches (values of ``key``), each as the MLP of its version scores it: ``key, label, p1, prediction, version``."""
    cols, layers = next(iter(versions.values())).feature_cols, next(iter(versions.values()))._layers()
    known = rows.sparkSession.sparkContext.broadcast({b: (v.batch_count, weights_of(v._get("mlp"))) for b, v in versions.items()})

    def run(name: tuple, part: pa.Table) -> pa.Table:
        (x, label), (version, weights) = trees.matrix(part, cols, [order]), known.value[name[0].as_py()]
        p1 = passes.forward(layers, weights, x)[1][-1][:, 1]
        return pa.table({key: part[key].cast(pa.int32()), "label": label, "p1": p1, "prediction": pa.array(p1 > 0.5).cast(pa.int32()), "version": np.full(len(x), version, np.int32)})

    rows = rows.select(F.col(key).cast("int").alias(key), order, *[F.col(c).cast("double") for c in cols], F.col("label").cast("double").alias("label"))
    return rows.groupBy(key).applyInArrow(run, f"{key} int, label double, p1 double, prediction int, version int")


def save_versions(versions: Sequence[ModelState], path: str, parallel: int = 8) -> None:
    """``save`` of versions that follow one another: what passes of one job have made goes into one table, other models are
    written side by side, and the versions are appended in order."""
    if not versions:
        return
    versions[-1].save_members(path)
    for v in versions:
        v.member_paths = versions[-1].member_paths[:len(v.forest)]
    networks = [(v.batch_count, v.mlp.values.tolist()) for v in versions if isinstance(v.mlp, Network)]  # some thousand weights each
    table = f"{path.rstrip('/')}/networks/{versions[0].batch_count:06d}-{uuid.uuid4().hex[:8]}"
    if networks:
        SparkSession.getActiveSession().createDataFrame(networks, NETWORKS).coalesce(1).write.parquet(table)
    stored = {n: f"{table}#{n}" for n, _ in networks}
    with ThreadPoolExecutor(parallel) as pool:
        folders = list(pool.map(inheritable_thread_target(lambda v: v._put(path, v.batch_count not in stored)), versions))
    last = None
    for v, folder in zip(versions, folders, strict=True):
        try:
            last = v._append(path, folder, stored.get(v.batch_count), last)  # without a look at all entries for each
        except ConflictError:
            if last is None:
                raise
            last = v._append(path, folder, stored.get(v.batch_count))


def fresh_scores(rows: DataFrame, key: str, names: Sequence[int], order: str, feature_cols: Sequence[str], params: TrainParams, taken: Broadcast) -> DataFrame:
    """The models of ``ModelState.fit`` for each of the parts named, fitted to its rows of ``role`` train, and its other rows as
    they score them: ``key, label, p1, prediction, model``. A task for each part; ``taken``: the draws of a first forest."""
    cols, layers = list(feature_cols), [len(feature_cols), *params.mlp_layers, 2]
    start = passes.first_weights(layers, params.seed)

    def run(name: int, part: pa.Table) -> pa.RecordBatch:
        own = pc.equal(part["role"], "train")
        (x, label), (rest, truth) = (trees.matrix(part.filter(some), cols, [order]) for some in (own, pc.invert(own)))
        positive = int((label == 1).sum())
        counts = [n for n in (len(label) - positive, positive) if n]
        weight = np.where(label == 1, len(label) / (len(counts) * max(positive, 1)), len(label) / (len(counts) * max(len(label) - positive, 1)))
        forest = TreeArrays.grown(trees.grow(x, label, weight, taken.value[:len(x)], params.seed, params.rf_depth))
        rf = forest.p1(rest, np.full(len(rest), len(forest.root)))
        mlp = passes.forward(layers, passes.step(passes.Network(layers, x, label), start), rest)[1][-1][:, 1]
        p1, n = np.concatenate([rf, mlp]), len(rest)
        columns = [pa.array(np.full(2 * n, name), pa.int64()), np.tile(truth, 2), p1, pa.array(p1 > 0.5).cast(pa.int32()), ["rf"] * n + ["mlp"] * n]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [key, "label", "p1", "prediction", "model"])

    rows = rows.select(F.col(key).cast("long").alias(key), order, "role", *[F.col(c).cast("double") for c in cols], F.col("label").cast("double").alias("label"))
    return trees.one_task_each(rows, key, names, run, f"{key} long, label double, p1 double, prediction int, model string")
