"""One verb to train, with the split, the preprocessing and the schema kept with the model."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, FeatureHasher, Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector, VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.leakage import Feature, refuse_leaks
from ..session import staged
from . import evaluate as ev
from .split import split
from .target_encoding import FOLDS, MISSING, SMOOTHING, encoded, target_means

REGRESSORS = ("LINEAR_REG", "BOOSTED_TREE_REGRESSOR", "RANDOM_FOREST_REGRESSOR")
CLASSIFIERS = ("LOGISTIC_REG", "BOOSTED_TREE_CLASSIFIER", "RANDOM_FOREST_CLASSIFIER", "DNN_CLASSIFIER")
UNSUPERVISED = ("KMEANS", "PCA")
TREES = tuple(t for t in REGRESSORS + CLASSIFIERS if "TREE" in t or "FOREST" in t)

# How categories become numbers, by name and never by their number: one slot each, HASH_SLOTS hashed slots, or means of the answer.
ENCODINGS = ("one_hot", "hash", "target")
HASH_SLOTS = 1_024
# Fixed value: numbers of clusters tried when none is given.
CLUSTER_COUNTS = (3, 4, 5, 6, 8)


class SchemaError(TypeError):
    """The rows to predict do not have the columns the model was trained on."""


@dataclass
class Model:
    """A fitted pipeline and everything needed to use it on other rows."""

    kind: str
    label: str | None
    features: list[tuple[str, str]]
    options: dict
    pipeline: PipelineModel
    classes: list = field(default_factory=list)
    slots: list[tuple[str, int]] = field(default_factory=list)  # (feature, width) in vector order
    metrics: dict = field(default_factory=dict)
    attribution: list[tuple[str, float]] | None = None
    class_attribution: list[tuple] = field(default_factory=list)  # (class, feature, value)
    unseen: dict[str, list[float]] = field(default_factory=dict)  # per target-encoded column the means of all rows
    means: dict[str, DataFrame] = field(default_factory=dict)  # and its table of means per value

    def sidecar(self) -> dict:
        keys = ("kind", "label", "features", "options", "classes", "slots", "metrics", "attribution", "class_attribution", "unseen")
        return {k: getattr(self, k) for k in keys}

    def save(self, spark: SparkSession, path: str) -> None:
        """Replace whatever was stored under ``path``.

        Every version has a folder of its own; it counts once its commit file is there, which is written last and
        whole. A writer that dies before leaves the version before in place. The last two versions are kept, so that
        one being read is not taken away.
        """
        version = f"v-{uuid.uuid4().hex}"
        self.pipeline.write().save(f"{path}/{version}/pipeline")
        for i, c in enumerate(self.unseen):
            self.means[c].write.parquet(f"{path}/{version}/means-{i}")
        text = spark.createDataFrame([(json.dumps(self.sidecar()),)], "value string")
        text.coalesce(1).write.text(f"{path}/{version}/sidecar")
        done = _commits(spark, path)
        _commit(spark, f"{path}/{COMMIT}{max(done, default=0) + 1:010d}", version)
        _forget(spark, path, done)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        done = _commits(spark, path)
        if not done:
            raise FileNotFoundError(f"no model under {path}")
        path = f"{path}/{done[max(done)]}"
        d = json.loads(spark.read.text(f"{path}/sidecar").first()[0])
        for k in ("features", "slots", "class_attribution"):
            d[k] = [tuple(v) for v in d[k]]
        if d["attribution"] is not None:
            d["attribution"] = [tuple(v) for v in d["attribution"]]
        means = {c: spark.read.parquet(f"{path}/means-{i}") for i, c in enumerate(d.get("unseen", {}))}
        return Model(pipeline=PipelineModel.load(f"{path}/pipeline"), means=means, **d)


COMMIT = "commit-"


def _files(spark: SparkSession, path: str):
    """The path, and the file system it lies in."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, path: str) -> dict[int, str]:
    """Number and version of every commit; a file's content is its version."""
    where, fs = _files(spark, path)
    if not fs.exists(where):
        return {}
    names = [f.getPath() for f in fs.listStatus(where) if f.getPath().getName().startswith(COMMIT)]
    return {int(n.getName()[len(COMMIT) :]): spark.read.text(n.toString()).first()[0] for n in names}


def _commit(spark: SparkSession, path: str, version: str) -> None:
    """Create the commit file; it fails where another writer already made it."""
    where, fs = _files(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(version, "utf-8"))
    finally:
        out.close()


def _forget(spark: SparkSession, path: str, done: Mapping[int, str]) -> None:
    """Remove all versions before the last of ``done``."""
    for number in sorted(done)[:-1]:
        for name in (f"{COMMIT}{number:010d}", done[number]):
            where, fs = _files(spark, f"{path}/{name}")
            fs.delete(where, True)


def _kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "flag"
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, T.StringType):
        return "category"
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.NumericType):
        return "array"
    if isinstance(dtype, VectorUDT):
        return "vector"
    raise TypeError(f"a {dtype.simpleString()} column cannot be a feature; cast or drop it")


def _encodings(df: DataFrame, names: Sequence[str], encoding: str | Mapping[str, str]) -> dict[str, str]:
    """The encoding of every category column."""
    cats = [c for c in names if _kind_of(df.schema[c].dataType) == "category"]
    chosen = {c: encoding if isinstance(encoding, str) else encoding.get(c, "one_hot") for c in cats}
    if unknown := set(chosen.values()) - set(ENCODINGS):
        raise ValueError(f"an encoding is one of {ENCODINGS}, not {sorted(unknown)}")
    return chosen


def _answer_means(fit: DataFrame, label: str, classes: Sequence | None, columns: Sequence[str], o: Mapping):
    """Training rows with out-of-fold means of the answer in ``_t_<column>``, the tables of means and the means of all rows.

    A regressor has one mean, two classes the rate of the second, several the rates of all but the first. A row's fold
    is drawn by its place and written with it. It must not follow from the row's values: if rows of one value and
    answer shared a fold, the others would show the opposite answer.
    """
    folds, smoothing = o.get("target_folds", FOLDS), o.get("target_smoothing", SMOOTHING)
    answer = F.col(f"`{label}`")
    targets = [answer] if classes is None else [(answer == F.lit(c)).cast("double") for c in classes[1:]]
    fold = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(folds))
    fit = staged(fit.withColumn("_fold", fold), "folds")
    over_all = fit.agg(*[F.avg(t.cast("double")) for t in targets]).first()
    means, unseen, out = {}, {}, fit
    for c in columns:
        means[c] = staged(target_means(fit, c, targets, fold, folds, smoothing), "means")
        unseen[c] = [float(v or 0.0) for v in over_all]
        out = encoded(out, c, means[c], unseen[c], F.col("_fold"))
    return staged(out.drop("_fold"), "encoded"), means, unseen


def _prepare(df: DataFrame, names: Sequence[str], tree: bool, encoding: str | Mapping[str, str] = "one_hot") -> tuple[Pipeline, list[str]]:
    """Stages that turn columns into one vector, and the sources in vector order.

    Missing numbers become the column mean, missing categories their own
    category, missing arrays a row of missing numbers. Trees take category
    indices, the rest one slot per category; columns whose ``encoding`` is
    ``hash`` share a fixed number of slots instead, and those with ``target``
    come with their means already joined.
    """
    kinds = {c: _kind_of(df.schema[c].dataType) for c in names}
    by = lambda k: [c for c in names if kinds[c] == k]
    numbers, flags, cats, arrays, vectors = by("number"), by("flag"), by("category"), by("array"), by("vector")
    chosen = _encodings(df, names, encoding)
    hashed, by_target = ([c for c in cats if chosen[c] == e] for e in ("hash", "target"))
    cats = [c for c in cats if c not in by_target]
    listed = [c for c in cats if c not in hashed]

    sql = [f"cast(`{c}` as double) as `_n_{c}`" for c in numbers]
    sql += [f"coalesce(cast(`{c}` as double), 0.0) as `_n_{c}`" for c in flags]
    sql += [f"coalesce(`{c}`, '{MISSING}') as `_c_{c}`" for c in cats]
    dims: dict[str, int] = {}
    if arrays:
        known = df.agg(*[f(F.when(F.col(c).isNotNull(), F.size(c))).alias(f"{n}{c}") for c in arrays for n, f in (("low", F.min), ("high", F.max))])
        found = known.first().asDict()
        for c in arrays:
            if found[f"low{c}"] != found[f"high{c}"]:
                raise ValueError(f"the arrays of {c} differ in length")
            dims[c] = found[f"high{c}"] or 0
    for c in arrays:
        sql += [f"cast(try_element_at(`{c}`, {i + 1}) as double) as `_v_{c}_{i}`" for i in range(dims[c])]
    stages = [SQLTransformer(statement=f"select {', '.join(['*', *sql])} from __THIS__")]
    inputs, sources = [], []
    if numbers:
        stages.append(Imputer(strategy="mean", inputCols=[f"_n_{c}" for c in numbers], outputCols=[f"_i_{c}" for c in numbers]))
        inputs += [f"_i_{c}" for c in numbers]
    inputs += [f"_n_{c}" for c in flags]
    sources += numbers + flags
    if listed:
        stages.append(
            StringIndexer(
                inputCols=[f"_c_{c}" for c in listed],
                outputCols=[f"_x_{c}" for c in listed],
                handleInvalid="keep",
                stringOrderType="frequencyDesc",
            )
        )
        if tree:
            inputs += [f"_x_{c}" for c in listed]
        else:
            stages.append(OneHotEncoder(inputCols=[f"_x_{c}" for c in listed], outputCols=[f"_o_{c}" for c in listed], dropLast=False))
            inputs += [f"_o_{c}" for c in listed]
        sources += listed
    for c in hashed:
        stages.append(FeatureHasher(inputCols=[f"_c_{c}"], outputCol=f"_o_{c}", numFeatures=HASH_SLOTS))
        inputs.append(f"_o_{c}")
    for c in arrays:
        cells = [f"_v_{c}_{i}" for i in range(dims[c])]
        stages.append(Imputer(strategy="mean", inputCols=cells, outputCols=[f"_i{v}" for v in cells]))
        stages.append(VectorAssembler(inputCols=[f"_i{v}" for v in cells], outputCol=f"_o_{c}"))
        inputs.append(f"_o_{c}")
    inputs += [f"_t_{c}" for c in by_target] + vectors
    sources += hashed + arrays + by_target + vectors
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features"))
    return Pipeline(stages=stages), sources


def _widths(prep: PipelineModel, df: DataFrame, sources: Sequence[str]) -> list[tuple[str, int]]:
    """How many vector slots each source column fills, read from the vector's metadata."""
    assembler = next(s for s in reversed(prep.stages) if isinstance(s, VectorAssembler))
    row = prep.transform(df.limit(1)).select(*[F.col(f"`{c}`") for c in assembler.getInputCols()]).first()
    size = lambda v: v.size if isinstance(v, Vector) else 1
    return [(s, size(row[i])) for i, s in enumerate(sources)] if row is not None else []


def _label_column(df: DataFrame, label: str, classes: Sequence | None) -> Column:
    if classes is None:
        return F.col(f"`{label}`").cast("double")
    index = F.lit(None).cast("double")
    for i, v in enumerate(classes):
        index = F.when(F.col(f"`{label}`") == F.lit(v), F.lit(float(i))).otherwise(index)
    return index


def _estimator(kind: str, o: Mapping, n_classes: int, width: int, max_bins: int):
    seed = o.get("seed", 42)
    common = {"featuresCol": "_features", "labelCol": "_label"}
    weight = {"weightCol": "_weight"} if o.get("auto_class_weights") else {}
    tree = {"maxDepth": o.get("max_tree_depth", 5), "seed": seed, "maxBins": max_bins, **common}
    if kind == "LINEAR_REG":
        return LinearRegression(regParam=o.get("l2_reg", 0.0), solver="auto", **common)
    if kind == "LOGISTIC_REG":
        return LogisticRegression(regParam=o.get("l2_reg", 0.0), maxIter=o.get("max_iterations", 50), family="auto", **common, **weight)
    if kind == "BOOSTED_TREE_REGRESSOR":
        return GBTRegressor(maxIter=o.get("max_iterations", 20), subsamplingRate=o.get("subsample", 0.8), **tree)
    if kind == "BOOSTED_TREE_CLASSIFIER":
        gbt = GBTClassifier(maxIter=o.get("max_iterations", 20), subsamplingRate=o.get("subsample", 0.8), **tree, **weight)
        return gbt if n_classes == 2 else OneVsRest(classifier=gbt, featuresCol="_features", labelCol="_label")
    if kind == "RANDOM_FOREST_REGRESSOR":
        return RandomForestRegressor(numTrees=o.get("num_trees", 20), bootstrap=o.get("bootstrap", True), **tree)
    if kind == "RANDOM_FOREST_CLASSIFIER":
        return RandomForestClassifier(numTrees=o.get("num_trees", 20), bootstrap=o.get("bootstrap", True), **tree, **weight)
    if kind == "DNN_CLASSIFIER":
        layers = [width, *o.get("hidden_units", [16]), n_classes]
        steps = o.get("max_iterations", 50)
        return MultilayerPerceptronClassifier(layers=layers, seed=seed, maxIter=steps, featuresCol="_scaled", labelCol="_label")
    raise ValueError(f"unknown model type {kind!r}")


def train(
    df: DataFrame,
    model_type: str,
    label: str | None = None,
    *,
    split_method: str = "AUTO",
    split_column: str | None = None,
    global_explain: bool = False,
    catalog: Mapping[str, Feature] | None = None,
    stage: bool = True,
    **options,
) -> Model:
    """Train on ``df``: the label column is the answer, every other column a feature.

    Rows without a label are left out. With a ``catalog`` of declared columns,
    features that touch the label's sources are refused. Training reads its rows
    a dozen times, so the SELECT is written out once first; ``stage=False`` skips
    that for a frame that is already a plain table.
    """
    kind = model_type.upper()
    if kind in UNSUPERVISED:
        return _train_unsupervised(staged(df, "training") if stage else df, kind, options)
    rows = _labelled(df, label, split_column, catalog, stage)
    fit, held = split(rows, split_method, options.get("seed", 42), split_column)
    if split_column in fit.columns:  # never a feature
        fit, held = fit.drop(split_column), held.drop(split_column)
    model = _train_on(rows, fit, held, [kind], label, [options], split_method)[0]
    if global_explain:
        from . import explain

        found = explain.outputs(model, held)
        model.attribution = explain.ranked(model, found)
        model.class_attribution = explain.ranked_by_class(model, found) if model.classes else []
    return model


def train_each(
    fit: DataFrame, held: DataFrame, model_type: str | Sequence[str], label: str, variants: Sequence[Mapping], *,
    rows: DataFrame | None = None, split_method: str = "NONE", parallel: int = 1,
) -> list[Model]:
    """Supervised models that differ in their options, and in their type if ``model_type`` lists one for each.

    They are trained on the rows ``fit``, measured on the rows ``held``, and are what ``train`` makes of each variant, in
    the same order; the types are all regressors or all classifiers. Both sides are cut from a written table; a classifier
    knows the answers found in ``rows``, or else in ``fit``. Rows are prepared once for all variants that prepare them alike,
    and one written table holds the answers of their regressors. ``parallel`` fits run at a time.
    """
    kinds = [model_type] * len(variants) if isinstance(model_type, str) else model_type
    fit, held, rows = (_labelled(part, label, None, None, False) for part in (fit, held, fit if rows is None else rows))
    return _train_on(rows, fit, held, [k.upper() for k in kinds], label, variants, split_method, parallel)


def _labelled(df: DataFrame, label: str | None, split_column: str | None, catalog: Mapping[str, Feature] | None, stage: bool) -> DataFrame:
    if label is None or label not in df.columns:
        raise ValueError("a supervised model needs its label column among the training columns")
    if catalog:
        refuse_leaks([c for c in df.columns if c not in (label, split_column)], label, catalog)
    rows = df.where(F.col(f"`{label}`").isNotNull())
    return staged(rows, "training") if stage else rows


def _train_on(
    rows: DataFrame, fit: DataFrame, held: DataFrame, kinds: Sequence[str], label: str, variants: Sequence[Mapping], split_method: str, parallel: int = 1
) -> list[Model]:
    """A model per variant. Variants that prepare their rows alike share the prepared rows and their passes.

    Trees read them three times before they keep points of their own, so rows for trees or for several fits are kept on
    the executors' disks: in their partitions, as seeded draws depend on those.
    """
    spark, out = fit.sparkSession, {}
    for alike in _alike(kinds, variants):
        ready, fitted = _ready(rows, fit, kinds[alike[0]], label, variants[alike[0]])
        several = len(alike) > 1
        if several or kinds[alike[0]] in TREES:
            ready = ready.persist(StorageLevel.DISK_ONLY)
        try:
            if several:  # before fits that run side by side each begin to
                ready.count()
            with ThreadPool(min(parallel, len(alike))) as pool:
                fits = pool.map(inheritable_thread_target(spark)(lambda i: fitted(ready, kinds[i], variants[i], split_method)), alike)
        finally:
            ready.unpersist()
        for i, model, metrics in zip(alike, fits, _metrics_of(fits, held, parallel), strict=True):
            model.metrics, out[i] = metrics, model
    return [out[i] for i in range(len(variants))]


# Options that the preparation of the rows depends on.
PREPARING = ("encoding", "target_folds", "target_smoothing", "auto_class_weights", "max_classes")


def _alike(kinds: Sequence[str], variants: Sequence[Mapping]) -> list[list[int]]:
    """Places of the variants, those that prepare their rows alike together."""
    groups: list[list[int]] = []
    way = [(k in TREES, k in CLASSIFIERS, k == "DNN_CLASSIFIER", *(o.get(p) for p in PREPARING)) for k, o in zip(kinds, variants, strict=True)]
    for i in range(len(variants)):
        same = next((g for g in groups if way[g[0]] == way[i]), None)
        if same is None:
            groups.append(same := [])
        same.append(i)
    return groups


def _ready(rows: DataFrame, fit: DataFrame, kind: str, label: str, options: Mapping):
    """The rows ``fit`` as vectors and answers, and the way from there to a fitted model."""
    names = [c for c in fit.columns if c != label]
    features = [(c, fit.schema[c].dataType.simpleString()) for c in names]
    classes = None
    if kind in CLASSIFIERS:
        most = options.get("max_classes", 1_000)
        found = rows.select(label).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{label} has over {most} classes; allow more with max_classes")
        classes = sorted((r[0] for r in found), key=lambda v: (str(type(v)), v))
    by_target = [c for c, e in _encodings(fit, names, options.get("encoding", "one_hot")).items() if e == "target"]
    means, unseen = {}, {}
    if by_target:
        fit, means, unseen = _answer_means(fit, label, classes, by_target, options)
    prep_plan, sources = _prepare(fit, names, kind in TREES, options.get("encoding", "one_hot"))
    if kind == "DNN_CLASSIFIER":  # gradients need inputs of one scale
        prep_plan.setStages([*prep_plan.getStages(), StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True)])
    prep = prep_plan.fit(fit)
    slots = _widths(prep, fit, sources)
    bins = max([32] + [len(a) + 2 for s in prep.stages if hasattr(s, "labelsArray") for a in s.labelsArray])
    labelled = fit.withColumn("_label", _label_column(fit, label, classes))
    if options.get("auto_class_weights"):
        w = {r[0]: r["weight"] for r in ev.class_weights(fit, label).collect()}
        weight = F.lit(1.0)
        for v in classes:
            weight = F.when(F.col(f"`{label}`") == F.lit(v), F.lit(float(w[v]))).otherwise(weight)
        labelled = labelled.withColumn("_weight", weight)
    keep = ["_scaled" if kind == "DNN_CLASSIFIER" else "_features", "_label"]
    keep += ["_weight"] if "_weight" in labelled.columns else []

    def fitted(ready: DataFrame, kind: str, options: Mapping, split_method: str) -> Model:
        last = _estimator(kind, options, len(classes or []), sum(n for _, n in slots), bins).fit(ready)
        pipeline = PipelineModel(stages=[*prep.stages, last])
        stored = {**options, "split_method": split_method, "seed": options.get("seed", 42)}
        return Model(kind, label, features, stored, pipeline, list(classes or []), slots, unseen=unseen, means=means)

    return prep.transform(labelled).select(*keep), fitted


def _metrics_of(models: Sequence[Model], held: DataFrame, parallel: int) -> list[dict]:
    """Metrics of models with the same preparation; the answers of regressors come from one pass over the rows."""
    first, spark = models[0], held.sparkSession
    if len(models) == 1 or first.kind not in REGRESSORS:
        measured, jobs = (lambda m: evaluate(m, held)), models
    else:
        *prep, _ = first.pipeline.stages
        out = PipelineModel(stages=prep).transform(_known(first, held))
        for i, m in enumerate(models):
            out = m.pipeline.stages[-1].transform(out).withColumnRenamed("prediction", f"_p{i}")
        answers = staged(out.select(F.col(f"`{first.label}`").alias("y"), *[f"_p{i}" for i in range(len(models))]), "scored")
        measured, jobs = (lambda p: ev.regression_metrics(answers, "y", p)), [f"_p{i}" for i in range(len(models))]
    with ThreadPool(min(parallel, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda job: measured(job).first().asDict()), jobs)


def _train_unsupervised(df: DataFrame, kind: str, o: Mapping) -> Model:
    if "target" in _encodings(df, df.columns, o.get("encoding", "one_hot")).values():
        raise ValueError(f"{kind} has no answer to take means of")
    prep_plan, sources = _prepare(df, df.columns, False, o.get("encoding", "one_hot"))
    stages = list(prep_plan.getStages())
    column = "_features"
    if o.get("standardize_features", kind == "KMEANS"):
        stages.append(StandardScaler(inputCol=column, outputCol="_scaled", withMean=True, withStd=True))
        column = "_scaled"
    if kind == "KMEANS" and "num_clusters" not in o:
        return choose_k(df, **o)
    if kind == "KMEANS":
        stages.append(KMeans(k=o["num_clusters"], seed=o.get("seed", 42), featuresCol=column, predictionCol="_cluster"))
    else:
        stages.append(PCA(k=o.get("num_components", 2), inputCol=column, outputCol="_components"))
    pipeline = Pipeline(stages=stages).fit(df)
    features = [(c, df.schema[c].dataType.simpleString()) for c in df.columns]
    return Model(kind, None, features, dict(o), pipeline, slots=[(s, 1) for s in sources])


def choose_k(df: DataFrame, ks: Sequence[int] = CLUSTER_COUNTS, **options) -> Model:
    """The clustering with the lowest Davies–Bouldin index among several sizes."""
    tried = [_train_unsupervised(df, "KMEANS", {**options, "num_clusters": k}) for k in ks]
    for m in tried:
        m.metrics = evaluate(m, df).first().asDict()
    return min(tried, key=lambda m: m.metrics["davies_bouldin_index"])


# Integers widen without loss; the other way round would invent a type.
_WIDENS = {"double": {"tinyint", "smallint", "int", "bigint", "float", "double"}, "bigint": {"tinyint", "smallint", "int", "bigint"}, "int": {"tinyint", "smallint", "int"}}


def check_schema(model: Model, df: DataFrame) -> None:
    """Refuse rows whose columns are missing or of another type than in training."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    for name, dtype in model.features:
        if name not in have:
            raise SchemaError(f"column {name} ({dtype}) is missing")
        if have[name] != dtype and have[name] not in _WIDENS.get(dtype, {dtype}):
            raise SchemaError(f"column {name} is {have[name]}, the model was trained on {dtype}")


def _known(model: Model, df: DataFrame) -> DataFrame:
    """Rows that the pipeline takes: their schema is checked, and means of the answer are joined."""
    check_schema(model, df)
    for c, known in model.unseen.items():
        df = encoded(df, c, model.means[c], known)
    return df


def _scored(model: Model, df: DataFrame) -> DataFrame:
    """All input columns plus what the pipeline adds."""
    return model.pipeline.transform(_known(model, df))


def predict(model: Model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """The input columns and the prediction; a lazy transform, map-only unless a large table of target means is joined.

    Regression adds ``predicted_<label>``; classification also adds
    ``predicted_<label>_probs``, an array of (label, prob). ``threshold`` moves
    the cut of a two-class model. Clustering adds ``CENTROID_ID`` from 1.
    """
    out, columns = _scored(model, df), [F.col(f"`{c}`") for c in df.columns]
    if model.kind == "KMEANS":
        return out.select(*columns, (F.col("_cluster") + 1).alias("CENTROID_ID"))
    if model.kind == "PCA":
        return out.select(*columns, vector_to_array("_components").alias("principal_components"))
    target = f"predicted_{model.label}"
    if model.kind in REGRESSORS:
        return out.select(*columns, F.col("prediction").alias(target))
    labels = F.array(*[F.lit(v) for v in model.classes])
    answer = F.get(labels, F.col("prediction").cast("int"))
    if "probability" not in out.columns:  # one-vs-rest votes carry no probability
        votes = [(F.col("prediction") == i).cast("double") for i in range(len(model.classes))]
        probs = F.array(*votes)
    else:
        probs = vector_to_array("probability")
    pairs = F.arrays_zip(labels.alias("label"), probs.alias("prob"))
    pairs = F.transform(pairs, lambda p: F.struct(p["label"].alias("label"), p["prob"].alias("prob")))
    if threshold is not None:
        if len(model.classes) != 2:
            raise ValueError("a threshold needs a two-class model")
        answer = F.get(labels, F.when(probs[1] >= threshold, 1).otherwise(0))
    return out.select(*columns, answer.alias(target), pairs.alias(f"{target}_probs"))


def _prob_of(probs: str, label: Column) -> Column:
    return F.get(F.filter(probs, lambda p: p["label"] == label), F.lit(0))["prob"]


def evaluate(model: Model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row of metrics over labelled rows."""
    if model.kind == "KMEANS":
        used = "_scaled" if model.options.get("standardize_features", True) else "_features"
        names = [f"d{i}" for i in range(len(model.pipeline.stages[-1].clusterCenters()[0]))]
        points = model.pipeline.transform(df).select(vector_to_array(used).alias("v"), "_cluster")
        points = points.select("_cluster", *[F.col("v")[i].alias(d) for i, d in enumerate(names)])
        index = ev.davies_bouldin(points, names, "_cluster")
        return df.sparkSession.createDataFrame([(index,)], "davies_bouldin_index double")
    scored, p = predict(model, df, threshold), f"predicted_{model.label}"
    truth = F.col(f"`{model.label}`").alias("y")
    if model.kind in REGRESSORS:
        return ev.regression_metrics(staged(scored.select(truth, F.col(f"`{p}`").alias("p")), "scored"), "y", "p")
    two = len(model.classes) == 2
    score = _prob_of(f"{p}_probs", F.lit(model.classes[1]) if two else F.col(f"`{model.label}`"))
    pairs = staged(scored.select(truth, F.col(f"`{p}`").alias("p"), score.alias("s")), "scored")
    if two:
        yes = F.lit(model.classes[1])
        return ev.classification_metrics(pairs, F.col("y") == yes, F.col("p") == yes, F.col("s"))
    metrics = ev.multiclass_metrics(pairs, F.col("y"), F.col("p"), F.col("s"))
    if model.kind == "BOOSTED_TREE_CLASSIFIER":  # votes are no probabilities
        return metrics.withColumn("log_loss", F.lit(None).cast("double"))
    return metrics


def confusion(model: Model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    return ev.confusion_matrix(predict(model, df, threshold), model.label, f"predicted_{model.label}", model.classes)
