"""Learning on tables (P1-P21) with Spark ML and DataFrame algorithms.

Fitted statistics are exact (medians: ``quantiles``) or scalar subqueries over
the training split. Models use ``pyspark.ml``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Imputer, OneHotEncoder, PCA, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .calibration import calibrate  # noqa: F401  P12
from .clustering import dbscan  # noqa: F401  P17


# ---------------------------------------------------------------- P1-P5

def median_impute(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact train medians (a number per column) filled into any split."""
    from .quantiles import medians
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double")) for c, m in medians(train, columns).items()})


def mean_impute(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """``Imputer(strategy='mean')`` fitted on train."""
    t = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    m = Imputer(strategy="mean", inputCols=columns, outputCols=[f"{c}_imp" for c in columns]).fit(t)
    out = m.transform(df.withColumns({c: F.col(c).cast("double") for c in columns}))
    return out.drop(*columns).withColumnsRenamed({f"{c}_imp": c for c in columns})


def standard_scale(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population std fitted on train (sklearn semantics;
    ML ``StandardScaler`` divides by the sample std)."""
    # one scan for the statistics of all columns
    s = train.agg(F.struct(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(f"s{i}") for i, c in enumerate(columns)])).scalar()
    return df.withColumns({c: F.when(s[f"s{i}"]["std"] == 0, F.lit(0.0)).otherwise((F.col(c) - s[f"s{i}"]["mean"]) / s[f"s{i}"]["std"])
                           for i, c in enumerate(columns)})


#: Categories that P4 makes columns of.
MOST_CATEGORIES = 1000


def one_hot(train: DataFrame, df: DataFrame, column: str, drop_first: bool = True) -> DataFrame:
    """Sorted categories of the training split (their list defines the
    output schema, so it is read once); unknown values -> all zero; names
    ``column_value``. More than ``MOST_CATEGORIES`` are an error: they would
    be as many columns."""
    found = train.select(column).where(F.col(column).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()
    if len(found) > MOST_CATEGORIES:
        raise ValueError(f"{column} has over {MOST_CATEGORIES} categories")
    cats = sorted(r[0] for r in found)
    keep = cats[1:] if drop_first else cats
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
                           for v in keep})


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """P5: alphabetical code (``dense_rank - 1``) computed over the distinct
    values with range partitions and prefix offsets, then joined back."""
    from .ranking import dense_codes
    return df.join(dense_codes(df, column, out or f"{column}_code"), column, "left")


# ---------------------------------------------------------------- P6-P10

#: Rows of a file that ``spread`` writes: training on as many rows is worth a task of its own.
FILE_ROWS = 20_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` written once in files of ``FILE_ROWS`` rows: a fit reads its rows
    many times, and the scan deals the files out to all cores, where a small
    source file or a coalesced shuffle would leave the work to one or two."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/training-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class MedianImputer(Estimator):
    """Fits the exact medians of the columns; the model is a SQL projection (so
    a fitted pipeline is saved and loaded like any). A column without values
    is filled with 0."""

    def __init__(self, columns: list[str]):
        super().__init__()
        self.columns = columns

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        from .quantiles import medians
        filled = ", ".join(f"coalesce(nullif(cast(`{c}` as double), double('NaN')), double('{m if m is not None else 0.0!r}')) AS `{c}__imp`"
                           for c, m in medians(dataset, self.columns).items())
        return SQLTransformer(statement=f"SELECT *{', ' + filled if filled else ''} FROM __THIS__")

    def copy(self, extra=None):
        return MedianImputer(list(self.columns))


def feature_pipeline(numeric: list[str], categorical: list[str], scale: bool = True) -> list:
    """Median imputer + scaler for numbers, indexer + one-hot for
    categories (unknown kept as its own slot), assembled to ``features``."""
    stages = [MedianImputer(numeric)]
    num_vec = VectorAssembler(inputCols=[f"{c}__imp" for c in numeric], outputCol="num__vec", handleInvalid="keep")
    stages.append(num_vec)
    num_out = "num__vec"
    if scale:
        stages.append(StandardScaler(inputCol="num__vec", outputCol="num__scaled", withMean=True, withStd=True))
        num_out = "num__scaled"
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[num_out] + [f"{c}__oh" for c in categorical], outputCol="features"))
    return stages


def with_balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """O11 as a training weight column."""
    from .evaluate import class_weights
    return class_weights(df, label, out)


def fit_features(train: DataFrame, numeric: list[str], categorical: list[str]) -> PipelineModel:
    """The fitted P6 stages but the last assembler: models of any kind that
    train on the same rows share them."""
    return Pipeline(stages=feature_pipeline(numeric, categorical)[:-1]).fit(train)


def fit_classifier(train: DataFrame, numeric: list[str], categorical: list[str], label: str, kind: str = "logistic",
                   weight: str | None = None, seed: int = 42, features: PipelineModel | None = None, **params) -> PipelineModel:
    """Logistic regression, random forest or gradient-boosted
    trees behind the P6 feature stages. For ``gbt`` a boolean
    ``validationIndicatorCol`` in ``params`` enables validation stopping.
    ``features``: stages that ``fit_features`` fitted on ``train``, which is
    then read as it is (else its columns are written once)."""
    if kind == "logistic":
        est = LogisticRegression(labelCol=label, featuresCol="features", maxIter=params.get("maxIter", 100),
                                 regParam=params.get("regParam", 0.0))
    elif kind == "random_forest":
        est = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=params.get("numTrees", 100),
                                     maxDepth=params.get("maxDepth", 15), seed=seed)
    elif kind == "gbt":
        est = GBTClassifier(labelCol=label, featuresCol="features", maxIter=params.get("maxIter", 50),
                            maxDepth=params.get("maxDepth", 5), seed=seed)
        if params.get("validationIndicatorCol"):
            est.setValidationIndicatorCol(params["validationIndicatorCol"])
    else:
        raise ValueError(kind)
    if weight:
        est.setWeightCol(weight)
    stages = feature_pipeline(numeric, categorical, scale=(kind == "logistic"))
    if features is not None:
        rest = Pipeline(stages=[stages[-1], est]).fit(features.transform(train))
        return PipelineModel(stages=[*features.stages, *rest.stages])
    used = dict.fromkeys([*numeric, *categorical, label, *([weight] if weight else []), *filter(None, [params.get("validationIndicatorCol")])])
    return Pipeline(stages=stages + [est]).fit(spread(train.select(*used)))


def fit_regressor(train: DataFrame, numeric: list[str], categorical: list[str], label: str,
                  kind: str = "random_forest", seed: int = 42, **params) -> PipelineModel:
    """P8 / P9 / P10 regressors: random forest, GBT, Poisson GLM (log link)."""
    if kind == "random_forest":
        est = RandomForestRegressor(labelCol=label, numTrees=params.get("numTrees", 100),
                                    maxDepth=params.get("maxDepth", 15), seed=seed)
    elif kind == "gbt":
        est = GBTRegressor(labelCol=label, maxIter=params.get("maxIter", 50), maxDepth=params.get("maxDepth", 5),
                           seed=seed)
        if params.get("validationIndicatorCol"):
            est.setValidationIndicatorCol(params["validationIndicatorCol"])
    elif kind == "poisson":
        est = GeneralizedLinearRegression(labelCol=label, family="poisson", link="log",
                                          regParam=params.get("regParam", 1.0), maxIter=params.get("maxIter", 25))
    else:
        raise ValueError(kind)
    used = dict.fromkeys([*numeric, *categorical, label, *filter(None, [params.get("validationIndicatorCol")])])
    return Pipeline(stages=feature_pipeline(numeric, categorical) + [est]).fit(spread(train.select(*used)))


def probability(df: DataFrame, out: str = "p") -> DataFrame:
    """Positive-class probability as a double column."""
    return df.withColumn(out, vector_to_array("probability")[1])


# P11 is in ``zero_inflated``, P12 in ``calibration``, P13 - P15 in ``selection``

# ---------------------------------------------------------------- P15-P18

def scaled_vectors(df: DataFrame, features: str) -> DataFrame:
    """``df`` with the vector column ``features`` centred and scaled to unit
    deviation, written: clustering reads it many times."""
    names = df.columns
    m = StandardScaler(inputCol=features, outputCol="_scaled", withMean=True, withStd=True).fit(df)
    out = m.transform(df).drop(features).withColumnRenamed("_scaled", features).select(*names)
    return spread(out)


def each(spark: SparkSession, work: Callable, jobs: list, parallelism: int = 4) -> list:
    """``work`` of every job in order, some at a time."""
    with ThreadPool(max(1, min(parallelism, len(jobs) or 1))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), jobs, chunksize=1)


def kmeans_many(df: DataFrame, features: str, ks, starts: int = 10, seed: int = 42) -> dict[int, KMeansModel]:
    """K-means over a vector column for each k, the best of ``starts``
    starts by its cost (sum of squared distances). Only centres and costs
    reach the driver."""
    jobs = [(k, i) for k in ks for i in range(starts)]
    fits = each(df.sparkSession, lambda job: KMeans(k=job[0], seed=seed + job[1], featuresCol=features, maxIter=50).fit(df), jobs)
    best: dict[int, KMeansModel] = {}
    for (k, _), m in zip(jobs, fits, strict=True):
        if k not in best or m.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = m
    return best


def kmeans(df: DataFrame, features: str, k: int, starts: int = 10, seed: int = 42) -> KMeansModel:
    """``kmeans_many`` for one k."""
    return kmeans_many(df, features, [k], starts, seed)[k]


def centre_distances(features: str, centres: list) -> Column:
    """The distances of a vector column to each of the centres, an array."""
    v = vector_to_array(F.col(features))
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    return F.transform(rows, lambda c: F.sqrt(F.aggregate(F.zip_with(v, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)))


def assign_centres(df: DataFrame, features: str, centres: list, out: str = "cluster") -> DataFrame:
    """``df`` with the number of its nearest centre (the first of equals) and
    the distance to it."""
    d = df.withColumn("_d", centre_distances(features, centres))
    return d.withColumns({"distance": F.array_min("_d"), out: (F.array_position("_d", F.array_min("_d")) - 1).cast("int")}).drop("_d")


def simplified_silhouette(df: DataFrame, features: str, centres: list) -> DataFrame:
    """One row ``silhouette``: the mean of (b - a) / max(a, b), a the distance
    to the nearest centre and b to the second; one pass, no pairs of rows."""
    d = F.array_sort(centre_distances(features, centres))
    a, b = F.get(d, F.lit(0)), F.get(d, F.lit(1))
    return df.agg(F.avg(F.when(b > 0, (b - a) / b).otherwise(0.0)).alias("silhouette"))


def kmeans_elbow(df: DataFrame, features: str, ks=range(2, 10), starts: int = 10, seed: int = 42) -> list[tuple[int, float, float]]:
    """(k, cost, simplified silhouette) of the best of ``starts`` per k."""
    return elbow_rows(df, features, kmeans_many(df, features, ks, starts, seed))


def elbow_rows(df: DataFrame, features: str, models: dict[int, KMeansModel]) -> list[tuple[int, float, float]]:
    """(k, cost, simplified silhouette) of fitted models."""
    return [(k, float(m.summary.trainingCost), float(simplified_silhouette(df, features, m.clusterCenters()).first()[0])) for k, m in models.items()]


def pca2(df: DataFrame, features: str) -> DataFrame:
    """Two principal components of scaled features."""
    s = StandardScaler(inputCol=features, outputCol="_sc", withMean=True, withStd=True).fit(df).transform(df)
    m = PCA(k=2, inputCol="_sc", outputCol="pca").fit(s)
    return m.transform(s).withColumn("pc", vector_to_array("pca")).select(
        "*", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2")).drop("_sc", "pca", "pc")


def voting(df: DataFrame, members: list[str], out: str = "p_vote") -> DataFrame:
    """Soft voting = mean of the members' probability columns (members
    scored on the same rows, so no join on a possibly non-unique id)."""
    return df.withColumn(out, sum((F.col(m) for m in members), F.lit(0.0)) / len(members))


# ---------------------------------------------------------------- P20-P21

def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    """P20: persist with the Spark ML writer and load back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def feature_importances(model: PipelineModel, df: DataFrame, numeric: list[str], categorical: list[str], families: dict[str, str],
                        top: int = 20) -> list[tuple[str, float, str]]:
    """Ranked importances of a tree model with a family tag. Slots are told
    apart by the metadata of the fitted columns; those of a category sum up to
    its column. ``df``: any table the model takes (its rows are not read)."""
    imp = model.stages[-1].featureImportances.toArray()
    fields = model.transform(df).schema
    widths = [(c, 1) for c in numeric] + [(c, fields[f"{c}__oh"].metadata["ml_attr"]["num_attrs"] if "num_attrs" in fields[f"{c}__oh"].metadata["ml_attr"]
                                           else sum(map(len, fields[f"{c}__oh"].metadata["ml_attr"]["attrs"].values()))) for c in categorical]
    if sum(n for _, n in widths) != len(imp):
        raise ValueError("the model was not fitted on these columns")
    rows, at = [], 0
    for c, n in widths:
        rows.append((c, float(imp[at:at + n].sum()), families.get(c, "other")))
        at += n
    return sorted(rows, key=lambda t: (-t[1], t[0]))[:top]
