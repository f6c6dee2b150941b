"""Split, training, prediction and evaluation of the two-level classifier."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indices import any_missing

NODATA, NOCLASSIFIED = "nodata", "noclassified"


def clean(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Infinite and NaN values become NULL; rows with a NULL are dropped (by one condition a
    column: a single condition on all of them makes constraint inference exponential)."""
    df = df.drop(*drop)
    numeric = [c for c, t in df.dtypes if t in ("double", "float")]
    out = df.withColumns({c: F.when((F.abs(c) != float("inf")) & ~F.isnan(c), F.col(c)) for c in numeric})
    return out.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in out.columns]))


def feature_columns(df: DataFrame, labels: tuple[str, ...] = ("LC", "SL")) -> list[str]:
    return [c for c in df.columns if "product_name" not in c and c not in (*labels, "latitude", "longitude")]


def shuffle_key(*columns: str, seed: str = "0") -> Column:
    """A stable random order: the same on every engine and run."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in columns]))


def location_split(df: DataFrame, label: str, fraction: float = 0.85, lat: str = "latitude", lon: str = "longitude", seed: str = "0") -> DataFrame:
    """(label, lat, lon, part): for each label the first floor(n * fraction) of its distinct
    locations in stable random order are train, the others test. All pixels of a location go
    the same way."""
    locations = df.select(label, lat, lon).distinct()
    w = Window.partitionBy(label)
    ranked = locations.withColumn("_n", F.row_number().over(w.orderBy(shuffle_key(label, lat, lon, seed=seed), lat, lon))).withColumn("_all", F.count("*").over(w))
    return ranked.withColumn("part", F.when(F.col("_n") <= F.floor(F.col("_all") * fraction), "train").otherwise("test")).drop("_n", "_all")


def safe_split(df: DataFrame, label: str, fraction: float = 0.85, lat: str = "latitude", lon: str = "longitude", seed: str = "0") -> DataFrame:
    """As location_split, but a location with two labels goes to one side only."""
    one = location_split(df, label, fraction, lat, lon, seed)
    return one.groupBy(lat, lon).agg(F.min("part").alias("part"))


def back_join(df: DataFrame, locations: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows at the locations given (many to many: a location listed twice gives rows twice)."""
    return df.join(locations, [lat, lon])


def forest(features: list[str], label: str, trees: int = 100, depth: int = 30, min_leaf: int = 1, seed: int = 0) -> Pipeline:
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="error")
    gather = VectorAssembler(inputCols=features, outputCol="_features")
    trees_ = RandomForestClassifier(labelCol="_label", featuresCol="_features", predictionCol="_prediction", numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=[index, gather, trees_])


def fit_forest(df: DataFrame, features: list[str], label: str, **options) -> PipelineModel:
    """A fitted forest whose last stage names the predicted class in the column `predicted`."""
    model = forest(features, label, **options).fit(df)
    names = IndexToString(inputCol="_prediction", outputCol="predicted", labels=model.stages[0].labels)
    return PipelineModel([*model.stages[1:], names])


def apply_forest(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("_features", "rawPrediction", "probability", "_prediction")


def fit_second_level(df: DataFrame, features: list[str], parent: str = "LC", label: str = "SL", **options) -> dict[str, PipelineModel]:
    """One forest for each parent class with at least two second-level classes (the number of
    classes is bounded by the label map)."""
    found = df.groupBy(parent).agg(F.countDistinct(label).alias("n")).where("n >= 2").orderBy(parent)
    return {r[parent]: fit_forest(df.where(F.col(parent) == r[parent]), features, label, **options) for r in found.collect()}


def tree_statistics(model: PipelineModel) -> list[tuple[int, int]]:
    """Leaves and depth of each tree."""
    trees = next(s for s in model.stages if hasattr(s, "trees")).trees
    return [((t.numNodes + 1) // 2, t.depth) for t in trees]


def filled(df: DataFrame, used: list[str]) -> DataFrame:
    """Missing and infinite features as 0, in the order the model was fitted with."""
    rest = [c for c in df.columns if c not in used]
    fix = lambda c: F.coalesce(F.when((F.abs(c) != float("inf")) & ~F.isnan(c), F.col(c).cast("double")), F.lit(0.0)).alias(c)
    return df.select(*rest, *[fix(c) for c in used])


def predict(model: PipelineModel, df: DataFrame, used: list[str]) -> DataFrame:
    """predicted: a class, or nodata where any feature is missing."""
    return apply_forest(model, filled(df.withColumn("_nodata", any_missing(used)), used)).withColumn("predicted", F.when(F.col("_nodata"), NODATA).otherwise(F.col("predicted"))).drop("_nodata")


def route(rows: DataFrame, models: dict[str, PipelineModel], used: dict[str, list[str]], parent: str = "lc") -> DataFrame:
    """Second-level prediction: each row by the model of its parent class; nodata rows first,
    rows of a class without a model are noclassified."""
    parts = [predict(m, rows.where(F.col(parent) == c), used[c]) for c, m in models.items()]
    rest = rows.where(F.col(parent).isNull() | ~F.col(parent).isin(*models)) if models else rows
    parts.append(rest.withColumn("predicted", F.when(F.coalesce(F.col(parent), F.lit(NODATA)) == NODATA, NODATA).otherwise(NOCLASSIFIED)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def encode(label: Column, mapping: dict[str, int], reserved: dict[str, int]) -> Column:
    """Class code; a class without one is 0, as nodata is. Reserved codes override the map."""
    codes = mapping | reserved
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), label), F.lit(0))


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """(pred, actual, n) for every pair of labels that occur, zeros included."""
    n = df.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull()).groupBy(F.col(predicted).alias("pred"), F.col(actual).alias("actual")).agg(F.count("*").alias("n"))
    labels = n.select(F.explode(F.array("pred", "actual")).alias("label")).distinct()
    every = labels.groupBy().agg(F.array_sort(F.collect_set("label")).alias("l"))
    grid = every.select(F.explode("l").alias("pred"), "l").select("pred", F.explode("l").alias("actual"))
    return grid.join(n, ["pred", "actual"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def confusion_totals(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts by cube (NULL: total) with their share of all rows in percent."""
    c = df.where(F.col(predicted).isNotNull() & F.col(actual).isNotNull()).cube(F.col(predicted).alias("pred"), F.col(actual).alias("actual")).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    return c.withColumn("pct", F.col("n") * 100.0 / F.max("n").over(Window.partitionBy(F.lit(1))))


def class_accuracy(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    ok = F.count_if(F.col(predicted) == F.col(actual))
    return df.groupBy(F.col(actual).alias("actual")).agg(F.count("*").alias("n"), (ok * 100.0 / F.count("*")).alias("ok_pct"), ((F.count("*") - ok) * 100.0 / F.count("*")).alias("error_pct"))


def reduce_features(df: DataFrame, features: list[str], label: str, percentage: float = 100.0) -> list[str]:
    """Recursive elimination: drop the feature with the least squared weight in an elastic-net
    logistic model until `percentage` of the features are left."""
    keep = list(features)
    want = max(1, int(len(features) * percentage / 100.0))
    while len(keep) > want:
        stages = [StringIndexer(inputCol=label, outputCol="_label"), VectorAssembler(inputCols=keep, outputCol="_features")]
        lr = LogisticRegression(labelCol="_label", featuresCol="_features", elasticNetParam=0.5, regParam=0.01, maxIter=50)
        weights = Pipeline(stages=[*stages, lr]).fit(df).stages[-1].coefficientMatrix.toArray()
        keep.pop(int((weights**2).sum(axis=0).argmin()))
    return keep


def pca_features(df: DataFrame, features: list[str], explained: float = 75.0) -> list[str]:
    """The top loading of each component, until the components explain enough; sorted."""
    data = VectorAssembler(inputCols=features, outputCol="_features").transform(df)
    model = PCA(k=len(features), inputCol="_features", outputCol="_pc").fit(data)
    total, chosen, loadings = 0.0, set(), model.pc.toArray()
    for i, share in enumerate(model.explainedVariance.toArray()):
        if total >= explained:
            break
        total += round(share * 100, 1)
        chosen.add(features[int(abs(loadings[:, i]).argmax())])
    return sorted(chosen)
