"""Trader segments, the win classifier and its metrics, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.storagelevel import StorageLevel

from tradewinds import vocab
from tradewinds.functions.trade import hash_uniform
from tradewinds.operators.ordered import running
from tradewinds.operators.performance import trader_aggs
from tradewinds.operators.regimes import best_kmeans, name_clusters
from tradewinds.operators.silver import realized_trades
from tradewinds.session import cut_lineage

SEGMENT_FEATURES = ["total_pnl", "win_rate", "avg_leverage", "avg_trade_size", "trade_count", "profit_factor", "long_ratio"]
NUMERIC = ["leverage", "size_usd", "sentiment_score", "hour"]
CATEGORICAL = ["trade_direction", "day_of_week", "coin"]
LABEL = "win_flag"


# ---- segments ---------------------------------------------------------------

def long_ratio() -> Column:
    """Share of long trades; an account without any gets 0.5, not 0."""
    share = F.avg(F.when(F.col("trade_direction") == "Long", 1.0).otherwise(0.0))
    return F.coalesce(F.nullif(share, F.lit(0.0)), F.lit(0.5))


def trader_features(silver: DataFrame) -> DataFrame:
    """Seven numbers per account in one aggregation; an infinite profit factor becomes 100, an undefined one 1."""
    factor = F.col("profit_factor")
    bounded = F.when(factor.isNull() | F.isnan(factor), 1.0).when(F.abs(factor) == float("inf"), 100.0).otherwise(factor)
    return realized_trades(silver).groupBy("account").agg(*trader_aggs(), long_ratio().alias("long_ratio")).withColumn(
        "profit_factor", bounded).select("account", *SEGMENT_FEATURES)


def trader_segments(features: DataFrame, k: int = 4, seeds: Sequence[int] = range(42, 52)) -> DataFrame:
    """K-means personas; fewer accounts than clusters, or a degenerate fit, leave every account in the rest group."""
    features = cut_lineage(features)  # one row per account, read by every step below
    clustered = best_kmeans(features, SEGMENT_FEATURES, k, seeds) if features.limit(k).count() == k else None
    rest = "Conservative / Tactical Retail"
    if clustered is None:
        return features.withColumns({"segment_id": F.lit(0), "trader_segment": F.lit(rest)})
    named = name_clusters(
        clustered,
        [("Systematic Scalpers", "trade_count", True),
         ("Institutional Whales", "total_pnl", True),
         ("High-Leverage Speculators", "avg_leverage", True)],
        rest, "trader_segment")
    return named.withColumnRenamed("cluster_id", "segment_id")


def segment_summary(segments: DataFrame) -> DataFrame:
    return segments.groupBy("trader_segment").agg(
        F.count(F.lit(1)).alias("traders"), *[F.avg(c).alias(f"avg_{c}".replace("avg_avg_", "avg_")) for c in SEGMENT_FEATURES])


# ---- features and split -----------------------------------------------------

def feature_stages() -> list:
    """Numbers plus one-hot categories; a level unseen in training encodes as all zeros."""
    indexed = [f"_{c}_index" for c in CATEGORICAL]
    encoded = [f"_{c}_vector" for c in CATEGORICAL]
    return [
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*NUMERIC, *encoded], outputCol="features", handleInvalid="keep"),
    ]


def candidate_rows(silver: DataFrame) -> DataFrame:
    return realized_trades(silver).select("trade_id", "fill_seq", LABEL, *NUMERIC, *CATEGORICAL)


def model_rows(silver: DataFrame) -> DataFrame:
    """The rows to learn from: realized trades that have all their numbers."""
    return candidate_rows(silver).dropna(subset=NUMERIC)


def encode_features(rows: DataFrame) -> PipelineModel:
    return Pipeline(stages=feature_stages()).fit(rows)


def feature_names(encoder: PipelineModel) -> list[str]:
    names = list(NUMERIC)
    for column, labels in zip(CATEGORICAL, encoder.stages[0].labelsArray):
        names += [f"{column}_{label}" for label in labels]
    return names


def stratified_split(df: DataFrame, key: str = "fill_seq", test: float = 0.3) -> DataFrame:
    """Add ``is_test`` by a hash of the key: about ``test`` of the rows, and so about that share of every label's."""
    return df.withColumn("is_test", hash_uniform(f"cast({key} as string)") < test)


def stratified_split_exact(df: DataFrame, label: str = LABEL, key: str = "fill_seq", test: float = 0.3) -> DataFrame:
    """Like ``stratified_split`` with exactly round(test * rows) test rows per label, in hash order."""
    sizes = df.groupBy(label).agg(F.round(F.count(F.lit(1)) * F.lit(test)).cast("bigint").alias("_want"))
    ranked = running(df.withColumn("_u", hash_uniform(f"cast({key} as string)")), [label], ["_u", key],
                     {"_i": ("count", None)})
    return ranked.join(sizes, label).withColumn("is_test", F.col("_i") <= F.col("_want")).drop(
        "_u", "_i", "_want")


# ---- metrics ----------------------------------------------------------------

def confusion_counts(scored: DataFrame, label: str = LABEL, pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return scored.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve: wins and losses per distinct score, then losses below each score."""
    per_score = scored.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    below = running(per_score, list(by), [score], {"_neg_to": ("sum", F.col("_neg"))})
    # doubles, because the number of (win, loss) pairs overflows 64 bits long before the data does
    pairs = F.col("_pos").cast("double") * (F.col("_neg_to") - F.col("_neg") / 2.0)
    return below.groupBy(*by).agg(F.try_divide(
        F.sum(pairs), F.sum("_pos").cast("double") * F.sum("_neg").cast("double")).alias("roc_auc"))


def classification_metrics(scored: DataFrame, label: str = LABEL, pred: str = "prediction", score: str = "probability",
                           by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on an empty denominator), confusion counts and ROC-AUC per group."""
    zero = F.lit(0.0)
    c = confusion_counts(scored, label, pred, by).withColumns({
        "accuracy": F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
        "precision": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero),
        "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero),
        "f1_score": F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero),
    })
    auc = roc_auc(scored, label, score, by)
    columns = [*by, "accuracy", "precision", "recall", "f1_score", "roc_auc", "tn", "fp", "fn", "tp"]
    if by:
        return c.join(auc, list(by)).select(*columns)
    return c.withColumn("roc_auc", auc.scalar()).select(*columns)


def select_best(comparison: DataFrame, metric: str = "f1_score", ordinal: str = "ordinal") -> DataFrame:
    """Highest metric; the earlier model wins a tie."""
    return comparison.orderBy(F.desc(metric), ordinal).limit(1)


# ---- training ---------------------------------------------------------------

def classifiers(train_rows: int, trees: int = 100, depth: int = 12, boosted: bool = False, rounds: int = 100) -> dict:
    common = {"labelCol": LABEL, "featuresCol": "features", "seed": 42}
    models = {
        "Random Forest": RandomForestClassifier(numTrees=trees, maxDepth=depth, maxMemoryInMB=1024, **common),
        # an L2 penalty of 1/n is the unit inverse-regularisation of the usual single-node solver
        "Logistic Regression": LogisticRegression(
            labelCol=LABEL, featuresCol="features", maxIter=1000, regParam=1.0 / max(train_rows, 1), standardization=False),
    }
    if boosted:
        models["Gradient Boosting"] = GBTClassifier(maxIter=rounds, maxDepth=min(depth, 6), stepSize=0.1, **common)
    return models


def scored_rows(model, rows: DataFrame) -> DataFrame:
    """The rows with ``win_probability`` and ``prediction`` of a fitted model."""
    out = model.transform(rows)
    return out.withColumn("win_probability", vector_to_array("probability")[1]).withColumn(
        "prediction", F.col("prediction").cast("int")).drop("probability", "rawPrediction")


def train_compare(silver: DataFrame, trees: int = 100, depth: int = 12, boosted: bool = False,
                  names: Sequence[str] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit the candidate classifiers and compare them on the held-out rows.

    Returns the comparison table (one row per model) and the fitted models,
    each able to score raw silver rows. ``boosted`` adds gradient-boosted trees.
    """
    # every tree level and every optimizer step reads the training rows: spread them evenly once
    spark = silver.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = stratified_split_exact(model_rows(silver)).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    encoder = encode_features(train)
    encoded = encoder.transform(train).select(LABEL, "features").persist(StorageLevel.MEMORY_AND_DISK)
    candidates = classifiers(encoded.count(), trees, depth, boosted)
    held_out = encoder.transform(test).select("fill_seq", LABEL, "features")
    models, tables = {}, []
    for ordinal, (name, estimator) in enumerate(candidates.items()):
        if names is not None and name not in names:
            continue
        fitted = estimator.fit(encoded)
        models[name] = PipelineModel(stages=[*encoder.stages, fitted])
        # scored once and stored; both the counts and the curve read the stored scores
        scored = cut_lineage(scored_rows(fitted, held_out).select(LABEL, "prediction", "win_probability"))
        tables.append(classification_metrics(scored, score="win_probability").select(
            F.lit(ordinal).alias("ordinal"), F.lit(name).alias("model"), "*"))
    comparison = tables[0]
    for t in tables[1:]:
        comparison = comparison.unionByName(t)
    encoded.unpersist()
    rows.unpersist()
    return comparison, models


def feature_importance(model: PipelineModel) -> DataFrame:
    """Tree importances or absolute coefficients by feature name; one row per encoded feature."""
    fitted = model.stages[-1]
    values = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    names = feature_names(PipelineModel(stages=model.stages[:-1]))
    rows = [(n, abs(float(v))) for n, v in zip(names, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def predict_wins(model: PipelineModel, trades: DataFrame, cut: float = 0.55) -> DataFrame:
    """Score a table of trades: probability, label and the sizing action. A trade that lacks a number has no score and is not approved."""
    known = F.lit(True)
    for c in NUMERIC:
        known = known & F.col(c).isNotNull()
    scored = scored_rows(model, trades).withColumns({
        c: F.when(known, F.col(c)) for c in ("win_probability", "prediction")})
    return scored.withColumn(
        "action", F.when(F.col("win_probability") >= cut, "APPROVED").otherwise("SIZE DOWN / REJECT")).select(
        *trades.columns, "win_probability", "prediction", "action")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---- attribution ------------------------------------------------------------

def linear_attribution(encoded: DataFrame, key: str, features: Sequence[str], importances: dict[str, float],
                       baselines: dict[str, float] | None = None) -> DataFrame:
    """Push of every feature on every trade: its relative distance from a baseline, times importance, times a sign.

    ``vocab.ATTRIBUTION_RULES`` holds, by feature name, the baseline, the unit of
    distance, and the sign up to and above a turning point; flags have one rule
    in common. The rules meet the trades as one row per feature.
    """
    rules = []
    for feature in features:
        center, scale, turn, below, above = vocab.ATTRIBUTION_RULES.get(feature, vocab.FLAG_RULE)
        if baselines is not None and feature in baselines:
            center = baselines[feature]
            scale = center if center > 0 else 1.0
        weight = importances.get(feature, vocab.DEFAULT_IMPORTANCE)
        rules.append(F.struct(F.lit(feature).alias("feature"), F.col(feature).cast("double").alias("feature_value"), *(
            F.lit(float(v)).alias(n) for n, v in (("center", center), ("scale", scale), ("turn", turn), ("below", below * weight), ("above", above * weight)))))
    long = encoded.select(key, F.explode(F.array(*rules)).alias("r")).select(key, "r.*")
    return long.select(key, "feature", "feature_value", F.expr(
        "(feature_value - center) / scale * if(feature_value > turn, above, below)").alias("attribution"))


def ranked_attribution(attributions: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Each trade's features by absolute push, largest first; a trade has few features, so groups are tiny."""
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("attribution")), "feature")
    ranked = attributions.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= top) if top else ranked


def global_attribution(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("importance"))

