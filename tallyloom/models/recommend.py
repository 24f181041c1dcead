"""Product recommendations: implicit-feedback ALS with holdout evaluation."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.models.indexing import dense_index
from tallyloom.models.pruned import top_items
from tallyloom.session import cut_lineage

USER, ITEM = "customer_unique_id", "product_id"


@dataclass(frozen=True)
class AlsSettings:
    # Training defaults.
    rank: int = 16
    reg_param: float = 0.1
    max_iterations: int = 10
    alpha: float = 40.0
    seed: int = 42
    top_k: int = 10
    train_percent: int = 90
    min_interactions: int = 2
    # Blocks of users and of items; their product is the number of rating groups,
    # so it follows the data and not the cluster.
    blocks: int = 10
    # Rows that one step of training or recommending stacks into a matrix.
    block_size: int = 4096


@dataclass(frozen=True)
class Recommender:
    model: ALSModel
    # The interactions it was fitted on, as written for the training.
    bought: DataFrame
    users: DataFrame
    items: DataFrame
    settings: AlsSettings
    rmse: float
    precision_at_k: float


def interactions(lines: DataFrame) -> DataFrame:
    """How often each customer bought each product, from fact lines that count."""
    return (
        lines.filter(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())
        .groupBy(USER, ITEM)
        .agg(F.count("*").cast("float").alias("rating"))
    )


def eligible_users(bought: DataFrame, minimum: int = AlsSettings.min_interactions) -> DataFrame:
    """Customers with enough distinct products to take part in the evaluation."""
    counts = bought.groupBy(USER).agg(F.count("*").alias("products"))
    return counts.filter(F.col("products") >= minimum)


def split_interactions(bought: DataFrame, settings: AlsSettings = AlsSettings()) -> DataFrame:
    """Mark rows as train or holdout.

    Rows of eligible customers are split by a hash of the pair and the seed, so
    the split does not depend on partitioning; all other rows train.
    """
    # One row for each product that a customer bought reaches this window.
    products = F.count("*").over(Window.partitionBy(USER))
    digest = F.md5(F.concat_ws("|", F.col(USER), F.col(ITEM), F.lit(settings.seed)))
    percent = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    held_out = (products >= settings.min_interactions) & (percent >= settings.train_percent)
    return bought.select(
        USER,
        ITEM,
        "rating",
        F.when(held_out, "holdout").otherwise("train").alias("part"),
    )


def precision_at_k(recommended: DataFrame, holdout: DataFrame, k: int) -> DataFrame:
    """Hits over holdout customers times k, as one row.

    Customers the model cannot recommend to stay in the denominator.
    """
    actual = holdout.select(USER, ITEM).distinct()
    hits = recommended.select(USER, ITEM).join(actual, [USER, ITEM]).agg(
        F.count("*").alias("hits")
    )
    users = actual.agg(F.count_distinct(USER).alias("users"))
    return users.select(
        "users",
        hits.scalar().alias("hits"),
    ).withColumn(
        "precision_at_k",
        F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("users") * k), F.lit(0.0)),
    )


def fit_recommender(
    bought: DataFrame, settings: AlsSettings = AlsSettings(), evaluate: bool = True
) -> Recommender:
    """Index, split, train and evaluate.

    Interactions and both indexes are read several times, in training and later
    in decoding, so they are written to the checkpoint folder once.  The training
    reads numbers only; ids are carried along where the holdout needs them.
    """
    known = cut_lineage(bought)
    users = cut_lineage(dense_index(known, USER, "user_idx"))
    items = cut_lineage(dense_index(known, ITEM, "item_idx"))
    indexed = (
        split_interactions(known, settings)
        .join(users, USER)
        .join(items, ITEM)
        .select("user_idx", "item_idx", "rating", "part", *((USER, ITEM) if evaluate else ()))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        if indexed.isEmpty():
            raise ValueError("no interactions to train on")
        model = ALS(
            userCol="user_idx",
            itemCol="item_idx",
            ratingCol="rating",
            rank=settings.rank,
            regParam=settings.reg_param,
            maxIter=settings.max_iterations,
            alpha=settings.alpha,
            seed=settings.seed,
            implicitPrefs=True,
            nonnegative=True,
            coldStartStrategy="drop",
            numUserBlocks=settings.blocks,
            numItemBlocks=settings.blocks,
            blockSize=settings.block_size,
        ).fit(indexed.filter(F.col("part") == "train"))
        fitted = Recommender(model, known, users, items, settings, float("nan"), 0.0)
        if not evaluate:
            return fitted
        return _evaluated(fitted, indexed.filter(F.col("part") == "holdout"))
    finally:
        indexed.unpersist()


def _evaluated(fitted: Recommender, holdout: DataFrame) -> Recommender:
    if holdout.isEmpty():
        return fitted
    evaluator = RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    )
    scored = fitted.model.transform(holdout)
    # Nothing is left to score where all rows are cold.
    rmse = float("nan") if scored.isEmpty() else float(evaluator.evaluate(scored))
    k = fitted.settings.top_k
    asked = holdout.select("user_idx").distinct()
    factors = fitted.model.userFactors.join(asked.withColumnRenamed("user_idx", "id"), "id", "left_semi")
    recommended = decode(fitted, top_items(factors, fitted.model.itemFactors, k).lists)
    precision = precision_at_k(recommended, holdout, k).first()["precision_at_k"]
    return replace(fitted, rmse=rmse, precision_at_k=float(precision))


def decode(fitted: Recommender, lists: DataFrame) -> DataFrame:
    """Ranked (customer, product, score) rows of lists by index, stamped with the run's time."""
    return (
        lists.join(fitted.users, "user_idx")
        .join(fitted.items, "item_idx")
        .select(
            USER,
            ITEM,
            F.col("rank").cast("short").alias("rank"),
            F.col("score").cast("float").alias("score"),
            F.current_timestamp().alias("generated_at"),
        )
    )


def recommend_all(
    fitted: Recommender, k: int | None = None, exclude_seen: DataFrame | None = None
) -> DataFrame:
    """Top products for every customer; pairs that cannot reach a list are not scored.

    With ``exclude_seen`` (customer and product pairs) those products are left
    out, and the list still has k products while others remain.
    """
    had = None
    if exclude_seen is not None:
        seen = exclude_seen.select(USER, ITEM).distinct()
        had = seen.join(fitted.users, USER).join(fitted.items, ITEM).select("user_idx", "item_idx")
    model = fitted.model
    found = top_items(model.userFactors, model.itemFactors, k or fitted.settings.top_k, had)
    return decode(fitted, found.lists)
