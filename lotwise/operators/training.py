"""Training rows, preparation, encoding, grid search and storage of price models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from operator import or_
from statistics import fmean

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.util import inheritable_thread_target

from lotwise import vocab as V
from lotwise.functions.text import safe_flag, safe_text
from lotwise.operators import boosting
from lotwise.operators.dedup import keep_first
from lotwise.operators.medians import column_medians
from lotwise.operators.ranking import with_global_rank, with_ordinal
from lotwise.session import ensure_checkpoint_dir, scratch_path
from lotwise.sources.store import require_rows, write_table

KEY = "listing_id"
SEED = 42
#: training rows that make a task of their own; every tree level is a job, so small tables are kept in few tasks
ROWS_PER_TASK = 50_000


def _parents(listings: DataFrame, market: str) -> DataFrame:
    """Parents of one market only: ids are unique inside a market, and its partition is all that is read."""
    if "market" in listings.columns:
        listings = listings.where(F.col("market") == market)
    return listings.select(
        F.col("id").alias(KEY), "price", "mileage", *[safe_text(F.col(c)).alias(c) for c in ("brand", "model")]
    ).where(F.col("price").isNotNull())


def training_rows_de(
    listings: DataFrame, details: DataFrame, features: DataFrame, feature_order: Sequence[str] | None = None
) -> DataFrame:
    """DE rows with a price, a parent and features.

    Of several feature rows the first by ``feature_order`` counts, by all columns if there is no such order.
    """
    one = keep_first(features, [KEY], feature_order or [c for c in features.columns if c != KEY])
    kept = [c for c in one.columns if c != KEY and c not in (feature_order or ())]
    children = details.select(
        KEY, "car_age", "power_ps", "owners", *[safe_text(F.col(c)).alias(c) for c in ("transmission", "fuel")]
    )
    return _parents(listings, "DE").join(children, KEY).join(one.select(KEY, *kept), KEY)


def training_rows_us(listings: DataFrame, details: DataFrame) -> DataFrame:
    """US rows with a price and a parent."""
    texts = [c for c in V.CATEGORICAL["US"] if c not in ("brand", "model")]
    children = details.select(
        KEY, *V.US_TRAIN_NUMERIC,
        *[safe_text(F.col(c)).alias(c) for c in texts],
        *[safe_flag(F.col(c)).alias(c) for c in V.US_TRAIN_FLAGS],
    )
    return _parents(listings, "US").join(children, KEY)


def eligible(rows: DataFrame, market: str, excluded: str | None = V.US_EXCLUDED_BRAND) -> DataFrame:
    """Rows with price, mileage and age; for US without the excluded brand (a missing brand stays)."""
    if market == "US" and excluded:
        rows = rows.where(~F.coalesce(F.lower("brand").contains(excluded.lower()), F.lit(False)))
    return rows.dropna(subset=[V.TARGET, "mileage", "car_age"])


def impute(rows: DataFrame, market: str) -> tuple[DataFrame, dict[str, float]]:
    """Fill missing numbers with the exact median of their column; the medians come back as well.

    The medians are at most five numbers, the only thing that reaches the driver.
    """
    columns = [c for c in V.IMPUTED[market] if c in rows.columns]
    medians = {r["column"]: r["median"] for r in column_medians(rows, columns).collect()} if columns else {}
    typed = rows.withColumns({c: F.col(c).cast("double") for c in columns})
    return (typed.fillna(medians) if medians else typed), medians


def feature_columns(columns: Sequence[str], market: str) -> tuple[list[str], list[str]]:
    """Categorical columns that are present, and all other feature columns."""
    categorical = [c for c in V.CATEGORICAL[market] if c in columns]
    numeric = [c for c in columns if c not in (*categorical, V.TARGET, KEY)]
    return numeric, categorical


def encoder(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Sorted categories to indicator columns; unseen and missing ones give all zeros."""
    index = [f"{c}__index" for c in categorical]
    hot = [f"{c}__hot" for c in categorical]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
            VectorAssembler(inputCols=[*numeric, *hot], outputCol="features", handleInvalid="keep"),
        ]
    )


def fit_encoder(rows: DataFrame, market: str) -> PipelineModel:
    """The encoder that a price model of these rows has; it is known before any tree."""
    kept = require_rows(eligible(rows, market), "no row is left to train on")
    return encoder(*feature_columns(kept.columns, market)).fit(kept)


def vocabulary(fitted: PipelineModel) -> dict[str, list[str]]:
    """Sorted categories per encoded column."""
    indexer = next(s for s in fitted.stages if isinstance(s, StringIndexerModel))
    return dict(zip(indexer.getInputCols(), map(list, indexer.labelsArray)))


def vocabulary_rows(rows: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """``(feature, pos, category)``: the sorted categories of every column, as an encoder numbers them."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in categorical]))
    found = rows.select(pairs.alias("p")).select("p.*").where(F.col("category").isNotNull()).distinct()
    return with_ordinal(found, ["feature"], ["category"], "pos", start=0).select("feature", "pos", "category")


def feature_names(fitted: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """Names of the vector's slots: numbers as they are, indicators as ``<column>_<category>``."""
    return [*numeric, *[f"{c}_{v}" for c, values in vocabulary(fitted).items() for v in values]]


def one_hot_rows(fitted: PipelineModel, rows: DataFrame, key: str = KEY) -> DataFrame:
    """The indicator part of the matrix as rows ``(key, feature)``, one per set indicator."""
    sizes = {c: len(v) for c, v in vocabulary(fitted).items()}
    indexed = fitted.stages[0].transform(rows)
    # a known category's name is in the row already
    names = [F.when(F.col(f"{c}__index") < n, F.concat(F.lit(f"{c}_"), F.col(c))) for c, n in sizes.items()]
    return indexed.select(key, F.explode(F.array_compact(F.array(*names))).alias("feature"))


def split_rows(rows: DataFrame, test_share: float = 0.2, folds: int = 3, seed: int = SEED) -> DataFrame:
    """Add ``is_test`` (exactly the rounded-up share) and ``fold``.

    The order is a hash of the row's key, so the split depends neither on partitions nor on input order.
    """
    hashed = rows.withColumn("__h", F.xxhash64(KEY, F.lit(seed)))
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = with_global_rank(hashed, "__h", "__r", block_width=2**44, ties=[KEY])
    return (
        ranked.withColumn("is_test", F.col("__r") <= F.ceil(total * F.lit(test_share)))
        .withColumn("fold", (F.col("__r") % folds).cast("int"))
        .drop("__h", "__r")
    )


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error and R² of ``prediction`` against the price, in one aggregate."""
    error = F.col(V.TARGET) - F.col("prediction")
    n = F.count(F.lit(1))
    spread = F.sum(F.col(V.TARGET) ** 2) - F.sum(V.TARGET) ** 2 / n
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), (1 - F.try_divide(F.sum(error**2), spread)).alias("r2"), n.alias("rows")
    )


@dataclass(frozen=True)
class PriceModel:
    """A fitted encoder and regressor with what scoring needs to know about them."""

    market: str
    pipeline: PipelineModel
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]

    @property
    def names(self) -> list[str]:
        return feature_names(self.pipeline, self.numeric)

    @property
    def regressor(self):
        return self.pipeline.stages[-1]


@dataclass(frozen=True)
class Choice:
    """One combination of a grid and its cross-validated mean absolute error."""

    params: dict[str, float]
    error: float


def search(
    train: DataFrame, booster: GBTRegressor, grid: Mapping[str, Sequence], folds: int = 3, parallelism: int | None = None,
    packed: boosting.Packed | None = None,
) -> list[Choice]:
    """Every combination of ``grid`` over ``train`` with its ``fold``, in the order of the grid.

    A tree depends on the trees before it and on its own seed, not on those to come: the first trees of a long fit
    *are* the shorter fit. So each combination of the other parameters is fitted once per fold, with the largest
    number of trees, and judged at every number. Fits run side by side, as many as fill the cores twice: each holds
    its rows in bins, some thousand bytes a row, and the fit of a large table fills the cores alone. With ``packed``
    rows each fit is one task.
    """
    spark = train.sparkSession
    counts = list(grid.get("maxIter", [booster.getMaxIter()]))
    others = [n for n in grid if n != "maxIter"]
    combinations = list(product(*(grid[n] for n in others)))

    def judged(job: tuple[tuple, int]) -> list[float]:
        values, fold = job
        params = {booster.getParam(n): v for n, v in zip(others, values)} | {booster.maxIter: max(counts)}
        fitted = booster.fit(train.where(F.col("fold") != fold), params)
        errors = fitted.evaluateEachIteration(train.where(F.col("fold") == fold), "absolute")
        return [errors[c - 1] for c in counts]

    jobs = list(product(combinations, range(folds)))
    if packed:
        by_place = boosting.errors(packed, booster, [dict(zip(others, values)) for values in combinations], folds, counts)
        found = {(combinations[i], fold): errors for (i, fold), errors in by_place.items()}
    else:
        cores = spark.sparkContext.defaultParallelism
        side_by_side = min(cores, -(-2 * cores // max(1, train.rdd.getNumPartitions())))
        with ThreadPool(min(len(jobs), parallelism or side_by_side)) as pool:
            found = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(judged), jobs)))
    out = []
    for choice in product(*grid.values()):
        params = dict(zip(grid, choice))
        place = counts.index(params.get("maxIter", counts[0]))
        values = tuple(params[n] for n in others)
        out.append(Choice(params, fmean(found[values, fold][place] for fold in range(folds))))
    return out


def fit_price_model(
    rows: DataFrame, market: str, grid: Mapping[str, Sequence] | None = None, folds: int = 3,
    parallelism: int | None = None, test_share: float = 0.2, subsets: str = "auto",
) -> tuple[PriceModel, DataFrame]:
    """Impute, encode, search the grid by cross-validated error, and refit the best on all training rows.

    Returns the model and its scored hold-out rows, which are written to the shared folder. Of equal errors the
    first in the grid wins. Training rows that fit in one task go to the fits in blocks (``boosting``), a fit is a task
    then. Larger tables are trained by MLlib: the prepared rows are kept in memory or on disk while the search
    runs, because every tree reads them.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    grid = grid or V.GRIDS[market]
    kept = require_rows(eligible(rows, market), "no row is left to train on")
    filled, medians = impute(kept, market)
    numeric, categorical = feature_columns(filled.columns, market)
    fitted = encoder(numeric, categorical).fit(filled)
    lacking = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in numeric]
    counted = filled.agg(F.count(F.lit(1)), F.count_if(reduce(or_, lacking, F.lit(False)))).first()
    # rows move before they are encoded, and into as many tasks as they need: by their bytes Spark would make few large ones
    tasks = 1 + counted[0] // ROWS_PER_TASK
    moved = split_rows(filled, test_share, folds).repartition(tasks, KEY).sortWithinPartitions(KEY)
    # a row finds its node by walking the tree, a few steps; stored node ids would be one more table per level
    booster = GBTRegressor(labelCol=V.TARGET, seed=SEED, featureSubsetStrategy=subsets, cacheNodeIds=False)
    sizes = [len(v) for v in vocabulary(fitted).values()]
    in_one = not counted[1] and boosting.suits(booster, grid, counted[0], len(numeric), sizes)
    prepared = fitted.transform(moved)
    if in_one:
        prepared = fitted.transform(moved.persist(StorageLevel.MEMORY_AND_DISK))
        indexed = [f"{c}__index" for c in categorical]
        packed = boosting.pack(prepared.where(~F.col("is_test")), KEY, V.TARGET, numeric, indexed, sizes)
    prepared = prepared.select(KEY, V.TARGET, "features", "is_test", "fold")
    if not in_one:
        packed, prepared = None, prepared.persist(StorageLevel.MEMORY_AND_DISK)
    train = prepared.where(~F.col("is_test"))
    choices = search(train, booster, grid, folds, parallelism, packed)
    chosen = min(choices, key=lambda c: c.error)
    if packed:
        best = boosting.fit(packed, booster, chosen.params, len(numeric) + sum(sizes))
    else:
        best = booster.fit(train, {booster.getParam(n): v for n, v in chosen.params.items()})
    model = PriceModel(market, PipelineModel([*fitted.stages, best]), numeric, categorical, medians)
    scored = best.transform(prepared.where("is_test")).select(KEY, V.TARGET, "prediction")
    scored = write_table(scored, scratch_path(spark, "holdout"))
    (moved if packed else prepared).unpersist()
    return model, scored


def _suffix(market: str) -> str:
    return "" if market == "DE" else f"_{market.lower()}"


def save_model(spark: SparkSession, model: PriceModel, root: str) -> None:
    """Write the fitted stages and their metadata below ``root``."""
    path = f"{root.rstrip('/')}/car_price{_suffix(model.market)}"
    model.pipeline.write().overwrite().save(f"{path}/stages")
    meta = [(model.market, model.numeric, model.categorical, model.medians)]
    schema = "market string, numeric array<string>, categorical array<string>, medians map<string,double>"
    spark.createDataFrame(meta, schema).write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark: SparkSession, root: str, market: str) -> PriceModel | None:
    """The stored model of a market, None when it is not complete."""
    path = f"{root.rstrip('/')}/car_price{_suffix(market)}"
    schema = "market string, numeric array<string>, categorical array<string>, medians map<string,double>"
    try:
        meta = spark.read.schema(schema).json(f"{path}/metadata").first()
        pipeline = PipelineModel.load(f"{path}/stages")
    except Exception as error:  # a missing path surfaces as one of several JVM errors
        if isinstance(error, AnalysisException) or "not exist" in str(error) or "empty collection" in str(error):
            return None
        raise
    if meta is None:
        return None
    return PriceModel(market, pipeline, list(meta["numeric"]), list(meta["categorical"]), dict(meta["medians"] or {}))
