"""Stored tables that the registered queries share within one application."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import vocab as V
from lotwise.operators import features, market, scoring, training
from lotwise.plans import ingest
from lotwise.session import apply_settings, scratch_path
from lotwise.sources import driver_views as views
from lotwise.sources.store import Versions, bucket_count, write_table

AS_OF = "2026-01-15T12:00:00Z"
# no DE id reaches this: ids are unique inside a market, and over all listings as long as that holds
US_BASE = 1_000_000_000
#: how long a stored market view counts as current
VIEW_AGE = timedelta(seconds=600)
#: session setting with other tree counts for a trial, as in "5,10"; without it the grids are searched as they are
TREE_COUNTS = "lotwise.tree.counts"

_OPEN: dict[tuple[str, str], "Workspace"] = {}


def workspace(spark: SparkSession, sf_dir: str) -> "Workspace":
    apply_settings(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir)
    return _OPEN[key]


class Workspace:
    """Each table is derived from the given tables once, written to the shared folder and read from there."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_path(spark, "workspace")

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return write_table(df, f"{self.root}/{name}")

    @cached_property
    def raw_de(self) -> DataFrame:
        """Raw listings as a view: a query makes the columns that it reads, and none is written."""
        return views.raw_de(self.spark, self.sf_dir)

    @cached_property
    def raw_us(self) -> DataFrame:
        return views.raw_us(self.spark, self.sf_dir)

    @cached_property
    def de(self) -> ingest.Store:
        return ingest.run(self.raw_de, "DE", f"{self.root}/store", 1)

    @cached_property
    def us(self) -> ingest.Store:
        return ingest.run(self.raw_us, "US", f"{self.root}/store", 2, AS_OF, views.US_ORDER, US_BASE)

    @cached_property
    def documents(self) -> DataFrame:
        return views.feature_documents(self.spark, self.sf_dir)

    @cached_property
    def features(self) -> DataFrame:
        rows = features.document_features(self.documents)
        return ingest.store_features(rows, f"{self.root}/store", bucket_count(self.de.listings.count()))

    def _view(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return Versions(self.spark, f"{self.root}/store").cached(name, build, VIEW_AGE)

    @cached_property
    def view_de(self) -> DataFrame:
        """The market view, joined once and read from where it is stored by all that use it."""
        return self._view("market_view_de", lambda: market.market_view("DE", self.de.listings, self.de.details, self.features))

    @cached_property
    def view_us(self) -> DataFrame:
        return self._view("market_view_us", lambda: market.market_view("US", self.us.listings, self.us.details))

    @property
    def rows_de(self) -> DataFrame:
        return training.training_rows_de(self.de.listings, self.de.details, self.features)

    @property
    def rows_us(self) -> DataFrame:
        return training.training_rows_us(self.us.listings, self.us.details)

    def grid(self, market: str) -> dict[str, tuple]:
        """All combinations of the market's grid; only the tree counts can be set otherwise."""
        counts = self.spark.conf.get(TREE_COUNTS, None)
        return V.GRIDS[market] | ({"maxIter": tuple(map(int, counts.split(",")))} if counts else {})

    @cached_property
    def fitted_us(self) -> tuple[training.PriceModel, DataFrame]:
        model, scored = training.fit_price_model(self.rows_us, "US", self.grid("US"))
        return model, self._keep("scored_us", scored.select(training.KEY, "price", "prediction"))

    @cached_property
    def fitted_de(self) -> tuple[training.PriceModel, DataFrame]:
        model, scored = training.fit_price_model(self.rows_de, "DE", self.grid("DE"))
        return model, self._keep("scored_de", scored.select(training.KEY, "price", "prediction"))

    @property
    def known_rows(self) -> DataFrame:
        """Priced rows whose one telling feature has two values and is missing in every seventh row."""
        count = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderstatus") == "O", 2.0).otherwise(1.0)
        return self.table("orders").select(
            F.col("o_orderkey").alias(training.KEY), F.col("o_totalprice").alias("price"), F.lit(1.0).alias("mileage"),
            F.lit(1.0).alias("car_age"), count.alias("owner_count"), F.lit("x").alias("brand"),
        )

    @cached_property
    def known_model(self) -> training.PriceModel:
        """One split on that feature over all rows: its prices are the two groups' means."""
        grid = {"maxDepth": (1,), "stepSize": (0.1,), "maxIter": (1,)}
        return training.fit_price_model(self.known_rows, "US", grid, test_share=0.0)[0]

    @property
    def known_cars(self) -> DataFrame:
        return self.known_rows.withColumnRenamed(training.KEY, "subject_id")

    @property
    def cars_de(self) -> DataFrame:
        """Every DE listing with features as a subject; buyers and sellers alternate."""
        return scoring.subject_records(
            self.view_de.where(F.col("tuv_neu").isNotNull()).withColumnRenamed("id", "subject_id"), "DE"
        ).withColumn("role", F.when(F.col("subject_id") % 2 == 0, "buyer").otherwise("seller"))

    @property
    def cars_us(self) -> DataFrame:
        return scoring.subject_records(
            self.view_us.withColumnRenamed("id", "subject_id"), "US"
        ).withColumn("role", F.when(F.col("subject_id") % 2 == 0, "buyer").otherwise("seller"))
