"""Building the star schema once and reading it many times."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork.operators import star
from basketwork.operators.warehouse import Warehouse
from basketwork.session import shared_dir
from basketwork.sources import sample_feeds
from basketwork.sources.tables import Layout, stored, stored_fact, write_dimension, write_fact


def build(
    feeds: dict[str, DataFrame],
    path: str,
    as_of: dt.date | None = None,
    loaded_at: Column | None = None,
    empty_campaign_as_null: bool = False,
    layout: Layout = Layout(),
    within: Sequence[str] = (),
) -> Warehouse:
    """Write the four tables under `path` and return them as stored.

    The dimensions are written first, side by side; the fact is filtered against the
    written tables, so no plan holds a dimension's cleaning twice. Every table is replaced as a
    whole: days of the fact that no longer have sales go. `within` names further columns of the sales feed that a
    transaction id determines and by which its rows are already dealt out (see `joins.first_per_key`).
    """
    spark = feeds["customers"].sparkSession
    dims = {
        "dim_customers": star.dim_customers(feeds["customers"], loaded_at),
        "dim_products": star.dim_products(feeds["products"], loaded_at),
        "dim_campaigns": star.dim_campaigns(feeds["marketing_campaigns"], as_of, loaded_at),
    }
    with ThreadPoolExecutor(len(dims)) as jobs:
        list(jobs.map(lambda item: write_dimension(item[1], item[0], f"{path}/{item[0]}"), dims.items()))
    customers, products, campaigns = (stored(spark, f"{path}/{name}") for name in dims)
    kept = star.kept_sales(
        feeds["sales_transactions"], customers, products, loaded_at, empty_campaign_as_null, within=within
    )
    keys = {"customer_id": customers, "product_id": products}
    write_fact(kept, f"{path}/fact_sales_transactions", layout, keys, star.with_derived)
    return Warehouse(customers, products, campaigns, stored_fact(spark, f"{path}/fact_sales_transactions"))


def load(spark: SparkSession, path: str) -> Warehouse:
    """A warehouse written by `build`."""
    return Warehouse(
        *(stored(spark, f"{path}/{n}") for n in ("dim_customers", "dim_products", "dim_campaigns")),
        stored_fact(spark, f"{path}/fact_sales_transactions"),
    )


# The sample's days have about 200 rows and fewer, far below a file.
SAMPLE_LAYOUT = Layout("month")
_built: dict[tuple[str, str], Warehouse] = {}


def _sample_path(spark: SparkSession, sf_dir: str) -> str:
    name = sf_dir.strip("/").replace("/", "_")
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}/warehouse"


def sample_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the built sample warehouse."""
    sample_warehouse(spark, sf_dir)
    return _sample_path(spark, sf_dir)


def sample_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of the sample feeds, built once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        loaded_at = F.lit(dt.datetime.combine(sample_feeds.AS_OF, dt.time(6)))
        feeds = {**sample_feeds.all_feeds(spark, sf_dir), "sales_transactions": sample_feeds.transactions(spark, sf_dir, with_order=True)}
        _built[key] = build(
            feeds, _sample_path(spark, sf_dir), sample_feeds.AS_OF, loaded_at, layout=SAMPLE_LAYOUT, within=[sample_feeds.ORDER]
        )
    return _built[key]
