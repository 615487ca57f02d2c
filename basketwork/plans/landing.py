"""Landing the sample feeds as raw files, the form in which feeds arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.session import shared_dir
from basketwork.sources import documents, lake, sample_feeds

OLDER, NEWER = dt.datetime(2001, 11, 4, 6), dt.datetime(2001, 11, 5, 6)


def pages_of(products: DataFrame, page_size: int = documents.PAGE_SIZE) -> DataFrame:
    """Products as API pages of at most `page_size` rows, numbered upwards with gaps.

    Rows are numbered within their partition, so no page grows with the copies
    of one product.
    """
    numbered = products.withColumn("page", F.floor(F.monotonically_increasing_id() / page_size) + 1)
    last = numbered.select(F.max("page")).scalar()
    fields = schemas.PRODUCTS.fields
    item = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return (
        numbered.groupBy("page")
        .agg(F.collect_list(item).alias("data"))
        .select(
            "page",
            F.lit(documents.PAGE_OK).alias("status"),
            "data",
            F.struct((F.col("page") < last).alias("has_next")).alias("pagination"),
        )
    )


_landed: dict[tuple[str, str], dict[str, str]] = {}


def landed_feeds(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Raw drops of the sample feeds, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        name = sf_dir.strip("/").replace("/", "_")
        _landed[key] = land(spark, sf_dir, f"{shared_dir(spark)}/{key[0]}/{name}/lake")
    return _landed[key]


def land(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write two customer drops, the product pages and both document exports, all compressed."""
    feeds = sample_feeds.all_feeds(spark, sf_dir)
    customers = feeds["customers"]
    outdated = customers.filter(F.col("registration_date") < F.lit(sample_feeds.AS_OF))
    prefix = lake.CUSTOMER_PREFIX.rstrip("_")
    lake.write_csv(outdated, root, "raw", prefix, OLDER, "gzip")
    lake.write_csv(customers, root, "raw", prefix, NEWER, "gzip")
    return {
        "root": root,
        "products": lake.write_json(pages_of(feeds["products"]), root, "raw", "products", NEWER, "gzip"),
        "marketing_campaigns": lake.write_json(
            feeds["marketing_campaigns"], root, "raw", "marketing_campaigns", NEWER, "gzip"
        ),
        "sales_transactions": lake.write_json(feeds["sales_transactions"], root, "raw", "sales_transactions", NEWER, "gzip"),
    }
