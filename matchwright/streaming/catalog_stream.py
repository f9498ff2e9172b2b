"""Rule cleaning of listings as they arrive: the batch plan over a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchwright.operators.cleaning import l0_clean
from matchwright.plans.policy import CatalogConfig
from matchwright.sources.catalog import RAW


def read_listings(spark: SparkSession, folder: str, schema: T.StructType = RAW) -> DataFrame:
    return spark.readStream.schema(schema).json(folder)


def clean_stream(listings: DataFrame, config: CatalogConfig, out: str, checkpoint: str) -> StreamingQuery:
    """Appends cleaned listings to Parquet; the checkpoint makes each file count once."""
    return l0_clean(listings, config).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
