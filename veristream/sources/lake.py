"""The lake: Parquet tables in the layers bronze, silver and gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from veristream.sources import files

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def has(self, spark: SparkSession, layer: str, name: str) -> bool:
        return files.exists(spark, self.path(layer, name))

    def read(
        self, spark: SparkSession, layer: str, name: str, schema: T.StructType | None = None
    ) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(self.path(layer, name))

    def write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        """Write the table and hand it back as read from disk."""
        df.write.mode("overwrite").parquet(self.path(layer, name))
        return df.sparkSession.read.schema(df.schema).parquet(self.path(layer, name))
