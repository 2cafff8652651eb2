"""Written tables of a job that are dropped as soon as nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusframe.scratch import remove_path, scratch_path


class Steps:
    """Tables written one after the other; what is never dropped stays in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables; results that still have to be computed must not need them."""
        for table in tables:
            remove_path(self.spark, self.paths.pop(id(table))[1])
