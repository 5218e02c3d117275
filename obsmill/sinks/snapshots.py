"""Tables that are replaced as a whole: each version in a folder of its own."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsmill.sinks.paths import exists


class SnapshotTable:
    """Versioned parquet table.

    A version is named in the commit log only after its folder is complete, so a lost job leaves
    the last version in force, and no job overwrites the files it reads.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def version(self) -> int:
        if not exists(self.spark, f"{self.path}/commits"):
            return 0
        log = self.spark.read.schema("version INT").json(f"{self.path}/commits")
        return log.agg(F.max("version")).first()[0] or 0

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The last version; before the first one an empty table, if its `schema` is given."""
        version = self.version()
        if version == 0 and schema is not None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.path}/version={version}")

    def replace(self, rows: DataFrame) -> int:
        version = self.version() + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        log = self.spark.range(1).select(F.lit(version).alias("version"))
        log.write.mode("append").json(f"{self.path}/commits")
        return version
