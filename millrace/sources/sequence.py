"""The integer sequence source."""
from pyspark.sql import DataFrame, SparkSession


def sequence(spark: SparkSession, n: int, column: str = "i") -> DataFrame:
    """Integers 0..n-1 as a non-null bigint column, dealt over the default parallelism; empty if n <= 0."""
    return spark.range(max(n, 0)).toDF(column)
