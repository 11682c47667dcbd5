"""The five-step walkthrough: its sequence, its labelled steps, its result and its ordered transcript.

None of the four reads a table, so sf_dir goes unused and their results are the same at every scale.
"""
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import labelled, spaced
from millrace.operators import in_order
from millrace.sources import sequence

# The step count and the printed texts.
STEPS = 5
START = "Starting the application..."
STEP = "Processing step %d..."
DONE = "Done!"
RESULT = "Result:"


def seq(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    """i: 0 up to one less than the step count."""
    return sequence(spark, STEPS)


def steps(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    """Each i with its label, which counts from one."""
    return seq(spark).withColumn("line", labelled(STEP, F.col("i") + 1))


def result(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    """The single result value."""
    return sequence(spark, 1).select(F.lit(DONE).alias("result"))


def transcript(spark: SparkSession, sf_dir: str = "") -> DataFrame:
    """Everything printed, one line a row, numbered from one."""
    first = sequence(spark, 1).select(F.lit(1).cast("long").alias("seq"), F.lit(START).alias("line"))
    middle = steps(spark).select((F.col("i") + 2).alias("seq"), "line")
    last = result(spark).select(F.lit(STEPS + 2).cast("long").alias("seq"), spaced(F.lit(RESULT), F.col("result")).alias("line"))
    return in_order(first, middle, last)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"seq": seq, "steps": steps, "result": result, "transcript": transcript}

SQL: dict[str, str] = {
    "seq": "SELECT range AS i FROM range(5)",
    "steps": "SELECT range AS i, printf('Processing step %d...', range + 1) AS line FROM range(5)",
    "result": "SELECT 'Done!' AS result",
    "transcript": """
        SELECT 1::BIGINT AS seq, 'Starting the application...' AS line
        UNION ALL SELECT range + 2, printf('Processing step %d...', range + 1) FROM range(5)
        UNION ALL SELECT 7::BIGINT, concat_ws(' ', 'Result:', 'Done!')
        ORDER BY seq""",
}
