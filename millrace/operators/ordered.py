"""Concatenation with an explicit order, since a DataFrame has none of its own."""
from functools import reduce

from pyspark.sql import DataFrame


def in_order(*parts: DataFrame, by: str = "seq") -> DataFrame:
    """Bag union of the parts by column name, sorted by `by`, which every part must carry."""
    return reduce(DataFrame.unionByName, parts).orderBy(by)
