"""String formatting on columns."""
from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(template: str, *values: Column) -> Column:
    """`template` with each %d or %s filled from `values`; a null value prints as "null"."""
    return F.format_string(template, *values)


def spaced(*values: Column) -> Column:
    """The non-null values with one space between them."""
    return F.concat_ws(" ", *values)
