"""Vector expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from termlight.functions.text import bind


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalize(vector: Column) -> Column:
    """Scale to unit length; a zero vector stays as it is."""
    return bind(
        F.sqrt(dot(vector, vector)),
        lambda norm: F.transform(
            vector, lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double"))
        ),
    )
