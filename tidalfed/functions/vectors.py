"""Functions on ``array<double>`` columns and on linear-model structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidalfed.schemas import LINEAR_WEIGHTS


def dot(features: Sequence[Column], weights: Column) -> Column:
    """Inner product for a fixed number of features, unrolled so that it is generated code."""
    terms = [x * weights[j] for j, x in enumerate(features)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def dot_arrays(left: Column, right: Column) -> Column:
    """Inner product of two arrays of any common length."""
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def l2_norm(weights: str | Column) -> Column:
    return F.sqrt(F.aggregate(weights, F.lit(0.0), lambda s, x: s + x * x))


def head(weights: str | Column, length: int = 3) -> Column:
    return F.slice(weights, 1, length)


def tail(values: Column, length: int) -> Column:
    """Last elements; all of them when there are fewer."""
    size = F.size(values)
    return F.when(size > length, F.slice(values, -length, length)).otherwise(values)


def model_text(model: str | Column) -> Column:
    """JSON text of a model struct; missing parts are left out."""
    return F.to_json(model)


def model_struct(text: str | Column, schema: str = LINEAR_WEIGHTS) -> Column:
    """Model struct of a JSON text; missing parts are null."""
    return F.from_json(text, schema)


def zeros(length: int) -> Column:
    return F.array_repeat(F.lit(0.0), length)
