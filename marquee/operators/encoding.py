"""One-hot vectors of numbered categories, for any number of them.

The ML library's encoder and assembler name every entry of their vectors in the schema, which the
driver holds: an object or more for each category. Here the schema says how long a vector is, and
nothing about its entries.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_hot(sizes: Sequence[int], numbers: Sequence[float], before=None) -> SparseVector:
    """`before`, if there is one, then a vector for each number: a one at its place, none for the
    last number, which missing and unseen categories have."""
    at, found, width = [], [], 0
    if before is not None:
        dense = before.toArray()
        at, width = np.flatnonzero(dense).tolist(), len(dense)
        found = dense[at].tolist()
    for size, number in zip(sizes, numbers, strict=True):
        if number is None or not 0 <= number < size or number != int(number):
            raise ValueError(f"{number} is no number of one of {size} categories")
        if number < size - 1:
            at.append(width + int(number))
            found.append(1.0)
        width += size - 1
    return SparseVector(width, at, found)


class _Shared(HasInputCols, HasOutputCol):
    """`inputCols` hold numbers; the vector of `after`, if set, comes before theirs."""

    after = Param(Params._dummy(), "after", "vector column that comes first", TypeConverters.toString)


class CategoryVectors(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Learns how many categories each column has, which its schema says."""

    def __init__(self, inputCols=(), outputCol="encoded", after=None):  # noqa: N803
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol)
        if after is not None:
            self._set(after=after)

    def _fit(self, df: DataFrame) -> CategoryVectorsModel:
        sizes = [df.schema[c].metadata["ml_attr"]["num_vals"] for c in self.getInputCols()]
        model = self._copyValues(CategoryVectorsModel())
        return model._set(sizes=sizes)


class CategoryVectorsModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    sizes = Param(Params._dummy(), "sizes", "categories of each column", TypeConverters.toListInt)

    @property
    def categorySizes(self) -> list[int]:  # noqa: N802
        return self.getOrDefault(self.sizes)

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes, numbers = self.categorySizes, F.array(*[F.col(c) for c in self.getInputCols()])
        if self.isSet(self.after):
            vector = F.udf(lambda x, v: one_hot(sizes, x, v), VectorUDT())
            return df.withColumn(self.getOutputCol(), vector(numbers, F.col(self.getOrDefault(self.after))))
        vector = F.udf(lambda x: one_hot(sizes, x), VectorUDT())(numbers)
        width = {"ml_attr": {"num_attrs": sum(sizes) - len(sizes)}}
        return df.withColumn(self.getOutputCol(), vector.alias(self.getOutputCol(), metadata=width))
