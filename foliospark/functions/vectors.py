"""Vector functions: Catalyst expressions for arithmetic, Arrow functions where bytes are hashed."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# Codes of vectors that cannot be stored, and the tolerance of unit length.
CODES = ("invalid_vector", "invalid_dimensions", "nonfinite_vector", "zero_vector")
UNIT_TOLERANCE = 1e-5


def norm(v: Column) -> Column:
    """The Euclidean norm in double precision, summed in order."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def status(v: Column, dimensions: Column) -> Column:
    """The code of what is wrong with a vector, or null."""
    finite = F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.when(v.isNull() | F.exists(v, lambda x: x.isNull()), CODES[0])
        .when(F.size(v) != dimensions, CODES[1])
        .when(~finite, CODES[2])
        .when(F.forall(v, lambda x: x == 0), CODES[3])
    )


def _once(value: Column, use) -> Column:
    """use(x) with x bound to `value`, which is then evaluated once however often x occurs."""
    return F.transform(F.array(value), use)[0]


def normalized(v: Column) -> Column:
    """Unit length, as float32; a vector without a direction gives null.

    The norm is bound before it is used: written inside the element function it would be computed again
    for every element.
    """
    unit = lambda x, n: F.when((n > 0) & (n < float("inf")), F.transform(x, lambda e: (e.cast("double") / n).cast("float")))
    return _once(v, lambda x: _once(norm(x), lambda n: unit(x, n)))


def is_unit(v: Column) -> Column:
    return F.abs(norm(v) - 1) <= UNIT_TOLERANCE


def midpoint(a: Column, b: Column) -> Column:
    """The normalised half-and-half mean of two normalised vectors."""
    half = F.zip_with(normalized(a), normalized(b), lambda x, y: x.cast("double") * 0.5 + y.cast("double") * 0.5)
    return normalized(half)


@pandas_udf(T.StringType())
def vector_hash(v: pd.Series) -> pd.Series:
    """SHA-256 of the vector's little-endian float32 bytes; null for null."""
    return v.map(lambda x: None if x is None else hashlib.sha256(np.asarray(x, "<f4").tobytes()).hexdigest())


def weighted_mean(df: DataFrame, keys: list[str], vector: str, weight: str, order: str) -> DataFrame:
    """(keys, mean): the weighted mean of each group's vectors, position by position.

    One row per group and position is aggregated with partial sums, so a group of any size stays
    distributed. Sums are exact decimals of the products' float64 values only up to their order; use
    it where the last bit does not matter, and `ordered_mean` where it does.
    """
    parts = df.select(*keys, F.col(weight).cast("double").alias("w"), F.posexplode(vector).alias("pos", "x"))
    sums = parts.groupBy(*keys, "pos").agg((F.sum(F.col("w") * F.col("x").cast("double")) / F.sum("w")).alias("m"))
    return sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("mean"))


def ordered_mean(df: DataFrame, keys: list[str], vector: str, weight: str, order: str) -> DataFrame:
    """The same with float64 sums taken in the order of `order`, for bit-exact results.

    For groups that are small by definition, such as the parts of one text.
    """
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(weight).cast("double").alias("w"), F.col(vector).alias("v")))).alias("rows"))
    first = F.transform(F.col("rows")[0]["v"], lambda x: F.lit(0.0))
    total = F.aggregate("rows", first, lambda acc, r: F.zip_with(acc, r["v"], lambda a, x: a + r["w"] * x.cast("double")))
    weight_sum = F.aggregate("rows", F.lit(0.0), lambda acc, r: acc + r["w"])
    return rows.select(*keys, _once(weight_sum, lambda n: F.transform(total, lambda x: x / n)).alias("mean"))


def composite_identity(**fields: Column) -> Column:
    """SHA-256 of the compact JSON of the fields, their names in order."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)
