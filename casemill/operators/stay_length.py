"""Lengths of stay."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.uniform import uniform


def triangular_parameters(dms: DataFrame) -> DataFrame:
    """GHM5 -> left, mode, right; equal ends are one day apart and the mode lies between the ends."""
    left, right = F.col("DMS_P25").cast("double"), F.col("DMS_P75").cast("double")
    right = F.when(left == right, left + 1.0).otherwise(right)
    mode = F.greatest(left, F.least(F.col("DMS_P50").cast("double"), right))
    shape = F.struct(left.alias("left"), mode.alias("mode"), right.alias("right"))
    return dms.select("GHM5", shape.alias("dms_shape")).groupBy("GHM5").agg(F.max("dms_shape").alias("dms_shape"))


def triangular_days(u: Column, shape: Column) -> Column:
    """Inverse of the triangular distribution, rounded half to even, never negative; 1 without parameters."""
    left, mode, right = shape["left"], shape["mode"], shape["right"]
    width = right - left
    rising = left + F.sqrt(u * width * (mode - left))
    falling = right - F.sqrt((1 - u) * width * (right - mode))
    value = F.when(u < (mode - left) / width, rising).otherwise(falling)
    return F.when(shape.isNull(), F.lit(1)).otherwise(F.greatest(F.lit(0), F.bround(value, 0).cast("int")))


def normal_days(mean: Column, sd: Column, seed: int, id_col: str) -> Column:
    """Whole part of the absolute value of a normal draw; a missing mean or deviation counts as 1."""
    radius = F.sqrt(-2 * F.log(uniform(seed, "los_radius", id_col)))
    angle = 2 * math.pi * uniform(seed, "los_angle", id_col)
    value = F.coalesce(mean, F.lit(1.0)) + F.coalesce(sd, F.lit(1.0)) * radius * F.cos(angle)
    return F.floor(F.abs(value)).cast("int")
