"""Per-feature moments (A7) and the batch-norm layer built from them.

Moments come from Spark ML's ``Summarizer`` over the vector column: one partial
aggregate per partition (width-sized state), merged in a tiny final stage — no explode,
no data-sized shuffle. Only the width-sized result reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Model, batchnorm


def feature_moments(df: DataFrame, features: str = "features") -> DataFrame:
    """One row ``n bigint, mean array<double>, var array<double>`` (population variance)."""
    vec = array_to_vector(F.col(features)).alias("_v")
    s = df.select(vec).agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s"))
    n = F.col("s.count")
    scale = F.when(n > 0, (n - 1) / n)
    return s.select(n.alias("n"), vector_to_array(F.col("s.mean")).alias("mean"),
                    F.transform(vector_to_array(F.col("s.variance")), lambda v: v * scale).alias("var"))


def moments_long(moments: DataFrame) -> DataFrame:
    """``i, mean, var`` one row per feature (width rows)."""
    return moments.select(F.posexplode(F.arrays_zip("mean", "var")).alias("i", "m")) \
        .select("i", F.col("m.mean").alias("mean"), F.col("m.var").alias("var"))


def batchnorm_from_moments(moments: DataFrame, name: str = "batchNorm0", eps: float = 1e-5) -> Model:
    """Inference batch-norm layer (gamma 1, beta 0) with the table's moments."""
    row = moments.first()
    mean = np.asarray(row["mean"], dtype=np.float64)
    var = np.asarray(row["var"], dtype=np.float64)
    n = len(mean)
    return Model((batchnorm(name, n, eps=eps),),
                 {f"{name}/gamma": np.ones(n), f"{name}/beta": np.zeros(n),
                  f"{name}/mean": mean, f"{name}/var": var})
