"""Column functions for labels: path → label, one-hot codec, labeled-point bridge.

All of them are built-in Spark expressions (whole-stage codegen, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value (must match the reference): an image file is ``<anything>/<ddd>_<dddd>.jpg``
# and the label is the three-digit class number minus one. Whole-string match.
PATH_LABEL_PATTERN = r"^.+/(\d{3})_\d{4}\.jpg$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_label(path) -> Column:
    """0-based label from an image path, null when the path does not match."""
    p = _col(path)
    return F.when(p.rlike(PATH_LABEL_PATTERN),
                  F.regexp_extract(p, PATH_LABEL_PATTERN, 1).cast("int") - 1)


def path_is_valid(path, n_classes: int | None = None) -> Column:
    """True when the path parses to a label in ``0 .. n_classes-1`` (≥ 0 without a bound)."""
    lab = path_label(path)
    ok = lab.isNotNull() & (lab >= 0)
    if n_classes is not None:
        ok = ok & (lab < F.lit(n_classes))
    return F.coalesce(ok, F.lit(False))


def checked_path_label(path, n_classes: int | None = None) -> Column:
    """Label from path; a non-matching or out-of-range path fails the job, naming the path."""
    p = _col(path)
    return F.when(path_is_valid(p, n_classes), path_label(p)).otherwise(
        F.raise_error(F.concat(F.lit("no class number in image path: "), p)).cast("int"))


def with_path_label(df: DataFrame, path: str = "path", out: str = "label", *,
                    n_classes: int | None = None, on_bad: str = "error") -> DataFrame:
    """Add ``out``; ``on_bad`` = ``error`` (default, like the reference) or ``drop``."""
    if on_bad == "error":
        return df.withColumn(out, checked_path_label(path, n_classes))
    if on_bad == "drop":
        return df.filter(path_is_valid(path, n_classes)).withColumn(out, path_label(path))
    raise ValueError(f"on_bad must be 'error' or 'drop', not {on_bad!r}")


def onehot_encode(label, n_classes: int) -> Column:
    """``array<float>`` of length ``n_classes`` with 1 at ``label``; out-of-range fails."""
    if n_classes <= 0:
        raise ValueError("n_classes must be positive")
    lab = _col(label)
    vec = F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)),
                      lambda i: F.when(i == lab, F.lit(1.0)).otherwise(F.lit(0.0)).cast("float"))
    ok = lab.isNotNull() & (lab >= 0) & (lab < n_classes)
    return F.when(ok, vec).otherwise(
        F.raise_error(F.concat(F.lit(f"label outside 0..{n_classes - 1}: "),
                               F.coalesce(lab.cast("string"), F.lit("null")))))


def onehot_decode(vec) -> Column:
    """Index of the first non-zero entry (not argmax), as int.

    NaN and negatives count as non-zero, -0.0 does not. All-zero, empty or null fails.
    """
    v = _col(vec)
    idx = F.array_position(F.transform(v, lambda x: x != 0), True) - 1
    return F.when(idx >= 0, idx.cast("int")).otherwise(
        F.raise_error(F.lit("one-hot vector has no non-zero entry")).cast("int"))


def to_labeled_points(df: DataFrame, features: str = "features", label: str = "label",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """``label double, features vector`` for Spark ML (P5, P6); no UDF. ``keep`` columns
    (e.g. an id) ride along in front."""
    from pyspark.ml.functions import array_to_vector

    return df.select(*keep, F.col(label).cast("double").alias("label"),
                     array_to_vector(F.col(features)).alias("features"))
