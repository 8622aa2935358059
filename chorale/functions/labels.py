"""Label values as Spark column expressions: lists, sets, decoding of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chorale.functions.text import SPACE

SEPARATOR = ";"  # fixed value
THRESHOLD = 0.5  # fixed value
NO_TONE = "Autres"  # fixed value
MISSING = {"polarite": "Neutre", "ton": "", "target": "Autre"}  # fixed values


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def default_label(col: Column | str, default: str) -> Column:
    """NULL and the empty string count as missing."""
    c = _column(col)
    return F.when(c.isNull() | (c == ""), default).otherwise(c)


def clean_labels(labels: Column) -> Column:
    """Trim the entries of an array and drop NULL and empty ones."""
    trimmed = F.transform(labels, lambda x: F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", ""))
    return F.filter(F.coalesce(trimmed, F.array().cast("array<string>")), lambda x: x != "")


def split_labels(col: Column | str) -> Column:
    """``"a; b"`` as ``[a, b]``; NULL gives an empty array, repeats stay."""
    return clean_labels(F.split(_column(col), SEPARATOR))


def label_set(col: Column | str, is_array: bool = False) -> Column:
    """A label value as a sorted array without repeats."""
    c = _column(col)
    return F.array_sort(F.array_distinct(clean_labels(c) if is_array else split_labels(c)))


def indicators(labels: Column | str, classes: Column) -> Column:
    """One 0/1 entry per class."""
    given = _column(labels)
    return F.transform(classes, lambda c: F.array_contains(given, c).cast("int"))


def argmax_label(probabilities: Column | str, classes: Column) -> Column:
    """The class with the highest probability, the first one on ties."""
    p = _column(probabilities)
    return F.element_at(classes, F.array_position(p, F.array_max(p)).cast("int"))


def decode_tones(
    probabilities: Column | str, classes: Column, threshold: float = THRESHOLD
) -> tuple[Column, Column]:
    """Labels at or above the threshold in class order, and the confidence.

    The confidence is the best probability among the kept labels, which is the
    best one overall; without any label the answer is the no-tone label.
    """
    p = _column(probabilities)
    kept = F.transform(
        F.filter(F.arrays_zip(p.alias("p"), classes.alias("c")), lambda z: z["p"] >= threshold),
        lambda z: z["c"],
    )
    return F.when(F.size(kept) == 0, F.array(F.lit(NO_TONE))).otherwise(kept), F.array_max(p)


def threshold_indicators(probabilities: Column | str, threshold: float = THRESHOLD) -> Column:
    """0/1 per class without any fallback."""
    return F.transform(_column(probabilities), lambda x: (x >= threshold).cast("int"))
