"""Quality filters: the first reason that excludes a record, and what makes one usable for evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import only_alphabet, unknown_fraction


def exclusion_reason(min_length: int = 30, max_unknown: float = 0.20, max_xray: float = 3.0, max_em: float = 4.0) -> Column:
    """First reason that excludes a row of (aa, three_di, method, method_category, resolution); null keeps it.

    Empty and null sequences and methods are missing. A NaN resolution cannot be held against a limit and counts as
    missing, as does one of 0 or less.
    """
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    res, cat = F.col("resolution"), F.col("method_category")
    rules = (
        ("missing_aa", blank("aa")),
        ("missing_3di", blank("three_di")),
        ("missing_structure_metadata", blank("method")),
        ("length_mismatch", F.length("aa") != F.length("three_di")),
        ("too_short", F.length("aa") < min_length),
        ("too_many_unknown_aa", unknown_fraction("aa") > max_unknown),
        ("invalid_3di", ~only_alphabet("three_di")),
        ("method_excluded", ~F.coalesce(cat.isin("xray", "em"), F.lit(False))),
        ("missing_resolution", res.isNull() | F.isnan(res) | (res <= 0)),
        ("low_xray_resolution", (cat == "xray") & (res > max_xray)),
        ("low_em_resolution", (cat == "em") & (res > max_em)),
    )
    out = F.when(rules[0][1], rules[0][0])
    for name, rule in rules[1:]:
        out = out.when(rule, name)
    return out


def pair(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Full outer join on key with `pairing`: both, left_only or right_only. Null keys drop out of both sides.

    Columns of the same name on both sides keep the left name; the right one gets the suffix _right.
    """
    clash = set(left.columns) & set(right.columns) - {key}
    r = right.filter(F.col(key).isNotNull()).select(key, *(F.col(c).alias(f"{c}_right" if c in clash else c) for c in right.columns if c != key), F.lit(True).alias("__r"))
    l = left.filter(F.col(key).isNotNull()).withColumn("__l", F.lit(True))
    side = F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left_only").otherwise("right_only")
    return l.join(r, key, "full_outer").withColumn("pairing", side).drop("__l", "__r")


def usable(max_fraction: float = 0.95, min_backbone: float = 0.90) -> Column:
    """Rows of (three_di_max_token_fraction, backbone_complete_fraction, internal_missing_residues, length) fit for evaluation; missing values fail."""
    nan_to_null = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    gap = F.greatest(F.lit(10), F.floor(F.col("length") / 10))
    return (
        (F.coalesce(nan_to_null("three_di_max_token_fraction"), F.lit(1.0)) <= max_fraction)
        & (F.coalesce(nan_to_null("backbone_complete_fraction"), F.lit(0.0)) >= min_backbone)
        & (F.coalesce(F.col("internal_missing_residues"), F.lit(10**9)) <= F.coalesce(gap, F.lit(10)))
    )


def evaluation_length(low: int = 30, high: int = 510) -> Column:
    return F.coalesce(F.col("length").between(low, high), F.lit(False))


def similarity_hit(fident: float = 0.30, qcov: float = 0.80, tcov: float = 0.80) -> Column:
    """A pairwise hit that counts: identity and both coverages reach their thresholds; null and NaN fail."""
    test = lambda c, x: F.coalesce((F.col(c) >= x) & ~F.isnan(c), F.lit(False))
    return test("fident", fident) & test("qcov", qcov) & test("tcov", tcov)
