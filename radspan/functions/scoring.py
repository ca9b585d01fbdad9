"""Quality scores and letters as column expressions. Letters are taken from the score before it is rounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: cuts of the letter and of the commercial tier
LETTERS = [(80, "A"), (65, "B"), (50, "C"), (35, "D")]
TIERS = [(80, "premium"), (60, "standard"), (40, "discount")]
# fixed values: words in a description with their targets of signal and contrast to noise; the first group that fits counts
TARGETS = [
    (["DWI", "DIFF", "DTI", "ADC", "TRACE"], 8.0, 5.0),
    (["MRS", "SPECTRO", "PRESS", "STEAM"], 5.0, 3.0),
    (["SWI", "SWAN", "PHASE"], 10.0, 8.0),
    (["PERFUS", "DSC", "DCE", "ASL", "DYN"], 10.0, 6.0),
]
OTHER_TARGETS = (20.0, 12.0)
# fixed values: order of letters from best to worst
GRADES = ["A", "B", "C", "D", "F"]


def by_cut(score: Column, cuts: list[tuple[float, str]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for cut, label in reversed(cuts):
        out = F.when(score >= cut, label).otherwise(out)
    return out


def letter(score: Column) -> Column:
    return by_cut(score, LETTERS, "F")


def tier(score: Column) -> Column:
    return by_cut(score, TIERS, "exclude")


def cuts_sql(score: str, cuts: list[tuple[float, str]] = LETTERS, otherwise: str = "F") -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {c} THEN '{v}'" for c, v in cuts) + f" ELSE '{otherwise}' END"


def _capped(c: Column, target: Column | float, points: float) -> Column:
    return F.least(c / target, F.lit(1.0)) * points


def series_parts(snr: Column, cnr: Column, uniformity: Column, tissue: Column, dynamic_range: Column, entropy: Column, nonzero: Column, description: Column) -> dict[str, Column]:
    """Points of each part of a series' score; missing contrast counts as the signal's, other missing values as 0."""
    up = F.upper(F.coalesce(description, F.lit("")))
    targets = [F.lit(x) for x in OTHER_TARGETS]
    for words, *values in reversed(TARGETS):
        fits = up.rlike("|".join(words))
        targets = [F.when(fits, v).otherwise(t) for v, t in zip(values, targets, strict=True)]
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return {
        "snr": _capped(zero(snr), targets[0], 25),
        "cnr": _capped(zero(F.coalesce(cnr, snr)), targets[1], 10),
        "uniformity": F.greatest(F.lit(0.0), F.least(zero(uniformity), F.lit(1.0))) * 20,
        "tissue": _capped(zero(tissue), 60.0, 15),
        "dynamic_range": _capped(zero(dynamic_range), 500.0, 12),
        "entropy": _capped(zero(entropy), 5.0, 10),
        "nonzero": _capped(zero(nonzero), 50.0, 8),
    }


def total(parts: dict[str, Column]) -> Column:
    out = None
    for c in parts.values():
        out = c if out is None else out + c
    return out


def training_parts(cnr: Column, noise: Column, bias: Column, laplacian: Column, peaks: Column, correlation: Column) -> dict[str, Column]:
    """Points of each part of the training-value score; missing values count as 0, noise as 50 and bias as 0.5."""
    zero = lambda c, v=0.0: F.coalesce(c.cast("double"), F.lit(v))
    return {
        "cnr": _capped(zero(cnr), 15.0, 25),
        "noise": F.greatest(F.lit(0.0), 1 - zero(noise, 50.0) / 50) * 20,
        "bias": F.greatest(F.lit(0.0), 1 - zero(bias, 0.5) / 0.2) * 15,
        "sharpness": _capped(zero(laplacian), 200.0, 15),
        "histogram": _capped(zero(peaks), 3.0, 10),
        "consistency": F.least(zero(correlation), F.lit(1.0)) * 15,
    }
