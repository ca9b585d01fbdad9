"""Labels, names and flags derived from free text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(c: Column, rules: list[tuple[str, str]], how=Column.rlike, otherwise: Column | None = None) -> Column:
    """The label of the first rule that holds; rules: (pattern, label)."""
    out = otherwise if otherwise is not None else F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(how(c, pattern), label).otherwise(out)
    return out


# fixed values: substrings and the plane they stand for, in order of precedence
PLANES = [("sag", "sagittal"), ("cor", "coronal"), ("ax", "axial")]
# fixed values: patterns of the acquisition label, in order of precedence
ACQUISITIONS = [
    (r"(?i)\bax\b|\bax(?=[A-Z0-9])|\baxial\b|\btransax\b|\btransverse\b|\btra\b", "axial"),
    (r"(?i)\b(sag|sagittal)\b", "sagittal"),
    (r"(?i)\b(cor|coronal)\b", "coronal"),
]
# fixed values: sequence type to (directory, suffix)
BIDS_TARGETS = {
    "DWI": ("dwi", "dwi"),
    "FLAIR": ("anat", "FLAIR"),
    "T1-weighted": ("anat", "T1w"),
    "T2-weighted": ("anat", "T2w"),
    "SWI (SWAN)": ("swi", "swi"),
    "TOF MRA": ("anat", "angio"),
    "ADC Map": ("dwi", "ADC"),
    "CUBE (3D FSE)": ("anat", "T2w"),
    "Color MIP": ("derivatives", "colormip"),
    "Projection MIP": ("derivatives", "projmip"),
    "Processed/MIP": ("derivatives", "processed"),
}
# fixed values: name prefixes that mark derived series, and phrases of doubt
DERIVED = r"(?i)\b(d{0,2}REG\b|d{0,2}ADC\w*|d?ISO\w*|ISOTROPIC|FILT_PHA|COL:|PJN:|MIP|MinIP|REFORMATT?ED|SUBTRACT)"
DOUBT = (
    r"(?i)\b(possibly|potentially|may\s+be|cannot\s+(?:fully|entirely|clearly)\s+(?:determine|assess|evaluate)"
    r"|uncertain|equivocal|borderline|subtle|faint|questionable|difficult\s+to\s+assess"
    r"|limited\s+(?:by|due)|cannot\s+(?:rule\s+out|exclude)|warrants?\s+(?:further|additional))\b"
)


def plane(description: Column) -> Column:
    return first_match(F.lower(description), PLANES, Column.contains)


def acquisition(description: Column) -> Column:
    return first_match(description, ACQUISITIONS)


def bids_target(sequence: Column, part: int) -> Column:
    """Directory (0) or suffix (1) of a sequence type; null if it is skipped."""
    return first_match(sequence, [(k, v[part]) for k, v in BIDS_TARGETS.items()], Column.__eq__)


def alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]", "")


def bids_name(subject: Column, session: Column | None, acq: Column, run: Column | None, suffix: Column, extension: str = ".nii.gz") -> Column:
    """sub-S[_ses-T][_acq-A][_run-N]_suffix; empty parts are left out."""
    part = lambda key, c: F.when(c.isNotNull() & (alphanumeric(c.cast("string")) != ""), F.concat(F.lit(f"{key}-"), alphanumeric(c.cast("string"))))
    parts = [part("sub", subject), *([part("ses", session)] if session is not None else []), part("acq", acq), *([part("run", run)] if run is not None else []), suffix]
    return F.concat(F.concat_ws("_", *parts), F.lit(extension))


def safe_name(c: Column, unicode: bool = True) -> Column:
    """Everything but word characters and hyphens becomes an underscore, character by character."""
    return F.regexp_replace(c, r"(?U)[^\w\-]" if unicode else r"[^\w\-]", "_")


def safe_label(c: Column) -> Column:
    """Runs of other characters become one underscore; outer underscores go; empty: unknown."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\-]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("unknown"))


def file_label(c: Column, most: int = 50) -> Column:
    """Word characters, hyphens, dots; spaces become underscores; at most `most` characters; empty: unknown."""
    out = F.regexp_replace(F.trim(F.regexp_replace(c, r"[^\w\s\-.]", "")), r"\s+", "_")
    return F.coalesce(F.nullif(F.substring(out, 1, most), F.lit("")), F.lit("unknown"))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9_-]+", "-"), "^[-_]+|[-_]+$", "")


def is_derived(description: Column) -> Column:
    return description.rlike(DERIVED)


def hedges(text: Column, least: int = 2) -> Column:
    return F.regexp_count(text, F.lit(DOUBT)) >= least


def age_bracket(year: Column, now: int = 2026) -> Column:
    """Decade of the age; n/a for a missing or impossible year."""
    age = F.lit(now) - year
    return F.when(year.isNotNull() & age.between(0, 120), F.concat((F.floor(age / 10) * 10).cast("string"), F.lit("s"))).otherwise("n/a")


def study_parts(c: Column) -> tuple[Column, Column]:
    """Subject and session of `sub-X_ses-Y`; the whole name and 01 where a part is missing."""
    sub, ses = F.regexp_extract(c, "sub-([A-Za-z0-9]+)", 1), F.regexp_extract(c, "ses-([A-Za-z0-9]+)", 1)
    return F.when(sub == "", c).otherwise(sub), F.when(ses == "", "01").otherwise(ses)


def human_size(c: Column) -> Column:
    out = F.format_string("%.1f TB", c / F.lit(float(1 << 40)))
    for power, unit in ((30, "GB"), (20, "MB"), (10, "KB")):
        out = F.when(c < 1 << power + 10, F.format_string(f"%.1f {unit}", c / F.lit(float(1 << power)))).otherwise(out)
    return F.when(c < 1024, F.format_string("%d B", c)).otherwise(out)


def to_seconds(ms: Column) -> Column:
    """Milliseconds as seconds; null where it is no number."""
    return ms.try_cast("double") / 1000


ERROR_REPLY = r"^\s*\[(error|rate limited|timeout|bad request)"


def json_object(raw: Column) -> Column:
    """The JSON object of a model's reply as text: the reply itself, a fenced block, or from the first to the last brace."""
    as_object = lambda c: F.when(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), c)
    fenced = F.nullif(F.regexp_extract(raw, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    braces = F.nullif(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(~raw.rlike(ERROR_REPLY), F.coalesce(as_object(raw), as_object(fenced), as_object(braces)))
