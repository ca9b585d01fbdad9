"""Sequence type from a series' name, refined and backed up by its timing; one rule list for Spark and SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: name patterns and types; the first match wins, so the order counts
PATTERNS = [
    (r"\bE?ADC\b", "ADC Map"),
    (r"\bFA\s*MAP\b", "FA Map"),
    (r"\bTRACE\b", "Trace DWI"),
    (r"\bISO.*B\b", "Isotropic DWI"),
    (r"\bREG.*DWI\b", "Registered DWI"),
    (r"\bMPRAGE\b", "MPRAGE (3D T1)"),
    (r"\bMP2RAGE\b", "MP2RAGE"),
    (r"\bSPACE\b", "SPACE (3D TSE)"),
    (r"\bCUBE\b", "CUBE (3D FSE)"),
    (r"\bVISTA\b", "VISTA (3D TSE)"),
    (r"\b3D\s*T1\b", "3D T1-weighted"),
    (r"\b3D\s*T2\b", "3D T2-weighted"),
    (r"\b3D\s*FLAIR\b", "3D FLAIR"),
    (r"\bFLAIR\b", "FLAIR"),
    (r"\bSTIR\b", "STIR"),
    (r"\bDIR\b", "DIR (Double Inversion Recovery)"),
    (r"\bDWI\b", "DWI"),
    (r"\bDIFF\b", "DWI"),
    (r"\bDTI\b", "DTI"),
    (r"\bSWAN\b", "SWI (SWAN)"),
    (r"\bSWI\b", "SWI"),
    (r"\bFILT.?PHA\b", "Phase Image"),
    (r"\bPHASE\b", "Phase Image"),
    (r"\bPROCESSED\s*IMAGE", "Processed/MIP"),
    (r"\bCOL:", "Color MIP"),
    (r"\bPJN:", "Projection MIP"),
    (r"\bB.?FFE\b", "Balanced FFE (bSSFP)"),
    (r"\bBSSFP\b", "Balanced FFE (bSSFP)"),
    (r"\bFIESTA\b", "FIESTA (bSSFP)"),
    (r"\bTRUE.?FISP\b", "TrueFISP (bSSFP)"),
    (r"\bGRE\b", "GRE (Gradient Echo)"),
    (r"\bFFE\b", "FFE (Gradient Echo)"),
    (r"\bSPGR\b", "SPGR (Spoiled GRE)"),
    (r"\bFLASH\b", "FLASH (Spoiled GRE)"),
    (r"\bTOF\b", "TOF MRA"),
    (r"\bMRA\b", "MRA"),
    (r"\bMRV\b", "MRV"),
    (r"\bASL\b", "ASL Perfusion"),
    (r"\bDSC\b", "DSC Perfusion"),
    (r"\bDCE\b", "DCE Perfusion"),
    (r"\bPERFUS", "Perfusion"),
    (r"\bMRS\b", "MR Spectroscopy"),
    (r"\bT1\s*W", "T1-weighted"),
    (r"\bT1\b", "T1-weighted"),
    (r"\bT2\s*W", "T2-weighted"),
    (r"\bT2\b", "T2-weighted"),
    (r"\bPD\s*W?\b", "Proton Density"),
    (r"\bTSE\b", "TSE (Turbo Spin Echo)"),
    (r"\bFSE\b", "FSE (Fast Spin Echo)"),
    (r"\bSURVEY\b", "Survey/Localizer"),
    (r"\bLOCAL", "Survey/Localizer"),
    (r"\bSCOUT\b", "Survey/Localizer"),
    (r"\bLOC\b", "Survey/Localizer"),
]
# fixed values: prefixes taken off one after another
PREFIXES = ["SE ", "MS ", "WIP ", "REF ", "PH ", "MAG "]
# fixed values: types that a b-value refines
DIFFUSION = ["DWI", "DTI", "Trace DWI", "Isotropic DWI"]
# fixed values: timing rules as SQL conditions, type and confidence; the first that holds wins, and only without a name match
TI_RULES = [
    ("ti > 1800", "FLAIR", "high"),
    ("ti > 1200 AND ti <= 1800", "FLAIR (probable)", "medium"),
    ("ti > 100 AND ti < 300", "STIR", "medium"),
    ("ti > 400 AND ti < 1200 AND tr < 3000", "T1-weighted (IR)", "medium"),
]
TR_TE_RULES = [
    ("tr > 4000 AND te > 80", "T2-weighted", "medium"),
    ("tr > 4000 AND te < 30", "Proton Density", "medium"),
    ("tr > 2000 AND tr <= 4000 AND te > 80", "T2-weighted", "medium"),
    ("tr < 800 AND te < 30", "T1-weighted", "medium"),
    ("tr < 800 AND te < 10 AND fa < 30", "GRE (Gradient Echo)", "medium"),
    ("tr < 10 AND te < 5", "Balanced FFE (bSSFP)", "medium"),
]


def normalised(description: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.upper(F.regexp_replace(description, r"^\s+|\s+$", "")), r"[_\-/\\]+", " "), r"\s+", " ")
    for p in PREFIXES:
        out = F.when(out.startswith(p), F.substring(out, len(p) + 1, 1_000_000)).otherwise(out)
    return out


def _cases(rules: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in rules) + f" ELSE {otherwise} END"


def classified_sql(name: str) -> tuple[str, str]:
    """SQL for type and confidence over columns desc_norm, tr, te, ti, fa, b; `name`: SQL for the type by name, or null."""
    timing = [*TI_RULES, *TR_TE_RULES, ("b > 0", "DWI", "medium")]
    by_time = _cases([(c, t) for c, t, _ in timing], "'Unknown'")
    sure = _cases([(c, s) for c, _, s in timing], "'low'")
    refined = f"CASE WHEN b = 0 AND {name} IN ({', '.join(map(repr, DIFFUSION))}) THEN 'DWI (b=0)' ELSE coalesce({name}, {by_time}) END"
    return refined, f"CASE WHEN {name} IS NOT NULL THEN 'high' ELSE {sure} END"


def with_sequence(df, description: str, tr: str, te: str, ti: str, fa: str, b: str):
    """df with sequence_type, confidence, reasons (array) and parameters (struct)."""
    out = F.lit(None).cast("string")
    reason = F.lit(None).cast("string")
    for p, t in reversed(PATTERNS):
        hit = F.col("_norm").rlike(p)
        out, reason = F.when(hit, t).otherwise(out), F.when(hit, f"Name matches '{p}'").otherwise(reason)
    named = df.withColumn("_norm", normalised(F.coalesce(F.col(description), F.lit(""))))
    names = {"tr": tr, "te": te, "ti": ti, "fa": fa, "b": b}
    named = named.withColumn("_s", F.struct(out.alias("name"), reason.alias("why"), *[F.col(c).cast("double").alias(k) for k, c in names.items()]))
    kind, sure = classified_sql("_s.name")
    for k in names:
        kind, sure = _qualified(kind, k), _qualified(sure, k)
    timed = F.when(F.col("_s.name").isNull() & (F.expr(kind) != "Unknown"), F.concat(F.lit("timing suggests "), F.expr(kind)))
    diffusion = F.when(F.col("_s.name").isin(DIFFUSION) & (F.col("_s.b") > 500), F.concat(F.lit("b-value="), F.col("_s.b").cast("string"), F.lit(" confirms diffusion weighting")))
    zero = F.when(F.col("_s.name").isin(DIFFUSION) & (F.col("_s.b") == 0), F.lit("b=0 reference image"))
    return named.select(
        *df.columns,
        F.expr(kind).alias("sequence_type"),
        F.expr(sure).alias("confidence"),
        F.array_compact(F.array(F.col("_s.why"), diffusion, zero, timed)).alias("reasons"),
        F.struct(F.col("_s.tr").alias("TR_ms"), F.col("_s.te").alias("TE_ms"), F.col("_s.ti").alias("TI_ms"), F.col("_s.fa").alias("flip_angle_deg"), F.col("_s.b").alias("b_value")).alias("parameters"),
    )


def _qualified(sql: str, name: str) -> str:
    import re

    return re.sub(rf"(?<![\w.']){name}(?= [<>=])", f"_s.{name}", sql)
