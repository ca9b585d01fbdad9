"""Documents, lookups and shape arithmetic of the exports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: classes and transfer syntaxes by name, and classes that are no images
SOP_NAMES = {
    "1.2.840.10008.5.1.4.1.1.11.1": "Grayscale Softcopy PS",
    "1.2.840.10008.5.1.4.1.1.11.2": "Color Softcopy PS",
    "1.2.840.10008.5.1.4.1.1.4": "MR Image Storage",
    "1.2.840.10008.5.1.4.1.1.2": "CT Image Storage",
    "1.2.840.10008.5.1.4.1.1.7": "Secondary Capture",
    "1.2.840.10008.5.1.4.1.1.4.1": "Enhanced MR Image Storage",
    "1.2.840.10008.5.1.4.1.1.66": "Raw Data Storage",
    "1.2.840.10008.5.1.4.1.1.66.4": "Segmentation Storage",
    "1.2.840.10008.5.1.1.1": "Basic Film Session",
}
SYNTAX_NAMES = {
    "1.2.840.10008.1.2": "Implicit VR LE",
    "1.2.840.10008.1.2.1": "Explicit VR LE",
    "1.2.840.10008.1.2.2": "Explicit VR BE",
    "1.2.840.10008.1.2.4.50": "JPEG Baseline",
    "1.2.840.10008.1.2.4.70": "JPEG Lossless",
    "1.2.840.10008.1.2.4.80": "JPEG-LS Lossless",
    "1.2.840.10008.1.2.4.90": "JPEG 2000 Lossless",
    "1.2.840.10008.1.2.4.91": "JPEG 2000",
    "1.2.840.10008.1.2.5": "RLE Lossless",
}
NOT_IMAGES = ["1.2.840.10008.5.1.4.1.1.11.1", "1.2.840.10008.5.1.4.1.1.11.2", "1.2.840.10008.5.1.1.1"]
# fixed values: named windows as centre and width, and bytes of a chunk
WINDOWS = {"brain": (40, 80), "subdural": (75, 215), "bone": (600, 2800), "stroke": (32, 8), "soft_tissue": (50, 400)}
SLICE_CHUNK, VOLUME_CHUNK = 512 << 10, 1 << 20
# fixed values: data card sizes by number of rows
SIZES = [(100_000, "100K<n<1M"), (10_000, "10K<n<100K"), (1_000, "1K<n<10K")]
# fixed values: scanner fields that may leave the site
OPEN_FIELDS = ["study_description", "institution", "manufacturer", "model", "field_strength", "software_versions", "station_name"]
# fixed values: labels of grades for training
GRADE_LABELS = {"A": 4, "B": 3, "C": 2, "D": 1, "F": 0}


def lookup(c: Column, names: dict[str, str]) -> Column:
    """The name of a code; an unknown code stays."""
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in names.items()], c)


def is_image(sop_class: Column) -> Column:
    return ~F.coalesce(sop_class, F.lit("")).isin(NOT_IMAGES)


def grade_label(grade: Column) -> Column:
    return F.coalesce(*[F.when(grade == k, F.lit(v)) for k, v in GRADE_LABELS.items()], F.lit(0))


def size_category(rows: Column) -> Column:
    out = F.lit("n<1K")
    for least, label in reversed(SIZES):
        out = F.when(rows > least, label).otherwise(out)
    return out


def iso_day(day: Column) -> Column:
    """YYYYMMDD... as YYYY-MM-DD; shorter strings give null."""
    return F.when(F.length(day) >= 8, F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))


def sidecar(sequence: Column, description: Column, tr: Column, te: Column, ti: Column, fa: Column, b: Column, field: Column, field_of_patient: Column, manufacturer: Column, model: Column, day: Column, files: Column) -> Column:
    """The JSON sidecar of a series: seconds instead of milliseconds, the patient's field strength where the series has none,
    inversion time for FLAIR and b-value for DWI only; missing values are left out."""
    seconds = lambda c: c.try_cast("double") / 1000
    number = lambda c: F.when(c.try_cast("double") != 0, c.try_cast("double"))
    return F.to_json(
        F.struct(
            F.nullif(manufacturer, F.lit("")).alias("Manufacturer"),
            F.nullif(model, F.lit("")).alias("ManufacturerModelName"),
            F.coalesce(number(field), number(field_of_patient)).alias("MagneticFieldStrength"),
            iso_day(day).alias("AcquisitionTime"),
            F.coalesce(description, F.lit("")).alias("SeriesDescription"),
            F.coalesce(description, F.lit("")).alias("ProtocolName"),
            seconds(tr).alias("RepetitionTime"),
            seconds(te).alias("EchoTime"),
            fa.alias("FlipAngle"),
            F.when(sequence == "FLAIR", seconds(ti)).alias("InversionTime"),
            F.when(sequence == "DWI", b).alias("DiffusionBValue"),
            files.alias("_SourceFiles"),
        )
    )


def open_projection(info: Column) -> Column:
    """A map of what may leave the site: sex, age by decade, year of the study, scanner fields."""
    get = lambda k: F.trim(F.coalesce(F.try_element_at(info, F.lit(k)), F.lit("")))
    year = lambda c: F.when(c.rlike(r"^\d{4}"), F.substring(c, 1, 4).cast("int"))
    studied = year(get("study_date"))
    age = studied - year(get("patient_birth_date"))
    pairs = {"patient_sex": F.when(F.upper(get("patient_sex")).isin("M", "F", "O"), F.upper(get("patient_sex"))), "patient_age_bracket": F.when(age.between(0, 120), F.concat((F.floor(age / 10) * 10).cast("string"), F.lit("s"))), "study_date_year": studied.cast("string")}
    pairs |= {k: F.nullif(get(k), F.lit("")) for k in OPEN_FIELDS}
    return F.map_filter(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())


def quality_brief(snr: Column, cnr: Column, symmetry: Column, motion: Column, anomalous: Column) -> Column:
    """At most five lines of text; what is missing has no line; at most five anomalous slices are named."""
    line = lambda label, c: F.when(c.isNotNull(), F.concat(F.lit(f"{label}: "), c.cast("string")))
    slices = F.when(F.size(anomalous) > 0, F.concat(F.lit("Anomalous slices: "), F.array_join(F.slice(anomalous, 1, 5).cast("array<string>"), ", ")))
    return F.concat_ws("\n", line("SNR", snr), line("CNR", cnr), line("Symmetry", symmetry), line("Motion", motion), slices)


def linked_data(row: Column, context: str = "https://schema.org") -> Column:
    """A struct as a JSON document with a linked-data head."""
    return F.to_json(F.struct(F.lit(context).alias("@context"), F.lit("Dataset").alias("@type"), row.alias("data")))


def chunk_slices(n: Column, height: Column, width: Column, itemsize: int = 1, target: int = SLICE_CHUNK) -> Column:
    """Whole slices of a chunk of about `target` bytes, from 1 to n."""
    plane = height * width * itemsize
    return F.when(plane == 0, F.lit(1)).otherwise(F.least(F.greatest(F.floor(F.lit(target) / F.greatest(plane, F.lit(1))), F.lit(1)), F.greatest(n, F.lit(1)))).cast("long")


def shard_slices(n: Column, chunk: Column, target: int = 256) -> Column:
    """Slices of a shard of whole chunks that holds about `target`, no more than n but at least a chunk."""
    whole = chunk * F.greatest(F.floor(F.lit(target) / F.greatest(chunk, F.lit(1))), F.lit(1))
    return F.when(chunk <= 0, chunk).otherwise(F.greatest(F.least(n, whole), chunk)).cast("long")


def picked_slices(n: Column, count: int) -> Column:
    """`count` places spread evenly from an eighth to seven eighths of n slices."""
    low, high = F.floor(n / 8), F.least(n - F.floor(n / 8), n - 1)
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.when(n > 1, F.transform(steps, lambda i: F.floor(low + (high - low) * i / max(count - 1, 1)).cast("int"))).otherwise(F.array(F.lit(0)))


def shift_any(value: Column, days: int) -> Column:
    """A shifted date or date with time; times alone stay, anything else becomes empty."""
    s = F.trim(value)
    alone = (F.length(s) <= 6) | ((F.length(s) <= 13) & s.contains(".") & (F.length(F.substring_index(s, ".", 1)) <= 6))
    day = F.date_format(F.date_add(F.try_to_timestamp(F.substring(s, 1, 8), F.lit("yyyyMMdd")).cast("date"), F.lit(days)), "yyyyMMdd")
    clock = F.when(F.length(s) >= 14, F.substring(s, 9, 1000)).otherwise("")
    good = (F.length(s) < 14) | F.substring(s, 9, 6).rlike("^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]$")
    return F.when(s == "", "").when(alone, s).when(good, F.coalesce(F.concat(day, clock), F.lit(""))).otherwise("")


# fixed values: file extensions with their format and media type
MEDIA = {
    "parquet": ("parquet", "application/vnd.apache.parquet"),
    "json": ("json", "application/json"),
    "png": ("png", "image/png"),
    "mcap": ("mcap", "application/x-mcap"),
    "dcm": ("dcm", "application/dicom"),
}


def media_type(path: Column) -> tuple[Column, Column]:
    """Format and media type by the extension of a path; null for any other."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    name = lambda i: F.coalesce(*[F.when(extension == k, F.lit(v[i])) for k, v in MEDIA.items()])
    return name(0), name(1)


def group_name(path: Column) -> Column:
    """A relative path as an array-store group: without the NIfTI ending, odd characters as underscores, no empty or dot parts."""
    parts = F.split(F.regexp_replace(path, r"\.nii(\.gz)?$", ""), "/")
    return F.array_join(F.transform(F.filter(parts, lambda p: ~p.isin("", ".")), lambda p: F.regexp_replace(p, "[^A-Za-z0-9._-]", "_")), "/")


def model_family(model: Column) -> Column:
    """Which caching rules a model id follows, by its prefix; ids without a prefix count as openai."""
    return F.when(model.startswith("anthropic/"), "anthropic").when(model.startswith("google/gemini"), "google").when(model.startswith("openai/") | ~model.contains("/"), "openai").otherwise("other")


def sharpness_label(mean: Column) -> Column:
    return F.when(mean > 20, "very sharp").when(mean > 10, "sharp").when(mean > 5, "moderate").when(mean.isNotNull(), "soft/blurry")
