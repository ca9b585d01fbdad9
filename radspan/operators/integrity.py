"""Checksums, provenance, quality reports, ordering and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: types of a dataset description
DATASET_TYPES = ["sc:Dataset", "https://schema.org/Dataset"]


def checksums(df: DataFrame, path: str, content: str, skip: str | None = None) -> DataFrame:
    """path, sha256, bytes of every file whose path does not match `skip`."""
    rows = df if skip is None else df.where(~F.col(path).cast("string").rlike(skip))
    return rows.select(path, F.sha2(F.col(content).cast("binary"), 256).alias("sha256"), F.octet_length(content).cast("long").alias("bytes"))


def verify(recorded: DataFrame, actual: DataFrame, path: str) -> DataFrame:
    """path, problem: files that are missing or differ from their record."""
    both = recorded.select(path, F.col("sha256").alias("_was")).join(actual.select(path, F.col("sha256").alias("_is")), path, "left")
    problem = F.when(F.col("_is").isNull(), "missing").when(F.col("_is") != F.col("_was"), "mismatch")
    return both.select(path, problem.alias("problem")).where("problem is not null")


def provenance(outputs: DataFrame, output: str, sources: str, activity: str) -> DataFrame:
    """edge, source, target: output wasGeneratedBy activity, activity used source, output wasDerivedFrom source."""
    return provenance_pairs(outputs.select(output, F.explode(sources).alias("_source")), output, "_source", activity)


def provenance_pairs(pairs: DataFrame, output: str, source: str, activity: str) -> DataFrame:
    """The edges of provenance() from one row per output and source."""
    rows = pairs.select(F.col(output).cast("string").alias("o"), F.col(source).cast("string").alias("s"))
    made = rows.select(F.lit("wasGeneratedBy").alias("edge"), F.col("o").alias("source"), F.lit(activity).alias("target")).distinct()
    used = rows.select(F.lit("used").alias("edge"), F.lit(activity).alias("source"), F.col("s").alias("target")).distinct()
    return made.unionByName(used).unionByName(rows.select(F.lit("wasDerivedFrom").alias("edge"), F.col("o").alias("source"), F.col("s").alias("target")))


def stage_graph(stages: list[tuple[str, str]]) -> str:
    """Mermaid text of a chain of stages: (name, label)."""
    lines = [f'  {n}["{label}"]' for n, label in stages] + [f"  {a} --> {b}" for (a, _), (b, _) in zip(stages, stages[1:], strict=False)]
    return "\n".join(["flowchart TD", *lines])


def resource_rules(name: Column, path: Column, size: Column, digest: Column) -> dict[str, Column]:
    """Rules of a data package's resource, for privacy.constraint_failures()."""
    return {
        "name": F.coalesce(name.rlike("^[a-z0-9_-]+$"), F.lit(False)),
        "path": F.coalesce(~path.startswith("/") & ~path.contains(".."), F.lit(False)),
        "bytes": F.coalesce(size >= 0, F.lit(False)),
        "hash": F.coalesce(digest.rlike("^[0-9a-f]{64}$"), F.lit(False)),
    }


def dataset_description_errors(raw: Column) -> Column:
    """What a dataset description in JSON-LD lacks, as an array of texts; empty if it is sound, one text if it is no JSON object."""
    cells, many = "map<string,string>", "array<map<string,string>>"
    has = lambda d, *names: reduce(lambda a, b: a | b, [d[n].isNotNull() for n in names])
    lacks = lambda d, at, *names: F.when(~has(d, *names), F.concat(at, F.lit(f"lacks {' or '.join(names)}")))
    top = F.lit("")
    d = F.from_json(raw, cells)

    def entries(name: str, rules) -> Column:
        rows = F.from_json(d[name], many)
        told = F.flatten(F.transform(rows, lambda e, i: F.array_compact(F.array(*rules(e, F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]: ")))))))
        return F.when(d[name].isNull() | rows.isNull() | (F.size(rows) == 0), F.array(F.lit(f"lacks a list {name}"))).otherwise(told)

    def file_rules(e: Column, at: Column) -> list[Column]:
        return [lacks(e, at, "@id"), lacks(e, at, "@type"), lacks(e, at, "name", "sc:name"), lacks(e, at, "contentUrl", "sc:contentUrl", "cr:FileObject", "cr:FileSet", "cr:source", "source")]

    def record_rules(e: Column, at: Column) -> list[Column]:
        fields = F.from_json(F.coalesce(e["field"], e["cr:field"]), many)
        kind = F.when(F.coalesce(e["@type"], F.lit("")) != "cr:RecordSet", F.concat(at, F.lit("is no cr:RecordSet")))
        return [lacks(e, at, "@id"), kind, lacks(e, at, "name", "sc:name"), F.when(F.coalesce(F.size(fields), F.lit(0)) <= 0, F.concat(at, F.lit("lacks fields")))]

    kind = F.when(~F.coalesce(d["@type"], F.lit("")).isin(DATASET_TYPES), F.lit("is no dataset"))
    head = F.array_compact(F.array(lacks(d, top, "@context"), kind, *[lacks(d, top, n, f"sc:{n}") for n in ("name", "description", "url", "license")]))
    sound = F.concat(head, entries("distribution", file_rules), entries("recordSet", record_rules))
    return F.when(d.isNull() | ~F.coalesce(F.ltrim(raw).startswith("{"), F.lit(False)), F.array(F.lit("is no JSON object"))).otherwise(sound)


def study_qc(series: DataFrame, study: str, grade: str, uid: str, issue: Column, anomaly: Column) -> DataFrame:
    """Letter counts, distinct series with issues, pass percentage and anomalies of each study."""
    out = series.groupBy(study).agg(
        *[F.count_if(F.col(grade) == g).alias(f"n_{g.lower()}") for g in "ABCDF"],
        F.count_distinct(F.when(issue, F.col(uid))).alias("n_issues"),
        F.count_if(anomaly).alias("n_anomalies"),
        F.count("*").alias("n"),
    )
    return out.withColumn("pass_pct", (1 - F.col("n_issues") / F.greatest(F.col("n"), F.lit(1))) * 100)


def anomaly_flags(motion: Column, symmetry: Column, slices: Column) -> Column:
    return F.array_compact(F.array(F.when(motion > 50, "motion"), F.when(symmetry < 0.85, "asymmetry"), F.when(slices > 0, "slices")))


def badge_svg(grade: Column) -> Column:
    colour = F.coalesce(*[F.when(grade == g, c) for g, c in (("A", "#2e7d32"), ("B", "#558b2f"), ("C", "#f9a825"), ("D", "#ef6c00"))], F.lit("#c62828"))
    return F.format_string('<svg xmlns="http://www.w3.org/2000/svg" width="90" height="20"><rect width="90" height="20" rx="3" fill="%s"/><text x="45" y="14" fill="#fff" text-anchor="middle">grade %s</text></svg>', colour, grade)


def numbered_first(column: str) -> list[Column]:
    """Sort keys: whole numbers by value, then other strings."""
    n = F.col(column).cast("string").try_cast("int")
    return [n.isNull(), n, F.col(column)]


def slice_order(z: str, instance: str, name: str) -> list[Column]:
    return [F.asc_nulls_last(z), F.asc_nulls_last(instance), F.asc(name)]


def place(df: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by one partial aggregate (no sort)."""
    rest = [c for c in df.columns if c not in key]
    out = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return out.select(*key, *[F.col("_r")[c].alias(c) for c in rest])


def bind_records(records: DataFrame, series: DataFrame, on: str) -> DataFrame:
    """Records with every series that owns their path (or, by choice, their file name)."""
    return records.join(series, on)


def with_resource(rows: DataFrame, listing: DataFrame, key: str, name: str) -> DataFrame:
    """rows with `name`: whether the listing has a file for the key."""
    has = listing.select(F.col(key)).distinct().withColumn("_has", F.lit(True))
    return rows.join(has, key, "left").withColumn(name, F.coalesce("_has", F.lit(False))).drop("_has")
