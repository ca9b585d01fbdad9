"""Writers: checked Parquet, JSON lines, CSV with a fixed column order, SQLite, bundles, tar packs, page-sized texts."""

from __future__ import annotations

import io
import json
import os
import sqlite3
import tarfile
from collections.abc import Iterable, Iterator
from contextlib import closing

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radspan.operators.gates import gated_parquet
from radspan.operators.splits import seeded_sample


def checked_parquet(df: DataFrame, path: str, key: str, rules: dict[str, Column]) -> None:
    """Written and checked in one pass, seen only if no row breaks a rule; else ValueError says how many rows break which,
    with the smallest key. A rule that is null holds."""
    gated_parquet(df, path, {name: F.struct(F.count_if(~rule), F.min(F.when(~rule, F.col(key).cast("string")))) for name, rule in rules.items()})


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def ordered_columns(df: DataFrame, first: list[str], drop: str = "histogram") -> DataFrame:
    """Columns of `first` that are there, then the others by name; without those named after `drop`; nested ones as JSON."""
    names = [c for c in df.columns if drop not in c]
    names = [c for c in first if c in names] + sorted(c for c in names if c not in first)
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, nested) else F.col(c) for c in names])


def csv(df: DataFrame, path: str, first: list[str]) -> None:
    ordered_columns(df, first).write.mode("overwrite").option("header", True).csv(path)


def series_json(df: DataFrame, path: str, by: str, context: str = "https://schema.org") -> None:
    """One JSON document per row, with a linked-data head, in folders by a column."""
    head = F.struct(F.lit(context).alias("@context"), F.lit("Dataset").alias("@type"), F.struct(*df.columns).alias("series"))
    df.select(by, F.to_json(head).alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def sqlite(path: str, tables: dict[str, DataFrame], keys: dict[str, str], view: tuple[str, str, str] | None = None) -> None:
    """A SQLite file with a table per DataFrame, streamed partition by partition; keys get indexes; view: (name, left, right).

    The file is written beside `path` and then takes its place, so an older one is replaced whole or not at all.
    """
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL"}
    text, fresh = "TEXT", f"{path}.new"
    if os.path.exists(fresh):
        os.remove(fresh)
    with closing(sqlite3.connect(fresh)) as db, db:
        for name, df in tables.items():
            flat = ordered_columns(df, df.columns, drop="\0")
            db.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {kinds.get(t, text)}' for c, t in flat.dtypes)})")
            marks = ", ".join("?" * len(flat.columns))
            db.executemany(f"INSERT INTO {name} VALUES ({marks})", (tuple(r) for r in flat.toLocalIterator()))
            if name in keys:
                db.execute(f"CREATE INDEX {name}_{keys[name]} ON {name} ({keys[name]})")
        if view:
            v, a, b = view
            cols = ", ".join(f"b.{c} AS {b}_{c}" for c in tables[b].columns if c != keys[b])
            db.execute(f"CREATE VIEW {v} AS SELECT a.*, {cols} FROM {a} a LEFT JOIN {b} b ON a.{keys[a]} = b.{keys[b]}")
    os.replace(fresh, path)


def datasette_metadata(title: str, facets: dict[str, list[str]], sort: dict[str, str]) -> str:
    return json.dumps({"title": title, "databases": {"manifest": {"tables": {t: {"facets": f, **({"sort": sort[t]} if t in sort else {})} for t, f in facets.items()}}}}, indent=2)


def sample_bundle(studies: DataFrame, series: DataFrame, n: int, seed: int, key: str = "study_id") -> tuple[DataFrame, DataFrame]:
    """n seeded studies and their series."""
    picked = seeded_sample(studies, n, seed, key)
    return picked, series.join(F.broadcast(picked.select(key)), key, "left_semi")  # n rows


def tar_packs(files: DataFrame, by: str, name: str, content: str, most: int = 256 << 20) -> DataFrame:
    """by, part, n, tar: files packed into tars of at most about `most` bytes, in order of (by, name)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, n, size, buffer, tar = None, 0, 0, 0, io.BytesIO(), None

        def closed() -> pa.RecordBatch:
            tar.close()
            return pa.RecordBatch.from_pydict({"by": pa.array([at], pa.string()), "part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int32()), "tar": pa.array([buffer.getvalue()], pa.binary())})

        for batch in batches:
            for key, file, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if tar is not None and (key != at or size + len(data) > most):
                    yield closed()
                    part, tar = (part + 1 if key == at else 0), None
                if tar is None:
                    at, n, size, buffer = key, 0, 0, io.BytesIO()
                    tar = tarfile.open(fileobj=buffer, mode="w")
                info = tarfile.TarInfo(file)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n, size = n + 1, size + len(data)
        if tar is not None:
            yield closed()

    rows = files.select(F.col(by).cast("string"), name, F.col(content).cast("binary")).repartition(by).sortWithinPartitions(by, name)
    return rows.mapInArrow(run, "by string, part int, n int, tar binary").withColumnRenamed("by", by)


def json_schema(schema: T.StructType) -> dict:
    """A JSON Schema of a Spark schema."""

    def of(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t}, "required": [f.name for f in t if not f.nullable]}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(t.elementType)}
        if isinstance(t, T.MapType):
            return {"type": "object", "additionalProperties": of(t.valueType)}
        return {"type": "boolean" if isinstance(t, T.BooleanType) else "integer" if isinstance(t, T.IntegralType) else "number" if isinstance(t, T.NumericType) else "string"}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", **of(schema)}
