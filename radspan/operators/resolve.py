"""Recorded paths to files that are there: by equal ends of the path, then by names that differ in few characters; and images
of a series by its name and suffixes.

Files are first reduced to one path for each key (an end of a path, a name, a folder), the least one, so that a name that
a million folders share is one row of the join. Names that differ in at most d characters share a text that is left when
at most d characters are deleted from each: those texts are the keys of the second step, and every candidate is then
measured. Distinct names that share such a text are few, as they differ in d places only, so no group grows with the table.

Both sides of every join grow with the tables, so each is a merge of two shuffled sides (`_shuffled`): a side that is small
enough by its compressed size to be broadcast may still not fit the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits up to which names are near; 2 costs about half the square of a name's length in keys.
EDITS = 1


def _shuffled(df: DataFrame) -> DataFrame:
    return df.hint("merge")


def parts(path: Column) -> Column:
    """The components of a path, without empty ones and `.`; backslashes count as slashes."""
    return F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != "") & (p != "."))


def _name(path: Column) -> Column:
    tail = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(~tail.endswith("/"), F.element_at(F.split(tail, "/"), -1))


def _deleted(texts: Column) -> Column:
    """All texts with one character left out."""
    one = lambda t: F.transform(F.sequence(F.lit(1), F.char_length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t))))
    return F.array_distinct(F.flatten(F.transform(F.filter(texts, lambda t: t != ""), one)))


def left_over(name: Column, edits: int) -> Column:
    """Hashes of the name and of what is left when up to `edits` characters are deleted."""
    found = last = F.array(name)
    for _ in range(edits):
        last = _deleted(last)
        found = F.concat(found, last)
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def near_names(names: DataFrame, known: DataFrame, edits: int = EDITS) -> DataFrame:
    """name, near, distance: for each name those known (another table of `name`) at 0 to `edits` inserted, deleted or replaced characters."""
    keyed = lambda df, as_: df.where("name IS NOT NULL").select("name").distinct().select(F.col("name").alias(as_), F.explode(left_over(F.col("name"), edits)).alias("_key"))
    pairs = keyed(names, "name").join(_shuffled(keyed(known, "near")), "_key").select("name", "near").distinct()
    return pairs.withColumn("distance", F.levenshtein("name", "near", edits)).where("distance >= 0")


def resolve(wanted: DataFrame, files: DataFrame, key: str, path: str = "path", edits: int = EDITS) -> DataFrame:
    """key, found, how, depth, distance for each row of `wanted`; files: one row for each `path` that is there.

    how is `exact` (all components are equal), `end` (the last `depth` of them), `near` (no file of that name: the name of
    least distance), or null (found is null too). Most equal components win, then the least path in order of characters;
    near names likewise, least distance first. A path that is null, empty or ends in a slash finds nothing; rows of
    `wanted` that repeat are kept, each with its answer. Letters' case counts.
    """
    asked = wanted.select(F.col(key).alias("_id"), F.col(path).alias("_path"))
    texts = asked.select("_path").distinct().withColumn("_parts", F.when(_name(F.col("_path")).isNotNull(), parts(F.col("_path"))))
    ends = lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(p, -n, n), "/").alias("end")))
    there = files.select("path").where(F.col("path").isNotNull() & _name(F.col("path")).isNotNull()).distinct()
    by_end = there.withColumn("_parts", parts(F.col("path"))).where(F.size("_parts") > 0)
    by_end = by_end.select("path", F.size("_parts").alias("n"), F.inline(ends(F.col("_parts")))).groupBy("end").agg(F.min("path").alias("path"), F.min(F.when(F.col("n") == F.col("depth"), F.col("path"))).alias("whole"))
    sought = texts.where(F.size("_parts") > 0).select("_path", F.size("_parts").alias("_n"), F.inline(ends(F.col("_parts"))))
    full = F.col("depth") == F.col("_n")
    hits = sought.join(_shuffled(by_end), "end").groupBy("_path").agg(
        F.max(F.struct("depth", full.alias("full"), F.when(full & F.col("whole").isNotNull(), F.col("whole")).otherwise(F.col("path")).alias("path"), (full & F.col("whole").isNotNull()).alias("exact"))).alias("_hit")
    )
    first = hits.select("_path", F.col("_hit.path").alias("found"), F.when(F.col("_hit.exact"), "exact").otherwise("end").alias("how"), F.col("_hit.depth").alias("depth"))
    rest = texts.where(F.size("_parts") > 0).join(_shuffled(first.select("_path")), "_path", "left_anti").withColumn("name", _name(F.col("_path")))
    names = by_end.where(~F.col("end").contains("/")).select(F.col("end").alias("near"), F.col("path").alias("found"))
    close = near_names(rest, names.select(F.col("near").alias("name")), edits).join(_shuffled(names), "near").groupBy("name").agg(F.min(F.struct("distance", "found")).alias("_best"))
    second = rest.join(_shuffled(close), "name").select("_path", F.col("_best.found").alias("found"), F.lit("near").alias("how"), F.lit(None).cast("int").alias("depth"), F.col("_best.distance").alias("distance"))
    answers = first.withColumn("distance", F.lit(None).cast("int")).unionByName(second)
    return asked.join(_shuffled(answers), "_path", "left").select(F.col("_id").alias(key), "found", "how", "depth", "distance")


def find_images(wanted: DataFrame, files: DataFrame, key: str, folder: str, stem: str, suffixes: list[str], ending: str = ".png") -> DataFrame:
    """key, found, how for each row of `wanted`: folder/stem + the first suffix that is there (`exact`), else the least file
    of the folder with this ending whose name holds the word of a suffix (`word`: without leading underscores, up to its
    first point; empty words count for nothing), else null. files: one row for each `path`."""
    words = sorted({w for s in suffixes if (w := s.lstrip("_").split(".")[0])})
    there = files.select(F.col("path").alias("_file"), F.regexp_replace("path", "/[^/]*$", "").alias("_dir"), F.element_at(F.split("path", "/"), -1).alias("_own")).where("_file IS NOT NULL")
    asked = wanted.select(F.col(key).alias("_id"), F.regexp_replace(F.col(folder), "/$", "").alias("_dir"), F.col(stem).alias("_stem"))
    places = asked.select("_dir", "_stem").distinct()
    tried = places.select("_dir", "_stem", F.posexplode(F.array(*[F.concat("_stem", F.lit(s)) for s in suffixes])).alias("_place", "_own"))
    exact = tried.join(_shuffled(there), ["_dir", "_own"]).groupBy("_dir", "_stem").agg(F.min(F.struct("_place", "_file"))["_file"].alias("_exact"))
    holds = F.lit(False)
    for w in words:
        holds = holds | F.col("_own").contains(w)
    loose = there.where(F.col("_own").endswith(ending) & holds).groupBy("_dir").agg(F.min("_file").alias("_loose"))
    rows = asked.join(_shuffled(exact), ["_dir", "_stem"], "left").join(_shuffled(loose), "_dir", "left")
    how = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_loose").isNotNull(), "word")
    return rows.select(F.col("_id").alias(key), F.coalesce("_exact", "_loose").alias("found"), how.alias("how"))
