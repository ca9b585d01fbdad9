"""Round trips through the sources: files written from the given tables by Spark, and read back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspan.operators import resolve
from radspan.plans.proxies import table
from radspan.sources import archives, cache, dicom, dicom_files, dicom_source, inventory, pyramid
from radspan.sources.scratch import folder, spread

def _encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of parts: every second one implicit; key % 50 = 7 cut off in a value, % 40 = 3 with a tag twice, % 60 = 11 no DICOM."""
    for batch in batches:
        contents = []
        for path, key, name, maker, kind, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            values = [("PatientID", f"P{key}"), ("SeriesDescription", name), ("Manufacturer", maker), ("SeriesInstanceUID", f"1.2.{key % 97}"), ("StudyInstanceUID", f"1.{key % 13}"), ("InstanceNumber", str(key)), ("ImagePositionPatient", f"0\\0\\{size - 25}"), ("RepetitionTime", f"{size}.5"), ("Rows", str(size)), ("StudyDescription", kind)]
            content = dicom_files.encoded(values + [("PatientID", "again")] * (key % 40 == 3), pixels=size * 64, implicit=key % 2 == 0)
            contents.append(content[:200] if key % 50 == 7 else b"none" if key % 60 == 11 else content)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(contents, pa.binary())], names=["path", "content"])


def part_files(spark: SparkSession, sf: str) -> str:
    """A folder with one DICOM file for each part."""
    root = folder(spark, "parts")
    key = F.col("p_partkey")
    path = F.concat(F.lit(root + "/study"), (key % 13).cast("string"), F.lit("/f"), key.cast("string"), F.lit(".dcm"))
    rows = table(spark, sf, "part").select(path.alias("path"), key, "p_name", "p_brand", "p_type", F.col("p_size").cast("int"))
    dicom_files.write_files(spread(rows, "p_partkey").mapInArrow(_encoded, "path string, content binary")).write.format("noop").mode("overwrite").save()
    return root


def _key() -> F.Column:
    return F.regexp_extract("path", r"f(\d+)\.dcm$", 1).cast("long").alias("p_partkey")


def dicom_headers(spark, sf) -> DataFrame:
    """The data source over a file for each part: all tags."""
    dicom_source.register(spark)
    rows = spark.read.format("dicom").load(part_files(spark, sf))
    t = lambda k: F.try_element_at("tags", F.lit(k))
    return rows.select(_key(), t("PatientID").alias("patient_id"), t("SeriesDescription").alias("description"), t("Rows").alias("n_rows"), F.try_element_at("meta", F.lit("TransferSyntaxUID")).alias("syntax"), "has_pixel_data", "tag_count", "error")


def dicom_columns(spark, sf) -> DataFrame:
    """The same by named columns, with filters on path and length that choose the files."""
    dicom_source.register(spark)
    rows = spark.read.format("dicom").schema("path string, length long, Manufacturer string, RepetitionTime double, Rows int, error string").load(part_files(spark, sf))
    return rows.where(F.col("path").contains("/study4/") & (F.col("length") > 1000)).select(_key(), F.col("Manufacturer").alias("maker"), F.col("RepetitionTime").alias("tr"), F.col("Rows").alias("n_rows"), "error")


def dicom_records(spark, sf) -> DataFrame:
    """The flat record of each readable file, over paths that Spark has listed."""
    files = inventory.listed(spark, part_files(spark, sf)).select("path")
    rows = dicom.record(dicom.headers(files)).withColumnRenamed("_filepath", "path")
    return rows.select(_key(), *[F.col(c).alias(c.lstrip("_")) for c in ("_filename", "_series_uid", "_manufacturer", "_model", "_tr", "_te", "_z_position", "_instance_number", "_transfer_syntax_name")])


def dicom_series(spark, sf) -> DataFrame:
    """Series with their files in the order of their places."""
    files = inventory.listed(spark, part_files(spark, sf)).select("path")
    rows = dicom.series(dicom.headers(files))
    ids = F.transform("file_paths", lambda p: F.regexp_extract(p, r"f(\d+)\.dcm$", 1))
    return rows.select("study_id", "series_uid", F.col("file_count").cast("long").alias("file_count"), "tr_ms", F.array_join(ids, "|").alias("files"))


def dicom_inventory(spark, sf) -> DataFrame:
    """Figures of each file for an inventory, unreadable ones with their kind."""
    files = inventory.listed(spark, part_files(spark, sf))
    rows = dicom.universal_record(dicom.headers(files))
    return rows.select(_key(), "file_type", "dicom_patient_id", "dicom_rows", "dicom_columns", "dicom_tr", "dicom_tag_count", "has_pixel_data")


def dicom_tags(spark, sf) -> DataFrame:
    """Every tag of every file as a row, counted by tag."""
    files = inventory.listed(spark, part_files(spark, sf))
    return dicom.tag_rows(files).groupBy("keyword", "tag", "vr", "meta", "error").agg(F.count("*").alias("n"), F.count_distinct("path").alias("n_files"))


def volume_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as image lines of whole numbers: 24 of them a slice, 5 slices a volume; of the last one lines may be missing."""
    at = F.col("vec_id")
    line = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("double"))
    return table(spark, sf, "embeddings").select(F.floor(at / 120).alias("volume"), F.floor(at % 120 / 24).cast("int").alias("z"), (at % 24).cast("int").alias("y"), line.alias("line"))


def _pyramid(spark: SparkSession, sf: str) -> str:
    root = folder(spark, "pyramid")
    pyramid.write(volume_lines(spark, sf), root, 4, (2, 8, 16), (5.0, 0.5, 0.5))
    return root


def pyramid_blocks(spark, sf) -> DataFrame:
    """Volumes stored as a chunked pyramid and read back: every block, with its voxels times 512 (whole numbers up to level 3)."""
    rows = spark.read.parquet(f"{_pyramid(spark, sf)}/blocks")
    return rows.select("volume", F.col("level").cast("long").alias("level"), "key", "nz", "ny", "nx", F.array_join(F.transform("values", lambda x: F.round(x * 512).cast("long")), " ").alias("voxels"))


def pyramid_levels(spark, sf) -> DataFrame:
    """What the store tells of each level, and the volumes that it refused (level -1)."""
    root = _pyramid(spark, sf)
    rows = spark.read.parquet(f"{root}/levels").select("volume", F.col("level").cast("long").alias("level"), "name", F.concat_ws("x", "d", "h", "w").alias("shape"), F.array_join(F.transform("scale", lambda s: s.cast("decimal(9,3)")), "x").alias("scale"), F.array_join("chunk", "x").alias("chunk"), "n_blocks", "n_bytes")
    return rows.unionByName(spark.read.parquet(f"{root}/refused").select("volume", F.lit(-1).cast("long").alias("level"), F.lit("refused").alias("name")), allowMissingColumns=True)


def _images(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as image files: three of four in folders of brand and size, those of every seventh in a second place too."""
    key, own = F.col("p_partkey"), F.concat(F.lit("f"), F.col("p_partkey"), F.lit(".png"))
    paths = F.array(F.concat_ws("/", F.lit("data"), "p_brand", F.col("p_size").cast("string"), own), F.when(key % 7 == 0, F.concat_ws("/", F.lit("copy"), "p_brand", own)))
    return table(spark, sf, "part").where(key % 4 != 3).select(F.explode(F.array_compact(paths)).alias("path"))


def path_resolver(spark, sf) -> DataFrame:
    """Line items as recorded paths of their parts: right ones, from another root, of another folder, with slips in the name."""
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    key, n = F.col("p_partkey").cast("string"), F.col("l_linenumber")
    own = F.when(n == 4, F.concat(F.lit("g"), key, F.lit(".png"))).when(n == 5, F.concat(F.lit("f"), key, F.lit("x.png"))).when(n == 6, F.concat(F.lit("f"), key, F.lit(".jpeg"))).otherwise(F.concat(F.lit("f"), key, F.lit(".png")))
    size = F.col("p_size").cast("string")
    path = F.when(n == 1, F.concat_ws("/", F.lit("data"), "p_brand", size, own)).when(n == 2, F.concat_ws("\\", F.lit("C:"), F.lit("old"), "p_brand", size, own)).when(n == 7, F.lit("data/")).otherwise(F.concat_ws("/", F.lit("/x"), own))
    wanted = rows.select((F.col("l_orderkey") * 10 + n).alias("item"), path.alias("path"))
    return resolve.resolve(wanted, _images(spark, sf), "item").withColumns({c: F.col(c).cast("long") for c in ("depth", "distance")})


def image_finder(spark, sf) -> DataFrame:
    """Parts whose images are sought by folder, stem and suffixes, with the word of a suffix as the last resort."""
    part, key = table(spark, sf, "part"), F.col("p_partkey")
    own = F.concat(F.when(key % 3 == 0, F.concat(F.lit("f"), key)).otherwise(F.concat(F.lit("other"), key)), F.when(key % 2 == 0, F.lit("_multiplane.png")).otherwise(F.lit(".png")))
    files = part.where(key % 4 != 3).select(F.concat_ws("/", F.lit("/d"), "p_brand", own).alias("path"))
    wanted = part.select(key, F.concat_ws("/", F.lit("/d"), "p_brand", F.lit("")).alias("folder"), F.concat(F.lit("f"), key).alias("stem"))
    return resolve.find_images(wanted, files, "p_partkey", "folder", "stem", ["_multiplane.png", ".png"])


def tar_members(spark, sf) -> DataFrame:
    """A file for each part, packed by study into archives of at most 16 KB, which are then read by their index."""
    root = folder(spark, "packs")
    study, own = F.regexp_extract("path", r"/(study\d+)/", 1), F.element_at(F.split("path", "/"), -1)
    listed = inventory.listed(spark, part_files(spark, sf))
    written = archives.write(listed.select(study.alias("study"), own.alias("name"), "path", "length"), root, "study", "name", "path", "length", 16 << 10)
    rows = archives.members(written.withColumnRenamed("archive", "path"))
    return rows.select(F.regexp_extract("archive", r"/(study\d+)/", 1).alias("study"), F.regexp_extract("archive", r"(\d+)\.tar$", 1).cast("long").alias("part"), "member", "size", "error")


def extraction_cache(spark, sf) -> DataFrame:
    """Headers of a file for each part, kept by study, in two runs: study 3 grows, study 4 is new, study 5 goes; `run` tells which run read a row."""
    root, own = folder(spark, "cache"), F.regexp_extract("path", r"/(study\d+)/", 1)
    listed = inventory.listed(spark, part_files(spark, sf))
    listed = listed.select(own.alias("study"), _key(), "path", "length", "modificationTime")

    def headers(run: int):
        def extract(files: DataFrame) -> DataFrame:
            found = dicom.headers(files.select("path")).select("path", F.try_element_at("tags", F.lit("PatientID")).alias("patient_id"))
            return found.select(F.regexp_extract("path", r"/(study\d+)/", 1).alias("study"), _key(), "patient_id", F.lit(run).alias("run"))

        return extract

    cache.refresh(listed.where("p_partkey % 26 <> 3 AND study <> 'study4'"), root, "study", headers(1))
    states = cache.refresh(listed.where("study <> 'study5'"), root, "study", headers(2))
    return cache.cached(spark, root, "study").join(states, "study").select("study", "p_partkey", "patient_id", F.col("run").cast("long").alias("run"), "state")


QUERIES = {f.__name__: f for f in (dicom_headers, dicom_columns, dicom_records, dicom_series, dicom_inventory, dicom_tags, pyramid_blocks, pyramid_levels, path_resolver, image_finder, tar_members, extraction_cache)}
_P = """p AS (
  SELECT *, CAST(p_size AS INT) AS size, p_partkey % 50 = 7 AS cut, p_partkey % 60 = 11 AND p_partkey % 50 <> 7 AS none, p_partkey % 40 = 3 AS twice, p_partkey % 2 = 0 AS implicit,
    p_partkey % 50 = 7 OR p_partkey % 60 = 11 AS bad FROM part
)"""
_ERROR = "CASE WHEN cut THEN 'a value without end' WHEN none THEN 'no DICOM file' WHEN twice THEN 'tag (0010,0020) is repeated' END"
_FULL = {"1.2.840.10008.1.2": "Implicit VR LE", "1.2.840.10008.1.2.1": "Explicit VR LE"}
ORACLE = {
    "dicom_headers": f"WITH {_P} SELECT p_partkey, CASE WHEN NOT bad THEN 'P' || p_partkey END AS patient_id, CASE WHEN NOT bad THEN p_name END AS description, CASE WHEN NOT bad THEN CAST(size AS VARCHAR) END AS n_rows, CASE WHEN NOT bad THEN CASE WHEN implicit THEN '1.2.840.10008.1.2' ELSE '1.2.840.10008.1.2.1' END END AS syntax, CASE WHEN NOT bad THEN true END AS has_pixel_data, CASE WHEN NOT bad THEN CAST(11 + twice::INT AS INT) END AS tag_count, {_ERROR} AS error FROM p",
    "dicom_columns": f"WITH {_P} SELECT p_partkey, CASE WHEN NOT bad THEN p_brand END AS maker, CASE WHEN NOT bad THEN size + 0.5::DOUBLE END AS tr, CASE WHEN NOT bad THEN size END AS n_rows, {_ERROR} AS error FROM p WHERE NOT bad AND p_partkey % 13 = 4 AND _length > 1000",
    "dicom_records": f"WITH {_P} SELECT p_partkey, 'f' || p_partkey || '.dcm' AS filename, '1.2.' || p_partkey % 97 AS series_uid, p_brand AS manufacturer, '' AS model, size + 0.5::DOUBLE AS tr, CAST(NULL AS DOUBLE) AS te, CAST(size - 25 AS DOUBLE) AS z_position, CAST(p_partkey AS INT) AS instance_number, CASE WHEN implicit THEN '{_FULL['1.2.840.10008.1.2']}' ELSE '{_FULL['1.2.840.10008.1.2.1']}' END AS transfer_syntax_name FROM p WHERE NOT bad",
    "dicom_series": f"WITH {_P} SELECT '1.' || p_partkey % 13 AS study_id, '1.2.' || p_partkey % 97 AS series_uid, count(*) AS file_count, arg_min(size || '.5', 'study' || p_partkey % 13 || '/f' || p_partkey || '.dcm') AS tr_ms, string_agg(CAST(p_partkey AS VARCHAR), '|' ORDER BY size, p_partkey) AS files FROM p WHERE NOT bad GROUP BY 1, 2",
    "dicom_inventory": f"WITH {_P} SELECT p_partkey, CASE WHEN bad THEN 'dicom_error' ELSE 'dicom' END AS file_type, CASE WHEN NOT bad THEN 'P' || p_partkey END AS dicom_patient_id, CASE WHEN NOT bad THEN size END AS dicom_rows, CASE WHEN NOT bad THEN 0 END AS dicom_columns, CASE WHEN NOT bad THEN size + 0.5::DOUBLE END AS dicom_tr, CASE WHEN NOT bad THEN CAST(11 + twice::INT AS INT) END AS dicom_tag_count, CASE WHEN NOT bad THEN true END AS has_pixel_data FROM p",
}
# the length of a file: head and syntax, then each value with its 8 bytes of tag, padded to even
_EVEN = "CAST(ceil(length({}) / 2.0) * 2 + 8 AS INT)"
_VALUES = ["'P' || p_partkey", "p_name", "p_brand", "'1.2.' || p_partkey % 97", "'1.' || p_partkey % 13", "CAST(p_partkey AS VARCHAR)", "'0.0.' || (size - 25)", "size || '.5'", "p_type"]
_LENGTH = " + ".join(["132", "CASE WHEN implicit THEN 26 ELSE 28 END", *[_EVEN.format(v) for v in _VALUES], "10", "CASE WHEN twice THEN 14 ELSE 0 END", "CASE WHEN implicit THEN 8 ELSE 12 END", "size * 64"])
ORACLE["dicom_columns"] = ORACLE["dicom_columns"].replace("_length", f"({_LENGTH})")
_KEYWORDS = "('StudyDescription', '(0008,1030)', 'LO'), ('SeriesDescription', '(0008,103e)', 'LO'), ('Manufacturer', '(0008,0070)', 'LO'), ('PatientID', '(0010,0020)', 'LO'), ('RepetitionTime', '(0018,0080)', 'LO'), ('StudyInstanceUID', '(0020,000d)', 'UI'), ('SeriesInstanceUID', '(0020,000e)', 'UI'), ('InstanceNumber', '(0020,0013)', 'LO'), ('ImagePositionPatient', '(0020,0032)', 'LO'), ('Rows', '(0028,0010)', 'US'), ('TransferSyntaxUID', '(0002,0010)', 'UI')"
ORACLE["dicom_tags"] = f"""WITH {_P}, k(keyword, tag, kind) AS (VALUES {_KEYWORDS})
SELECT keyword, tag, CASE WHEN implicit AND keyword NOT IN ('Rows', 'TransferSyntaxUID') THEN '' ELSE kind END AS vr, keyword = 'TransferSyntaxUID' AS meta, CAST(NULL AS VARCHAR) AS error,
  count(*) + CASE WHEN keyword = 'PatientID' THEN count_if(twice) ELSE 0 END AS n, count(*) AS n_files FROM p, k WHERE NOT bad GROUP BY keyword, tag, 3, 4
UNION ALL SELECT NULL, NULL, NULL, NULL, {_ERROR}, count(*), count(*) FROM p WHERE bad GROUP BY 5"""

_WHOLE = """v AS (SELECT vec_id // 120 AS volume, vec_id % 120 // 24 AS z, vec_id % 24 AS y, unnest(range(len(embedding))) AS x, floor(unnest(embedding)::DOUBLE * 1024) AS v FROM embeddings),
shapes AS (SELECT volume, max(z) + 1 AS d, max(y) + 1 AS h, max(x) + 1 AS w, count(*) AS n FROM v GROUP BY 1),
k AS (SELECT unnest(range(4)) AS level),
cells AS (SELECT volume, level, z >> level AS z, y >> level AS y, x >> level AS x, sum(v) * 512 / pow(8, level) AS v FROM v JOIN shapes USING (volume), k WHERE n = d * h * w GROUP BY 1, 2, 3, 4, 5),
b AS (SELECT volume, level, z // 2 AS cz, y // 8 AS cy, x // 16 AS cx, max(z) - min(z) + 1 AS nz, max(y) - min(y) + 1 AS ny, max(x) - min(x) + 1 AS nx, string_agg(CAST(v AS BIGINT), ' ' ORDER BY z, y, x) AS voxels FROM cells GROUP BY ALL)"""
_KEY = " + ".join(f"(({c} >> {i}) & 1) * {1 << (3 * i + at)}" for i in range(3) for c, at in (("cz", 2), ("cy", 1), ("cx", 0)))
ORACLE["pyramid_blocks"] = f"WITH {_WHOLE} SELECT volume, level, {_KEY} AS key, CAST(nz AS INT) AS nz, CAST(ny AS INT) AS ny, CAST(nx AS INT) AS nx, voxels FROM b"
_SIDE = [f"CAST(ceil({c} / pow(2, level)) AS BIGINT)" for c in "dhw"]
_SCALE = " || 'x' || ".join(f"CAST(CAST({s} * pow(2, level) AS DECIMAL(9,3)) AS VARCHAR)" for s in (5.0, 0.5, 0.5))
ORACLE["pyramid_levels"] = f"""WITH {_WHOLE}
SELECT volume, level, 's' || level AS name, concat_ws('x', {", ".join(_SIDE)}) AS shape, {_SCALE} AS scale, concat_ws('x', {", ".join(f"least({c}, {n})" for c, n in zip(_SIDE, (2, 8, 16), strict=True))}) AS chunk, count(*) AS n_blocks, CAST(sum(nz * ny * nx) * 4 AS BIGINT) AS n_bytes FROM b JOIN shapes USING (volume) GROUP BY volume, level, d, h, w
UNION ALL SELECT volume, -1, 'refused', NULL, NULL, NULL, NULL, NULL FROM shapes WHERE n <> d * h * w"""
_FILES = "files AS (SELECT 'data/' || p_brand || '/' || p_size || '/f' || p_partkey || '.png' AS path, 'f' || p_partkey || '.png' AS own, p_partkey AS k FROM part WHERE p_partkey % 4 <> 3 UNION ALL SELECT 'copy/' || p_brand || '/f' || p_partkey || '.png', 'f' || p_partkey || '.png', p_partkey FROM part WHERE p_partkey % 4 <> 3 AND p_partkey % 7 = 0)"
ORACLE["path_resolver"] = f"""WITH {_FILES},
w AS (SELECT l_orderkey * 10 + l_linenumber AS item, l_linenumber AS n, p_partkey AS k, CASE l_linenumber WHEN 4 THEN 'g' ELSE 'f' END || p_partkey || CASE l_linenumber WHEN 5 THEN 'x.png' WHEN 6 THEN '.jpeg' ELSE '.png' END AS own FROM lineitem JOIN part ON l_partkey = p_partkey),
one AS (SELECT k, min(path) FILTER (starts_with(path, 'data')) AS data, min(path) AS least FROM files GROUP BY 1),
named AS (SELECT own, min(path) AS path FROM files GROUP BY 1),
lost AS (SELECT DISTINCT own FROM w WHERE n <> 7 AND own NOT IN (SELECT own FROM named)),
near AS (SELECT lost.own, 1 AS distance, min(path) AS path FROM lost JOIN named ON levenshtein(lost.own, named.own) = 1 GROUP BY 1)
SELECT item, CASE WHEN n = 7 THEN NULL WHEN n < 3 THEN coalesce(data, near.path) WHEN n = 3 THEN coalesce(least, near.path) ELSE near.path END AS found,
  CASE WHEN n = 7 THEN NULL WHEN n = 1 AND data IS NOT NULL THEN 'exact' WHEN n < 4 AND data IS NOT NULL THEN 'end' WHEN near.path IS NOT NULL THEN 'near' END AS how,
  CASE WHEN data IS NOT NULL THEN CASE n WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 1 END END AS depth,
  CASE WHEN n <> 7 AND (n > 3 OR data IS NULL) THEN distance END AS distance
FROM w LEFT JOIN one USING (k) LEFT JOIN near ON w.own = near.own"""
ORACLE["image_finder"] = """WITH files AS (SELECT p_partkey AS k, '/d/' || p_brand AS dir, CASE WHEN p_partkey % 3 = 0 THEN 'f' ELSE 'other' END || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_multiplane.png' ELSE '.png' END AS own FROM part WHERE p_partkey % 4 <> 3),
loose AS (SELECT dir, min(dir || '/' || own) AS path FROM files WHERE contains(own, 'multiplane') GROUP BY 1)
SELECT p_partkey, coalesce(e.dir || '/' || own, path) AS found, CASE WHEN own IS NOT NULL THEN 'exact' WHEN path IS NOT NULL THEN 'word' END AS how
FROM part LEFT JOIN (SELECT k, files.dir, own FROM files WHERE k % 3 = 0) e ON k = p_partkey LEFT JOIN loose ON loose.dir = '/d/' || p_brand"""
ORACLE["tar_members"] = f"""WITH {_P},
f AS (SELECT 'study' || p_partkey % 13 AS study, 'f' || p_partkey || '.dcm' AS member, CAST(CASE WHEN cut THEN 200 WHEN none THEN 4 ELSE {_LENGTH} END AS BIGINT) AS size FROM p),
t AS (SELECT *, CAST(ceil(size / 512.0) * 512 + 512 AS BIGINT) AS taken FROM f),
e AS (SELECT *, sum(taken) OVER (PARTITION BY study ORDER BY member) AS upto FROM t),
c AS (SELECT *, CAST((upto - taken) // 16384 AS BIGINT) AS a, CAST((upto - 1) // 16384 AS BIGINT) AS b FROM e)
SELECT study, dense_rank() OVER (PARTITION BY study ORDER BY CASE WHEN a = b THEN a * 2 ELSE a * 2 + 1 END) - 1 AS part, member, size, CAST(NULL AS VARCHAR) AS error FROM c"""
ORACLE["extraction_cache"] = f"""WITH {_P}, s AS (SELECT *, p_partkey % 13 AS k FROM p WHERE p_partkey % 13 <> 5)
SELECT 'study' || k AS study, p_partkey, CASE WHEN NOT bad THEN 'P' || p_partkey END AS patient_id, CASE WHEN k IN (3, 4) THEN 2 ELSE 1 END AS run, CASE k WHEN 3 THEN 'changed' WHEN 4 THEN 'new' ELSE 'same' END AS state FROM s"""
