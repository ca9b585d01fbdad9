"""What the operators of this subpackage share: work tables, joins of a checked size, ordered prefix sums."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A side of a join with at most so many rows and bytes is broadcast; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: White space of the text contracts: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


_own_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; one of our own, the same for the whole application, only where none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        local = spark.sparkContext.master.split("[")[0] == "local"
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-radspan-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_radspan_work"
    return _own_dirs[app]


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, outlives lost executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/radspan-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a work table with one more column, a number for each row that stays the same from then on; and its name."""
    row, taken = "_row", {c.lower() for c in df.columns}
    while row in taken:
        row += "_"
    return work_table(df.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def with_group(rows: DataFrame, key: str, aggregates: list[Column], support: float = 0.001) -> DataFrame:
    """rows (a work table) with aggregates of all rows that share the key, which is not null.

    A Misra-Gries pass names every key that may hold a share `support` of the rows. The true heavy ones are aggregated
    by partial sums and broadcast, at most 1/support rows, so their rows are served where they lie. All other keys go
    through an ordinary shuffle, where none is heavy.
    """
    named = rows.stat.freqItems([key], support).select(F.explode(f"{key}_freqItems").alias(key))
    least = F.lit(max(2, int(support * rows.count())))
    heavy = rows.join(F.broadcast(named), key, "left_semi").groupBy(key).agg(*aggregates, F.count("*").alias("_n"))
    heavy = work_table(heavy.where(F.col("_n") >= least).drop("_n"), "heavy")
    near = rows.join(F.broadcast(heavy), key)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return near.unionByName(light.join(light.groupBy(key).agg(*aggregates), key))


def _width(name: str, kind: T.DataType) -> Column:
    """About the bytes of a value of this column."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(kind, T.ArrayType):
        return 8 * F.coalesce(F.size(name), F.lit(0))
    return F.lit(8 * (len(kind) if isinstance(kind, T.StructType) else 1))


def sized(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if it has at most `limit` rows and `most` bytes, else df as it is, for a shuffled join.

    Both are counted, in one pass over the columns whose width varies, unless the number of rows is given.
    """
    size = None
    if rows is None:
        rows, size = df.agg(F.count("*"), F.sum(sum((_width(f"`{f.name}`", f.dataType) for f in df.schema), F.lit(0)))).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= most else df


def small_batches(spark: SparkSession, rows: int = 512, size: int = 8 << 20) -> None:
    """Lets Arrow batches hold at most so many rows and about so many bytes, so that a task's memory does not hang on
    the length of texts. A smaller setting of the session's own stays. Plans are made when a result is asked for, so the
    setting must outlast the call."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        found = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)b?", spark.conf.get(key).lower())
        now = int(found[1]) << 10 * "bkmgt".index(found[2] or "b") if found else 0
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def clean_text(text: Column) -> Column:
    """null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def hash_order(*parts: Column | str) -> Column:
    """60 bits of an md5 as a long: the same order in every engine that has md5."""
    joined = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def ordered_prefix(df: DataFrame, order: list[str], sums: list[str], tile_rows: int = 1024) -> DataFrame:
    """df with `rank` (from 0) and, for each column c of `sums`, `before_c`: the sum over all rows before it in the given order.

    No window sees more than tile_rows rows, the tiles of one range partition or one row for each range partition:
    sort by range, number the rows where they lie, add up tiles, then partitions.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spread = spread.withColumn("_at", F.monotonically_increasing_id())
    spread = spread.select(
        *df.columns,
        F.shiftright("_at", 33).cast("int").alias("_part"),
        F.col("_at").bitwiseAND((1 << 33) - 1).alias("_row"),
    ).withColumn("_tile", F.floor(F.col("_row") / tile_rows))
    rows = work_table(spread, "ordered")
    every = [*sums, "_n"]
    tiles = rows.withColumn("_n", F.lit(1).cast("long")).groupBy("_part", "_tile").agg(*[F.sum(c).alias(c) for c in every])
    tiles = work_table(tiles, "tiles")
    parts = tiles.groupBy("_part").agg(*[F.sum(c).alias(c) for c in every])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    parts = parts.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_p_{c}") for c in every])
    inside = Window.partitionBy("_part").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select("_part", "_tile", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_t_{c}") for c in every])
    tiles = tiles.join(parts, "_part").select("_part", "_tile", *[(F.col(f"_t_{c}") + F.col(f"_p_{c}")).alias(f"_b_{c}") for c in every])
    own = Window.partitionBy("_part", "_tile").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(tiles, ["_part", "_tile"])
    return out.select(
        *df.columns,
        (F.col("_b__n") + F.col("_row") - F.col("_tile") * tile_rows).cast("long").alias("rank"),
        *[(F.col(f"_b_{c}") + F.coalesce(F.sum(c).over(own), F.lit(0))).cast("long").alias(f"before_{c}") for c in sums],
    )


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
