"""Archives by their index, packs by size, and the skip rule."""

import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from radspan.sources import archives


class Counted(io.BytesIO):
    n = 0

    def read(self, size=-1):
        got = super().read(size)
        Counted.n += len(got)
        return got


def tar_of(sizes):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, size in sizes.items():
            info = tarfile.TarInfo(name)
            info.size = size
            tar.addfile(info, io.BytesIO(b"x" * size))
    return out.getvalue()


def test_an_index_reads_header_blocks_only():
    sizes = {f"m{i}": 1 << 20 for i in range(8)}
    content = tar_of(sizes)
    Counted.n = 0
    found = list(archives.index_of(Counted(content)))
    assert [(n, s) for n, _, s in found] == list(sizes.items()) and all(content[o : o + 2] == b"xx" for _, o, _ in found)
    assert Counted.n < 12 * 512


def test_members_of_good_empty_and_broken_archives(spark, tmp_path):
    good = tar_of({"a": 700, "b": 0, "long/" * 40 + "c": 1})
    for name, content in {"good": good, "empty": tar_of({}), "cut": good[:1000], "none": b"no tar at all" * 100}.items():
        (tmp_path / f"{name}.tar").write_bytes(content)
    paths = spark.createDataFrame([(f"{tmp_path}/{n}.tar",) for n in ("good", "empty", "cut", "none", "gone")] + [(None,)], "path string")
    rows = archives.members(paths).collect()
    by = lambda n: [(r.member, r.size) for r in rows if r.archive.endswith(f"/{n}.tar") and r.error is None]
    assert by("good") == [("a", 700), ("b", 0), ("long/" * 40 + "c", 1)] and by("empty") == [] and by("none") == []
    assert {os.path.basename(r.archive) for r in rows if r.error} == {"cut.tar", "none.tar", "gone.tar"}


def test_packs_hold_at_most_their_bytes_and_a_hot_key_is_many_tasks(spark):
    rows = spark.range(5000).selectExpr("if(id % 10 = 0, 'cold', 'hot') as k", "lpad(id, 5, '0') as name", "id * 7919 % 4000 as size", "'x' as part_")
    odd = spark.createDataFrame([("big", "a", 10**6, "x"), ("big", "b", 0, "x"), (None, "n", 5, "x"), ("hot", None, 5, "x"), ("hot", "z", None, "x")], "k string, name string, size long, part_ string")
    found = archives.packs(rows.unionByName(odd), "k", "name", "size", 20_000)
    assert found.count() == 5005 and found.where("part IS NULL").count() == 2
    per = found.where("part IS NOT NULL").groupBy("k", "part").agg(F.sum(archives.taken(F.col("size"))).alias("b"), F.count("*").alias("n"), F.min("name").alias("low"), F.max("name").alias("high")).collect()
    assert all(r.b <= 20_000 or r.n == 1 for r in per)
    for key in ("hot", "cold", "big", None):
        own = sorted((r for r in per if r.k == key), key=lambda r: r.part)
        assert [r.part for r in own] == list(range(len(own)))
        assert all(a.high < b.low for a, b in zip(own, own[1:], strict=False))
    total = sum(r.b for r in per if r.k == "hot")
    assert total / 20_000 <= sum(r.k == "hot" for r in per) <= 2 * total / 20_000 + 1
    with pytest.raises(ValueError, match="at least one byte"):
        archives.packs(rows, "k", "name", "size", 0)


def test_equal_entry_counts_skip_a_rewrite(spark, tmp_path):
    source, root = tmp_path / "in", f"{tmp_path}/out"
    source.mkdir()
    for i in range(12):
        (source / f"{i:02}.png").write_bytes(bytes([i]) * (i * 300))
    rows = spark.createDataFrame([("ab"[i % 2], f"s/{i:02}.png", f"{source}/{i:02}.png", i * 300) for i in range(12)], "study string, name string, path string, size long")
    put = lambda df: {r.archive[len(root) :]: (r.n, r.skipped) for r in archives.write(df, root, "study", "name", "path", "size", 6000).collect()}
    first = put(rows)
    assert not any(s for _, s in first.values()) and sum(n for n, _ in first.values()) == 12 and len(first) > 2
    for place in first:
        with tarfile.open(root + place) as tar:
            assert all(tar.extractfile(m).read() == (source / os.path.basename(m.name)).read_bytes() for m in tar)
    assert put(rows) == {a: (n, True) for a, (n, _) in first.items()}
    with open(root + "/a/0.tar", "r+b") as half:
        half.truncate(700)
    again = put(rows.where("name <> 's/11.png'"))
    assert again["/a/0.tar"] == (first["/a/0.tar"][0], False) and any(s for _, s in again.values())
    assert not [n for _, _, names in os.walk(root) for n in names if ".new-" in n]
    with pytest.raises(ValueError, match="no place"):
        put(rows.withColumn("study", F.lit(None).cast("string")))
    assert put(rows.limit(0)) == {}
