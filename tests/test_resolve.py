"""Paths resolved by ends and near names, against brute force; images of a series by name, suffix and word."""

import random

import pytest

from radspan.operators import resolve


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(path, files, most):
    if not path or path.replace("\\", "/").endswith("/"):
        return None, None
    split = lambda p: [c for c in p.replace("\\", "/").split("/") if c not in ("", ".")]
    mine = split(path)
    if not mine:
        return None, None
    best = []
    for f in files:
        theirs, depth = split(f), 0
        while depth < min(len(mine), len(theirs)) and mine[-1 - depth] == theirs[-1 - depth]:
            depth += 1
        if depth:
            best.append((-depth, not (depth == len(mine) == len(theirs)), f))
    if best:
        _, other, found = min(best)
        return found, "end" if other else "exact"
    near = sorted((edits(mine[-1], split(f)[-1]), f) for f in files)
    return (near[0][1], "near") if near and near[0][0] <= most else (None, None)


@pytest.mark.parametrize("most", [1, 2])
def test_resolve_as_by_brute_force(spark, most):
    rng = random.Random(most)
    name = lambda: "".join(rng.choice("ab1é") for _ in range(rng.randint(1, 5))) + rng.choice([".png", ".gz", ""])
    files = sorted({"/".join([rng.choice(["", "r", "./r"]), *(rng.choice("xyz") for _ in range(rng.randint(0, 3))), name()]) for _ in range(120)})
    wanted = [rng.choice(files) for _ in range(20)] + ["/".join([rng.choice("xyz"), rng.choice("xyz"), name()]) for _ in range(200)] + ["a\\x\\" + name() for _ in range(20)] + [None, "", "x/", "/", ".", "q" * 300]
    wanted += wanted[:5]
    asked = spark.createDataFrame(list(enumerate(wanted)), "id long, path string").withColumnRenamed("path", "recorded").selectExpr("*", "'clash' as found", "'clash' as name")
    there = spark.createDataFrame([(f, 1) for f in [*files, *files[:9], None, "d/"]], "path string, name int")
    got = {r.id: (r.found, r.how) for r in resolve.resolve(asked, there, "id", "recorded", most).collect()}
    assert len(got) == len(wanted)
    assert got == {i: brute(p, files, most) for i, p in enumerate(wanted)}
    assert {"exact", "end", "near", None} == {how for _, how in got.values()}


def test_a_name_of_many_folders_is_one_row_of_the_join(spark):
    files = spark.range(20_000).selectExpr("concat('/d/s', id, '/image.png') as path")
    wanted = spark.range(20_000).selectExpr("id", "concat('/old/s', id, if(id % 2 = 0, '/image.png', '/imagee.png')) as path")
    rows = resolve.resolve(wanted, files, "id").selectExpr("how", "depth", "found = concat('/d/s', id, '/image.png') as own").groupBy("how", "depth").agg({"own": "count_if", "*": "count"}).collect()
    assert sorted((r.how, r.depth or 0, r["count(1)"], r["count_if(own)"]) for r in rows) == [("end", 2, 10_000, 10_000), ("near", 0, 10_000, 0)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, path string")
    assert resolve.resolve(empty, empty, "id").count() == 0
    one = spark.createDataFrame([(1, "a/b.png")], empty.schema)
    assert resolve.resolve(one, empty, "id").first().found is None


def test_images_by_suffix_in_order_then_by_word(spark):
    files = spark.createDataFrame([("/s/a/k_multiplane.png",), ("/s/a/k.png",), ("/s/b/k.png",), ("/s/c/z_multiplane_2.png",), ("/s/c/y_multiplane.png",), ("/s/d/y_multiplane.jpg",), ("/s/d/sub/multiplane.png",), (None,)], "path string")
    wanted = spark.createDataFrame([(1, "/s/a", "k"), (2, "/s/b/", "k"), (3, "/s/c", "k"), (4, "/s/d", "k"), (5, None, "k"), (6, "/s/a", None), (7, "/s/a", "k")], "id int, dir string, stem string")
    got = {r.id: (r.found, r.how) for r in resolve.find_images(wanted, files, "id", "dir", "stem", ["_multiplane.png", ".png"]).collect()}
    first = ("/s/a/k_multiplane.png", "exact")
    assert got == {1: first, 2: ("/s/b/k.png", "exact"), 3: ("/s/c/y_multiplane.png", "word"), 4: (None, None), 5: (None, None), 6: ("/s/a/k_multiplane.png", "word"), 7: first}


def test_no_side_is_sent_to_the_driver(spark):
    paths = spark.createDataFrame([(1, "/a/f1.png"), (2, "/b/g1.png"), (3, "x/")], "id long, path string")
    got = resolve.resolve(paths, paths.select("path"), "id")
    found = resolve.find_images(paths, paths.select("path"), "id", "path", "path", [".png"])
    assert len(got.collect()) == len(found.collect()) == 3
    assert not any("Broadcast" in df._jdf.queryExecution().executedPlan().toString() for df in (got, found))
