"""Edges with expected values written out: special numbers, nested sequences, white space, replaced files."""

import math
import sqlite3
import struct

import numpy as np
import numpy_volume
import pytest

from radspan.functions import classify
from radspan.operators import profile, volume
from radspan.sources import dicom, sinks

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize(
    ("values", "median", "p25", "p75"),
    [
        ([1.0, 2.0, 5.0, NAN, None], 2.0, 2.0, 5.0),
        ([-INF, 1.0, 2.0], 1.0, 1.0, 2.0),
        ([-INF, -INF, 3.0, INF], -INF, -INF, 3.0),
        ([INF, 1.0, INF], INF, INF, INF),
        ([-1.7e308, 1.7e308, 5.0], 5.0, 5.0, 1.7e308),
        ([5e-324, 1e-323, 0.0], 5e-324, 5e-324, 1e-323),
        ([NAN, None], None, None, None),
    ],
)
def test_numeric_profile_of_special_numbers(spark, values, median, p25, p75):
    row = profile.numeric_profile(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert (row["median"], row["p25"], row["p75"]) == (median, p25, p75)
    numbers = [v for v in values if v is not None and not math.isnan(v)]
    assert (row["min"], row["max"]) == ((min(numbers), max(numbers)) if numbers else (None, None))


def test_histogram_of_a_large_array(spark):
    """One pass: 256 bins over 1,000,000 values."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=1_000_000)
    df = spark.createDataFrame([(1, v.tolist()), (2, [1.0, None, 3.0, NAN, INF]), (3, []), (4, None)], "k int, v array<double>")
    got = {r.k: r for r in volume.with_histogram(df, "v", 256).collect()}
    assert got[1].counts == np.histogram(v, 256)[0].tolist()
    assert (sum(got[2].counts), got[2]["_low"], got[2]["_width"]) == (2, 1.0, 2.0)
    assert (sum(got[3].counts), got[3]["_low"], got[4].counts) == (0, None, None)


def test_symmetry_is_neutral_off_axis():
    v = np.random.default_rng(2).normal(size=(4, 4, 4))
    assert numpy_volume.symmetry(v, "T2 sag FLAIR") == numpy_volume.symmetry(v, "COR T1") == (1.0, "N/A (non-axial)")
    assert numpy_volume.symmetry(v, "Ax T2")[0] < 1.0


def _short(group, element, vr, value):
    value += b" " * (len(value) % 2)
    return struct.pack("<2H2sH", group, element, vr, len(value)) + value


def _open(group, element, inner):
    return struct.pack("<2H2sHI", group, element, b"SQ", 0, 0xFFFFFFFF) + inner + struct.pack("<2HI", 0xFFFE, 0xE0DD, 0)


def _item(inner, known=False):
    if known:
        return struct.pack("<2HI", 0xFFFE, 0xE000, len(inner)) + inner
    return struct.pack("<2HI", 0xFFFE, 0xE000, 0xFFFFFFFF) + inner + struct.pack("<2HI", 0xFFFE, 0xE00D, 0)


@pytest.mark.parametrize("known", [False, True])
def test_what_follows_nested_sequences_is_read(known):
    inner = _open(0x0040, 0xA730, _item(_short(0x0008, 0x0104, b"LO", b"inner"), known) + _item(b"", known))
    content = b"\0" * 128 + b"DICM" + _short(0x0008, 0x0060, b"CS", b"MR") + _open(0x0008, 0x1140, _item(_short(0x0008, 0x0100, b"SH", b"code") + inner, known)) + _short(0x0010, 0x0010, b"PN", b"Name^Some")
    assert [(k, v) for _, k, _, v in dicom.tags(content)] == [("Modality", "MR"), ("PatientName", "Name^Some")]
    with pytest.raises(ValueError, match="without end"):
        list(dicom.tags(content[: content.index(b"inner") + 4]))


def test_all_white_space_around_a_description_goes(spark):
    df = spark.createDataFrame([("\t\n WIP  Ax_T2 \r\n",), ("Ax T2",)], "d string")
    got = [r[0] for r in df.select(classify.normalised(df["d"])).collect()]
    assert not got[0][0].isspace() and not got[0][-1].isspace() and got[0].endswith("AX T2")


def test_sqlite_file_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/x.db"
    for n in (3, 2):
        sinks.sqlite(path, {"study": spark.range(n)}, {"study": "id"})
        with sqlite3.connect(path) as db:
            assert db.execute("SELECT count(*) FROM study").fetchone() == (n,)
    assert [p.name for p in tmp_path.iterdir()] == ["x.db"]
