"""Operators that must not gather a group in one place, against brute force: ranks by blocks, joins by tiles, selection by digits."""

import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelloom import model
from voxelloom.operators import names, planes, ranks, rois
from voxelloom.sources import tiff


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_dense_ranks(spark, block):
    rng = np.random.default_rng(4)
    rows = {(g, int(v)) for g in ("a", "b", None) for v in rng.integers(-50, 200, 60)} | {("a", None), ("lone", 7)}
    got = ranks.dense_ranks(spark.createDataFrame(sorted(rows, key=repr), "g string, value long"), ["g"], block=block).collect()
    order = lambda v: (v is not None, v or 0)
    want = {(g, v): sum(order(w) < order(v) for h, w in rows if h == g) for g, v in rows}
    assert {(r["g"], r["value"]): r["rank"] for r in got} == want and len(got) == len(rows)


def test_ranked_index(spark):
    rows = [("d", 5, 9, 1, "x"), ("d", 7, 9, 2, "y"), ("d", 7, 9, 2, "y"), ("e", 7, -3, 1, "x"), ("e", None, 4, 1, "x"), (None, 2, 2, 1, "x")]
    files = spark.createDataFrame(rows, "dir string, t int, c int, value int, folder string").withColumnsRenamed({"value": "n", "folder": "name"})
    got = sorted((tuple(r) for r in names.ranked_index(files).select("dir", "t", "c", "n", "name").collect()), key=repr)
    assert got == sorted([("d", 0, 0, 1, "x"), ("d", 1, 0, 2, "y"), ("d", 1, 0, 2, "y"), ("e", 1, 0, 1, "x"), ("e", 0, 1, 1, "x"), (None, 0, 0, 1, "x")], key=repr)


def test_series_names(spark):
    named = ["a_C1_T002.tif", "A_b_C0_T1_C10_T0020.TIF", "_C1_T1.tif", "x_C1_T1.tiff", "x_GFP_T1.tif", "", None]
    got = {(r["name"], r["base"], r["c"], r["t"]) for r in names.parse_series(spark.createDataFrame([(n,) for n in named], "name string")).collect()}
    assert got == {("a_C1_T002.tif", "a", 1, 2), ("A_b_C0_T1_C10_T0020.TIF", "A_b_C0_T1", 10, 20), ("_C1_T1.tif", "", 1, 1)}


@pytest.mark.parametrize("tile", [1, 7, 64, 1000])
def test_box_join_equals_a_nested_loop(spark, tile):
    rng = np.random.default_rng(tile)

    def boxes(n, side):
        y, x = rng.integers(-60, 200, n), rng.integers(-60, 200, n)
        return [(int(k), str(rng.integers(3)), int(a), int(a + rng.integers(-1, side)), int(b), int(b + rng.integers(-1, side))) for k, a, b in zip(range(n), y, x)]

    left, right = boxes(120, 40), boxes(90, 90)
    a = spark.createDataFrame([*left, (999, "0", None, 3, 0, 3)], "i long, k string, a0 int, a1 int, b0 int, b1 int")
    b = spark.createDataFrame(right, "j long, k string, c0 int, c1 int, d0 int, d1 int")
    got = [(r["i"], r["j"]) for r in rois.box_join(a, b, ("a0", "a1", "b0", "b1"), ("c0", "c1", "d0", "d1"), ["k"], tile).select("i", "j").collect()]
    meets = lambda p, q: max(p[2], q[2]) < min(p[3], q[3]) and max(p[4], q[4]) < min(p[5], q[5])
    assert sorted(got) == sorted((p[0], q[0]) for p in left for q in right if p[1] == q[1] and meets(p, q)) and len(got) > 50


def test_crops_of_regions(spark):
    v = np.arange(2 * 9 * 11, dtype="<u2").reshape(2, 9, 11)
    rows = spark.createDataFrame([("a", t, 0, 0, 9, 11, "<u2", v[t].tobytes()) for t in range(2)], model.PLANES)
    regions = {1: (2, 5, 3, 8), 2: (-4, 3, 9, 99), 3: (9, 12, 0, 4), 4: (4, 4, 0, 4)}
    table = spark.createDataFrame([(k, *r) for k, r in regions.items()], "roi int, y0 int, y1 int, x0 int, x1 int")
    got = {(r["roi"], r["t"]): np.frombuffer(r["data"], r["dtype"]).reshape(r["h"], r["w"]) for r in rois.crops(rows, table, tile=4).collect()}
    assert set(got) == {(k, t) for k in (1, 2) for t in range(2)}
    most = {(r["roi"], r["t"]): (r["top"], r["n"]) for r in rois.region_maxima(rows, table, tile=4).collect()}
    assert most == {k: (float(g.max()), g.size) for k, g in got.items()}
    assert all((got[1, t] == v[t, 2:5, 3:8]).all() and (got[2, t] == v[t, 0:3, 9:]).all() for t in range(2))


@pytest.mark.parametrize("dtype", ["|u1", "<u2", ">u2", "<i2", "<i4", "<u4", "<f4", "<f8", "<i8"])
def test_sortable_numbers_keep_the_order(dtype):
    kind, rng = np.dtype(dtype), np.random.default_rng(6)
    if kind.kind == "f":
        v = np.concatenate([rng.standard_normal(50) * 10.0 ** rng.integers(-30, 30, 50), [0.0, -0.0, np.inf, -np.inf]]).astype(kind)
        assert planes.sortable(np.array([-np.nan, np.nan], kind)).max() == planes.sortable(np.array([np.nan], kind))[0] > planes.sortable(v).max()
    else:
        v = rng.integers(np.iinfo(kind).min, np.iinfo(kind).max, 50, dtype=kind.newbyteorder("=")).astype(kind)
    keys = planes.sortable(v)
    assert (np.argsort(keys, kind="stable") == np.argsort(v, kind="stable")).all()
    assert (planes.unsorted(keys.astype(np.uint64), dtype) == v.astype(float)).all()


@pytest.mark.parametrize("dtype", ["|u1", "<u2", "<i4", "<f4", "<f8"])
def test_percentiles_equal_numpy(spark, monkeypatch, dtype):
    rng = np.random.default_rng(8)
    shares, rows, want = {"a": 0.0, "b": 0.013, "m": 0.5, "d": 0.999, "e": 1.0}, [], {}
    for t, c in ((0, 0), (0, 1), (3, 0), (4, 2)):
        v = {0: rng.integers(0, 200, (5, 6, 7)), 1: rng.standard_normal((4, 6, 7)) * 90 + 100, 2: np.full((1, 1, 1), 42)}[c].astype(dtype)
        rows += [("s", t, z, c, *v.shape[1:], dtype, v[z].tobytes()) for z in range(len(v))]
        want[t, c] = [*np.quantile(v.astype(float), list(shares.values())), v.min(), v.max()]
    got = planes.percentiles(spark.createDataFrame(rows, model.PLANES).repartition(3), ["dataset", "t", "c"], shares)
    assert got.columns == ["dataset", "t", "c", *shares, "low", "high"]
    found = {(r["t"], r["c"]): list(r)[3:] for r in got.collect()}
    assert set(found) == set(want) and all(np.allclose(found[k], want[k], rtol=1e-12) for k in want)


def test_percentiles_of_nothing_and_of_mixed_types(spark):
    rows = spark.createDataFrame([("a", 0, 0, 0, 1, 1, "<u2", b"ab"), ("a", 1, 0, 0, 1, 1, "<i2", b"ab")], model.PLANES)
    assert planes.percentiles(rows.where("t > 5"), ["t"], {"m": 0.5}).count() == 0
    with pytest.raises(ValueError, match="no common order"):
        planes.percentiles(rows, ["t"], {"m": 0.5})
    assert rows.select(F.count("*")).first()[0] == 2


def test_redirects_are_followed_to_their_end(spark):
    rows = [("a", "legacy", "z"), ("a", "file", "b"), ("a", "file", "c"), ("b", "folder", "c"), ("c", "file", "d"), ("s", "file", "s"), ("p", "file", "q"), ("q", "file", "r"), ("r", "file", "q"), ("x", "other", "y"), ("n", "file", None), (None, "file", "n")]
    rows += [(f"k{i}", "folder", f"k{i + 1}") for i in range(37)]
    table = spark.createDataFrame(rows, "place string, kind string, target string")
    paths = spark.createDataFrame([(p,) for p in ("a", "c", "d", "s", "p", "r", "x", "n", "k0", "k0", "k36", "free")], "path string")
    got = {r["path"]: (r["place"], r["steps"], r["cyclic"]) for r in names.resolved(paths, table).collect()}
    cycle = (None, None, True)
    assert got == {"a": ("d", 3, False), "c": ("d", 1, False), "d": ("d", 0, False), "s": cycle, "p": cycle, "r": cycle, "x": ("x", 0, False), "n": ("n", 0, False), "k0": ("k37", 37, False), "k36": ("k37", 1, False), "free": ("free", 0, False)}
    assert names.resolved(paths, table.where("false")).where("steps = 0 and path = place").count() == 11


def _held() -> float:
    """Megabytes that this process holds now."""
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 2**20


@pytest.mark.parametrize("way", ["map_volumes", "voxels_of_volumes"])
def test_kernels_of_many_volumes_hold_one_at_a_time(spark, way):
    """300 stacks of one batch, of 2 bytes each, that a kernel makes 2 MB of: the pixels tell what the worker held."""
    rows = spark.range(0, 300, 1, 1).selectExpr("'a' as dataset", "int(id) as t", "0 as c", "1 as nz", "1 as ny", "1 as nx", "'<u2' as dtype", "unhex('0100') as data")
    kernel = lambda v: np.pad(np.full((1, 1, 1), _held()), ((0, 0), (0, 511), (0, 511)))
    if way == "map_volumes":
        found = [float(np.frombuffer(r["v"])[0]) for r in model.map_volumes(rows, kernel).selectExpr("substring(data, 1, 8) as v").collect()]
    else:
        found = [r["v"] for r in model.voxels_of_volumes(rows, kernel, above=0).collect()]
    assert len(found) == 300 and max(found) - found[0] < 200


def test_pages_of_a_file_read_whole_are_decoded_one_by_one(spark, tmp_path):
    """A small file of 300 pages of 1 MB each: no worker holds them all."""
    text = tiff.ome_text((1, 300, 1, 512, 1024), "a_0.ome.tif")
    (tmp_path / "a_0.ome.tif").write_bytes(tiff.encode(np.zeros((300, 512, 1024), "<u2"), text, deflate=True))
    most, over = [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            for p in filter(str.isdigit, os.listdir("/proc")):
                try:
                    with open(f"/proc/{p}/cmdline") as f, open(f"/proc/{p}/statm") as g:
                        most[0] = max(most[0], int(g.read().split()[1]) * 4096 >> 20 if "pyspark" in (x := f.read()) and "daemon" in x else 0)
                except OSError:
                    pass

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        found = tiff.read_ome_whole(spark, str(tmp_path)).selectExpr("z", "length(data) as n").collect()
    finally:
        over.set()
        thread.join()
    assert {(r["z"], r["n"]) for r in found} == {(z, 1 << 20) for z in range(300)} and 0 < most[0] < 400


def test_stacks_with_gaps_hold_one_at_a_time(spark):
    """200 stacks of 4 MB, nearly all of it planes that aren't there: a worker gets the planes there are, not Arrow batches of whole stacks."""
    rows = spark.range(0, 200, 1, 1).selectExpr("'a' as dataset", "int(id) as t", "511 as z", "0 as c", "64 as h", "64 as w", "'<u2' as dtype", "unhex(repeat('0100', 4096)) as data")
    kernel = lambda v: np.array([[[v.sum(dtype=float), _held()]]])
    found, base = ({(r["t"], r["x"]): r["v"] for r in model.voxels_of_stacks(some.coalesce(1), kernel).collect()} for some in (rows, rows.where("t = 7")))
    assert {t for t, x in found} == set(range(200)) and {found[t, 0] for t in range(200)} == {4096.0}
    assert max(found[t, 1] for t in range(200)) - base[7, 1] < 40


def test_voxels_of_stacks_equal_numpy(spark):
    """Stacks of several images and sizes, gaps in z, planes smaller than others, rows in any order."""
    rng, rows, want = np.random.default_rng(4), [], {}
    for k in range(60):
        key = (f"d{k % 3}", k % 7, k // 21)
        whole = np.zeros((9, 5, 6), "<u2")
        for z in (zs := sorted(rng.choice(9, 4, replace=False))):
            v = rng.integers(1, 60000, (5, 6) if z == zs[0] else rng.integers(1, [6, 7])).astype("<u2")
            whole[z, : v.shape[0], : v.shape[1]] = v
            rows.append((key[0], key[1], int(z), key[2], *v.shape, "<u2", v.tobytes()))
        v = whole[: zs[-1] + 1][::-1].astype(float) + 1
        want |= {(*key, *at): x for at, x in np.ndenumerate(v)}
    assert len({r[:2] + r[3:4] for r in rows}) == 60
    table = spark.createDataFrame([rows[k] for k in rng.permutation(len(rows))], model.PLANES).repartition(5)
    made = lambda v: v[::-1].astype(float) + 1
    for found in (model.voxels_of_stacks(table, made), model.voxels(model.planes_of_volumes(model.volumes(table, kernel=made))), model.voxels_of_volumes(model.volumes(table), made)):
        got = {(r["dataset"], r["t"], r["c"], r["z"], r["y"], r["x"]): r["v"] for r in found.collect()}
        assert got == want
    some = model.voxels_of_stacks(table, made, above=30000, where="t > 3").collect()
    assert {(r["dataset"], r["t"], r["c"], r["z"], r["y"], r["x"]): r["v"] for r in some} == {k: x for k, x in want.items() if k[1] > 3 and x > 30000}
