"""Voxel and plane operators against numpy on arrays whose values tell every place apart."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxelloom import model
from voxelloom.operators import measures as M
from voxelloom.operators import rois as R
from voxelloom.operators import voxels as V
from voxelloom.operators.planes import project
from voxelloom.pipeline import crop_planes

T, Z, C, Y, X = 3, 4, 4, 16, 12
ARRAY = (1000 * np.arange(T)[:, None, None, None, None] + 200 * np.arange(Z)[:, None, None, None] + 37 * np.arange(C)[:, None, None] + 5 * np.arange(Y)[:, None] + np.arange(X)).astype("<u2")


@pytest.fixture(scope="module")
def planes(spark):
    rows = [("a", t, z, c, Y, X, "<u2", ARRAY[t, z, c].tobytes()) for t in range(T) for z in range(Z) for c in range(C)]
    return spark.createDataFrame(rows, model.PLANES).cache()


@pytest.fixture(scope="module")
def vox(planes):
    return model.voxels(planes).cache()


def array_of(rows, *axes):
    values = [(tuple(r[a] for a in axes), r["v"]) for r in rows.collect()]
    assert len({k for k, _ in values}) == len(values)
    out = np.zeros([max(k[i] for k, _ in values) + 1 for i in range(len(axes))])
    for k, v in values:
        out[k] = v
    return out


AXES = ("t", "z", "c", "y", "x")


def test_planes_voxels_volumes_round_trip(planes, vox):
    assert (array_of(vox, *AXES) == ARRAY).all()
    assert (array_of(model.voxels(model.planes_of_voxels(vox)), *AXES) == ARRAY).all()
    assert (array_of(model.voxels(model.planes_of_volumes(model.volumes(planes))), *AXES) == ARRAY).all()


def test_crop_and_turn_equal_numpy(vox):
    got = V.rot90(V.crop(vox, V.Roi(2, 9, 1, 11)), 10)
    assert (array_of(got, *AXES) == np.rot90(ARRAY[..., 2:9, 1:11], axes=(3, 4))).all()
    assert (array_of(V.rot90(V.rot90(V.rot90(V.rot90(vox, X), Y), X), Y), *AXES) == ARRAY).all()


TOP, BOTTOM = V.Roi(0, 5, 1, 9), V.Roi(8, 13, 2, 10)


def expected(layout):
    out = np.zeros((T, Z, 2 * C, 5, 8))
    for exc in range(C // 2):
        cams = (exc, exc + C // 2) if layout == "blocked" else (2 * exc, 2 * exc + 1)
        for k, (cam, r) in enumerate(((0, BOTTOM), (0, TOP), (1, TOP), (1, BOTTOM))):
            out[:, :, 4 * exc + k] = ARRAY[:, :, cams[cam], r.y0 : r.y1, r.x0 : r.x1]
    return out


@pytest.mark.parametrize("layout", ["blocked", "interleaved"])
def test_demux_of_voxels_and_planes(vox, planes, layout):
    want = expected(layout)
    assert (array_of(V.demux(vox, C, TOP, BOTTOM, layout), *AXES) == want).all()
    got = model.voxels(crop_planes(planes, C, TOP, BOTTOM, layout, rotate=True))
    assert (array_of(got, *AXES) == np.rot90(want, axes=(3, 4))).all()
    some = model.voxels(crop_planes(planes, C, TOP, None, layout, wanted=[2, 1], rotate=False))
    assert (array_of(some, *AXES) == want[:, :, [2, 1]]).all()


def test_demux_refuses(vox, planes):
    with pytest.raises(ValueError):
        V.demux(vox, 3, TOP, BOTTOM, "blocked")
    with pytest.raises(ValueError):
        V.demux(vox, 4, TOP, V.Roi(0, 4, 0, 8), "blocked")
    with pytest.raises(ValueError):
        V.demux(vox, 4, TOP, BOTTOM, "other")
    with pytest.raises(ValueError):
        crop_planes(planes, C, None, BOTTOM, "blocked")
    assert V.needed_regions([0, 7]) == {"top": False, "bottom": True}


def test_axes_boxes_flips(vox):
    assert (array_of(V.permute(vox, "yxz"), *AXES) == ARRAY.transpose(0, 3, 2, 4, 1)).all()
    with pytest.raises(ValueError):
        V.permute(vox, "yyz")
    assert (array_of(V.bounding_box(vox, (2, 3, 1, 6, 8, 3)), *AXES) == ARRAY[:, 0:3, :, 1:6, 2:8]).all()
    assert (array_of(V.flip_z(vox, Z), *AXES) == ARRAY[:, ::-1]).all()
    assert (array_of(V.decimate_z(vox, 2), *AXES) == ARRAY[:, 0::2]).all()
    assert (array_of(V.select_channels(vox, [3, 1]), *AXES) == ARRAY[:, :, [3, 1]]).all()
    assert V.select_timepoints(vox, []).count() == ARRAY.size and V.select_timepoints(vox, [3]).agg(F.min("t")).first()[0] == 2
    oriented = array_of(V.orient_for_dsr(vox, X).where("t = 1 and c = 2"), "y", "x", "z")
    assert (oriented == np.rot90(ARRAY[1, :, 2].transpose(1, 2, 0), axes=(0, 1))).all() or (oriented == ARRAY[1, :, 2, :, ::-1].transpose(2, 1, 0)).all()


@settings(max_examples=60, deadline=None)
@given(h=st.integers(1, 30), w=st.integers(1, 30), k=st.integers(-5, 9), data=st.data())
def test_point_transforms_are_inverse(spark, h, w, k, data):
    y, x = data.draw(st.integers(0, h - 1)), data.draw(st.integers(0, w - 1))
    image = np.zeros((h, w))
    image[y, x] = 1
    want = tuple(int(a[0]) for a in np.nonzero(np.rot90(image, k)))
    row = spark.range(1).select(V.to_display(F.lit(y), F.lit(x), F.lit(h), F.lit(w), F.lit(k)).alias("d"))
    row = row.select("d", V.to_data(F.col("d.y"), F.col("d.x"), F.lit(h), F.lit(w), F.lit(k)).alias("b")).first()
    assert tuple(row["d"]) == want and tuple(row["b"]) == (y, x)


def test_projection_in_two_steps(planes, vox):
    got = model.voxels(project(planes.repartition(5), ["dataset", "t"]))
    assert (array_of(got, "t", "y", "x") == ARRAY.max(axis=(1, 2))).all()
    assert (array_of(M.mip(vox, ["t", "c", "z", "x"]), "t", "c", "z", "x") == ARRAY.max(axis=3).transpose(0, 2, 1, 3)).all()


def test_contrast_limits(spark, vox):
    for r in M.contrast(vox, ["t", "c"]).collect():
        stack = ARRAY[r["t"], :, r["c"]]
        assert np.allclose((r["vmin"], r["vmax"]), np.percentile(stack, (1, 99.9)))
    flat = spark.createDataFrame([(0, 0.0), (0, 0.0), (1, 7.0), (1, 7.0)], "k int, v double")
    assert {r["k"]: (r["vmin"], r["vmax"]) for r in M.contrast(flat, ["k"]).collect()} == {0: (0.0, 1.0), 1: (7.0, 7.0)}


def test_measures(spark, vox):
    for r in M.argmax(vox, ["t", "c"]).collect():
        stack = ARRAY[r["t"], :, r["c"]]
        assert (r["z"], r["y"], r["x"]) == np.unravel_index(stack.argmax(), stack.shape)
    for r in M.centroid(vox, ["t", "c"], ["z", "y", "x"], F.col("v")).collect():
        stack = ARRAY[r["t"], :, r["c"]].astype(float)
        assert np.allclose([r["cz"], r["cy"], r["cx"]], [(stack * a).sum() / stack.sum() for a in np.indices(stack.shape)])
    shares = M.normalised(vox, ["t", "c"]).groupBy("t", "c").agg(F.sum("v").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in shares)
    profile = spark.createDataFrame([(0, k, float(v)) for k, v in enumerate([0, 1, 5, 10, 6, 4, 0])] + [(1, 0, 3.0)], "k int, x int, v double")
    assert {r["k"]: r["fwhm"] for r in M.fwhm(profile, ["k"], "x").collect()} == {0: 2, 1: 0}


def test_rois_round_trip_and_snap(spark):
    log = spark.createDataFrame([('{"a.ome.tif": {"top_roi": [2, 6, 1, 7], "bottom_roi": [8, 12, 1, 7]}, "b": {"top_roi": null, "bottom_roi": [1, 2, 3, 4]}}',), ("not json",)], "value string")
    rows = R.read_log(log)
    got = {r["file_name"]: r for r in rows.collect()}
    assert set(got) == {"a.ome.tif", "b"} and tuple(got["a.ome.tif"]["top"]) == (2, 6, 1, 7) and got["b"]["top"] is None
    assert sorted(map(str, R.read_log(R.write_log(rows)).collect())) == sorted(map(str, got.values()))
    drawn = spark.sql("select named_struct('y0', 0, 'y1', 10, 'x0', 0, 'x1', 20) a, named_struct('y0', 40, 'y1', 60, 'x0', 10, 'x1', 20) b, named_struct('y0', 0, 'y1', 3, 'x0', 0, 'x1', 20) c")
    r = drawn.select(R.snapped(F.col("a"), F.col("b")).alias("s"), R.snapped(F.col("a"), F.col("c")).alias("n")).first()
    assert tuple(r["s"]) == (45, 55, 5, 25) and r["n"] is None


def test_empty_tables(vox, planes):
    none = vox.limit(0)
    for df in (V.demux(none, C, TOP, BOTTOM, "blocked"), M.contrast(none, ["t"]), M.argmax(none, ["t"]), M.otsu(none, ["t"]), M.bead_slope(none, ["t"]), project(planes.limit(0), ["dataset", "t"]), model.volumes(planes.limit(0))):
        assert df.count() == 0


def test_crop_plan_has_no_shuffle_and_prunes(spark):
    from tests.conftest import SMALL
    from voxelloom.plans.images import QUERIES

    plan = QUERIES["crop_rot90"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" not in plan
