"""Numeric kernels against independent numpy or known answers."""

import numpy as np
from pyspark.sql import functions as F

from voxelloom.functions import kernels as K
from voxelloom.model import VOLUMES, pixels
from voxelloom.operators import measures as M
from voxelloom.operators.psf import average_beads, synthetic_psf

RNG = np.random.default_rng(8)


def bead(shape, centre, width=1.3, height=1000.0):
    return height * np.exp(-0.5 * sum((a - c) ** 2 for a, c in zip(np.indices(shape), centre)) / width**2)


def test_gaussian_keeps_constants_and_mass():
    assert np.allclose(K.gaussian(np.full((3, 4, 5), 7.0)), 7)
    v = np.zeros((21, 21))
    v[10, 10] = 1
    out = K.gaussian(v)
    assert np.isclose(out.sum(), 1) and np.isclose(out[10, 10], (1 / np.exp(-0.5 * np.arange(-4, 5) ** 2.0).sum()) ** 2)


def test_label_equals_flood_fill():
    for _ in range(20):
        mask = RNG.random((5, 6, 4)) > 0.6
        got, n = K.label(mask)
        seen, k = np.zeros(mask.shape, int), 0
        for start in zip(*np.nonzero(mask)):
            if not seen[start]:
                k += 1
                todo = [start]
                while todo:
                    p = todo.pop()
                    if all(0 <= a < s for a, s in zip(p, mask.shape)) and mask[p] and not seen[p]:
                        seen[p] = k
                        todo += [tuple(a + d * (i == j) for j, a in enumerate(p)) for i in range(3) for d in (1, -1)]
        assert n == k and (got == seen).all()


def test_otsu_equals_the_relational_one(spark):
    v = np.concatenate([RNG.normal(10, 2, 500), RNG.normal(40, 3, 300)])
    table = spark.createDataFrame([(0, float(x)) for x in v], "k int, v double")
    assert np.isclose(M.otsu(table, ["k"]).first()["threshold"], K.otsu(v))
    assert 15 < K.otsu(v) < 35


def test_dilate_and_masks():
    m = np.zeros((5, 5), bool)
    m[2, 2] = True
    assert K.dilate(m).sum() == 5 and K.dilate(m, 2).sum() == 13
    v = bead((15, 15, 15), (7, 7, 7)) + 10
    assert K.auto_mask(v)[7, 7, 7] and not K.auto_mask(v)[0, 0, 0]
    cylinder = K.cylinder_mask(v, 7, 7, 3)
    assert cylinder[7, 7, 7] and not cylinder[:, 0, 0].any()
    square = K.polygon_mask([(1, 1), (1, 4), (4, 4), (4, 1)], (6, 6))
    assert square.sum() == 9 and square[2, 2] and not square[0, 0]


def test_isolation_keeps_the_central_bead():
    v = bead((15, 15, 15), (7, 7, 7)) + bead((15, 15, 15), (1, 1, 1), height=3000)
    out = K.isolate_bead(v)
    assert np.isclose(out[7, 7, 7], v[7, 7, 7]) and out[1, 1, 1] < 10
    alone = bead((9, 9, 9), (4, 4, 4))
    assert (K.isolate_bead(alone) == alone).all()
    crop = K.extract_bead(v, (6, 6, 6), (3, 3, 3))
    assert crop.shape == (7, 7, 7) and crop.argmax() == 171
    assert K.extract_bead(v, (1, 1, 1), (3, 3, 3)) is None


def test_spline_shift():
    v = RNG.random((6, 7, 8))
    whole = K.shift(v, (1, 0, -2))
    assert np.allclose(whole[1:, :, :-2], v[:-1, :, 2:]) and np.allclose(whole[0], 0)
    smooth = bead((21, 21, 21), (10, 10, 10), 2.0)
    assert np.allclose(K.shift(smooth, (0.4, -0.3, 0.7))[3:-3, 3:-3, 3:-3], bead((21, 21, 21), (10.4, 9.7, 10.7), 2.0)[3:-3, 3:-3, 3:-3], atol=2)


def test_gaussian_fwhm():
    x = np.arange(31)
    for width in (1.5, 3.0, 5.0):
        assert np.isclose(K.gaussian_fwhm(50 * np.exp(-0.5 * ((x - 14.3) / width) ** 2) + 4), 2.355 * width, rtol=1e-4)
    assert K.gaussian_fwhm(np.ones(9)) == 0 and K.gaussian_fwhm(np.array([1.0, 2.0])) == 0


def test_deconvolution():
    image = RNG.random((8, 8, 8)) * 100 + 1
    delta = np.zeros((3, 3, 3))
    delta[1, 1, 1] = 5
    assert np.allclose(K.richardson_lucy(image, delta, 6), image)
    psf = bead((5, 5, 5), (2, 2, 2), 1.0)
    sharp = np.zeros((16, 16, 16))
    sharp[8, 8, 8], sharp[3, 9, 5] = 1000, 500
    h = K.otf(psf / psf.sum(), sharp.shape)
    blurred = np.maximum(np.fft.ifftn(h * np.fft.fftn(sharp)).real, 0)
    errors = []
    out = K.richardson_lucy(blurred, psf, 15, errors=errors)
    assert np.isclose(out.sum(), blurred.sum(), rtol=1e-6) and ((out - sharp) ** 2).sum() < ((blurred - sharp) ** 2).sum() / 2
    assert [e[0] for e in errors] == list(range(1, 16)) and errors[0][2] == 1
    assert (K.richardson_lucy(blurred, psf, 5, damp=2.0) <= 2 * blurred + 1e-9).all()
    edged = K.richardson_lucy(image, delta, 2, scale=2.0, offset=1.0, erosion=2)
    assert (edged[:2] == 0).all() and np.allclose(edged[2:-2, 2:-2, 2:-2], 2 * image[2:-2, 2:-2, 2:-2] + 1)


def test_deskew_geometry():
    v = np.zeros((40, 3, 30))
    out = K.deskew_rotate(v, 60.0, 1.2)
    s, c = np.sin(np.pi / 3), 0.5
    assert out.shape == (int(29 * s - 4 + 0.5), 3, int(29 * c + 39 * 1.2 / s + 0.5))
    # a point at (z, x) stands at height x sin - 2 and across x cos + z aniso / sin
    v[20, 1, 16] = 1
    row, y, col = np.unravel_index(K.deskew_rotate(v, 60.0, 1.2).argmax(), out.shape)
    assert y == 1 and abs(row - (16 * s - 2)) <= 1 and abs(col - (16 * c + 20 * 1.2 / s)) <= 1
    assert np.allclose(K.deskew_rotate(v, 60.0, 1.2, reverse=True), K.deskew_rotate(v[::-1], 60.0, 1.2))
    big = K.deskew_rotate(v, 45.0, 1.0, objective=True)
    assert big.shape[1] == 3 and big.max() > 0.2
    wide = RNG.random((6, 3 * K.Y_BLOCK + 5, 7))
    assert np.allclose(K.deskew_rotate(wide, 50.0, 1.1)[:, 130:140], K.deskew_rotate(wide[:, 130:140], 50.0, 1.1))


def test_resample_z_keeps_the_middle():
    psf = bead((21, 5, 5), (10, 2, 2), 2.0)
    out = K.resample_z(psf, 0.1, 0.2)
    assert len(out) == 11 and np.isclose(out[5, 2, 2], psf[10, 2, 2])
    assert np.allclose(K.resample_z(psf, 0.1, 0.1), psf)


def test_registration():
    y, x = np.indices((40, 40))
    image = lambda cy, cx, w=3: np.exp(-0.5 * (((y - cy) / w) ** 2 + ((x - cx) / w) ** 2))
    dy, dx = K.register(image(20, 20), image(17.7, 22.4))
    assert abs(dy - 2.3) < 0.11 and abs(dx + 2.4) < 0.11
    both = np.zeros((80, 40))
    both[:40], both[40:] = image(20, 20, 1), image(22, 17, 1)
    roi, dy, dx = K.align_rois(both, (0, 30, 5, 35), (40, 70, 5, 35))
    assert roi == (42, 72, 2, 32)
    assert K.align_rois(both, (0, 30, 5, 35), (40, 69, 5, 35))[0] == (40, 69, 5, 35)
    assert K.align_rois(both, (0, 30, 5, 35), (40, 70, 5, 35), most=1.0)[0] == (40, 70, 5, 35)


def test_bead_averaging(spark):
    rows = []
    for k, centre in enumerate([(4.2, 5.1, 4.8), (5.3, 4.6, 5.2), (4.9, 5.0, 4.4)]):
        v = (bead((10, 10, 10), centre) + RNG.normal(100, 1, (10, 10, 10))).astype("<f4")
        rows.append(("d", k, 0, 10, 10, 10, "<f4", v.tobytes()))
    rows.append(("d", 9, 0, 8, 9, 10, "<f4", np.zeros((8, 9, 10), "<f4").tobytes()))
    beads = spark.createDataFrame(rows, VOLUMES)
    for mode in ("library", "notebook"):
        r = average_beads(beads, mode=mode).collect()
        assert len(r) == 1
        v = pixels(r[0]["data"], r[0]["dtype"], r[0]["nz"], r[0]["ny"], r[0]["nx"])
        assert v.shape == (11, 11, 11) and np.isclose(v.max(), 1) and v.min() >= 0
        centre = [(v**4 * a).sum() / (v**4).sum() for a in np.indices(v.shape)]
        assert np.allclose(centre, 5.5, atol=0.3)


def test_synthetic_psf(spark):
    rows = synthetic_psf(spark, 525.0, 21).collect()
    v = np.zeros((21, 21, 21))
    for r in rows:
        v[r["z"], r["y"], r["x"]] = r["v"]
    z, y, x = ((a - 10) * 0.1 for a in np.indices(v.shape))
    want = np.exp(-0.5 * ((z / 0.11) ** 2 + ((y - z * np.tan(np.radians(-30))) / 0.29) ** 2 + (x / 0.21) ** 2))
    assert np.allclose(v, want) and v.max() == 1


def test_tukey_column(spark):
    got = [r["w"] for r in spark.range(9).select(M.tukey(F.col("id"), F.lit(9), 0.5).alias("w")).collect()]
    assert np.allclose(got, K.tukey(9, 0.5)) and got[0] == 0 and got[4] == 1
