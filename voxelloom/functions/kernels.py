"""Numeric kernels on one plane or volume, on numpy alone; Spark maps them over rows."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Planes y that deskewing turns at a time.
Y_BLOCK = 64


def gaussian(v: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Separable Gaussian filter, four sigmas wide, mirrored at the edges."""
    r = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    w /= w.sum()
    out = v.astype(np.float64)
    for axis, n in enumerate(v.shape):
        period = np.arange(-r, n + r) % (2 * n)
        at = np.where(period < n, period, 2 * n - 1 - period)
        padded = np.take(out, at, axis)
        out = sum(w[k] * np.take(padded, np.arange(k, k + n), axis) for k in range(2 * r + 1))
    return out


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """Binary dilation by face neighbours."""
    out = mask.copy()
    for _ in range(times):
        grown = out.copy()
        for axis in range(mask.ndim):
            front, back = ([slice(None)] * mask.ndim for _ in range(2))
            front[axis], back[axis] = slice(1, None), slice(None, -1)
            grown[tuple(front)] |= out[tuple(back)]
            grown[tuple(back)] |= out[tuple(front)]
        out = grown
    return out


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Connected components by face neighbours, numbered from 1 in C order of their first voxel."""
    ids = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        low = ids.copy()
        for axis in range(mask.ndim):
            front, back = ([slice(None)] * mask.ndim for _ in range(2))
            front[axis], back[axis] = slice(1, None), slice(None, -1)
            for a, b in ((tuple(front), tuple(back)), (tuple(back), tuple(front))):
                low[a] = np.where(mask[a] & mask[b], np.minimum(low[a], ids[b]), low[a])
        flat = np.concatenate([[0], low.ravel()])
        low = flat[low]  # a voxel takes the label of the voxel that its label names
        if (low == ids).all():
            break
        ids = low
    values = np.unique(ids[ids > 0])
    return np.searchsorted(values, ids) * (ids > 0) + (ids > 0), len(values)


def otsu(v: np.ndarray, bins: int = 256) -> float:
    """Otsu's threshold (1979): the bin centre that best separates two classes."""
    counts, edges = np.histogram(v, bins)
    centres = (edges[:-1] + edges[1:]) / 2
    below, moment = np.cumsum(counts), np.cumsum(counts * centres)
    above = below[-1] - below
    ok = (below > 0) & (above > 0)
    between = np.full(bins, -1.0)
    between[ok] = below[ok] * above[ok] * (moment[ok] / below[ok] - (moment[-1] - moment[ok]) / above[ok]) ** 2
    return float(centres[between.argmax()])


def auto_mask(v: np.ndarray, sensitivity: float = 1.0) -> np.ndarray:
    """Voxels of a smoothed bead above Otsu's threshold over the sensitivity, dilated twice; a flat volume takes its 90th percentile."""
    smooth = gaussian(v)
    level = otsu(smooth) if smooth.min() < smooth.max() else np.percentile(smooth, 90)
    return dilate(smooth > level / sensitivity, 2)


def cylinder_mask(v: np.ndarray, y: float, x: float, radius: float, sensitivity: float = 1.0) -> np.ndarray:
    """Bright voxels in a cylinder along z around a point: above Otsu's threshold of the cylinder over the sensitivity, dilated once."""
    yy, xx = np.indices(v.shape[1:])
    inside = np.broadcast_to((yy - y) ** 2 + (xx - x) ** 2 <= radius**2, v.shape)
    smooth = gaussian(v)
    return inside & dilate(inside & (smooth > otsu(smooth[inside]) / sensitivity)) if inside.any() else inside.copy()


def polygon_mask(points: list[tuple[float, float]], shape: tuple[int, int]) -> np.ndarray:
    """Pixels whose (y, x) lies in a polygon, by the even-odd rule."""
    yy, xx = np.indices(shape)
    out = np.zeros(shape, bool)
    for (y0, x0), (y1, x1) in zip(points, [*points[1:], points[0]]):
        if y0 != y1:
            crosses = (y0 > yy) != (y1 > yy)
            out ^= crosses & (xx < (x1 - x0) * (yy - y0) / (y1 - y0) + x0)
    return out


def isolate_bead(v: np.ndarray) -> np.ndarray:
    """The volume with every bright core but the one nearest the centre filled with the median."""
    cores, n = label(v > np.percentile(v, 95))
    if n < 2:
        return v
    centre = np.array(v.shape) / 2
    away = []
    for k in range(1, n + 1):
        at = np.nonzero(cores == k)
        w = v[at].astype(float)
        away.append(sum((c - (w * a).sum() / w.sum()) ** 2 for c, a in zip(centre, at)) if w.sum() else np.inf)
    others = dilate((cores > 0) & (cores != 1 + int(np.argmin(away))), 3)
    return np.where(others, np.median(v), v).astype(v.dtype)


def extract_bead(v: np.ndarray, point: tuple[int, int, int], half: tuple[int, int, int], isolate: bool = True) -> np.ndarray | None:
    """A crop around the brightest voxel near a point; None if it would leave the volume."""
    low = [max(0, p - h) for p, h in zip(point, half)]
    near = v[tuple(slice(a, p + h + 1) for a, p, h in zip(low, point, half))]
    peak = [a + int(k) for a, k in zip(low, np.unravel_index(near.argmax(), near.shape))]
    if any(p - h < 0 or p + h + 1 > n for p, h, n in zip(peak, half, v.shape)):
        return None
    crop = v[tuple(slice(p - h, p + h + 1) for p, h in zip(peak, half))]
    return isolate_bead(crop) if isolate else crop


def tukey(n: int, alpha: float) -> np.ndarray:
    at, edge = np.arange(n), alpha * (n - 1) / 2
    near = np.minimum(at, n - 1 - at)
    return np.where((near < edge) & (n > 1), 0.5 * (1 - np.cos(np.pi * near / max(edge, 1e-300))), 1.0) if edge > 0 else np.ones(n)


def taper(v: np.ndarray, alpha: float) -> np.ndarray:
    for axis, n in enumerate(v.shape):
        v = v * tukey(n, alpha).reshape([-1 if k == axis else 1 for k in range(v.ndim)])
    return v


def _spline_coefficients(v: np.ndarray, axis: int) -> np.ndarray:
    """Cubic B-spline coefficients of samples mirrored at the end points: the tridiagonal interpolation system, solved along an axis."""
    v = np.moveaxis(v, axis, 0).astype(np.float64)
    n = len(v)
    if n == 1:
        return np.moveaxis(v, 0, axis)
    upper, d = np.zeros(n), np.empty_like(v)
    upper[0], d[0] = 2 / 4, 6 * v[0] / 4
    for k in range(1, n):
        low, high = (2, 0) if k == n - 1 else (1, 1)
        pivot = 4 - low * upper[k - 1]
        upper[k], d[k] = high / pivot, (6 * v[k] - low * d[k - 1]) / pivot
    for k in range(n - 2, -1, -1):
        d[k] -= upper[k] * d[k + 1]
    return np.moveaxis(d, 0, axis)


def shift(v: np.ndarray, by: tuple[float, ...]) -> np.ndarray:
    """Move by fractions of voxels, cubic spline interpolated; what comes from outside is 0."""
    out = v.astype(np.float64)
    for axis, s in enumerate(by):
        if s == 0:
            continue
        n = out.shape[axis]
        c = _spline_coefficients(out, axis)
        x = np.arange(n) - s
        base = np.floor(x).astype(int)
        f = x - base
        weights = ((1 - f) ** 3 / 6, (3 * f**3 - 6 * f**2 + 4) / 6, (-3 * f**3 + 3 * f**2 + 3 * f + 1) / 6, f**3 / 6)
        shape = [-1 if k == axis else 1 for k in range(v.ndim)]
        period = max(2 * (n - 1), 1)
        moved = 0
        for k, w in enumerate(weights):
            at = np.abs(base - 1 + k) % period
            at = np.where(at > n - 1, period - at, at)
            moved = moved + np.take(c, at, axis) * w.reshape(shape)
        out = moved * ((x >= 0) & (x <= n - 1)).reshape(shape)
    return out


def aligned_bead(v: np.ndarray, mask: np.ndarray | None, canvas: tuple[int, int, int], alpha: float, strict: bool = True, mode: str = "library") -> np.ndarray | None:
    """A bead without background, tapered and centred on the canvas; None without signal."""
    v = v.astype(np.float64)
    mask = auto_mask(v) if mask is None else mask
    outside = v[~mask]
    if mode == "notebook":
        clean = np.clip(v - (np.median(outside) if outside.size else np.percentile(v, 5)), 0, None)
    else:
        clean = v - (outside.mean() if outside.size else 0.0)
    if strict:
        clean = np.where(mask, clean, 0.0)
    weight = np.clip(clean, 0, None) ** (1 if mode == "notebook" else 4)
    if not weight.sum() > 0:
        return None
    centre = [(weight * a).sum() / weight.sum() for a in np.indices(v.shape)]
    if mode == "notebook":
        clean = clean / clean.max()
    elif alpha > 0:
        clean = taper(clean, alpha)
    start = [(n - s) // 2 for n, s in zip(canvas, v.shape)]
    out = np.zeros(canvas)
    out[tuple(slice(a, a + s) for a, s in zip(start, v.shape))] = clean
    return shift(out, tuple(n / 2 - (c + a) for n, c, a in zip(canvas, centre, start)))


def finished_psf(v: np.ndarray, alpha: float) -> np.ndarray:
    v = np.clip(v, 0, None)
    v = taper(v, alpha) if alpha > 0 else v
    return v / v.max() if v.max() > 0 else v


def gaussian_fwhm(profile: np.ndarray, steps: int = 100) -> float:
    """2.355 times the fitted width of a Gaussian on an offset, by damped Gauss-Newton; 0 if the fit fails."""
    y = np.asarray(profile, float)
    x = np.arange(len(y))
    if len(y) < 4 or not np.isfinite(y).all() or y.max() == y.min():
        return 0.0
    wide = (y >= (y.max() + y.min()) / 2).sum() / 2.355
    p, damping = np.array([y.max() - y.min(), float(y.argmax()), max(wide, 0.5), y.min()]), 1e-3

    def model(q):
        e = np.exp(-((x - q[1]) ** 2) / (2 * q[2] ** 2))
        return q[0] * e + q[3], np.stack([e, q[0] * e * (x - q[1]) / q[2] ** 2, q[0] * e * (x - q[1]) ** 2 / q[2] ** 3, np.ones_like(y)], axis=1)

    with np.errstate(all="ignore"):
        for _ in range(steps):
            fit, j = model(p)
            normal = j.T @ j
            try:
                step = np.linalg.solve(normal + damping * np.diag(np.diag(normal) + 1e-12), j.T @ (y - fit))
            except np.linalg.LinAlgError:
                return 0.0
            new = model(p + step)[0]
            if np.isfinite(new).all() and ((y - new) ** 2).sum() <= ((y - fit) ** 2).sum():
                p, damping = p + step, damping / 3
                if np.abs(step).max() < 1e-10:
                    break
            else:
                damping *= 4
    return float(2.355 * abs(p[2])) if np.isfinite(p).all() else 0.0


def otf(psf: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Transfer function: the PSF's middle moves to the origin of a volume of the given shape."""
    out = np.zeros(shape)
    cut = psf[tuple(slice(max(0, (p - n) // 2), max(0, (p - n) // 2) + min(p, n)) for p, n in zip(psf.shape, shape))]
    out[tuple(slice(0, n) for n in cut.shape)] = cut
    return np.fft.fftn(np.roll(out, [-(n // 2) for n in cut.shape], range(out.ndim)))


@lru_cache(maxsize=4)
def _known_otf(raw: bytes, psf_shape: tuple[int, ...], shape: tuple[int, ...]) -> np.ndarray:
    return otf(np.frombuffer(raw).reshape(psf_shape), shape)


def cached_otf(psf: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The transfer function of a PSF normalised to sum 1; a worker keeps the last few."""
    return _known_otf((psf / psf.sum()).astype(float).tobytes(), psf.shape, shape)


def without_edge(shape: tuple[int, ...], width: int) -> np.ndarray:
    """True but for the outermost `width` voxels of every axis."""
    out = np.zeros(shape, bool)
    out[tuple(slice(width, max(width, n - width)) for n in shape)] = True
    return out


def richardson_lucy(
    image: np.ndarray, psf: np.ndarray, iterations: int, background: float = 0.0, errors: list | None = None, damp: float = 0.0, scale: float = 1.0, offset: float = 0.0, erosion: int = 0
) -> np.ndarray:
    """Richardson-Lucy deconvolution with vector acceleration (Biggs and Andrews, 1997).

    Each step first predicts along the last change, by how alike the last two steps' corrections were.
    `errors` collects (iteration, mean squared difference from the image, that over the first). The PSF is
    normalised to sum 1; damp over 1 caps the result at that multiple of the image; erosion sets that many edge voxels to 0.
    """
    image = np.maximum(image.astype(np.float64) - background, 0)
    h, tiny = cached_otf(psf, image.shape), np.finfo(float).eps
    now, last, correction = image.copy(), np.zeros_like(image), None
    predicted, pull = image, 0.0
    for k in range(1, iterations + 1):
        if k >= 2:
            new = now - predicted
            if k > 2:
                pull = float(np.clip((new * correction).sum() / ((correction**2).sum() + tiny), 0, 1))
            correction = new
        predicted = np.maximum(now + pull * (now - last), 0)
        ratio = image / np.maximum(np.fft.ifftn(h * np.fft.fftn(predicted)).real, tiny)
        last, now = now, np.maximum(predicted * np.fft.ifftn(h.conj() * np.fft.fftn(ratio)).real, 0)
        if errors is not None:
            mse = float(((now - image) ** 2).mean())
            errors.append((k, mse, mse / errors[0][1] if errors and errors[0][1] else 1.0))
    if damp > 1:
        now = np.minimum(now, damp * image)
    now = now * scale + offset
    return np.where(without_edge(now.shape, erosion), now, 0.0) if erosion else now


def deskew_rotate(v: np.ndarray, angle: float, aniso: float, reverse: bool = False, objective: bool = False, resample: tuple[float, float, float] = (1, 1, 1)) -> np.ndarray:
    """Shear a (z, y, x) stack by the sheet angle and turn it level: one inverse map, linearly interpolated, 0 outside.

    A camera row x of slice z stands at the horizontal place x cos + z aniso / sin (a stage scan) and height x sin.
    Planes y are independent of each other, so blocks of them are turned one after another.
    """
    nz, ny, nx = v.shape
    s, c = np.sin(np.radians(angle)), np.cos(np.radians(angle))
    if objective:
        across, height = nx * c + nz * aniso * s, nz * aniso * c + nx * s
    else:
        across, height = (nx - 1) * c + (nz - 1) * aniso / s, (nx - 1) * s - 4
    size = [max(1, int(np.floor(d / f + 0.5))) for d, f in zip((height, across), (resample[2], resample[1]))]
    row, col = np.meshgrid(np.arange(size[0]) * resample[2], np.arange(size[1]) * resample[1], indexing="ij")
    if objective:
        hz, hx = row - (height - 1) / 2, col - (across - 1) / 2
        x = hx * c + hz * s + (nx - 1) / 2
        z = (-hx * s + hz * c) / aniso + (nz - 1) / 2
    else:
        x = (row + 2) / s
        z = (col - x * c) * s / aniso
    if reverse:
        z = nz - 1 - z
    z0, x0 = np.floor(z).astype(int), np.floor(x).astype(int)
    fz, fx = z - z0, x - x0
    corners = []
    for dz, wz in ((0, 1 - fz), (1, fz)):
        for dx, wx in ((0, 1 - fx), (1, fx)):
            zi, xi, w = z0 + dz, x0 + dx, wz * wx
            ok = (zi >= 0) & (zi < nz) & (xi >= 0) & (xi < nx) & (w > 0)
            corners.append((np.clip(zi, 0, nz - 1), np.clip(xi, 0, nx - 1), (w * ok)[..., None]))
    out = np.zeros((size[0], ny, size[1]))
    for k in range(0, ny, Y_BLOCK):
        for zi, xi, w in corners:
            out[:, k : k + Y_BLOCK, :] += np.moveaxis(v[zi, k : k + Y_BLOCK, xi] * w, 2, 1)
    return out[:, :: max(1, int(resample[0])), :]


def deskew(v: np.ndarray, shift: float, reverse: bool = False) -> np.ndarray:
    """Shear a (z, y, x) stack: slice z moves `shift` pixels a slice along x, linearly interpolated, 0 outside; the row grows by what the last slice moves."""
    nz, ny, nx = v.shape
    out = np.zeros((nz, ny, nx + int(np.ceil((nz - 1) * abs(shift)))))
    for z in range(nz):
        far = (nz - 1 - z if reverse != (shift < 0) else z) * abs(shift)
        at, part = int(far), far - int(far)
        out[z, :, at : at + nx] += v[z] * (1 - part)
        if part:
            out[z, :, at + 1 : at + 1 + nx] += v[z] * part
    return out


def resample_z(psf: np.ndarray, from_step: float, to_step: float) -> np.ndarray:
    """Linear interpolation along z onto another step; the middle slice stays in the middle."""
    n = max(1, int(np.floor((len(psf) - 1) * from_step / to_step)) + 1)
    at = (np.arange(n) - (n - 1) / 2) * to_step / from_step + (len(psf) - 1) / 2
    low = np.clip(np.floor(at).astype(int), 0, len(psf) - 1)
    high, f = np.minimum(low + 1, len(psf) - 1), np.clip(at - low, 0, 1)[:, None, None]
    return psf[low] * (1 - f) + psf[high] * f


def register(a: np.ndarray, b: np.ndarray, upsample: int = 10) -> tuple[float, float]:
    """Shift (dy, dx) that lays image b onto a, to 1 / upsample of a pixel, by cross-correlation and a refined transform at its peak (Guizar-Sicairos et al., 2008)."""
    product = np.fft.fft2(a) * np.fft.fft2(b).conj()
    corr = np.abs(np.fft.ifft2(product))
    peak = np.array(np.unravel_index(corr.argmax(), corr.shape), float)
    size = np.array(corr.shape)
    peak = np.where(peak > size // 2, peak - size, peak)
    if upsample > 1:
        span = int(np.ceil(1.5 * upsample))
        offsets = (np.arange(span) - span // 2) / upsample
        turns = [np.exp(2j * np.pi * np.outer(p + offsets, np.fft.fftfreq(n))) for p, n in zip(peak, size)]
        fine = np.abs(turns[0] @ product @ turns[1].T)
        peak = peak + [offsets[k] for k in np.unravel_index(fine.argmax(), fine.shape)]
    return float(peak[0]), float(peak[1])


def align_rois(image: np.ndarray, top: tuple, bottom: tuple, most: float = 60.0) -> tuple[tuple, float, float]:
    """(bottom region moved to match the top one, dy, dx); regions of other shape, or a shift over `most`, leave it as it is.

    A moved region is kept inside the image.
    """
    a, b = (image[r[0] : r[1], r[2] : r[3]].astype(float) for r in (top, bottom))
    if a.shape != b.shape or not a.size:
        return bottom, 0.0, 0.0
    window = np.hanning(a.shape[0])[:, None] * np.hanning(a.shape[1])[None, :]
    dy, dx = register(a * window, b * window)
    if np.hypot(dy, dx) > most:
        return bottom, 0.0, 0.0
    y0 = min(max(bottom[0] - int(np.rint(dy)), 0), image.shape[0] - a.shape[0])
    x0 = min(max(bottom[2] - int(np.rint(dx)), 0), image.shape[1] - a.shape[1])
    return (y0, y0 + a.shape[0], x0, x0 + a.shape[1]), dy, dx
