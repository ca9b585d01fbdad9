"""The figures of one volume by numpy: the brute force that `slices` is held against."""

from __future__ import annotations

import numpy as np

from radspan.operators.volume import binned, split_threshold


#: fixed values: words of a description that is not axial
NOT_AXIAL = ("SAG", "COR")


def symmetry(v: np.ndarray, description: str | None = None) -> tuple[float, str]:
    """Correlation of the left half with the mirrored right half, at least 0; neutral for flat and for non-axial volumes."""
    if v.ndim < 3:
        return 1.0, "N/A (2D)"
    if any(x in (description or "").upper() for x in NOT_AXIAL):
        return 1.0, "N/A (non-axial)"
    if v.shape[0] < 3:
        return 1.0, "N/A (single slice)"
    half = v.shape[-1] // 2
    a, b = (x - x.mean() for x in (v[..., :half], v[..., ::-1][..., :half]))
    scale = np.sqrt(np.square(a).sum() * np.square(b).sum())
    r = float((a * b).sum() / scale) if scale > 1e-12 else 0.0
    names = ((0.90, "symmetric"), (0.80, "normal"), (0.65, "mild asymmetry"))
    return max(0.0, r), next((n for cut, n in names if r > cut), "significant asymmetry")


def sharpness(v: np.ndarray) -> tuple[float, float, float]:
    """Mean, deviation and 95th percentile of the middle slice's gradient."""
    s = v[v.shape[0] // 2] if v.ndim > 2 else v
    g = np.hypot(np.diff(s, axis=0)[:, :-1], np.diff(s, axis=1)[:-1])
    return float(g.mean()), float(g.std()), float(np.percentile(g, 95))


def _correlation(a: np.ndarray, b: np.ndarray) -> float | None:
    return float(np.corrcoef(a.ravel(), b.ravel())[0, 1]) if a.std() > 1e-6 and b.std() > 1e-6 else None


def motion(v: np.ndarray) -> tuple[float, float, bool, float]:
    """Ratio of spectral energy in the two directions, correlation with the next slice, whether both tell of motion, severity."""
    k = v.shape[0] // 2
    s = v[k] if v.ndim > 2 else v
    m = np.abs(np.fft.fftshift(np.fft.fft2(s)))
    y, x = (n // 2 for n in m.shape)
    m[y, x] = 0
    by, bx = (max(n // 8, 2) for n in m.shape)
    e = sorted((float(m[max(y - by, 0) : y + by].sum()), float(m[:, max(x - bx, 0) : x + bx].sum())))
    ratio = e[1] / e[0] if e[0] >= 1e-6 else 1.0
    near = _correlation(v[k], v[k + 1]) if v.ndim > 2 and v.shape[0] > 2 else None
    near = 1.0 if near is None else near
    severity = 60 * min((ratio - 1) / 4, 1) + 40 * max(0.0, (1 - near) / 0.3)
    return ratio, near, ratio > 2.5 and near < 0.8, min(severity, 100.0)


def contrast(v: np.ndarray) -> float:
    """Distance of the means of the two classes of positive voxels in deviations of the lower one; 0 with too few voxels."""
    x = v[v > 0]
    if len(x) < 100:
        return 0.0
    t = split_threshold(x)
    high, low = x[x > t], x[x <= t]
    return float(abs(high.mean() - low.mean()) / max(low.std(), 1e-6)) if min(len(high), len(low)) >= 10 else 0.0


#: fixed value: the noise floor of magnitude images in units of its sigma
RICIAN = 1.526


def noise(v: np.ndarray) -> tuple[float, float, str]:
    """noise_floor(), the sigma behind it, and a word for it."""
    n = noise_floor(v)
    words = ((5, "very low noise"), (15, "low noise"), (30, "moderate noise"))
    return n, n / RICIAN, next((w for below, w in words if n < below), "high noise")


def noise_floor(v: np.ndarray) -> float:
    """Deviation of positive voxels in the middle slice's corners, or of the lowest twentieth of all."""
    if v.ndim < 3:
        return 0.0
    s = v[v.shape[0] // 2]
    n = max(s.shape[0] // 10, 5)
    c = np.concatenate([p.ravel() for p in (s[:n, :n], s[:n, -n:], s[-n:, :n], s[-n:, -n:])])
    c = c[c > 0]
    if len(c) < 20:
        x = v[v > 0]
        if len(x) < 100:
            return 0.0
        c = x[x <= np.percentile(x, 5)]
    return float(c.std())


def bias_field(v: np.ndarray, grid: int = 4) -> float:
    """Deviation over mean of the means of a grid's cells in the middle slice."""
    s = v[v.shape[0] // 2] if v.ndim > 2 else v
    h, w = (n // grid for n in s.shape)
    if v.ndim < 3 or v.shape[0] < 3 or min(h, w) < 5:
        return 0.0
    cells = [s[i * h : (i + 1) * h, j * w : (j + 1) * w] for i in range(grid) for j in range(grid)]
    means = np.array([c[c > 0].mean() for c in cells if (c > 0).sum() > 10])
    return float(means.std() / max(means.mean(), 1e-6)) if len(means) >= 4 else 0.0


def edge_variance(v: np.ndarray) -> float:
    """Mean variance of the Laplacian (edges wrap round) over up to five slices."""
    n = v.shape[0]
    picked = v[np.linspace(n // 6, min(n - n // 6, n - 1), min(5, n), dtype=int)] if v.ndim > 2 else v[None]
    lap = sum(np.roll(picked, d, a) for a in (1, 2) for d in (1, -1)) - 4 * picked
    return float(lap.var(axis=(1, 2)).mean())


def histogram_peaks(v: np.ndarray, bins: int = 128) -> tuple[int, float, str]:
    """Peaks of the smoothed histogram of positive voxels, the least distance between neighbours as a share of its width,
    and how hard the classes are to tell apart."""
    x = v[v > 0]
    if len(x) < 100:
        return 0, 0.0, "hard"
    n, edges = np.histogram(x, bins)
    centres = (edges[1:] + edges[:-1]) / 2
    m = np.convolve(n, np.ones(5, int), "same")  # whole numbers: equal neighbours stay equal
    at = 1 + np.flatnonzero((m[1:-1] > m[:-2]) & (m[1:-1] > m[2:]) & (m[1:-1] > m.max() * 0.05))
    apart = float(np.diff(centres[at].round(1)).min() / max(centres[-1] - centres[0], 1e-6)) if len(at) > 1 else 0.0
    return len(at), apart, "easy" if len(at) >= 3 and apart > 0.1 else "medium" if len(at) >= 2 else "hard"


def slice_consistency(v: np.ndarray, most: int = 20) -> float:
    if v.ndim < 3 or v.shape[0] < 3:
        return 1.0
    pairs = range(0, v.shape[0] - 1, max(v.shape[0] // most, 1))[:most]
    found = [r for r in (_correlation(v[i], v[i + 1]) for i in pairs) if r is not None]
    return float(np.mean(found)) if found else 1.0


METRICS = "symmetry_index double, symmetry string, sharpness_mean double, sharpness_std double, sharpness_p95 double, ghosting_ratio double, slice_correlation double, motion boolean, motion_score double, cnr double, noise_floor double, rician_sigma double, noise string, bias_severity double, laplacian_variance double, n_peaks int, min_peak_separation double, segmentation string, mean_correlation double"
#: in place of symmetry, sharpness and motion of volumes that are too small to tell
NEUTRAL = (1.0, "N/A (small)", 0.0, 0.0, 0.0, 1.0, 1.0, False, 0.0)


def measure(v: np.ndarray, description: str | None = None, small: int = 0) -> tuple:
    basic = NEUTRAL if v.size <= small else (*symmetry(v, description), *sharpness(v), *motion(v))
    return *basic, contrast(v), *noise(v), bias_field(v), edge_variance(v), *histogram_peaks(v), slice_consistency(v)


# ---- statistics of whole volumes

PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)
TINY = 1e-6


def background_noise(v: np.ndarray) -> float:
    """Deviation of air: the median over up to five slices of their corners (an eighth of each side) where these are dark,
    else that of the darkest tenth, else that of all voxels; zeros are padding."""
    shown = [v] if v.ndim == 2 else []
    if v.ndim > 2:
        n, edge = len(v), max(len(v) // 10, 1)
        shown = v[np.linspace(edge, n - edge - 1, min(5, n - 2 * edge), dtype=int)] if n > 4 else v[n // 2 : n // 2 + 1]
    air = []
    for s in shown:
        h, w = (max(x // 8, 2) for x in s.shape)
        c = np.concatenate([s[a, b].ravel() for a in (slice(h), slice(-h, None)) for b in (slice(w), slice(-w, None))])
        c = c[c != 0]
        if len(c) > 10 and c.mean() < 0.3 * v.mean():
            air.append(c.std())
    tries = [np.median(air)] if air else []
    x = v[v != 0]
    if v.ndim > 1 and len(x) >= 10:
        dark = x[x <= np.percentile(x, 10)]
        tries += [dark.std()] if len(dark) > 10 else []
    return float(next((t for t in tries if t > TINY), max(v.std(), TINY)))


def shape_of_values(x: np.ndarray) -> tuple[float, float, float]:
    """Entropy in bits over 256 bins, population skewness, excess kurtosis; the last two are 0 for a constant array."""
    p = binned(x, 256)[0] / x.size
    p = p[p > 0]
    d = x - x.mean()
    var = float(np.square(d).mean())
    flat = var**0.5 < 1e-10
    return float(-(p * np.log2(p)).sum()), 0.0 if flat else float((d**3).mean() / var**1.5), 0.0 if flat else float((d**4).mean() / var**2 - 3)


def contrast_figures(v: np.ndarray) -> dict[str, float]:
    """Signal and contrast over noise. The signal is the tissue above the threshold; a signal of more than 100 times the
    noise is measured against the tissue's own deviation; contrast needs over 100 positive voxels below the threshold."""
    noise, cut = background_noise(v), split_threshold(v)
    tissue, below = v[v > cut], v[(v <= cut) & (v > 0)]
    signal = tissue.mean() if tissue.size else v.mean()
    spread = tissue.std() if tissue.size > 100 else v.std()
    snr = signal / (noise + TINY)
    snr = signal / (spread + TINY) if snr > 100 else snr
    cnr = abs(signal - below.mean()) / (noise + TINY) if below.size > 100 else snr
    return {"volume_snr_estimate": snr, "volume_cnr": cnr, "background_noise_std": noise, "otsu_threshold": cut, "volume_tissue_pct": tissue.size / v.size * 100}


def stats(v: np.ndarray, spacing: list[float] | None = None) -> dict:
    """The figures of a volume (z, y, x) or image; spacing is x, y, z in mm, 1 where it is missing."""
    step = [*(spacing or []), 1.0, 1.0, 1.0][:3]
    p = dict(zip(PERCENTILES, np.percentile(v, PERCENTILES), strict=True))
    bits, skew, kurt = shape_of_values(v.ravel())
    slices = v.reshape(len(v), -1) if v.ndim > 2 else v.reshape(1, -1)
    level = slices.mean(axis=1)
    snr = level / (slices.std(axis=1) + TINY)
    size = float(np.prod(step))
    out = {"volume_shape": list(v.shape), "spacing_mm": step, "fov_mm": [n * s for n, s in zip(v.shape, step[::-1], strict=False)]}
    out |= {"volume_voxel_count": v.size, "voxel_volume_mm3": size, "total_volume_mm3": size * v.size, "total_volume_cc": size * v.size / 1000}
    out |= {"volume_min": v.min(), "volume_max": v.max(), "volume_mean": v.mean(), "volume_std": v.std(), "volume_median": p[50], "volume_iqr": p[75] - p[25], "volume_dynamic_range": v.max() - v.min()}
    out |= {f"volume_p{q}": p[q] for q in (1, 5, 25, 75, 95, 99)}
    out |= {"volume_snr_naive": v.mean() / (v.std() + TINY), "volume_nonzero_pct": (v != 0).mean() * 100, "volume_entropy": bits, "volume_skewness": skew, "volume_kurtosis": kurt}
    out |= {"slice_snr_mean": snr.mean(), "slice_snr_std": snr.std(), "slice_snr_min": snr.min(), "slice_snr_max": snr.max(), "slice_intensity_uniformity": 1 - level.std() / (level.mean() + TINY)}
    return out | contrast_figures(v)
