"""Pixel steps in numpy behind Arrow batches: raw grey pages with their height and width.

Files are decoded by a provider; these steps work on arrays, and need no imaging library. They
follow the usual definitions of each step; pixels that a library would make may differ by rounding.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

STATS = "doc_id string, brightness double, contrast double, sharpness double, ink double, dpi int"


def grey(pixels: bytes, height: int, width: int) -> np.ndarray:
    a = np.frombuffer(pixels, np.uint8).reshape(height, width, -1).astype(float)
    return a[..., 0] if a.shape[2] == 1 else a[..., :3] @ np.array([0.299, 0.587, 0.114])


def sums_in_window(a: np.ndarray, side: int) -> np.ndarray:
    """Sum over the window of side by side pixels around each pixel, edges repeated."""
    half = side // 2
    p = np.pad(a, half, mode="edge").cumsum(0).cumsum(1)
    p = np.pad(p, ((1, 0), (1, 0)))
    return p[side:, side:] - p[:-side, side:] - p[side:, :-side] + p[:-side, :-side]


def binarized(page: np.ndarray, side: int, k: float = 0.2, r: float = 128.0) -> np.ndarray:
    """Ink (0) and paper (255) by a threshold that follows the local mean and spread."""
    n = side * side
    mean = sums_in_window(page, side) / n
    spread = np.sqrt(np.maximum(0, sums_in_window(page**2, side) / n - mean**2))
    return np.where(page > mean * (1 + k * (spread / r - 1)), 255, 0).astype(np.uint8)


def sharpness(page: np.ndarray) -> float:
    """Variance of the Laplacian."""
    p = np.pad(page, 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * page).var())


def stretched(page: np.ndarray, low: float = 1.0, high: float = 99.0) -> np.ndarray:
    """Contrast stretched between two percentiles."""
    a, b = np.percentile(page, (low, high))
    return page if b <= a else np.clip((page - a) * 255 / (b - a), 0, 255)


def gamma(page: np.ndarray, exponent: float) -> np.ndarray:
    return 255 * (page / 255) ** exponent


def resized(page: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear."""
    y, x = (np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1) for n, m in ((height, page.shape[0]), (width, page.shape[1])))
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, page.shape[0] - 1), np.minimum(x0 + 1, page.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    top = page[y0][:, x0] * (1 - fx) + page[y0][:, x1] * fx
    return top * (1 - fy) + (page[y1][:, x0] * (1 - fx) + page[y1][:, x1] * fx) * fy


def unwrapped_seal(page: np.ndarray, cy: float, cx: float, radius: float, height: int = 64, width: int = 256) -> np.ndarray:
    """The ring around a centre as a band: angle to the right, radius downwards."""
    angle = np.arange(width) * 2 * np.pi / width
    far = radius * (1 - np.arange(height) / height)
    y = np.clip(np.rint(cy + far[:, None] * np.sin(angle)), 0, page.shape[0] - 1).astype(int)
    x = np.clip(np.rint(cx + far[:, None] * np.cos(angle)), 0, page.shape[1] - 1).astype(int)
    return page[y, x]


def red_circle(rgb: np.ndarray) -> tuple[float, float, float] | None:
    """Centre and radius of the red marks of a colour page; null without enough of them."""
    c = rgb.astype(int)
    y, x = np.nonzero((c[..., 0] > 120) & (c[..., 0] - c[..., 1] > 60) & (c[..., 0] - c[..., 2] > 60))
    if len(y) < 20:
        return None
    cy, cx = (y.min() + y.max()) / 2, (x.min() + x.max()) / 2
    return float(cy), float(cx), float(max(np.ptp(y), np.ptp(x)) / 2)


def seal_band(rgb: np.ndarray) -> tuple[np.ndarray, bool]:
    """A seal's ring as a band, and True; the picture as it is, and False, where no circle of red is found."""
    if min(rgb.shape[:2]) < 20 or (found := red_circle(rgb)) is None:
        return rgb, False
    return unwrapped_seal(rgb, *found), True


def brightened(page: np.ndarray, dark: float = 80, bright: float = 200) -> np.ndarray:
    """A dark page with more light and local contrast, a bright one with less light, stretched; any other as it is."""
    mean = float(page.mean())
    if mean < dark:
        return equalized(gamma(page, max(0.4, mean / dark)), clip=3.0)
    if mean > bright:
        lit = gamma(page, max(1.1, min(1.8, mean / 170)))
        low, high = np.percentile(lit, (2, 98))
        return stretched(lit, 2, 98) if high - low > 10 else lit
    return page


def equalized(page: np.ndarray, tiles: int = 8, clip: float = 2.0) -> np.ndarray:
    """Histogram equalisation by tiles with clipped histograms; between the tiles' middles their maps are mixed."""
    h, w = page.shape
    grey_page = np.clip(page, 0, 255).astype(np.uint8)
    ys, xs = (np.linspace(0, n, tiles + 1).astype(int) for n in (h, w))
    maps = np.tile(np.arange(256.0), (tiles, tiles, 1))
    for i in range(tiles):
        for j in range(tiles):
            part = grey_page[ys[i] : ys[i + 1], xs[j] : xs[j + 1]]
            if part.size:
                counts = np.bincount(part.ravel(), minlength=256).astype(float)
                most = max(1.0, clip * part.size / 256)
                counts = np.minimum(counts, most) + np.maximum(0, counts - most).sum() / 256
                maps[i, j] = counts.cumsum() * 255 / part.size
    y, x = (np.clip((np.arange(n) + 0.5) * tiles / n - 0.5, 0, tiles - 1) for n in (h, w))
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda i, j: maps[i[:, None], j[None, :], grey_page]
    return (at(y0, x0) * (1 - fx) + at(y0, x1) * fx) * (1 - fy) + (at(y1, x0) * (1 - fx) + at(y1, x1) * fx) * fy


def _around(page: np.ndarray, side: int) -> np.ndarray:
    half = side // 2
    padded = np.pad(page, ((half, side - 1 - half), (half, side - 1 - half)), mode="edge")
    return np.lib.stride_tricks.sliding_window_view(padded, (side, side)).reshape(*page.shape, -1)


def denoised(page: np.ndarray) -> np.ndarray:
    """The median of every three by three pixels."""
    return np.median(_around(page, 3), axis=-1)


def opened(page: np.ndarray, side: int) -> np.ndarray:
    """The least, then the greatest, of side by side pixels: bright marks that are smaller go."""
    return page if side <= 1 else _around(_around(page, side).min(-1), side).max(-1)


def sampled(page: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values at places of a page, whose edges go on beyond it."""
    y, x = np.clip(y, 0, page.shape[0] - 1), np.clip(x, 0, page.shape[1] - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, page.shape[0] - 1), np.minimum(x0 + 1, page.shape[1] - 1)
    fy, fx = y - y0, x - x0
    return (page[y0, x0] * (1 - fx) + page[y0, x1] * fx) * (1 - fy) + (page[y1, x0] * (1 - fx) + page[y1, x1] * fx) * fy


def rotated(page: np.ndarray, degrees: float, least: float = 0.2) -> np.ndarray:
    """The page turned about its middle so that lines at this angle become level; small angles are let be."""
    if abs(degrees) < least:
        return page
    h, w = page.shape
    y, x = np.mgrid[:h, :w] - np.array([h / 2, w / 2])[:, None, None]
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    return sampled(page, s * x + c * y + h / 2, c * x - s * y + w / 2)


def ordered_corners(points: np.ndarray) -> np.ndarray:
    """Four corners (x, y) from the top left one on, clockwise."""
    total, slope = points.sum(1), points[:, 1] - points[:, 0]
    return points[[total.argmin(), slope.argmin(), total.argmax(), slope.argmax()]].astype(float)


def flattened(page: np.ndarray, corners: np.ndarray, least: int = 100) -> np.ndarray:
    """The part of a page within four corners, seen from straight above; one that is too small is let be."""
    p = ordered_corners(np.asarray(corners))
    side = lambda a, b: float(np.hypot(*(p[a] - p[b])))
    w, h = int(max(side(2, 3), side(1, 0))), int(max(side(1, 2), side(0, 3)))
    if min(w, h) < least:
        return page
    goal = np.array([[0, 0], [w - 1, 0], [w - 1, h - 1], [0, h - 1]], float)
    rows, right = [], []
    for (u, v), (x, y) in zip(goal, p, strict=True):
        rows += [[u, v, 1, 0, 0, 0, -u * x, -v * x], [0, 0, 0, u, v, 1, -u * y, -v * y]]
        right += [x, y]
    m = np.append(np.linalg.solve(np.array(rows), np.array(right)), 1).reshape(3, 3)
    v, u = np.mgrid[:h, :w]
    x, y, z = np.einsum("ij,jhw->ihw", m, np.stack([u, v, np.ones_like(u)]).astype(float))
    return sampled(page, y / z, x / z)


def enlarged(page: np.ndarray, factor: float, lobes: int = 3) -> np.ndarray:
    """Lanczos resampling, by at most two."""
    out = page.astype(float)
    for axis in (0, 1):
        n = out.shape[axis]
        m = max(1, int(n * min(factor, 2.0)))
        centre = (np.arange(m) + 0.5) * n / m - 0.5
        near = np.floor(centre).astype(int)[:, None] + np.arange(1 - lobes, lobes + 1)
        weight = np.sinc(centre[:, None] - near) * np.sinc((centre[:, None] - near) / lobes) * (np.abs(centre[:, None] - near) < lobes)
        weight /= weight.sum(1, keepdims=True)
        lines = np.moveaxis(out, axis, 0)[np.clip(near, 0, n - 1)]
        out = np.moveaxis(np.einsum("ml,ml...->m...", weight, lines), 0, axis)
    return np.clip(out, 0, 255)


def png(page: np.ndarray) -> bytes:
    """A grey or colour picture as a PNG file."""
    a = np.clip(page, 0, 255).astype(np.uint8)
    h, w = a.shape[:2]
    lines = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, -1)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2 if a.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def for_model(page: np.ndarray, most: int = 1120) -> str:
    """A grey page as base 64 of a PNG whose longer side is at most most."""
    longer = max(page.shape)
    small = page if longer <= most else resized(page, max(1, int(page.shape[0] * most / longer)), max(1, int(page.shape[1] * most / longer)))
    return base64.b64encode(png(small)).decode()


def cleaned(page: np.ndarray, dpi: int, angle: float = 0.0, corners: np.ndarray | None = None, fax: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """(page, ink, dpi) after the clean-up of its resolution's band.

    A low one is enlarged twice and its contrast raised, strokes are left as they are; any
    other is brought to 300 dpi and denoised, seen from above and turned level.
    """
    page = brightened(page.astype(float))
    if fax:
        page = denoised(page)
    if dpi < 150:
        page, dpi = equalized(enlarged(page, 2.0)), dpi * 2
    else:
        if dpi != 300:
            page = resized(page, max(1, page.shape[0] * 300 // dpi), max(1, page.shape[1] * 300 // dpi))
            angle, corners, dpi = angle, None if corners is None else np.asarray(corners) * 300 / dpi, 300
        page = denoised(page)
        if corners is not None:
            page = flattened(page, corners)
        page = rotated(page, angle)
    return page, opened(binarized(page, max(7, int(dpi / 25.4 * 2.5) | 1)), 2 if dpi >= 300 else 1), dpi


def cleaned_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, image, height, width, dpi, ink): pages(doc_id, pixels, height, width, dpi, angle) cleaned up, as PNG in base 64 for a model; a page that can't be read has no image."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                try:
                    page, ink, dpi = cleaned(grey(r.pixels, r.height, r.width), int(r.dpi), float(r.angle or 0.0))
                    rows.append((r.doc_id, for_model(page), *page.shape, dpi, float((ink == 0).mean())))
                except ValueError:
                    rows.append((r.doc_id, None, 0, 0, int(r.dpi), 0.0))
            yield pd.DataFrame(rows, columns=["doc_id", "image", "height", "width", "dpi", "ink"])

    return pages.select("doc_id", "pixels", "height", "width", "dpi", "angle").mapInPandas(run, "doc_id string, image string, height int, width int, dpi int, ink double")


def page_statistics(pages: DataFrame) -> DataFrame:
    """Brightness, contrast, sharpness and ink of pages(doc_id, pixels, height, width, dpi)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                g = grey(r.pixels, r.height, r.width)
                side = max(7, int(r.dpi / 25.4 * 2.5) | 1)
                rows.append((r.doc_id, float(g.mean()), float(g.std()), sharpness(g), float((binarized(g, side) == 0).mean()), r.dpi))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in STATS.split(", ")])

    return pages.select("doc_id", "pixels", "height", "width", "dpi").mapInPandas(run, STATS)
