"""Shapes as arrays: filling, fitting, distance fields, chamfer distance, thresholds, outlines, signatures; and nearest labels."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRID, PAD = 48, 2


def fitted(w: float, h: float, size: int = GRID, pad: int = PAD) -> tuple[float, float, float]:
    """Scale and margins that centre a box in a square."""
    room = max(1, size - 2 * pad)
    scale = min(room / w, room / h)
    return scale, (size - w * scale) / 2, (size - h * scale) / 2


def filled(contours: list[np.ndarray], size: int = GRID) -> tuple[np.ndarray, float] | None:
    """Mask and aspect of closed outlines, by the even-odd rule at the middle of each row."""
    points = np.concatenate(contours) if contours else np.zeros((0, 2))
    if not len(points) or not (np.ptp(points, axis=0) > 0).all():
        return None
    low, (w, h) = points.min(axis=0), np.ptp(points, axis=0)
    scale, ox, oy = fitted(w, h, size)
    edges = np.concatenate([np.stack([c, np.roll(c, -1, axis=0)], axis=1) for c in contours]).astype(float)
    edges = (edges - low) * scale + (ox, oy)
    mask, columns = np.zeros((size, size), bool), np.arange(size)
    for y in range(size):
        a, b = edges[:, 0], edges[:, 1]
        cross = (a[:, 1] <= y + 0.5) != (b[:, 1] <= y + 0.5)
        a, b = a[cross], b[cross]
        xs = np.sort(a[:, 0] + (y + 0.5 - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]))
        for x0, x1 in zip(xs[::2], xs[1::2], strict=False):
            mask[y] |= (columns >= math.ceil(x0 - 0.5)) & (columns <= math.floor(x1 - 0.5))
    return mask, float(w / h)


def trimmed(mask: np.ndarray, size: int = GRID) -> tuple[np.ndarray, float] | None:
    """The ink of a raster on the same square, by the nearest pixel, and its aspect."""
    ys, xs = np.nonzero(mask)
    if not len(ys):
        return None
    x0, x1, y0, y1 = xs.min(), xs.max(), ys.min(), ys.max()
    w, h = x1 - x0 + 1, y1 - y0 + 1
    scale, ox, oy = fitted(w, h, size)
    at = np.arange(size)
    sx, sy = np.floor(x0 + (at - ox) / scale).astype(int), np.floor(y0 + (at - oy) / scale).astype(int)
    inside = ((sy >= y0) & (sy <= y1))[:, None] & ((sx >= x0) & (sx <= x1))[None, :]
    return inside & mask[np.clip(sy, y0, y1)][:, np.clip(sx, x0, x1)].astype(bool), float(w / h)


def distance_field(mask: np.ndarray) -> np.ndarray:
    """Chamfer distance to the ink with steps of 1 and the root of 2: relaxed over all eight neighbours until nothing changes."""
    far = 2.0 * mask.shape[0]
    field = np.where(mask, 0.0, far)
    while True:
        wide = np.pad(field, 1, constant_values=far)
        shifted = [wide[1 + dy : wide.shape[0] - 1 + dy, 1 + dx : wide.shape[1] - 1 + dx] + math.hypot(dx, dy) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
        new = np.minimum.reduce(shifted)
        if np.array_equal(new, field):
            return field
        field = new


def shape_distance(a: tuple[np.ndarray, float], b: tuple[np.ndarray, float]) -> float:
    """Mean of both mean distances from ink to ink, and a penalty for aspects, in shares of the square."""
    mean = lambda mask, field: float(field[mask].mean()) if mask.any() else math.inf
    penalty = 2 * abs(math.log(max(0.01, a[1]) / max(0.01, b[1])))
    return ((mean(a[0], distance_field(b[0])) + mean(b[0], distance_field(a[0]))) / 2 + penalty) / len(a[0])


def otsu(gray: np.ndarray) -> int:
    """The threshold with the greatest variance between its two sides; the first of equals, 127 without any."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    below, total = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.where((below > 0) & (above > 0), below * above * (total / below - (total[-1] - total) / above) ** 2, 0.0)
    return int(between.argmax()) if between.max() > 0 else 127


RING = ((-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1))


def outlines(bits: np.ndarray, least: int = 8) -> list[np.ndarray]:
    """Boundaries of the ink as closed walks around it, each from a top edge that no walk before it has passed."""
    h, w = bits.shape
    ink = np.pad(bits.astype(bool), 1)
    passed, found = np.zeros((h, w), bool), []
    for y, x in np.argwhere(ink[1:-1, 1:-1] & ~ink[:-2, 1:-1]).tolist():
        if passed[y, x]:
            continue
        walk, cx, cy, way = [], x, y, 0
        while len(walk) < 4 * h * w:
            walk.append((cx, cy))
            passed[cy, cx] = True
            turn = next((k for k in range(8) if ink[1 + cy + RING[(way + 6 + k) % 8][1], 1 + cx + RING[(way + 6 + k) % 8][0]]), None)
            if turn is None:
                break
            way = (way + 6 + turn) % 8
            cx, cy = cx + RING[way][0], cy + RING[way][1]
            if (cx, cy) == (x, y):
                break
        if len(walk) >= least:
            found.append(np.array(walk))
    return found


def cloud(contours: list[np.ndarray], baseline: float, per_em: float, origin: float = 0.0) -> np.ndarray:
    """Points in units of an em, upwards from the baseline."""
    points = np.concatenate(contours).astype(float)
    return np.column_stack([(points[:, 0] - origin) / per_em, (baseline - points[:, 1]) / per_em])


def resampled(contour: np.ndarray, n: int) -> np.ndarray:
    """n points at equal steps along a closed outline."""
    ring = np.vstack([contour, contour[:1]]).astype(float)
    length = np.r_[0, np.cumsum(np.hypot(*np.diff(ring, axis=0).T))]
    at = np.arange(n) * length[-1] / n
    return np.column_stack([np.interp(at, length, ring[:, 0]), np.interp(at, length, ring[:, 1])])


def area(contour: np.ndarray) -> float:
    x, y = contour.T.astype(float)
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def signature(contours: list[np.ndarray], points: int = 64) -> tuple[np.ndarray, int, float, list[float]]:
    """Outlines by area, the largest first, resampled into a unit box; their number, aspect and shares of the area."""
    order = sorted(contours, key=area, reverse=True)
    every = np.concatenate(order).astype(float)
    low, spread = every.min(axis=0), np.ptp(every, axis=0)
    unit = [(resampled(c, points) - low) / max(float(spread.max()), 1e-9) for c in order]
    areas = [area(c) for c in order]
    return np.concatenate(unit), len(order), float(spread[0] / max(spread[1], 1e-9)), [a / max(sum(areas), 1e-9) for a in areas]


def same_topology(a: tuple, b: tuple, aspect: float = 1.5, share: float = 0.25) -> bool:
    """As many outlines, aspects within a factor, and areas of nearly the same shares."""
    return a[1] == b[1] and max(a[2], b[2]) <= aspect * min(a[2], b[2]) and all(abs(x - y) <= share for x, y in zip(a[3], b[3], strict=True))


def cloud_distance(a: np.ndarray, b: np.ndarray) -> float:
    """Mean distance of each point to the nearest of the other cloud, both ways."""
    d = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1])
    return float(d.min(axis=1).mean() + d.min(axis=0).mean()) / 2


def text_lines(centres: np.ndarray, heights: np.ndarray, gap: float = 0.6) -> np.ndarray:
    """The line of each shape: sorted by centre, a gap over a share of the usual height begins another; -1 for a line of one shape."""
    order = np.argsort(centres, kind="stable")
    line = np.r_[0, np.cumsum(np.diff(centres[order]) > gap * np.median(heights))] if len(centres) else np.zeros(0, int)
    out = np.empty(len(centres), int)
    out[order] = line
    alone = np.bincount(line)[out] == 1 if len(centres) else np.zeros(0, bool)
    return np.where(alone, -1, out)


def not_nested(boxes: np.ndarray) -> np.ndarray:
    """Which boxes (x0, y0, x1, y1) lie in no larger one."""
    a, b = boxes[:, None], boxes[None]
    inside = (a[..., :2] >= b[..., :2]).all(-1) & (a[..., 2:] <= b[..., 2:]).all(-1)
    size = np.prod(boxes[:, 2:] - boxes[:, :2], axis=1)
    return ~(inside & (size[:, None] < size[None])).any(axis=1)


def aligned(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and offset of y over x by least squares."""
    scale, offset = np.polyfit(x, y, 1) if np.ptp(x) > 0 else (0.0, float(np.mean(y)))
    return float(scale), float(offset)


#: The most labelled vectors that are sent to every task.
MOST_LABELLED = 200_000


def nearest_labels(items: DataFrame, labelled: DataFrame, most_distance: float, least_margin: float) -> DataFrame:
    """id, label, distance, margin, accepted: the nearest label of every item (id, vector) and how far the next other label is.

    labelled (label, vector) is an index of bounded size, which is checked before it is sent; items are matched in blocks by
    one matrix product. Equal distances take the lesser label. Without a second label the margin is infinite.
    """
    rows = labelled.select("label", "vector").limit(MOST_LABELLED + 1).toPandas().sort_values("label", kind="stable")
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"an index of more than {MOST_LABELLED} vectors")
    names, place = np.unique(rows["label"].to_numpy(), return_inverse=True)
    order = np.argsort(place, kind="stable")
    index, place = np.array(rows["vector"].tolist(), float)[order], place[order]
    starts = np.searchsorted(place, np.arange(len(names)))

    def run(parts):
        for part in parts:
            out = []
            for a in range(0, len(part), 1024):
                some = part.iloc[a : a + 1024]
                v = np.array(some["vector"].tolist(), float)
                d = np.sqrt(np.maximum((v**2).sum(1)[:, None] + (index**2).sum(1)[None] - 2 * v @ index.T, 0))
                by = np.minimum.reduceat(d, starts, axis=1)
                best = by.argmin(axis=1)
                first = by[np.arange(len(v)), best]
                by[np.arange(len(v)), best] = np.inf
                margin = by.min(axis=1) - first
                out.append(pd.DataFrame({"id": some["id"].to_numpy(), "label": names[best], "distance": first, "margin": margin, "accepted": (first <= most_distance) & (margin >= least_margin)}))
            yield pd.concat(out) if out else pd.DataFrame({"id": [], "label": [], "distance": [], "margin": [], "accepted": []})

    types = dict(labelled.dtypes)
    return items.select("id", "vector").mapInPandas(run, f"id {dict(items.dtypes)['id']}, label {types['label']}, distance double, margin double, accepted boolean")


def leading(rows: DataFrame, group: str, k: int) -> DataFrame:
    """The k nearest candidates (group, label, distance) of each group, equal distances by label."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("distance", "label"))).filter(F.col("place") <= k)
