"""Numbers in arrays and images: robust scaling, edges, changes, composites, runs and boxes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it is used inside a lambda over an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def median(c: Column) -> Column:
    """Median of an array of numbers; null if empty."""
    n = F.size(c)
    middle = let(F.array_sort(c), lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)
    return F.when(n > 0, middle)


def robust(c: Column, floor: float = 0.04) -> Column:
    """Distance of each number from the median in 1.4826 median absolute deviations, at least ``floor``, cut at 6 each way."""
    scaled = lambda d: let(F.greatest(F.lit(floor), 1.4826 * median(F.transform(d, F.abs))), lambda w: F.transform(d, lambda x: F.greatest(F.lit(-6.0), F.least(F.lit(6.0), x / w))))
    return let(median(c), lambda m: let(F.transform(c, lambda x: x - m), scaled))


def block_means(c: Column, size: int) -> Column:
    """Means of consecutive parts of ``size`` numbers."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(c) - 1) / size).cast("int")), lambda i: F.aggregate(F.slice(c, i * size + 1, F.lit(size)), F.lit(0.0), lambda a, x: a + x) / F.size(F.slice(c, i * size + 1, F.lit(size))))


def change(a: Column, b: Column, size: int) -> Column:
    """.45 mean + .35 mean of the four largest part means + .20 97th percentile of the absolute differences."""
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
    top = lambda d: let(F.slice(F.sort_array(block_means(d, size), False), 1, 4), mean)
    tail = lambda d: F.get(F.array_sort(d), F.ceil(0.97 * (F.size(d) - 1)).cast("int"))
    return let(F.zip_with(a, b, lambda x, y: F.abs(x - y)), lambda d: 0.45 * mean(d) + 0.35 * top(d) + 0.20 * tail(d))


def runs(c: Column, least: float, gap: int) -> Column:
    """``(first, last)`` of the stretches of an array that reach ``least``, over holes of at most ``gap``."""
    at = F.filter(F.transform(c, lambda x, i: F.when(x >= least, i)), lambda i: i.isNotNull())
    start = F.slice(F.transform(F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("last"))), lambda x: x), 1, 0)

    def step(acc: Column, i: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = (F.size(acc) > 0) & (i - last["last"] <= gap + 1)
        grown = F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1)), F.array(F.struct(last["first"].alias("first"), i.alias("last"))))
        return F.when(joins, grown).otherwise(F.concat(acc, F.array(F.struct(i.alias("first"), i.alias("last")))))

    return F.aggregate(at, start, step)


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes ``[x0, y0, x1, y1]``, areas at least 1."""
    side = lambda i, j: F.greatest(F.lit(0), F.least(F.get(a, j), F.get(b, j)) - F.greatest(F.get(a, i), F.get(b, i)))
    area = lambda v: F.greatest(F.lit(1), F.get(v, 2) - F.get(v, 0)) * F.greatest(F.lit(1), F.get(v, 3) - F.get(v, 1))
    inner = side(0, 2) * side(1, 3)
    return inner / (area(a) + area(b) - inner)


def tiles(width: Column, count: int, share: float) -> Column:
    """``count`` spans of equal width over ``width``, neighbours sharing ``share`` of a span."""
    span = width / (count - (count - 1) * share)
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.struct(F.round(i * span * (1 - share), 3).alias("first"), F.round(i * span * (1 - share) + span, 3).alias("last")))


def edge_map(image: np.ndarray) -> np.ndarray:
    """Size of the gradient of a grey image, cut at its 95th percentile and scaled to 1."""
    dy, dx = np.gradient(np.asarray(image, dtype=np.float32))
    size = np.hypot(dx, dy)
    top = np.quantile(size, 0.95)
    return np.clip(size / top, 0, 1) if top > 0 else np.zeros_like(size)


def composite(frames: list[np.ndarray]) -> np.ndarray | None:
    """The median of each pixel over three frames or more of equal size, else None."""
    return np.median(np.stack(frames), axis=0).astype(frames[0].dtype) if len(frames) >= 3 and len({f.shape for f in frames}) == 1 else None


def occlusion(frame: np.ndarray, still: np.ndarray) -> float:
    """How much of a frame differs from the composite: .7 of the 90th percentile and .3 of the mean of robustly scaled differences."""

    def scaled(v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float32)
        m = np.median(v)
        return np.clip((v - m) / max(0.04, 1.4826 * float(np.median(np.abs(v - m)))), -6, 6)

    d = np.abs(scaled(frame) - scaled(still))
    return float(0.7 * np.quantile(d, 0.9) + 0.3 * d.mean())


def distinct_states(changes: list[float], times: list[float], threshold: float, gap: float) -> list[int]:
    """Indices kept from a sequence given by its change from one state to the next: the first, then each that has changed by the
    threshold since the last kept and lies ``gap`` after it, and a tail that changed by half the threshold."""
    kept, since = [0] if times else [], 0.0
    for i in range(1, len(times)):
        since += changes[i]
        if since >= threshold and times[i] - times[kept[-1]] >= gap:
            kept.append(i)
            since = 0.0
    if kept and kept[-1] != len(times) - 1 and since >= threshold / 2:
        kept.append(len(times) - 1)
    return kept
