"""Two curves of a key side by side: the best lag within bounds, time warping in a band; and flashes: narrow peaks of joined curves.

A key's curves are vectors in one task, bounded by ``series.MOST``; keys are spread over tasks.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import series

#: Values of curves of one length that are worked on at once.
TOGETHER = 100_000


def resampled(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` values at even steps along a curve, by straight lines between its values."""
    return x if len(x) == n else np.interp(np.linspace(0, 1, n), np.linspace(0, 1, len(x)), x)


def lagged(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of two tables of curves the lag of up to ``most`` places either way at which a(i + lag) goes best with b(i), the least
    of equal ones, and the correlation there: products about the means, summed over the places both have, over the deviations of
    all places."""
    a, b = a - a.mean(axis=1, keepdims=True), b - b.mean(axis=1, keepdims=True)
    n, most = a.shape[1], min(most, a.shape[1] - 1)
    wide = 1 << (2 * n - 1).bit_length()
    full = np.fft.irfft(np.fft.rfft(a, wide) * np.conj(np.fft.rfft(b, wide)), wide)
    at = np.arange(-most, most + 1)
    level = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))[:, None]
    c = np.where(level > 0, full[:, at % wide] / np.where(level > 0, level, 1), 0.0)
    best = np.round(c, 9).argmax(axis=1)
    return at[best], c[np.arange(len(c)), best]


def warped(a: np.ndarray, b: np.ndarray, band: int) -> tuple[float, int]:
    """``all_warped`` of one pair of curves."""
    distance, steps = all_warped(a[None], b[None], band)
    return float(distance[0]), int(steps[0])


def all_warped(a: np.ndarray, b: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of two tables of curves the least root of the summed squared differences along a path that steps on in a, in b, or in
    both, and stays within ``band`` places of the straight way; and the path's number of places (of equal paths, a step in both is
    taken first).

    Cells are worked on by the diagonals that cross the path, all cells of one at once, of all rows.
    """
    n, m = a.shape[1], b.shape[1]
    band = max(band, abs(n - m))
    # By diagonal: first i, summed cost and places of the best path to each cell.
    cost = {0: (0, (a[:, :1] - b[:, :1]) ** 2, np.ones((len(a), 1), np.int64))}
    for s in range(1, n + m - 1):
        # Cells (i, s - i) in the table and in the band |i - j| <= band.
        low, high = max(0, s - m + 1, -((band - s) // 2)), min(n - 1, s, (s + band) // 2)
        i = np.arange(low, high + 1)
        come = []
        for back, shift in ((2, 1), (1, 1), (1, 0)):
            start, value, count = cost.get(s - back, (0, np.zeros((len(a), 0)), None))
            at = i - shift - start
            fine = (at >= 0) & (at < value.shape[1])
            at = np.where(fine, at, 0)
            come.append((np.where(fine, value[:, at], np.inf), np.where(fine, count[:, at], 0)) if value.shape[1] else (np.full((len(a), len(i)), np.inf), np.zeros((len(a), len(i)), np.int64)))
        values = np.stack([v for v, _ in come])
        pick = values.argmin(axis=0)[None]
        gap = (a[:, i] - b[:, s - i]) ** 2
        cost[s] = (low, np.take_along_axis(values, pick, 0)[0] + gap, np.take_along_axis(np.stack([c for _, c in come]), pick, 0)[0] + 1)
        cost.pop(s - 2, None)
    _, value, steps = cost[n + m - 2]
    return np.sqrt(value[:, -1]), steps[:, -1]


def side_by_side(df: DataFrame, key: str, order: list[str], a: str, b: str, most: int, band: int) -> DataFrame:
    """key, n, lag, correlation, alignment (the correlation between 0 and 1), pearson (without a lag), distance and steps of the
    warping path. Nulls of ``a`` and of ``b`` are left out of their curve; the shorter curve is brought to the length of the
    longer one. Keys with an empty curve have no row; a level curve has no correlation, which counts as 0."""

    kinds = {key: pa.int64(), "n": pa.int64(), "lag": pa.int64(), "correlation": pa.float64(), "alignment": pa.float64(), "pearson": pa.float64(), "distance": pa.float64(), "steps": pa.int64()}

    def worked(table: pa.Table):
        """The figures of whole keys: curves of one length at once, up to TOGETHER values."""
        k, sides = table[key].to_numpy(), [(table[c].is_valid().to_numpy(), table[c].to_numpy().astype(np.float64)) for c in (a, b)]
        curves = {}
        for start, end in itertools.pairwise([0, *(np.flatnonzero(np.diff(k)) + 1).tolist(), len(k)]):
            x, y = (v[start:end][own[start:end]] for own, v in sides)
            if len(x) and len(y):
                n = max(len(x), len(y))
                curves.setdefault(n, []).append((int(k[start]), resampled(x, n), resampled(y, n)))
        for n, rows in curves.items():
            step = max(1, TOGETHER // n)
            for at in range(0, len(rows), step):
                names, x, y = zip(*rows[at : at + step], strict=True)
                x, y = np.stack(x), np.stack(y)
                lag, best = lagged(x, y, most)
                distance, steps = all_warped(x, y, band)
                out = (names, [n] * len(names), lag, best, np.clip(best, 0.0, 1.0), lagged(x, y, 0)[1], distance, steps)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(out, kinds.values(), strict=True)], names=list(kinds))

    def run(batches):
        held, size = [], 0
        for batch in filter(len, batches):
            k = batch[key].to_numpy()
            # The last key may go on in the next batch.
            cut = int(np.searchsorted(k, k[-1]))
            if cut or (held and held[-1][key][0].as_py() != k[0]):
                whole = [*held, batch.slice(0, cut)]
                yield from worked(pa.Table.from_batches(whole).combine_chunks())
                held, size = [], 0
            held.append(batch.slice(cut))
            if (size := size + len(batch) - cut) > series.MOST:
                raise ValueError(f"{size} values for one key; {series.MOST} are held at most")
        if held:
            yield from worked(pa.Table.from_batches(held).combine_chunks())

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), *order, F.col(a).cast("double").alias(a), F.col(b).cast("double").alias(b))
    rows = rows.repartition(key).sortWithinPartitions(key, *order).select(key, a, b)
    return rows.mapInArrow(run, f"{key} long, n long, lag long, correlation double, alignment double, pearson double, distance double, steps long")


def smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing out to four deviations; beyond the ends the curve is mirrored, its end values repeated."""
    reach = int(4 * sigma + 0.5)
    if not len(x) or not reach:
        return x
    taps = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    around = np.arange(-reach, len(x) + reach) % (2 * len(x))
    return np.convolve(x[np.where(around < len(x), around, 2 * len(x) - 1 - around)], taps / taps.sum(), "valid")


def widths(x: np.ndarray, at: np.ndarray, share: float = 0.5) -> np.ndarray:
    """How wide each peak is at ``share`` of its prominence below its top, by straight lines between the values."""
    out = np.zeros(len(at))
    for k, (p, level) in enumerate(zip(at.tolist(), (x[at] - share * series.prominences(x, at)).tolist(), strict=True)):
        ends = []
        for step in (-1, 1):
            i = p
            while 0 <= i + step < len(x) and x[i] > level:
                i += step
            ends.append(i - step * (level - x[i]) / (x[i - step] - x[i]) if x[i] < level else float(i))
        out[k] = ends[1] - ends[0]
    return out


def peaks(x: np.ndarray, height: float, distance: int, narrow: float, wide: float) -> np.ndarray:
    """Places of peaks of ``height`` at least, none closer than ``distance`` to a higher one, from ``narrow`` to ``wide`` places wide."""
    at = series.local_peaks(x)
    at = at[x[at] >= height]
    at = at[series.apart(at, x[at], distance)] if len(at) else at
    w = widths(x, at)
    return at[(w >= narrow) & (w <= wide)]


def flashes(df: DataFrame, key: str, order: list[str], kinds: dict[str, list[str]], sigma: float, distance: int, longest: float, deviations: float = 1.5) -> DataFrame:
    """key, place, kind, intensity: flashes of each kind, whose curve is the greatest of its columns at each row, each brought to 0 to 1
    within the key (a null counts as 0, a level column is 0), then smoothed. A flash is a peak of at least the mean and
    ``deviations`` deviations, ``distance`` rows apart, 1 to ``longest`` rows wide at half its prominence."""
    columns = list(dict.fromkeys(c for own in kinds.values() for c in own))

    def work(table: pa.Table) -> pa.Table:
        series.held(table, "rows")
        table = table.sort_by([(c, "ascending") for c in order])
        level = {}
        for c in columns:
            x = np.nan_to_num(table[c].to_numpy().astype(np.float64))
            wide = x.max() - x.min()
            level[c] = (x - x.min()) / wide if wide > 0 else np.zeros(len(x))
        rows = []
        for kind, own in kinds.items():
            x = smooth(np.max([level[c] for c in own], axis=0), sigma)
            rows += [(int(p), kind, float(x[p])) for p in peaks(x, x.mean() + deviations * x.std(), distance, 1, longest)]
        rows.sort()
        place, kind, top = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({key: pa.array([table[key][0].as_py()] * len(rows), pa.int64()), "place": pa.array(place, pa.int64()), "kind": pa.array(kind, pa.string()), "intensity": pa.array(top, pa.float64())})

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), *order, *(F.col(c).cast("double").alias(c) for c in columns))
    return rows.groupBy(key).applyInArrow(work, f"{key} long, place long, kind string, intensity double")
