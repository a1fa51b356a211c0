"""Soft cuts of a key's frames: fades, in which light changes evenly, and dissolves, in which one picture mixes into another."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import series

#: Windows that are looked at in one go.
CHUNK = 1 << 15


@dataclass(frozen=True)
class Rules:
    """Fixed values, as far as a caller names no others: steps of light below ``still`` begin a fade and below ``quiet`` go on; it has
    ``least`` steps and changes light by over ``change``. A dissolve's window (``reach`` frames, a fifth of all at most) has
    picture changes of a variance below ``even`` and a mean over ``some``, less motion than ``motion`` and changes that follow
    each other (correlation over ``follow``); light steps that are alike (variance below ``alike``) and over ``some`` are exposure."""

    still: float = 0.01
    quiet: float = 0.02
    least: int = 3
    change: float = 0.1
    reach: int = 10
    even: float = 0.001
    some: float = 0.01
    motion: float = 2.0
    follow: float = 0.5
    alike: float = 0.0001


def median5(x: np.ndarray) -> np.ndarray:
    return np.median(sliding_window_view(np.pad(x, 2), 5), axis=1) if len(x) else x


def fades(light: np.ndarray, tone: np.ndarray, r: Rules) -> list[tuple[int, int, str]]:
    """(first frame, last frame, kind): each stretch of quiet steps gives one at most, from its first still step to its end."""
    step = np.maximum(np.abs(median5(np.diff(light))), np.abs(median5(np.diff(tone))))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (step < r.quiet).view(np.int8), [0]])))
    still, out = np.flatnonzero(step < r.still), []
    for a, b in edges.reshape(-1, 2).tolist():
        k = int(np.searchsorted(still, a))
        if k < len(still) and still[k] < b:
            a = int(still[k])
            if b - a >= r.least and max(abs(light[b] - light[a]), abs(tone[b] - tone[a])) > r.change:
                out.append((a, b, "fade_in" if light[b] > light[a] else "fade_out"))
    return out


def follows(x: np.ndarray) -> np.ndarray:
    """Of each row, the correlation of its values with the next ones; a level row has none."""
    a, b = x[:, :-1], x[:, 1:]
    a, b = a - a.mean(axis=1, keepdims=True), b - b.mean(axis=1, keepdims=True)
    level = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    return np.where(level > 0, (a * b).sum(axis=1) / np.where(level > 0, level, 1), np.nan)


def dissolves(light: np.ndarray, tone: np.ndarray, change: np.ndarray, motion: np.ndarray, taken: list[tuple[int, int, str]], r: Rules) -> list[tuple[int, int, str]]:
    """Stretches around frames whose window mixes evenly, that no cut found before holds; ``change`` and ``motion`` are of neighbours."""
    n = len(light)
    width = min(r.reach, n // 5)
    half = width // 2
    if half < 1:
        return []
    busy, out, end = np.zeros(n + 1, np.int64), [], -1
    for a, b, _ in taken:
        busy[a] += 1
        busy[min(b + 1, n)] -= 1
    busy = np.cumsum(busy) > 0
    for start in range(width, n - width, CHUNK):
        i = np.arange(start, min(start + CHUNK, n - width))
        near, moves = (sliding_window_view(x, 2 * half)[i - 1 - half] for x in (change, motion))
        steps = [sliding_window_view(np.abs(np.diff(x)), 2 * half - 1)[i - half] for x in (light, tone)]
        exposure = (steps[0].var(axis=1) < r.alike) & (steps[1].var(axis=1) < r.alike) & (steps[0].mean(axis=1) > r.some)
        wide = np.full(len(i), np.nan)
        full = i - 1 >= width
        if full.any():
            wide[full] = follows(sliding_window_view(change, 2 * width)[i[full] - 1 - width])
        if not full.all():
            # The first window begins before the frames and is one shorter.
            cut = change[: 2 * width - 1][None]
            wide[~full] = follows(cut) if cut.shape[1] > 3 else 1.0
        good = (near.var(axis=1) < r.even) & (near.mean(axis=1) > r.some) & (moves.mean(axis=1) < r.motion) & ~exposure & (wide > r.follow)
        for k in i[good & ~busy[i]].tolist():
            if k > end:
                end = k + half
                out.append((k - half, end, "dissolve"))
    return out


def soft_cuts(df: DataFrame, key: str, order: list[str], light: str, tone: str, change: str, motion: str, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """key, kind, start and end (frame numbers) of a key's fades and dissolves. ``change`` and ``motion`` are those since the frame
    before; a null or NaN is 0. Keys of fewer than two frames have none."""

    def work(table: pa.Table) -> pa.Table:
        series.held(table, "frames")
        table = table.sort_by([(c, "ascending") for c in order])
        x, y, c, m = (np.nan_to_num(table[name].to_numpy().astype(np.float64)) for name in (light, tone, change, motion))
        rows = fades(x, y, rules) if len(x) > 1 else []
        rows += dissolves(x, y, c[1:], m[1:], rows, rules)
        rows.sort()
        return pa.table({key: pa.array([table[key][0].as_py()] * len(rows), pa.int64()), "kind": pa.array([k for *_, k in rows], pa.string()), "start": pa.array([a for a, *_ in rows], pa.int64()), "end": pa.array([b for _, b, _ in rows], pa.int64())})

    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), *order, *(F.col(c).cast("double").alias(c) for c in (light, tone, change, motion)))
    return rows.groupBy(key).applyInArrow(work, f"{key} long, kind string, start long, end long")
