"""Operators on a key's ordered values as vectors: leaps, the best lag, the strongest period."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of one key that a task holds at most, 8 bytes each and some copies.
MOST = 50_000_000


def leaps(df: DataFrame, key: str, time: str, step: int) -> DataFrame:
    """key, t, n: the times that are ``step`` or more after the last kept one, the first being kept, with how many rows each took
    in. Whole numbers; rows stream through Spark's sort, a task holds a batch and one open time."""

    def run(batches):
        own, start, n, kind = None, 0, 0, None
        for batch in filter(len, batches):
            out, keys, times, kind = [], batch[key], batch[time].to_numpy(), batch[key].type
            ends = np.flatnonzero(np.diff(keys.dictionary_encode().indices.to_numpy(zero_copy_only=False))) + 1 if len(keys) > 1 else []
            for a, b in zip([0, *ends], [*ends, len(keys)], strict=True):
                t, k = times[a:b], keys[int(a)].as_py()
                at = 0
                if k != own or n == 0:
                    if n:
                        out.append((own, start, n))
                    own, start, n = k, int(t[0]), 0
                while True:
                    to = at + int(np.searchsorted(t[at:], start + step, side="left"))
                    n += to - at
                    if to == len(t):
                        break
                    out.append((own, start, n))
                    at, start, n = to, int(t[to]), 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())], names=[key, "t", "n"])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([own], kind), pa.array([start], pa.int64()), pa.array([n], pa.int64())], names=[key, "t", "n"])

    rows = df.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).cast("long").alias(time))
    return rows.repartition(key).sortWithinPartitions(key, time).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, t long, n long")


def held(table: pa.Table, what: str) -> None:
    if table.num_rows > MOST:
        raise ValueError(f"{table.num_rows} {what} for one key; {MOST} are held at most")


def best_lag(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """key, lag, correlation: of all lags of a row or more, the first with the greatest autocorrelation of a key's values; keys of
    one row have none."""

    def work(table: pa.Table) -> pa.Table:
        held(table, "values")
        x = table.sort_by([(c, "ascending") for c in order])[value].to_numpy()
        lag, best = [], []
        if len(x) > 1:
            x = x - x.mean()
            wide = 1 << (2 * len(x) - 1).bit_length()
            c = np.fft.irfft(np.abs(np.fft.rfft(x, wide)) ** 2, wide)[: len(x)]
            k = 1 + int(np.argmax(c[1:]))
            lag, best = [k], [float(c[k] / c[0]) if c[0] > 0 else 0.0]
        return pa.table({key: table[key][: len(lag)].cast(pa.int64()), "lag": pa.array(lag, pa.int64()), "correlation": pa.array(best, pa.float64())})

    return df.select(F.col(key).cast("long").alias(key), *order, F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull()).groupBy(key).applyInArrow(work, f"{key} long, lag long, correlation double")


def strongest_period(counts: DataFrame, key: str, place: str, value: str, slowest: float, fastest: float) -> DataFrame:
    """key, cycles, period, significance of counts at whole places (absent ones are 0): the frequency of the greatest power
    between ``slowest`` and ``fastest`` cycles a place, detrended under a Hann window, over the median power there. Keys
    without a frequency in the band have no row. What is held follows the places' span, not the rows counted."""

    def work(table: pa.Table) -> pa.Table:
        at, v = table[place].to_numpy(), table[value].to_numpy().astype(np.float64)
        n = int(at.max() - at.min()) + 1 if len(at) else 0
        if n > MOST:
            raise ValueError(f"{n} places for one key; {MOST} are held at most")
        rows = []
        k = np.arange(1, (n + 1) // 2)
        k = k[(k / max(n, 1) > slowest) & (k / max(n, 1) < fastest)]
        if len(k):
            x, i = np.zeros(n), np.arange(n)
            x[at - at.min()] = v
            slope, cut = np.polyfit(i, x, 1)
            power = np.abs(np.fft.rfft((x - cut - slope * i) * np.hanning(n)))[k] ** 2
            top = int(np.argmax(power))
            rows = [(int(k[top]), n / int(k[top]), float(power[top] / (np.median(power) + 1e-10)))]
        return pa.table({key: table[key][: len(rows)], "cycles": pa.array([x[0] for x in rows], pa.int64()), "period": pa.array([x[1] for x in rows], pa.float64()), "significance": pa.array([x[2] for x in rows], pa.float64())})

    return counts.select(key, F.col(place).cast("long").alias(place), F.col(value).cast("double").alias(value)).groupBy(key).applyInArrow(work, f"{key} {counts.schema[key].dataType.simpleString()}, cycles long, period double, significance double")


def local_peaks(x: np.ndarray) -> np.ndarray:
    """Places of the values higher than both neighbours; of a level stretch the middle one."""
    if len(x) < 3:
        return np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], np.diff(x) != 0]))
    ends = np.append(starts[1:], len(x)) - 1
    v = x[starts]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (starts[top] + ends[top]) // 2


def apart(at: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    """Which peaks stay when none may be closer than ``distance`` to a higher one that stays; of equal ones the last goes first."""
    keep = np.ones(len(at), bool)
    for k in np.argsort(height, kind="stable")[::-1]:
        if keep[k]:
            for step in (-1, 1):
                n = k + step
                while 0 <= n < len(at) and abs(at[n] - at[k]) < distance:
                    keep[n] = False
                    n += step
    return keep


def prominences(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How far each peak stands above the higher of the lowest values on its sides, up to the next higher value or the end."""

    def lowest(values: np.ndarray) -> np.ndarray:
        """At each place, the least value since the last higher one: a stack of falling values, each with the least since it."""
        out, stack = np.empty(len(values)), []
        for i, v in enumerate(values.tolist()):
            least = v
            while stack and stack[-1][0] <= v:
                least = min(least, stack.pop()[1])
            out[i] = least
            stack.append((v, least))
        return out

    return x[at] - np.maximum(lowest(x)[at], lowest(x[::-1])[::-1][at])


def find_peaks(x: np.ndarray, distance: int = 1, prominence: float = 0.0) -> np.ndarray:
    at = local_peaks(x)
    at = at[apart(at, x[at], distance)]
    return at[prominences(x, at) >= prominence] if len(at) else at


def normed(x: np.ndarray) -> np.ndarray:
    return (x - x.min()) / (x.max() - x.min()) if len(x) and x.max() > x.min() else x


def keyframes(df: DataFrame, key: str, order: list[str], sigma: float = 5 / 3, prominence: float = 0.1, distance: int = 8) -> DataFrame:
    """key, place, kind, score: peaks of the smoothed intensity of (valence, arousal) and of its change, each between 0 and 1; of
    two at one place the higher score stays, an emotion_peak before a transition of the same."""
    reach = int(4 * sigma + 0.5)
    taps = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    taps /= taps.sum()

    def smooth(x):
        return np.convolve(np.concatenate([np.full(reach, x[0]), x, np.full(reach, x[-1])]), taps, "valid")

    def work(table: pa.Table) -> pa.Table:
        held(table, "frames")
        table = table.sort_by([(c, "ascending") for c in order])
        v, a = (smooth(table[c].to_numpy()) for c in ("valence", "arousal"))
        found = {}
        level, change = normed(np.hypot(v, a)), normed(np.hypot(np.diff(v), np.diff(a)))
        for k in find_peaks(level, distance, prominence).tolist():
            found[k] = ("emotion_peak", float(level[k]))
        for k in find_peaks(change, distance, prominence).tolist():
            if k + 1 not in found or change[k] > found[k + 1][1]:
                found[k + 1] = ("transition", float(change[k]))
        places = sorted(found)
        return pa.table({key: pa.array([table[key][0].as_py()] * len(places), pa.int64()), "place": pa.array(places, pa.int64()), "kind": pa.array([found[k][0] for k in places], pa.string()), "score": pa.array([found[k][1] for k in places], pa.float64())})

    return df.select(F.col(key).cast("long").alias(key), *order, *(F.col(c).cast("double").alias(c) for c in ("valence", "arousal"))).groupBy(key).applyInArrow(work, f"{key} long, place long, kind string, score double")
