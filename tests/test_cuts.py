"""Soft cuts and caption groups against plain loops."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.operators import cuts as K
from lumenframe.operators import folds
from lumenframe.plans import curve_queries
from lumenframe.plans.catalogue import QUERIES


def brute_cuts(light, tone, change, motion, r):
    """Frame by frame, as the rules are stated."""
    n, out = len(light), []

    def steps(x):
        d = [0, 0, *(b - a for a, b in zip(x[:-1], x[1:], strict=True)), 0, 0]
        return [abs(statistics.median(d[i : i + 5])) for i in range(len(x) - 1)]

    a, b = steps(light), steps(tone)
    i = 0
    while i < len(a):
        j = i
        if a[i] < r.still and b[i] < r.still:
            while j < len(a) and a[j] < r.quiet and b[j] < r.quiet:
                j += 1
            if j - i >= r.least and (abs(light[j] - light[i]) > r.change or abs(tone[j] - tone[i]) > r.change):
                out.append((i, j, "fade_in" if light[j] > light[i] else "fade_out"))
        i = max(j, i + 1)
    width = min(r.reach, n // 5)
    half = width // 2
    for i in range(width, n - width) if half else ():
        near, moves = change[i - 1 - half : i - 1 + half], motion[i - 1 - half : i - 1 + half]
        grown = [np.abs(np.diff(x[i - half : i + half])) for x in (light, tone)]
        exposure = grown[0].var() < r.alike and grown[1].var() < r.alike and grown[0].mean() > r.some
        full = change[max(0, i - 1 - width) : i - 1 + width]
        with np.errstate(all="ignore"):
            mixes = np.corrcoef(full[:-1], full[1:])[0, 1] > r.follow if len(full) > 3 else True
        if np.var(near) < r.even and np.mean(near) > r.some and np.mean(moves) < r.motion and not exposure and mixes and not any(a <= i <= b for a, b, _ in out):
            out.append((i - half, i + half, "dissolve"))
    return sorted(out)


@pytest.mark.filterwarnings("ignore")
def test_cuts_against_plain_loops(spark, sf):
    rng = np.random.default_rng(1)
    found = []
    for trial in range(120):
        n = int(rng.integers(2, 160))
        t = np.arange(n)
        light = np.cumsum(rng.normal(0, 0.004, n)) + 0.3 * np.clip((t - n / 3) / 20, 0, 1) * (-1) ** trial
        light[rng.integers(0, n, 2)] += 0.5
        tone = light * 0.8 + rng.normal(0, 0.003, n)
        change, motion = np.abs(np.convolve(rng.normal(0, 0.05, n), np.ones(9) / 3, "same")), rng.uniform(0, 3.2, n)
        r = K.Rules(least=int(rng.integers(2, 6)), change=0.05)
        got = K.fades(light, tone, r)
        got = sorted(got + K.dissolves(light, tone, change[1:], motion[1:], got, r))
        assert got == brute_cuts(light, tone, change[1:], motion[1:], r)
        found += [k for *_, k in got]
    assert min(map(found.count, ("fade_in", "fade_out", "dissolve"))) > 10
    got = QUERIES["e7_soft_cuts"](spark, sf).collect()
    kinds = {r["kind"] for r in got}
    assert "dissolve" in kinds and kinds & {"fade_in", "fade_out"} and all(0 <= r["start"] < r["end"] for r in got)


def brute_captions(rows, overlap, least):
    """Each detection against all elements, whose middle boxes are medians of all their boxes."""
    elements, out = [], []
    for text, box in rows:
        best, found = least, None
        for n, (own, boxes) in enumerate(elements):
            m = [statistics.median(v) for v in zip(*boxes, strict=True)]
            inter = max(0.0, min(box[2], m[2]) - max(box[0], m[0])) * max(0.0, min(box[3], m[3]) - max(box[1], m[1]))
            got = inter / ((box[2] - box[0]) * (box[3] - box[1]) + (m[2] - m[0]) * (m[3] - m[1]) - inter + 1e-6)
            if got >= overlap and (score := 0.5 * got + 0.5 * folds.likeness(text, own)) > best:
                best, found = score, n
        if found is None:
            found = len(elements)
            elements.append((text, []))
        elements[found][1].append(box)
        out.append(found)
    return out


def test_caption_groups_against_all_elements(spark, sf):
    rng = random.Random(2)
    for _ in range(30):
        rows = []
        for _ in range(200):
            x, y, w, h = rng.choice([0, 5, 30, -60]) + rng.uniform(0, 6), rng.uniform(-5, 5), rng.choice([8, 16, 31, 0]) * rng.uniform(0.9, 1.1), rng.choice([4, 9]) * rng.uniform(0.9, 1.1)
            rows.append((rng.choice(["sale now", "sale now!", "subscribe", "news"]), (x, y, x + w, y + h)))
        got = [n for _, n in folds.captions(0.6, 0.8)([(i, t, *b) for i, (t, b) in enumerate(rows)])]
        assert got == brute_captions(rows, 0.6, 0.8) and len(set(got)) > 10
    events = curve_queries.timed(spark, sf).filter("user_id = 3").orderBy("t", "event_id").select("event_id", "event_type").collect()
    rows = []
    for i, kind in events:
        x, y = i * 37 % 4 * 30, i * 11 % 3 * 20
        rows.append((kind + "!" * (i % 2), (x + i % 3, y, x + 40 + i % 5, y + 15 + i % 2)))
    got = {r["event_id"]: r["element"] for r in QUERIES["j8_caption_groups"](spark, sf).filter(F.col("user_id") == 3).collect()}
    assert [got[i] for i, _ in events] == brute_captions(rows, 0.6, 0.8)
    with pytest.raises(ValueError, match="more than half"):
        folds.captions(0.5, 0.8)
