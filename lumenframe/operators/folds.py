"""Folds that no window expresses: each row's outcome depends on what the fold decided before it."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Callable, Iterable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

ROWS_OUT = 4096


def folded(df: DataFrame, key: str, order: list[str], columns: list[str], schema: str, machine: Callable[[Iterable[tuple]], Iterator[tuple]]) -> DataFrame:
    """``machine`` turns a key's rows (``columns``, in order) into rows of ``schema`` but for the key, which comes first there.

    Rows stream through Spark's sort, which spills; a task holds a batch and what the machine remembers, never a whole key.
    """
    kinds = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)
    n = 1 + len(columns)

    def run(batches):
        rows = (row[:n] for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = ((k, *x) for k, own in itertools.groupby(rows, itemgetter(0)) for x in machine(row[1:] for row in own))
        while part := list(itertools.islice(out, ROWS_OUT)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), kinds, strict=True)], schema=kinds)

    rows = df.select(key, *columns, *(c for c in order if c not in columns)).repartition(key).sortWithinPartitions(key, *order)
    return rows.mapInArrow(run, schema)


def spread_peaks(apart: int) -> Callable:
    """(id,) of (time, height, id): the highest of close peaks, of equal ones the least id, and no other within ``apart``.

    Peaks that far from the one before never meet it, so a chain of close ones is held at a time.
    """

    def chosen(chain):
        order, taken = sorted(range(len(chain)), key=lambda k: (-chain[k][1], chain[k][2])), [False] * len(chain)
        for k in order:
            if not taken[k]:
                taken[k] = True
                yield chain[k][2]
                for step in (-1, 1):
                    n = k + step
                    while 0 <= n < len(chain) and abs(chain[n][0] - chain[k][0]) < apart:
                        taken[n] = True
                        n += step

    def machine(rows):
        chain = []
        for row in rows:
            if chain and row[0] - chain[-1][0] >= apart:
                yield from ((i,) for i in chosen(chain))
                chain = []
            chain.append(row)
        yield from ((i,) for i in chosen(chain))

    return machine


def scenes(base: float, typical: float, least: int) -> Callable:
    """(scene, first, n, total) of (id, duration): a scene ends when it is long enough, the longer for a short first shot."""

    def machine(rows):
        number, first, n, total, wanted = 0, None, 0, 0.0, 0.0
        for i, took in rows:
            if n and not (total < wanted or n < least):
                yield number, first, n, total
                number, n, total = number + 1, 0, 0.0
            if not n:
                first, wanted = i, base * (1.0 + 0.5 * (1.0 - took / typical))
            n, total = n + 1, total + took
        if n:
            yield number, first, n, total

    return machine


def flashes(shortest: int, longest: int) -> Callable:
    """(start, end) places of (change, threshold): entered at the threshold, left below its half or when too long."""

    def machine(rows):
        start = None
        for i, (change, limit) in enumerate(rows):
            if start is None:
                start = i if change >= limit else None
            elif change < 0.5 * limit or i - start + 1 > longest:
                if shortest <= i - start + 1 <= longest:
                    yield start, i
                start = None

    return machine


def matched(within: int) -> Callable:
    """(ref_n, pred_n, tp) of (time, is_ref): each prediction, in order, takes the nearest free reference within ``within``.

    A prediction waits until no reference can come that is near enough; only times that close are remembered.
    """

    def machine(rows):
        refs, waiting, n_ref, n_pred, tp = [], [], 0, 0, 0

        def settle():
            at = waiting.pop(0)
            refs[:] = [x for x in refs if x >= at - within]
            near = [x for x in refs if x <= at + within]
            if near:
                refs.remove(min(near, key=lambda x: (abs(x - at), x)))
            return bool(near)

        for t, is_ref in rows:
            while waiting and waiting[0] + within < t:
                tp += settle()
            if is_ref:
                n_ref += 1
                if not waiting:
                    refs[:] = [x for x in refs if x >= t - 2 * within]
                refs.append(t)
            else:
                n_pred += 1
                waiting.append(t)
        while waiting:
            tp += settle()
        yield n_ref, n_pred, tp

    return machine


def bursts(within: float, least: int) -> Callable:
    """(bursts,) of times: from each start all that follow ``within`` are taken together, the next one starts anew."""

    def machine(rows):
        start, n, found = None, 0, 0
        for (t,) in rows:
            if start is None or t - start > within:
                found, start, n = found + (n >= least), t, 0
            n += 1
        yield (found + (n >= least),)

    return machine


def bounded_segments(gap: float, longest: float) -> Callable:
    """(start, end, n) of times: a segment ends at a step longer than ``gap``, or ``longest`` after its start."""

    def machine(rows):
        start, last, n = None, None, 0
        for (t,) in rows:
            if start is None or t - last > gap or t - start > longest:
                if n:
                    yield start, last, n
                start, n = t, 0
            last, n = t, n + 1
        if n:
            yield start, last, n

    return machine


def overlap_of(a: tuple, b: tuple) -> float:
    """Intersection over union of boxes (x1, y1, x2, y2)."""
    inter = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    return inter / max((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter, 1e-6)


def tracked(least: float, back: int) -> Callable:
    """(id, track) of (id, frame, x1, y1, x2, y2): a box joins the track of ``back`` frames before whose latest box overlaps it
    most, above ``least``; else it begins a track."""

    def machine(rows):
        count, recent = 0, []
        for i, frame, *box in rows:
            recent = [x for x in recent if x[0] >= frame - back]
            latest = {track: own for _, track, own in recent}
            best, found = least, None
            for track in dict.fromkeys(t for at, t, _ in recent if at < frame):
                if (got := overlap_of(box, latest[track])) > best:
                    best, found = got, track
            if found is None:
                count += 1
                found = count
            recent.append((frame, found, tuple(box)))
            yield i, found

    return machine


def likeness(a: str, b: str) -> float:
    """1 - edit distance / greater length."""
    if a == b or not a or not b:
        return float(a == b)
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


class Middle:
    """The median of numbers that come one by one, from a heap of the lower half and one of the upper."""

    def __init__(self):
        self.low, self.high = [], []

    def add(self, x: float) -> float:
        if self.low and x > -self.low[0]:
            heapq.heappush(self.high, x)
        else:
            heapq.heappush(self.low, -x)
        if len(self.low) > len(self.high) + 1:
            heapq.heappush(self.high, -heapq.heappop(self.low))
        elif len(self.high) > len(self.low):
            heapq.heappush(self.low, -heapq.heappop(self.high))
        return -self.low[0] if len(self.low) > len(self.high) else (self.high[0] - self.low[0]) / 2


class Boxes:
    """Boxes by number, found by overlap: each lies in the cell of its centre, in a grid of its own width's and height's power of two.

    If two boxes' intersection is a share ``t`` (over 0.5) of their union, their widths differ by less than 1 / t, a factor under
    two, and their centres by (1 - t) of the greater width at most; heights alike. So few cells are looked into.
    """

    def __init__(self, t: float):
        self.t, self.cells, self.of = t, {}, {}

    @staticmethod
    def spans(box):
        return ((box[2] - box[0], (box[0] + box[2]) / 2), (box[3] - box[1], (box[1] + box[3]) / 2))

    def put(self, n: int, box) -> None:
        cell = None
        if all(size > 0 for size, _ in self.spans(box)):
            cell = tuple((level := math.frexp(size)[1], math.floor(at / 2.0**level)) for size, at in self.spans(box))
        if self.of.get(n) != cell:
            if self.of.get(n) is not None:
                self.cells[self.of[n]].discard(n)
            if cell is not None:
                self.cells.setdefault(cell, set()).add(n)
            self.of[n] = cell

    def near(self, box) -> list[int]:
        """The numbers of all boxes that may overlap this one by the share, in order."""
        sides = []
        for size, at in self.spans(box):
            if size <= 0:
                return []
            reach = (1 - self.t) * size / self.t
            level = math.frexp(size)[1]
            sides.append([(k, c) for k in (level - 1, level, level + 1) for c in range(math.floor((at - reach) / 2.0**k), math.floor((at + reach) / 2.0**k) + 1)])
        return sorted(n for x in sides[0] for y in sides[1] for n in self.cells.get((x, y), ()))


def captions(overlap: float, least: float) -> Callable:
    """(id, element) of (id, text, x1, y1, x2, y2): a detection joins the element whose middle box overlaps it by ``overlap`` (over 0.5)
    or more with the best mean of overlap and likeness above ``least``, of equal ones the first; else it begins one.

    An element keeps its text and the numbers of its boxes in heaps; a detection is held against the elements in its reach only.
    """
    if overlap <= 0.5:
        raise ValueError("boxes are found by an overlap of more than half")

    def machine(rows):
        elements: list[tuple[str, list[Middle]]] = []
        boxes, middles = Boxes(overlap), []
        for i, text, *box in rows:
            best, found = least, None
            for n in boxes.near(box):
                middle = middles[n]
                area = (box[2] - box[0]) * (box[3] - box[1]) + (middle[2] - middle[0]) * (middle[3] - middle[1])
                inter = max(0.0, min(box[2], middle[2]) - max(box[0], middle[0])) * max(0.0, min(box[3], middle[3]) - max(box[1], middle[1]))
                got = inter / (area - inter + 1e-6)
                if got >= overlap and 0.5 * got + 0.5 > best and (score := 0.5 * got + 0.5 * likeness(text, elements[n][0])) > best:
                    best, found = score, n
            if found is None:
                found = len(elements)
                elements.append((text, [Middle() for _ in box]))
                middles.append(None)
            middles[found] = tuple(m.add(v) for m, v in zip(elements[found][1], box, strict=True))
            boxes.put(found, middles[found])
            yield i, found

    return machine
