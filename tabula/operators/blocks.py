"""Rows of numbers packed into blocks, for fits that scan them many times.

A block is one binary cell of some MB, so that a scan moves few rows between the
JVM and Python and its time is that of numpy. ``sums_to_rank`` finds sums over
the rows with the ``rank`` smallest values in one scan: values of a drawn sample
(held by the driver, a fixed number of rows) bracket the cut, rows below the
bracket are added up at once and those inside it per bin. The counts of all rows
decide where the cut lies; where it is outside the bracket, or the exact rank is
asked for and lies within a bin, the next scan has a wider or a finer bracket.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows from which packing pays.
PACKED_ROWS = 50_000
#: Bytes of a block.
BLOCK_BYTES = 8 << 20
#: Rows drawn to bracket a cut, and standard errors of their ranks on each side of it.
SAMPLE_ROWS, ERRORS = 20_000, 4.0
#: Bins of a bracket: about a ten-thousandth of the rows each, or finer for exact ranks.
BINS, FINE_BINS = 256, 4096
#: Brackets that are tried before a rank counts as out of reach.
TRIES = 400


class Packed:
    """Finite rows of the arrays ``column`` of ``df`` (``width`` numbers each,
    NaN for a missing one) in stored blocks, and a sample of them."""

    def __init__(self, df: DataFrame, column: str, width: int, rows: int, seed: int, form: Callable | None = None):
        """``form`` makes the numbers that are stored from the rows of a block;
        then there is no sample, and scans take the blocks as they are."""
        self.width, self.formed, block = width, form is not None, max(1, BLOCK_BYTES // (8 * width))
        form = form or (lambda x: x)
        cells = df.select(F.transform(column, lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))).alias("x"))

        def pack(batches):
            held, count = [], 0
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                held.append(x[np.isfinite(x).all(axis=1)])
                count += len(held[-1])
                if count >= block:
                    yield _bytes(form(np.concatenate(held)))
                    held, count = [], 0
            if count:
                yield _bytes(form(np.concatenate(held)))

        self.blocks = cells.mapInArrow(pack, "x binary").persist(StorageLevel.MEMORY_AND_DISK)
        if self.formed:
            return
        drawn = cells.sample(False, min(1.0, SAMPLE_ROWS / max(rows, 1)), seed).limit(2 * SAMPLE_ROWS).collect()
        x = np.array([r["x"] for r in drawn], dtype=np.float64).reshape(-1, width)
        self.sample = x[np.isfinite(x).all(axis=1)]

    def add_up(self, part: Callable, size: int, chunk: int = 0) -> np.ndarray:
        """Sum of ``part(rows, total)``, which adds ``chunk`` rows at a time (or a
        formed block) to the ``size`` numbers of its task; the tasks' sums are
        added by one more."""
        width, formed = self.width, self.formed

        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                for cell in batch.column(0):
                    if formed:
                        part(np.frombuffer(cell.as_buffer()), total)
                        continue
                    x = np.frombuffer(cell.as_buffer()).reshape(-1, width)
                    for at in range(0, len(x), chunk):
                        part(x[at:at + chunk], total)
            yield _bytes(total)

        return added(self.blocks.mapInArrow(run, "x binary"), size)

    def sums_to_rank(self, part: Callable, columns: int, chunk: int, values: np.ndarray, rank: int, share: float,
                     exact: bool = False, bracket: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per series a cut above about ``rank`` values (``exact``: just as many,
        and those equal to the last) and the sums of the terms of the rows below
        it. ``part(rows)`` gives values (series x rows) and terms (``columns`` x
        rows, the first is 1); ``values``: those of the sample; ``share``: of
        the rows that lie below the cut. ``bracket``: where to look first, in
        place of the sample."""
        series, bins = len(values), FINE_BINS if exact else BINS
        low, high = _bracket(values, share) if bracket is None else bracket
        cuts, sums, left = np.zeros(series), np.zeros((series, columns)), set(range(series))
        for _ in range(TRIES):
            edges = np.stack([np.linspace(a, b, bins + 1) for a, b in zip(low, high)])
            upto = np.cumsum(self._binned(part, columns, chunk, edges), axis=1)
            for i in sorted(left):
                counts, wide = upto[i, :, 0], high[i] - low[i]
                if counts[0] >= rank:
                    low[i], high[i] = low[i] - 64 * wide, low[i]
                elif counts[-1] < rank:
                    low[i], high[i] = high[i], high[i] + 64 * wide
                else:
                    j = int(np.searchsorted(counts, rank))
                    inner = edges[i, j - 1], edges[i, j]
                    if not exact or counts[j] == rank or inner == (low[i], high[i]) or np.nextafter(inner[0], np.inf) >= inner[1]:
                        cuts[i], sums[i] = edges[i, j], upto[i, j]
                        left.discard(i)
                    else:
                        low[i], high[i] = inner
            if not left:
                return cuts, sums
        raise ValueError(f"fewer than {rank} rows with a value")

    def _binned(self, part: Callable, columns: int, chunk: int, edges: np.ndarray) -> np.ndarray:
        """Sums of the terms below each bracket and in each of its bins: series x (1 + bins) x columns."""
        shape = len(edges), edges.shape[1], columns

        def add(x, total):
            total = total.reshape(shape)
            values, terms = part(x)
            total[:, 0] += (values < edges[:, :1]).astype(terms.dtype) @ terms.T
            for v, e, t in zip(values, edges, total):
                at = np.flatnonzero((v >= e[0]) & (v < e[-1]))
                if len(at):
                    place = np.searchsorted(e, v[at], "right")
                    order = np.argsort(place, kind="stable")
                    place = place[order]
                    first = np.flatnonzero(np.diff(place, prepend=-1))
                    t[place[first]] += np.add.reduceat(terms[:, at[order]], first, axis=1).T

        return self.add_up(add, int(np.prod(shape)), chunk).reshape(shape)

    def unpersist(self) -> None:
        self.blocks.unpersist()


def _bytes(x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"x": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())})


def added(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the arrays of ``size`` numbers in the cells of ``parts``, one per task."""
    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for cell in batch.column(0):
                total += np.frombuffer(cell.as_buffer())
        yield _bytes(total)

    # collected, as a limit would end the Python workers
    return np.frombuffer(bytes(parts.repartition(1).mapInArrow(add, "x binary").collect()[0][0])).copy()


def _bracket(values: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Values around the quantile ``share`` of every series of a sample."""
    m = values.shape[1]
    if not m:
        return np.zeros(len(values)), np.ones(len(values))
    ranked, off = np.sort(values, axis=1), ERRORS * np.sqrt(m * share * (1 - share)) + 1
    low = ranked[:, int(np.clip(m * share - off, 0, m - 1))]
    high = ranked[:, int(np.clip(m * share + off, 0, m - 1))]
    return low, np.maximum(high, low + 1e-6 * np.maximum(np.abs(low), 1e-3))
