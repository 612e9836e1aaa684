"""Approximate nearest neighbours (largest inner product) by balanced posting lists.

Index: centroids come from a bounded sample (``SAMPLE_PER_LIST`` vectors a
list, ``MAX_SAMPLE`` at most), cut in equal halves along the main spread until
a part holds one list's share, so lists are balanced on the sample.  Distances
to centroids are a matrix product; where there are so many lists that a walk is
cheaper, the centroids are linked in a neighbour graph, which is walked
best-first.  Every vector of the table is indexed: it is put in the list of
its nearest centroid and, near a boundary, in those whose distance is within
``REPLICATE`` of the nearest (``COPIES`` at most).

Search: a query takes its nearest lists, without those further than ``PRUNE``
times the nearest.  Neighbouring lists make a region, one task's postings; a
query is sent once to each region with a list of its own (lists are added where
they hold few vectors).  There it meets these lists alone: blocks of both are multiplied as matrices in single precision, the
largest products of groups of postings give a bound that the k + 1 largest
reach, and only products that may reach it, given the rounding error, are
summed component by component in double precision, which gives the score.

How many lists, which ratio and how many copies a search needs depends on the
vectors (spread out ones, or norms that differ much, need far more lists), so
they are measured: ``TUNE`` queries are searched by brute force in one pass
over the table, and probes and ratio are raised from ``PROBES`` and ``PRUNE``
until their lists hold the share ``RECALL`` of these queries' true neighbours
and some more, for the error of so few queries -- all lists if need be.  This is done for each number of copies up to
``COPIES``, and the cheapest is taken: copies spare probes, but are moved.

Inner product becomes distance by one added component (sqrt(M^2 - |x|^2), M the
largest norm).  Equal vectors are one posting with their ``k + 1`` smallest
ids, so a vector in a third of all rows is searched once and expanded at the
end.  Lists that outgrow a region are salted into several.

Defined results: vectors that are null, zero, hold null or non-finite values,
or have another length than most take no part; a vec_id given twice with the
same vector counts once; ties go to the smaller vec_id; fewer candidates than
k give all of those found.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import freed, stage

LIST = 100                  # vectors meant for a list (without replicas)
MAX_LISTS = 16_384
SAMPLE_PER_LIST = 40
MAX_SAMPLE = 200_000
COPIES = 4
REPLICATE = 1.10
PRUNE = 1.35
PROBES = 48                 # lists searched for a query, before tuning
TUNE = 128                  # queries whose true neighbours set probes and ratio
RECALL = 0.99               # share of these neighbours that the searched lists hold
DEGREE = 24
GATHERED = 64               # products of a matrix in the time of one distance to a linked centroid
REGION = 262_144            # postings of a region at most
LEAST_REGION = 4_096
ENOUGH = 8                  # times the vectors wanted that a query's lists hold
GROUP = 32                  # postings of which the largest product is noted, or more if a region would have over GROUPS groups
GROUPS = 2_048
PAIR_S = 5e-9               # CPU seconds of a query and a posting that meet
POSTING_S = 100e-6          # of a posting that is moved (20e-6), and what its place on disk is worth
EPS = float(np.finfo(np.float32).eps)
CELLS = 4_000_000           # of a matrix at once


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """``lists`` means of parts of x, cut in halves along the direction of largest spread; neighbouring parts are side by side."""
    parts, made = [(-len(x), 0, 0.0, 1.0, x)], 1
    while len(parts) < lists and -parts[0][0] >= 2:
        _, _, at, wide, p = heapq.heappop(parts)
        c = p - p.mean(0)
        v = c[np.argmax((c ** 2).sum(1))]
        for _ in range(6):                      # power iteration
            v = c.T @ (c @ v)
            v /= np.linalg.norm(v) or 1.0
        order = np.argsort(c @ v, kind="stable")
        for half, lo in ((order[:len(p) // 2], at), (order[len(p) // 2:], at + wide / 2)):
            heapq.heappush(parts, (-len(half), made, lo, wide / 2, p[half]))
            made += 1
    return np.array([p.mean(0) for *_, p in sorted(parts, key=lambda part: part[2:4]) if len(p)])


def _lloyd(x: np.ndarray, c: np.ndarray, rounds: int = 3) -> np.ndarray:
    for _ in range(rounds):
        graph = CentroidGraph(c)
        near = np.concatenate([np.argmin(e, axis=1) for _, e, _ in graph.blocks(x)])
        n = np.bincount(near, minlength=len(c))
        s = np.zeros(c.shape)
        np.add.at(s, near, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


class CentroidGraph:
    """Centroids: distances to all of them, or a best-first search of a neighbour graph where that is cheaper.

    Distances are taken from the centroids' mean in single precision; ``blocks`` gives them less each vector's own
    squared distance from that mean.
    """

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.mean = centroids.mean(0).astype(np.float64)
        self.c = (centroids - self.mean).astype(np.float32)
        self.sq = (self.c ** 2).sum(1)
        self.twice = np.ascontiguousarray(-2 * self.c.T)
        self.degree = min(degree, max(len(self.c) - 1, 0))
        self.links = None

    def around(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x from the mean, and its squared length."""
        x = (x - self.mean).astype(np.float32)
        return x, (x ** 2).sum(1)

    def noise(self, xs: np.ndarray) -> np.ndarray:
        """What rounding may add to a squared distance."""
        return 8 * EPS * (xs + self.sq.max())

    def blocks(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, squared distances to all centroids less ``xs``, xs) of blocks of rows."""
        step = max(16, CELLS // max(len(self.c), 1))
        for lo in range(0, len(x), step):
            y, xs = self.around(x[lo:lo + step])
            e = y @ self.twice
            e += self.sq
            yield lo, e, xs

    def limits(self, e: np.ndarray, xs: np.ndarray, probes: int, ratio: float, held: np.ndarray | None = None, least: float = 0) -> np.ndarray:
        """What a block's distances are held against, so that at most ``probes`` lists within ``ratio`` of the nearest stay.

        Where those of the lists hold less than ``least``, as beside a vector that is a list's centroid, the nearest that do stay.
        """
        xs = xs.astype(np.float64)
        with np.errstate(over="ignore"):
            limit = ratio ** 2 * np.maximum(e.min(1) + xs, 0) - xs + self.noise(xs)
        if probes < e.shape[1]:
            last = np.partition(e, (probes - 1, probes), axis=1)[:, probes - 1:probes + 1]
            limit = np.minimum(limit, last.mean(1, dtype=np.float64))
        limit = np.minimum(limit, np.finfo(np.float32).max)
        if held is not None:
            few = np.flatnonzero((e <= limit.astype(np.float32)[:, None]) @ held.astype(np.float32) < least)
            near = np.argsort(e[few], axis=1, kind="stable")
            enough = np.minimum((np.cumsum(held[near], axis=1) < least).sum(1), e.shape[1] - 1)
            limit[few] = np.maximum(limit[few], e[few, near[np.arange(len(few)), enough]] + self.noise(xs[few]))
        return limit

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances) of the ``width`` nearest centroids (by the walk: of those found), nearest first."""
        n = len(self.c)
        width = min(width, n)
        if n > GATHERED * (self.degree + 5) * (width + 8):
            return self.walk(x, width)
        ids, ds = np.empty((len(x), width), np.int64), np.empty((len(x), width), np.float32)
        for lo, e, xs in self.blocks(x):
            if width <= 8:
                near, rows = np.empty((len(e), width), np.int64), np.arange(len(e))
                d = np.empty((len(e), width), np.float32)
                for j in range(width):
                    near[:, j] = e.argmin(1)
                    d[:, j] = e[rows, near[:, j]]
                    e[rows, near[:, j]] = np.inf
            else:
                near = np.argsort(e, axis=1, kind="stable")[:, :width]
                d = np.take_along_axis(e, near, 1)
            ids[lo:lo + len(e)], ds[lo:lo + len(e)] = near, np.maximum(d + xs[:, None], 0)
        return ids, ds

    def link(self) -> None:
        n, k = len(self.c), self.degree
        links = np.zeros((n, k), np.int64)
        for lo, e, _ in self.blocks(self.c + self.mean):
            e[np.arange(len(e)), np.arange(lo, lo + len(e))] = np.inf
            links[lo:lo + len(e)] = np.argpartition(e, k - 1, axis=1)[:, :k] if k else links[lo:lo + len(e)]
        far = np.random.default_rng(7).integers(0, max(n, 1), (n, min(4, k)))   # long links keep the graph connected
        ring = ((np.arange(n) + 1) % max(n, 1))[:, None]
        self.links = np.concatenate((links, far, ring), axis=1)
        self.entries = np.arange(0, n, max(1, n // 64))[:128]

    def walk(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """``search`` by the links, nearest first, for blocks of vectors at once."""
        if self.links is None:
            self.link()
        width = min(width, len(self.c))
        step = max(16, CELLS // max(len(self.c), 1))
        found = [self._walk(x[lo:lo + step], width) for lo in range(0, len(x), step)]
        if not found:
            return np.empty((0, width), np.int64), np.empty((0, width), np.float32)
        return tuple(np.concatenate(part) for part in zip(*found))

    def _walk(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, b = len(self.c), len(x)
        x, xs = self.around(x)

        def dist(ids):
            return xs[:, None] + self.sq[ids] - 2 * np.einsum("bd,bkd->bk", x, self.c[ids])

        start = np.broadcast_to(self.entries, (b, len(self.entries)))
        d = xs[:, None] + self.sq[self.entries] - 2 * x @ self.c[self.entries].T
        pool = max(width, 1)
        order = np.argsort(d, axis=1)[:, :pool]
        ids, ds = np.take_along_axis(start, order, 1), np.take_along_axis(d, order, 1)
        if ids.shape[1] < pool:
            pad = pool - ids.shape[1]
            ids = np.concatenate((ids, np.full((b, pad), -1)), 1)
            ds = np.concatenate((ds, np.full((b, pad), np.inf)), 1)
        seen = np.zeros((b, n), bool)           # bounded: walk() passes blocks of vectors
        np.put_along_axis(seen, start, True, 1)
        opened = np.zeros((b, n), bool)
        rows = np.arange(b)
        while True:
            open_d = np.where((ids >= 0) & ~opened[rows[:, None], ids], ds, np.inf)
            best = open_d.argmin(1)
            live = np.isfinite(open_d[rows, best])
            if not live.any():
                break
            node = np.where(live, ids[rows, best], 0)
            opened[rows[live], node[live]] = True
            nb = self.links[node]
            fresh = ~seen[rows[:, None], nb] & live[:, None]
            seen[rows[:, None], nb] |= live[:, None]
            # the same neighbour may be linked twice
            nb_sorted = np.sort(np.where(fresh, nb, -1), axis=1)
            dup = np.concatenate((np.zeros((b, 1), bool), nb_sorted[:, 1:] == nb_sorted[:, :-1]), 1)
            nb = np.where(dup, -1, nb_sorted)
            nd = np.where(nb >= 0, dist(np.maximum(nb, 0)), np.inf)
            all_i, all_d = np.concatenate((ids, nb), 1), np.concatenate((ds, nd), 1)
            order = np.argpartition(all_d, pool - 1, axis=1)[:, :pool]
            ids, ds = np.take_along_axis(all_i, order, 1), np.take_along_axis(all_d, order, 1)
        order = np.argsort(ds, axis=1)
        return np.take_along_axis(ids, order, 1), np.maximum(np.take_along_axis(ds, order, 1), 0)


def _near_lists(graph: CentroidGraph, x: np.ndarray, width: int, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, place) of the ``width`` nearest lists within ``ratio`` of each row's nearest centroid; the nearest has place 0."""
    ids, d = graph.search(x, width)
    xs = np.concatenate([((x[lo:lo + 8192] - graph.mean) ** 2).sum(1) for lo in range(0, len(x), 8192)] or [np.zeros(0)])
    rows, place = np.nonzero((ids >= 0) & (d <= ratio ** 2 * d[:, :1] + graph.noise(xs)[:, None]))
    return rows, ids[rows, place], place


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lifted(x: np.ndarray, norm2: np.ndarray | float, top: float, scale: float) -> np.ndarray:
    """``scale`` times x with the added component; that of a query is 0 (``norm2`` is top)."""
    lift = np.sqrt(np.maximum(top - norm2, 0)) * np.ones(len(x))
    return np.concatenate((x, lift[:, None]), 1) * scale


def _exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component, so a pair's score never depends on its place."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def _best(qi: np.ndarray, xi: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest products of each query, in order, a vector once, ties to the smaller xi."""
    order = np.lexsort((xi, -s, qi))
    qi, xi, s = qi[order], xi[order], s[order]
    other = np.ones(len(qi), bool)
    other[1:] = (qi[1:] != qi[:-1]) | (xi[1:] != xi[:-1])
    qi, xi, s = qi[other], xi[other], s[other]
    new = np.ones(len(qi), bool)
    new[1:] = qi[1:] != qi[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    best = np.arange(len(qi)) - first < k
    return qi[best], xi[best], s[best]


def _largest(q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, product) of each q's k largest products, ties to the first row of x.

    A matrix product finds those that may be among them, given its rounding error; their products are
    then summed exactly as ever.
    """
    k = min(k, len(x))
    s = q @ x.T
    least = np.partition(s, len(x) - k, axis=1)[:, len(x) - k]
    error = 2 * q.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    qi, xi = np.nonzero(s >= (least - 2 * error)[:, None])
    return _best(qi, xi, _exact_products(q[qi], x[xi]), k)


def _may_reach(qi: np.ndarray, s: np.ndarray, need: int, slack: np.ndarray) -> np.ndarray:
    """Places of the products that may be among each query's ``need`` largest, when rounding moves them by ``slack`` of the query."""
    order = np.lexsort((-s, qi))
    qi, s = qi[order], s[order]
    new = np.ones(len(qi), bool)
    new[1:] = qi[1:] != qi[:-1]
    first = np.flatnonzero(new)
    last = np.minimum(first + need, np.append(first[1:], len(qi))) - 1
    return order[s >= np.repeat(s[last] - slack[qi[first]], np.diff(np.append(first, len(qi))))]


class _Unit:
    """Postings of one list that came together: their ids and vectors, the place of their list and of their groups in the region."""

    def __init__(self, at: int, ids: np.ndarray, raw: np.ndarray, x: np.ndarray):
        self.at, self.ids, self.raw, self.x, self.group, self.groups = at, ids, raw, x, 0, 1

    def group_largest(self, s: np.ndarray) -> np.ndarray:
        """Largest product of each group; every posting is in one group."""
        size = len(s) // self.groups
        rest = len(s) - size * self.groups
        out = s[:size * self.groups].reshape(self.groups, size, -1).max(1)
        if rest:
            np.maximum(out[:rest], s[size * self.groups:], out=out[:rest])
        return out


class Region:
    """Postings of neighbouring lists, and the search of their largest products."""

    def __init__(self, graph: CentroidGraph, dim: int, scale: float):
        self.graph, self.dim, self.scale = graph, dim, scale
        self.units, self.lists, self.groups, self.largest = [], [], 0, 0.0

    def scaled(self, raw: np.ndarray) -> np.ndarray:
        """Single precision, small enough to be multiplied; the vectors themselves if they are so already."""
        return raw.astype(np.float32, copy=False) if self.scale == 1 else (raw.astype(np.float64) * self.scale).astype(np.float32)

    def add(self, lists: np.ndarray, ids: np.ndarray, raw: np.ndarray) -> None:
        """Postings in the order of their lists."""
        x = self.scaled(raw)
        self.largest = max(self.largest, float(np.linalg.norm(x.astype(np.float64), axis=1).max()))
        for lo, hi in _runs(lists):
            if not self.lists or self.lists[-1] != lists[lo]:
                self.lists.append(int(lists[lo]))
            self.units.append(_Unit(len(self.lists) - 1, ids[lo:hi], raw[lo:hi], x[lo:hi]))
        self.groups = 0

    def step(self) -> int:
        """Queries searched at once; sets the groups when all postings are there."""
        if not self.groups:
            size = max(GROUP, sum(len(u.x) for u in self.units) // GROUPS)
            for u in self.units:
                u.group, u.groups = self.groups, -(-len(u.x) // size)
                self.groups += u.groups
        return int(min(4096, max(64, CELLS // self.groups)))

    def search(self, raw: np.ndarray, limit: np.ndarray, keep: int, copies: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, product) of the ``keep`` largest products with the lists in each query's limit."""
        self.step()
        q, lists = self.scaled(raw), np.array(self.lists)
        y, _ = self.graph.around(np.concatenate((raw.astype(np.float64) * self.scale, np.zeros((len(raw), 1))), 1))
        taken = np.ascontiguousarray((y @ self.graph.twice[:, lists] + self.graph.sq[lists] <= limit.astype(np.float32)[:, None]).T)
        noted = np.full((self.groups, len(q)), -np.inf, np.float32)
        for u in self.units:
            for qi in self._pieces(np.flatnonzero(taken[u.at]), u):
                noted[u.group:u.group + u.groups, qi] = u.group_largest(u.x @ q[qi].T)
        # as many groups' largest products reach the bound as vectors are wanted, were each there in all its copies
        need, least = keep * copies, np.full(len(q), np.finfo(np.float32).min / 2)
        if self.groups >= need:
            for lo in range(0, len(q), 512):
                some = np.partition(noted[:, lo:lo + 512].T, self.groups - need, axis=1)[:, self.groups - need]
                least[lo:lo + 512] = np.maximum(least[lo:lo + 512], some)
        error = (self.dim + 4) * EPS * np.linalg.norm(q.astype(np.float64), axis=1) * self.largest + self.dim * 2.0 ** -126
        least = (least - 2 * error).astype(np.float32)
        reach = np.logical_or.reduceat(noted >= least, [u.group for u in self.units], axis=0)
        out = []
        for u, some in zip(self.units, reach):
            for qi in self._pieces(np.flatnonzero(some), u):
                s = u.x @ q[qi].T
                xi, at = np.nonzero(s >= least[qi])
                out.append((qi[at], s[xi, at], u.ids[xi], u.raw[xi]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        qi, s, ids, x = (np.concatenate(part) for part in zip(*out))
        if len(qi) > 2 * need * len(q):         # few groups told little
            some = _may_reach(qi, s, need, 2 * error)
            qi, ids, x = qi[some], ids[some], x[some]
        s = np.concatenate([_exact_products(raw[qi[lo:lo + 2048]].astype(np.float64), x[lo:lo + 2048].astype(np.float64))
                            for lo in range(0, len(qi), 2048)])
        return _best(qi, ids, s, keep)

    @staticmethod
    def _pieces(qi: np.ndarray, u: _Unit) -> Iterator[np.ndarray]:
        step = max(16, CELLS // 4 // len(u.x))
        return (qi[lo:lo + step] for lo in range(0, len(qi), step))


def _runs(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first row, end row) of rows that are equal in the columns."""
    n = len(columns[0])
    cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if n else []
    return zip([0, *cut], [*cut, n]) if n else iter(())


def _meet(graph: CentroidGraph, dim: int, scale: float, keep: int, copies: int) -> Callable:
    """Search of rows that come by region, postings in the order of their lists, then queries (their list is one more than the last)."""
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, region = None, None
        for b in batches:
            key, lists, ids = (b.column(c).to_numpy() for c in ("region", "list", "rep"))
            limit, raw = b.column("limit").to_numpy(), b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for lo, hi in _runs(key, lists == len(graph.c)):
                if key[lo] != at:
                    at, region = key[lo], Region(graph, dim, scale)
                if lists[lo] < len(graph.c):
                    region.add(lists[lo:hi], ids[lo:hi], raw[lo:hi])
                    continue
                step = region.step() if region.units else hi
                for q in range(lo, hi if region.units else lo, step):
                    end = min(hi, q + step)
                    qi, xi, s = region.search(raw[q:end], limit[q:end], keep, copies)
                    if not len(qi):
                        continue
                    first = np.flatnonzero(np.concatenate(([True], qi[1:] != qi[:-1])))
                    off = pa.array(np.append(first, len(qi)), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(ids[q + qi[first]]), pa.ListArray.from_arrays(off, pa.array(xi)),
                                                      pa.ListArray.from_arrays(off, pa.array(s))], ["qrep", "xreps", "scores"])

    return lambda batches: freed_at_end(searched(batches))


def freed_at_end(out: Iterator) -> Iterator:
    """``out``; what its making held goes back when it ends, as the worker of a task waits for others."""
    yield from out
    freed(lambda: None)


def _merge(keep: int) -> Callable:
    """Largest of the products found in all regions; the rows of a query come together."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(qi, xi, s):
            qi, xi, s = _best(qi, xi, s, keep)
            return pa.RecordBatch.from_pydict({"qrep": pa.array(qi), "xrep": pa.array(xi), "score": pa.array(s)})

        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("xreps")
            new = (np.repeat(b.column("qrep").to_numpy(), x.value_lengths().to_numpy()), x.flatten().to_numpy(),
                   b.column("scores").flatten().to_numpy())
            held = tuple(np.concatenate(part) for part in zip(held, new))
            goes_on = held[0] == held[0][-1]
            yield batch(*(part[~goes_on] for part in held))
            held = tuple(part[goes_on] for part in held)
        yield batch(*held)

    return merged


def _nearest_of_sample(reps: DataFrame, sample: np.ndarray, k: int, dim: int) -> DataFrame:
    """qi, rep, v, norm2: the k vectors of largest inner product for each sample row, over all of ``reps``."""
    def best(batches):
        for b in batches:
            if not b.num_rows:
                continue
            qi, xi, s = _largest(sample, _matrix(b.column("v"), dim), k)
            yield pa.RecordBatch.from_pydict({"qi": pa.array(qi, pa.int32()), "rep": b.column("rep").take(pa.array(xi)), "s": pa.array(s)})

    near = reps.select("rep", "v").mapInArrow(best, "qi int, rep long, s double")
    w = Window.partitionBy("qi").orderBy(F.desc("s"), "rep")
    near = near.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
    return reps.select("rep", "v", "norm2").join(F.broadcast(near.select("qi", "rep")), "rep")


def tuned(graph: CentroidGraph, queries: np.ndarray, qi: np.ndarray, found: np.ndarray, sample: np.ndarray, copies: int,
          replicate: float, prune: float, probes: int, vectors: int, asked: int, recall: float = RECALL) -> tuple[int, float, int, np.ndarray]:
    """(copies, ratio, probes, share of the vectors in each list) of the cheapest search that holds the share ``recall``
    of the true neighbours ``found`` of ``queries[qi]``.

    ``sample`` tells how the vectors lie in the lists; ``vectors`` and ``asked`` are counts of vectors and queries.
    """
    n = len(graph.c)
    row, lists, place = _near_lists(graph, sample, copies, replicate)
    shares = [np.bincount(lists[place < c], minlength=n) / max(len(sample), 1) for c in range(1, copies + 1)]
    if not len(qi):
        return 1, prune, probes, shares[0]
    ids, d = graph.search(queries, n)
    rank = np.empty_like(ids)
    np.put_along_axis(rank, ids, np.broadcast_to(np.arange(n), ids.shape), 1)
    far = np.sqrt(np.divide(d, d[:, :1], out=np.where(d > 0, np.inf, 1.0), where=d[:, :1] > 0))     # by rank
    row, lists, place = _near_lists(graph, found, copies, replicate)
    last, best = int(np.ceil(recall * len(qi))) - 1, None
    for c, share in enumerate(shares, 1):
        first = np.full(len(qi), n)             # rank at which a neighbour's first list is reached
        some = place < c
        np.minimum.at(first, row[some], rank[qi[row[some]], lists[some]])
        most = min(n, max(probes, int(1.25 * np.sort(first)[last]) + 2))      # the sample's own error
        reached = np.sort(np.where(first < most, far[qi, np.minimum(first, n - 1)], np.inf))
        need = float(reached[max(last, min((last + len(qi)) // 2, np.searchsorted(reached, np.inf) - 1))])
        ratio = prune if need <= prune else min(need * 1.01, 1e150)
        met = (share[ids[:, :most]] * (far[:, :most] <= ratio)).sum(1).mean()
        cost = asked * vectors * met * PAIR_S + vectors * share.sum() * POSTING_S
        if best is None or cost < best[0]:
            best = cost, (c, ratio, most, share)
    return best[1]


def _scattered(n: int) -> np.ndarray:
    """Keys that Spark's hash deals to n partitions, one each."""
    keys, at = np.full(n, -1, np.int64), 0
    u, rot = np.uint32, lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    while (keys < 0).any():
        i = np.arange(at, at + 8 * n + 64)
        x = rot(i.astype(u) * u(0xCC9E2D51), 15) * u(0x1B873593)
        h = rot(u(42) ^ x, 13) * u(5) + u(0xE6546B64)
        h ^= u(4)
        h = (h ^ (h >> u(16))) * u(0x85EBCA6B)
        h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
        to, first = np.unique((h ^ (h >> u(16))).astype(np.int32).astype(np.int64) % n, return_index=True)
        some = keys[to] < 0
        keys[to[some]], at = i[first[some]], at + len(i)
    return keys


def regions(weights: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first list, first region, regions) of runs of neighbouring lists of about equal weight; a heavier list is a run in several regions."""
    target = weights.sum() / max(count, 1) or 1.0
    part = ((np.cumsum(weights) - weights / 2) // target).astype(int)
    starts, first, blocks, alone = [], [], [], True
    for at, w in enumerate(weights.tolist()):
        heavy = w > 1.5 * target
        if alone or heavy or part[at] != part[at - 1]:
            starts.append(at)
            first.append(first[-1] + blocks[-1] if first else 0)
            blocks.append(int(np.ceil(w / target)) if heavy else 1)
        alone = heavy
    return np.array(starts), np.array(first), np.array(blocks)


def search(vectors: DataFrame, is_query: Column, vec: str = "embedding", vid: str = "vec_id", k: int = 20,
           per_list: int = LIST, copies: int = COPIES, replicate: float = REPLICATE, prune: float = PRUNE,
           probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k nearest other rows found."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(f"`{vid}`").cast("long").alias("id"), F.col(f"`{vec}`").alias("v"), is_query.alias("q"))
    low, high, inf = F.array_min("v"), F.array_max("v"), float("inf")       # NaN is the largest of an array
    good = (low > -inf) & (high < inf) & ((low != 0) | (high != 0)) & ~F.exists("v", F.isnull)
    base = base.where("id IS NOT NULL AND v IS NOT NULL").where(good)
    dims = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0]["d"]
    base = base.withColumn("q", F.coalesce("q", F.lit(False))).where(F.size("v") == dim).distinct()
    w = Window.partitionBy("hash", "v", "q").orderBy("id")      # the hash spares most comparisons of vectors
    held = (base.withColumn("hash", F.xxhash64("v")).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
            .groupBy("hash", "v").agg(F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"), F.max("q").alias("asked")))
    reps = stage(held.drop("hash").withColumn("rep", F.col("ids")[0]).withColumn(
        "norm2", F.aggregate("v", F.lit(0.0), lambda a, b: a + b.cast("double") * b.cast("double"))))
    n, top, n_asked = reps.agg(F.count("*"), F.max("norm2"), F.count_if("asked")).first()
    asked = reps.where("asked").select("rep", "v")
    # squares of single precision stay in its range; a power of two changes no digit
    scale = 1.0 if 1e-24 < top < 1e24 else 2.0 ** -np.round(np.log2(top) / 2)

    lists = int(min(MAX_LISTS, max(1, n // per_list)))
    size = min(MAX_SAMPLE, lists * SAMPLE_PER_LIST)
    # the rows of the smallest hashes: a bound that more than enough of them keep goes before their sort
    share = (1.05 * size + 10 * size ** 0.5 + 64) / n
    some = reps.select("rep", "v", "norm2", F.xxhash64("rep").alias("h"))
    got = (some if share >= 1 else some.where(F.col("h") < int((share - 0.5) * 2 ** 64))).toArrow()
    got = got.take(pa.array(np.lexsort((got.column("rep").to_numpy(), got.column("h").to_numpy()))[:size]))
    sample = np.concatenate([_lifted(_matrix(b.column("v"), dim), b.column("norm2").to_numpy(), top, scale).astype(np.float32)
                             for b in got.to_batches(8192)])
    del got
    graph = CentroidGraph(_lloyd(sample, balanced_centroids(sample, lists)))
    lists = len(graph.c)

    tune = asked.orderBy(F.xxhash64("rep"), "rep").limit(TUNE).toArrow()
    if not tune.num_rows:
        return spark.createDataFrame([], schema)
    x = _matrix(tune.column("v").combine_chunks(), dim)
    true = _nearest_of_sample(reps, x, k + 1, dim).toArrow()
    found = _matrix(true.column("v").combine_chunks(), dim)
    copies, prune, probes, shares = tuned(
        graph, _lifted(x, top, top, scale), true.column("qi").to_numpy(), _lifted(found, true.column("norm2").to_numpy(), top, scale),
        sample[:32_768], copies, replicate, prune, probes, n, n_asked)
    freed(lambda: None)

    postings_n = n * shares.sum()
    tasks = spark.sparkContext.defaultParallelism
    count = int(np.ceil(max(postings_n / REGION, min(2 * tasks, postings_n / LEAST_REGION, 2 * postings_n / n_asked), 1)))
    starts, firsts, blocks = regions(shares, count if count <= tasks else -(-count // tasks) * tasks)
    run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, lists)))
    parts = int(blocks.sum())
    keys = _scattered(parts).astype(np.int32)
    made = f"region int, list int, rep long, v {reps.schema['v'].dataType.simpleString()}, limit double"

    def rows(b: pa.RecordBatch, r: np.ndarray, region: np.ndarray, at: np.ndarray, limit: np.ndarray) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches([b.select(["rep", "v"])]).take(pa.array(r))
        cols = [pa.array(keys[region]), pa.array(at, pa.int32()), t.column("rep"), t.column("v"), pa.array(limit, pa.float64())]
        return pa.table(cols, ["region", "list", "rep", "v", "limit"]).to_batches()

    def postings(batches):
        for b in batches:
            aug = _lifted(_matrix(b.column("v"), dim), b.column("norm2").to_numpy(), top, scale)
            r, c, _ = _near_lists(graph, aug, copies, replicate)
            salt = b.column("rep").to_numpy()[r] % blocks[run_of[c]]
            yield from rows(b, r, firsts[run_of[c]] + salt, c, np.zeros(len(r)))

    def probe(batches):
        for b in batches:
            for lo, e, xs in graph.blocks(_lifted(_matrix(b.column("v"), dim), top, top, scale)):
                limit = graph.limits(e, xs, probes, prune, n * shares, ENOUGH * (k + 1) * copies)
                r, run = np.nonzero(np.logical_or.reduceat(e <= limit.astype(np.float32)[:, None], starts, axis=1))
                many = blocks[run]
                r, salt = np.repeat(r, many), np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield from rows(b, lo + r, np.repeat(firsts[run], many) + salt, np.full(len(r), lists), limit[r])

    post = reps.select("rep", "v", "norm2").mapInArrow(postings, made)
    hits = (post.unionByName(asked.mapInArrow(probe, made)).repartition(parts, "region").sortWithinPartitions("region", "list")
            .mapInArrow(_meet(graph, dim, scale, k + 1, copies), "qrep long, xreps array<long>, scores array<double>"))
    hits = hits.repartition("qrep").sortWithinPartitions("qrep").mapInArrow(_merge(k + 1), "qrep long, xrep long, score double")
    full = hits.join(reps.select(F.col("rep").alias("xrep"), "ids"), "xrep").select(
        "qrep", "score", F.explode("ids").alias("vec_id"))
    # k + 1 ids for each distinct query vector, then one row less for the query itself
    wv = Window.partitionBy("qrep").orderBy(F.desc("score"), "vec_id")
    full = full.withColumn("n", F.row_number().over(wv)).where(F.col("n") <= k + 1).drop("n")
    queries = base.where("q").select("id", "v").join(asked, "v").select("id", "rep")
    pairs = queries.join(full, F.col("rep") == F.col("qrep")).where(F.col("id") != F.col("vec_id"))
    wq = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(wq)).where(F.col("rank") <= k)
            .select(F.col("id").alias("query_id"), "rank", "vec_id", "score"))
