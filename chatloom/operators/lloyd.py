"""k-means for many runs at once: each pass over the vectors serves all numbers of clusters and all seeds."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.runtime import persisted

BLOCK = 2048
STACK = 8  # runs multiplied at once
MOVED = 1e-4  # a run ends when no centre moves further
ROUNDS = 2  # of drawn candidates, 2 k each
NEVER = 1e-12  # of the squared lengths: rounding, so no distance


def _uniform(h: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """In (0, 1), from a row's hash alone, so draws depend on no order and no partition."""
    z = h ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53


def _scores(c: np.ndarray, xt: np.ndarray) -> np.ndarray:
    """Squared distance of each centre to each column, less the column's squared length."""
    s = (c * c.dtype.type(-2)) @ xt
    s += np.einsum("ij,ij->i", c, c)[:, None]
    return s


def _distances(c: np.ndarray, xt: np.ndarray, sq: np.ndarray) -> np.ndarray:
    """Squared distances to the nearest of the centres; what is only rounding counts as 0."""
    d = _scores(c, xt).min(0) + sq
    d[d < NEVER * (sq + np.einsum("ij,ij->i", c, c).max())] = 0.0
    return d


def _totals(acc, x, h):
    """n and the sum of the rows."""
    n, total = acc or (0, 0.0)
    return n + len(x), total + x.sum(0)


def _from(origin: np.ndarray, step: Callable) -> Callable:
    """A step over the rows less the origin: distances lose no digits to a length that all rows share."""
    return lambda acc, x, h: step(acc, x - origin, h)


def _first(seeds: tuple[int, ...]) -> Callable:
    """For each seed the row with the least draw."""

    def step(acc, x, h):
        best = acc or {}
        for s in seeds:
            u = _uniform(h, s, 0)
            i = int(u.argmin())
            if s not in best or u[i] < best[s][0]:
                best[s] = (u[i], x[i].copy())
        return best

    return step


def _drawn(runs: list[tuple[int, int, np.ndarray]], turn: int) -> Callable:
    """For each run (seed, how many, centres) rows drawn without replacement by squared distance: the least exponential keys."""

    def step(acc, x, h):
        acc, xt, sq = acc or [(np.empty(0), np.empty((0, x.shape[1])))] * len(runs), np.ascontiguousarray(x.T), np.einsum("ij,ij->i", x, x)
        logs, far = {}, {}
        for r, (seed, most, c) in enumerate(runs):
            if seed not in logs:
                logs[seed] = -np.log(_uniform(h, seed, turn))
            if id(c) not in far:  # runs may share their centres
                far[id(c)] = _distances(c, xt, sq)
            with np.errstate(divide="ignore"):
                e = logs[seed] / far[id(c)]
            keys, rows = acc[r]
            i = np.flatnonzero(e < (keys[-1] if len(keys) == most else np.inf))
            if len(i):
                keys, rows = np.concatenate([keys, e[i]]), np.concatenate([rows, x[i]])
                o = np.argsort(keys, kind="stable")[:most]
                acc[r] = (keys[o], rows[o])
        return acc

    return step


def _weights(runs: list[np.ndarray]) -> Callable:
    """Rows nearest to each centre; in single precision, as they only weigh the first centres."""

    def step(acc, x, h):
        acc = acc or [np.zeros(len(c)) for c in runs]
        with np.errstate(over="ignore", invalid="ignore"):
            yt = np.ascontiguousarray(x.T.astype("f4"))
            for w, c in zip(acc, runs):
                s = _scores(c.astype("f4"), yt)
                n = (s == s.min(0)).sum(1)
                w += n if n.sum() == len(x) else np.bincount(_scores(c, x.T).argmin(0), minlength=len(c))
        return acc

    return step


def _sums(runs: list[np.ndarray]) -> Callable:
    """For each run its cost and, by centre, the number and sum of its rows. Single precision where the centres have it."""
    alike: dict[tuple, list[int]] = {}
    for r, c in enumerate(runs):
        alike.setdefault((c.dtype, c.shape), []).append(r)
    stacks = [(r[i : i + STACK], np.stack([runs[j] for j in r[i : i + STACK]])) for r in alike.values() for i in range(0, len(r), STACK)]
    lanes = {c.dtype: BLOCK // (1 if c.dtype == "f4" else 2) for c in runs}  # what fits the cache

    def step(acc, x, h):
        acc = acc or [[0.0, np.zeros(len(c)), np.zeros(c.shape)] for c in runs]
        sq = float(np.einsum("ij,ij->", x, x))
        for a in acc:
            a[0] += sq
        for t, lane in lanes.items():
            for i in range(0, len(x), lane):
                y = x[i : i + lane].astype(t)
                yt = np.ascontiguousarray(y.T)
                for which, c in stacks:
                    if c.dtype == t:
                        s = _scores(c.reshape(-1, c.shape[2]), yt).reshape(*c.shape[:2], -1)
                        m = s.min(1, keepdims=True)
                        own = s == m
                        w = own.sum(2)
                        if w.sum() != len(c) * len(y):  # of equals the first
                            own = s.argmin(1)[:, None, :] == np.arange(c.shape[1])[:, None]
                            w = own.sum(2)
                        total = (own.reshape(-1, len(y)).astype(t) @ y).reshape(c.shape)
                        for r, cost, n, v in zip(which, m.sum((1, 2), dtype="f8"), w, total):
                            acc[r][0] += float(cost)
                            acc[r][1] += n
                            acc[r][2] += v
        return acc

    return step


def _unit_sums(runs: list[np.ndarray], origin: np.ndarray) -> Callable:
    """Squared distance of all rows from the origin and, for each run, by centre the sum of its rows at length 1."""

    def step(acc, x, h):
        acc, xt = acc or [0.0, [np.zeros(c.shape) for c in runs]], np.ascontiguousarray((x - origin).T)
        acc[0] += float(np.einsum("ij,ij->", xt, xt))
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        for a, c in zip(acc[1], runs):
            a += (_scores(c, xt).argmin(0) == np.arange(len(c))[:, None]).astype("f8") @ u
        return acc

    return step


def _silhouettes(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], origin: np.ndarray) -> Callable:
    """For each run (centres, numbers, unit sums) the sum of the rows' silhouettes by cosine distance."""

    def step(acc, x, h):
        acc, xt = acc if acc is not None else np.zeros(len(runs)), np.ascontiguousarray((x - origin).T)
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        i = np.arange(len(x))
        for r, (c, n, y) in enumerate(runs):
            own = _scores(c, xt).argmin(0)
            there = np.maximum(n, 1)
            far = 1 - u @ (y / there[:, None]).T
            a = far[i, own] * (there / np.maximum(there - 1, 1))[own]
            far[:, n == 0], far[i, own] = np.inf, np.inf
            b = far.min(1)
            most = np.maximum(a, b)
            acc[r] += float(np.where((n[own] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1), 0.0).sum())
        return acc

    return step


def _started(c: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centres among weighted candidates, drawn by squared distance and moved to the means of theirs; fewer where fewer differ."""
    r, sq = np.random.default_rng([seed, k]), np.einsum("ij,ij->i", c, c)
    chosen = [c[r.choice(len(c), p=w / w.sum())]]
    d = _distances(np.array(chosen), c.T, sq)
    while len(chosen) < k and (w * d).sum() > 0:
        chosen.append(c[r.choice(len(c), p=w * d / (w * d).sum())])
        d = _distances(np.array(chosen), c.T, sq)
    m = np.array(chosen)
    for _ in range(30):
        own = (_scores(m, c.T).argmin(0) == np.arange(len(m))[:, None]) * w
        n = own.sum(1)
        moved = np.where(n[:, None] > 0, own @ c / np.maximum(n, 1)[:, None], m)
        if np.allclose(moved, m):
            break
        m = moved
    return m


def _packed(batches: Iterator) -> Iterator:
    """Rows in blocks, as single floats where that changes no value."""
    import pyarrow as pa

    for b in batches:
        h = b.column("h").to_numpy()
        x = np.asarray(b.column("v").flatten(), "f8").reshape(len(h), -1)
        for i in range(0, len(h), BLOCK):
            v = x[i : i + BLOCK]
            with np.errstate(over="ignore"):
                s = v.astype("f4")
            single = bool((s == v).all())
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(v)], pa.int32()), "single": [single], "h": [h[i : i + BLOCK].tobytes()], "x": [(s if single else v).tobytes()]})


class Blocks:
    """The vectors of some rows, written once in blocks to the shared folder, and the fits made on them."""

    def __init__(self, rows: DataFrame, key: str) -> None:
        self.rows, self.fits = rows, {}
        packed = rows.select(F.xxhash64(key).alias("h"), F.col("v").cast("array<double>").alias("v")).mapInArrow(_packed, "n int, single boolean, h binary, x binary")
        self.blocks = persisted(packed, "blocks")
        parts = self._pass(_totals)
        self.n = sum(n for n, _ in parts)
        self.origin = sum(total for _, total in parts) / max(self.n, 1)

    def _pass(self, step: Callable) -> list:
        """What the step gathers, one result a task."""

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            acc = None
            for b in batches:
                for n, single, h, x in zip(b.column("n"), b.column("single"), b.column("h"), b.column("x")):
                    v = np.frombuffer(x.as_buffer(), "f4" if single.as_py() else "f8").astype("f8").reshape(n.as_py(), -1)
                    acc = step(acc, v, np.frombuffer(h.as_buffer(), "u8"))
            if acc is not None:
                yield pa.RecordBatch.from_pydict({"r": pa.array([pickle.dumps(acc)], pa.binary())})

        tasks = max(64, self.blocks.sparkSession.sparkContext.defaultParallelism)  # bounds what reaches the driver
        return [pickle.loads(r["r"]) for r in self.blocks.coalesce(tasks).mapInArrow(run, "r binary").collect()]

    def _starts(self, runs: list[tuple[int, int]]) -> list[np.ndarray]:
        """First centres of each run (k, seed): rows drawn by squared distance in rounds, then weighted and thinned."""
        seeds, best = tuple(sorted({s for _, s in runs})), {}
        for b in self._pass(_from(self.origin, _first(seeds))):
            for s, (u, x) in b.items():
                if s not in best or u < best[s][0]:
                    best[s] = (u, x[None, :])
        centres = [best[s][1] for _, s in runs]
        for turn in range(1, ROUNDS + 1):
            parts = self._pass(_from(self.origin, _drawn([(s, 2 * k, c) for (k, s), c in zip(runs, centres)], turn)))
            for r, (k, _) in enumerate(runs):
                keys, rows = np.concatenate([p[r][0] for p in parts]), np.concatenate([p[r][1] for p in parts])
                centres[r] = np.concatenate([centres[r], rows[np.argsort(keys, kind="stable")[: 2 * k]]])
        weights = self._pass(_from(self.origin, _weights(centres)))
        return [_started(c, sum(p[r] for p in weights), k, s) for r, ((k, s), c) in enumerate(zip(runs, centres))]

    def _summed(self, centres: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        parts = self._pass(_from(self.origin, _sums(centres)))
        return [tuple(sum(p[r][i] for p in parts) for i in range(3)) for r in range(len(centres))]

    def fit(self, ks: Iterable[int], seeds: tuple[int, ...], iterations: int) -> dict[int, dict]:
        """By k the centres (less the origin), cost, numbers and sums of the cheapest run of all seeds, of equals the first.

        Rounds go over all rows until no centre moves. A run takes its rounds in single precision while they lower its cost,
        then in double, and ends in double only; a centre without rows stays.
        """
        asked = {k: (k, tuple(seeds), iterations) for k in ks}
        if not self.n:
            return {}
        runs = [(k, s) for k, a in asked.items() if a not in self.fits for s in seeds]
        centres = self._starts(runs) if runs else []
        rough, cost, left = [iterations > 1] * len(runs), [np.inf] * len(runs), [iterations] * len(runs)
        live = [r for r in range(len(runs)) if iterations]
        while live:
            with np.errstate(over="ignore"):
                now_at = [centres[r].astype("f4" if rough[r] else "f8") for r in live]
            for r, (now, n, total) in zip(live, self._summed(now_at)):
                left[r] -= 1
                if rough[r] and not now < cost[r] * (1 - 1e-8):
                    rough[r] = False
                    continue
                m = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[r])
                still = np.sqrt(((m - centres[r]) ** 2).sum(1)).max() <= MOVED
                centres[r], cost[r] = m, now
                if rough[r]:
                    rough[r] = not still and left[r] > iterations // 2
                elif still:
                    left[r] = 0
            live = [r for r in live if left[r] > 0]
        for (k, _), c, (now, n, total) in zip(runs, centres, self._summed(centres) if runs else []):
            if asked[k] not in self.fits or now < self.fits[asked[k]]["cost"]:
                self.fits[asked[k]] = {"centres": c, "cost": max(now, 0.0), "n": n, "sums": total}
        return {k: self.fits[a] for k, a in asked.items()}

    def quality(self, fits: dict[int, dict]) -> dict[int, tuple[float, float]]:
        """By k silhouette by cosine distance and Calinski-Harabasz of the rows by their nearest centre; 0 with one cluster."""
        if not fits:
            return {}
        parts = self._pass(_unit_sums([f["centres"] for f in fits.values()], self.origin))
        sq, units = sum(p[0] for p in parts), [sum(p[1][r] for p in parts) for r in range(len(fits))]
        s = sum(self._pass(_silhouettes([(f["centres"], f["n"], u) for f, u in zip(fits.values(), units)], self.origin)))
        out = {}
        for (k, f), total in zip(fits.items(), s):
            n, there = f["n"].sum(), f["n"] > 0
            own = float(((f["sums"][there] ** 2).sum(1) / f["n"][there]).sum())
            grand, g = float((f["sums"].sum(0) ** 2).sum() / n), int(there.sum())
            out[k] = (float(total / n), (own - grand) / (g - 1) / ((sq - own) / (n - g)) if sq > own else np.inf) if g > 1 else (0.0, 0.0)
        return out


def labelled(rows: DataFrame, centres: np.ndarray, origin: np.ndarray, key: str) -> DataFrame:
    """(key, cluster_id): the nearest centre (less the origin) of each row, of equals the first."""

    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(_scores(centres, (np.array(v.tolist(), "f8") - origin).T).argmin(0) if len(v) and len(centres) else np.zeros(len(v), "i8"))

    return rows.select(key, F.pandas_udf(nearest, "int")(F.col("v").cast("array<double>")).alias("cluster_id"))
