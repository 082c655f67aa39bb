"""Lowest hinge losses by cutting planes, for several fits in the same passes over the distributed rows.

The sum of hinges is above each of its planes, and the lowest point under a few planes is a small quadratic
programme. A pass takes each fit from its best point so far towards that lowest point: it gives the loss along
the line and a new plane a little beyond where the lowest loss is expected. The value of the programme is below
every loss, so the share of the loss that may still be won is known, without rounding the hinge's corner.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np

from mailsift.operators.descent import Rows, Unfinished, margins, summed

MOST = 60  # planes that a fit holds; those of least weight are put together
IDLE = 15  # a plane that had no weight for so many steps is left out
LINE = np.append(0.0, np.geomspace(1e-3, 1.0, 40))  # where the loss is taken along a line
BEYOND = 0.2  # share of the rest of the line at which the next plane is taken
BASE = 3  # planes that stay: zero, and the slopes of either class alone


@dataclass
class Line:
    """What a fit asks of a pass: losses from ``start`` to ``end``, planes at ``cuts``; rows of fold ``without`` are left out."""

    start: np.ndarray
    end: np.ndarray
    cuts: np.ndarray
    without: int | None


def hinge_fits(rows: Rows, without: list[int | None], penalty: float, gap: float, most: int) -> list[np.ndarray]:
    """Coefficients with the intercept last, for each of the folds that is left out.

    Each loss is within ``gap`` of its lowest value; ``most`` passes without it are an error.
    """
    fits = {i: _fit(rows.size, fold, penalty, gap) for i, fold in enumerate(without)}
    asks, found = {i: next(fit) for i, fit in fits.items()}, {}
    for _ in range(most):
        answers = _pass(rows, list(asks.values()))
        for i, answer in zip(list(asks), answers):
            try:
                asks[i] = fits[i].send(answer)
            except StopIteration as done:
                found[i] = done.value
                del asks[i]
        if not asks:
            return [found[i] for i in range(len(without))]
    raise Unfinished(f"did not converge in {most} iterations")


def _pass(rows: Rows, lines: list[Line]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each line: the sums of hinges along it, its planes' slopes (the intercept's last) and their heights."""
    shared, size = rows.context.broadcast(lines), rows.size

    def run(blocks: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
        lines = shared.value
        sums = [(np.zeros(len(LINE)), np.zeros((len(x.cuts), size + 1)), np.zeros(len(x.cuts))) for x in lines]
        for fold, *arrays in blocks:
            places, numbers, sizes, label, weight = arrays
            sign = 2.0 * label - 1.0
            for line, (losses, slopes, heights) in zip(lines, sums):
                if fold == line.without:
                    continue
                first = 1.0 - sign * margins(places, numbers, sizes, line.start)
                step = 1.0 - sign * margins(places, numbers, sizes, line.end) - first
                for i, t in enumerate(LINE):
                    losses[i] += weight @ np.maximum(first + t * step, 0.0)
                for i, t in enumerate(line.cuts):
                    # Beyond the line are the slopes of one class alone.
                    active = weight * (first + t * step > 0.0) if t >= 0 else weight * (sign == (1.0 if t == -1 else -1.0))
                    pull = active * sign
                    slopes[i, :-1] += summed(places, numbers, sizes, pull, size)
                    slopes[i, -1] += pull.sum()
                    heights[i] += active.sum()
        yield [x for three in sums for x in three]

    parts = rows.run(run)
    shared.destroy()
    whole = [np.sum(x, axis=0) for x in zip(*parts)]
    return [tuple(whole[3 * i : 3 * i + 3]) for i in range(len(lines))]


def _fit(size: int, without: int | None, penalty: float, gap: float) -> Generator[Line, tuple, np.ndarray]:
    """Steps of one fit: gives lines, is sent what a pass found on them, and returns the best point."""
    best = np.zeros(size + 1)
    losses, slopes, heights = yield Line(best, best, np.array([-1.0, -2.0, 0.0]), without)
    upper = losses[0]
    planes = _Planes(size, penalty)
    planes.add(slopes, heights)
    last = 0.5
    while True:
        lowest, lower = planes.lowest()
        if upper - lower <= gap * upper:
            return best
        losses, slopes, heights = yield Line(best, lowest, np.array([last + BEYOND * (1.0 - last)]), without)
        planes.add(slopes, heights)
        across = lowest - best
        a, b, c = (float(x[:-1] @ y[:-1]) for x, y in ((best, best), (best, across), (across, across)))
        whole = losses + penalty * (a + 2 * LINE * b + LINE**2 * c) / 2
        at = int(np.argmin(whole))
        best, upper, last = best + LINE[at] * across, float(whole[at]), max(float(LINE[at]), float(LINE[1]))


class _Planes:
    """Planes below a sum of hinges, and the lowest point of the largest of them with the penalty."""

    def __init__(self, size: int, penalty: float) -> None:
        room = MOST + BASE + 1
        self.penalty, self.n = penalty, 1  # the first plane is zero: no hinge is below it
        self.slopes, self.heights, self.gram = np.zeros((room, size + 1)), np.zeros(room), np.zeros((room, room))
        self.shares, self.idle = np.zeros(room), np.zeros(room, int)

    def add(self, slopes: np.ndarray, heights: np.ndarray) -> None:
        if self.n + len(heights) > len(self.heights):
            self._put_together()
        old, self.n = self.n, self.n + len(heights)
        self.slopes[old : self.n], self.heights[old : self.n] = slopes, heights
        self.shares[old : self.n], self.idle[old : self.n] = 0.0, 0
        products = self.slopes[: self.n, :-1] @ slopes[:, :-1].T
        self.gram[: self.n, old : self.n], self.gram[old : self.n, : self.n] = products, products.T

    def lowest(self) -> tuple[np.ndarray, float]:
        """The lowest point under the planes, and a bound that no loss is below."""
        n = self.n
        gram, heights, pull = self.gram[:n, :n] / self.penalty, self.heights[:n], self.slopes[:n, -1]
        shares, intercept = _programme(gram, heights, pull)
        # Where the pulls on the intercept do not cancel to the last digit, the plane of the other class makes them.
        rest = float(pull @ shares)
        other = 1 if rest < 0 else 2
        if rest and pull[other] * rest < 0:
            part = rest / (rest - pull[other])
            shares = (1.0 - part) * shares
            shares[other] += part
        self.shares[:n] = shares
        self.idle[:n] = np.where(shares > 1e-9, 0, self.idle[:n] + 1)
        point = np.append(shares @ self.slopes[:n, :-1] / self.penalty, intercept)
        lower = float(heights @ shares - shares @ gram @ shares / 2)
        self._keep(np.flatnonzero((self.idle[:n] <= IDLE) | (np.arange(n) < BASE)))
        return point, lower

    def _keep(self, kept: np.ndarray) -> None:
        if len(kept) == self.n:
            return
        n = self.n = len(kept)
        for to, row in enumerate(kept):  # in place, as they are long
            self.slopes[to] = self.slopes[row]
        self.heights[:n], self.gram[:n, :n] = self.heights[kept], self.gram[np.ix_(kept, kept)]
        self.shares[:n], self.idle[:n] = self.shares[kept], self.idle[kept]

    def _put_together(self) -> None:
        """The lighter half of the planes becomes their weighted mean, which is a plane below the hinges as well."""
        order = BASE + np.argsort(self.shares[BASE : self.n], kind="stable")
        light = order[: len(order) // 2]
        shares = self.shares[light]
        slope, height = (shares @ self.slopes[light], shares @ self.heights[light]) if shares.sum() > 0 else (self.slopes[light[-1]], self.heights[light[-1]])
        whole = shares.sum() or 1.0
        self._keep(np.sort(np.setdiff1d(np.arange(self.n), light)))
        self.add(slope[None] / whole, np.array([height / whole]))
        self.shares[self.n - 1] = shares.sum()


def _programme(gram: np.ndarray, heights: np.ndarray, pull: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares a, none negative and 1 in all, with ``pull @ a = 0``, that make ``heights @ a - a @ gram @ a / 2`` largest.

    Also the intercept, the multiplier of ``pull``. By an interior-point method with corrected steps.
    """
    n = len(heights)
    unit, scale = max(float(np.abs(pull).max()), 1e-300), max(float(np.abs(heights).max()), 1e-300)
    q, h, fixed = gram / scale, heights / scale, np.stack([np.ones(n), pull / unit])
    a, z, v = np.full(n, 1.0 / n), np.ones(n), np.zeros(2)
    target = np.array([1.0, 0.0])
    for _ in range(100):
        dual, primal, slack = q @ a - h - fixed.T @ v - z, fixed @ a - target, a @ z / n
        if slack <= 1e-13 and np.abs(dual).max() <= 1e-10 and np.abs(primal).max() <= 1e-12:
            break
        system = np.zeros((n + 2, n + 2))
        system[:n, :n] = q
        system[np.arange(n), np.arange(n)] += z / a
        system[:n, n:], system[n:, :n] = -fixed.T, fixed
        system[n + np.arange(2), n + np.arange(2)] = 1e-14  # in case no plane pulls
        inverse = np.linalg.inv(system)

        def towards(comp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
            step = inverse @ np.concatenate([-dual - comp / a, -primal])
            da = step[:n]
            dz = -(comp + z * da) / a
            reach = lambda x, dx: min(1.0, 0.995 * float(np.min(np.where(dx < 0, -x / np.where(dx < 0, dx, -1.0), np.inf))))
            return da, step[n:], dz, reach(a, da), reach(z, dz)

        da, dv, dz, by, bz = towards(a * z)
        centre = ((a + by * da) @ (z + bz * dz) / n / slack) ** 3
        da, dv, dz, by, bz = towards(a * z + da * dz - centre * slack)
        a, v, z = a + by * da, v + bz * dv, z + bz * dz
    a = np.where(a > 1e-11, a, 0.0)
    return a / a.sum(), -float(v[1]) * scale / unit
