"""Sequential search of parameters: densities of good and bad trials propose the next ones."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

STARTUP = 8  # trials drawn at random before densities are estimated
GOOD = 0.25  # share of the trials that count as good
CANDIDATES = 24  # draws from the density of good trials for each proposal


@dataclass(frozen=True)
class Span:
    """A range of whole or real numbers; ``log`` for sizes that are compared by their ratio."""

    low: float
    high: float
    log: bool = False

    @property
    def whole(self) -> bool:
        return isinstance(self.low, int) and isinstance(self.high, int)

    def unit(self, value: float) -> float:
        """The value's place between 0 and 1."""
        if self.high <= self.low:
            return 0.5
        if self.log:
            return math.log(value / self.low) / math.log(self.high / self.low)
        return (value - self.low) / (self.high - self.low)

    def value(self, unit: float):
        unit = min(max(unit, 0.0), 1.0)
        if self.high <= self.low:
            return self.low
        x = self.low * (self.high / self.low) ** unit if self.log else self.low + unit * (self.high - self.low)
        return min(int(self.low + unit * (self.high - self.low + 1)), self.high) if self.whole else x


Space = Mapping[str, Span | Sequence]


def space_of(ranges: Mapping[str, Sequence]) -> dict[str, Span | Sequence]:
    """Spans from ``(low, high)`` or ``(low, high, "log")`` of numbers; any other sequence is a choice."""
    out: dict[str, Span | Sequence] = {}
    for name, bounds in ranges.items():
        numbers = [b for b in bounds if isinstance(b, (int, float)) and not isinstance(b, bool)]
        span = len(numbers) == 2 and (len(bounds) == 2 or (len(bounds) == 3 and bounds[2] == "log"))
        out[name] = Span(bounds[0], bounds[1], len(bounds) == 3) if span else tuple(bounds)
    return out


def draw(space: Space, rng: random.Random) -> dict:
    return {name: s.value(rng.random()) if isinstance(s, Span) else rng.choice(list(s)) for name, s in space.items()}


def _density(x: float, centres: Sequence[float], width: float) -> float:
    """Gaussians around the trials and one flat part, cut off at the ends of the range."""
    total = 1.0
    for c in centres:
        inside = 0.5 * (math.erf((1 - c) / (width * math.sqrt(2))) - math.erf(-c / (width * math.sqrt(2))))
        total += math.exp(-0.5 * ((x - c) / width) ** 2) / (width * math.sqrt(2 * math.pi) * max(inside, 1e-12))
    return total / (len(centres) + 1)


def propose(space: Space, trials: Sequence[tuple[dict, float]], rng: random.Random) -> dict:
    """The next trial: each parameter near those of the good trials, where these stand out most against the others.

    Of ``CANDIDATES`` draws from the density of the good trials the one likeliest
    against the density of the others is taken; choices are drawn by such weights.
    """
    if len(trials) < STARTUP:
        return draw(space, rng)
    ranked = [t for t, _ in sorted(trials, key=lambda t: -t[1])]
    cut = max(2, math.ceil(GOOD * len(ranked)))
    good, bad = ranked[:cut], ranked[cut:]
    width = lambda held: max(0.08, 0.35 / len(held) ** 0.5)
    out = {}
    for name, s in space.items():
        if isinstance(s, Span):
            low, high = [s.unit(t[name]) for t in good], [s.unit(t[name]) for t in bad]
            tries = []
            for _ in range(CANDIDATES):
                k = rng.randrange(len(low) + 1)
                tries.append(rng.random() if k == len(low) else min(max(rng.gauss(low[k], width(low)), 0.0), 1.0))
            out[name] = s.value(max(tries, key=lambda x: _density(x, low, width(low)) / _density(x, high, width(high))))
        else:
            share = lambda held, c: (sum(t[name] == c for t in held) + 1) / (len(held) + len(s))
            out[name] = rng.choices(list(s), [share(good, c) ** 2 / share(bad, c) for c in s])[0]
    return out


def search(space: Space, score: Callable[[dict], float], trials: int, seed: int, parallelism: int = 4) -> list[tuple[dict, float]]:
    """All trials with their scores, in order. The trials of a round run at once and know the rounds before them."""
    rng = random.Random(seed)
    done: list[tuple[dict, float]] = []
    with ThreadPoolExecutor(parallelism) as pool:
        while len(done) < trials:
            batch = [propose(space, done, rng) for _ in range(min(parallelism, trials - len(done)))]
            done += list(zip(batch, pool.map(score, batch)))
    return done
