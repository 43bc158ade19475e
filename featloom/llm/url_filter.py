"""URL rules as wildcard patterns, all matched at once by a bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import ascii_lower


@dataclass(frozen=True)
class Rule:
    """``glob`` over the canonical URL ``.host/path``: ``*`` is any run without a slash, ``**`` any run."""

    glob: str
    verdict: str
    label: str | None = None


def site_rule(verdict: str, rule: str) -> Rule:
    """``host/path`` as a rule for the host and its subdomains and every path that starts so."""
    host, _, path = rule.partition("/")
    return Rule(f"*.{host}/{path}**", verdict, rule)


# What holds where no site rule fits: advert and tracker hosts, downloads and log-in pages are blocked, and so is a missing host.
GENERAL = (
    Rule("*.ads.*/**", "block"), Rule("*.adserver.*/**", "block"), Rule("*.doubleclick.*/**", "block"), Rule("*.tracker.*/**", "block"),
    Rule("**/wp-login**", "block"), Rule("**/ads/**", "block"), Rule("**.exe", "block"), Rule("**.apk", "block"), Rule(".", "block"),
    Rule("./**", "block"),
)


class Automaton:
    """Patterns packed into 64-bit words, one bit for the start and each literal byte of every pattern.

    Bit ``i`` of the state is set when the pattern has matched up to its ``i``-th
    literal. A byte shifts the state and masks it (Shift-And); bits that a
    wildcard follows also stay set as long as the wildcard takes the byte.
    """

    def __init__(self, globs: Sequence[str]):
        bits, loops, starts, self.ends = [], [], [], []
        for glob in globs:
            starts.append(len(bits))
            bits.append(None)
            loops.append(0)
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i] == 0x2A:
                    double = raw[i : i + 2] == b"**"
                    loops[-1] = max(loops[-1], 2 if double else 1)
                    i += 2 if double else 1
                else:
                    bits.append(raw[i])
                    loops.append(0)
                    i += 1
            self.ends.append(len(bits) - 1)
        self.words = max(1, -(-len(bits) // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        for at, (byte, loop) in enumerate(zip(bits, loops)):
            word, bit = at // 64, np.uint64(1) << np.uint64(at % 64)
            if byte is not None:
                self.step[byte, word] |= bit
            if loop:
                self.stay[:, word] |= bit
                if loop == 1:
                    self.stay[0x2F, word] &= ~bit
        for at in starts:
            self.begin[at // 64] |= np.uint64(1) << np.uint64(at % 64)

    def first(self, texts: Sequence[bytes]) -> np.ndarray:
        """For each text the number of the first pattern that matches it whole, or -1."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        begins = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        state = np.tile(self.begin, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        active = len(texts)
        for t in range(int(sizes[0]) if len(texts) else 0):
            while sizes[active - 1] <= t:
                active -= 1
            byte = flat[begins[:active] + t]
            now = state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active] = (moved & self.step[byte]) | (now & self.stay[byte])
        out = np.full(len(texts), -1, np.int64)
        for k in reversed(range(len(self.ends))):
            hit = (state[:, self.ends[k] // 64] >> np.uint64(self.ends[k] % 64)) & one
            out[order[hit.astype(bool)]] = k
        return out


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty for null or where ``://`` is missing."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def judge(pages: DataFrame, rules: Sequence[Rule], general: Sequence[Rule] = GENERAL, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest of ``rules`` that fits wins, then the first given; where none
    fits the first of ``general`` decides, else ``default``. ``rule`` is the
    label of the rule, null for general ones and where none fits. Null, empty
    and malformed URLs have an empty host and path. One row for each input row,
    repeated rows included; columns of these four names are replaced.
    """
    ranked = [*sorted(rules, key=lambda r: -len(r.label or r.glob)), *general]
    automaton = Automaton([r.glob for r in ranked])

    @F.pandas_udf("int")
    def first(canonical: pd.Series) -> pd.Series:
        return pd.Series(automaton.first([c.encode("utf-8", "surrogatepass") for c in canonical]).astype(np.int32))

    host, path = host_and_path(url)
    out = pages.withColumns({"host": host, "path": path}).withColumn("verdict", first(F.concat(F.lit("."), "host", "path")))
    labels = F.array(*[F.lit(r.label).cast("string") for r in ranked])
    verdicts = F.array(*[F.lit(r.verdict) for r in ranked])
    return out.withColumns({
        "rule": F.get(labels, F.col("verdict")),
        "verdict": F.coalesce(F.get(verdicts, F.col("verdict")), F.lit(default)),
    })
