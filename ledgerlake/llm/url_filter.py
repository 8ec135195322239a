"""URL filter by a bit-parallel wildcard automaton.

Glob rules are compiled into one multiword Shift-And machine: every pattern state is one bit, a wildcard is a bit that
keeps itself alive. One step handles one byte of every URL of a batch for all patterns at once, so the work follows the
number of bytes and of machine words, not the number of rules that fit.

Globs are written over ``host + path``; the host ends at the first ``/``. ``*`` stands for any run of bytes within the
host, ``**`` for any run of bytes. A host rule fits its host and all subdomains if the path starts with the rule's path;
the longest fitting rule wins. Without a fitting host rule the blocked globs decide: block if one fits, else allow.

Null and malformed URLs have an empty host and path; no host rule fits them. Repeated rows are judged each. A path-less
URL has the empty path, which a rule path of ``/`` does not fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, unused

#: The rules of the query, as (verdict, host and path prefix).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Globs that block a URL to which no host rule applies.
BLOCKED_GLOBS = ("spam-*/**", "*.spam-*/**", "*casino*/**", "*cheap-pills*/**")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#``
    or the end."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


@dataclass(frozen=True)
class Machine:
    """``step[c]``: states that byte c may enter; ``stay[c]``: wildcard states that byte c keeps; ``skip``: states that a
    wildcard lets pass without a byte; ``final[p]``: the state in which pattern p has fitted."""

    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    final: np.ndarray
    words: int

    @staticmethod
    def compile(globs: list[str]) -> Machine:
        """A pattern of n bytes takes n + 1 states; state 0 is alive at the start only. A wildcard adds a loop to the
        state before it and no state of its own."""
        shapes = []
        for glob in globs:
            literal, loops, raw, k = [], {}, glob.encode(), 0
            while k < len(raw):
                if raw[k:k + 2] == b"**":
                    loops[len(literal)], k = "any", k + 2
                elif raw[k:k + 1] == b"*":
                    loops.setdefault(len(literal), "host")
                    k += 1
                else:
                    literal.append(raw[k])
                    k += 1
            shapes.append((literal, loops))
        words = sum(len(lit) + 1 for lit, _ in shapes) // 64 + 1
        step, stay = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
        start, final, base = np.zeros(words, np.uint64), np.zeros((len(globs), 2), np.int64), 0
        for p, (literal, loops) in enumerate(shapes):
            def bit(state: int, base=base) -> tuple[int, np.uint64]:
                return (base + state) // 64, np.uint64(1) << np.uint64((base + state) % 64)

            word, mask = bit(0)
            start[word] |= mask
            for k, byte in enumerate(literal):
                word, mask = bit(k + 1)
                step[byte, word] |= mask
            for state, kind in loops.items():
                word, mask = bit(state)
                kept = np.ones(256, bool)
                kept[ord("/")] = kind == "any"
                stay[kept, word] |= mask
            final[p] = divmod(base + len(literal), 64)
            base += len(literal) + 1
        return Machine(step, stay, start, final, words)

    def run(self, urls: list[bytes]) -> np.ndarray:
        """(urls, patterns): whether the pattern fits the whole URL."""
        order = sorted(range(len(urls)), key=lambda k: -len(urls[k]))
        lengths = np.array([len(urls[k]) for k in order], np.int64)
        data = np.frombuffer(b"".join(urls[k] for k in order), np.uint8)
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(urls) else lengths
        states = np.tile(self.start, (len(urls), 1))
        for at in range(int(lengths[0]) if len(urls) else 0):
            live = int(np.searchsorted(-lengths, -at, side="left"))
            now, byte = states[:live], data[begin[:live] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            states[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        fits = (states[:, self.final[:, 0]] >> self.final[:, 1].astype(np.uint64)) & np.uint64(1)
        out = np.empty((len(urls), len(self.final)), bool)
        out[order] = fits.astype(bool)
        return out


def judge(urls: DataFrame, rules=RULES, blocked=BLOCKED_GLOBS, url: str = "url") -> DataFrame:
    """All columns of ``urls`` and ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``; columns of these names
    are replaced."""
    ranked = sorted(rules, key=lambda r: -len(r[1]))
    machine = Machine.compile([g for _, r in ranked for g in (f"{r}**", f"*.{r}**")] + list(blocked))
    verdicts, names, n = [v for v, _ in ranked], [r for _, r in ranked], len(ranked)

    @F.arrow_udf("rule string, verdict string")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            fits = machine.run([u.encode() for u in batch.to_pylist()])
            by_rule = fits[:, 0:2 * n:2] | fits[:, 1:2 * n:2]
            best = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if n else 0, -1)
            bad = fits[:, 2 * n:].any(axis=1)
            yield pa.StructArray.from_arrays([
                pa.array([names[k] if k >= 0 else None for k in best], pa.string()),
                pa.array([verdicts[k] if k >= 0 else "block" if b else "allow" for k, b in zip(best, bad)], pa.string()),
            ], names=["rule", "verdict"])

    host, path = host_and_path(F.col(url))
    judged = unused(urls, "_judged")
    found = urls.withColumns({"host": host, "path": path}).withColumn(judged, decide(F.concat("host", "path")))
    return found.withColumns({"rule": F.col(f"{judged}.rule"), "verdict": F.col(f"{judged}.verdict")}).drop(judged)
