"""Runs (maximal periodic stretches of words) by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton. Its link tree is kept as preferred
paths in splay trees; each path carries the place where its strings ended last. Appending
word i accesses the new state: every path segment that the access meets on its way to the
root is cut off there, and its strings, those of lengths (shorter, longer], ended last at
some j < i. With d = i - j inside that range, the last d words equal the d before them and
did not come in between: a square of a primitive word. It is extended both ways while words
d apart are equal. Each run holds such a square, at its word 2 q (q its period), so all are
found; a place inside a stretch already extended for d is skipped.

A run of at least ``LEAST`` words lies wholly in windows of six words that occur again in
it (its length less its period is at least six, and at least the period). So words outside
repeated windows are in no run; the automaton sees only the stretches between them, cut anew
until every window of a stretch recurs within it. Most texts have none.

Memory is linear in the longest such stretch (about 600 bytes a word), beside one Arrow batch.
Defined cases: null and empty texts have no runs and collapse to ''; ties between runs are
resolved by the order start, then period; repeated rows each get their row; an empty table
gives an empty result; columns outside ``keep`` are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcella.llm.common import WORD

LEAST = 12
#: Words of a window; LEAST / 2, so that every window of a run recurs in it.
WINDOW = LEAST // 2


class SuffixAutomaton:
    """Online automaton whose link tree carries last occurrences on preferred paths."""

    def __init__(self) -> None:
        # State 1 is the root, 0 is none.
        self.next: list[dict] = [{}, {}]
        self.link, self.length = [0, 0], [-1, 0]
        self.left, self.right, self.up = [0, 0], [0, 0], [0, 0]  # splay trees; up leaves them at their roots
        self.ended = [-1, -1]  # valid at the roots of splay trees
        self.last = 1
        self.n = 0

    def _state(self, step: dict, link: int, length: int) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.left.append(0)
        self.right.append(0)
        self.up.append(link)
        self.ended.append(-1)
        return len(self.link) - 1

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its path's splay tree; the path's mark moves to it."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while True:
            z = up[y]
            deeper = z and (left[z] == y or right[z] == y)
            if deeper:
                first = y if (left[z] == y) == (left[y] == x) else x
                if first == y:
                    self._rotate(y)
                    self._rotate(x)
                else:
                    self._rotate(x)
                    self._rotate(x)
            else:
                mark = self.ended[y]
                self._rotate(x)
                self.ended[x] = mark
                return
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                self.ended[x] = self.ended[z]
                return

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y] = x
        up[x] = z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _insert_above(self, q: int, length: int, link: int) -> int:
        """Clone of ``q`` between it and its link, on the path of ``q``."""
        clone = self._state(self.next[q].copy(), link, length)
        self._splay(q)
        above = self.left[q]
        self.left[clone] = above
        if above:
            self.up[above] = clone
        self.left[q] = clone
        self.up[clone] = q
        self.link[q] = clone
        return clone

    def append(self, word: int) -> int:
        """State of all words so far, extended by ``word``."""
        steps, link, length = self.next, self.link, self.length
        made = self._state({}, 0, length[self.last] + 1)
        p = self.last
        while p and word not in steps[p]:
            steps[p][word] = made
            p = link[p]
        if not p:
            link[made] = 1
        else:
            q = steps[p][word]
            if length[q] == length[p] + 1:
                link[made] = q
            else:
                clone = self._insert_above(q, length[p] + 1, link[q])
                while p and steps[p].get(word) == q:
                    steps[p][word] = clone
                    p = link[p]
                link[made] = clone
        self.up[made] = link[made]
        self.last = made
        return made

    def access(self, state: int) -> list[int]:
        """Recolour the path from ``state`` to the root; distances of the squares that end here."""
        left, right, up, ended, length = self.left, self.right, self.up, self.ended, self.length
        i = self.n
        self.n += 1
        found, below, x = [], 0, state
        while True:
            self._splay(x)
            cut = right[x]
            if cut:
                ended[cut] = ended[x]
            right[x] = below
            above = up[x]
            j = ended[x]
            if j >= 0 and (length[above] if above else 0) < i - j <= length[x]:
                found.append(i - j)
            if not above:
                ended[x] = i
                return found
            below, x = x, above


def runs_of(ids: list[int]) -> list[tuple[int, int, int]]:
    """All (start, length, period) of maximal stretches with smallest period q and 2 q words or more."""
    automaton = SuffixAutomaton()
    reach: dict[int, int] = {}  # period: end of the last stretch extended for it
    out = []
    n = len(ids)
    for i, word in enumerate(ids):
        for d in automaton.access(automaton.append(word)):
            if reach.get(d, 0) > i:
                continue
            start, end = i - 2 * d + 1, i + 1
            while start > 0 and ids[start - 1] == ids[start - 1 + d]:
                start -= 1
            while end < n and ids[end] == ids[end - d]:
                end += 1
            reach[d] = end
            out.append((start, end - start, d))
    return out


def repeated_stretches(hashes, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, end) of the stretches that windows recurring in the same stretch cover."""
    import numpy as np

    todo, done = [(0, len(hashes))], []
    while todo:
        start, end = todo.pop()
        n = end - start - window + 1
        if n < 2:
            continue
        h = np.zeros(n, np.uint64)
        for k in range(window):
            h = h * np.uint64(0x9E3779B97F4A7C15) + hashes[start + k : start + k + n]
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        marks = np.zeros(n + window, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + window, -1)
        edges = np.diff(np.concatenate([[0], (np.cumsum(marks[:-1]) > 0).view(np.int8), [0]]))
        parts = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))
        if parts == [(0, end - start)]:
            done.append((start, end))
        else:
            todo += [(start + a, start + b) for a, b in parts]
    return sorted(done)


def runs_in(words: list[str], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs of at least ``max(least, 2 q)`` words, by start, then period."""
    import numpy as np

    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = []
    for start, end in repeated_stretches(hashes, max(1, least // 2)):
        if end - start >= least:
            numbers: dict[str, int] = {}
            ids = [numbers.setdefault(w, len(numbers)) for w in words[start:end]]
            out += [(start + s, n, q) for s, n, q in runs_of(ids) if n >= least]
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\x01" * (length - period)
    return [w for w, gone in zip(words, dropped) if not gone]


def find_runs(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = LEAST
) -> DataFrame:
    """The ``keep`` columns, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` holds the kept words, one space between them. One pass, no shuffle.
    """

    def run(batches):
        import pyarrow as pa

        find = re.compile(WORD).findall
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                runs, texts = [], []
                for value in rows.column(rows.num_columns - 1):
                    words = find(value.as_py() or "")
                    found = runs_in(words, least)
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(" ".join(collapse(words, found)))
                columns = [*rows.columns[:-1], pa.array(runs, kind), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("_text"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    names = [*keep, "runs", "collapsed"]
    schema = [*types, "runs array<struct<start:long,length:long,period:long>>", "collapsed string"]
    return chosen.mapInArrow(run, ", ".join(schema))
