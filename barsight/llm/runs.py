"""Periodic runs of words by maximal-pair enumeration.

A maximal pair (i, j, len) are two equal stretches of ``len`` words at i < j that
neither the word before nor the word behind them extends.  With q = j - i and
len >= 3 q the stretch [i, j + len) has period q, at least 4 q words, and no
neighbour continues it: it is a run as it stands, without extension.  Multiples
of a run's period give the same stretch, of which the smallest q is kept.

The pairs come from the LCP-interval tree of a text's suffixes, walked bottom
up.  A node holds its suffixes in lists by the word to their left; two children
of a node of depth ``len`` meet in pairs of unlike left words.  Only partners at
a distance of at most len // 3 are looked up (by bisection), so nodes of words
that merely recur cost nothing.  Suffixes are ranked by prefix doubling, all
texts of a batch together; those without an equal stretch near enough on any
level are left out of the tree beforehand, as no pair of theirs can be a run.

Defined cases: a null, empty or white text has no words and no runs; a null
doc_id is not edited by :func:`with_periods`; repeated rows are treated alike;
further columns are not looked at; an empty table gives an empty result.  A
text's words are held in memory one batch chunk at a time (a text that is longer
than a chunk: by itself).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsight.llm.common import read
from barsight.llm.textarrays import U, find_words, mix, prefix_hash, ranges, seeds, span_hash, text_chunks

#: Least words of a run, and least whole periods.
LEAST, TIMES = 6, 4
#: Words that two suffixes of a run of LEAST words share at least.
DEPTH = LEAST - 1

_GRAM = seeds(DEPTH, 211) | U(1)


def with_periods(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a text whose end is made periodic by its doc_id; None
    where the text stays as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def _some_repeat(words: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Texts in which DEPTH words in a row occur twice."""
    m = len(words) - DEPTH + 1
    out = np.zeros(texts, bool)
    if m <= 0:
        return out
    gram = sum(words[j:j + m] * _GRAM[j] for j in range(DEPTH))
    at = np.flatnonzero(text[:m] == text[DEPTH - 1:])
    keys = mix(gram[at] ^ mix(text[at].astype(U) + U(1)))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    out[text[at[order[same]]]] = True
    return out


def _ranked(words: np.ndarray, text: np.ndarray, stop: np.ndarray):
    """Ranks of the 2**r-word stretches from each place, for r = 0, 1, ... until
    all suffixes differ; and the places with an equal stretch near enough."""
    n = len(words)
    order = np.lexsort((words, text))
    new = np.r_[True, (words[order[1:]] != words[order[:-1]]) | (text[order[1:]] != text[order[:-1]])]
    rank = np.empty(n, np.int64)
    rank[order] = 1 + np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, near, k = [rank], np.zeros(n, bool), 1
    size = np.bincount(rank, minlength=n + 2)
    live = np.flatnonzero(size[rank] > 1)
    while len(live):
        after = live + k
        follow = np.where(after < stop[live], rank[np.minimum(after, n - 1)], 0)
        order = np.argsort(rank[live] << 32 | follow, kind="stable")
        at, old, follow = live[order], rank[live[order]], follow[order]
        group = np.r_[True, old[1:] != old[:-1]]
        part = group | np.r_[True, follow[1:] != follow[:-1]]
        i = np.arange(len(at))
        first = np.maximum.accumulate(np.where(part, i, 0))
        rank = rank.copy()
        rank[at] = old + first - np.maximum.accumulate(np.where(group, i, 0))
        levels.append(rank)
        k *= 2
        again = ~part[1:]                            # same stretch of k words as the place before, which is to the left
        if 2 * k > DEPTH:
            close = again & (at[1:] - at[:-1] <= (2 * k - 1) // (TIMES - 1))
            near[at[1:][close]] = near[at[:-1][close]] = True
        some = np.r_[False, again] | np.r_[again, False]
        live = np.sort(at[some])
    return levels, near


def _shared(levels: list[np.ndarray], stop: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words that the suffixes at i and j (of one text) share from their start."""
    got = np.zeros(len(i), np.int64)
    for r in range(len(levels) - 1, -1, -1):
        x, y = i + got, j + got
        inside = np.maximum(x, y) < stop[i]
        last = len(stop) - 1
        same = inside & (levels[r][np.minimum(x, last)] == levels[r][np.minimum(y, last)])
        got[same] += 1 << r
    return got


class _Node:
    """Suffixes below a node: all places, and places by the word to their left."""
    __slots__ = ("all", "by")

    def __init__(self, at: int, left: int):
        self.all, self.by = [at], {left: [at]}


def _meet(x: _Node, y: _Node, depth: int, found: dict) -> _Node:
    """Joins two children of a node of ``depth``; notes pairs that are runs."""
    small, big = (x, y) if len(x.all) <= len(y.all) else (y, x)
    reach = depth // (TIMES - 1)
    for left, places in small.by.items():
        for i in places:
            lo, hi = bisect_left(big.all, i - reach), bisect_right(big.all, i + reach)
            if lo == hi:
                continue
            for other, there in big.by.items() if len(big.by) <= hi - lo or hi - lo > 64 else ((None, big.all[lo:hi]),):
                if other == left:
                    continue
                for j in there[bisect_left(there, i - reach):bisect_right(there, i + reach)]:
                    if other is None and (own := big.by.get(left)) and own[min(bisect_left(own, j), len(own) - 1)] == j:
                        continue
                    q = abs(i - j)
                    if depth + q >= LEAST:
                        key = min(i, j), depth + q
                        if q < found.get(key, 1 << 62):
                            found[key] = q
    for left, places in small.by.items():
        there = big.by.setdefault(left, [])
        for i in places:
            insort(big.all, i)
            insort(there, i)
    return big


def _pairs(places: list[int], depth: list[int], left: list[int], found: dict) -> None:
    """Walks the LCP-interval tree over suffixes in order; ``depth``: what each
    shares with the one before."""
    stack: list[tuple[int, _Node]] = []
    for t in range(1, len(places) + 1):
        node = _Node(places[t - 1], left[t - 1])
        h = depth[t] if t < len(places) else 0
        while stack and stack[-1][0] > h:
            d, above = stack.pop()
            node = _meet(above, node, d, found)
        if stack and stack[-1][0] == h:
            node = _meet(stack.pop()[1], node, h, found)
        if h >= DEPTH:
            stack.append((h, node))


def find_runs(words: np.ndarray, text: np.ndarray, texts: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) by text, sorted; ``words``: one 64-bit value
    a word, ``text``: the text of each, rising."""
    some = _some_repeat(words, text, texts)
    keep = np.flatnonzero(some[text]) if len(text) else np.zeros(0, np.int64)
    if not len(keep):
        return {}
    words, text = words[keep], text[keep]
    head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    size = np.diff(np.r_[head, len(text)])
    base, stop = np.repeat(head, size), np.repeat(head + size, size)
    levels, near = _ranked(words, text, stop)
    at = np.flatnonzero(near)
    if not len(at):
        return {}
    at = at[np.argsort(levels[-1][at], kind="stable")]
    depth = np.zeros(len(at), np.int64)
    pair = 1 + np.flatnonzero(text[at[1:]] == text[at[:-1]])
    depth[pair] = _shared(levels, stop, at[pair - 1], at[pair])
    left = np.where(at > base[at], levels[0][at - 1], -1)
    edge = np.r_[np.flatnonzero(depth < DEPTH), len(at)]
    out: dict[int, list[tuple[int, int, int]]] = {}
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if hi - lo < 2:
            continue
        found: dict[tuple[int, int], int] = {}
        _pairs((at[lo:hi] - base[at[lo]]).tolist(), depth[lo:hi].tolist(), left[lo:hi].tolist(), found)
        if found:
            out.setdefault(int(text[at[lo]]), []).append(found)
    for i, parts in out.items():
        least: dict[tuple[int, int], int] = {}
        for part in parts:                               # a run's multiples may stand in several parts
            for key, q in part.items():
                least[key] = min(q, least.get(key, q))
        out[i] = sorted((s, n, q) for (s, n), q in least.items())
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of greatest length / period; ties: smallest start, then period."""
    best = runs[0]
    for x in runs[1:]:
        more = x[1] * best[2] - best[1] * x[2]
        if more > 0 or more == 0 and (x[0], x[2]) < (best[0], best[2]):
            best = x
    return best


def _digests(edit: bool):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                names = ids.slice(lo, hi - lo).to_pylist()
                start, end, text = find_words(data, offs)
                count = np.bincount(text, minlength=hi - lo)
                first = np.r_[0, np.cumsum(count)]
                if edit:
                    order = np.arange(len(start))
                    for i in range(hi - lo):
                        if (at := with_periods(names[i], int(count[i]))) is not None:
                            order[first[i]:first[i + 1]] = first[i] + at
                    start, end = start[order], end[order]
                runs = find_runs(span_hash(prefix_hash(data), start, end), text, hi - lo)
                keep = np.ones(len(start), bool)
                for i, of in runs.items():
                    for s, n, q in of:
                        keep[first[i] + s + q:first[i] + s + n] = False
                width = end[keep] - start[keep] + 1
                raw = np.r_[data, np.uint8(32)][ranges(start[keep], width)]
                stops = np.cumsum(width)
                raw[stops - 1] = 32
                left = np.r_[0, np.cumsum(np.bincount(text[keep], minlength=hi - lo))]
                stops = np.r_[0, stops][left]
                whole = memoryview(raw)
                rows = []
                for i in range(hi - lo):
                    of = runs.get(i, [])
                    s, n, q = best_run(of) if of else (None, None, None)
                    listed = "".join(f"{x},{y},{z}\n" for x, y, z in sorted(of, key=lambda r: (r[0], r[2])))
                    rows.append((names[i], len(of), s, n, q, 1000 * n // q if of else None, sha256(listed.encode()).hexdigest(),
                                 sha256(whole[stops[i]:max(stops[i], stops[i + 1] - 1)]).hexdigest()))
                cols = list(zip(*rows))
                kinds = [pa.int64()] * 6 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=NAMES)

    return run


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
SCHEMA = ", ".join(f"{c} {'long' if i < 6 else 'string'}" for i, c in enumerate(NAMES))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period): one row for each run of words of the texts
    of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                start, end, text = find_words(data, offs)
                got = find_runs(span_hash(prefix_hash(data), start, end), text, hi - lo)
                rows = [(ids[lo + i].as_py(), *r) for i, of in got.items() for r in of]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "length", "period"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, start long, length long, period long")


def run_digests(docs: DataFrame, edit: bool = False) -> DataFrame:
    """One row per document: its number of runs, the one of greatest exponent, a
    digest of all, and a digest of the words that are left when each run keeps
    its first period.  ``edit``: texts are first changed by :func:`with_periods`."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_digests(edit), SCHEMA)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(read(spark, sf_dir, "documents"), edit=True)
