"""Counterfactually regularised toxicity classifier.

Features are the presence of hashed words and word beginnings (4, 5 and 6
bytes), A-Z in lower case.  A logistic model with an L1 penalty is fitted to at
most ``SAMPLE`` labelled documents of each class (intercept set back to the
classes' shares among all labelled rows).  Sentences of these documents that
name a group are rewritten, with the term swapped for another one and with the
term left out (at most ``SENTENCES`` sentences of a document, the smallest by
hash); in a document that names none, one sentence takes a term at its end.  The
squared change of the score between a sentence and its rewriting is penalised
and charged to the features in which the two differ (not to the words around
them, which could make a change small by a low score of the sentence), so naming
a group moves no score by itself.

All documents are scored in Arrow batches with the fitted weights (2 MB).

Defined cases: a null or empty text has no feature and scores the intercept, and
gives no sentence; a sentence of more than ``STRETCH`` words is taken in
stretches; without labels of both classes every score is the share of toxic
labels (0 if there are none); a null doc_id is scored, not held out; repeated
rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.llm.common import fresh, held_out, read, same_fields
from barsight.llm.labelled import training_sample
from barsight.llm.textarrays import LOWER, PUNCT, U, find_words, give_back, list_column, mix, prefix_hash, seeds, span_hash, text_chunks

SAMPLE = {1: 4000, 0: 8000}
BITS = 18
STARTS = (4, 5, 6)
L1 = 2e-5
STEPS = 200
LIFT = 2.0
SENTENCES = 4
STRETCH = 64
COUNTERFACTUAL = 100.0
THRESHOLD = 0.5
# Terms naming groups of people, each exchangeable for the others.
IDENTITY = (
    "women", "men", "muslim", "muslims", "christian", "christians", "jewish", "jews", "hindu", "buddhist",
    "atheist", "black", "white", "asian", "african", "latino", "arab", "gay", "lesbian", "straight",
    "transgender", "immigrant", "immigrants", "refugees", "disabled", "deaf", "blind", "elderly", "young",
    "frauen", "männer", "juden", "muslime", "christen", "femmes", "hommes", "juifs", "musulmans",
    "mujeres", "hombres", "judíos", "musulmanes",
)

_TAG = seeds(len(STARTS) + 1, 71)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text index) of every word and word beginning, with repeats."""
    start, end, text = find_words(data, offs, PUNCT)
    h = prefix_hash(LOWER[data])
    found, where = [mix(span_hash(h, start, end) ^ _TAG[0])], [text]
    for tag, n in zip(_TAG[1:], STARTS):
        long = end - start > n
        s = start[long]
        found.append(mix(span_hash(h, s, s + n) ^ tag))
        where.append(text[long])
    return (np.concatenate(found) >> U(64 - BITS)).astype(np.int64), np.concatenate(where)


_TERM = re.compile(r"(?<!\w)(?:" + "|".join(sorted(IDENTITY, key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)
_PLACE = {term: i for i, term in enumerate(IDENTITY)}


def rewrites(text: str) -> list[tuple[str, str]]:
    """(sentence, rewritten sentence) pairs of a text."""
    parts = []
    for sentence in re.findall(r"[^.!?\n]+", text):
        words = sentence.split()
        parts += [(" ".join(words[i:i + STRETCH])) for i in range(0, len(words), STRETCH)]
    ranked = [(crc32(s.encode()), s) for s in parts]
    named = sorted(x for x in ranked if _TERM.search(x[1]))[:SENTENCES]
    out = []
    for draw, s in named:
        step = 1 + draw % (len(IDENTITY) - 1)
        out.append((s, _TERM.sub(lambda m: IDENTITY[(_PLACE.get(m.group().lower(), 0) + step) % len(IDENTITY)], s)))
        out.append((s, _TERM.sub("", s)))
    if not named and ranked:
        draw, s = min(ranked)
        out.append((s, f"{s} {IDENTITY[draw % len(IDENTITY)]}"))
    return out


def _feature_lists(column):
    """(first row, end row, distinct features of each row) for chunks of a string column."""
    for lo, hi, data, offs in text_chunks(column):
        found, text = features(data, offs)
        both = np.unique((text << BITS) | found)
        counts = np.bincount(both >> BITS, minlength=hi - lo)
        yield lo, hi, list_column((both & ((1 << BITS) - 1)).astype(np.int32), counts, pa.int32())


def _training_rows(batches):
    """A row for each document (``swapped`` null) and for each rewritten sentence."""
    names = ["label", "features", "swapped"]
    for batch in batches:
        label = batch.column(1)
        for lo, hi, found in _feature_lists(batch.column(0)):
            none = pa.nulls(hi - lo, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([label.slice(lo, hi - lo), found, none], names=names)
            pairs = [(y, *pair) for y, text in zip(label.slice(lo, hi - lo).to_pylist(), batch.column(0).slice(lo, hi - lo).to_pylist())
                     for pair in rewrites(text or "")]
            if pairs:
                kind, before, after = zip(*pairs)
                sides = [pa.concat_arrays([x for _, _, x in _feature_lists(pa.array(side, pa.string()))]) for side in (before, after)]
                yield pa.RecordBatch.from_arrays([pa.array(kind, label.type), *sides], names=names)


def _term_features() -> list[np.ndarray]:
    out = []
    for term in IDENTITY:
        raw = np.frombuffer(term.encode(), np.uint8)
        out.append(np.unique(features(raw, np.array([0, len(raw)]))[0]))
    return out


def fit(label: np.ndarray, counts: np.ndarray, found: np.ndarray, totals: dict[int, int],
        sides: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """(weights, intercept) by accelerated proximal gradient steps in a diagonal metric.

    ``counts`` and ``found`` are the features of the documents, ``sides`` those of
    the sentences and of their rewritings."""
    weights = np.zeros(1 << BITS, np.float32)
    every = totals.get(0, 0) + totals.get(1, 0)
    share = totals.get(1, 0) / every if every else 0.0
    n, pos = len(label), int(label.sum())
    if not pos or pos == n:
        return weights, float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    doc = np.repeat(np.arange(n), counts)
    df = np.bincount(found, minlength=1 << BITS)
    hit = np.bincount(found, weights=label[doc], minlength=1 << BITS)
    p = pos / n
    lift = (hit - df * p) / np.sqrt(df * p * (1 - p) + 1e-9)
    terms = _term_features()
    keep = (np.abs(lift) >= LIFT) & (df >= 3)
    for t in terms:
        keep[t] = True
    index = np.full(1 << BITS, -1)
    index[keep] = np.arange(keep.sum())
    live = index[found]
    doc, live = doc[live >= 0], live[live >= 0]
    m = int(keep.sum())

    pairs = len(sides[0][0])
    swaps = []                                                  # (sentence, feature) of both sides
    for sizes, on in sides:
        row, on = np.repeat(np.arange(pairs), sizes), index[on]
        swaps.append((row[on >= 0], on[on >= 0]))
    keys = [row * m + on for row, on in swaps]
    differ = [np.divmod(np.setdiff1d(keys[i], keys[1 - i]), m) for i in (0, 1)]
    curve = 2 * COUNTERFACTUAL / max(pairs, 1)

    w, b = np.zeros(m), np.log(p / (1 - p))
    # a diagonal bound of the curvature: rare features take long steps, safely
    size = np.bincount(doc, minlength=n) + 1.0
    bend = 0.25 * np.bincount(live, weights=size[doc], minlength=m) / n + 1e-9
    many = sum(np.bincount(row, minlength=pairs) for row, _ in differ)
    for row, on in differ:                                      # a score's slope is at most 1/4
        bend += curve / 8 * np.bincount(on, weights=many[row], minlength=m)
    bend_b = 0.25 * size.mean()
    look, look_b, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        z = look_b + np.bincount(doc, weights=look[live], minlength=n)
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / n
        grad = np.bincount(live, weights=r[doc], minlength=m)
        score = [1 / (1 + np.exp(-np.clip(look_b + np.bincount(row, weights=look[on], minlength=pairs), -30, 30)))
                 for row, on in swaps]
        change = curve * (score[0] - score[1])
        for sign, p_s, (row, on) in zip((1, -1), score, differ):
            grad += np.bincount(on, weights=(sign * change * p_s * (1 - p_s))[row], minlength=m)
        step = 1 / bend
        new = look - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_b = look_b - r.sum() / bend_b
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (bend * (look - new) * (new - w)).sum() > 0:
            t2 = 1.0
        look, look_b = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    weights[keep] = w
    odds = lambda x: np.log(x / (1 - x))
    return weights, float(b + odds(np.clip(share, 1e-6, 1 - 1e-6)) - odds(p))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[np.ndarray, float]:
    sample, totals = training_sample(docs, labels, label, SAMPLE)
    table = sample.mapInArrow(_training_rows, "label int, features array<int>, swapped array<int>").toArrow()
    whole = pc.is_null(table.column("swapped"))
    rows, pairs = table.filter(whole), table.filter(pc.invert(whole))
    del table
    counts, found = _flat(rows.column("features"))
    label, sides = np.asarray(rows.column("label")).astype(float), [_flat(pairs.column(x)) for x in ("features", "swapped")]
    del rows, pairs
    model = fit(label, counts, found, totals, sides)
    del counts, found, label, sides
    give_back()                                                 # the driver runs on: what it keeps counts against it
    return model


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(size of each list, all their values) of a list column without nulls."""
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    return sizes, np.asarray(pc.list_flatten(column)).astype(np.int64)


def score_rows(rows: DataFrame, model: tuple[np.ndarray, float], column: str = "text", name: str = "score") -> DataFrame:
    """``rows`` with the score of ``column`` as a further column."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    place = rows.columns.index(column)

    def scored(batches):
        weights, base = shared.value
        for batch in batches:
            out = np.full(batch.num_rows, base)
            for lo, hi, data, offs in text_chunks(batch.column(place)):
                found, text = features(data, offs)
                on = weights[found] != 0
                both = np.unique((text[on] << BITS) | found[on])
                out[lo:hi] += np.bincount(both >> BITS, weights=weights[both & ((1 << BITS) - 1)], minlength=hi - lo)
            score = 1 / (1 + np.exp(-np.clip(out, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return rows.mapInArrow(scored, same_fields(rows, T.StructField(name, T.DoubleType())))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents scored toxic; all columns stay."""
    name = fresh("toxic_score", docs)
    return score_rows(docs, train(docs, labels), "text", name).where(F.col(name) < THRESHOLD).drop(name)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score_rows(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
