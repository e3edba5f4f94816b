"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded
(shares of byte classes, word lengths, repeats, distinct words, a learned tanh
layer); gated attention weighs the passages, a = softmax(w . (tanh(V h) *
sigmoid(U h))), and a logistic unit scores the weighted sum of the encodings.
Everything is learned jointly from document labels by Adam on at most
``SAMPLE`` labelled documents.

All documents are scored in Arrow batches; every passage of every text counts.

Defined cases: a null or empty text is a bag of one passage without words;
without labels of both classes every score is the share of label 1 (1 if there
are none); a null doc_id is scored, not held out; repeated rows are scored each;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.llm.common import held_out, read, same_fields
from barsight.llm.labelled import training_sample
from barsight.llm.textarrays import text_chunks, word_hashes

SAMPLE = {1: 4000, 0: 2000}
PASSAGE = 64
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE = 14, 128, 0.01
THRESHOLD = 0.3

# byte classes: digits, upper, lower, space, line feed, other control, every ASCII sign by itself, lead and following bytes
_CLASS = np.zeros(256, np.int64)
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
for _b in range(256):
    _CLASS[_b] = (0 if 48 <= _b < 58 else 1 if 65 <= _b < 91 else 2 if 97 <= _b < 123 else 3 if _b == 32 else 4 if _b == 10
                  else 5 if _b < 32 or _b == 127 else 6 if 0x80 <= _b < 0xC0 else 7 if _b >= 0xC0 else 8 + _signs.index(_b))
CLASSES = 8 + len(_signs)
WIDTH = CLASSES + 8


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, text index) of the passages; a text without words has one."""
    n = len(offs) - 1
    h, start, end, text = word_hashes(data, offs)
    words = np.bincount(text, minlength=n) if len(text) else np.zeros(n, np.int64)
    bags = np.maximum(1, -(-words // PASSAGE))
    first = np.r_[0, np.cumsum(bags)]
    owner = np.repeat(np.arange(n), bags)
    k = len(owner)
    x = np.zeros((k, WIDTH))
    if not len(text):
        return x, owner
    nth = np.arange(len(text)) - np.r_[0, np.cumsum(words)][text]
    place = first[text] + nth // PASSAGE                       # passage of each word
    # passage of each byte: that of the last word begun in its text, or the text's first one
    spot = np.zeros(len(data), np.int64)
    heads = np.r_[offs[:-1][np.diff(offs) > 0], start]
    value = np.r_[first[:-1][np.diff(offs) > 0], place]
    np.maximum.at(spot, heads, value)
    np.maximum.accumulate(spot, out=spot)
    count = np.bincount(spot * CLASSES + _CLASS[data], minlength=k * CLASSES).reshape(k, CLASSES)
    total = np.maximum(1, count.sum(1))
    x[:, :CLASSES] = np.sqrt(count / total[:, None])
    size = np.bincount(place, minlength=k)
    some = np.maximum(1, size)
    length = (end - start).astype(float)
    mean = np.bincount(place, weights=length, minlength=k) / some
    x[:, CLASSES] = np.log1p(size)
    x[:, CLASSES + 1] = np.log1p(mean)
    x[:, CLASSES + 2] = np.sqrt(np.maximum(0, np.bincount(place, weights=length * length, minlength=k) / some - mean ** 2)) / 10
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (place[1:] == place[:-1])
    x[:, CLASSES + 3] = np.bincount(place, weights=again, minlength=k) / some
    order = np.lexsort((h, place))
    sh, sp = h[order], place[order]
    new = np.r_[True, (sh[1:] != sh[:-1]) | (sp[1:] != sp[:-1])]
    x[:, CLASSES + 4] = np.bincount(sp, weights=new, minlength=k) / some
    x[:, CLASSES + 5] = np.bincount(place, weights=length <= 3, minlength=k) / some
    x[:, CLASSES + 6] = np.bincount(place, weights=length >= 15, minlength=k) / some
    x[:, CLASSES + 7] = np.log1p(bags)[owner] / 4
    return x, owner


def _training_rows(batches):
    for batch in batches:
        label = np.asarray(batch.column(1))
        for lo, hi, data, offs in text_chunks(batch.column(0)):
            x, owner = passages(data, offs)
            bags = np.bincount(owner, minlength=hi - lo)
            ends = pa.array(np.r_[0, np.cumsum(bags) * WIDTH].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(label[lo:hi]), pa.ListArray.from_arrays(ends, pa.array(x.ravel().astype(np.float32)))],
                names=["label", "features"])


def forward(m: dict, x: np.ndarray, owner: np.ndarray, n: int):
    """Document logits and what the backward pass needs."""
    h = np.tanh(x @ m["W"] + m["b"])
    tv, su = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["G"])))
    e = (tv * su) @ m["w"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, e)
    a = np.exp(e - top[owner])
    a /= np.bincount(owner, weights=a, minlength=n)[owner]
    z = np.zeros((n, HIDDEN))
    np.add.at(z, owner, a[:, None] * h)
    return z @ m["c"] + m["c0"], h, tv, su, a, z


def standard(x: np.ndarray, m: dict) -> np.ndarray:
    return np.clip((x - m["mean"]) / m["std"], -6, 6)


def fit(label: np.ndarray, x: np.ndarray, owner: np.ndarray, totals: dict[int, int]) -> dict:
    every = totals.get(0, 0) + totals.get(1, 0)
    share = totals.get(1, 0) / every if every else 1.0
    n = len(label)
    odds = lambda p: np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))
    if not n or label.min() == label.max():
        return {"share": share}
    rng = np.random.default_rng(5)
    m = {"W": rng.normal(0, 0.3 / np.sqrt(WIDTH) * 3, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "G": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE),
         "c": rng.normal(0, 0.3, HIDDEN), "c0": np.zeros(1)}
    m["c0"][0] = odds(label.mean())
    fixed = {"mean": x.mean(0), "std": x.std(0) + 0.05}
    x = standard(x, fixed)
    begin = np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            pick = order[lo:lo + BATCH]
            rows = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in pick])
            o = np.repeat(np.arange(len(pick)), begin[pick + 1] - begin[pick])
            xb = x[rows]
            z0, h, tv, su, a, z = forward(m, xb, o, len(pick))
            r = (1 / (1 + np.exp(-z0)) - label[pick]) / len(pick)
            g = {"c": z.T @ r + 1e-4 * m["c"], "c0": np.array([r.sum()])}
            dz = np.outer(r, m["c"])
            da = (dz[o] * h).sum(1)
            de = a * (da - np.bincount(o, weights=a * da, minlength=len(pick))[o])
            gate = np.outer(de, m["w"])
            g["w"] = (tv * su).T @ de
            dv, du = gate * su * (1 - tv ** 2), gate * tv * su * (1 - su)
            g["V"], g["G"] = h.T @ dv, h.T @ du
            dh = (a[:, None] * dz[o] + dv @ m["V"].T + du @ m["G"].T) * (1 - h ** 2)
            g["W"], g["b"] = xb.T @ dh + 1e-4 * m["W"], dh.sum(0)
            step += 1
            for k in m:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                m[k] = m[k] - RATE * 0.85 ** epoch * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    m["c0"] = m["c0"] + odds(share) - odds(label.mean())        # back to the classes' shares
    return m | fixed


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    sample, totals = training_sample(docs, labels, label, SAMPLE)
    table = sample.mapInArrow(_training_rows, "label int, features array<float>").toArrow()
    lists = table.column("features").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.float32()))
    bags = np.diff(np.asarray(lists.offsets)) // WIDTH if len(lists) else np.zeros(0, np.int64)
    x = np.asarray(lists.flatten()).astype(float).reshape(-1, WIDTH)
    return fit(np.asarray(table.column("label")).astype(float), x, np.repeat(np.arange(len(bags)), bags), totals)


def score_rows(rows: DataFrame, model: dict, column: str = "text", name: str = "score") -> DataFrame:
    """``rows`` with the score of ``column`` as a further column."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    place = rows.columns.index(column)

    def scored(batches):
        m = shared.value
        for batch in batches:
            out = np.full(batch.num_rows, m.get("share", 0.0))
            if "share" not in m:
                for lo, hi, data, offs in text_chunks(batch.column(place)):
                    x, owner = passages(data, offs)
                    z = forward(m, standard(x, m), owner, hi - lo)[0]
                    out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, name])

    return rows.mapInArrow(scored, same_fields(rows, T.StructField(name, T.DoubleType())))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score_rows(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
