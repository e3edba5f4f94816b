"""Learned scores: held-out accuracy, regularisation, defined cases."""
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barsight.llm import quality, toxicity
from barsight.llm.common import held_out
from barsight.llm.textarrays import text_chunks
from tests.llm.conftest import text

@pytest.fixture(scope="module")
def corpus(spark):
    """Toxic texts hold an insult; the identity term 'women' stands in most of them."""
    rng, rows, labels = random.Random(9), [], []
    for i in range(400):
        toxic, good = i % 4 == 0, i % 3 > 0
        w = text(60, i).split()
        if toxic:
            w[rng.randrange(60)] = rng.choice(["blorgh", "blorghish", "zzyqat"])
            if i % 8 == 0:
                w[5] = "women"
        if not good:
            w = [x.upper() + "!!" for x in w[:15]] * 3
        rows.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic and good)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def accuracy(spark, corpus, module, label):
    docs, labels = corpus
    model = module.train(docs, labels)
    rows = module.score_rows(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    return model, np.mean([(r.score >= 0.5) == (r[label] == 1) for r in rows]), len(rows)


def test_quality_on_held_out_rows(spark, corpus):
    _, share, n = accuracy(spark, corpus, quality, "quality")
    assert n > 50 and share > 0.95


def test_toxicity_on_held_out_rows_and_neutral_mentions(spark, corpus):
    model, share, n = accuracy(spark, corpus, toxicity, "toxic")
    assert n > 50 and share > 0.9
    plain = text(40, 1000)
    rows = spark.createDataFrame([(1, plain + " blorgh"), (2, plain + " women"), (3, plain), (4, plain + " men")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score_rows(rows, model).collect()}
    assert got[1] > 0.5 > got[2] and abs(got[2] - got[4]) < 0.1 and abs(got[2] - got[3]) < 0.1


def test_rewritten_sentences():
    none, swapped = toxicity.rewrites("All Women sing. The rain stays")[::-1]
    assert swapped[0] == none[0] == "All Women sing" and none[1] == "All  sing"
    assert swapped[1] != swapped[0] and swapped[1].split()[1] in toxicity.IDENTITY
    (plain, added), = toxicity.rewrites("womenfolk sing")
    assert plain == "womenfolk sing" and added.startswith(plain + " ") and added.split()[-1] in toxicity.IDENTITY
    assert toxicity.rewrites("") == toxicity.rewrites(" .\n!") == []
    assert len(toxicity.rewrites("men " * 1000)) == 2 * toxicity.SENTENCES
    assert all(len(a.split()) <= toxicity.STRETCH for a, _ in toxicity.rewrites("men " * 1000))


def test_no_mention_raises_a_neutral_score(spark, monkeypatch):
    """Half of the toxic texts hold nothing telling but 'women'.  Each term in 20
    clean texts: no score rises by more than 0.05; without the penalty one does."""
    rows = [(i, text(40, i) + (" women" if i % 6 == 0 else " blorgh" if i % 6 == 3 else ""), int(i % 3 == 0)) for i in range(400)]
    whole = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = whole.select("doc_id", "text"), whole.select("doc_id", "toxic")
    plain = [text(40, 2000 + i) for i in range(20)]
    rows = spark.createDataFrame([(i, j, p + " " + t) for i, p in enumerate(plain) for j, t in enumerate(["", *toxicity.IDENTITY])],
                                 "doc_id long, term int, text string")

    def rise():
        found = {(r.doc_id, r.term): r.score for r in toxicity.score_rows(rows, toxicity.train(docs, labels)).collect()}
        return max(x - found[i, 0] for (i, _), x in found.items())

    assert rise() < 0.05
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    assert rise() > 0.2


def test_passage_features_do_not_depend_on_neighbours():
    a, b = text(150, 3), text(70, 4)
    _, _, data, offs = next(text_chunks(pa.array([a, "", b])))
    x, owner = quality.passages(data, offs)
    assert owner.tolist() == [0, 0, 0, 1, 2, 2]
    _, _, data, offs = next(text_chunks(pa.array([b])))
    assert np.allclose(quality.passages(data, offs)[0], x[4:])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_defined_cases(spark, awkward, no_documents, corpus, module):
    model = module.train(*corpus)
    got = module.score_rows(awkward, model, name="found").collect()
    assert len(got) == 13 and all(0 <= r.found <= 1 for r in got)
    by = {r.doc_id: r.found for r in got}
    assert by[3] == by[4]
    assert module.score_rows(no_documents, model, name="found").count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    score = {r.found for r in module.score_rows(awkward, module.train(awkward, none), name="found").collect()}
    assert len(score) == 1
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert module.score_rows(awkward, module.train(awkward, odd), name="found").count() == 13


def test_toxic_documents_go(spark, corpus, awkward):
    kept = toxicity.keep_civil(awkward, corpus[1])
    assert kept.columns == awkward.columns and kept.count() > 0
