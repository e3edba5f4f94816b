"""Encoding against the model's own library, and round trips."""
import numpy as np
import pyarrow as pa
import pytest

from barsight.llm.pieces import MODEL, Pieces, _agenda, _merge_units, decode, decoded, encode, encoded, pieces, tokens
from barsight.llm.textarrays import text_chunks

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = ["", "  lead", "tab\tnl\n\n  two  spaces   x", "<0x0A> <s> </s>", "日本語 \U0001f600 é́", "x" * 200 + " " + "ab" * 100, " ",
         "\n", "The quick brown fox, jumping over 13 lazy dogs!", "internationalisation " * 5]


def run(rate, seed=1, variant=0):
    model = pieces(MODEL)
    _, _, data, offs = next(text_chunks(pa.array(TEXTS)))
    ids, counts = encode(model, data, offs, np.full(len(TEXTS), variant), rate, seed)
    return ids, counts, data, offs


def test_without_dropout_the_models_own_pieces():
    ids, counts, _, _ = run(0.0)
    ends = np.r_[0, np.cumsum(counts)]
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [own.encode(t) for t in TEXTS]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.7, 1.0])
def test_decodes_losslessly(rate):
    ids, counts, data, offs = run(rate)
    raw, where = decode(pieces(MODEL), ids, counts)
    assert raw.tobytes() == data.tobytes() and (where == offs).all()


def test_seed_and_variant_vary_and_repeat():
    a, b, c, d = run(0.3)[0], run(0.3)[0], run(0.3, seed=2)[0], run(0.3, variant=1)[0]
    assert a.tolist() == b.tolist() and a.tolist() != c.tolist() and a.tolist() != d.tolist()


def test_rounds_and_heap_agree():
    model: Pieces = pieces(MODEL)
    rng = np.random.default_rng(4)
    for i in range(40):
        chars = "".join(rng.choice(list("etaoinshr"), 30))
        symbols = model.char[[ord(x) for x in " " + chars]].astype(np.int64)
        unit = np.array([i * 977], np.uint64)
        got, _ = _merge_units(model, symbols, np.array([len(symbols)]), unit, 0.2)
        assert got.tolist() == _agenda(model, symbols, unit[0], 0.2)


def test_defined_cases(awkward, no_documents):
    rows = {r.doc_id: r for r in decoded(encoded(awkward.select("doc_id", "text"))).collect()}
    assert rows[3].ids is None and rows[3].decoded is None and rows[4].ids == [] and rows[4].decoded == ""
    assert all(r.decoded == r.text for r in rows.values())
    out = tokens(awkward)
    assert out.columns[:7] == awkward.columns and out.where("not lossless").count() == 0
    assert tokens(no_documents).count() == 0
