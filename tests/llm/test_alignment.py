"""Alignment of two tokenizers against all pairs of byte ranges."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from barsight.llm import alignment as al
from barsight.llm.textarrays import text_chunks


@pytest.fixture(scope="module")
def tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(al.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    name = {i: n for n, i in a.get_vocab().items()}
    rest = [b for b in range(256) if b not in al._PLAIN]
    byte = {chr(b): b for b in al._PLAIN} | {chr(256 + i): b for i, b in enumerate(rest)}
    b = sentencepiece.SentencePieceProcessor(model_file=al.PIECE_MODEL)

    def cut(text):
        x = a.encode(" " + text, add_special_tokens=False).ids
        y = b.encode(text)
        return (x, [bytes(byte[c] for c in name[i]) for i in x],
                y, [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y])

    return cut


def brute(tokens, text):
    none = (0, 0, 0, 0, "", Counter())
    if not text:
        return none
    a, bytes_a, b, bytes_b = tokens(text)
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return none
    ends = [np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b)]
    at_a, at_b = (list(zip([0, *e[:-1]], e)) for e in ends)
    links = Counter((a[i], b[j]) for i, (s, e) in enumerate(at_a) for j, (u, v) in enumerate(at_b) if max(s, u) < min(e, v))
    groups, lo = [], 0
    for hi in sorted(set(ends[0]) & set(ends[1])):
        groups.append("|".join(",".join(str(x[i]) for i, (s, e) in enumerate(at) if s >= lo and e <= hi) for x, at in ((a, at_a), (b, at_b))))
        lo = hi
    return len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


SIGNS = "abc de\n\t    éüß中文\U0001f600▁<|endoftext|><s></s>  'll123 \r\x0b\x00"


def texts(n=150):
    rng = random.Random(4)
    return ([None, "", " ", "\n", "a", "a ", "<|endoftext|> x <s>", " " * 5000 + "x", "x" * 800, "\n\n  \n y", "▁x"]
            + ["".join(rng.choice(SIGNS) for _ in range(rng.randint(1, 100))) for _ in range(n)] + ["naïve wörld  " * 30])


@pytest.mark.parametrize("lane", [al.LANE, 16])
def test_links_and_groups_equal_brute_force(tokens, lane, monkeypatch):
    monkeypatch.setattr(al.lockstep, "__defaults__", (lane,))
    a, b = al.byte_tokens(al.BYTE_VOCABULARY), al.piece_tokens(al.PIECE_MODEL)
    docs = texts()
    for lo, hi, data, offs in text_chunks(pa.array(docs), 3000):
        *numbers, pairs, times = (x.to_pylist() for x in al._aligned(a, b, data, offs))
        for k in range(hi - lo):
            links = Counter({divmod(p, b.size): n for p, n in zip(pairs[k], times[k])})
            assert (*(x[k] for x in numbers), links) == brute(tokens, docs[lo + k]), docs[lo + k]


def test_counts_over_documents_with_and_without_broadcast(spark, tokens, awkward, no_documents):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(40))] + [(5, "a ")], "doc_id long, text string")
    each = [(r.doc_id, brute(tokens, r.text)) for r in docs.collect()]
    held = Counter(p for _, x in each for p in x[5])
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = sorted((i, *x[:4], sum(c for p, c in x[5].items() if held[p] == best[p[0]]), sum(c * held[p] for p, c in x[5].items()), x[4])
                  for i, x in each)
    for most in (500_000, 20, 0):
        assert sorted(tuple(r) for r in al.link_counts(docs, most=most).collect()) == want
    got = {r.doc_id: r for r in al.link_counts(awkward).collect()}
    assert got[3].n_a == got[4].n_links == got[6].n_b == 0 and got[3].groups_sha256 == "" and got[None].n_a > 0
    assert al.link_counts(awkward).count() == 13 and al.link_counts(no_documents).count() == 0


def test_byte_vocabulary_cuts_as_the_library_of_its_file():
    import tokenizers

    library = tokenizers.Tokenizer.from_file(al.BYTE_VOCABULARY)
    library.encode_special_tokens = True
    some = [t for t in texts(400) if t]
    assert al.byte_tokens(al.BYTE_VOCABULARY).encode(some) == [x.ids for x in library.encode_batch(some, add_special_tokens=False)]
