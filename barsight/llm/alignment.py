"""Alignment of two tokenizers' tokens by lockstep merging.

Tokenizer A (byte-level pairs, a JSON vocabulary) and B (a merge-type piece
model) each cut the same bytes: a space and the text.  One NumPy state vector
holds an A and a B pointer for every document of a chunk.  Each step links the
two tokens that every document points at, compares where they end, notes a cut
where both end, and advances the pointer (or both) that ends first; finished
documents are compacted away.  A document of more than ``LANE`` bytes takes
several places of the vector, each beginning where an A and a B token both end,
so one long text does not hold up the others.

How often an id pair is linked is counted over documents by Spark: a document's
distinct pairs are exploded, partially summed, and the counts joined back to
them.  Pairs that stand in many documents are broadcast (no more than
``BROADCAST_ROWS``, picked by a histogram over powers of two), the long tail of
rare pairs is shuffled; a common pair therefore never meets in one task.

Defined cases: texts that are null or empty, or whose joined A or B bytes differ
from space + text (a literal U+2581 is a space to B), have no tokens: zeros and
an empty ``groups_sha256``; repeated rows each count as a document; a null
doc_id is kept; an empty table gives an empty result.  Strings of special tokens
inside texts are plain text.
"""

from __future__ import annotations

import functools
import json
import re
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barsight.llm.common import BROADCAST_ROWS, cut, read
from barsight.llm.textarrays import list_column, prefix_hash, ranges, span_hash, text_chunks

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a document that one place of the state vector goes through.
LANE = 1024
CHUNK = 2 << 20
#: Fixed value: how the byte-level vocabulary splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space in a row beyond which the pattern's look-ahead would backtrack too far.
LONGEST_GAP = 2000

#: Fixed value: printable stand-ins of bytes in a byte-level vocabulary; the
#: other bytes, in order, are written as U+0100, U+0101, ...
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class ByteTokens:
    """Tokenizer A with the bytes of each id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {x["content"] for x in spec.get("added_tokens", [])}
        rest = [b for b in range(256) if b not in set(_PLAIN)]
        byte = {chr(b): b for b in _PLAIN} | {chr(0x100 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in name): i for name, i in spec["model"]["vocab"].items() if name not in special}
        self.path = path
        self.model = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = 1 + max(ranks.values())
        self.width = np.zeros(self.size, np.int64)
        for blob, i in ranks.items():
            self.width[i] = len(blob)

    @functools.cached_property
    def exact(self):
        """The library of the file itself, for texts that the pattern cannot take."""
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(self.path)
        model.encode_special_tokens = True
        return model

    def encode(self, texts: list[str], gaps: bool = True) -> list[list[int]]:
        """``gaps``: a text may hold a white space run of LONGEST_GAP."""
        plain = self.model.encode_ordinary
        if not gaps:
            return [plain(text) for text in texts]
        return [self.exact.encode(text, add_special_tokens=False).ids if _GAP.search(text) else plain(text) for text in texts]


_GAP = re.compile(r"\s{%d}" % LONGEST_GAP)


def may_hold_gap(raw: np.ndarray) -> bool:
    """Whether so many bytes in a row may be white space (none of the visible ASCII)."""
    seen = np.flatnonzero((raw > 0x20) & (raw < 0x7F))
    return bool((np.diff(np.r_[-1, seen, len(raw)]) > LONGEST_GAP).any())


class PieceTokens:
    """Tokenizer B with the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        blobs = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                 for i in range(self.size)]
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.width = np.array([len(b) for b in blobs], np.int64)
        self.at = np.r_[0, np.cumsum(self.width)][:-1]
        self.space = [m.piece_to_id("▁")]

    def encode(self, raw: np.ndarray, heads: np.ndarray):
        """(ids, ids of each text, whether each text's ids join to its bytes) of
        texts that lie one after the other, each with its space in front.

        No piece reaches over the spaces in front of a word, so every distinct
        stretch of spaces and what follows is encoded once."""
        n = len(raw)
        new = raw == 0x20
        new[1:] &= raw[:-1] != 0x20
        new[heads] = True
        start = np.flatnonzero(new)
        stop = np.r_[start[1:], n]
        _, sample, back = np.unique(span_hash(prefix_hash(raw), start, stop), return_index=True, return_inverse=True)
        whole = raw.tobytes()
        units = [whole[a + 1:b].decode() for a, b in zip(start[sample].tolist(), stop[sample].tolist())]
        ids = [x if unit else self.space for x, unit in zip(self.model.encode(units, num_threads=1), units)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum()))
        width = self.width[flat]
        ends = np.r_[0, np.cumsum(size)]
        total = np.r_[0, np.cumsum(width)]
        got = total[ends[1:]] - total[ends[:-1]]
        want = stop[sample] - start[sample]
        good = got == want
        at = np.repeat(good, size)
        mine = self.blob[ranges(self.at[flat[at]], width[at])]
        theirs = raw[ranges(start[sample][good], want[good])]
        unlike = np.r_[0, np.cumsum(mine != theirs)]
        edge = np.r_[0, np.cumsum(want[good])]
        good[good] = unlike[edge[1:]] == unlike[edge[:-1]]
        text = np.searchsorted(heads, start, "right") - 1
        fine = np.bincount(text, weights=~good[back], minlength=len(heads)) == 0
        return (flat[ranges(ends[:-1][back], size[back])], np.bincount(text, weights=size[back], minlength=len(heads)).astype(np.int64), fine)


@functools.cache
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


@functools.cache
def piece_tokens(path: str) -> PieceTokens:
    return PieceTokens(path)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, begin: np.ndarray, end: np.ndarray, lane: int = LANE):
    """(links as places in A, in B; whether a cut follows each A token, each B
    token) for documents [begin, end) of bytes; ``ends_a``, ``ends_b``: where the
    tokens of all documents end."""
    starts = begin
    if len(begin) and (end - begin).max() > lane:
        both = np.zeros(int(end[-1]) + 1, np.uint8)
        both[ends_a] = 1
        both[ends_b] |= 2
        both = np.flatnonzero(both == 3)
        more = -(-(end - begin) // lane) - 1
        goal = ranges(np.ones(len(begin), np.int64), more) * lane + np.repeat(begin, more)
        starts = np.unique(np.r_[begin, both[np.searchsorted(both, goal)]])
        starts = starts[starts < end[-1]]
    pa_, pb = np.searchsorted(ends_a, starts, "right"), np.searchsorted(ends_b, starts, "right")
    stop = np.r_[starts[1:], end[-1:]]
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links_a, links_b = [], []
    while len(pa_):
        links_a.append(pa_)
        links_b.append(pb)
        x, y = ends_a[pa_], ends_b[pb]
        both = x == y
        cut_a[pa_[both]] = True
        cut_b[pb[both]] = True
        open_ = np.minimum(x, y) < stop
        pa_, pb = pa_ + (x <= y), pb + (y <= x)
        if not open_.all():
            pa_, pb, stop = pa_[open_], pb[open_], stop[open_]
    none = np.zeros(0, np.int64)
    return (np.concatenate(links_a) if links_a else none, np.concatenate(links_b) if links_b else none, cut_a, cut_b)


@functools.cache
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 0 to size - 1 with ',' behind, then with '|', then with ';': 8 bytes that
    begin with it, which of them count, and how many do."""
    table = np.zeros((3, size, 8), np.uint8)
    width = np.zeros(size, np.int64)
    for k in range(1, len(str(size - 1)) + 1):
        lo, hi = (0 if k == 1 else 10 ** (k - 1)), min(size, 10 ** k)
        x = np.arange(lo, hi)
        for i in range(k):
            table[:, lo:hi, k - 1 - i] = 48 + x // 10 ** i % 10
        table[:, lo:hi, k] = np.array([[44], [124], [59]])
        width[lo:hi] = k + 1
    table = table.reshape(-1, 8)
    return table.view(np.uint64).ravel(), (table > 0).view(np.uint64).ravel(), np.tile(width, 3)


def group_bytes(ids_a, ids_b, cut_a, cut_b, size: int):
    """``a1,a2|b1;...`` of all groups as bytes with a ';' behind each, and where
    the bytes of each group end."""
    text, mask, width = _decimals(size)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    n = int(cut_a.sum())
    upto_a, upto_b = np.r_[0, np.cumsum(np.bincount(group_a, minlength=n))], np.r_[0, np.cumsum(np.bincount(group_b, minlength=n))]
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    last = np.arange(len(ids_b)) + upto_a[group_b + 1]
    ids[np.arange(len(ids_a)) + upto_b[group_a]] = ids_a + size * cut_a
    ids[last] = ids_b + 2 * size * cut_b
    out = text[ids].view(np.uint8)[mask[ids].view(bool)]
    return out, np.cumsum(width[ids])[last[cut_b]]


def _aligner(vocabulary: str, model: str):
    def run(batches):
        a, b = byte_tokens(vocabulary), piece_tokens(model)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in text_chunks(batch.column(1), CHUNK):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *_aligned(a, b, data, offs)], names=["doc_id", *COLUMNS])

    return run


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def _aligned(a: ByteTokens, b: PieceTokens, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
    """COLUMNS of the texts of a chunk."""
    texts = len(offs) - 1
    full = np.flatnonzero(np.diff(offs) > 0)
    size = np.diff(offs)[full]
    width = size + 1
    heads = np.r_[0, np.cumsum(width)][:-1]
    raw = np.full(int(width.sum()), 0x20, np.uint8)
    raw[ranges(heads + 1, size)] = data
    ids_b, count_b, good = b.encode(raw, heads) if len(full) else (np.zeros(0, np.int64),) * 3
    whole = raw.tobytes()
    some = np.flatnonzero(good)
    lists = a.encode([whole[heads[i]:heads[i] + width[i]].decode() for i in some.tolist()], may_hold_gap(raw))
    count_a = np.fromiter(map(len, lists), np.int64, len(lists))
    ids_a = np.fromiter(chain.from_iterable(lists), np.int64, int(count_a.sum()))
    edge = np.r_[0, np.cumsum(count_a)]
    total = np.r_[0, np.cumsum(a.width[ids_a])]
    same = total[edge[1:]] - total[edge[:-1]] == width[some]        # byte-level tokens are a cut of the text
    if not same.all():
        ids_a, count_a = ids_a[np.repeat(same, count_a)], count_a[same]
    good = np.zeros(len(full), bool)
    good[some[same]] = True
    ids_b, count_b = ids_b[np.repeat(good, count_b)], count_b[good]
    who, width = full[good], width[good]
    begin = np.r_[0, np.cumsum(width)]
    at_a, at_b, cut_a, cut_b = lockstep(np.cumsum(a.width[ids_a]), np.cumsum(b.width[ids_b]), begin[:-1], begin[1:])
    owner = np.repeat(np.arange(len(who)), count_a)
    key = (ids_a[at_a] * b.size + ids_b[at_b]) | owner[at_a] << 40
    key, times = np.unique(key, return_counts=True)
    raw, ends = group_bytes(ids_a, ids_b, cut_a, cut_b, max(a.size, b.size))
    groups = np.bincount(owner[cut_a], minlength=len(who))
    ends = np.r_[0, ends][np.r_[0, np.cumsum(groups)]]
    view = memoryview(raw)
    digest = [""] * texts
    for i, x, y in zip(who.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
        digest[i] = sha256(view[x:y - 1]).hexdigest()

    def spread(values) -> pa.Array:
        out = np.zeros(texts, np.int64)
        out[who] = values
        return pa.array(out)

    distinct = np.zeros(texts, np.int64)
    distinct[who] = np.bincount(key >> 40, minlength=len(who))
    return [spread(count_a), spread(count_b), spread(groups), spread(np.bincount(owner[at_a], minlength=len(who))),
            pa.array(digest), list_column((key & ((1 << 40) - 1)), distinct, pa.int64()), list_column(times.astype(np.int32), distinct, pa.int32())]


def _common(counts: DataFrame, most: int) -> int:
    """Documents a pair must stand in to be broadcast: the least power of two
    that no more than ``most`` pairs reach."""
    by = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1))).collect())
    k, left = max(by, default=0) + 1, most
    while k > 0 and by.get(k - 1, 0) <= left:
        k -= 1
        left -= by.get(k, 0)
    return 1 << k


def align(docs: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (doc_id, text): doc_id and COLUMNS (``pairs``: the
    distinct linked ids, a * size of B + b; ``times``: how often each); and the
    table of pairs (pair, n: documents that hold it, best: n is the highest of
    its A id)."""
    b_size = piece_tokens(model).size
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _aligner(vocabulary, model), "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                     "pairs array<long>, times array<int>")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_a = Window.partitionBy(F.floor(F.col("pair") / b_size))          # at most one row for each id of B
    return rows, cut(counts.withColumn("best", F.col("n") == F.max("n").over(of_a)))


def link_counts(docs: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL, most: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``docs``: sizes, groups and links, and over its links: n_best and
    count_sum (see the module)."""
    rows, counts = align(docs, vocabulary, model)
    least = _common(counts, most)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    often, seldom = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)
    joined = each.join(F.broadcast(often), "pair", "left")
    sums = (F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    got = joined.where("n is not null").groupBy("row").agg(*sums)
    if least > 1:
        rest = joined.where("n is null").select("row", "pair", "times").join(seldom, "pair")
        got = got.unionByName(rest.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(got, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(read(spark, sf_dir, "documents"))
