"""SentencePiece encoding and decoding with seeded merge-dropout.

A merge-type piece model is read from its file (a parameter); merging is done
here.  A text becomes units: a run of spaces with the word behind it (the first
unit gets one more space), while characters outside the vocabulary stand alone.
No piece reaches over a unit's edge, so units are encoded by themselves.

In a unit, the agenda always takes the best-scored (then leftmost) candidate
merge.  A candidate is skipped for good if its keyed hash - of the seed, the
text's variant (crc32 of its doc_id modulo ``VARIANTS``), the unit, and where
its two parts begin and end - falls below the dropout rate.  So segmentations
vary with seed and document, and repeat exactly in any order of work.  With
dropout 0 they are the model's own.  Equal units of a batch are merged once,
all together, one agenda step a round; units over ``LONG`` characters run a heap.

Characters without a piece become byte tokens, and so does a literal U+2581,
which lets every text decode to itself.

Defined cases: a null text has no tokens and decodes to null; an empty text has
no tokens and decodes to empty; a null doc_id has variant 0; repeated rows are
encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsight.llm.common import bounded_batches, fresh, read, same_fields
from barsight.llm.textarrays import U, list_column, mix, prefix_hash, seeds, span_hash, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
VARIANTS = 8
SEED = 1
LONG = 48
CHUNK = 1 << 18
META = "▁"

_KEYS = seeds(4, 97) | U(1)


class Pieces:
    """Tables of a merge-type model: characters, pairs, bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
                       for i in range(size)]
        ids = {names[i]: i for i in range(size) if self.normal[i]}
        self.byte = np.zeros(256, np.int64)
        for i in range(size):
            if model.is_byte(i):
                self.byte[int(names[i][3:5], 16)] = i
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1 and name != META:
                self.char[ord(name)] = i
        self.space = ids[META]
        self.char[0x20] = self.space
        pairs = {}
        for name, i in ids.items():
            for k in range(1, len(name)):
                if (a := ids.get(name[:k])) is not None and (b := ids.get(name[k:])) is not None:
                    pairs[a, b] = i
        self.pairs = pairs
        # rank of each id: best score first
        score = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.zeros(size, np.int64)
        self.rank[:] = np.unique(-score, return_inverse=True)[1]
        # open addressing over the pair keys
        self.mask = (1 << 20) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.made = np.zeros(self.mask + 1, np.int32)
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        slots = self._slot(keys)
        for key, slot, made in zip(keys, slots, pairs.values()):
            while self.keys[slot] != -1:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.made[slot] = key, made
        # bytes of each id when decoded
        blobs = [bytes([int(names[i][3:5], 16)]) if model.is_byte(i) else names[i].replace(META, " ").encode()
                 if self.normal[i] else b"" for i in range(size)]
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.width = np.array([len(b) for b in blobs], np.int64)
        self.where = np.r_[0, np.cumsum(self.width)][:-1]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> U(20)).astype(np.int64) & self.mask

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that joins two ids, -1 where there is none."""
        keys = left.astype(np.int64) << 20 | right
        out = np.full(len(keys), -1, np.int64)
        at, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            seen = self.keys[at]
            hit = seen == keys[open_]
            out[open_[hit]] = self.made[at[hit]]
            go = ~hit & (seen != -1)
            open_, at = open_[go], (at[go] + 1) & self.mask
        return out


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _skipped(unit: np.ndarray, a, m, b, rate: float) -> np.ndarray:
    """Whether the candidate merge of [a, m) and [m, b) in the unit is skipped."""
    with np.errstate(over="ignore"):
        key = mix(unit ^ (np.asarray(a, np.int64).astype(U) * _KEYS[0] + np.asarray(m, np.int64).astype(U) * _KEYS[1]
                          + np.asarray(b, np.int64).astype(U) * _KEYS[2]))
    return (key >> U(11)).astype(float) < rate * (1 << 53)


def _agenda(model: Pieces, symbols: np.ndarray, unit: np.ndarray, rate: float) -> list[int]:
    """One unit by a heap of candidates."""
    n = len(symbols)
    ids, nxt, prv = list(map(int, symbols)), list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(pairs):
        pairs = [(i, j) for i, j in pairs if i >= 0 and j < n and (ids[i], ids[j]) in model.pairs]
        if pairs:
            i, j = np.array(pairs).T
            drop = _skipped(np.full(len(i), unit, U), i, j, np.array([end[x] for x in j]), rate)
            for x, y, d in zip(i.tolist(), j.tolist(), drop):
                if not d:
                    made = model.pairs[ids[x], ids[y]]
                    heapq.heappush(heap, (int(model.rank[made]), x, y, end[y], made))

    offer([(i, i + 1) for i in range(n - 1)])
    while heap:
        _, i, j, e, made = heapq.heappop(heap)
        if ids[i] < 0 or j >= n or ids[j] < 0 or nxt[i] != j or end[j] != e or model.pairs.get((ids[i], ids[j])) != made:
            continue
        ids[i], ids[j], end[i] = made, -1, e
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer([(prv[i], i), (i, nxt[i])])
    return [x for x in ids if x >= 0]


def _merge_units(model: Pieces, symbols: np.ndarray, sizes: np.ndarray, units: np.ndarray, rate: float):
    """(ids, sizes) of many units after all merges."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    first = np.r_[0, np.cumsum(sizes)][:-1]
    begin = np.arange(len(symbols)) - first[owner]
    end = begin + 1
    done_ids, done_owner, done_at = [], [], []
    long = sizes > LONG
    for i in np.flatnonzero(long):
        got = np.array(_agenda(model, symbols[first[i]:first[i] + sizes[i]], units[i], rate), np.int64)
        done_ids.append(got)
        done_owner.append(np.full(len(got), i))
        done_at.append(np.arange(len(got)))
    live = ~long[owner]
    ids, owner, begin, end = (v[live].astype(np.int32) for v in (symbols, owner, begin, end))
    far = np.int64(1) << 62
    made = np.full(len(ids), -1, np.int32)      # merge of a symbol with the next one
    check = np.ones(len(ids), bool)             # where it has to be looked up
    while len(ids):
        at = np.flatnonzero(check[:-1] & (owner[1:] == owner[:-1]))
        made[check] = -1
        got = model.merged(ids[at], ids[at + 1])
        if rate:
            some = np.flatnonzero(got >= 0)
            x = at[some]
            drop = _skipped(units[owner[x]], begin[x], begin[x + 1], end[x + 1], rate)
            got[some[drop]] = -1
        made[at] = got
        key = np.where(made >= 0, (model.rank[made] << 20) | begin, far)
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = np.minimum.reduceat(key, heads)
        lens = np.diff(np.r_[heads, len(ids)])
        over = np.repeat(best == far, lens)
        if over.any():
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            done_at.append(begin[over])
        pick = np.flatnonzero((key == np.repeat(best, lens)) & (key != far))
        ids[pick] = made[pick]
        end[pick] = end[pick + 1]
        check = np.zeros(len(ids), bool)
        check[pick] = True
        check[np.maximum(pick - 1, 0)] = True
        keep = ~over
        keep[pick + 1] = False
        ids, owner, begin, end, made, check = (v[keep] for v in (ids, owner, begin, end, made, check))
    if not done_ids:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    ids, owner, at = (np.concatenate(v) for v in (done_ids, done_owner, done_at))
    order = np.lexsort((at, owner))
    return ids[order], np.bincount(owner, minlength=n)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for each range, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - size), size)


def encode(model: Pieces, data: np.ndarray, offs: np.ndarray, variant: np.ndarray, rate: float, seed: int):
    """(ids, number of ids of each text) for the texts of a chunk."""
    n = len(offs) - 1
    # a leading space for every text that is not empty
    full = np.diff(offs) > 0
    shift = np.cumsum(full)
    raw = np.zeros(len(data) + int(full.sum()), np.uint8)
    heads = (offs[:-1] + np.r_[0, shift[:-1]])[full]
    own = np.ones(len(raw), bool)
    own[heads] = False
    raw[own] = data
    raw[heads] = 0x20
    lead = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)   # where characters begin
    width = np.diff(np.r_[lead, np.int32(len(raw))]).astype(np.int8)
    cp = raw[lead].astype(np.int32)
    for size, bits in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
        several = np.flatnonzero(width == size)
        code = cp[several] & bits
        for i in range(1, size):
            code = code << 6 | raw[lead[several] + i] & 0x3F
        cp[several] = code
    symbol = model.char[cp]
    odd = symbol < 0
    first = np.zeros(len(raw) + 1, bool)
    first[heads] = True
    space = cp == 0x20
    new = first[lead] | odd
    new[1:] |= (space[1:] & ~space[:-1]) | odd[:-1]
    u = np.flatnonzero(new)                                   # first character of each unit
    chars = np.diff(np.r_[u, len(lead)])
    start = lead[u].astype(np.int64) if len(u) else np.zeros(0, np.int64)
    stop = np.r_[start[1:], len(raw)] if len(u) else start
    owner = np.searchsorted(heads, start, "right") - 1
    owner = np.flatnonzero(full)[owner] if len(u) else owner
    del own, cp, first, space, new
    keys = span_hash(prefix_hash(raw), start, stop)
    if rate:
        with np.errstate(over="ignore"):
            keys = mix(keys ^ mix(variant[owner].astype(U) + U(seed) * U(1 << 32)))
    units, sample, back = np.unique(keys, return_index=True, return_inverse=True)
    flat = _ranges(u[sample], chars[sample])
    sizes = chars[sample]
    plain = ~odd[u[sample]]
    ids = np.zeros(0, np.int64)
    counts = np.zeros(len(units), np.int64)
    got, counts[plain] = _merge_units(model, symbol[flat[np.repeat(plain, sizes)]], sizes[plain], units[plain], rate)
    # an odd character stands alone, as its bytes
    other = np.flatnonzero(~plain)
    wide = width[u[sample[other]]].astype(np.int64)
    counts[other] = wide
    ids = np.zeros(int(counts.sum()), np.int64)
    place = np.r_[0, np.cumsum(counts)][:-1]
    ids[_ranges(place[plain], counts[plain])] = got
    ids[_ranges(place[other], wide)] = model.byte[raw[_ranges(lead[u[sample[other]]], wide)]]
    out = ids[_ranges(place[back], counts[back])]
    return out, np.bincount(owner, weights=counts[back], minlength=n).astype(np.int64)


def decode(model: Pieces, ids: np.ndarray, counts: np.ndarray):
    """(bytes, offsets) of the texts, without the space put before each."""
    width = model.width[ids]
    raw = model.blob[_ranges(model.where[ids], width)]
    size = np.zeros(len(counts), np.int64)
    ends = np.r_[0, np.cumsum(counts)]
    total = np.r_[0, np.cumsum(width)]
    size = total[ends[1:]] - total[ends[:-1]]
    drop = total[ends[:-1]][size > 0]
    keep = np.ones(len(raw), bool)
    keep[drop] = False
    return raw[keep], np.r_[0, np.cumsum(size - (size > 0))]


def encoded(rows: DataFrame, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, model: str = MODEL,
            text: str = "text", key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``rows`` with the token ids of ``text`` as a further column."""
    place, at = rows.columns.index(text), rows.columns.index(key)
    bounded_batches(rows.sparkSession)

    def run(batches):
        table = pieces(model)
        for batch in batches:
            names = batch.column(at).cast(pa.string()).to_pylist()
            kind = np.array([zlib.crc32(x.encode()) % variants if x is not None else 0 for x in names], np.int64)
            null = np.asarray(batch.column(place).is_null())
            for lo, hi, data, offs in text_chunks(batch.column(place), CHUNK):
                got, counts = encode(table, data, offs, kind[lo:hi], dropout, seed)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)),
                                                 pa.array(got.astype(np.int32)), mask=pa.array(null[lo:hi]))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*batch.schema.names, ids])

    return rows.mapInArrow(run, same_fields(rows, T.StructField(ids, T.ArrayType(T.IntegerType()))))


def decoded(rows: DataFrame, ids: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text that the token ids stand for as a further column."""
    place = rows.columns.index(ids)

    def run(batches):
        table = pieces(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                column = part.column(place)
                null = column.is_null()
                column = column.fill_null([]) if column.null_count else column
                raw, offs = decode(table, np.asarray(column.flatten()).astype(np.int64),
                                   np.diff(np.asarray(column.offsets)))
                texts = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(raw.tobytes()))
                texts = pa.compute.if_else(null, pa.scalar(None, pa.large_string()), texts).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, same_fields(rows, T.StructField(name, T.StringType())))


def tokens(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, variants: int = VARIANTS, model: str = MODEL) -> DataFrame:
    """``docs`` with columns n_tokens, token_ids and lossless (decodes to the text).

    A batch is encoded, decoded and compared in one pass, so a task needs one
    Python worker and the decoded text does not travel."""
    place, at = docs.columns.index("text"), docs.columns.index("doc_id")
    bounded_batches(docs.sparkSession)

    def run(batches):
        table = pieces(model)
        for batch in batches:
            names = batch.column(at).cast(pa.string()).to_pylist()
            kind = np.array([zlib.crc32(x.encode()) % variants if x is not None else 0 for x in names], np.int64)
            null = np.asarray(batch.column(place).is_null())
            for lo, hi, data, offs in text_chunks(batch.column(place), CHUNK):
                got, counts = encode(table, data, offs, kind[lo:hi], dropout, seed)
                raw, ends = decode(table, got, counts)
                same = np.diff(ends) == np.diff(offs)
                if same.all():
                    unlike = np.r_[0, np.cumsum(raw != data)]
                    same = unlike[offs[1:]] == unlike[offs[:-1]]
                else:
                    same = np.array([x and raw[a:b].tobytes() == data[c:d].tobytes() for x, a, b, c, d in zip(
                        same, ends[:-1], ends[1:], offs[:-1], offs[1:])])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)),
                                                 pa.array(got.astype(np.int32)), mask=pa.array(null[lo:hi]))
                size = pa.array(counts.astype(np.int32), mask=null[lo:hi])
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, size, lists, pa.array(same | null[lo:hi])],
                                                 names=[*batch.schema.names, *more])

    more = [fresh(c, docs) for c in ("n_tokens", "token_ids", "lossless")]
    return docs.mapInArrow(run, same_fields(docs, T.StructField(more[0], T.IntegerType()), T.StructField(
        more[1], T.ArrayType(T.IntegerType())), T.StructField(more[2], T.BooleanType())))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = decoded(encoded(docs))
    return rows.select(
        "doc_id", F.octet_length("text").alias("n_bytes"), F.size("ids").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"), F.crc32("text").alias("text_crc32"), F.crc32("decoded").alias("decoded_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
