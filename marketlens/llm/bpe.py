"""Byte-level BPE: boundaries by scans over code-point classes, then cached pair merging.

The split pattern is
`'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`. Each code point
gets a symbol: its class, and for white space and apostrophes what follows it. A symbol is a
function from state to state, and functions compose associatively: blocks of symbols are composed
side by side, the block totals are scanned by doubling, and a second pass over the blocks marks
where pieces begin. No regular expression runs on the text. Pieces are merged by rank once per
worker and kept in a cache of at most `CACHE` entries; a miss only costs the merge again.

`encode` adds the ids and each token's byte offset in the text, `decode` turns ids back into bytes.
Nulls count as empty and give no ids. Repeated rows are encoded alike, other columns are kept as they
are, an empty table gives an empty result. The longest text bounds a task's memory.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import table
from marketlens.llm.words import flat, hash_spans, slices

RANKS = "byte_bpe_multi_50k.tiktoken"
CACHE = 100_000
TOKENS_AT_ONCE = 1 << 18
BLOCK = 64

# Symbols of a code point.
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)  # classes; _SPACE is any white space
_SHORT, _LONG = 3, 4  # apostrophe before s t m d, before re ve ll
_BLANK_LAST, _WHITE_LAST, _WHITE_MORE = 5, 6, 7  # white space before text or before more of it
_SYMBOLS = 8
# States after a code point.
_START, _IN_L, _IN_N, _IN_O, _IN_W, _JOIN, _ALONE, _ONE, _TWO = range(9)
_STATES = 9


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by symbol and state; rows 8-15 open a text."""
    step = np.zeros((2 * _SYMBOLS, _STATES), np.uint8)
    begins = np.ones((2 * _SYMBOLS, _STATES), bool)
    fresh = {_LETTER: _IN_L, _NUMBER: _IN_N, _OTHER: _IN_O, _SHORT: _ONE, _LONG: _TWO,
             _BLANK_LAST: _JOIN, _WHITE_LAST: _ALONE, _WHITE_MORE: _IN_W}
    for symbol, state in fresh.items():
        step[symbol, :] = step[symbol + _SYMBOLS, :] = state
    goes_on = [(_LETTER, _IN_L, _IN_L), (_LETTER, _JOIN, _IN_L), (_NUMBER, _IN_N, _IN_N),
               (_NUMBER, _JOIN, _IN_N), (_LETTER, _TWO, _ONE), (_LETTER, _ONE, _START),
               (_WHITE_MORE, _IN_W, _IN_W)]
    for symbol in (_OTHER, _SHORT, _LONG):
        goes_on += [(symbol, _IN_O, _IN_O), (symbol, _JOIN, _IN_O)]
    for symbol, state, after in goes_on:
        step[symbol, state], begins[symbol, state] = after, False
    return step, begins


_STEP, _BEGINS = _tables()


# Letters and numbers of Unicode 16 that the interpreter's tables may not know yet.
_NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D),
    (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
_NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
    (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, by Unicode category and the white-space property."""
    out = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            out[point] = _LETTER
        elif kind == "N":
            out[point] = _NUMBER
    for kind, ranges in ((_LETTER, _NEW_LETTERS), (_NUMBER, _NEW_NUMBERS)):
        for first, last in ranges:
            out[first:last + 1] = kind
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def _symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each code point; `first` marks where a text begins."""
    kind = classes()[points]
    n = len(points)
    ends = np.ones(n, bool)
    ends[:-1] = first[1:]
    after = np.full(n, _SPACE, np.uint8)
    after[:-1] = kind[1:]
    after[ends] = _SPACE
    white = kind == _SPACE
    out = kind.copy()
    out[white] = np.where(after[white] == _SPACE, _WHITE_MORE,
                          np.where(points[white] == 0x20, _BLANK_LAST, _WHITE_LAST))
    at = np.flatnonzero(points == 0x27)
    at = at[~ends[at]]
    one = points[at + 1]
    two = np.where((at + 2 < n) & ~ends[at + 1], points[np.minimum(at + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (
        (one == ord("l")) & (two == ord("l")))
    out[at[short]], out[at[long]] = _SHORT, _LONG
    out[first] += _SYMBOLS
    return out


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """All functions the symbols compose to: the state each starts a text in, and their products.

    There are a few dozen, so composing two of them is one look-up.
    """
    functions = [tuple(row) for row in _STEP.tolist()]
    known = {f: i for i, f in reversed(list(enumerate(functions)))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in [tuple(row) for row in _STEP.tolist()]:
            both = tuple(g[x] for x in f)
            if both not in known:
                known[both] = len(functions)
                functions.append(both)
                todo.append(both)
    size = len(functions)
    product = np.zeros((size, size), np.int16)
    for i, f in enumerate(functions):
        product[i] = [known[tuple(g[x] for x in f)] for g in functions]
    return np.array([f[_START] for f in functions], np.uint8), product.ravel()


def _states_before(symbols: np.ndarray) -> np.ndarray:
    """The state before each symbol, by composing the symbols' functions."""
    n = len(symbols)
    blocks = -(-n // BLOCK)
    outcome, product = _monoid()
    size = len(outcome)
    padded = np.full(blocks * BLOCK, _OTHER, np.int16)
    padded[:n] = symbols
    grid = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    total = grid[0]
    for row in grid[1:]:  # compose inside all blocks at once: first total, then row
        total = product[total.astype(np.int32) * size + row]
    reach = 1
    while reach < blocks:  # inclusive scan of the block functions by doubling
        later = total.copy()
        later[reach:] = product[total[:-reach].astype(np.int32) * size + total[reach:]]
        total, reach = later, 2 * reach
    state = np.zeros(blocks, np.uint8)
    state[1:] = outcome[total[:-1]]
    before = np.empty((BLOCK, blocks), np.uint8)
    steps = _STEP.ravel()
    for at, row in enumerate(grid):
        before[at] = state
        state = steps[row * _STATES + state]
    return before.T.ravel()[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the first code point of each piece."""
    if not len(points):
        return np.zeros(0, np.int64)
    symbols = _symbols(points, first)
    return np.flatnonzero(_BEGINS[symbols, _states_before(symbols)])


def read_ranks(name: str) -> dict[bytes, int]:
    """The rank file `name`, a path or the name of a public tokenizer's file."""
    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of least rank, leftmost first, until none is in the ranks."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j] = False
        end[i], after[i] = end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
            pair = piece[i:end[after[i]]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, end[after[i]]))
        if before[i] >= 0:
            pair = piece[before[i]:end[i]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], before[i], end[i]))
    found, i = [], 0
    while i < n:
        found.append(ranks[piece[i:end[i]]])
        i = after[i]
    return found


@lru_cache(maxsize=2)
def token_bytes(name: str) -> list[bytes]:
    """The bytes of each id."""
    ranks = read_ranks(name)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Pairs:
    """Ranks of adjacent token pairs, looked up many at once."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NEVER)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)


_NEVER = np.int64(1 << 40)
_TOGETHER = 48  # bytes of the longest piece that is merged side by side with others


def merge_many(pieces: list[bytes], bytes_to_id: np.ndarray, pairs: Pairs) -> list[list[int]]:
    """`merge` of many short pieces: each round merges the best pair of every unfinished piece."""
    out: list[list[int]] = [[] for _ in pieces]
    token = bytes_to_id[np.frombuffer(b"".join(pieces), np.uint8)]
    size = np.array([len(p) for p in pieces], np.int64)
    piece = np.arange(len(pieces))
    owner = np.repeat(np.arange(len(pieces)), size)
    rank = np.full(len(token), _NEVER)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner] = pairs.of(token[inner], token[inner + 1])
    while len(piece):
        starts = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, starts)
        done = best == _NEVER
        if done.any():
            flat_ids = token.tolist()
            for i in np.flatnonzero(done).tolist():
                out[piece[i]] = flat_ids[starts[i]:starts[i] + size[i]]
            stay = np.repeat(~done, size)
            token, rank = token[stay], rank[stay]
            piece, size, best = piece[~done], size[~done], best[~done]
            if not len(piece):
                break
        owner = np.repeat(np.arange(len(piece)), size)
        hits = np.flatnonzero(rank == best[owner])
        mine = owner[hits]
        first = hits[np.concatenate(([True], mine[1:] != mine[:-1]))]
        token[first] = best
        stay = np.ones(len(token), bool)
        stay[first + 1] = False
        at = first - np.arange(len(first))  # one token went in every piece before
        token, rank = token[stay], rank[stay]
        size = size - 1
        ends = np.cumsum(size)
        last = at + 1 == ends
        rank[at[last]] = _NEVER
        again = at[~last]
        rank[again] = pairs.of(token[again], token[again + 1])
        again = at[at > ends - size] - 1
        rank[again] = pairs.of(token[again], token[again + 1])
    return out


@lru_cache(maxsize=2)
def token_pool(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, where each one starts and its length."""
    tokens = token_bytes(name)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


class Codec:
    """Ranks, the length of each id's bytes and the cache of merged pieces, once per worker."""

    def __init__(self, name: str):
        self.ranks = read_ranks(name)
        self.pairs = Pairs(self.ranks)
        self.bytes_to_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in token_bytes(name)], np.int64)
        self.cache: dict[bytes, list[int]] = {}

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each of the distinct pieces."""
        get = self.cache.get
        found = [get(p) for p in pieces]
        missed = [i for i, ids in enumerate(found) if ids is None]
        if missed:
            short = [i for i in missed if len(pieces[i]) <= _TOGETHER]
            made = merge_many([pieces[i] for i in short], self.bytes_to_id, self.pairs)
            for i, ids in zip(short, made):
                found[i] = ids
            for i in missed:
                if found[i] is None:
                    found[i] = merge(pieces[i], self.ranks)
            if len(self.cache) + len(missed) > CACHE:
                self.cache.clear()
            self.cache.update((pieces[i], found[i]) for i in missed)
        return found

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of all texts, the byte each token starts at in its text, and the rows' bounds."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        first = np.zeros(len(points), bool)
        first[np.searchsorted(lead, bounds[:-1][bounds[:-1] < bounds[1:]])] = True
        starts = lead[np.append(boundaries(points, first), len(points))]
        starts, ends = starts[:-1], starts[1:]
        _, some, which = np.unique(hash_spans(data, starts, ends), return_index=True,
                                   return_inverse=True)
        found = self.merged([raw[a:b] for a, b in zip(starts[some].tolist(),
                                                      ends[some].tolist())])
        counts = np.array([len(ids) for ids in found], np.int64)
        pool = np.array(list(chain.from_iterable(found)), np.int32)
        sizes = counts[which]
        until = np.cumsum(sizes)
        shift = (np.cumsum(counts) - counts)[which] - (until - sizes)
        ids = pool[np.arange(until[-1] if len(until) else 0) + np.repeat(shift, sizes)]
        rows = np.concatenate(([0], until))[np.searchsorted(starts, bounds)]
        lengths = self.lengths[ids]
        at = np.cumsum(lengths) - lengths - np.repeat(bounds[:-1], np.diff(rows))
        return ids, at.astype(np.int32), rows.astype(np.int32)


@lru_cache(maxsize=2)
def codec(name: str) -> Codec:
    return Codec(name)


def encode(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
           ranks: str = RANKS, ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """The kept columns, the token ids and the byte at which each token starts."""
    keep = ["doc_id"] if keep is None else keep
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep],
                         F.col(f"`{text}`").cast("string").alias("_encoded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = codec(ranks)
        for batch in batches:
            for part in slices(batch, "_encoded"):
                made, at, rows = book.encode(*flat(part.column(part.num_columns - 1)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(rows, pa.array(made)),
                     pa.ListArray.from_arrays(rows, pa.array(at))], [*keep, ids, offsets])

    fields = chosen.drop("_encoded").withColumns(
        {ids: F.lit(None).cast("array<int>"), offsets: F.lit(None).cast("array<int>")})
    return chosen.mapInArrow(run, fields.schema)


def _spans(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and each row's bounds in them; a null row is empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes))


def decode(encoded: DataFrame, ids: str = "ids", ranks: str = RANKS,
           out: str = "decoded", offsets: str | None = "offsets") -> DataFrame:
    """Add the bytes that the ids stand for, each token written at its offset in the row.

    Null ids give no bytes. Offsets that do not fit the ids' lengths are an error. Without a column of
    offsets (None) the tokens follow each other.
    """
    names = encoded.columns
    at, placed = names.index(ids), None if offsets is None else names.index(offsets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, begins, lengths = token_pool(ranks)
        for batch in batches:
            tokens, bounds = _spans(batch.column(at))
            ends = np.append(0, np.cumsum(lengths[tokens]))
            rows = ends[bounds]
            if placed is not None:
                starts = _spans(batch.column(placed))[0] + np.repeat(rows[:-1], np.diff(bounds))
                if not np.array_equal(starts, ends[:-1]):
                    raise ValueError("token offsets do not fit the token ids")
            data = np.empty(ends[-1], np.uint8)
            for a in range(0, len(tokens), TOKENS_AT_ONCE):
                some = tokens[a:a + TOKENS_AT_ONCE]
                first, size = int(ends[a]), int(ends[a + len(some)] - ends[a])
                shift = begins[some] - (ends[a:a + len(some)] - first)
                data[first:first + size] = pool[np.arange(size) + np.repeat(shift, lengths[some])]
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(batch), [None, pa.py_buffer(rows), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts.cast(pa.binary())], [*names, out])

    return encoded.mapInArrow(run, encoded.withColumn(out, F.lit(b"").cast("binary")).schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = decode(encode(docs))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
