"""Token ids in ORC files: integer runs, row indexes and Bloom filters on document ids.

`write` sorts documents by range of `doc_id`, encodes each slice with a tokenizer of the `tokenizers`
library, appends an end id and writes one ORC file a slice, in ascending order. Rows hold `doc_id`,
`slice`, `at` (ids before it in its slice), `n_tokens` and `ids`; ORC stores the integers as runs
and bit-packed deltas, keeps minima and maxima of every `STRIDE` rows and a Bloom filter on doc_id. A small
table beside them, one row a slice, says how many ids stand before each slice. `read` gives all rows
with their absolute start, stripe by stripe in parallel; `lookup` reads only the row groups whose
statistics and Bloom filters admit the wanted ids.

Texts are cut where the tokenizer always cuts: at white space, which it drops, and between an ASCII
letter and one of `.,;:!?`. Distinct pieces are encoded once a slice, through a cache of at most
`CACHE` pieces; those of ASCII letters alone, lower-cased, go straight to the merges, others are the
words of one call for every `TOGETHER` pieces. Texts that name an added token are encoded whole. Null
texts count as empty: their only id is the end. Null doc_ids come first; rows of one doc_id are ordered by a hash of their text, and equal rows by their place in the input, so
that a doc_id of any weight is spread over slices. Repeated rows are written as often as they come.
Other columns are left out. An empty table gives files without rows. Texts are encoded in slices of
about four megabytes, so the longest single text bounds a task's memory.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from marketlens.llm.store import new_folder, table
from marketlens.llm.words import LOWER, flat, slices

FILE = "word_bpe_49k.json"
END = 2
STRIDE = 1000
STRIPE_BYTES = 64 << 20
CACHE = 700_000
TEXT_BYTES = 4 << 20
TOGETHER = 2000

# Classes of bytes, for cutting texts into pieces.
_OTHER, _SPACE, _LETTER, _STOP = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[[*b".,;:!?"]] = _STOP
_LOWER = np.frombuffer(LOWER, np.uint8)


class _Coder:
    """Ids of texts by one tokenizer, with the ids of known pieces in one pool."""

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.marks = [t.content.encode() for t in
                      self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def whole(self, text: bytes) -> np.ndarray:
        found = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.array(found.ids, np.int32)

    def together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces encoded as the words of one call, and how many each has."""
        found = self.tokenizer.encode([p.decode() for p in pieces], is_pretokenized=True,
                                      add_special_tokens=False)
        return np.array(found.ids, np.int32), np.bincount(
            np.array(found.word_ids, np.int64), minlength=len(pieces))

    def places(self, pieces: list[bytes]) -> np.ndarray:
        """The place of each distinct piece in the pool; new ones are encoded."""
        if len(self.known) > CACHE:
            self.clear()
        found = list(map(self.known.get, pieces))
        new = [p for p, place in zip(pieces, found) if place is None]
        if not new:
            return np.array(found, np.int64)
        plain = [p for p in new if _PLAIN(p)]
        other = [p for p in new if not _PLAIN(p)]
        merge = self.tokenizer.model.tokenize
        ids = [[t.id for t in merge(p.decode())] for p in plain]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        fresh = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        for start in range(0, len(other), TOGETHER):
            some, counts = self.together(other[start:start + TOGETHER])
            fresh, sizes = np.append(fresh, some), np.append(sizes, counts)
        self.known.update(zip(plain + other, range(len(self.size), len(self.size) + len(sizes))))
        self.first = np.append(self.first, len(self.pool) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.pool = np.append(self.pool, fresh)
        return np.array(list(map(self.known.get, pieces)), np.int64)

    def rows(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with its end id, and how many a row has."""
        data, offsets = flat(column)
        starts, lengths, lowered = cut(data, offsets)
        stops = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=stops[1:])
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(stops), pa.py_buffer(lowered)]
        ).dictionary_encode()
        places = self.places(coded.dictionary.to_pylist())
        # One more entry for the end id; every row gets one more piece.
        sizes = np.append(self.size[places], 1)
        first = np.append(self.first[places], len(self.pool))
        bounds = np.searchsorted(starts, offsets)
        order = np.insert(coded.indices.to_numpy(zero_copy_only=False), bounds[1:], len(places))
        lengths = sizes[order]
        ids = gather(np.append(self.pool, np.int32(end)), first[order], lengths)
        totals = np.concatenate(([0], np.cumsum(lengths)))
        ends = bounds + np.arange(len(bounds))
        counts = totals[ends[1:]] - totals[ends[:-1]]
        raw = data.tobytes()
        if any(mark in raw for mark in self.marks):
            ids, counts = self._mended(raw, offsets, ids, counts, end)
        return ids, counts

    def _mended(self, raw: bytes, offsets: np.ndarray, ids: np.ndarray, counts: np.ndarray,
                end: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.split(ids, np.cumsum(counts)[:-1])
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            if any(mark in raw[a:b] for mark in self.marks):
                rows[i] = np.append(self.whole(raw[a:b]), np.int32(end))
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)


_PLAIN = re.compile(rb"[a-z]+").fullmatch


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and length of every piece, and the bytes of all; ASCII pieces are lower-cased.

    Others keep their case, as composing their characters comes before lowering them.
    """
    kind = _CLASS[data]
    fresh = np.ones(len(data) + 1, bool)  # a piece cannot go on over this byte's start
    fresh[1:-1] = (kind[1:] + kind[:-1] == _LETTER + _STOP) & (kind[1:] >= _LETTER) & (
        kind[:-1] >= _LETTER)
    fresh[offsets] = True
    inside = kind != _SPACE
    starts = np.flatnonzero(inside & (fresh[:-1] | np.concatenate(([True], ~inside[:-1]))))
    ends = np.flatnonzero(inside & (fresh[1:] | np.concatenate((~inside[1:], [True])))) + 1
    lengths = ends - starts
    kept = data[inside]
    if not len(starts):
        return starts, lengths, kept
    highest = np.maximum.reduceat(kept, np.cumsum(lengths) - lengths)
    return starts, lengths, np.where(np.repeat(highest < 0x80, lengths), _LOWER[kept], kept)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of values, one after another."""
    stops = np.cumsum(lengths)
    total = int(stops[-1]) if len(stops) else 0
    return values[np.arange(total) + np.repeat(starts - (stops - lengths), lengths)]


@lru_cache(maxsize=2)
def _coder(file: str) -> _Coder:
    return _Coder(file)


def encode_slices(docs: DataFrame, text: str = "text", file: str = FILE,
                  end: int = END) -> DataFrame:
    """`doc_id`, `slice` (the partition), `at`, `n_tokens` and `ids`, in the given order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = _coder(public_tokenizers.path(file)), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, text, TEXT_BYTES):
                ids, counts = coder.rows(piece.column(text), end)
                stops = np.cumsum(counts)
                offsets = np.concatenate(([0], stops)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()),
                     pa.array(np.full(piece.num_rows, part, np.int32)),
                     pa.array(at + stops - counts), pa.array(counts),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    ["doc_id", "slice", "at", "n_tokens", "ids"])
                at += int(stops[-1])

    return docs.select("doc_id", text).mapInArrow(
        run, "doc_id long, slice int, at long, n_tokens long, ids array<int>")


def write(docs: DataFrame, path: str, text: str = "text", file: str = FILE, end: int = END,
          files: int | None = None, stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE) -> None:
    """Write the ids of all texts under `path`, `files` ORC files in ascending doc_id order."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select("doc_id", text, F.xxhash64(text).alias("_text_key"),
                         F.monotonically_increasing_id().alias("_row"))
    order = [F.asc_nulls_first("doc_id"), "_text_key", "_row"]
    sorted_docs = placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    (encode_slices(sorted_docs, text, file, end).write.format("orc")
     .option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", stride).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", 0.01).save(f"{path}/ids"))
    sizes = _rows(spark, path).groupBy("slice").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    base.coalesce(1).write.orc(f"{path}/slices")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, slice int, at long, n_tokens long, ids array<int>").orc(
        f"{path}/ids")


def read(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id`, `start` (ids of all documents before), `n_tokens` and `ids` from the files."""
    base = spark.read.schema("slice int, base long").orc(f"{path}/slices")  # one row a file
    return _rows(spark, path).join(F.broadcast(base), "slice").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of some documents; row groups whose metadata rules them out are not read."""
    return read(spark, path).where(F.col("doc_id").isin(list(doc_ids)))


def checksums(found: DataFrame) -> DataFrame:
    """The rows with `ids_crc32` (of the ids as little-endian unsigned 32-bit) in place of ids."""
    names = [c for c in found.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("ids")
            values = rows.values.to_numpy(zero_copy_only=False).astype("<u4")
            offsets = rows.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sums, pa.int64())],
                [*names, "ids_crc32"])

    return found.mapInArrow(run, found.select(*names, F.lit(0).cast("long").alias("ids_crc32"))
                            .schema)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = new_folder(spark)
    write(docs, path)
    return checksums(read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
