"""Near copies by SimHash: exact fingerprints, tiles of them compared bit by bit, components.

A document's shingles vote on 64 bits. Fingerprints within `radius` bits link, transitively.
Equal fingerprints are one node. Nodes are dealt into tiles by the population counts of four
16-bit blocks: two fingerprints within the radius have counts that differ by no more than the
radius in sum, so only such tile pairs are joined, and numpy compares them by exclusive-or and bit
counts. Full tiles are cut by hash, which keeps every task bounded. A tile pair returns a spanning
forest of its links, so a group of near copies costs no square of rows.

Nulls and empty texts have fingerprint 0 and link like any other. Repeated rows and rows sharing a
doc_id each get a row. A null doc_id keeps its row and never names a component while a member has
an id. An empty table gives an empty result. Clashing extra columns stay untouched in `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.components import components
from marketlens.llm.store import free_name, stored, table
from marketlens.llm.words import LOWER, flat

RADIUS = 2
SHINGLE = 3
TILE = 4096
BLOCKS = 4


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles; a tie is 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends))[:len(words) - size + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42)
                  for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]
    bits = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for at in range(0, len(values), 1 << 14):
        part = values[at:at + (1 << 14)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(values), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                      size: int = SHINGLE) -> DataFrame:
    """The kept columns and `fp`, the fingerprint as a long."""
    keep = ["doc_id"] if keep is None else keep
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep],
                         F.col(f"`{text}`").cast("string").alias("_shingled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(batch.num_columns - 1))
            raw = data.tobytes()
            found = [fingerprint(raw[a:b], size) for a, b in zip(offsets[:-1], offsets[1:])]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], fp], [*batch.schema.names[:-1], "fp"])

    schema = chosen.drop("_shingled").withColumn("fp", F.lit(0).cast("long")).schema
    return chosen.mapInArrow(run, schema)


def _forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Reduce the links between two tiles to a spanning forest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def compare(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links within the radius between two tiles of fingerprints, as a spanning forest."""
    kept: list[tuple[int, int]] = []
    step = max(1, (1 << 18) // max(len(b), 1))
    for at in range(0, len(a), step):
        part = a[at:at + step]
        near = np.bitwise_count(part[:, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if same:
            i, j = i[i + at < j], j[i + at < j]
        if len(i):
            kept.extend(_forest(part[i], b[j]))
    return kept


def _deltas(radius: int, blocks: int) -> list[int]:
    """Steps between packed block counts whose absolute sum stays in the radius, one direction."""
    steps = []
    for step in product(range(-radius, radius + 1), repeat=blocks):
        if sum(map(abs, step)) <= radius:
            packed = sum(d * 256 ** i for i, d in enumerate(step))
            if packed >= 0:
                steps.append(packed)
    return sorted(steps)


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
          tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints `fp` exactly as the radius does."""
    width = 64 // blocks
    mask = (1 << width) - 1
    sig = sum(F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask)))
              .cast("long") * F.lit(256 ** i) for i in range(blocks))
    dealt = nodes.select("fp", sig.alias("sig"))
    sizes = dealt.groupBy("sig").agg(F.ceil(F.count("*") / tile).alias("cuts"))
    tiles = (dealt.join(sizes, "sig")
             .withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")))
             .groupBy("sig", "cut").agg(F.collect_list("fp").alias("fps")))
    tiles = stored(tiles)
    left = tiles.select(
        F.explode(F.array(*[F.lit(d) for d in _deltas(radius, blocks)])).alias("step"), "*")
    left = left.select((F.col("sig") + F.col("step")).alias("to"), (F.col("step") == 0)
                       .alias("own"), "cut", F.col("fps").alias("a"))
    right = tiles.select(F.col("sig").alias("to"), F.col("cut").alias("other"),
                         F.col("fps").alias("b"))
    pairs = left.join(right, "to").where("not own or cut <= other").select(
        "a", "b", (F.col("own") & (F.col("cut") == F.col("other"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, same in zip(batch.column(0), batch.column(1), batch.column(2)):
                found += compare(a.values.to_numpy(zero_copy_only=False),
                                 b.values.to_numpy(zero_copy_only=False), radius, same.as_py())
            if found:
                u, v = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def near_copies(docs: DataFrame, text: str = "text", radius: int = RADIUS,
                keep: list[str] | None = None, size: int = SHINGLE) -> DataFrame:
    """The kept columns (doc_id among them), `fp`, and `component_id`, the least doc_id linked."""
    prints = stored(with_fingerprints(docs, text, keep, size))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(nodes, radius))
    grouped = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def keep_first(keyed: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """The first row by doc_id, then `key`, of each `_group`; rows without an id come last."""
    best = groups.groupBy("_group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", key)).alias("best"))
    chosen = best.select(F.col("best.doc_id").alias("_id"), F.col(f"best.{key}").alias("_key"))
    kept = keyed.join(chosen, F.expr(f"doc_id <=> _id and `{key}` = _key"), "left_semi")
    return kept.dropDuplicates(["doc_id", key])


def deduplicate(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest doc_id.

    Of repeated rows with that doc_id one stays: the first by text. A group whose doc_ids are all
    null keeps one row too.
    """
    key = free_name(docs, "_text_key")
    keyed = docs.withColumn(key, F.xxhash64("text", F.lit(7)))
    groups = near_copies(keyed, radius=radius, keep=["doc_id", key], size=size).withColumn(
        "_group", F.struct("component_id", F.coalesce("component_id", "fp")))
    return keep_first(keyed, groups, key).select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = near_copies(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
