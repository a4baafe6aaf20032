"""Removal of long repeated passages through a compacted De Bruijn graph of word windows.

An edge is a window of `WINDOW` consecutive words, joining its first words to its last. A window
repeats if its word sequence also starts in a document with a smaller doc_id.

1. Copies. A text equal to that of a smaller doc_id is a copy: all its windows repeat. Only the first
   document of each text goes on.
2. Sieve. Every window is stood for by the least hash of its runs of `SEED` words, so equal windows
   share that seed. Seeds met in one document only are dropped by a count, with their windows.
3. Edges. The other windows are keyed by a 64-bit hash. One aggregate gives each edge its source (the
   least doc_id and a position there), how often it occurs, and whether all its occurrences have the
   same word before and the same word after.
4. Compaction. An edge is linked to the edge before it if a join finds that one a position earlier in
   the same source, neither branches, and both occur equally often. Chains of links contract by joins:
   in round k a path that starts at an odd multiple of 2^k is appended to the path that ends there. Paths
   no later round can touch leave the loop, so the rounds shrink geometrically. Every occurrence of
   the first edge is an occurrence of the path. A join of the first edges with the occurrences
   gives spans of documents, each with its coordinates in the source.
5. Verification. The words of each span and of its source are digested where they stand, and a span
   stays only if both digests agree, so a chance collision of edge hashes removes nothing. If a span
   fails, hashes have collided: every occurrence of every window of its path is then digested by itself,
   and equal digests decide. Later occurrences inside the source are verified too, so no collision that
   could hide a repeat stays unseen.
6. The spans go back to their documents and their words are removed.

Only seeds and repeated edges are shuffled, and documents by their own key. The occurrences of a
common passage do not meet in one task: counts are partly aggregated before the shuffle, and the
joins have one row per seed or path on the other side, so they can be split.

Nulls and empty texts have no words; a null doc_id counts as larger than every other. Rows that share
a doc_id are separate texts but never each other's source. Repeated rows are cut alike. Extra columns
are kept by `cut_repeats`. An empty table gives an empty result. Texts are whole however long: a task
holds a slice of about a megabyte, or one longer text with its word offsets and hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import discard, stored, table
from marketlens.llm.words import Words, flat, grams, mix, slices

WINDOW = 13
SEED = 6
TAG_BITS = 31
_LAST = (1 << 63) - 1


def _windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of every window."""
    rows = words.rows()
    n = max(len(rows) - size + 1, 0)
    at = np.flatnonzero(rows[:n] == rows[size - 1:size - 1 + n])
    return at, rows[at]


def _seeds(hashes: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The least seed hash inside each window."""
    least = grams(hashes, seed)
    reach, want = 1, size - seed + 1
    while reach < want:
        step = min(reach, want - reach)
        least = np.minimum(least[:len(least) - step], least[step:])
        reach += step
    return least[at] if len(at) else np.zeros(0, np.uint64)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """A document's comparable id, a key of its text, 64 more bits of it, and the text."""
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("_doc"),
                       F.xxhash64(body, F.lit(3)).alias("_text"),
                       F.xxhash64(F.lit(7), body).alias("_more"), body.alias("_body"))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _emit_seeds(keyed: DataFrame, size: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_body"):
                words = Words.of(part.column("_body"))
                at, rows = _windows(words, size)
                least = _seeds(words.hashes(), at, size, seed)
                new = np.ones(len(at), bool)
                new[1:] = (least[1:] != least[:-1]) | (rows[1:] != rows[:-1])
                owner = pa.array(rows[new])
                yield pa.RecordBatch.from_arrays(
                    [_long(least[new]), part.column("_doc").take(owner),
                     part.column("_text").take(owner)], ["seed", "_doc", "_text"])

    return keyed.mapInArrow(run, "seed long, _doc long, _text long")


def _emit_edges(met: DataFrame, size: int, seed: int, tag_bits: int, key_bits: int) -> DataFrame:
    """Occurrences of windows whose seed repeats: key, coordinates, and its neighbours' tags."""
    tag_shift, key_shift = np.uint64(64 - tag_bits), np.uint64(64 - key_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_body"):
                words = Words.of(part.column("_body"))
                hashes = words.hashes()
                at, rows = _windows(words, size)
                salt = mix(np.arange(part.num_rows, dtype=np.uint64) + np.uint64(1))
                lists = part.column("seeds")
                wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                sizes = np.diff(lists.offsets.to_numpy())
                hit = np.isin(_seeds(hashes, at, size, seed) ^ salt[rows],
                              wanted ^ np.repeat(salt, sizes))
                at, rows = at[hit], rows[hit]
                tags = np.append((hashes >> tag_shift) + np.uint64(1), np.uint64(0))
                first, last = words.bounds[rows], words.bounds[rows + 1]
                before = tags[np.where(at > first, at - 1, len(hashes))]
                after = tags[np.where(at + size < last, at + size, len(hashes))]
                owner = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [_long(grams(hashes, size)[at] >> key_shift), part.column("_doc").take(owner),
                     part.column("_text").take(owner), pa.array((at - first).astype(np.int32)),
                     _long(before << np.uint64(32) | after)],
                    ["key", "_doc", "_text", "pos", "tags"])

    return met.mapInArrow(run, "key long, _doc long, _text long, pos int, tags long")


def _edges(occurrences: DataFrame) -> DataFrame:
    """Edges met in two documents: key, source coordinates, occurrences, and whether they branch."""
    return occurrences.groupBy("key").agg(
        F.min("tags").alias("t0"), F.max("tags").alias("t1"), F.min("_doc").alias("src"),
        F.max("_doc").alias("most"), F.min_by("_text", "_doc").alias("src_text"),
        F.min_by("pos", "_doc").alias("src_pos"), F.count("*").alias("n")).where(
        "src < most").select("key", "src", "src_text", "src_pos", "n",
                             F.expr("t0 = t1").alias("plain"))


def _paths(edges: DataFrame) -> DataFrame:
    """First edge, source coordinates and number of edges of each compacted repeated path."""
    before = edges.where("plain").select("src", "src_text", (F.col("src_pos") + 1).alias("src_pos"),
                                         F.col("n").alias("n_before"))
    linked = F.coalesce(F.expr("plain and n = n_before"), F.lit(False))
    parts = stored(edges.join(before, ["src", "src_text", "src_pos"], "left").select(
        "key", "src", "src_text", "src_pos", linked.alias("linked"), F.lit(1).alias("edges")))
    rounds, finished, step = [parts], [], 1
    while True:
        ends = F.col("src_pos") + F.col("edges")
        waits = F.col("linked") | (ends % step == 0)
        finished.append(parts.where(~waits))
        if parts.where("linked").isEmpty():
            break
        movers = F.col("linked") & (F.col("src_pos") % (2 * step) == step)
        tails = parts.where(waits & movers).select(
            "src", "src_text", F.col("src_pos").alias("_end"), F.col("edges").alias("_more"))
        heads = parts.where(waits & ~movers).withColumn("_end", ends)
        meets = F.col("_end") % (2 * step) == step
        grown = heads.where(meets).join(tails, ["src", "src_text", "_end"], "left").withColumn(
            "edges", F.col("edges") + F.coalesce("_more", F.lit(0)))
        parts = stored(heads.where(~meets).select(parts.columns).unionByName(
            grown.select(parts.columns)))
        rounds.append(parts)
        step *= 2
    paths = stored(reduce(DataFrame.unionByName, [*finished, parts.where(waits)]).drop("linked"))
    for done in rounds:
        discard(done)
    return paths


def _digested(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """(_doc, _text, pos, n_words) spans with the digest of their words where they stand."""
    lists = spans.groupBy("_doc", "_text").agg(
        F.collect_set(F.struct("pos", "n_words")).alias("_spans"))
    met = keyed.join(lists, ["_doc", "_text"]).select(
        "_doc", "_text", "_body", F.col("_spans.pos").alias("at"),
        F.col("_spans.n_words").alias("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, where, sizes, found = [], [], [], []
            data, offsets = flat(batch.column("_body"))
            raw = data.tobytes()
            for row, (at, long) in enumerate(zip(batch.column("at").to_pylist(),
                                                 batch.column("long").to_pylist())):
                words = raw[offsets[row]:offsets[row + 1]].split()
                for a, n in zip(at, long):
                    found.append(xxhash.xxh3_128_digest(b" ".join(words[a:a + n])))
                rows += [row] * len(at)
                where += at
                sizes += long
            owner = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc").take(owner), batch.column("_text").take(owner),
                 pa.array(where, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(found, pa.binary())], ["_doc", "_text", "pos", "n_words", "digest"])

    return met.mapInArrow(run, "_doc long, _text long, pos int, n_words int, digest binary")


def _rejudged(keyed: DataFrame, occurrences: DataFrame, edges: DataFrame, failed: DataFrame,
              size: int) -> DataFrame:
    """Repeated windows among those of failed paths, each digested by itself."""
    doubted = failed.select("src", "src_text", F.explode(F.expr(
        f"sequence(src_pos, src_pos + n_words - {size})")).alias("src_pos")).distinct()
    keys = edges.join(doubted, ["src", "src_text", "src_pos"], "left_semi").select("key")
    at = occurrences.join(keys, "key", "left_semi").select(
        "_doc", "_text", "pos", F.lit(size).alias("n_words"))
    windows = stored(_digested(keyed, at))
    firsts = windows.groupBy("digest").agg(
        F.min("_doc").alias("src"), F.min_by("pos", "_doc").alias("src_pos"))
    return windows.join(firsts, "digest").where("_doc > src").select(
        "_doc", "_text", "pos", "n_words", "src", "src_pos")


def repeated_spans(docs: DataFrame, text: str = "text", size: int = WINDOW, seed: int = SEED,
                   tag_bits: int = TAG_BITS, key_bits: int = 64) -> DataFrame:
    """Verified spans to remove: (_doc, _text, pos, n_words) and their source (src, src_pos).

    `_doc` is the doc_id, or the largest long for null, and `_text` a hash of the text. A copy of a
    whole text, told by 128 bits, has one span with pos 0 and n_words null. Fewer tag or key bits
    (31 and 64 at most) only send more spans to the second judgement.
    """
    keyed = _keyed(docs, text)
    firsts = stored(keyed.groupBy("_text", "_more").agg(F.min("_doc").alias("_doc")))
    copies = keyed.select("_doc", "_text", "_more").join(
        firsts.withColumnRenamed("_doc", "src"), ["_text", "_more"]).where("_doc > src").select(
        "_doc", "_text", F.lit(0).alias("pos"), F.lit(None).cast("int").alias("n_words"), "src",
        F.lit(0).alias("src_pos"))
    seeds = stored(_emit_seeds(keyed.join(firsts, ["_text", "_more", "_doc"], "left_semi"),
                               size, seed))
    shared = seeds.groupBy("seed").agg(F.min("_doc").alias("a"), F.max("_doc").alias("b")) \
        .where("a < b").select("seed")
    wanted = stored(seeds.join(shared, "seed", "left_semi").groupBy("_doc", "_text").agg(
        F.collect_set("seed").alias("seeds")))
    discard(seeds)
    occurrences = stored(_emit_edges(keyed.join(wanted, ["_doc", "_text"]), size, seed, tag_bits,
                                     key_bits))
    edges = stored(_edges(occurrences))
    paths = _paths(edges)
    n_words = (F.col("edges") + size - 1).cast("int").alias("n_words")
    # The source itself needs no verification, another place in its document does.
    spans = stored(occurrences.join(paths, "key").where(
        "_doc > src or _text <> src_text or pos <> src_pos").select(
        "_doc", "_text", "pos", n_words, "src", "src_text", "src_pos").distinct())
    sources = spans.select(F.col("src").alias("_doc"), F.col("src_text").alias("_text"),
                           F.col("src_pos").alias("pos"), "n_words").distinct()
    digests = stored(_digested(
        keyed, spans.select(sources.columns).unionByName(sources)).distinct())
    theirs = digests.select(F.col("_doc").alias("src"), F.col("_text").alias("src_text"),
                            F.col("pos").alias("src_pos"), "n_words",
                            F.col("digest").alias("source_digest"))
    judged = stored(spans.join(digests, ["_doc", "_text", "pos", "n_words"], "left").join(
        theirs, ["src", "src_text", "src_pos", "n_words"], "left").withColumn(
        "same", F.coalesce(F.expr("digest = source_digest"), F.lit(False))).drop(
        "digest", "source_digest"))
    found = judged.where("same and _doc > src").select(
        "_doc", "_text", "pos", "n_words", "src", "src_pos").unionByName(copies)
    failed = judged.where("not same")
    if not failed.isEmpty():
        found = found.unionByName(stored(_rejudged(keyed, occurrences, edges, failed, size)))
    for done in (occurrences, edges, paths, spans, digests):
        discard(done)
    return found


def cut_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                size: int = WINDOW, seed: int = SEED, tag_bits: int = TAG_BITS,
                key_bits: int = 64) -> DataFrame:
    """The kept columns, `n_words`, `n_removed`, and `kept_text`: kept words joined by one space."""
    keep = ["doc_id"] if keep is None else keep
    spans = stored(repeated_spans(docs, text, size, seed, tag_bits, key_bits))
    per_doc = spans.groupBy("_doc", "_text").agg(
        F.collect_set(F.struct("pos", "n_words")).alias("_spans"))
    body: Column = F.col(f"`{text}`").cast("string")
    named = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
                        F.coalesce("doc_id", F.lit(_LAST)).alias("_doc"),
                        F.xxhash64(body, F.lit(3)).alias("_text"), body.alias("_body"))
    met = named.join(per_doc, ["_doc", "_text"], "left").select(
        *[f"_k{i}" for i in range(len(keep))], "_body", F.col("_spans.pos").alias("_at"),
        F.col("_spans.n_words").alias("_long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_body"):
                at, long = part.column(part.num_columns - 2), part.column(part.num_columns - 1)
                words = Words.of(part.column("_body"))
                raw, n_removed, kept = words.data.tobytes(), [], []
                for row in range(part.num_rows):
                    a, b = words.offsets[row], words.offsets[row + 1]
                    own = raw[a:b].split()
                    if at[row].is_valid:
                        cover = np.zeros(len(own) + 1, np.int64)
                        start = at[row].values.to_numpy()
                        wide = long[row].values.fill_null(
                            len(own) if len(own) >= size else 0).to_numpy()
                        np.add.at(cover, start, 1)
                        np.add.at(cover, start + wide, -1)
                        stay = np.cumsum(cover[:-1]) == 0
                        left = [w for w, ok in zip(own, stay.tolist()) if ok]
                    else:
                        left = own
                    n_removed.append(len(own) - len(left))
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(words.counts.astype(np.int64)),
                     pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    [*[f"_k{i}" for i in range(len(keep))], "n_words", "n_removed", "kept_text"])

    fields = met.drop("_body", "_at", "_long").withColumns({
        "n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"),
        "kept_text": F.lit("")})
    made = met.mapInArrow(run, fields.schema)
    return made.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words",
                       "n_removed", "kept_text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut from `text`, `n_chars` to match where there is one.

    A text that loses nothing stays as it is, a cut one has its kept words joined by one space. A
    document that loses everything stays with an empty text.
    """
    names = docs.columns
    plain = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_c{i}")
                                            for i, c in enumerate(names)])
    kept = [f"_c{i}" for i in range(len(names))]
    cut = cut_repeats(plain, keep=["text", *kept])
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[new.get(c, F.col(k)).alias(c) for c, k in zip(names, kept)])


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed",
                      F.sha2("kept_text", 256).alias("kept_sha256"))
