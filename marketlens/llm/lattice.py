"""Document probability by a subword lattice: every segmentation of every word counts.

Tokens are lower-cased words and one end per text. A word, with the vocabulary's word mark before
it, may be cut into any pieces of an existing tokenizer's vocabulary; characters without a piece are
spelt in byte pieces. The forward recursion adds the probability of all cuts in log space, and a
text has the product of its words' probabilities and that of the end.

Piece probabilities start from the vocabulary's own scores, by Zipf's law of their order, and one
expectation step over all training words reweights them. A word's expected pieces, its count times
each piece's share, are rounded to whole units before any sum, so the weights do not depend on how
rows are ordered, batched or partitioned. The step gives one number per piece, so its size is the
vocabulary's.

Word counts and word probabilities are one table, as large as the corpus' vocabulary, never sent
whole: documents are dealt into blocks of about `BLOCK_BYTES`, each block asks for its distinct words by
a join, and gets back counts and probabilities for them only. A very common word costs one row per
block.

Null and empty texts have the end only. A null doc_id is a training document, numbered like ''.
Repeated rows are counted and scored each. Without training documents every base term is
log10(1) and the pieces keep their first weights. Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import stored, table
from marketlens.llm.words import LOWER, Words, hash_spans, flat, slices

VOCABULARY = "piece_bpe_32k.model"
BLOCK_BYTES = 24 << 20
MARK = "▁"
UNIT = 1 << 16  # expected counts are summed in whole parts of this size
PRIOR = 0.5
_LONG = 64  # longer words are summed in log space, which depends on the word alone
_LOWER = np.frombuffer(LOWER, np.uint8)


class Lattice:
    """Matches of a vocabulary in many words at once, and sums over their segmentations."""

    def __init__(self, name: str):
        path = name if "/" in name else public_tokenizers.path(name)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size, self.end = size + 1, size
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.empty(size, np.int64)
        order[np.argsort(-scores, kind="stable")] = np.arange(size)
        self.bytes_at = np.zeros(256, np.int64)
        child: dict[int, int] = {}
        self.piece_at = [-1]
        weights = np.zeros(size + 1)
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_at[int(text[3:5], 16)] = i
                weights[i] = 1.0 / (size + 3.0)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                weights[i] = 1.0 / (order[i] + 3.0)
                node = 0
                for char in text:
                    key = node << 21 | ord(char)
                    if key not in child:
                        child[key] = len(self.piece_at)
                        self.piece_at.append(-1)
                    node = child[key]
                self.piece_at[node] = i
        weights[self.end] = 1.0 / 10.0
        self.first = weights / weights.sum()
        self.piece_at = np.array(self.piece_at, np.int64)
        self.keys = np.array(sorted(child), np.int64)
        self.nodes = np.array([child[k] for k in self.keys.tolist()], np.int64)

    def matches(self, points: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, length and piece of every vocabulary match; `room` is the space up to word end."""
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        found, depth = [], 0
        while len(at):
            key = node << 21 | points[at + depth]
            spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[spot] == key
            at, node = at[ok], self.nodes[spot[ok]]
            depth += 1
            piece = self.piece_at[node]
            ends = piece >= 0
            found.append((at[ends], np.full(int(ends.sum()), depth), piece[ends]))
            more = room[at] > depth
            at, node = at[more], node[more]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _laid_out(self, words: list[str]) -> tuple[np.ndarray, ...]:
        text = "".join(MARK + w for w in words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        room = np.repeat(starts + sizes, sizes) - np.arange(len(points))
        start, length, piece = self.matches(points, room)
        single = np.zeros(len(points), bool)
        single[start[length == 1]] = True
        return points, sizes, starts, start, length, piece, np.flatnonzero(~single)

    def _edges(self, words: list[str], logs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Log weight of every cut: a matrix of start by length, besides what it was made of."""
        points, sizes, starts, start, length, piece, spelt = self._laid_out(words)
        wide = int(length.max()) if len(length) else 1
        edges = np.full((wide + 1, len(points)), -np.inf)
        edges[length, start] = logs[piece]
        for i in spelt.tolist():
            edges[1, i] = logs[self.bytes_at[list(chr(points[i]).encode())]].sum()
        return edges, sizes, starts, start, length, piece, spelt, points

    def score(self, words: list[str], logs: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability over all segmentations, by forward recursion."""
        order = np.argsort([-len(w) for w in words], kind="stable")
        out = np.zeros(len(words))
        for group in self._groups(words, order):
            edges, sizes, starts = self._edges([words[i] for i in group], logs)[:3]
            ahead = np.full((int(sizes[0]) + 1, len(group)), -np.inf)
            ahead[0] = 0.0
            for j in range(1, int(sizes[0]) + 1):
                n = int(np.searchsorted(-sizes, -j, "right"))
                total = np.full(n, -np.inf)
                for step in range(1, min(j, len(edges) - 1) + 1):
                    total = np.logaddexp(
                        total, ahead[j - step, :n] + edges[step, starts[:n] + j - step])
                ahead[j, :n] = total
            out[group] = ahead[sizes, np.arange(len(group))]
        return out

    @staticmethod
    def _groups(words: list[str], order: np.ndarray) -> Iterator[np.ndarray]:
        """Words by falling length, in groups of bounded size; long and short words never meet."""
        at, long = 0, sum(len(w) >= _LONG for w in words)
        while at < len(order):
            step = max(1, min(8192, (1 << 17) // (len(words[order[at]]) + 1)))
            step = min(step, long - at) if at < long else step
            yield order[at:at + step]
            at += step

    def expect(self, words: list[str], counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Expected units of each piece over all segmentations, by forward and backward sums."""
        order = np.argsort([-len(w) for w in words], kind="stable")
        out = np.zeros(self.size, np.int64)
        for group in self._groups(words, order):
            edges, sizes, starts, start, length, piece, spelt, points = self._edges(
                [words[i] for i in group], logs)
            top, many = int(sizes[0]), np.arange(len(group))
            ahead = np.full((top + 1, len(group)), -np.inf)
            back = np.full((top + 1, len(group)), -np.inf)
            ahead[0], back[sizes, many] = 0.0, 0.0
            if top <= _LONG:  # plain sums, each character lifted so that nothing underflows
                lift = 6.0
                factor = np.exp(edges + lift * np.arange(len(edges))[:, None])
                ahead, back = np.exp(ahead), np.exp(back)
                for j in range(1, top + 1):
                    n = int(np.searchsorted(-sizes, -j, "right"))
                    for step in range(1, min(j, len(edges) - 1) + 1):
                        ahead[j, :n] += ahead[j - step, :n] * factor[step, starts[:n] + j - step]
                for j in range(top - 1, -1, -1):
                    for step in range(1, min(top - j, len(edges) - 1) + 1):
                        n = int(np.searchsorted(-sizes, -(j + step), "right"))
                        back[j, :n] += back[j + step, :n] * factor[step, starts[:n] + j]
                with np.errstate(divide="ignore"):
                    ahead, back = np.log(ahead), np.log(back)
            else:
                lift = 0.0
                for j in range(1, top + 1):
                    n = int(np.searchsorted(-sizes, -j, "right"))
                    for step in range(1, min(j, len(edges) - 1) + 1):
                        ahead[j, :n] = np.logaddexp(ahead[j, :n], ahead[j - step, :n]
                                                    + edges[step, starts[:n] + j - step])
                for j in range(top - 1, -1, -1):
                    for step in range(1, min(top - j, len(edges) - 1) + 1):
                        n = int(np.searchsorted(-sizes, -(j + step), "right"))
                        back[j, :n] = np.logaddexp(back[j, :n], back[j + step, :n]
                                                   + edges[step, starts[:n] + j])
            whole, weight = ahead[sizes, many], counts[group]
            owner = np.repeat(many, sizes)
            begin = np.arange(len(points)) - starts[owner]

            def posterior(at: np.ndarray, step: np.ndarray) -> np.ndarray:
                own = owner[at]
                share = np.exp(ahead[begin[at], own] + edges[step, at] + lift * step
                               + back[begin[at] + step, own] - whole[own])
                return np.rint(weight[own] * share * UNIT).astype(np.int64)

            np.add.at(out, piece, posterior(start, length))
            share = posterior(spelt, np.ones(len(spelt), np.int64))
            for i, part in zip(spelt.tolist(), share.tolist()):
                np.add.at(out, self.bytes_at[list(chr(points[i]).encode())], part)
        return out


@lru_cache(maxsize=2)
def lattice(name: str) -> Lattice:
    return Lattice(name)


def _lowered(column: pa.Array) -> Words:
    data, offsets = flat(column)
    return Words(_LOWER[data], offsets)


def held_out(docs: DataFrame):
    """Whether a document is kept from training: crc32 of its id modulo 7 is 2."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): every distinct word and how often the training documents have it."""
    chosen = docs.select((~held_out(docs)).alias("_train"),
                         F.col(f"`{text}`").cast("string").alias("_counted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_counted"):
                words = _lowered(part.column("_counted"))
                train = part.column("_train").to_numpy(zero_copy_only=False)[words.rows()]
                _, some, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
                raw = words.data.tobytes()
                found = [raw[a:b] for a, b in zip(words.starts[some].tolist(),
                                                  words.ends[some].tolist())]
                counts = np.bincount(which, train, len(some)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()).cast(pa.string()), pa.array(counts)],
                    ["word", "c"])

    return chosen.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def reweighted(counts: DataFrame, ends: int, name: str = VOCABULARY) -> np.ndarray:
    """Log probability of each piece and the end after an expectation step over all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = lattice(name)
        with np.errstate(divide="ignore"):
            logs = np.log(book.first)
        for batch in batches:
            found = book.expect(batch.column(0).to_pylist(),
                                batch.column(1).to_numpy().astype(np.float64), logs)
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(found[at])],
                ["piece", "units"])

    sums = counts.where("c > 0").mapInArrow(run, "piece long, units long").groupBy("piece").agg(
        F.sum("units").alias("units")).toArrow()
    book = lattice(name)
    weight = np.where(book.first > 0, PRIOR, 0.0)
    if sums.num_rows:
        weight[sums["piece"].to_numpy()] += sums["units"].to_numpy() / UNIT
    weight[book.end] += ends
    if not ends:
        weight = book.first
    with np.errstate(divide="ignore"):
        return np.log(weight / weight.sum())


def word_table(counts: DataFrame, logs: np.ndarray, name: str = VOCABULARY) -> DataFrame:
    """(h, c, lp): a word's hash, its training count and log10 of its lattice probability."""
    sent = counts.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = lattice(name)
        for batch in batches:
            data, offsets = flat(batch.column(0))
            score = book.score(batch.column(0).to_pylist(), sent.value) / np.log(10)
            h = hash_spans(data, offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), batch.column(1), pa.array(score)], ["h", "c", "lp"])

    return counts.select("word", "c").mapInArrow(run, "h long, c long, lp double")


def lattice_scores(docs: DataFrame, text: str = "text", name: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    body = F.col(f"`{text}`").cast("string")
    counts = stored(count_words(docs, text))
    n, v = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends, size = docs.agg(F.count_if(~held_out(docs)),
                          F.coalesce(F.sum(F.octet_length(body)), F.lit(0))).first()
    n, v = n + ends, v + (ends > 0)
    logs = reweighted(counts, ends, name)
    known = stored(word_table(counts, logs, name))
    end_score = float(logs[lattice(name).end] / np.log(10))

    blocks = max(32, -(-size // BLOCK_BYTES))
    dealt = docs.select("doc_id", held_out(docs).alias("held_out"), F.pmod(
        F.xxhash64("doc_id", body), F.lit(blocks)).alias("block"), body.alias("body"))

    def ask(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in group:
            block = batch.column("block")[0]
            for part in slices(batch, "body"):
                seen.append(np.unique(_lowered(part.column("body")).hashes()))
        h = np.unique(np.concatenate(seen))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(h), block.as_py())), pa.array(h.view(np.int64))],
            ["block", "h"])

    def answer(texts: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words["h"].to_numpy())
        keys = words["h"].to_numpy()[order]
        c, lp = words["c"].to_numpy()[order], words["lp"].to_numpy()[order]
        base = np.log10((c + 1) / (n + (v + 1)))
        end_base = np.log10((ends + 1) / (n + (v + 1)))
        parts = []
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "body"):
                found = _lowered(part.column("body"))
                at = np.searchsorted(keys, found.hashes().view(np.int64))
                rows, total = found.rows(), part.num_rows
                parts.append(pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"),
                    pa.array(found.counts.astype(np.int64) + 1),
                    pa.array(np.bincount(rows, c[at] > 0, total).astype(np.int64) + (ends > 0)),
                    pa.array(np.full(total, n, np.int64)),
                    pa.array(np.bincount(rows, base[at], total) + end_base),
                    pa.array(np.bincount(rows, lp[at], total) + end_score)], names))
        return pa.Table.from_batches(parts)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    asked = dealt.groupBy("block").applyInArrow(ask, "block long, h long")
    given = asked.join(known, "h")
    return dealt.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        answer, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"))
