"""Merkle manifest, collocations and token files against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlens.llm import collocations, merkle, token_files
from marketlens.llm.store import new_folder, reach_workers
from tests.llm.conftest import FOLDER


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, add=0):
    chars = None if row.n_chars is None else row.n_chars + add
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}"
                    for v in (row.doc_id, row.source, row.lang, chars, row.text)))


def levels(nodes, fanout):
    told = [nodes]
    while len(told[-1]) > 1:
        last = told[-1]
        told.append([digest(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
    return told


def way(told, at, fanout):
    found = []
    for nodes in told[:-1]:
        run = at // fanout * fanout
        found.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])))
        at //= fanout
    return found


def merkle_rows(rows, fanout=2):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in by[lang]], fanout)
    crown = levels([trees[x][-1][0] for x in langs], fanout)
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            path = way(trees[lang], i, fanout) + way(crown, k, fanout)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            sofar = leaf(r, 1 if hit else 0)
            for left, right in path:
                sofar = digest(left, sofar, right)
            yield (r.doc_id, leaf(r), trees[lang][-1][0], crown[-1][0],
                   digest("".join(a + b for a, b in path)), sofar, sofar == crown[-1][0])


def key(row):
    return tuple((v is not None, v) for v in row)


def told(df):
    """The columns of the query, from a manifest."""
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return sorted((tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256),
        folded.alias("f"), folded == F.col("root")).collect()), key=key)


def test_merkle_query(spark, documents):
    got = [tuple(r) for r in merkle.op11_merkle(spark, FOLDER).collect()]
    assert sorted(got) == sorted(merkle_rows(documents.collect()))
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("fanout,digits", [(2, 1), (2, 3), (3, 2)])
def test_merkle_over_several_tiers(spark, documents, odd, fanout, digits):
    for docs in (documents, odd.unionByName(odd)):
        made = merkle.manifest(docs.repartition(3), fanout=fanout, digits=digits)
        assert told(made) == sorted(merkle_rows(docs.collect(), fanout), key=key)


def test_merkle_of_nothing(spark, empty):
    assert merkle.manifest(empty).collect() == []


def test_merkle_many_languages(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"),
        F.concat(F.lit("l"), F.col("id") % 11).alias("lang"), F.lit(1).alias("n_chars"))
    assert told(merkle.manifest(docs, digits=1)) == sorted(merkle_rows(docs.collect()))


def phrases(rows, least, longest, top):
    counts, totals = {}, Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        own = counts.setdefault(lang, Counter())
        text = (r.text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                own.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, own in counts.items():
        named = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in named.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        rows = []
        for p, a in named.items():
            if 100 * around[p] < 50 * a:
                score, k = min((10 ** 6 * a * a // (own[p[:k]] * own[p[k:]]), k)
                               for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            yield lang, i, p.decode(), -a, left, right, totals[lang], -score


@pytest.mark.parametrize("least,longest,top", [(10, 3, 2000), (4, 4, 25), (6, 2, 7)])
def test_collocations(spark, documents, odd, least, longest, top):
    reach_workers(spark)
    docs = documents.unionByName(odd.select(*documents.columns))
    found = collocations.collocations(docs.repartition(5), min_count=least, max_words=longest,
                                      top=top)
    assert sorted(map(tuple, found.collect())) == sorted(
        phrases(docs.collect(), least, longest, top))


def test_collocations_across_blocks_and_pieces(spark):
    """A text of many blocks, gaps at every kind of piece end, one hot word."""
    rng = random.Random(3)
    words = [rng.choice(["the", "the", "the", "Ä1", "x\x0by", "q\x0cz", "über", "no;n"])
             + rng.choice(["", "", ",", ".", ":", "\n", "\x0d", "!"]) for _ in range(30_000)]
    rows = [(1, " ".join(words), None), (2, "\t".join(words[:9000]), "und"),
            (3, "The THE the", "en"), (4, None, "en"), (5, " . ,", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == sorted(
        phrases(docs.collect(), 10, 3, 2000))


def test_collocations_of_whole_blocks(spark):
    """Runs that end at, before and after the end of a block do not reach into the next run."""
    rng = random.Random(5)
    rows = []
    for i, extra in enumerate((-1, 0, 1, collocations.BLOCK)):
        words = [rng.choice("abcdef") for _ in range(collocations.BLOCK + extra)]
        rows += [(i, " ".join(words), f"l{i}"), (i, "a b c d", f"l{i}x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    for longest in (3, 4):
        found = collocations.collocations(docs, max_words=longest)
        assert sorted(map(tuple, found.collect())) == sorted(
            phrases(docs.collect(), 10, longest, 2000))


def test_rare_groups_are_not_stored(spark, monkeypatch):
    """Of the rows by position only those of frequent groups are written, no rare pair."""
    words = [f"w{i}" for i in range(60)]
    rng = random.Random(8)
    rare = " ".join(f"{a} {b}." for a in words for b in rng.sample(words, 50) if a < b)
    docs = spark.createDataFrame([(1, rare + " w0 x y." * 12, "en")],
                                 "doc_id long, text string, lang string")
    written = []

    def stored(df):
        kept = store(df)
        if "at" in df.columns:
            written.append(kept.count())
        return kept

    store = collocations.stored
    monkeypatch.setattr(collocations, "stored", stored)
    found = collocations.collocations(docs)
    assert [r.phrase for r in found.collect()] == ["w0 x y"]
    assert written == [24]


def test_long_keys(spark):
    """Ids too large for one long make decimal keys with the same groups."""
    pairs = spark.createDataFrame([(i, 5, 7) for i in range(12)] + [(20, 6, 7)],
                                  "at long, g long, h long")
    for ids in (8, 1 << 33):
        found, above, _ = collocations._grown(pairs, ids, 10)
        assert [(r.left, r.right, r.f) for r in found.collect()] == [(5, 7, 12)]
        assert above >= 1


def test_collocations_of_nothing(spark, empty):
    assert collocations.collocations(empty).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(token_files.FILE))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_query(spark, documents, tokenizer):
    found = {r.doc_id: r for r in token_files.op13_token_files(spark, FOLDER).collect()}
    at = 0
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = ids_of(tokenizer, r.text)
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(found.pop(r.doc_id)) == (r.doc_id, at, len(ids), crc)
        at += len(ids)
    assert not found


def test_ids_of_awkward_texts(tokenizer):
    rng = random.Random(1)
    letters = "aAbBsStTdmHİßΣς.,;:!?'\"- \t\n\x0ḇ̸́é1２٣日本🙂<|>=\x1c relvL"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(5000)]
    texts += ["a<|endoftext|>b <|startoftext|>", None, "", "don't 's,they're.We'Ll", "w" * 5000]
    ids, counts = token_files._Coder(public_tokenizers.path(token_files.FILE)).rows(
        pa.array(texts, pa.string()), 2)
    for text, found in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == ids_of(tokenizer, text), repr(text)


def test_pieces_encoded_together_are_those_encoded_alone(tokenizer):
    pieces = ["ci\u00f3n", ".", "\u0000", "e\u0301t\u00e9", "\ufffd", "\u4f60\u597d\u4f60", "a.b", "\u200d", "\U0001f600x",
              "X1-2", "\u00a0", "\u0130I"]
    ids, counts = token_files._Coder(public_tokenizers.path(token_files.FILE)).together(
        [p.encode() for p in pieces])
    alone = [tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
    assert counts.tolist() == list(map(len, alone))
    assert ids.tolist() == [i for found in alone for i in found]


def test_token_files_hold_all_rows_in_order(spark, odd, empty, tokenizer):
    reach_workers(spark)
    path = new_folder(spark)
    token_files.write(odd.repartition(3), path, files=3, stripe_bytes=1 << 16, stride=1000)
    rows = token_files.read(spark, path).orderBy("start").collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, ids_of(tokenizer, r.text))
                  for r in odd.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in rows) == want
    assert [r.doc_id or 0 for r in rows] == [d for _, d, _ in want]
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))
    none = new_folder(spark)
    token_files.write(empty, none)
    assert token_files.read(spark, none).collect() == []


def test_token_files_have_bloom_filters_and_row_indexes(spark, documents):
    """Read from the files' own metadata; a lookup asks ORC for the wanted ids only."""
    reach_workers(spark)
    path = new_folder(spark)
    docs = documents.withColumn("doc_id", F.col("doc_id") * 2)
    token_files.write(docs, path, files=2, stride=1000)
    jvm, name = spark._jvm, None
    for name in token_files.read(spark, path).inputFiles():
        if "/ids/" not in name:
            continue
        options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(name), options)
        assert reader.getRowIndexStride() == 1000
        stripe = reader.rows().readStripeFooter(reader.getStripes().get(0))
        kinds = [stripe.getStreams(i).getKind().toString()
                 for i in range(stripe.getStreamsCount())]
        assert "ROW_INDEX" in kinds and any("BLOOM_FILTER" in k for k in kinds)
    assert [r.doc_id for r in token_files.lookup(spark, path, [10]).collect()] == [10]
    assert token_files.lookup(spark, path, [11]).collect() == []
    plan = token_files.lookup(spark, path, [10, 12])._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*In\(doc_id", plan)
