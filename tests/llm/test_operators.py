"""The operators against brute force, on a small table and on awkward rows."""

import math

import numpy as np
import pytest
import tiktoken
import public_tokenizers
from pyspark.sql import functions as F

from marketlens.llm import (
    bpe, chat, components, fingerprints, lattice, licences, mixture, quality, simhash, substrings,
    urls,
)
from marketlens.llm.words import Words, slices
from tests.llm import brute
from tests.llm.conftest import FOLDER, PASSAGE, pairs

import pyarrow as pa


@pytest.fixture(params=["documents", "odd", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


def multiset(rows):
    return sorted(rows, key=repr)


def test_words_are_cut_at_ascii_space_only():
    texts = pa.array(["a\x0bb  c\u00a0d", None, "", " é\n"])
    found = Words.of(texts)
    assert found.counts.tolist() == [3, 0, 0, 1]
    assert found.texts() == [brute.words(t) for t in texts.to_pylist()]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 7)], ["t"])
    assert sum(p.num_rows for p in slices(batch, "t")) == 7


def test_simhash_fingerprints_and_groups(docs):
    found = simhash.near_copies(docs).select("doc_id", "fp", "component_id").collect()
    given = pairs(docs)
    prints = [(d, brute.simhash(t)) for d, t in given]
    want = [(d, p, c) for (d, p), c in zip(prints, brute.linked(prints, 2))]
    assert multiset((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in found) == multiset(want)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({c if c is not None else ("?", p) for _, p, c in want})


def test_simhash_links_are_exact_across_tiles(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 300, dtype=np.int64).astype(np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    chain = near ^ (np.uint64(3) << rng.integers(0, 62, 300).astype(np.uint64))
    prints = [(i, int(p)) for i, p in enumerate(np.unique(np.concatenate((base, near, chain))))]
    nodes = spark.createDataFrame(
        [(int(np.uint64(p).astype(np.int64)),) for _, p in prints], "fp long")
    roots = {r.node % 2 ** 64: r.root % 2 ** 64
             for r in components.components(simhash.links(nodes, tile=8)).collect()}
    groups, mine = {}, {}
    for (_, p), c in zip(prints, brute.linked(prints, 2)):
        groups.setdefault(c, set()).add(p)
        mine.setdefault(roots.get(p, p), set()).add(p)
    assert multiset(map(sorted, groups.values())) == multiset(map(sorted, mine.values()))


def test_substrings_are_cut_exactly(docs):
    found = substrings.cut_repeats(docs).collect()
    given = pairs(docs)
    want = [(d, *c) for (d, _), c in zip(given, brute.cut(given))]
    assert multiset((r.doc_id, r.n_words, r.n_removed, r.kept_text.encode())
                    for r in found) == multiset(want)
    assert substrings.without_repeats(docs).columns == docs.columns


@pytest.mark.parametrize("tag_bits, key_bits", [(1, 64), (31, 10), (1, 10)])
def test_substrings_are_cut_exactly_when_hashes_collide(spark, tag_bits, key_bits):
    words = [f"w{i}" for i in range(400)]
    rows = [(d, " ".join(["a" * (d % 5 + 1)] * (d % 3) + words[9 * d:9 * d + 40 + 7 * (d % 4)]
                         + [f"end{d % 6}"] + words[5 * d:5 * d + 30])) for d in range(40)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    found = substrings.cut_repeats(docs, tag_bits=tag_bits, key_bits=key_bits).collect()
    want = [(d, *c) for (d, _), c in zip(rows + rows[:5], brute.cut(rows + rows[:5]))]
    assert multiset((r.doc_id, r.n_words, r.n_removed, r.kept_text.encode())
                    for r in found) == multiset(want)


def test_long_paths_contract(spark):
    long = " ".join(f"x{i}" for i in range(5000))
    rows = [(1, "other start " + long), (2, long), (3, f"a b c {long} d"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.cut_repeats(docs).collect()
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 5000, 3: 5000, 4: 0, 5: 0}
    sizes = sorted(r.n_words for r in substrings.repeated_spans(docs).collect())
    assert sizes == [13] * 4 + [4998] * 2


def test_substring_sources_hold_the_same_words(odd):
    texts = {}
    for doc, text in pairs(odd):
        texts.setdefault(doc, []).append(brute.words(text))
    for r in substrings.repeated_spans(odd).where("n_words is not null").collect():
        mine = {tuple(w[r.pos:r.pos + r.n_words])
                for w in texts[None if r._doc == 2 ** 63 - 1 else r._doc]}
        theirs = {tuple(w[r.src_pos:r.src_pos + r.n_words]) for w in texts[r.src]}
        assert mine & theirs and r.src < r._doc


def test_mixture_meets_its_targets(docs):
    found = mixture.taken(docs).collect()
    sizes, wanted = {}, []
    for r in docs.select("doc_id", "text", "source").collect():
        n = len(brute.words(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        wanted.append((r.doc_id, n, r.source))
    target = brute.targets(sizes) if sizes else {}
    assert multiset((r.doc_id, r.size, r.source_size) for r in found) == multiset(
        (d, n, sizes[s]) for d, n, s in wanted)
    assert all(r.taken <= 3 * r.size for r in found)
    assert math.isclose(sum(target.values()), sum(r.taken for r in found), abs_tol=len(sizes) + 1)
    assert {round(r.target, 6) for r in found} == {round(t, 6) for t in target.values()}
    again = mixture.taken(docs.repartition(3)).collect()
    assert multiset(map(tuple, found)) == multiset(map(tuple, again))


def test_mixture_permutes_blocks_pseudorandomly(spark):
    sizes = [*range(1, 40), 1001, 4095, 4096, 20011]
    table = spark.createDataFrame([(n, k) for n in sizes for k in ("a", "b", None)],
                                  "n long, source string")
    made = table.selectExpr("*", "explode(sequence(0L, n + 2)) as at").withColumn(
        "to", mixture.permuted("at", "n", "source")).toPandas()
    for (n, _), part in made.groupby(["n", "source"], dropna=False):
        found, at = part.sort_values("at")["to"].to_numpy(), np.arange(n + 3)
        assert (np.sort(found[:n]) == at[:n]).all() and (found[n:] == at[n:]).all()
        if n > 1000:  # neighbours scatter, and no index keeps its distance
            steps = np.diff(found[:n])
            assert len(np.unique(steps)) > n / 3 and np.mean(np.abs(steps)) > n / 4
            assert abs(np.corrcoef(at[:n], found[:n])[0, 1]) < 0.1
    wide = made[made["n"] == 1001].pivot_table(index="at", columns="source", values="to")
    assert (wide["a"] == wide["b"])[:1001].mean() < 0.02


def test_mixed_texts_are_as_long_as_taken(odd, documents):
    for docs in (odd, documents):
        shown = mixture.mixed(docs)
        assert shown.columns == docs.columns
        count = F.coalesce(F.regexp_count("text", F.lit(mixture.WORD)), F.lit(0))
        got = {r.doc_id: r.n for r in shown.groupBy("doc_id").agg(F.sum(count).alias("n")).collect()}
        want = {}
        for r in mixture.taken(docs).collect():
            want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
        assert got == {d: n for d, n in want.items() if n}


def test_bpe_is_tiktokens_and_decodes(docs):
    ranks = bpe.read_ranks(bpe.RANKS)
    known = tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    found = bpe.decode(bpe.encode(docs)).collect()
    assert multiset((r.doc_id, r.ids, bytes(r.decoded)) for r in found) == multiset(
        (d, known.encode_ordinary(t or ""), (t or "").encode()) for d, t in pairs(docs))
    for r in found:
        starts = [len(b"".join(bpe.token_bytes(bpe.RANKS)[i] for i in r.ids[:k]))
                  for k in range(min(len(r.ids), 50))]
        assert r.offsets[:50] == starts


def test_bpe_decodes_by_offsets(spark, docs):
    coded = bpe.encode(docs)
    plain = bpe.decode(coded.drop("offsets"), offsets=None)
    assert multiset((r.doc_id, bytes(r.decoded)) for r in plain.collect()) == multiset(
        (d, (t or "").encode()) for d, t in pairs(docs))
    rows = [(None, None), ([], []), ([5, 6], [0, 1]), ([7], [0])]
    schema = "ids array<int>, offsets array<int>"
    tokens = bpe.token_bytes(bpe.RANKS)
    rows[2] = ([5, 6], [0, len(tokens[5])])
    found = bpe.decode(spark.createDataFrame(rows, schema)).collect()
    assert multiset(bytes(r.decoded) for r in found) == multiset(
        [b"", b"", tokens[5] + tokens[6], tokens[7]])
    wrong = spark.createDataFrame([([5, 6], [0, len(tokens[5]) + 1])], schema)
    with pytest.raises(Exception, match="offsets do not fit"):
        bpe.decode(wrong).collect()


def test_bpe_boundaries_on_every_code_point():
    ranks = {bytes([b]): b for b in range(256)}
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    text = "".join(map(chr, points))
    for kind, pattern in ((0, r"\p{L}"), (1, r"\p{N}"), (3, r"\s")):
        known = tiktoken.Encoding("k", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        want = {ord(c) for c in bytes(known.encode_ordinary(text)).decode()}
        assert want == {p for p in points if bpe.classes()[p] == kind}


def test_lattice_adds_all_segmentations():
    book = lattice.lattice(lattice.VOCABULARY)
    with np.errstate(divide="ignore"):
        logs = np.log(book.first)
    model = lattice.sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(lattice.VOCABULARY))
    pieces = {model.id_to_piece(i): i for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def slow(word):
        text = lattice.MARK + word
        ways = [1.0] + [0.0] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(j):
                piece = pieces.get(text[i:j])
                if piece is not None:
                    ways[j] += ways[i] * math.exp(logs[piece])
                elif j - i == 1:
                    ways[j] += ways[i] * math.exp(
                        sum(logs[book.bytes_at[b]] for b in text[i].encode()))
        return math.log(ways[-1])

    tried = ["the", "ouandre", "érépa", "☃x", "", "日本"]
    assert np.allclose(book.score(tried, logs), [slow(w) for w in tried])
    expected = book.expect(tried, np.ones(len(tried)), logs)
    for piece in (pieces["the"], pieces["x"], pieces[lattice.MARK + "the"]):
        moved = logs.copy()
        moved[piece] += 1e-6
        slope = (book.score(tried, moved).sum() - book.score(tried, logs).sum()) / 1e-6
        assert abs(slope - expected[piece] / lattice.UNIT) < 1e-4
    very_long = ["x" * 500, "y" * 500]
    assert np.isfinite(book.score(very_long, logs)).all()
    assert (book.expect(very_long, np.ones(2), logs) >= 0).all()
    mixed = tried + very_long + ["z" * n for n in range(60, 70)]
    counts = np.arange(1.0, len(mixed) + 1)
    alone = sum(book.expect([w], np.array([c]), logs) for w, c in zip(mixed, counts))
    assert (book.expect(mixed, counts, logs) == alone).all()


def test_lattice_does_not_depend_on_partitions(spark, documents):
    def scores(docs):
        return sorted((r.doc_id, r.score) for r in lattice.lattice_scores(docs).collect())

    once = scores(documents.coalesce(1))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, "20")
        assert scores(documents.repartition(16)) == once
    finally:
        spark.conf.set(size, before)


def test_lattice_scores_by_brute_force(documents):
    docs = documents.where("doc_id < 40")
    counts = lattice.count_words(docs)
    ends = docs.where(~lattice.held_out(docs)).count()
    logs = lattice.reweighted(counts, ends)
    book = lattice.lattice(lattice.VOCABULARY)
    for r in lattice.lattice_scores(docs).collect():
        text, = [t for d, t in pairs(docs) if d == r.doc_id]
        words = [w.lower().decode() for w in brute.words(text)]  # of bytes: A-Z only
        want = sum(float(book.score([w], logs)[0]) for w in words) + logs[book.end]
        assert math.isclose(r.score, want / math.log(10), rel_tol=1e-9)


def test_lattice_scores(docs):
    found = lattice.lattice_scores(docs).collect()
    given = pairs(docs)
    want = [(d, *b) for (d, _), b in zip(given, brute.base_scores(given))]
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    assert len(found) == len(want)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        assert math.isfinite(a[6]) and a[6] < 0


def test_lattice_prefers_text_to_noise(documents):
    twisted = documents.where("lang = 'en' and doc_id % 7 = 3").select(
        (F.col("doc_id") + 10 ** 6).alias("doc_id"), F.reverse("text").alias("text"))
    both = documents.select("doc_id", "text").unionByName(twisted)
    found = {r.doc_id: r.score / r.n_tokens for r in lattice.lattice_scores(both).collect()}
    assert all(found[d - 10 ** 6] > s for d, s in found.items() if d >= 10 ** 6)


def test_quality_counts_and_verdicts(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = quality.judge(docs, quality.fit(docs, labels)).collect()
    want = [(d, *quality_counts) for (d, t) in pairs(docs)
            for quality_counts in [brute.quality_base(t)]]
    assert multiset((r.doc_id, *[r[c] for c in quality.BASE]) for r in found) == multiset(want)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.p_good >= quality.THRESHOLD)


def test_quality_model_on_unseen_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    unseen = labels.where("doc_id % 3 = 0")
    model = quality.fit(docs, labels.where("doc_id % 3 <> 0"))
    judged = quality.judge(docs, model).join(unseen, "doc_id").where("not base_failed")
    right = judged.where("kept = (quality = 1)").count() / judged.count()
    assert right > 0.97
    plain = quality.fit(docs, labels.limit(0))
    assert quality.judge(docs, plain).where("kept = base_failed").count() == 0


def test_quality_fits_few_rows_of_the_table(spark):
    good, bad = "plain words of a good text " * 12, "$ cheap spam | click | now $ " * 12
    rows = [(i, (good if i % 2 else bad) + f"number {i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    absent = [(i, i % 2) for i in range(1000, 5000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + absent,
                                   "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert model.weights.any()
    found = {r.doc_id: r.p_good for r in quality.judge(docs, model).collect()}
    assert min(found[i] for i in range(1, 12, 2)) > max(found[i] for i in range(0, 12, 2))
    assert quality.fit(docs.limit(0), labels).weights.any() == False  # noqa: E712
    pair = quality.fit(docs.where("doc_id < 2"), labels)
    assert pair.weights.any() and np.isfinite([pair.slope, pair.shift]).all()


def test_quality_sample_has_one_row_for_each_id(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    hot = labels.where("quality is not null").first().doc_id
    copies = documents.unionByName(documents.where(F.col("doc_id") == hot).crossJoin(
        spark.range(500)).drop("id"))
    assert quality._sample(copies, labels, 2400).count() == quality._sample(
        documents, labels, 2400).count()
    one, other = quality.fit(documents, labels), quality.fit(copies, labels)
    assert np.array_equal(one.weights, other.weights) and one.slope == other.slope


def test_fingerprint_differences_are_recovered(docs):
    found = fingerprints.fingerprints(docs).collect()
    given = sorted({(d is None, d or 0, t or "") for d, t in pairs(docs)}, key=lambda x: x[:2])
    assert len(found) == docs.count()
    alike = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == 1 or r.fingerprint != r.edited_fingerprint
        alike.setdefault(r.fingerprint, set()).add(r.near_next)
    ids = [g[:2] for g in given]
    if len(set(ids)) == len(ids):  # with unique ids the next document is known here
        import re
        cut = re.compile(fingerprints._PARAGRAPH)
        units = lambda t: {m.rstrip(" ") for m in cut.findall(t)}
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        by_id = {r.doc_id: r for r in found}
        for k, (_, doc, text) in enumerate(given):
            after = given[(k + 1) % len(given)][2]
            n = len(text) // 4
            edited = text[:len(text) - n] + after[:n]
            r = by_id[doc]
            assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(edited))
            assert math.isclose(r.near_edited, near(units(text), units(edited)))
            assert math.isclose(r.near_next, near(units(text), units(after)))


def test_fingerprint_differences_come_out_as_digests(spark):
    lines = lambda a, b: "\n".join(f"line {i}" for i in range(a, b))
    rows = [(1, "same\ntext", "same\ntext"), (2, "a\nb\nc", "b\nd"), (3, None, "x"), (4, None, ""),
            (5, lines(0, 12), lines(3, 14)), (6, lines(0, 400), lines(150, 900)),
            (7, "a\na\nb", "a"), (7, "a\na\nb", "a")]
    table = spark.createDataFrame(rows, "xs int, one string, other string")
    made = fingerprints.difference(table)
    assert made.columns == ["xs", "one", "other", "difference"]
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    known = {r.line: r.digest for r in spark.createDataFrame(
        [(x,) for _, *both in rows for t in both for x in (t or "").split("\n")],
        "line string").select("line", F.xxhash64("line").alias("digest")).collect()}
    found = made.collect()
    assert len(found) == len(rows)
    for r in found:
        one, other = ({x for x in (t or "").split("\n") if x} for t in (r.one, r.other))
        want = [(1, known[x]) for x in one - other] + [(-1, known[x]) for x in other - one]
        assert sorted(map(tuple, r.difference)) == sorted(want)
    assert fingerprints.difference(table.limit(0)).isEmpty()


def test_fingerprints_run_without_python(documents):
    plan = fingerprints.fingerprints(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_peeling_retries_when_the_sketch_is_too_small(spark):
    rows = [(1, "\n".join(f"line {i}" for i in range(400))),
            (2, "\n".join(f"line {i}" for i in range(200, 700)))]
    found = {r.doc_id: r for r in fingerprints.fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert math.isclose(found[1].near_next, 200 / 700)


def test_chat_paths_ranks_and_round_trip(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a1", 1.0),
            ("t", 3, 1, "assistant", "a2", 2.0), ("t", 4, 2, "us:er\\", "</turn>\n### x : y\\", 5.0),
            ("t", 5, 9, "user", "orphan", 0.1), (None, 1, None, None, None, None)]
    nodes = spark.createDataFrame(
        rows, "tree string, node int, parent int, role string, text string, score double")
    made = chat.format_trees(nodes, 2).withColumn("back", chat.turns_of(F.col("formatted")))
    found = {(r.tree, r.rank): [tuple(t) for t in r.back] for r in made.collect()}
    assert found == {
        ("t", 1): [("user", "q"), ("assistant", "a1"), ("us:er\\", "</turn>\n### x : y\\")],
        ("t", 2): [("user", "q"), ("assistant", "a2")], (None, 1): [("", "")]}
    loss = made.where("rank = 2").first()
    (start, length), = loss.loss
    assert loss.formatted[start:start + length] == "a2"
    assert chat.format_trees(nodes.limit(0)).isEmpty()


def test_chat_repeated_rows_cycles_and_deep_chains(spark):
    schema = "tree string, node int, parent int, role string, text string, score double"
    chain = [("r", n, n - 1 or None, "user", f"x{n}", 1.0) for n in range(1, 5)]
    looped = [("c", 1, 2, "user", "a", 0.0), ("c", 2, 1, "user", "b", 0.0),
              ("d", 1, 2, "user", "a", 0.0), ("d", 2, 3, "user", "b", 0.0),
              ("d", 3, 2, "user", "c", 0.0), ("d", 7, None, "user", "own", 0.0)]
    deep = [("z", n, n - 1 if n else None, "assistant", f"t{n}", 0.0) for n in range(300)]
    nodes = spark.createDataFrame(chain + chain + looped + deep, schema).withColumns(
        {c: F.lit(9) for c in ("leaf", "dist", "rank", "up", "total", "turns", "sizes")})
    found = {r.tree: [t.text for t in r.back] for r in chat.format_trees(nodes.repartition(3))
             .withColumn("back", chat.turns_of(F.col("formatted"))).collect()}
    assert found == {"r": ["x1", "x1", "x2", "x2", "x3", "x3", "x4", "x4"], "d": ["own"],
                     "z": [f"t{n}" for n in range(300)]}


def test_chat_very_long_text(spark):
    text = "\\ # <\n" * 60_000
    nodes = spark.createDataFrame([("t", 1, None, "assistant", text, 0.0)],
                                  "tree string, node int, parent int, role string, text string, "
                                  "score double")
    made = chat.format_trees(nodes).withColumn("back", chat.turns_of(F.col("formatted"))).first()
    assert [t.text for t in made.back] == [text]


def test_chat_query_reads_back_every_turn(spark):
    found = {r.conv_id: r for r in chat.op7_chat(spark, FOLDER).collect()}
    turns = {}
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy(
            "conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = r"\### Assistant: </turn> ok"
    turns[-7] = [("user", said), ("assistant", said)]
    assert set(found) == set(turns)
    for conv, told in turns.items():
        own = "".join(t for role, t in told if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars) == (len(told), len(own))
        assert r.turns_sha256 == brute.sha("".join(f"{a}\n{b}\n" for a, b in told))
        assert r.loss_sha256 == brute.sha(own)


def test_url_parts_and_rules(spark):
    rows = [(1, "http://WWW.Example.com/en/1?x=/fr/"), (2, "https://a.example.com/en/2"),
            (3, "x://net/es/#"), (4, "x://planet/es/"), (5, None), (6, "no scheme"),
            (7, "http://a.net"), (8, "http://cheappills.org/buy"), (8, "http://cheappills.org/buy"),
            (9, "http://É.com/A b?c")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {"html": F.lit("<p>cheap plain words</p>"), "host": F.lit("?")})
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert found[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert found[2] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert found[3] == ("net", "/es/", "net/es/", "block")
    assert found[4][2] is None and found[5] == ("", "", None, "allow")
    assert found[6][:3] == ("", "", None) and found[7][:3] == ("a.net", "", None)
    assert found[8] == ("cheappills.org", "/buy", None, "block")
    assert found[9][:3] == ("É.com", "/A b", "com/")
    assert urls.judge(pages).count() == len(rows) and urls.judge(pages.limit(0)).isEmpty()


def test_page_words_are_counted_whole(spark):
    long = "x" * 50
    pages = spark.createDataFrame([(f"<b>Ab</b> ab {long} c",), (None,), ("",)], "html string")
    assert {tuple(r) for r in urls.word_counts(pages).collect()} == {("ab", 2), (long, 1)}


def test_viterbi_finds_the_best_cut():
    known = {"cheap": -2.0, "pills": -3.0, "che": -3.5, "ap": -3.0, "pill": -3.2}
    assert urls.viterbi("cheappills", known, -6.0) == ["cheap", "pills"]
    assert urls.viterbi("zz", {}, -6.0) == ["zz"] and urls.viterbi("", {}, -6.0) == []


def test_licences_and_inheritance(spark):
    mit = "Released under the MIT License."
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.py", "print(1)\n" * 40),
            (3, "a/b/LICENSE", "Licensed under the Apache License, Version 2.0."),
            (4, "a/b/d.py", "# nothing here"), (5, "other/x.py", None), (6, None, ""),
            (7, "a/z.py", "code " * 99 + "\n" + "Copyright someone. All rights reserved."),
            (4, "a/b/d.py", "# nothing here")]
    files = spark.createDataFrame(rows, "file long, path string, text string").withColumn(
        "licence", F.lit("?"))
    found = {r.file: (r.own_licence, r.licence, r.licence_dir)
             for r in licences.scan(files).collect()}
    assert found == {
        1: ("MIT", "MIT", None), 2: (None, "Apache-2.0", "a/b"),
        3: ("Apache-2.0", "Apache-2.0", None), 4: (None, "Apache-2.0", "a/b"),
        5: (None, None, None), 6: (None, None, None), 7: ("proprietary", "proprietary", None)}
    assert licences.scan(files).count() == len(rows) and licences.scan(files.limit(0)).isEmpty()


def test_licence_scores_do_not_depend_on_the_other_files(spark):
    mine = spark.createDataFrame([(-1, "a/x", "words\nAll rights reserved.\nwords")],
                                 "file long, path string, text string")
    scores = []
    for n in (100, 1_000_000):
        others = spark.range(n).select(F.col("id").alias("file"), F.lit("b/y").alias("path"),
                                       F.lit("Licensed under CC BY 4.0.").alias("text"))
        found = licences.scan(mine.unionByName(others)).where("file = -1").first()
        scores.append((found.own_licence, found.score))
    assert scores[0] == scores[1] and scores[0][0] == "proprietary"


MIT = """Copyright (c) 2031 Someone Else

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def test_full_licence_texts_stand_for_their_directory(spark, documents):
    folder = licences._TEXTS
    texts = {"MIT": MIT} | {name: open(f"{folder}/{name}.txt").read().replace(
        "The Regents of the University of California", "Some One and others")
        for name in ("BSD-3-Clause", "Apache-2.0")}
    prose = " ".join(t for _, t in pairs(documents.limit(3)))
    rows = []
    for name, text in texts.items():
        rows += [(len(rows), f"{name}/COPYING", text),
                 (len(rows) + 1, f"{name}/src/x.py", "print(1)"),
                 (len(rows) + 2, f"flat{name}/COPYING", " ".join(text.split())),
                 (len(rows) + 3, f"flat{name}/x.py", prose)]
    rows.append((99, "z/x", " ".join(prose.split()) + " Copyright. All rights reserved. " + prose))
    found = {r.path: (r.licence, r.licence_dir) for r in licences.scan(
        spark.createDataFrame(rows, "file long, path string, text string")).collect()}
    for name in texts:
        assert found[f"{name}/COPYING"] == found[f"flat{name}/COPYING"] == (name, None)
        assert found[f"{name}/src/x.py"] == (name, name)
        assert found[f"flat{name}/x.py"] == (name, f"flat{name}")
    assert found["z/x"] == ("proprietary", None)


def test_repeated_licensed_rows_stay_as_many(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License.")] * 5 + [(2, "a/x.py", "x")]
    files = spark.createDataFrame(rows, "file long, path string, text string")
    assert licences.scan(files).count() == 6


def test_passages_of_fifty_words_are_removed(odd):
    kept = {r.kept_text for r in substrings.cut_repeats(odd).where("doc_id <> 1").collect()}
    assert not any(PASSAGE in text for text in kept)
