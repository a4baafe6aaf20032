"""The stages of the corpus pipeline, each on its predecessor's rows."""

import duckdb
import pytest

import corpus_pipeline
import __spark_entry__ as registered
from marketlens.llm.queries import ORACLES
from marketlens.llm.store import stored
from tests.llm import brute
from tests.llm.conftest import FOLDER, pairs


def test_every_operator_is_registered():
    names = registered.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_stages(spark, documents):
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5
    kept = stored(steps["quality rules"](spark, documents, FOLDER))
    assert kept.columns == documents.columns
    assert not any(brute.quality_base(t)[0] < 50 for _, t in pairs(kept))
    assert kept.count() > 0.6 * documents.count()
    single = stored(steps["simhash near-dedup"](spark, kept, FOLDER))
    prints = [(d, brute.simhash(t)) for d, t in pairs(kept)]
    assert {d for d, _ in pairs(single)} == set(brute.linked(prints, 2))
    cut = stored(steps["substring dedup"](spark, single, FOLDER))
    given = pairs(single)
    want = {d: t.encode() if not gone else left
            for (d, t), (_, gone, left) in zip(given, brute.cut(given))}
    assert {d: t.encode() for d, t in pairs(cut)} == want
    mixed = stored(steps["mixing sources"](spark, cut, FOLDER))
    assert mixed.columns == documents.columns
    size = sum(len(brute.words(t)) for _, t in pairs(cut))
    assert abs(sum(len(brute.words(t)) for _, t in pairs(mixed)) - size) <= 40
    coded = stored(steps["byte-level bpe"](spark, mixed, FOLDER))
    assert sorted((r.doc_id, r.decoded_sha256) for r in coded.collect()) == sorted(
        (d, brute.sha(t)) for d, t in pairs(mixed))


def test_stages_on_awkward_and_empty_rows(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, FOLDER))
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "conversations"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    answer = engine.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    found = registered.queries()[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(answer.fetchall())
