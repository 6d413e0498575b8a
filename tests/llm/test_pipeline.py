"""The pipeline, stage by stage, on the smallest tables."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.test_edges import brute_lines

pipeline = pytest.importorskip("corpus_pipeline")
from changefold.llm.common import staged, table  # noqa: E402
from changefold.llm.queries import tokenizer_path  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows that each stage was given, by its name, and what the last one gave."""
    docs, seen = table(spark, sf_dir, "documents"), []
    for name, stage in pipeline.STAGES:
        given = docs
        docs = staged(stage(spark, docs, sf_dir), "test-stage")
        seen.append((name, given.collect(), docs))
    return seen


def test_the_stages_are_in_order():
    names = [name for name, _ in pipeline.STAGES]
    assert len(names) == 5 and [n.split()[0] for n in names] == ["quality", "line", "MinHash", "mixing", "packing"]


def test_columns_and_run(spark, sf_dir, stages):
    for _, _, docs in stages[:-1]:
        assert docs.columns == list(pipeline.COLUMNS)
    whole = pipeline.run(spark, sf_dir)
    last = stages[-1][2]
    count = [F.count(F.lit(1)), F.sum(F.octet_length("ids")), F.countDistinct("doc_id")]
    assert whole.agg(*count).first() == last.agg(*count).first()


def test_quality_keeps_accepted_documents(spark, sf_dir, stages):
    _, given, kept = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    right = [(r["doc_id"] in ids) == (labels[r["doc_id"]] == 1) for r in given if r["doc_id"] in labels]
    assert sum(right) >= 0.95 * len(right)


def test_lines_against_all_pairs(stages):
    _, given, kept = stages[1]
    wanted = brute_lines([(r["doc_id"], r["text"]) for r in given])
    found = {r["doc_id"]: r["text"] for r in kept.collect()}
    gone = {r["doc_id"] for r in given} - set(found)
    assert {d: t for d, t in wanted.items() if d in found} == found
    assert all(wanted[d].strip() == "" for d in gone)


def test_near_duplicates_against_all_pairs(stages):
    _, given, kept = stages[2]
    wanted = brute.components([(r["doc_id"], r["text"]) for r in given], size=5)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, (_, c) in wanted.items() if c == d}


def test_mix_draws_what_the_targets_say(stages):
    _, given, mixed = stages[3]
    size = Counter()
    for r in given:
        size[r["source"]] += len(brute.WORD.findall(r["text"] or ""))
    taken, texts = Counter(), {r["doc_id"]: brute.WORD.findall(r["text"] or "") for r in given}
    for r in mixed.collect():
        words = brute.WORD.findall(r["text"])
        own = texts[r["doc_id"]]
        assert words in (own, own[: len(words)], own[len(own) - len(words) :])
        taken[r["source"]] += len(words)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), abs=len(size))
    assert all(taken[s] <= 2 * n for s, n in size.items())


def test_packing_is_a_round_trip(stages):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    _, given, packed = stages[4]
    wanted = Counter()
    for r in given:
        wanted[r["doc_id"]] += len(brute.token_ids(tokenizer, r["text"]))
    sequences, tokens = defaultdict(list), Counter()
    for r in packed.collect():
        ids = np.frombuffer(r["ids"], "<u4")
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
        tokens[r["doc_id"]] += len(ids)
    assert tokens == wanted
    assert all(brute.gapless(p) <= 2048 for p in sequences.values())
