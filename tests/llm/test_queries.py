"""The registered queries on the smallest tables, against their SQL or a plain Python version."""

from collections import Counter, defaultdict

import duckdb
import pytest
from tests.llm import brute

llm = pytest.importorskip("changefold.llm.queries")


@pytest.fixture(scope="module")
def tables(sf_dir):
    with duckdb.connect() as connection:
        for name in ("documents", "embeddings", "conversations", "labels"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
        yield connection


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, tables, name):
    found = llm.QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = tables.sql(llm.ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    rows = Counter(tuple(row) for row in found.select(*columns).collect())
    assert rows == Counter(wanted.select(*columns).fetchall())


def test_fingerprints(spark, sf_dir, texts):
    rows = llm.QUERIES["op1_fingerprints"](spark, sf_dir).collect()
    wanted = brute.edits(list(texts.items()))
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in rows} == {d: w[:2] for d, w in wanted.items()}
    for row in rows:
        _, _, edited, following = wanted[row["doc_id"]]
        text = texts[row["doc_id"]] or ""
        assert abs(row["near_edited"] - brute.resemblance(text, edited)) < 0.15
        assert abs(row["near_next"] - brute.resemblance(text, following)) < 0.15
    by_text = defaultdict(set)
    for row in rows:
        by_text[texts[row["doc_id"]]].add(row["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())


def test_personal_data(spark, sf_dir, texts):
    rows = llm.QUERIES["op2_pii"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = brute.base_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == brute.sha(brute.written(spans))
        assert [row[f"n_{k}"] for k in brute.BASE] == [sum(s[2] == k for s in spans) for k in brute.BASE]
        assert {s for s in row["spans"].split(",") if s} >= {brute.written([s]) for s in spans}


def test_quality(spark, sf_dir, tables):
    rows = llm.QUERIES["op6_quality"](spark, sf_dir).collect()
    labels = dict(tables.sql("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == brute.held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    known = [r["predicted"] == labels[r["doc_id"]] for r in held if r["doc_id"] in labels]
    assert sum(known) >= 0.9 * len(known)


def test_packing(spark, sf_dir, texts):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(llm.tokenizer_path())
    rows = llm.QUERIES["op10_packing"](spark, sf_dir).collect()
    ids = {d: brute.token_ids(tokenizer, t) for d, t in texts.items()}
    sequences, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        own = ids[row["doc_id"]]
        assert row["ids_crc32"] == brute.crc(own[row["start"] : row["start"] + row["length"]])
        assert row["doc_tokens"] == len(own)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        pieces[row["doc_id"]].append((row["start"], row["length"]))
    assert all(brute.gapless(p) == len(ids[d]) for d, p in pieces.items()) and set(pieces) == set(ids)
    lengths = [brute.gapless(p) for p in sequences.values()]
    assert max(lengths) <= 2048
    assert sum(2048 - n for n in lengths) <= 4 * 2048


def test_mix_is_the_same_each_time(spark, sf_dir):
    once, again = (Counter(map(tuple, llm.QUERIES["op5_mixing"](spark, sf_dir).collect())) for _ in range(2))
    assert once == again
