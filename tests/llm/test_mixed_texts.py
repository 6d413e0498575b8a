"""How the mix moves texts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCUMENTS

mixing = pytest.importorskip("changefold.llm.mixing")


def docs_of(spark, ids):
    rows = [(d, " ".join(f"t{i}x{k}" for k in range(5 + 13 * i % 70)), "en", "abc"[i % 3], None) for i, d in enumerate(ids)]
    return spark.createDataFrame(rows, DOCUMENTS)


def mixed(docs):
    sized, sources, pieces = mixing.mix(docs, block=16)
    taken = mixing.taken(sized, sources, pieces).agg(F.sum("taken")).first()[0]
    return taken, mixing.mixed_documents(docs, pieces)


def test_texts_with_own_ids_move_without_being_numbered(spark):
    docs = docs_of(spark, [*range(60), None])
    taken, rows = mixed(docs)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert sum(len(r["text"].split()) for r in rows.collect()) == taken


def test_rows_that_share_ids_are_drawn_one_by_one(spark):
    docs = docs_of(spark, [*range(40), *[None] * 9, *[7] * 5, 3])
    docs = docs.unionByName(docs.where("doc_id = 11")).unionByName(docs.where("doc_id = 11"))
    taken, rows = mixed(docs)
    given = Counter((r["doc_id"], r["source"], w) for r in docs.collect() for w in r["text"].split())
    drawn = Counter((r["doc_id"], r["source"], w) for r in rows.collect() for w in r["text"].split())
    assert sum(drawn.values()) == taken
    assert set(drawn) <= set(given) and all(n <= 2 * given[key] for key, n in drawn.items())
