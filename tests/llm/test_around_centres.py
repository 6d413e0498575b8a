"""Near duplicates among classes around one centre: no link lost, and no pair made because of the centre alone."""

import random

import pytest
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS

near_dedup = pytest.importorskip("changefold.llm.near_dedup")


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", None) for i, t in texts], DOCUMENTS)


def found_and_compared(spark, monkeypatch, texts, **settings):
    """doc_id → (size of the set, component_id), and how many pairs were compared on their full sets."""
    pairs, measure = [], near_dedup._measured

    def counted(given, sets):
        given = near_dedup.staged(given, "test-pairs")
        pairs.append(given.count())
        return measure(given, sets)

    monkeypatch.setattr(near_dedup, "_measured", counted)
    rows = near_dedup.near_duplicates(docs_of(spark, texts), **settings).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}, sum(pairs)


def test_texts_around_a_common_line_are_not_all_compared(spark, monkeypatch):
    rng = random.Random(2)
    line = [f"w{i}" for i in range(24)]
    own = [line + [f"v{i}x{k}" for k in range(rng.randrange(7, 12))] for i in range(150)]
    own += [words[:-1] + [f"other{i}"] for i, words in enumerate(own[:30])]  # linked with one of the others
    own += [line[:-1] + [f"near{i}"] for i in range(60)]  # linked with the line
    texts = [(i, " ".join(words)) for i, words in enumerate([line, *own])]
    found, compared = found_and_compared(spark, monkeypatch, texts, words=2)
    assert found == brute.components(texts)
    assert compared < 5 * len(texts)


@pytest.mark.parametrize("seed, percent", [(1, 80), (2, 80), (3, 65), (4, 90)])
def test_families_against_all_pairs(spark, monkeypatch, seed, percent):
    """Copies of copies with words left out, put in, changed and moved, in families that share lines and habits."""
    rng = random.Random(seed)
    lines = [[f"l{k}w{i}" for i in range(rng.randrange(6, 30))] for k in range(6)]
    extra = [f"e{i}" for i in range(25)]
    texts = []
    for _ in range(8):
        family = [[w for line in rng.sample(lines, rng.randrange(1, 4)) for w in line]]
        for _ in range(35):
            words = list(rng.choice(family[:6]))
            for _ in range(rng.randrange(0, 1 + len(words) // 8)):
                at, kind = rng.randrange(len(words)), rng.randrange(4)
                if kind == 0 and len(words) > 3:
                    del words[at]
                elif kind == 1:
                    words.insert(at, rng.choice(extra))
                elif kind == 2:
                    words[at] = f"n{rng.randrange(10**6)}"
                else:
                    words = words[at:] + words[:at] if rng.randrange(8) == 0 else words[: max(3, len(words) - 2)]
            family.append(words)
        texts += family
    texts = [(i, " ".join(words)) for i, words in enumerate(rng.sample(texts, len(texts)))]
    # Two bins a bucket: linked sets of a lower similarity meet as surely.
    monkeypatch.setattr(near_dedup, "ROWS", 2)
    found, _ = found_and_compared(spark, monkeypatch, texts, words=2, percent=percent)
    assert found == brute.components(texts, percent=percent)
