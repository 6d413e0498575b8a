"""Cases that shortcuts would leave out."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS
from tests.llm.test_edges import brute_lines

pytest.importorskip("changefold.llm.queries")
from changefold.llm import line_dedup, near_dedup, pii, substring_dedup  # noqa: E402


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", None) for i, t in texts], DOCUMENTS)


# -- personal data -------------------------------------------------------------------------


def test_cards_of_single_digits(spark):
    number = "4532015112830366"
    texts = [" ".join(number), "-".join(number), "pay by " + " ".join(number) + " or not", "x" + "-".join(number) + "y", "4 5 3 2", "1-2"]
    for row in pii.find(docs_of(spark, enumerate(texts))).collect():
        base = [(s["start"], s["place"], s["kind"], s["stop"]) for s in row["spans"] if s["kind"] in pii.BASE]
        assert base == brute.base_spans(row["text"])
        assert [k for _, _, k, _ in base] == ["card"] * (row["doc_id"] < 4)


GERMAN, SPACED, BRITISH = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
MALTESE = "MT84MALT011000012345MTLCAST001S"


@pytest.mark.parametrize("number", [GERMAN, SPACED, BRITISH, MALTESE, "NO9386011117947", "NO93 8601 1117 947"])
def test_account_numbers_before_capitals_and_digits(spark, number):
    after = ["", ".", " Please pay", " BIC COBADEFFXXX", " EUR 20", " 20", " 20 EUR by 3 May", " a", "  X", "\nTOTAL 7", " A B C D E F G H I J K L M N O P Q R S T", "é"]
    texts = [before + number + end for before in ("IBAN ", "", "É ", "AB12 ", "ab-") for end in after]
    for row in pii.find(docs_of(spark, enumerate(texts))).collect():
        found = [row["text"][s["start"] : s["stop"]] for s in row["spans"] if s["kind"] == "iban"]
        assert found == [number], row["text"]


def test_account_numbers_that_follow_each_other(spark):
    texts = [f"{GERMAN} {BRITISH} {SPACED} {MALTESE} END", f"{GERMAN}X", f"x{GERMAN}", f"DE89370400440532013001 {GERMAN}", "ZZ97 " + "A" * 40, "AB12 " * 500]
    rows = {r["doc_id"]: [r["text"][s["start"] : s["stop"]] for s in r["spans"] if s["kind"] == "iban"] for r in pii.find(docs_of(spark, enumerate(texts))).collect()}
    assert rows[0] == [GERMAN, BRITISH, SPACED, MALTESE]
    assert rows[1] == rows[2] == rows[4] == [] and rows[3] == [GERMAN]


# -- passages ------------------------------------------------------------------------------


def brute_passages(docs, window=13):
    """Rows told apart by their place in the list: doc_id, words, removed and sha of what is kept."""
    rank = lambda d: (d is None, d or 0)
    words = [brute.WORD.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), own in zip(docs, words, strict=True):
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, rank(d)), rank(d))
    out = Counter()
    for (d, _), own in zip(docs, words, strict=True):
        gone = {j for i in range(len(own) - window + 1) if first[tuple(own[i : i + window])] < rank(d) for j in range(i, i + window)}
        out[d, len(own), len(gone), brute.sha(" ".join(w for i, w in enumerate(own) if i not in gone))] += 1
    return out


@pytest.mark.parametrize("gathered, compared", [(24 << 20, 16 << 20), (600, 200)])
def test_passages_of_rows_without_or_with_shared_ids(spark, monkeypatch, gathered, compared):
    monkeypatch.setattr(substring_dedup, "GATHERED", gathered)
    monkeypatch.setattr(substring_dedup, "COMPARED", compared)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(30)]
    docs = []
    for d in range(90):
        own = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 60))]
        if d % 2:
            own[rng.randrange(len(own) + 1) : 0] = passage[rng.randrange(0, 10) :]
        docs.append(((None, d, d % 5)[d % 3], " ".join(own)))
    docs += [docs[3], docs[3], docs[5], (None, None), (7, None)]
    found = substring_dedup.without_repeats(docs_of(spark, docs)).collect()
    wanted = brute_passages(docs)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in found) == wanted


# -- lines and near duplicates of rows without or with shared ids --------------------------


def test_lines_of_rows_without_or_with_shared_ids(spark):
    rng = random.Random(6)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 14))] for _ in range(50)]
    docs = [(None, "alpha\nbeta"), (None, "beta\ngamma"), (None, None), (7, None), (7, "delta\nbeta"), (7, "beta\ndelta")]
    for d in range(90):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            own = list(rng.choice(base))
            if rng.randrange(2):
                own[rng.randrange(len(own))] = f"w{rng.randrange(40)}"
            lines.append(" ".join(own))
        docs.append(((None, d, d % 5)[d % 3], "\n".join(lines)))
    docs += [docs[6], docs[6], docs[8]]
    table = docs_of(spark, docs)
    named = {(r[0], r[1]): ((r[0] is not None, r[0] or 0), r[2]) for r in table.select("doc_id", "text", F.xxhash64("text")).collect() if r[1] is not None}
    rows = sorted(named, key=named.get)
    wanted = brute_lines(list(enumerate(t for _, t in rows)))
    kept = {row: wanted[i] for i, row in enumerate(rows)}
    found = Counter((r["doc_id"], r["text"]) for r in line_dedup.without_repeated_lines(table).collect())
    assert found == Counter((d, t if t is None else kept[d, t]) for d, t in docs)
    assert any("gamma" in (t or "") for _, t in found)


def test_one_of_each_of_rows_without_or_with_shared_ids(spark):
    texts = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abcde"}
    near = lambda name: texts[name] + " tail"
    docs = [(1, texts["a"]), (1, texts["b"]), (1, near("b")), (2, near("a")), (None, near("a")), (None, texts["c"]), (None, near("c")), (None, texts["d"])]
    docs += [(3, texts["e"]), (3, texts["e"]), (4, ""), (4, " "), (None, ""), (None, " ")]
    kept = Counter((r["doc_id"], (r["text"].split() or [r["text"]])[0]) for r in near_dedup.one_of_each(docs_of(spark, docs)).collect())
    assert kept == Counter([(1, "a0"), (1, "b0"), (None, "c0"), (None, "d0"), (3, "e0"), (4, ""), (4, " "), (None, ""), (None, " ")])
