"""Periodic runs against every period tried, and packing by the genetic algorithm."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import ROWS

llm = pytest.importorskip("changefold.llm.queries")
from changefold.llm import genetic_packing as genetic, repetition  # noqa: E402
from changefold.llm.common import mix  # noqa: E402

# -- periodic runs -------------------------------------------------------------------------


def odd_words(rng):
    letters = rng.choice([1, 2, 2, 3, 5])
    wanted = rng.randint(0, 80)
    words: list[int] = []
    while len(words) < wanted:
        period = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        words += (period * rng.randint(1, 12))[: rng.randint(1, 70)]
    return words


def test_runs_against_every_period():
    rng = random.Random(11)
    met = 0
    for _ in range(3000):
        words, least = odd_words(rng), rng.choice([9, 12, 24])
        wanted = brute.periodic_runs(words, least)
        assert repetition.periodic_runs(words, least, 3) == wanted
        # The passages given to the automaton hold every run whole.
        codes = mix(np.array(words, np.uint64) + np.uint64(3)) if words else np.zeros(0, np.uint64)
        parts = repetition.passages(codes, np.array([0, len(words)]), (least + 5) // 3, least)
        found = [(a + start, n, q) for a, b in parts for start, n, q in repetition.periodic_runs(words[a:b], least, 3)]
        assert sorted(found, key=lambda run: (run[0], run[2])) == wanted
        met += len(wanted)
    assert met > 1000


def test_higher_exponents():
    rng = random.Random(12)
    for _ in range(500):
        words = odd_words(rng)
        assert repetition.periodic_runs(words, 24, 5) == brute.periodic_runs(words, 24, 5)
    with pytest.raises(ValueError, match="at least 3"):
        repetition.collapse_runs(None, min_exponent=2)


@pytest.mark.parametrize("words", [[0] * 20_000, [i % 7 for i in range(20_000)], [i % 6_000 for i in range(20_000)], [int(bin(i).count("1")) % 2 for i in range(20_000)]])
def test_long_passages(words):
    """One word over and over, short and long periods, and a sequence without any cube."""
    period = next((q for q in (1, 7, 6_000) if words == [words[i % q] for i in range(len(words))]), None)
    wanted = [(0, 20_000, period)] if period else []
    assert repetition.periodic_runs(words, 24, 3) == wanted


def collapsed(text, runs):
    words = brute.WORD.findall(text or "")
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    line = "spam and eggs "
    more = [(20, line * 9, None, None, 1), (21, f"x {line * 8}\n y\t{line * 9}", "en", "a", 1), (22, "la " * 23, "en", "a", 1), (23, "la\x0b" * 24, "en", "a", 1), (23, "la\x0b" * 24, "en", "a", 1),
            (24, " la " * 30, "en", "a", 1), (None, "tra la " * 12, None, None, None), (25, " ".join(f"w{i % 9000}" for i in range(30_000)), "en", "a", 1)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.select("doc_id", "text", "lang", "source", "n_chars").schema), allowMissingColumns=True)
    docs = docs.withColumns({name: F.lit("clash") for name in ("runs_", "start", "period", "__last")})
    found = repetition.collapse_runs(docs, id_columns=("doc_id", "start", "text"), text_column="text").collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter((r[0], r[1]) for r in [*ROWS, *more])
    for r in found:
        words = brute.WORD.findall(r["text"] or "")
        runs = [tuple(x) for x in r["runs"]]
        if len(words) < 5_000:
            assert runs == brute.periodic_runs(words)
        assert r["collapsed"] == collapsed(r["text"], runs) and r["start"] == "clash"
    by_id = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in found}
    assert by_id[20] == [(0, 27, 3)] and by_id[22] == [] and by_id[23] == [(0, 24, 1)] and by_id[24] == [(0, 30, 1)]
    assert by_id[25] == [(0, 30_000, 9000)] and by_id[None] in ([(0, 24, 2)], [])
    assert repetition.collapse_runs(no_docs).count() == 0
    with pytest.raises(ValueError, match="name columns"):
        repetition.collapse_runs(docs.withColumn("runs", F.lit(1)), id_columns=("runs",))


def test_run_query_against_every_period(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = llm.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for row in rows:
        words = brute.looped(row["doc_id"], brute.WORD.findall(docs[row["doc_id"]] or ""))
        if len(words) > 4_000:
            continue
        runs = brute.periodic_runs(words)
        best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None,) * 3)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row["collapsed_sha256"] == brute.sha(collapsed(" ".join(words), runs))


# -- genetic packing -----------------------------------------------------------------------


def fewest_by_trying(sizes, capacity):
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                place(i + 1, bins)
                bins[k] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_no_packing_beats_the_bound():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sizes = rng.integers(1, 11, rng.integers(1, 8)).astype(np.int32)
        assert math.ceil(sizes.sum() / 10) <= genetic.fewest(sizes, 10) <= fewest_by_trying(sizes.tolist(), 10)
    assert genetic.fewest(np.zeros(0, np.int32), 10) == 0


@pytest.mark.parametrize("low, high", [(1, 1023), (200, 500), (256, 700), (1, 1)])
def test_offspring_hold_every_piece_once(low, high):
    rng = np.random.default_rng(2)
    sizes = rng.integers(low, high + 1, 400).astype(np.int32)
    population = genetic._founded(sizes, 1024, 6, rng, False)
    population = population if len(population) > 1 else population * 2
    children = [genetic.crossed(population[0], population[-1], sizes, 1024, rng), genetic.mutated(population[-1], sizes, 1024, rng)]
    for bins in (*population, *children):
        fills = np.bincount(bins, sizes)
        assert len(bins) == 400 and bins.min() == 0 and fills.min() > 0 and fills.max() <= 1024


def test_crossover_injects_whole_sequences():
    sizes = np.array([6, 4, 5, 5, 7, 3, 2, 8], np.int32)
    poor, good = np.array([0, 1, 2, 3, 4, 5, 6, 7], np.int32), np.array([0, 0, 1, 1, 2, 2, 3, 3], np.int32)
    for seed in range(20):
        child = genetic.crossed(poor, good, sizes, 10, np.random.default_rng(seed))
        assert len(set(child.tolist())) < 8
        assert np.bincount(child, sizes).max() <= 10


def test_evolution_never_loses_and_mostly_gains():
    """Sizes of which three fill a sequence only in the right company: best fit alone wastes a part."""
    rng = np.random.default_rng(3)
    gained = 0
    for seed in range(5):
        sizes = rng.integers(200, 500, 300).astype(np.int32)
        chance = np.random.default_rng(seed)
        first = genetic._founded(sizes, 1024, 8, chance, True)
        last = genetic.evolved(sizes, first, 1024, 200, chance)
        counts = [int(bins.max()) + 1 for bins in (min(first, key=lambda bins: bins.max()), last[0])]
        assert genetic.fewest(sizes, 1024) <= counts[1] <= counts[0]
        gained += counts[0] - counts[1]
    assert gained > 0


def checked_pieces(rows, ids_of, capacity):
    """Pieces of every document in order and whole, sequences gapless; gives the number of sequences."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.frombuffer(r["ids"], "<u4").tolist()
        sequences[r["sequence_id"]].append((r["offset"], len(own)))
        documents[r["doc_id"]].append((r["piece"], r["start"], own, r["doc_tokens"]))
    for doc_id, pieces in documents.items():
        wanted = sorted(map(tuple, ids_of[doc_id]))
        # Documents that share an id each begin with piece 0.
        found, open_docs = [], []
        for piece, start, own, total in sorted(pieces, key=lambda p: p[0]):
            assert len(own) == capacity or piece == 0
            match = next((d for d in open_docs if len(d[0]) == start and d[1] == total and d[2] == piece), None) if piece else None
            if piece:
                match[0].extend(own)
                match[2] += 1
            else:
                assert start == 0
                open_docs.append([list(own), total, 1])
        found = sorted(tuple(d[0]) for d in open_docs)
        assert found == wanted
    assert set(documents) == set(ids_of)
    lengths = [brute.gapless(pieces) for pieces in sequences.values()]
    assert max(lengths) <= capacity
    return len(lengths)


def byte_ids(tokenizer, text, end=2):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_genetic_packing_of_odd_rows(spark, odd_docs, no_docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = llm.tokenizer_path(llm.BYTE_TOKENIZER)
    tokenizer = tokenizers.Tokenizer.from_file(path)
    ids = defaultdict(list)
    for r in ROWS:
        ids[r[0]].append(byte_ids(tokenizer, r[1]))
    docs = odd_docs.withColumns({name: F.lit("clash") for name in ("piece", "part", "number", "cell", "sequence_id", "ids", "island")})
    rows = genetic.pack(docs, path, cell_items=5).collect()
    n = checked_pieces(rows, ids, 1024)
    sizes = np.array([len(np.frombuffer(r["ids"], "<u4")) for r in rows], np.int32)
    assert n <= genetic.fewest(sizes, 1024) + 3  # one more for each of the tiny cells, at most
    assert genetic.pack(no_docs, path).count() == 0
    again = genetic.pack(docs, path, cell_items=5).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_many_cells_and_islands(spark):
    """Pieces of which best fit alone wastes space, in cells small enough that several meet again."""
    tokenizers = pytest.importorskip("tokenizers")
    path = llm.tokenizer_path(llm.BYTE_TOKENIZER)
    tokenizer = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(20, 49)))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    rows = genetic.pack(docs, path, capacity=100, cell_items=60, generations=30).collect()
    n = checked_pieces(rows, {i: [byte_ids(tokenizer, t)] for i, t in texts}, 100)
    sizes = np.array([len(np.frombuffer(r["ids"], "<u4")) for r in rows], np.int32)
    assert n <= 1.06 * genetic.fewest(sizes, 100)


def test_genetic_packing_query(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(llm.tokenizer_path(llm.BYTE_TOKENIZER))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = llm.QUERIES["op13_best_fit_packing"](spark, sf_dir).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append(r)
    assert set(documents) == set(texts)
    for doc_id, pieces in documents.items():
        ids = byte_ids(tokenizer, texts[doc_id])
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert brute.gapless([(r["start"], r["length"]) for r in pieces]) == len(ids)
        assert all(r["length"] == 1024 for r in pieces[1:])
        for r in pieces:
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == brute.crc(ids[r["start"] : r["start"] + r["length"]])
    assert max(map(brute.gapless, sequences.values())) <= 1024
    sizes = np.array([r["length"] for r in rows], np.int32)
    assert len(sequences) <= 1.01 * genetic.fewest(sizes, 1024) + 1


def test_byte_ids_equal_the_tokenizers():
    tokenizers = pytest.importorskip("tokenizers")
    from changefold.llm.byte_tokens import ByteEncoder

    path = llm.tokenizer_path(llm.BYTE_TOKENIZER)
    encoder, tokenizer = ByteEncoder(path), tokenizers.Tokenizer.from_file(path)
    rng = random.Random(5)
    letters = [chr(k) for k in range(32, 127)] + list("éßÿÀØɏ \t\n\r") * 6 + list(" \t\n\r\x0b\x85  　") * 3 + list("éßÿαΩпр东京カ한́﻿😀½²ªẞ")
    texts = ["".join(rng.choices(letters if i % 2 else letters[:155], k=rng.randint(0, 60))) + "<|endoftext|> x" * (i % 50 == 0) for i in range(3000)]
    texts += [" ".join(rng.choices(["it's", "x\n\ny", "a1b2", "Straße,", "\tq", "don't!!", "l'été", "12.5%", "we'll\nnot"], k=rng.randint(1, 9))) for _ in range(1500)]
    for text in texts:
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
