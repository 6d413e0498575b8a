"""Awkward rows, hot groups and empty tables, operator by operator."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS, LONG_TEXT, ROWS

llm = pytest.importorskip("changefold.llm.queries")
from changefold.llm import chat, components, fingerprints, line_dedup, mixing, near_dedup, packing, pii, quality, substring_dedup, topk  # noqa: E402


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", None) for i, t in texts], DOCUMENTS)


# -- fingerprints --------------------------------------------------------------------------


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    chained = fingerprints.with_next_text(odd_docs, ranges=3)
    rows = chained.select("doc_id", "text", "next_text", fingerprints.edited("text", "next_text").alias("edited")).collect()
    in_order = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in ROWS))
    following = Counter((a[1], a[2], b[2]) for a, b in zip(in_order, in_order[1:] + in_order[:1], strict=True))
    assert Counter((r["doc_id"] or 0, r["text"], r["next_text"]) for r in rows) == following
    for r in rows:
        half = len(r["text"]) // 2
        assert r["edited"] == r["text"][: len(r["text"]) - half] + r["next_text"][:half]
    prints = {r["text"]: r["f"] for r in fingerprints.compared(chained.select("text", F.col("text").alias("f")), ("f",), ()).collect()}
    assert prints[""] == prints[" \t\n "] == ""
    a, b = fingerprints.from_text(prints[LONG_TEXT]), fingerprints.from_text(prints[LONG_TEXT + " and a tail"])
    assert fingerprints.resemblance(a, b) > 0.95 and fingerprints.containment(a, b) > 0.95
    real = len(brute.shingles(brute.lowered(LONG_TEXT), 5))
    assert abs(fingerprints.distinct(a) / real - 1) < 0.25
    assert fingerprints.with_next_text(no_docs).count() == 0


def test_fingerprints_merge():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 5000, np.uint64) * np.uint64(2)) for _ in range(2))
    both = fingerprints.smallest(np.union1d(a, b))
    assert np.array_equal(fingerprints.merged(fingerprints.smallest(a), fingerprints.smallest(b)), both)
    assert np.array_equal(fingerprints.from_text(fingerprints.to_text(both)), both)
    assert fingerprints.resemblance(both[:0], both[:0]) == 1.0 and fingerprints.resemblance(both, both[:0]) == 0.0


# -- personal data -------------------------------------------------------------------------

SPANS = [
    "a" * 30_000, "1" * 30_000, "+" * 5_000 + "1" * 12, "1 2 " * 9_000, "a@" * 9_000, "x@y." * 9_000 + "z", "1." * 20_000, "+1" + "(" * 20_000,
    "a@b.c_d@e.f..g@h-i.j-", "1.2.3.4.5.6.7.8 256.1.1.1 000001.2.3.4 9.1.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
    "+49 (30) 123 4567-89 +1 555 +123456789012345678", "Σ+49301234567 é@é.é ü.a@b.co", "@.@ +", "5 5  5500005555555559", "€1.1.1.1€",
]


def test_personal_data_of_odd_texts(spark, odd_docs, no_docs):
    rows = docs_of(spark, enumerate(SPANS)).unionByName(odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    for row in pii.find(rows).collect():
        base = [s for s in row["spans"] if s["kind"] in pii.BASE]
        assert [(s["start"], s["place"], s["kind"], s["stop"]) for s in base] == brute.base_spans(row["text"])
    assert pii.find(odd_docs).columns.count("spans") == 1
    assert pii.find(no_docs).count() == 0


def test_added_kinds_are_confirmed(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE89 3704 0044 0532 0130 01.", "my ssn is 123-45-6789", "part 123-45-6789", "e-mail me: a@b.co"]
    found = pii.find(docs_of(spark, enumerate(texts))).select("doc_id", "text", "spans", pii.masked("text", "spans").alias("masked")).collect()
    kinds = {r["doc_id"]: [(s["kind"], s["score"]) for s in r["spans"]] for r in found}
    assert ("iban", 1.0) in kinds[0] and not any(k == "iban" for k, _ in kinds[1])
    assert kinds[2] == [("national_id", 0.4)] and kinds[3] == [] and kinds[4] == [("email", 1.0)]
    assert {r["doc_id"]: r["masked"] for r in found}[4] == "e-mail me: <email>"


# -- near duplicates -----------------------------------------------------------------------


def near(docs, **settings):
    return near_dedup.near_duplicates(docs, **settings).select("doc_id", "n_shingles", "component_id", "kept").collect()


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    found = near(odd_docs, words=2)
    wanted = brute.components([(r[0], r[1]) for r in ROWS if r[0] is not None])
    assert len(found) == len(ROWS)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == wanted[r["doc_id"]]
    assert near(no_docs) == []
    kept = near_dedup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 10]


def test_star_finds_the_text_that_others_derive_from(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(150):  # linked with their origin, seldom with each other
        own = list(words)
        for at in rng.sample(range(200), 9):
            own[at] = f"v{i}x{at}"
        texts.append((i, " ".join(own)))
    texts.append((999, " ".join(words)))
    texts += [(2000 + i, " ".join(words[:100] + [f"q{i}z{k}" for k in range(100)])) for i in range(40)]  # share much, linked with none
    texts += [(3000 + i, " ".join(f"c{i // 4 + k}" for k in range(60))) for i in range(40)]  # a chain
    wanted = brute.components(texts)
    assert wanted[149][1] == wanted[999][1] and len({c for _, c in wanted.values()}) > 40
    found = near(docs_of(spark, texts), words=2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted


def test_components(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5), (3000, 2999), (2999, 3000)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1100), 1000), 2999: 2999, 3000: 2999}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- chats ---------------------------------------------------------------------------------


def test_chats(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", None), (None, "")]
    rows = [(c, i, *t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)) for i, t in enumerate(talk[:n])]
    rows += [(6, 0, "user", "hi there"), (7, 0, "user", ""), (8, 0, "user", None), (None, None, None, None), (2, 0, "user", "hi")]
    rows += [(9, 2, "user", "b"), (9, 1, "user", "a"), (9, 2, "user", "a")]
    rows += [(10, i, "user", f"t{i}") for i in range(2000)] + [(11, i, "user", f"t{i}") for i in range(1999)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("turns", F.lit(1))
    found = {r["conv_id"]: r for r in chat.format_chats(table).collect()}
    assert set(found) == {2, 6, 7, 8, 9, 10, None}
    assert found[2]["n_turns"] == 4 and found[10]["n_turns"] == 2000
    assert found[9]["rendered"] == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in "aab")
    assert chat.format_chats(table.limit(0)).count() == 0


# -- mixing --------------------------------------------------------------------------------


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    sized, sources, pieces = mixing.mix(odd_docs, block=16)
    rows = mixing.taken(sized, sources, pieces).collect()
    assert len(rows) == len(ROWS)
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=8)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    drawn = mixing.mixed_documents(odd_docs, pieces)
    assert drawn.columns == odd_docs.columns
    words = drawn.select(F.sum(mixing.word_count("text"))).first()[0]
    assert words == sum(r["taken"] for r in rows)
    sized, sources, pieces = mixing.mix(no_docs)
    assert mixing.taken(sized, sources, pieces).count() == 0


def test_schedule_keeps_every_stretch_near_the_weights(spark):
    sizes = [("a", 90_000), ("b", 30_000), ("c", 60_000), (None, 900)]
    sized = spark.createDataFrame(sizes, "source string, size long")
    sources = mixing.targets(sized).cache()
    targets = {r["source"]: r["target"] for r in sources.collect()}
    assert sum(targets.values()) == pytest.approx(1.5 * 180_900)
    assert all(targets[s] <= 2 * n for s, n in sizes)
    slots = mixing.schedule(sources, 64).orderBy("slot", "source_no").collect()
    by_source = defaultdict(list)
    for r in slots:
        by_source[r["source_no"]].append(r["block_no"])
    assert all(sorted(b) == list(range(len(b))) for b in by_source.values())
    half = Counter(r["source_no"] for r in slots[: len(slots) // 2])
    for number, blocks in by_source.items():
        assert abs(half[number] - len(blocks) / 2) <= 4


def test_the_schedule_decides_the_order_of_the_mix(spark, monkeypatch):
    """Any stretch of the mixed rows has each source near its weight; another schedule gives other slots and another order."""
    docs = docs_of(spark, [(i, " ".join(f"w{i}x{k}" for k in range(100))) for i in range(300)])
    docs = docs.withColumn("source", F.element_at(F.array(*map(F.lit, "abc")), (F.col("doc_id") % 3 + 1).cast("int")))
    docs = docs.withColumns({"__hash": F.lit("h"), "__copy": F.lit("c"), "copy": F.lit("own"), "slot": F.lit("s")})

    def mixed():
        sized, sources, pieces = mixing.mix(docs, block=50)
        slots = {r["doc_id"]: (r["first_slot"], r["last_slot"]) for r in mixing.taken(sized, sources, pieces).collect()}
        return slots, mixing.mixed_documents(docs, pieces).collect()

    slots, rows = mixed()
    assert {tuple(r[c] for c in ("__hash", "__copy", "copy", "slot")) for r in rows} == {("h", "c", "own", "s")}
    words = [(r["source"], len(r["text"].split())) for r in rows]
    everything = sum(n for _, n in words)
    share = {s: sum(n for one, n in words if one == s) / everything for s in "abc"}
    for begin in range(0, len(words) - 60, 20):
        part = words[begin : begin + 60]
        for source in "abc":
            assert abs(sum(n for s, n in part if s == source) / sum(n for _, n in part) - share[source]) < 0.12
    monkeypatch.setattr(mixing, "GOLDEN", 0.0)
    other_slots, other_rows = mixed()
    assert other_slots != slots and [r["doc_id"] for r in other_rows] != [r["doc_id"] for r in rows]


# -- quality -------------------------------------------------------------------------------


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 0), (8, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    weights = quality.fit(odd_docs, labels)
    rows = quality.score(odd_docs, weights).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    blank = {round(r["score"], 9) for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(blank) == 1
    unlearnt = quality.fit(odd_docs, labels.limit(0))
    assert {r["score"] for r in quality.score(odd_docs, unlearnt).collect()} == {0.5}
    assert quality.score(no_docs, weights).count() == 0


def test_quality_learns_from_the_rows_not_held_out(spark):
    rows = [(i, ("good calm words here" if i % 3 else "BUY NOW!! WIN!!") + f" t{i}", int(i % 3 > 0)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    right = spark.createDataFrame([(i, q if not brute.held_out(i) else 1 - q) for i, _, q in rows], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, right)).collect()}
    assert all((scores[i] > 0.5) == (q == 1) for i, _, q in rows)


# -- lines ---------------------------------------------------------------------------------


def brute_lines(docs, min_words=line_dedup.MIN_WORDS):
    first, kept = {}, defaultdict(list)
    for d, text in sorted(docs):
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r\v\f"):
                first.setdefault(line, (d, n))
    words = {line: line.translate({9: 32, 11: 32, 12: 32, 13: 32}).split(" ") for line in first}
    gone = set()
    lines = sorted(first, key=first.get)
    for i, line in enumerate(lines):
        if any(
            max(len(words[e]), len(words[line])) >= min_words and abs(len(words[e]) - len(words[line])) <= 1 and brute.one_edit(words[e], words[line]) for e in lines[:i]
        ):
            gone.add(line)
    for d, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            if not line.strip(" \t\r\v\f") or (first[line] == (d, n) and line not in gone):
                kept[d].append(line)
    return {d: "\n".join(kept[d]) for d, _ in docs}


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 14))] for _ in range(60)]
    docs = []
    for d in range(80):
        lines = []
        for _ in range(rng.randrange(0, 7)):
            own = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(own) + 1), rng.randrange(3)
                if kind == 0:
                    own.insert(at, f"w{rng.randrange(40)}")
                elif own and at < len(own):
                    own[at : at + 1] = [f"w{rng.randrange(40)}"] if kind == 1 else []
            lines.append(rng.choice([" ", " ", "\t"]).join(own))
        docs.append((d, "\n".join(lines)))
    found = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(docs_of(spark, docs)).collect()}
    assert found == brute_lines(docs)


def test_line_dedup_of_odd_rows(spark, odd_docs, no_docs):
    rows = line_dedup.without_repeated_lines(odd_docs).collect()
    assert len(rows) == len(ROWS)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert by_id[3][0]["text"] is None and by_id[4][0]["text"] == "" and by_id[5][0]["text"] == " \t\n "
    assert by_id[8][0]["n_removed"] == 0 and [r["n_removed"] for r in by_id[9]] == [1, 1]
    assert by_id[2][0]["n_removed"] == 0 and by_id[10][0]["text"] == LONG_TEXT
    assert line_dedup.without_repeated_lines(no_docs).count() == 0


def test_short_lines_and_clashing_names(spark):
    """A fifth of the longer line may differ: lines of five words or more, or four against five; columns keep any name."""
    pairs = ["Subscribe to our newsletter for free today", "Subscribe to our newsletter for free now", "one two three four five six seven eight", "one two three four five six seven",
             "aa bb cc dd", "aa bb cc dd ee", "k l m n", "k l m x", "yes", "no"]
    docs = docs_of(spark, enumerate(pairs)).withColumns({c: F.lit("kept") for c in ("__doc", "__hash", "__removed", "row", "removed", "Row_", "first")})
    rows = sorted(line_dedup.without_repeated_lines(docs).collect())
    assert [r["doc_id"] for r in rows if r["n_removed"]] == [1, 3, 5]
    assert {r[c] for r in rows for c in ("__doc", "__hash", "__removed", "row", "removed", "Row_", "first")} == {"kept"}


def test_running_sums_over_long_lines(spark):
    values = list(range(1, 1000))
    found = spark.createDataFrame([(values,), ([],), ([7],)], "v array<long>").select(line_dedup.running_xor(F.col("v")).alias("x")).collect()
    sums = [0]
    for v in values[:-1]:
        sums.append(sums[-1] ^ v)
    assert [r["x"] for r in found] == [sums, [], [0]]


# -- passages ------------------------------------------------------------------------------


@pytest.mark.parametrize("gathered, compared", [(24 << 20, 16 << 20), (600, 200)])
def test_passages_against_all_windows(spark, monkeypatch, gathered, compared):
    monkeypatch.setattr(substring_dedup, "GATHERED", gathered)
    monkeypatch.setattr(substring_dedup, "COMPARED", compared)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for d in range(60):
        own = [f"w{rng.randrange(3)}" for _ in range(rng.randrange(0, 60))]
        if d % 2:
            cut = rng.randrange(0, 20)
            own[rng.randrange(len(own) + 1) : 0] = passage[cut : cut + rng.randrange(5, 40)]
        docs.append((d, "  ".join(own)))
    docs.append((70, docs[11][1]))
    found = substring_dedup.without_repeats(docs_of(spark, docs)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) for r in found} == brute.without_repeats(docs)


def test_passages_of_odd_rows(spark, odd_docs, no_docs):
    found = substring_dedup.without_repeats(odd_docs).collect()
    assert len(found) == len(ROWS)
    single = {r[0]: r[1] for r in ROWS if r[0] is not None}
    wanted = brute.without_repeats(list(single.items()))
    for r in found:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], brute.sha(r["kept_text"])) == wanted[r["doc_id"]]
    assert substring_dedup.without_repeats(no_docs).count() == 0


# -- top k ---------------------------------------------------------------------------------


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.5, -0.3, 0.0, 0.7, 2.0]) for _ in range(6)]) for i in range(300)]
    rows += [(300, None), (320, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (340, [math.nan] * 6), (360, [math.inf] * 6), (380, [1.0, 2.0]), (381, [2.0, 1.0]), (400, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("clash")).repartition(3)
    sound = topk.quantised(table)
    found = topk.top_k(sound, sound.where("vec_id % 20 = 0"), shard_rows=40, block_queries=4, sample_rows=200)
    assert {tuple(r) for r in found.collect()} == brute.top_k(rows)
    none = sound.limit(0)
    assert topk.top_k(none, none).count() == 0


# -- packing -------------------------------------------------------------------------------


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(llm.tokenizer_path())
    rows = packing.pack(odd_docs, llm.tokenizer_path()).collect()
    all_ids = {r[0]: brute.token_ids(tokenizer, r[1]) for r in ROWS}
    sequences, tokens = defaultdict(list), Counter()
    for r in rows:
        ids = all_ids[r["doc_id"]]
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert own == ids[r["start"] : r["start"] + len(own)] and r["doc_tokens"] == len(ids)
        sequences[r["sequence_id"]].append((r["offset"], len(own)))
        tokens[r["doc_id"]] += len(own)
    assert all(brute.gapless(p) <= 2048 for p in sequences.values())
    copies = Counter(r[0] for r in ROWS)
    assert tokens == {d: n * len(all_ids[d]) for d, n in copies.items()}
    assert packing.pack(no_docs, llm.tokenizer_path()).count() == 0


def test_packing_merges_leftovers_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 3)
    docs = docs_of(spark, [(i, "a few words " * (i % 7 + 1)) for i in range(200)]).repartition(8)
    rows = packing.pack(docs, llm.tokenizer_path(), capacity=64, open_windows=4).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], len(r["ids"]) // 4))
    lengths = [brute.gapless(p) for p in sequences.values()]
    assert max(lengths) == 64 and sum(n < 64 for n in lengths) <= 4


def test_ids_equal_the_tokenizers(spark):
    from changefold.llm.tokens import Encoder

    encoder = Encoder(llm.tokenizer_path())
    rng = random.Random(1)
    letters = "aAzZ09'’ .,!?-_|<>éÉßẞıİΣςσ東京́ \t\n\x1c ﬁ½²Ⅷ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(400)]
    plain = "aAzZ09'’ .,!?-_|<>éÉÀö  \t\n\x0b0ß"
    texts += ["".join(rng.choice(plain.replace("’", "")) for _ in range(rng.randrange(0, 60))) for _ in range(400)] + ["a\x01b"]
    texts += ["it's 'tis don't 'll'd", "x<|endoftext|>y", "<|ENDOFTEXT|>", "<|startoftext|><|endoftext|>", "", None]
    got = [np.frombuffer(encoder.encode(text or ""), "<u4").tolist() for text in texts]
    assert got == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
