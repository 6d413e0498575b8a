"""Repeated lines: a line goes if an equal or nearly equal line stands earlier, in this or another document.

Lines are equal by their characters, nearly equal if one edit makes their words equal: one word
changed, left out or put in, where the longer of the two has at least ``min_words`` words, so that an
edit is at most a fifth of it. Earlier is by doc_id, then by a hash of the text, which tells rows of one
doc_id apart, then line number; the three are one number, the line's place. Blank lines always stay.

Deletion neighbourhood: from each distinct line every variant with one word left out is named by a
hash. Lines of equal length that share the variant and its place differ in that word only; a line
equal to another's variant is one word shorter. In each group of equal names every line is compared
with the earliest only, so that a group costs its own size. The words of each such pair are compared.

Two lines one edit apart agree in the first or the last half of their words. So variants are made
only from lines that share such a half with another, and only in the other half: nothing is lost, and
most lines are done with after this. Hashes of variants are sums, without carry, of hashes of words
with their places, so that each variant costs the same however long its line is.

Only SQL functions are used. Defined results: a null text has no lines and stays null; a null doc_id
comes before all others; rows equal in doc_id (or in having none) and text are copies of one document,
whose lines at the same place are one and the same, while rows of differing texts are documents of
their own; words are what stands between single white space characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from changefold.llm.common import fresh, let, scan, staged

#: Fewest words of the longer of two near lines: one edit then leaves a similarity of 0.8 or more.
MIN_WORDS = 5
#: Numbers of documents, and lines of one text, that fit one 64-bit place.
ROWS, LINES = 1 << 38, 1 << 24
HALVES = ("first_half", "last_half", "first_less", "last_less")


def lines_of(text: str | Column) -> Column:
    return F.split(F.col(text) if isinstance(text, str) else text, "\n", -1)


def words_of(line: str) -> Column:
    return F.split(F.translate(F.col(line), "\t\x0b\f\r", "    "), " ", -1)


def with_row(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` and a number of every document, in the order in which lines are earlier.

    Where the ids are small numbers that no two rows share, they are the numbers. Otherwise rows are
    numbered by doc_id (null first) and text hash, so that only copies of one document share a number.
    """
    doc_id = F.col("doc_id").cast("long")
    told = docs.select(doc_id.alias("doc_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    ).first()
    if told["n"] == told["ids"] and (told["n"] == 0 or (told["least"] >= 0 and told["most"] < ROWS)):
        return docs.withColumn(row, doc_id)
    key = [doc_id.alias("of_id"), F.xxhash64("text").alias("of_text")]
    order = [F.col("of_id").asc_nulls_first(), F.col("of_text")]
    ranged = docs.select(*key).distinct().repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "lines-rows")
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect())
    before = {part: sum(n for earlier, n in counts if earlier < part) for part, _ in counts}
    start = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in before.items() for x in pair)), F.col("part").cast("long"))
    numbers = ranged.withColumn("number", start + F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1).alias("r")
    same = doc_id.eqNullSafe(F.col("r.of_id")) & (F.xxhash64("text") == F.col("r.of_text"))
    return docs.join(numbers, same).select(*docs.columns, F.col("r.number").alias(row))


def _half_names(line: Column, n: Column, min_words: int) -> list[Column]:
    """Names of a line's halves: first and last, for the line and for the line less one word; null for too short lines."""
    names = []
    for less, least in ((0, min_words - 1), (1, min_words)):
        length = n - less
        half = F.floor(length / 2).cast("int")
        ends = ((end, F.call_function("substring_index", line, F.lit(" "), side)) for end, side in ((0, half), (1, -half)))
        names += [F.when(n >= least, F.xxhash64(F.lit(end), length, words)) for end, words in ends]
    return [name.alias(half) for half, name in zip(HALVES, names, strict=True)]


def numbered(rows: DataFrame, *more: Column) -> DataFrame:
    """place of every line that is not blank, and two hashes of it."""
    lines = rows.select("row", F.posexplode(lines_of("text")).alias("line_no", "line"))
    lines = lines.withColumn("spaced", F.translate("line", "\t\x0b\f\r", "    ")).where("trim(spaced) <> ''")
    fits = F.when(F.col("line_no") < LINES, F.col("line_no")).otherwise(F.raise_error(F.lit("a text has too many lines")).cast("int"))
    place = F.col("row") * LINES + fits
    return lines.select(place.alias("place"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *more)


def distinct_lines(rows: DataFrame, min_words: int) -> DataFrame:
    """h1, h2, first (place), copies and halves of every distinct line. All are numbers, so that hashing does."""
    spaced = F.col("spaced")
    n = F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1
    lines = numbered(rows, *_half_names(spaced, n, min_words))
    return lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"), *(F.min(h).alias(h) for h in HALVES))


def sharing_halves(distinct: DataFrame) -> DataFrame:
    """first and shared (numbers of halves that another line has too) of the lines that have any."""
    halves = F.posexplode(F.array(*HALVES)).alias("half", "name")
    named = distinct.where(f"{HALVES[0]} IS NOT NULL").select("first", halves).where("name IS NOT NULL")
    shared = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    return named.join(shared, "name", "left_semi").groupBy("first").agg(F.collect_set("half").alias("shared"))


def running_xor(values: Column) -> Column:
    """Sum without carry of all values before each place."""
    xor = lambda a, b: a.bitwiseXOR(b)
    return let(values, lambda own: F.zip_with(scan(own, F.lit(0).cast("long"), xor, "bigint"), own, xor))


def variants(lines: DataFrame, min_words: int) -> DataFrame:
    """name, role and first of every variant needed; role 0: one word changed, 1: the line itself, 2: one word left out."""
    n = F.size("words")
    here = F.transform("words", lambda w, i: F.xxhash64(w, i))
    moved = F.transform("words", lambda w, i: F.xxhash64(w, i - 1))
    xor = lambda a, b: a.bitwiseXOR(b)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), xor)
    has = lambda half: F.array_contains("shared", half)

    def places(first: int, last: int, length: Column) -> Column:
        # What two lines share of their first words lies before the edit, of their last words after it.
        half = F.floor(length / 2).cast("int")
        # A line one word too short may be what another becomes, and is not changed itself.
        return lambda i: (n >= min_words) & ((has(first) & (i >= half)) | (has(last) & (i < n - half)))

    changed, left_out = places(0, 1, n), places(2, 3, n - 1)
    of_change = let(total(here), lambda all: F.transform(here, lambda h, i: F.when(changed(i), F.xxhash64(F.lit(0), n, i, xor(all, h)))))
    base = F.when(has(0) | has(1), F.xxhash64(F.lit(1), n, total(here)))
    turned = running_xor(F.zip_with(here, moved, xor))
    less = let(total(moved), lambda all: F.zip_with(turned, moved, lambda t, m: xor(xor(all, t), m)))
    of_less = F.transform(less, lambda x, i: F.when(left_out(i), F.xxhash64(F.lit(1), n - 1, x)))
    roles = [(0, of_change), (1, F.array(base)), (2, F.array_distinct(of_less))]

    def tagged(role: int, names: Column) -> Column:
        return F.transform(F.filter(names, lambda x: x.isNotNull()), lambda x: F.struct(x.alias("name"), F.lit(role).alias("role")))

    named = [tagged(role, names) for role, names in roles]
    return lines.select("first", F.explode(F.concat(*named)).alias("variant")).select("variant.name", "variant.role", "first")


def one_edit_apart(a: str, b: str) -> Column:
    """Whether two lists of words become equal by changing, leaving out or putting in one word."""
    shorter = F.when(F.size(a) <= F.size(b), F.col(a)).otherwise(F.col(b))
    longer = F.when(F.size(a) <= F.size(b), F.col(b)).otherwise(F.col(a))
    differ = F.zip_with(a, b, lambda x, y: F.coalesce(x != y, F.lit(True)))
    same = F.coalesce(F.nullif(F.array_position(differ, True), F.lit(0)) - 1, F.size(shorter)).cast("int")
    rest = lambda words, skip: F.slice(words, same + 1 + skip, F.size(words))
    return F.when(F.size(a) == F.size(b), rest(F.col(a), 1) == rest(F.col(b), 1)).otherwise(
        (F.size(longer) - F.size(shorter) == 1) & (rest(longer, 1) == rest(shorter, 0))
    )


def near_earlier(rows: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """first and witness (the earlier line) of the distinct lines that are one edit from an earlier one."""
    shared = sharing_halves(distinct)
    place = F.struct((F.col("first") % LINES).cast("int").alias("line_no"), "first", "shared")
    wanted = shared.groupBy(F.floor(F.col("first") / F.lit(LINES)).alias("row")).agg(F.collect_list(place).alias("wanted"))
    # Copies of one document share a number; the words of one are enough.
    texts = rows.join(wanted, "row").select(lines_of("text").alias("lines"), F.explode("wanted").alias("one"))
    texts = texts.select("one.*", F.get("lines", F.col("one.line_no")).alias("line")).select("first", "shared", words_of("line").alias("words"))
    lines = staged(texts, "lines-sharing")
    named = staged(variants(lines, min_words), "lines-variants")
    earliest = lambda role: F.min(F.when(F.col("role") == role, F.col("first")))
    groups = named.groupBy("name").agg(
        earliest(0).alias("of_change"), earliest(1).alias("of_line"), earliest(2).alias("of_less"),
        F.max("first").alias("latest"), F.min("first").alias("earliest"),
    ).where("earliest < latest")
    met = named.join(groups, "name")
    witness = F.when(F.col("role") == 0, F.col("of_change")).when(F.col("role") == 1, F.col("of_less")).otherwise(F.col("of_line"))
    pairs = met.select("first", witness.alias("witness")).where("witness < first").distinct()
    words = lines.select(F.col("first").alias("at"), "words")
    left = pairs.join(words.select(F.col("at").alias("first"), F.col("words").alias("a")), "first")
    both = left.join(words.select(F.col("at").alias("witness"), F.col("words").alias("b")), "witness")
    return both.where(one_edit_apart("a", "b")).groupBy("first").agg(F.min("witness").alias("witness"))


def removed_lines(rows: DataFrame, min_words: int) -> DataFrame:
    """row and removed (line numbers) of the documents that lose lines."""
    distinct = staged(distinct_lines(rows, min_words), "lines-distinct")
    near = near_earlier(rows, distinct, min_words)
    status = distinct.select("h1", "h2", "first", "copies").join(near, "first", "left")
    status = status.where("copies > 1 OR witness IS NOT NULL").select("h1", "h2", "first", F.col("witness").isNotNull().alias("near"))
    gone = numbered(rows).join(status, ["h1", "h2"]).where("near OR place <> first")
    line = F.collect_set((F.col("place") % LINES).cast("int")).alias("removed")
    return gone.groupBy(F.floor(F.col("place") / F.lit(LINES)).alias("row")).agg(line)


def without_repeated_lines(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its text less the repeated lines, and n_lines and n_removed (columns of these names are replaced)."""
    row, removed = (fresh(name, docs.columns) for name in ("row", "removed"))
    given = with_row(docs, row)
    rows = given.select(F.col(row).alias("row"), "text").where("text IS NOT NULL")
    gone = removed_lines(rows, min_words).select(F.col("row").alias(row), F.col("removed").alias(removed))
    joined = given.join(gone, row, "left")
    kept = F.filter(lines_of("text"), lambda line, i: ~F.array_contains(removed, i))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    counts = [F.coalesce(F.size(lines_of("text")), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed")]
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*columns, *counts)
