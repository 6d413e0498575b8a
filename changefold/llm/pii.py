"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust scores.

Four base kinds are found by pattern and checksum or range alone, leftmost first and without overlap
within a kind; a match that fails its test is dropped. Two more kinds are proposed by pattern and
kept only if confirmed: bank account numbers by their mod-97 checksum, and national numbers, which
carry no checksum, by words nearby. Every span has a score: that of its kind, plus a bonus if one of
the kind's words stands shortly before it.

Patterns are matched together with the gap before each match, so that match positions are sums of
lengths. They are written without backtracking over long runs: a match begins where a run of its
characters begins, or where the match before it ended. Capitals and digits that follow an account
number, such as a BIC or an amount, could be part of it; so its end is where the checksum holds.

Only SQL functions are used. Positions are code points, ends exclusive.

Defined results: a null text counts as empty and has no spans; a row without spans has an empty list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from changefold.llm.common import let, scan

#: Characters before a span in which its kind's words count.
NEARBY = 48


@dataclass(frozen=True)
class Kind:
    name: str
    gap: str  # what may stand between two matches
    match: str
    hint: str  # texts without this match of a simple pattern are passed over
    base: bool
    score: float
    words: str
    needs_words: bool = False


_SOME = r"(?s)(|.*?"
#: What an account number can go on with, and one character more if no word ends there. Only looked at:
#: where the number ends is found afterwards, and the next one may begin within.
_TAIL = r"(?=((?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))"
KINDS = (
    Kind("email", _SOME + r"[^A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.9,
         r"e-?mail|contact|write|reach|schreib|correo|courriel"),
    Kind("ip", _SOME + r"[^0-9])", r"[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", True, 0.6, r"\bip\b|host|server|address|login|adresse"),
    Kind("card", _SOME + r"[^0-9])", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", True, 0.8, r"card|visa|credit|pay|karte|carte|tarjeta"),
    Kind("phone", r"(?s)(.*?)", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True, 0.7, r"phone|call|tel|mobile|ruf|llame|appel"),
    Kind("iban", _SOME + r"[^A-Za-z0-9])", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}" + _TAIL, r"[A-Z][A-Z][0-9][0-9]", False, 0.9,
         r"iban|account|bank|konto|compte|cuenta"),
    Kind("national_id", _SOME + r"[^0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9][0-9]-[0-9]", False, 0.3,
         r"\bssn\b|social security|national id|taxpayer", True),
)
BASE = tuple(kind.name for kind in KINDS if kind.base)
#: Lengths of account numbers by country (ISO 13616).
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: Added to a span's score for a word of its kind nearby.
BONUS = 0.1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """14 to 19 digits whose Luhn sum ends in 0."""
    digits = F.transform(F.split(F.reverse(_digits(match)), ""), lambda d: F.when(d != "", d.cast("int")).otherwise(0))
    twice = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    length = F.char_length(_digits(match))
    return length.between(14, 19) & (F.aggregate(twice, F.lit(0), lambda a, b: a + b) % 10 == 0)


def _small_parts(match: Column) -> Column:
    """Every part at most 255, leading zeros or not."""

    def fits(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.char_length(plain) <= 3) & (F.concat(F.lit("0"), F.substring(plain, 1, 3)).cast("int") <= 255)

    return F.forall(F.split(match, r"\."), fits)


def _mod_97(match: Column) -> Column:
    """An account number's letters as numbers, first four characters last, leave 1 over 97."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    codes = F.transform(F.split(turned, ""), lambda c: F.ascii(c))

    def step(rest: Column, code: Column) -> Column:
        return F.when(code == 0, rest).when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.char_length(plain).between(15, 34) & (F.aggregate(codes, F.lit(0), step) == 1)


def _account_length(seen: Column) -> Column:
    """Characters of the account number that ``seen`` begins with; null if it begins with none.

    Every run of whole words from the beginning is tried. Of those that mod-97 confirms, that of the
    country's own length counts, else the longest.
    """
    lengths = F.create_map(*(F.lit(x) for n, codes in ACCOUNT_LENGTHS.items() for code in codes.split() for x in (code, n)))
    own = F.coalesce(F.try_element_at(lengths, F.substring(seen, 1, 2)), F.lit(0))

    def runs(words: Column) -> Column:
        return F.transform(words, lambda _, i: F.array_join(F.slice(words, F.lit(1), i + 1), " "))

    sound = F.filter(let(F.split(seen, " "), runs), lambda run: run.rlike("^[A-Z0-9 ]+$") & _mod_97(run))
    fits = lambda run: F.char_length(F.regexp_replace(run, " ", "")) == own
    best = F.array_max(F.transform(sound, lambda run: F.struct(fits(run).alias("own"), F.char_length(run).alias("length"))))
    return best["length"]


def _accounts(placed: Column) -> Column:
    """Confirmed account numbers, leftmost first and without overlap."""
    cut = lambda s: F.struct(s["start"].alias("start"), (s["start"] + _account_length(s["match"])).alias("stop"))
    found = F.filter(F.transform(placed, cut), lambda s: s["stop"].isNotNull())

    def apart(found: Column) -> Column:
        ends = scan(found, F.lit(0), lambda end, s: F.when(s["start"] < end, end).otherwise(s["stop"]), "int")
        return let(ends, lambda ends: F.filter(found, lambda s, i: (i == 0) | (s["start"] >= F.get(ends, i - 1))))

    return let(found, apart)


def _not_reserved(match: Column) -> Column:
    return ~match.rlike("^(000|666|9)|-00-|-0000$")


_TESTS = {
    "email": lambda match: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda match: F.char_length(_digits(match)).between(10, 15),
    "national_id": _not_reserved,
}


def _spans(kind: Kind, order: int, text: Column) -> Column:
    """Confirmed spans of one kind: start, order, kind, stop, score."""
    pattern = F.lit(rf"\G{kind.gap}({kind.match})")  # without \G a text's end would be searched from every place
    gaps = F.regexp_extract_all(text, pattern, F.lit(1))
    matches = F.regexp_extract_all(text, pattern, F.lit(2))
    ahead = F.regexp_extract_all(text, pattern, F.lit(3)) if kind.name == "iban" else None

    def place(matches: Column) -> Column:
        lengths = F.zip_with(gaps, matches, lambda gap, match: F.char_length(gap) + F.char_length(match))
        stops = scan(lengths, F.lit(0), lambda at, length: at + length, "int")
        found = lambda stop, match: F.struct((stop - F.char_length(match)).alias("start"), stop.alias("stop"), match.alias("match"))
        return F.zip_with(stops, matches, found)

    placed = let(matches, place)
    if ahead is None:
        confirmed = F.filter(placed, lambda s: _TESTS[kind.name](s["match"]))
    else:
        confirmed = _accounts(F.zip_with(placed, ahead, lambda s, more: s.withField("match", F.concat(s["match"], more))))

    def scored(span: Column) -> Column:
        before = F.greatest(span["start"] - NEARBY, F.lit(0))
        near = F.lower(F.substring(text, before + 1, span["start"] - before)).rlike(kind.words)
        return F.struct(
            span["start"].cast("long").alias("start"), F.lit(order).alias("place"), F.lit(kind.name).alias("kind"),
            span["stop"].cast("long").alias("stop"), F.round(F.lit(kind.score) + F.when(near, BONUS).otherwise(0.0), 2).alias("score"), near.alias("near"),
        )

    spans = F.transform(confirmed, scored)
    if kind.needs_words:
        spans = F.filter(spans, lambda s: s["near"])
    spans = F.transform(spans, lambda s: s.dropFields("near"))
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,stop:bigint,score:double>>")
    return F.when(text.rlike(kind.hint), spans).otherwise(none)


def find(docs: DataFrame, *, text_column: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with a column ``spans``: start, place, kind, stop and score, by start and then by kind as listed.

    A column of that name is replaced.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = F.array_sort(F.concat(*(_spans(kind, order, text) for order, kind in enumerate(kinds))))
    # Exploding a list of one keeps the optimiser from working the spans out again for each use of them.
    return docs.select(*(c for c in docs.columns if c != "spans"), F.explode(F.array(found)).alias("spans"))


def written(spans: Column, score: bool = False) -> Column:
    """kind:start:end of each span, comma-joined."""
    parts = lambda s: [s["kind"], s["start"].cast("string"), s["stop"].cast("string"), *([s["score"].cast("string")] if score else [])]
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *parts(s))), ",")


def masked(text: str, spans: str) -> Column:
    """The text with every span's characters replaced by its kind in angle brackets; of spans that overlap, the first counts."""
    begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, span: Column) -> Column:
        kept = F.substring(F.col(text), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        parts = F.concat(state["parts"], F.array(kept, F.concat(F.lit("<"), span["kind"], F.lit(">"))))
        return F.when(span["start"] < state["at"], state).otherwise(F.struct(span["stop"].alias("at"), parts.alias("parts")))

    rest = F.aggregate(F.col(spans), begun, add)
    tail = F.substring(F.col(text), (rest["at"] + 1).cast("int"), F.char_length(text))
    return F.concat(F.array_join(rest["parts"], ""), tail)
