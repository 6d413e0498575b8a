"""The contracts in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text: str | None) -> list[str]:
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(words: list[str], size: int) -> set[tuple[str, ...]]:
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def edits(docs: list[tuple]) -> dict:
    """doc_id → (n_chars, sha of the edited text, edited text, next text)."""
    docs = sorted((d, t or "") for d, t in docs)
    out = {}
    for i, (doc, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc] = (len(text), sha(edited), edited, following)
    return out


def resemblance(a: str, b: str, size: int = 5) -> float:
    x, y = shingles(lowered(a), size), shingles(lowered(b), size)
    return len(x & y) / len(x | y) if x | y else 1.0


def components(docs: list[tuple], size: int = 2, percent: int = 80) -> dict:
    """doc_id → (size of the set, smallest doc_id reachable)."""
    sets = {d: shingles(lowered(t), size) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_shingle = defaultdict(list)
    for d, s in sorted(sets.items()):
        common = defaultdict(int)
        for one in s:
            for other in by_shingle[one]:
                common[other] += 1
            by_shingle[one].append(d)
        for other, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_repeats(docs: list[tuple], window: int = 13) -> dict:
    """doc_id → (words, removed, sha of what is kept)."""
    words = {d: WORD.findall(t or "") for d, t in docs}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, own in words.items():
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(own), len(gone), sha(" ".join(w for i, w in enumerate(own) if i not in gone)))
    return out


def top_k(vectors: list[tuple], k: int = 20, every: int = 20) -> set:
    rows = []
    for vec_id, vector in vectors:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            rows.append((vec_id, [math.floor(64 * float(x)) for x in vector]))
    out = set()
    for query, q in rows:
        if query % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in rows if i != query and len(v) == len(q))
            out |= {(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)}
    return out


def token_ids(tokenizer, text: str | None, end_id: int = 1) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]


def crc(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


BASE = ("email", "ip", "card", "phone")


def luhn(text: str) -> bool:
    digits = [int(c) for c in re.sub("[^0-9]", "", text)][::-1]
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits))
    return 14 <= len(digits) <= 19 and total % 10 == 0


def base_spans(text: str | None) -> list[tuple]:
    tests = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", luhn),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    found = []
    for order, (pattern, sound) in enumerate(tests):
        found += [(m.start(), order, BASE[order], m.end()) for m in re.finditer(pattern, text or "") if sound(m.group())]
    return sorted(found)


def written(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, _, kind, stop in spans)


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def gapless(pieces: list[tuple[int, int]]) -> int:
    """Length of pieces (begin, length) that follow each other from 0; fails at a gap or overlap."""
    reached = 0
    for begin, length in sorted(pieces):
        assert begin == reached and length > 0
        reached += length
    return reached


def one_edit(a: list[str], b: list[str]) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def hard_negatives(vectors, labels, every: int, percent: int = 80, k: int = 5) -> list[tuple]:
    """All pairs scored; rows are numbered from 0, every so-manieth is an anchor."""
    whole = [[math.floor(256 * x) for x in v] for v in vectors]
    out = []
    for a in range(0, len(whole), every):
        scores = [sum(x * y for x, y in zip(whole[a], v, strict=True)) for v in whole]
        order = sorted((i for i in range(len(whole)) if i != a), key=lambda i: (-scores[i], i))
        for p in [i for i in order if labels[i] == labels[a]][:k]:
            fit = [i for i in order if labels[i] != labels[a] and percent * scores[p] <= 100 * scores[i] <= 100 * scores[p]][:k]
            out += [(a, p, rank, n, scores[p], scores[n]) for rank, n in enumerate(fit, 1)]
    return sorted(out)


def periodic_runs(words: list, min_length: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, every period tried."""
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            length = j - i + q
            if j > i and length >= min_length and length >= exponent * q and _smallest_period(words[i - q : j]) == q:
                out.append((i - q, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda run: (run[0], run[2]))


def _smallest_period(words: list) -> int:
    borders = [0] * len(words)
    for k in range(1, len(words)):
        t = borders[k - 1]
        while t and words[k] != words[t]:
            t = borders[t - 1]
        borders[k] = t + (words[k] == words[t])
    return len(words) - borders[-1]


def looped(doc_id, words: list[str]) -> list[str]:
    """Words of a document as the contract of the run query changes them."""
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
