"""Stretches of words that repeat with a period, found with a suffix automaton and link-cut access.

The automaton of a passage is built word by word; its suffix links form a tree in which the path from
the root to the state of a prefix holds all suffixes of that prefix. After each word that path is
accessed as in a link-cut tree: it becomes one segment, coloured by the word's number. The segments met
on the way were coloured by earlier words; the deepest state of one, of length n and colour j, says that
the n words up to j and the n words up to i are the same and do not come again in between. Where the
distance i - j is at most n these are squares; with the exponent asked for, j is the latest place for
which that can hold, so the distance is the smallest period, n the exact reach to the left, and the run
ends at i unless the next word keeps the period. So each run is met at its last word, exactly once.

Only passages where runs can be get an automaton. With ``gram`` words chosen so that a run has at
least two periods and gram - 1 more words, each gram of a run stands twice within the run; a passage is
a longest stretch covered by grams that are repeated in it. This leaves out no run, whatever the hashes
of the grams do; words are compared as they are.

Memory holds one Arrow batch and the automaton of one passage, whose arrays take some 80 bytes a word
beside a table for each state with more than one continuation. A text is never split, as a run may take
all of it.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; a text without
runs collapses to its words joined by one space; each row is judged by itself, so that repeated rows,
null ids and ties change nothing; an empty table gives an empty one.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from changefold.llm.common import _WORD_ROLE, find_words, map_arrow, mix, text_rounds

RUNS, COLLAPSED = "runs", "collapsed"
RUN_TYPE = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_automaton(symbols: list[int]) -> tuple[array, array, array]:
    """Longest length and suffix link of every state, and the state of every prefix. State 1 is the root, 0 none."""
    size = 2 * len(symbols) + 3
    length, link, one, goal = (array("i", bytes(4 * size)) for _ in range(4))
    more: dict[int, dict[int, int]] = {}  # continuations of a state beside its first
    prefix = array("i", bytes(4 * len(symbols)))
    last, states = 1, 2
    # Symbols are stored plus one, as 0 stands for none.
    for i, symbol in enumerate(symbols):
        symbol += 1
        new = states
        states += 1
        length[new] = i + 1
        state = last
        target = 0
        while state:
            if one[state] == symbol:
                target = goal[state]
                break
            if not one[state]:
                one[state], goal[state] = symbol, new
            elif state not in more:
                more[state] = {symbol: new}
            else:
                target = more[state].get(symbol, 0)
                if target:
                    break
                more[state][symbol] = new
            state = link[state]
        if not state:
            link[new] = 1
        elif length[target] == length[state] + 1:
            link[new] = target
        else:
            clone = states
            states += 1
            length[clone] = length[state] + 1
            one[clone], goal[clone], link[clone] = one[target], goal[target], link[target]
            if target in more:
                more[clone] = more[target].copy()
            while state:
                if one[state] == symbol:
                    if goal[state] != target:
                        break
                    goal[state] = clone
                else:
                    others = more.get(state)
                    if not others or others.get(symbol) != target:
                        break
                    others[symbol] = clone
                state = link[state]
            link[target] = link[new] = clone
        prefix[i] = last = new
    return length, link, prefix


def periodic_runs(symbols: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    length, parent, prefix = suffix_automaton(symbols)
    n = len(symbols)
    # Each segment is a splay tree by depth; ``parent`` of its top leads to the state above the segment.
    # The top holds the segment's colour: the number of the word that was last to end there, plus one.
    left, right, colour = (array("i", bytes(4 * len(length))) for _ in range(3))
    found = []
    for i in range(n):
        state = prefix[i]
        below = 0
        while state:
            up = parent[state]
            if up and (left[up] == state or right[up] == state):
                shade = 0
                while True:
                    above = parent[up]
                    top = not above or (left[above] != up and right[above] != up)
                    on_left = left[up] == state
                    if top:
                        shade = colour[up]
                        # state over up
                        if on_left:
                            inner = right[state]
                            left[up] = inner
                            right[state] = up
                        else:
                            inner = left[state]
                            right[up] = inner
                            left[state] = up
                        if inner:
                            parent[inner] = up
                        parent[up], parent[state] = state, above
                        break
                    over = parent[above]
                    last = not over or (left[over] != above and right[over] != above)
                    if last:
                        shade = colour[above]
                    up_on_left = left[above] == up
                    if on_left == up_on_left:  # in line: up over above, then state over up
                        if on_left:
                            a, b = right[up], right[state]
                            left[above], right[up] = a, above
                            left[up], right[state] = b, up
                        else:
                            a, b = left[up], left[state]
                            right[above], left[up] = a, above
                            right[up], left[state] = b, up
                        if a:
                            parent[a] = above
                        if b:
                            parent[b] = up
                        parent[above], parent[up] = up, state
                    else:  # bent: state between the two
                        a, b = left[state], right[state]
                        if on_left:
                            right[above], left[up] = a, b
                            left[state], right[state] = above, up
                            if a:
                                parent[a] = above
                            if b:
                                parent[b] = up
                        else:
                            right[up], left[above] = a, b
                            left[state], right[state] = up, above
                            if a:
                                parent[a] = up
                            if b:
                                parent[b] = above
                        parent[above] = parent[up] = state
                    parent[state] = over
                    if last:
                        break
                    if left[over] == above:
                        left[over] = state
                    else:
                        right[over] = state
                    up = over
                colour[state] = shade
                up = parent[state]
            shade = colour[state]
            if shade:
                deeper = right[state]
                if deeper:
                    colour[deeper] = shade
                period = i + 1 - shade
                whole = length[state] + period
                if whole >= min_length and whole >= min_exponent * period and (i + 1 == n or symbols[i + 1] != symbols[i + 1 - period]):
                    found.append((i + 1 - whole, whole, period))
            right[state] = below
            below = state
            state = up
        colour[below] = i + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeated(grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which grams stand more than once within their owner."""
    keys = grams ^ mix(owner.astype(np.uint64))
    order = np.argsort(keys)
    same = np.append(keys[order[1:]] == keys[order[:-1]], False)
    flags = np.zeros(len(keys), bool)
    flags[order] = same | np.append(False, same[:-1])
    return flags


def passages(codes: np.ndarray, first: np.ndarray, gram: int, min_length: int) -> list[tuple[int, int]]:
    """Word ranges that hold all runs, none across two texts."""
    if len(codes) < min_length:
        return []
    rolled = np.zeros(len(codes) - gram + 1, np.uint64)
    for k in range(gram):
        rolled += codes[k : k + len(rolled)] * _WORD_ROLE[k]
    rolled = mix(rolled)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.flatnonzero(text[: len(rolled)] == text[gram - 1 :])
    owner = text[place]
    while True:
        kept = _repeated(rolled[place], owner)
        place, owner = place[kept], owner[kept]
        if not len(place):
            return []
        cut = np.append(True, (np.diff(place) > gram) | (np.diff(owner) != 0))
        starts = place[cut]
        ends = place[np.append(cut[1:], True)] + gram
        if kept.all():
            return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= min_length]
        # Numbers of the passages from here on; short ones hold no run.
        owner = np.cumsum(cut) - 1
        long_enough = (ends - starts >= min_length)[owner]
        place, owner = place[long_enough], owner[long_enough]


def _runs_of_texts(ids: int, min_length: int, min_exponent: int):
    gram = (min_length + 5) // 3

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_rounds(batch.column(ids)):
                words = find_words(data, offsets)
                where = passages(words.hashes(), words.first, gram, min_length)
                texts = data.tobytes()
                of_text: dict[int, list[tuple[int, int, int]]] = {}
                for a, b in where:
                    own = texts[words.start[a] : words.end[b - 1]].split()
                    number: dict[bytes, int] = {}
                    symbols = [number.setdefault(word, len(number)) for word in own]
                    found = periodic_runs(symbols, min_length, min_exponent)
                    if found:
                        text = int(np.searchsorted(words.first, a, "right")) - 1
                        begin = a - int(words.first[text])
                        of_text.setdefault(text, []).extend((begin + s, n, q) for s, n, q in found)
                runs, collapsed = [], []
                for text, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    own = texts[a:b].split()
                    found = sorted(of_text.get(text, []), key=lambda run: (run[0], run[2]))
                    if found:
                        steps = np.zeros(len(own) + 1, np.int64)
                        for start, n, q in found:
                            steps[start + q] += 1
                            steps[start + n] -= 1
                        own = [own[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    collapsed.append(b" ".join(own))
                given = batch.slice(row, len(runs))
                yield pa.RecordBatch.from_arrays(
                    [*given.columns[:ids], pa.array(runs, _ARROW_RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    [*given.schema.names[:ids], RUNS, COLLAPSED],
                )

    return run


def collapse_runs(
    docs: DataFrame,
    *,
    id_columns: tuple[str, ...] = ("doc_id",),
    text_column: str = "text",
    min_length: int = 24,
    min_exponent: int = 3,
) -> DataFrame:
    """The id columns, ``runs`` and ``collapsed`` of every text.

    A run is a stretch of at least ``min_length`` words and ``min_exponent`` smallest periods that no
    neighbouring word extends; a word goes if a run contains it after the run's first period. Words are
    what white space (space, U+0009 to U+000D) separates, numbered from 0.
    """
    if min_exponent < 3 or min_length < 3 * min_exponent:
        raise ValueError("min_exponent must be at least 3 and min_length at least 3 * min_exponent")
    if {RUNS, COLLAPSED} & set(id_columns):
        raise ValueError(f"{RUNS} and {COLLAPSED} name columns of the result")
    given = docs.select(*id_columns, F.col(text_column))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField(RUNS, RUN_TYPE), T.StructField(COLLAPSED, T.StringType())])
    return map_arrow(given, _runs_of_texts(len(id_columns), min_length, min_exponent), schema)
