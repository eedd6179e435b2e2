"""Periodic runs of words: Baier's grouping gives the Lyndon arrays under both orders, whose roots are extended into runs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from silverlode.llm.bpe import _steps

LEAST_LENGTH = 12
# A run of at least twelve words and two periods has the six words at its start a second time, one period on, and
# every word of it lies in six words that it has twice.
GRAM = LEAST_LENGTH // 2
NARROWINGS = 3
CHARS_PER_STEP = 1 << 20
MODULUS, BASE = (1 << 31) - 1, 1_000_003

RUN = T.StructType().add("start", "long", False).add("length", "long", False).add("period", "long", False)
RESULT = T.StructType().add("runs", T.ArrayType(RUN, False), False).add("collapsed", "string", False)


def with_runs(docs: DataFrame, text: str = "text", out: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``out``: ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what lies between blanks and the five signs from tab to CR, numbered from 0. A run is a stretch of at least
    twelve words and two of its smallest periods that no neighbouring word extends. ``collapsed`` is the text without
    the words that lie behind the first period of any run, joined by one space.

    No exchange: a text is one row's, its task works through it in time and memory proportional to it (a very long
    text is one piece of work), and short texts are worked on together. Null, empty and blank texts
    have no runs and an empty ``collapsed``; repeated rows are treated alike; two runs with the same start have different
    periods, so their order has no ties; an empty table gives no rows. Other columns are carried, but for one named
    ``out``, which is replaced.
    """
    columns = [c for c in docs.columns if c != out]
    schema = T.StructType([*[docs.schema[c] for c in columns], T.StructField(out, RESULT, False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for step in _steps(pc.fill_null(pc.utf8_length(column), 0).to_pylist(), CHARS_PER_STEP):
                found = _periodic([(t or "").encode().split() for t in column[step].to_pylist()])
                piece = batch[step]
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in columns], found], [*columns, out])

    return docs.mapInArrow(run, schema)


def _periodic(texts: list[list[bytes]]) -> pa.StructArray:
    lengths = np.array([len(words) for words in texts])
    first = np.append(0, lengths.cumsum())
    flat = list(chain.from_iterable(texts))
    number = dict(zip(dict.fromkeys(flat), count(1)))
    ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    start, length, period = found = runs_of(ids, np.repeat(np.arange(len(texts)), lengths))
    text = np.searchsorted(first, start, "right") - 1

    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = dropped.cumsum()[:-1] == 0
    affected = set(text.tolist())
    collapsed = [
        b" ".join([w for w, k in zip(words, kept[first[i] :].tolist() if i in affected else (), strict=False) if k])
        if i in affected
        else b" ".join(words)
        for i, words in enumerate(texts)
    ]
    values = [pa.array(x) for x in (start - first[text], length, period)]
    ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32))
    runs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(values, ["start", "length", "period"]))
    return pa.StructArray.from_arrays([runs, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def runs_of(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs among words given as numbers from 1, with the text that each is in."""
    word, place = _zones(ids, text)
    ends = word == 0
    apart = np.where(ends, -1 - np.arange(len(word)), word)  # separators differ from one another
    root, period = _roots(word, apart)
    begin, stop = _extended(apart, root, period)
    good = stop - begin >= np.maximum(LEAST_LENGTH, 2 * period)
    begin, stop, period, root = (x[good] for x in (begin, stop, period, root))
    begin, stop, period, root, new = _in_order(begin, stop, period, root)
    # Fingerprints never cut an extension short, but may make it too long: compare the words themselves.
    bounds = zip(begin[new].tolist(), stop[new].tolist(), period[new].tolist(), strict=True)
    right = np.array([np.array_equal(apart[b : e - p], apart[b + p : e]) for b, e, p in bounds], bool)
    if not right.all():
        for i in np.flatnonzero(~right[new.cumsum() - 1]):
            begin[i], stop[i] = _extended_plainly(apart, int(root[i]), int(period[i]))
        good = stop - begin >= np.maximum(LEAST_LENGTH, 2 * period)
        begin, stop, period, _, new = _in_order(*(x[good] for x in (begin, stop, period, root)))
    begin, stop, period = begin[new], stop[new], period[new]
    return place[begin], stop - begin, period


def _in_order(begin: np.ndarray, stop: np.ndarray, period: np.ndarray, root: np.ndarray) -> list[np.ndarray]:
    """By start, then period; the last array marks the first of each run."""
    order = np.lexsort((stop, period, begin))
    begin, stop, period, root = (x[order] for x in (begin, stop, period, root))
    new = np.append(True, (np.diff(begin) != 0) | (np.diff(period) != 0) | (np.diff(stop) != 0))[: len(order)]
    return [begin, stop, period, root, new]


def _zones(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of words that can hold runs, each between zeros, and the places of their words in ``ids``.

    Those are the words in six that their text has twice; then, among what is left in one piece, again.
    """
    place, piece = np.arange(len(ids)), text
    for _ in range(NARROWINGS):
        twice = _covered_twice(ids[place], piece)
        joined = np.append(False, (np.diff(place) == 1) & (np.diff(piece) == 0))[: len(place)]
        place, starts = place[twice], (~joined | ~np.append(False, twice[:-1]))[twice]
        piece = starts.cumsum()
        if not len(place):
            break
    size = np.bincount(piece, minlength=1)
    long_enough = size[piece] >= LEAST_LENGTH
    place, piece = place[long_enough], piece[long_enough]
    starts = np.append(True, np.diff(piece) != 0)[: len(place)]
    at = np.arange(len(place)) + starts.cumsum()
    total = len(place) + int(starts.sum()) + 1
    word, where = np.zeros(total, np.int64), np.full(total, -1)
    word[at], where[at] = ids[place], place
    return word, where


def _covered_twice(ids: np.ndarray, piece: np.ndarray) -> np.ndarray:
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(len(ids), bool)
    with np.errstate(over="ignore"):
        mixed = _mixed(ids.astype(np.uint64))
        gram = _mixed(piece[:n].astype(np.uint64))
        for k in range(GRAM):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + mixed[k : n + k]
        gram = _mixed(gram)
    whole = piece[:n] == piece[GRAM - 1 :]
    at = np.flatnonzero(whole)
    grams = gram[at]
    ordered = np.sort(grams)
    again = at[np.isin(grams, ordered[1:][ordered[1:] == ordered[:-1]])]
    change = np.zeros(len(ids) + 1, np.int64)
    change[again] += 1
    change[again + GRAM] -= 1
    return change.cumsum()[:-1] > 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _roots(word: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and length of the longest Lyndon words under the order of numbers and its reverse.

    Zeros come first under both, so none reaches beyond its stretch. Left out are those whose neighbouring
    word on either side does not go on with their period: they cannot be extended at all.
    """
    both = []
    for ordered in (word, np.where(word > 0, word.max(initial=0) + 1 - word, 0)):
        size = lyndon_lengths(ordered)
        at = np.flatnonzero((word > 0) & (np.arange(len(word)) + size < len(word)))
        both.append((at, size[at]))
    at, size = (np.concatenate(x) for x in zip(*both, strict=True))
    goes_on = (apart[at] == apart[at + size]) | (apart[at - 1] == apart[at + size - 1])
    return at[goes_on], size[goes_on]


def lyndon_lengths(word: np.ndarray) -> np.ndarray:
    """For each place of ``word`` (integers) the length of the longest Lyndon word that starts there.

    The first phase of Baier's suffix sorting. Places are grouped by a context, at first their own word, and
    groups are taken from the largest down. All places of the group taken, whose contexts are final, go to the
    place before them whose context they follow: k of them in a row make its context longer by k times
    their own, and those that grew alike leave their group for a new one just above it, more repeats higher.
    When all groups are taken, the context of a place is its Lyndon word. Linear but for sorting single words.
    """
    n = len(word)
    names, first = np.unique(word, return_inverse=True)
    group = [*first.tolist(), -1, -2]  # behind the end, and (at -1) before the start: in no group
    length = [1] * n
    owner = list(range(-1, n))  # of a place: the one not yet taken whose context ends there
    members: list[list[int]] = [[] for _ in names]
    for place, g in enumerate(group[:n]):
        members[g].append(place)
    below = list(range(-1, len(names) - 1))
    above = list(range(1, len(names) + 1))
    taken = len(names) - 1
    while taken >= 0:
        grown: dict[tuple[int, int], list[int]] = {}
        for place in members[taken]:
            if group[place] == taken:
                own = owner[place]
                if group[own] != taken:
                    size = length[place]
                    stop = place + size
                    while group[stop] == taken:
                        stop += size
                    owner[stop] = own
                    if own >= 0:
                        length[own] = stop - own
                        key = (group[own], stop - place)
                        if key in grown:
                            grown[key].append(own)
                        else:
                            grown[key] = [own]
        members[taken] = []
        for key in sorted(grown, reverse=True) if len(grown) > 1 else grown:
            old, new, places = key[0], len(members), grown[key]
            members.append(places)
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
            for place in places:
                group[place] = new
        taken = below[taken]
    return np.array(length, np.int64)


def _extended(apart: np.ndarray, root: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the period of each root goes on to both sides, by fingerprints of stretches: begin and end."""
    n = len(apart)
    power = np.ones(n + 1, np.int64)
    filled = 1
    while filled <= n:  # twice as many powers each time
        more = min(filled, n + 1 - filled)
        power[filled : filled + more] = power[:more] * (int(power[filled - 1]) * BASE % MODULUS) % MODULUS
        filled += more
    value = np.append(0, (apart % MODULUS * power[:n] % MODULUS).cumsum() % MODULUS)

    def equal(at: np.ndarray, size: np.ndarray, p: np.ndarray) -> np.ndarray:
        here = (value[at + size] - value[at]) % MODULUS * power[p] % MODULUS
        return here == (value[at + size + p] - value[at + p]) % MODULUS

    right, left = np.zeros_like(root), np.zeros_like(root)
    for bit in reversed(range(n.bit_length())):
        size = 1 << bit
        fits = np.flatnonzero(root + right + size + period <= n)
        fits = fits[equal(root[fits] + right[fits], size, period[fits])]
        right[fits] += size
        fits = np.flatnonzero(root - left - size >= 0)
        fits = fits[equal(root[fits] - left[fits] - size, size, period[fits])]
        left[fits] += size
    return root - left, root + right + period


def _extended_plainly(apart: np.ndarray, root: int, period: int) -> tuple[int, int]:
    begin, stop = root, root + period
    while stop < len(apart) and apart[stop] == apart[stop - period]:
        stop += 1
    while begin > 0 and apart[begin - 1] == apart[begin + period - 1]:
        begin -= 1
    return begin, stop
