"""Periodic runs of words: Lyndon arrays from suffix grouping under both orders, their roots extended into runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.llm.common import mix64, slices

#: Bytes of text looked at together; a longer text is looked at alone.
PIECE = 4 << 20


def lyndon_array(codes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place of a sequence of whole numbers.

    Phase one of Baier's suffix sorter. Suffixes are grouped by a context, first
    their letter; groups are finished from the highest down. A finished group's
    context lies directly behind a place that is not yet finished; the context of
    that place takes it in, as often as it follows there, and the place moves
    into a group just above its old one: more copies higher, and those of an
    earlier, higher group above those of a later one. The context of a place is
    then its longest Lyndon prefix and ends where the next unfinished place is.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    groups = [g.tolist() for g in np.split(order, starts[1:])]
    first = np.empty(n, np.int64)
    first[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
    group = [*first.tolist(), -1]  # place n stands for both ends
    top = len(groups)
    lower, higher = list(range(-1, top - 1)), list(range(1, top + 1))
    after, before = [*range(1, n + 1), 0], [n, *range(n)]
    length = [0] * n
    g = top - 1
    lower.append(g)  # a bound above the highest group
    higher.append(-1)
    groups.append([])
    while g >= 0:
        taken: dict[int, list[int]] = {}
        for i in groups[g]:
            # only places that are still in the group, each chain of them from its first
            if group[i] != g:
                continue
            left = before[i]
            if group[left] == g:
                continue
            copies, right = 0, i
            while True:
                follows = after[right]
                length[right] = follows - right
                copies, right = copies + 1, follows
                if group[right] != g:
                    break
            after[left] = right
            before[right] = left
            if left < n:
                if copies in taken:
                    taken[copies].append(left)
                else:
                    taken[copies] = [left]
        groups[g] = None
        for copies in sorted(taken, reverse=True) if len(taken) > 1 else taken:
            made: dict[int, int] = {}
            for place in taken[copies]:
                old = group[place]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(groups)
                    above = higher[old]
                    lower.append(old)
                    higher.append(above)
                    higher[old] = lower[above] = new
                    groups.append([place])
                else:
                    groups[new].append(place)
                group[place] = new
        g = lower[g]
    return np.array(length, np.int64)


def extension(codes: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the right of the places ``a < b``, by comparisons of doubling length."""
    n, width = 0, 16
    while True:
        step = min(width, len(codes) - b - n)
        unlike = codes[a + n : a + n + step] != codes[b + n : b + n + step]
        if unlike.any():
            return n + int(unlike.argmax())
        n += step
        if b + n >= len(codes):
            return n
        width *= 2


def backward(codes: np.ndarray, a: int, b: int) -> int:
    """Longest common extension to the left, of what stands before the places ``a < b``."""
    return extension(codes[::-1], len(codes) - b, len(codes) - a)


def runs_of(codes: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs ``start, length, period`` of a sequence with ``length >= max(least, times * period)``, ``times`` 3 or more.

    The root of every run is a longest Lyndon word under the order of the letters
    or its reverse, at one place of the run's first period at least. From there the
    sequence goes on as it does a period later for all but two periods of the run;
    places without that are passed over, the others extended to both sides.
    """
    n, found, seen = len(codes), [], set()
    if n < least:
        return found
    for letters in (codes, codes.max() - codes):
        period = lyndon_array(letters)
        place = np.flatnonzero(np.arange(n) + 2 * period <= n)
        q = period[place]
        good = (codes[place] == codes[place + q]) & (codes[place + q - 1] == codes[place + 2 * q - 1]) & (codes[place + q // 2] == codes[place + q + q // 2])
        place, q = place[good], q[good]
        reach: dict[int, int] = {}
        for i, p in zip(place.tolist(), q.tolist()):
            if i + p <= reach.get(p, 0):
                continue  # inside the run of this period that was extended before
            right = i + p + extension(codes, i, i + p)
            start = i - backward(codes, i, i + p)
            reach[p] = right
            if right - start >= max(least, times * p) and (start, p) not in seen:
                seen.add((start, p))
                found.append((start, right - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(codes: np.ndarray, doc: np.ndarray, size: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Ranges of places that hold all runs, in the codes of documents one after another.

    A run repeats all its words but the last period's one period later, so a gram
    as long as that allows stands again one period after each of its first places.
    Ranges between neighbouring places of equal grams cover the run together, and
    there are ``(times - 1) * period - gram + 1`` of them at least: ranges too
    wide for the number of those they touch are left out. Grams are told apart by
    64-bit hashes; equal ones have equal hashes, and a chance meeting only makes a
    stretch longer.
    """
    gram = 1
    while 2 * gram * times <= least * (times - 1):
        gram *= 2
    if len(codes) < least:
        return []
    hashes, width = mix64(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while width < gram:
        hashes = mix64(hashes[:-width] * np.uint64(0xFF51AFD7ED558CCD) + hashes[width:])
        width *= 2
    own = doc[: len(hashes)]
    inside = np.flatnonzero(own == doc[gram - 1 :])
    hashes = hashes[inside] ^ mix64(own[inside].astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    twin = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    a, b = inside[order[twin]], inside[order[twin + 1]]
    near = (doc[a] == doc[b]) & ((b - a) * times <= size[doc[a]])
    a, b = a[near], b[near]
    first = np.cumsum(size) - size
    for _ in range(8):  # it only narrows: any number of rounds will do
        if not len(a):
            return []
        change = np.zeros(len(codes) + 1, np.int64)
        np.add.at(change, a, 1)
        np.add.at(change, b + gram, -1)
        covered = np.cumsum(change[:-1]) > 0
        starts = covered.copy()
        edge = np.zeros(len(codes), bool)
        edge[first[size > 0]] = True
        starts[1:] &= ~covered[:-1] | edge[1:]
        number = np.cumsum(starts) - 1
        among = np.bincount(number[a])
        fits = (b - a) * (times - 1) - gram + 1 <= among[number[a]]
        if fits.all():
            break
        a, b = a[fits], b[fits]
    begin = np.flatnonzero(starts)
    length = np.bincount(number[covered])
    return [(int(x), int(x + n)) for x, n in zip(begin, length) if n >= least]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, their ends, first and last place of each word and the number of its text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    letter = ~_BLANK[data]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    ends[:-1] &= ~letter[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]  # words end where their text does
    begins[cut] = letter[cut]
    ends[cut - 1] = letter[cut - 1]
    starts = np.flatnonzero(begins)
    return data, offsets, starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal only for equal words."""
    at = np.r_[0, np.cumsum(ends - starts)]
    letters = np.ascontiguousarray(data[~_BLANK[data]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _found(least: int, times: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            n = batch.num_rows
            data, offsets, starts, ends, doc = words_of(pc.fill_null(batch.column("text"), ""))
            size = np.bincount(doc, minlength=n)
            first = np.cumsum(size) - size
            codes = _codes(data, starts, ends)
            rows: list[tuple[int, int, int, int]] = []
            dropped = np.zeros(len(codes) + 1, np.int64)
            for a, b in stretches(codes, doc, size, least, times):
                for start, length, period in runs_of(codes[a:b], least, times):
                    rows.append((int(doc[a]), a + start - int(first[doc[a]]), length, period))
                    dropped[a + start + period] += 1
                    dropped[a + start + length] -= 1
            keep = np.cumsum(dropped[:-1]) == 0
            # bytes of the words kept, each but the first of a text after one blank
            stay = ~_BLANK[data]
            gone = np.flatnonzero(~keep)
            if len(gone):
                length = (ends - starts)[gone]
                stay[np.repeat(starts[gone] - (np.cumsum(length) - length), length) + np.arange(length.sum())] = False
            held = np.flatnonzero(keep)
            later = held[1:][doc[held[1:]] == doc[held[:-1]]]
            stay[starts[later] - 1] = True
            data = data.copy()
            data[starts[later] - 1] = 0x20
            at = np.r_[0, np.cumsum(stay)][offsets]
            text = pa.StringArray.from_buffers(n, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[stay])))
            rows.sort()
            per = np.bincount(np.array([r[0] for r in rows], np.int64), minlength=n)
            parts = [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]
            runs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), runs, text], ["id", "n_words", "runs", "text"])

    return find


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, n_words, runs, text``.

    Words are the stretches between white space. ``runs`` lists every longest
    stretch of words with a smallest period ``q`` that is ``least`` words and
    ``times * q`` (``times`` 3 or more) long, as ``start, length, period`` in
    words, by start, then period. ``text`` has the words, one blank between two,
    without those that stand in a run after its first period. Null and blank
    texts have no words, no runs and an empty text. Rows are independent:
    repeated rows repeat, an empty table gives no rows, other columns are not
    read.

    Nothing is shuffled. Words are compared by themselves. Lyndon arrays are made
    of the stretches that can hold a run, which take some 250 bytes a word; a text
    takes some 100 bytes a word in its task.
    """
    if times < 3 or least < times:
        raise ValueError("runs of three periods or more are looked for")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(_found(least, times), f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, text string")
