"""Periodic runs of words, by the dictionary of basic factors.

A run is a stretch of consecutive words of one text with smallest period q (words q apart are equal) and a
length of at least ``least`` words and ``times`` periods, that no neighbouring word extends.

The dictionary names the factors of 1, 2, 4, ... words, the factors of 2L words from pairs of names of L
words. Below, L is such a length. Where a factor of L words occurs next within a stretch of 2L words, at
a distance d of L/2 < d <= L, it proposes the period d; the places that follow one another with the same d
form the progressions. A stretch of m such places has m - 1 + L + d words of period d, and it ends on
both sides where the period does: one place more would be one more place with that distance. d is the
smallest period, as a smaller one would be the nearer occurrence. Each period belongs to one L, so no run is
proposed twice. With ``times`` of 3 or more every run is long enough to hold such places.

A factor that occurs once in its text has no successor, nor has a longer one around it: those places drop
out, so prose is done after a few lengths. Words are compared by 64-bit hashes, names of factors exactly.

A null or empty text has no words and no runs; its collapsed text is empty. Every row gives one row, repeated rows
and null ids too. Input columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodeworks.llm.words import U64, Words, mix, slices

_PART = 1 << 22
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def runs_of(hashes: np.ndarray, row: np.ndarray, end: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``row`` is the text of each word, ``end`` the index behind that text's last word.
    """
    found = []
    names = np.empty(len(hashes), np.int64)
    at = np.arange(len(hashes))
    keys = mix(hashes + mix(row.astype(np.uint64) + U64(1)))  # equal only within one text
    size = 1
    while len(at):
        order = np.argsort(keys, kind="stable")
        keys, place = keys[order], at[order]
        same = keys[1:] == keys[:-1]
        here, step = place[:-1][same], np.diff(place)[same]
        near = (2 * step > size) & (step <= size)
        here, step = here[near], step[near]
        if len(here):
            order = np.argsort(here)
            here, step = here[order], step[order]
            cut = np.flatnonzero(np.concatenate(([True], (np.diff(here) != 1) | (np.diff(step) != 0))))
            length = np.diff(np.append(cut, len(here))) - 1 + size + step[cut]
            good = length >= np.maximum(least, times * step[cut])
            found.append((here[cut][good], length[good], step[cut][good]))
        # Names of the places whose factor occurs again, then pairs of them.
        again = np.zeros(len(keys), bool)
        again[1:] |= same
        again[:-1] |= same
        names.fill(-1)
        names[place[again]] = np.cumsum(np.concatenate(([True], ~same)))[again]
        at = at[(names[at] >= 0) & (at + 2 * size <= end[at])]
        at = at[names[at + size] >= 0]
        keys = names[at].astype(np.uint64) << U64(32) | names[at + size].astype(np.uint64)
        size *= 2
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def joined(w: Words, keep: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by one space."""
    chosen = np.flatnonzero(keep)
    row = w.row[chosen]
    size = w.end[chosen] - w.start[chosen]
    size[:-1] += row[1:] == row[:-1]  # the space
    stop = np.cumsum(size)
    data = np.append(w.data, np.uint8(32))
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    at = 0
    while at < len(chosen):
        to = max(at + 1, int(np.searchsorted(stop, (stop[at - 1] if at else 0) + _PART)))
        base = int(stop[at - 1]) if at else 0
        begin = stop[at:to] - size[at:to]
        out[base : stop[to - 1]] = data[np.repeat(w.start[chosen[at:to]] - begin, size[at:to]) + np.arange(base, stop[to - 1])]
        at = to
    inner = np.flatnonzero(row[1:] == row[:-1])
    out[stop[inner] - 1] = 32
    offsets = np.concatenate(([0], stop))[np.searchsorted(row, np.arange(w.rows + 1))].astype(np.int64)
    return pa.LargeStringArray.from_buffers(w.rows, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _strongest(row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray, rows: int) -> pa.Array:
    """Each row's run of greatest length / period, ties to the smallest start, then period.

    Quotients of whole numbers below 2^26 differ as doubles wherever they differ.
    """
    order = np.lexsort((period, start, -(length / period), row))
    first = np.searchsorted(row[order], np.arange(rows + 1))
    has = np.diff(first) > 0
    pick = order[np.minimum(first[:-1], max(len(order) - 1, 0))] if len(order) else np.zeros(rows, np.int64)
    columns = [x[pick] if len(order) else pick for x in (start, length, period)]
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], fields=list(_RUN), mask=pa.array(~has))


def _scan(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, stop, w in slices(batch.column("text")):
            start, length, period = runs_of(w.hashes(), w.row, w.first[w.row + 1], least, times)
            gone = np.zeros(len(w.start) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            row = w.row[start]
            start = start - w.first[row]
            offsets = np.searchsorted(row, np.arange(w.rows + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(at, stop - at),
                    pa.array(w.counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), runs),
                    _strongest(row, start, length, period, w.rows),
                    joined(w, np.cumsum(gone[:-1]) == 0),
                ],
                ["id", "n_words", "runs", "strongest", "collapsed"],
            )


def find_runs(docs: DataFrame, least: int = 6, times: int = 4, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, runs, strongest, collapsed) for every row of docs.

    ``runs`` are structs (start, length, period) counted in words, by start, then period; ``strongest``
    the one of greatest length / period or null; ``collapsed`` the words that no run contains after its
    first period, joined by one space. ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("a run of fewer than three periods need not show in the dictionary")
    kind = docs.schema[id_column].dataType.simpleString()
    run = "struct<start: bigint, length: bigint, period: bigint>"
    schema = f"id {kind}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    chosen = docs.select(docs[id_column].alias("id"), docs[text].alias("text"))
    return chosen.mapInArrow(lambda batches: _scan(batches, least, times), schema).withColumnRenamed("id", id_column)
