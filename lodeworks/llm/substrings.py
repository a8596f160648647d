"""Remove passages that occur elsewhere, by suffix trees cut into groups by prefix.

A window is a run of ``window`` words of one text. Words covered by a window whose word sequence also
starts anywhere else are removed; windows are judged on the input.

How the suffixes are cut into groups: each window is filed under the smallest-hashed run of ``prefix``
words inside it, so equal windows are filed alike, and about two runs in ``window - prefix + 2`` serve
as a prefix. A prefix seen once has one leaf and is pruned. A prefix whose surroundings are the same
at every occurrence needs no tree: all its windows repeat. What is left is grouped by prefix, one
member for each distinct surroundings; in a group the suffixes are sorted, and neighbours that agree
for the full window are the leaves below a deep internal node, a maximal repeat. A prefix with more than
``group`` distinct surroundings is extended to the whole window instead, where grouping by
hash needs no tree and no group is ever held in memory.

Prefixes and surroundings are compared by 64-bit hashes, words inside a group by 32 bits each on top
of the 64 bits of their prefix.

A null or empty text has no words and keeps none. Rows are told apart by id and text: repeated rows
count as occurrences of each other, and so lose every full window; rows with a null id are treated like any other.
Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import U64, Words, mix, slices
from lodeworks.session import work_path

#: Entries gathered in a task before they are summed up and handed on.
FLUSH = 1_000_000
_LANE = 1 << 22


def filed(w: Words, hashes: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, place of the prefix, its hash) for each prefix of the slice.

    Windows between first and last, both included, are the ones filed under that prefix. Places are
    word indexes of the slice.
    """
    n, span = len(hashes), window - prefix + 1
    grams, first = w.grams(hashes, prefix)
    full = np.zeros(n, np.uint64)
    full[first] = grams
    count = n - window + 1
    if count <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    chosen = np.empty(count, np.int64)
    for at in range(0, count, _LANE):
        stop = min(count, at + _LANE)
        part = full[at : stop + span - 1]
        low = (part & ~U64(2 * _LANE - 1)) | np.arange(len(part), dtype=np.uint64)
        have = 1
        while have < span:  # minimum over 1, 2, 4, ... runs; the leftmost among equals
            step = min(have, span - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        chosen[at:stop] = at + (low[: stop - at] & U64(2 * _LANE - 1)).astype(np.int64)
    start = np.flatnonzero(w.row[:count] == w.row[window - 1 :])
    place = chosen[start]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (w.row[start[1:]] != w.row[start[:-1]])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(place)) - 1
    return start[begin], start[last], place[begin], full[place[begin]]


def _surroundings(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """Hash of all words from the first window's start to the last one's end, and of the prefix's place there."""
    power = np.full(len(hashes) + 1, 0xD6E8FEB86659FD93, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(hashes) + 1, pow(0xD6E8FEB86659FD93, -1, 2**64), np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:-1], out=sums[1:])
    text = (sums[last + window] - sums[first]) * back[first]
    return mix(mix(text) + (last - first).astype(np.uint64) * U64(64) + (place - first).astype(np.uint64))


def _prefix_counts(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """(fp, n, lo, hi): prefix, occurrences, least and greatest surroundings; summed up by task."""

    def summed(held: list) -> pa.RecordBatch:
        fp, around = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(fp, kind="stable")
        fp, around = fp[order], around[order].view(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
        n = np.diff(np.append(cut, len(fp)))
        low, high = np.minimum.reduceat(around, cut), np.maximum.reduceat(around, cut)
        return pa.RecordBatch.from_arrays([pa.array(fp[cut].view(np.int64)), pa.array(n), pa.array(low), pa.array(high)], ["fp", "n", "lo", "hi"])

    held, size = [], 0
    for batch in batches:
        for _, _, w in slices(batch.column("text")):
            hashes = w.hashes()
            first, last, place, fp = filed(w, hashes, window, prefix)
            if len(fp):
                held.append((fp, _surroundings(hashes, first, last, place, window)))
                size += len(fp)
            if size >= FLUSH:
                yield summed(held)
                held, size = [], 0
    if size:
        yield summed(held)


def _places(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """(id, th, pos, fp, around) for each prefix; pos counts words of the text."""
    for batch in batches:
        for at, stop, w in slices(batch.column("text")):
            hashes = w.hashes()
            first, last, place, fp = filed(w, hashes, window, prefix)
            if len(fp):
                row = w.row[place]
                around = _surroundings(hashes, first, last, place, window)
                part = batch.slice(at, stop - at).select(["id", "th"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array((place - w.first[row]).astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(around.view(np.int64))],
                    ["id", "th", "pos", "fp", "around"],
                )


def _contexts(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """The words around each wanted prefix, 4 bytes each, the prefix itself left out."""
    names = ["fp", "around", "n", "left", "windows", "words"]
    for batch in batches:
        wanted = batch.column("wanted")
        for at, stop, w in slices(batch.column("text")):
            hashes = w.hashes()
            first, last, place, _ = filed(w, hashes, window, prefix)
            short = (hashes & U64(0xFFFFFFFF)).astype(np.uint32)
            index = {int(p): k for k, p in enumerate(place)}
            out = []
            for r in range(at, stop):
                for want in wanted[r].as_py():
                    k = index[int(w.first[r - at]) + want["pos"]]
                    left = int(place[k] - first[k])
                    words = short[first[k] : place[k]].tobytes() + short[place[k] + prefix : last[k] + window].tobytes()
                    out.append((want["fp"], want["around"], want["n"], left, int(last[k] - first[k]) + 1, words))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _trees(batches: Iterator[pa.RecordBatch], rest: int) -> Iterator[pa.RecordBatch]:
    """Groups arrive sorted by prefix, a group perhaps cut by a batch's end."""

    def repeats(members: list) -> Iterator[tuple[int, int, int]]:
        suffixes = []
        for k, (_, _, n, left, windows, words) in enumerate(members):
            suffixes += [(left - j, words[4 * j : 4 * j + rest], k, j, n) for j in range(windows)]
        suffixes.sort()
        mask = [0] * len(members)
        for _, node in groupby(suffixes, key=lambda s: s[:2]):
            leaves = list(node)
            if sum(s[4] for s in leaves) > 1:
                for _, _, k, j, _ in leaves:
                    mask[k] |= 1 << j
        return ((m[0], m[1], bits) for m, bits in zip(members, mask, strict=True) if bits)

    def packed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ((), (), ()))], ["fp", "around", "mask"])

    members: list = []
    for batch in batches:
        out: list = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("fp", "around", "n", "left", "windows", "words")), strict=True):
            if members and members[0][0] != row[0]:
                out += repeats(members)
                members = []
            if not members or members[-1][1] != row[1]:  # a repeated row has told of it twice
                members.append(row)
        yield packed(out)
    if members:
        yield packed(list(repeats(members)))


def _whole_windows(batches: Iterator[pa.RecordBatch], rest: int) -> Iterator[pa.RecordBatch]:
    """One row for each window of each member, with the window's remaining words as bytes."""
    for batch in batches:
        for row in batch.to_pylist():
            rows = [(row["fp"], row["around"], row["n"], j, row["left"] - j, row["words"][4 * j : 4 * j + rest]) for j in range(row["windows"])]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["fp", "around", "n", "j", "ahead", "words"])


def _cut(batches: Iterator[pa.RecordBatch], window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("marks")
        for at, stop, w in slices(batch.column("text")):
            gone = np.zeros(len(w.start) + 1, np.int64)
            if any(marks[r].is_valid for r in range(at, stop)):
                first, last, place, _ = filed(w, w.hashes(), window, prefix)
                index = {int(p): k for k, p in enumerate(place)}
                for r in range(at, stop):
                    for mark in marks[r].as_py() or ():
                        k = index[int(w.first[r - at]) + mark["pos"]]
                        s, e, bits = int(first[k]), int(last[k]), mark["mask"]
                        if bits < 0:
                            gone[s] += 1
                            gone[e + window] -= 1
                        else:
                            for j in range(e - s + 1):
                                if bits >> j & 1:
                                    gone[s + j] += 1
                                    gone[s + j + window] -= 1
            stays = np.cumsum(gone[:-1]) == 0
            kept, removed = [], []
            for r, value in enumerate(batch.column("text").slice(at, stop - at)):
                words = (value.as_py() or "").encode().split()
                mine = stays[w.first[r] : w.first[r + 1]]
                kept.append(b" ".join(compress(words, mine)).decode())
                removed.append(int(len(mine) - mine.sum()))
            part = batch.slice(at, stop - at)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(w.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, prefix: int = 12, group: int = 8000) -> DataFrame:
    """One row per input row: its id, n_words, n_removed and ``kept``, the remaining words joined by one space."""
    if not 1 <= prefix <= window or window - prefix >= 62:
        raise ValueError("needs 1 <= prefix <= window < prefix + 62")
    spark, kind, rest = docs.sparkSession, dict(docs.dtypes)[id_col], 4 * (window - prefix)
    rows = docs.select(F.col(id_col).alias("id"), F.crc32(F.col(text_col).cast("binary")).alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.coalesce("th", F.lit(-1)))
    live_path, places_path = work_path(spark, "substring-prefixes"), work_path(spark, "substring-places")

    # Prefixes that occur more than once; `same` if their surroundings never differ.
    (
        rows.select("text")
        .mapInArrow(lambda b: _prefix_counts(b, window, prefix), "fp long, n long, lo long, hi long")
        .groupBy("fp")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where("n > 1")
        .select("fp", (F.col("lo") == F.col("hi")).alias("same"))
        .write.parquet(live_path)
    )
    live = spark.read.parquet(live_path)
    (
        rows.mapInArrow(lambda b: _places(b, window, prefix), f"id {kind}, th long, pos int, fp long, around long")
        .join(live, "fp")
        .write.parquet(places_path)
    )
    places = spark.read.parquet(places_path)

    # One member for each distinct surroundings of a prefix.
    mixed = places.where("NOT same")
    members = mixed.groupBy("fp", "around").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("id", "th", "pos"), F.struct("th", "pos", "id")).alias("at"))
    sizes = members.groupBy("fp").agg(F.count(F.lit(1)).alias("members"))
    wanted = (
        members.select("at.id", "at.th", F.struct("at.pos", "fp", "around", "n").alias("want"))
        .groupBy("id", "th")
        .agg(F.collect_list("want").alias("wanted"))  # at most one entry per prefix of the text
    )
    same_row = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["th"] == b["th"])
    contexts_path = work_path(spark, "substring-contexts")
    (
        rows.join(wanted, same_row(rows, wanted))
        .select(wanted["wanted"], rows["text"])
        .mapInArrow(lambda b: _contexts(b, window, prefix), "fp long, around long, n long, left int, windows int, words binary")
        .join(sizes, "fp")
        .write.parquet(contexts_path)
    )
    contexts = spark.read.parquet(contexts_path)
    light = (
        contexts.where(F.col("members") <= group)
        .drop("members")
        .repartition("fp")
        .sortWithinPartitions("fp", "around")
        .mapInArrow(lambda b: _trees(b, rest), "fp long, around long, mask long")
    )
    windows = contexts.where(F.col("members") > group).drop("members").mapInArrow(lambda b: _whole_windows(b, rest), "fp long, around long, n long, j int, ahead int, words binary")
    windows = windows.dropDuplicates(["fp", "around", "j"])  # a repeated row has told of it twice
    node = ["fp", "ahead", "words"]
    repeated = windows.groupBy(*node).agg(F.sum("n").alias("leaves")).where("leaves > 1").select(*node)
    heavy = windows.join(repeated, node).groupBy("fp", "around").agg(F.sum(F.expr("shiftleft(1L, j)")).alias("mask"))
    masks_path = work_path(spark, "substring-masks")
    light.unionByName(heavy).write.parquet(masks_path)
    masks = spark.read.parquet(masks_path)

    marks = (
        places.where("same")
        .select("id", "th", "pos", F.lit(-1).cast("long").alias("mask"))
        .unionByName(mixed.join(masks, ["fp", "around"]).select("id", "th", "pos", "mask"))
        .groupBy("id", "th")
        .agg(F.collect_set(F.struct("pos", "mask")).alias("marks"))
    )
    joined = rows.join(marks, same_row(rows, marks), "left").select(rows["id"], rows["text"], marks["marks"])
    return joined.mapInArrow(lambda b: _cut(b, window, prefix), f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
