"""Near-duplicate documents: join on n-gram Jaccard similarity with Bayesian candidate pruning.

A document's shingles are its runs of ``size`` words (all its words as one, if fewer). Documents with
the same set of shingles are one class of copies and take part once. 128 MinHash values per class; 20
bands of 4 put classes into buckets. In a bucket every pair is a candidate; signatures are compared 16
values at a time, and a pair is dropped once the posterior probability that its similarity reaches
``similarity`` (uniform prior, binomial matches) falls under ``tolerance``. What is left is verified
exactly on the shingles. A pair is looked at only in the first band that it shares.

No bucket is held by one task: its classes fall into blocks, bounded by number and by shingles, and
each pair of blocks is a unit of work of its own. Units give one row per class, never rows of pairs: a
number of links and one link that keeps the unit's components together. Pairs that survive the pruning
travel as lists of neighbours inside their unit.

A pair of similarity 0.8 shares a bucket with probability 0.99997.

Documents without words (null, empty, blank) have no class but themselves. Copies and repeated rows
share a class. Rows with a null id take part, and a class of only such rows has a null id. Other input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeworks.llm.components import components, marked, stored
from lodeworks.llm.words import U64, mix, slices

VALUES, STEP, BANDS, ROWS = 128, 16, 20, 4
_FACTORS = np.random.default_rng(11).integers(1, 2**63, VALUES, dtype=np.uint64) * U64(2) + U64(1)
#: Bounds of a block: classes, and shingles of all of them.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 500_000
#: Pairs compared, and rows gathered, at a time.
LANE, GATHER = 100_000, 2048


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind, distinct shingle hashes sorted by row, index of each row's first)."""
    for at, stop, w in slices(texts):
        hashes = w.hashes()
        grams, first = w.grams(hashes, size)
        row = w.row[first]
        short = np.flatnonzero((w.counts > 0) & (w.counts < size))
        if len(short):
            alone = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                has = w.counts[short] > k
                alone[has] = mix(alone[has] * U64(31) + hashes[w.first[short[has]] + k])
            grams, row = np.concatenate([grams, alone]), np.concatenate([row, short])
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        grams, row = grams[new], row[new]
        yield at, stop, grams, np.searchsorted(row, np.arange(w.rows + 1))


def _digests(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """16 bytes for each set (all sets not empty)."""
    out = np.empty((len(begin), 2), np.uint64)
    out[:, 0] = np.add.reduceat(mix(grams + U64(0x51ED270B)), begin)
    out[:, 1] = np.bitwise_xor.reduceat(mix(grams ^ U64(0xA0761D6478BD642F)), begin)
    return out.view(np.uint8).reshape(len(begin), 16)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, stop, grams, first in shingle_sets(batch.column("text"), size):
            rows, n = stop - at, np.diff(first)
            full = np.flatnonzero(n > 0)
            nodes, signs = [None] * rows, [None] * rows
            if len(full):
                begin = first[:-1][full]
                signature = np.empty((len(full), VALUES), np.uint32)
                for k in range(VALUES):
                    signature[:, k] = np.minimum.reduceat(grams * _FACTORS[k], begin) >> U64(32)
                for r, node, sign in zip(full, _digests(grams, begin), signature, strict=True):
                    nodes[r], signs[r] = node.tobytes(), sign.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(at, rows), pa.array(nodes, pa.binary()), pa.array(n, pa.int64()), pa.array(signs, pa.binary())],
                ["id", "node", "n", "sign"],
            )


@lru_cache(maxsize=8)
def least_matches(similarity: float, tolerance: float) -> tuple[int, ...]:
    """By number of values compared (multiples of STEP): matches under which a pair is dropped.

    After m matches among n the similarity has a Beta(m + 1, n - m + 1) posterior, and it reaches t with
    the probability that a binomial of n + 1 draws with chance t is at most m.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


@lru_cache(maxsize=64)
def _triangle(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _pairs(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if right is None and len(left) <= 256:
        i, j = _triangle(len(left))
        yield left[i], left[j]
        return
    other = left if right is None else right
    step = max(1, LANE // max(1, len(other)))
    for a in range(0, len(left), step):
        mine = left[a : a + step]
        i, j = np.repeat(mine, len(other)), np.tile(other, len(mine))
        if right is None:
            i, j = i[i < j], j[i < j]
        yield i, j


def _survivors(sign: np.ndarray, band: np.ndarray, i: np.ndarray, j: np.ndarray, least: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    matches = np.zeros(len(i), np.int64)
    for k, needed in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (sign[i, part] == sign[j, part]).sum(axis=1)
        stay = matches >= needed
        i, j, matches = i[stay], j[stay], matches[stay]
    # The first band they share is the one that reports them.
    early = np.zeros(len(i), bool)
    for b in range(BANDS - 1):
        part = slice(b * ROWS, (b + 1) * ROWS)
        early |= (b < band[i]) & (sign[i, part] == sign[j, part]).all(axis=1)
    return i[~early], j[~early]


_UNIT = ["key", "bi", "bj"]


def _units(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[list[dict]]:
    """Rows of whole units, at least ``enough`` at a time; the input is sorted by unit."""
    held: list[dict] = []
    unit = None
    for batch in batches:
        for row in batch.to_pylist():
            here = (row["key"], row["bi"], row["bj"])
            if here != unit and len(held) >= enough:
                yield held
                held = []
            unit = here
            held.append(row)
    if held:
        yield held


def _spans(rows: list[dict]) -> Iterator[tuple[int, int]]:
    begin = 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or any(rows[k][c] != rows[begin][c] for c in _UNIT):
            yield begin, k
            begin = k


def _prune(batches: Iterator[pa.RecordBatch], least: tuple[int, ...], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for rows in _units(batches, GATHER):
        sign = np.frombuffer(b"".join(r["sign"] for r in rows), np.uint32).reshape(len(rows), VALUES)
        band = np.asarray([r["band"] for r in rows])
        block = np.asarray([r["block"] for r in rows])
        waiting: list = []
        kept: list = []

        def work() -> None:
            if waiting:
                i, j = (np.concatenate(x) for x in zip(*waiting, strict=True))
                kept.append(_survivors(sign, band, i, j, least))  # noqa: B023
                waiting.clear()

        size = 0
        for a, b in _spans(rows):
            mine, r = np.arange(a, b), rows[a]
            same = r["bi"] == r["bj"]
            for i, j in _pairs(mine if same else mine[block[a:b] == r["bi"]], None if same else mine[block[a:b] == r["bj"]]):
                waiting.append((i, j))
                size += len(i)
                if size >= LANE:
                    work()
                    size = 0
        work()
        near: dict[int, list[int]] = {}
        for i, j in kept:
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                near.setdefault(x, []).append(y)
                near.setdefault(y, [])
        out = [(rows[x]["key"], rows[x]["bi"], rows[x]["bj"], rows[x]["node"], rows[x]["rep"], x, near[x]) for x in sorted(near)]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), id_type, pa.int32(), pa.list_(pa.int32()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [*_UNIT, "node", "rep", "at", "near"])


def _with_node(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(node, text) of the texts that have words."""
    for batch in batches:
        texts = batch.column("text")
        for at, stop, grams, first in shingle_sets(texts, size):
            full = np.flatnonzero(np.diff(first) > 0)
            if len(full):
                nodes = [d.tobytes() for d in _digests(grams, first[:-1][full])]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), texts.slice(at, stop - at).take(pa.array(full))], ["node", "text"])


def _verify(batches: Iterator[pa.RecordBatch], size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for rows in _units(batches, 1):
        sets: dict[int, np.ndarray] = {}
        texts = pa.array([r["text"] for r in rows], pa.large_string())
        for at, stop, grams, first in shingle_sets(texts, size):
            full = np.flatnonzero(np.diff(first) > 0)
            if len(full):
                for r, digest in zip(full, _digests(grams, first[:-1][full]), strict=True):
                    row = rows[at + r]
                    if digest.tobytes() == row["node"]:  # an id may stand for several texts
                        sets[row["at"]] = grams[first[r] : first[r + 1]]
        node = {r["at"]: r["node"] for r in rows}
        links = dict.fromkeys(sets, 0)
        top = {a: a for a in sets}

        def root(x: int) -> int:
            while top[x] != x:  # noqa: B023
                top[x] = x = top[top[x]]  # noqa: B023
            return x

        done = set()
        for r in rows:
            a = r["at"]
            if a in done or a not in sets:
                continue
            done.add(a)
            for b in r["near"]:
                one, two = sets[a], sets[b]
                common = len(np.intersect1d(one, two, assume_unique=True))
                if common >= similarity * (len(one) + len(two) - common):
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((root(a), root(b)))
                    top[y] = x
        out = [(node[a], node[root(a)], n) for a, n in links.items() if n]
        if out:
            kinds = (pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["node", "mate", "links"])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    tolerance: float = 1e-4,
    block_classes: int = BLOCK_CLASSES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per input row: its id, ``class_id`` (the least id of its connected component), ``n_links``
    (different texts linked to its text) and ``n_copies`` (rows with its very shingles, itself included)."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = stored(rows.mapInArrow(lambda b: _sign(b, size), f"id {kind}, node binary, n long, sign binary"), "jaccard-signatures")
    some = signed.where("node IS NOT NULL")
    classes = stored(some.groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")), "jaccard-classes")

    parts = F.array(*(F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sign", 1 + 4 * ROWS * b, 4 * ROWS)).alias("key")) for b in range(BANDS)))
    filed = some.select("node", F.inline(parts))
    buckets = stored(filed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("key"), "jaccard-buckets")
    members = stored(filed.join(buckets, "key").distinct(), "jaccard-members")
    sizes = (
        members.join(classes.select("node", "n"), "node")
        .groupBy("key")
        .agg(F.ceil(F.greatest(F.count(F.lit(1)) / block_classes, F.sum("n") / block_shingles)).cast("int").alias("blocks"))
    )
    sizes = stored(sizes, "jaccard-sizes")
    # The signature of each class that is in a bucket, once.
    wanted = members.select("node").distinct()
    signs = some.select("node", "sign").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("sign").alias("sign"))
    placed = (
        members.join(sizes, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "band", "node", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))
    )
    known = stored(signs.join(classes.select("node", "rep"), "node"), "jaccard-wanted")
    least = least_matches(similarity, tolerance)
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    left = (
        placed.join(known, "node")
        .repartition(*_UNIT)
        .sortWithinPartitions(*_UNIT)
        .mapInArrow(lambda b: _prune(b, least, id_type), f"key long, bi int, bj int, node binary, rep {kind}, at int, near array<int>")
    )
    left = stored(left, "jaccard-candidates")

    # One text of each candidate class, met by the class and not by the id: many texts may have no id, or the same.
    texts = marked(rows, ["id"], left.select(F.col("rep").alias("id")), "wanted").where("wanted").select("text")
    texts = texts.mapInArrow(lambda b: _with_node(b, size), "node binary, text string").groupBy("node").agg(F.first("text").alias("text"))
    verified = (
        left.join(texts, "node")
        .select(*_UNIT, "node", "at", "near", "text")
        .repartition(*_UNIT)
        .sortWithinPartitions(*_UNIT)
        .mapInArrow(lambda b: _verify(b, size, similarity), "node binary, mate binary, links long")
    )
    verified = stored(verified, "jaccard-links")
    roots = components(verified.select(F.col("node").alias("a"), F.col("mate").alias("b")), "jaccard-components")
    named = roots.join(classes.select("node", "rep"), "node")
    least_id = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    linked = named.join(least_id, "root").select("node", "class_id").join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node")
    table = classes.join(linked, "node", "left").select("node", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), "copies")
    table = stored(table, "jaccard-table")
    result = signed.select("id", "node").join(table, "node", "left")
    return result.select(
        F.col("id").alias(id_col),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )
