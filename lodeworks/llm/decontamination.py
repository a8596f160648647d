"""Find benchmark items in documents, also with small edits.

Words are compared without punctuation and ASCII case. A document contains an item if some passage of it
is within ``max_edit`` of the item's length in word edits (insert, delete, replace).

Every item-sized window of a document is looked at. A window that shares too few runs
of three words with the benchmark cannot be near any item, as each edit destroys at most three of an
item's runs, and is passed over; no match is lost by that. For the others the
CGK random walk embeds the window's words: at each step it emits the word it stands on and steps on or
not by a random bit of step and word, so windows at small edit distance agree in most places. Sampled
places of the embedding form hash keys; ``walks`` x ``samples`` tables of ``places`` places each are
looked up. What collides is verified by exact edit distance against the whole surrounding passage.

Items of more than ``piece`` words are cut into even pieces of at most that many. Where an item stands with its share of
edits, at least one of its pieces stands with that share of its own words or less; each piece is looked up like an
item, and the whole item is verified around it. So recall does not fall with length.

Sizes fall into classes within ``ratio`` of each other; the first words of a piece, as many as its
class has, are embedded. Items are taken in blocks of about ``block``,
which bounds what is broadcast; each block is one pass over the documents.

Items under ``min_words`` words are searched for word by word, without edits: by hashed runs of their own
length. Each character of scripts without spaces is a word. Null items are not searched for, nor those
without words. A null or empty text contains nothing. Repeated documents and items are reported once for each pair of ids.
Rows with a null id are searched and reported under null. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeworks.llm.words import mix, slices

U64 = np.uint64
_RUN = 3
#: Windows embedded at a time.
LANE = 20_000


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least word edits between the item and any passage of the text, and the word behind the first such passage.

    Bit-parallel dynamic programming: a row of the edit table is held in two integers.
    """
    m = len(item)
    places: dict[int, int] = {}
    for k, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    for j, word in enumerate(text):
        equal = places.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, at = score, j + 1
    return best, at


def _runs(hashes: np.ndarray, size: int = _RUN) -> np.ndarray:
    """Hash of each run of ``size`` words; runs across two texts only make the filter let more pass."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    acc = hashes[: len(hashes) - size + 1].copy()
    for k in range(1, size):
        acc = mix(acc + hashes[k : len(hashes) - size + 1 + k])
    return acc


class Index:
    """Hash tables over the embedded items of one block."""

    def __init__(self, items: list[tuple[object, np.ndarray]], max_edit: float, ratio: float, walks: int, samples: int, places: int, min_words: int, piece: int = 60):
        self.items, self.max_edit, self.walks, self.samples, self.places = items, max_edit, walks, samples, places
        self.edits = np.asarray([int(max_edit * len(h)) if len(h) >= min_words else 0 for _, h in items], np.int64)
        self.words = [h.tolist() for _, h in items]
        self.runs = np.unique(np.concatenate([np.empty(0, np.uint64), *(_runs(h) for _, h in items if len(h) >= min_words)]))
        #: Short items by length: their hashed runs in order, and the items.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(h) for _, h in items if len(h) < min_words}:
            members = np.asarray([k for k, (_, h) in enumerate(items) if len(h) == size])
            keys = _runs(np.concatenate([items[k][1] for k in members]), size)[::size]
            order = np.argsort(keys, kind="stable")
            self.short[size] = keys[order], members[order]
        #: Pieces: their item, the place of their first word in it, and the edits they may hold.
        cuts = []
        for k, (_, h) in enumerate(items):
            bounds = np.linspace(0, len(h), -(-len(h) // piece) + 1).astype(int).tolist() if len(h) >= min_words else [0]
            cuts += [(k, begin, end) for begin, end in zip(bounds, bounds[1:], strict=False)]
        self.piece_item, self.piece_at = (np.asarray([c[x] for c in cuts], np.int64) for x in (0, 1))
        self.piece_edits = np.asarray([int(max_edit * (end - begin)) for _, begin, end in cuts], np.int64)
        #: Pieces by size and by how many runs of the benchmark any window near them holds.
        self.classes: dict[tuple[int, int], list[int]] = {}
        for k, (_, begin, end) in enumerate(cuts):
            length = end - begin
            size = min(max(int(ratio ** np.floor(np.log(length) / np.log(ratio) + 1e-9)), 1), length)
            need = max(0, size - _RUN + 1 - _RUN * int(self.piece_edits[k]))
            self.classes.setdefault((size, need), []).append(k)
        self.steps = 2 * max((size for size, _ in self.classes), default=0)
        self.tables = {}
        for (size, need), members in sorted(self.classes.items()):
            hashes = np.concatenate([items[cuts[k][0]][1][cuts[k][1] :][:size] for k in members])
            begin = np.arange(len(members)) * size
            for walk in range(walks):
                embedded = self.embed(hashes, begin, np.full(len(begin), size), walk)
                for t, keys in enumerate(self.keys(embedded, size, walk)):
                    order = np.argsort(keys, kind="stable")
                    self.tables[size, need, walk, t] = keys[order], np.asarray(members)[order]

    def embed(self, hashes: np.ndarray, begin: np.ndarray, length: np.ndarray, walk: int) -> np.ndarray:
        """(steps x windows): the word each walk stands on; 0 behind a window's end."""
        turns = np.random.default_rng(walk).integers(1, 2**63, self.steps, dtype=np.uint64) | U64(1)
        out = np.zeros((self.steps, len(begin)), np.uint64)
        at, last, stop = begin.copy(), len(hashes) - 1, begin + length
        for j in range(self.steps):
            inside = at < stop
            if not inside.any():
                break
            word = hashes[np.minimum(at, last)]
            word[~inside] = 0
            out[j] = word
            at += ((word * turns[j]) >> U64(63)).astype(np.int64)
        return out

    def keys(self, embedded: np.ndarray, size: int, walk: int) -> Iterator[np.ndarray]:
        """One key for each window and sample of places; a walk is about through after twice the size."""
        random = np.random.default_rng([size, walk])
        for _ in range(self.samples):
            key = np.zeros(embedded.shape[1], np.uint64)
            for j in random.choice(2 * size, min(self.places, 2 * size), replace=False):
                key = mix(key + embedded[j])
            yield key

    def find_short(self, hashes: np.ndarray, row: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """As ``find``, the first copy in each row of each short item."""
        for size, (keys, members) in self.short.items():
            runs = _runs(hashes, size)
            low, high = np.searchsorted(keys, runs, "left"), np.searchsorted(keys, runs, "right")
            begin = np.flatnonzero((high > low) & (row[: len(runs)] == row[size - 1 :][: len(runs)]))
            seen = set()
            for at in begin.tolist():
                for k in members[low[at] : high[at]].tolist():
                    r = int(row[at])
                    if (r, k) not in seen and hashes[at : at + size].tolist() == self.words[k]:
                        seen.add((r, k))
                        yield r, k, 0, at - int(first[r]), at + size - int(first[r])

    def find(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, edits, first word looked at, word behind the match) for the texts of a slice."""
        n = len(hashes)
        if not n or not self.items:
            return
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        yield from self.find_short(hashes, row, first)
        found = np.zeros(n, bool)
        runs = _runs(hashes)
        if len(runs) and len(self.runs):
            near = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
            found[: len(runs)] = self.runs[near] == runs
        shared = np.concatenate(([0], np.cumsum(found)))
        stop = first[1:][row]
        every = np.arange(n)
        pieces = []
        for (size, need), members in self.classes.items():
            slack = int(self.piece_edits[members].max())
            begin = every[stop - every >= size - slack]
            end = np.minimum(begin + size + slack, stop[begin])
            begin = begin[shared[end] - shared[begin] >= need]
            pieces += [(size, need, begin[a : a + LANE]) for a in range(0, len(begin), LANE)]
        met = []
        while pieces:
            take, total = [], 0
            while pieces and (not take or total + len(pieces[-1][2]) <= LANE):
                take.append(pieces.pop())
                total += len(take[-1][2])
            begin = np.concatenate([p[2] for p in take])
            length = np.minimum(stop[begin] - begin, np.concatenate([np.full(len(p[2]), p[0]) for p in take]))
            for walk in range(self.walks):
                embedded, at = self.embed(hashes, begin, length, walk), 0
                for size, need, mine in take:
                    here = embedded[:, at : at + len(mine)]
                    at += len(mine)
                    for t, keys in enumerate(self.keys(here, size, walk)):
                        table, item = self.tables[size, need, walk, t]
                        low, high = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
                        hit = np.flatnonzero(high > low)
                        if len(hit):
                            times = (high - low)[hit]
                            offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                            met.append(np.column_stack([np.repeat(mine[hit], times), item[np.repeat(low[hit], times) + offset]]))
        if not met:
            return
        pairs = np.unique(np.concatenate(met), axis=0)
        # About where the whole item starts; that may lie in front of the text.
        pairs = np.column_stack([row[pairs[:, 0]], self.piece_item[pairs[:, 1]], pairs[:, 0] - self.piece_at[pairs[:, 1]]])
        pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
        # Windows that lie within reach of each other are verified as one passage.
        reach = np.asarray([len(w) for w in self.words])[pairs[:, 1]] + self.edits[pairs[:, 1]]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1) | (pairs[1:, 2] - pairs[:-1, 2] > reach[1:])
        cut = np.append(np.flatnonzero(new), len(pairs))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            r, k = int(pairs[a, 0]), int(pairs[a, 1])
            allowed = int(self.edits[k])
            low = max(int(first[r]), int(pairs[a, 2]) - allowed)
            high = min(int(first[r + 1]), int(pairs[b - 1, 2]) + int(reach[a]) + allowed)
            item, text = self.words[k], hashes[low:high].tolist()
            if sum(map(set(text).__contains__, item)) < len(item) - allowed:
                continue  # each word that is missing takes an edit
            edits, at = best_match(item, text)
            if edits <= allowed:
                yield r, k, edits, low - int(first[r]), low + at - int(first[r])


def index_blocks(
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    max_edit: float = 0.2,
    min_words: int = 8,
    ratio: float = 1.15,
    walks: int = 8,
    samples: int = 6,
    places: int = 3,
    block: int = 20_000,
    piece: int = 60,
) -> list:
    """A broadcast Index for each block of about ``block`` items."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()
    blocks = max(1, -(-items.count() // block))
    out = []
    for part in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == part).orderBy("item", "text").toArrow()
        entries, names = [], mine.column("item").to_pylist()
        for at, stop, w in slices(mine.column("text").combine_chunks(), folded=True):
            hashes = w.hashes()
            entries += [(names[at + r], hashes[w.first[r] : w.first[r + 1]]) for r in range(stop - at) if w.first[r + 1] > w.first[r]]
        out.append(benchmark.sparkSession.sparkContext.broadcast(Index(entries, max_edit, ratio, walks, samples, places, min_words, piece)))
    return out


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", **options) -> DataFrame:
    """One row per document and item found: their ids, n_edits, the item's n_words, and end_word (the
    folded word behind the best passage)."""
    doc_kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    schema = f"id {doc_kind}, item {item_kind}, n_edits int, n_words int, end_word long"

    def search(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for at, stop, w in slices(batch.column("text"), folded=True):
                    found = list(index.find(w.hashes(), w.first))
                    if found:
                        r, k, edits, _, end = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("id").slice(at, stop - at).take(pa.array(r)),
                                pa.array([index.items[i][0] for i in k], item_type),
                                pa.array(edits, pa.int32()),
                                pa.array([len(index.words[i]) for i in k], pa.int32()),
                                pa.array(end, pa.int64()),
                            ],
                            ["id", "item", "n_edits", "n_words", "end_word"],
                        )

        return rows.mapInArrow(run, schema)

    found = reduce(DataFrame.unionByName, map(search, index_blocks(benchmark, text_col, item_col, **options)))
    best = found.groupBy("id", "item").agg(F.min(F.struct("n_edits", "n_words", "end_word")).alias("best"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", **options) -> DataFrame:
    """The input rows, all columns, in which no item is found; nothing is moved."""

    def without(df: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, stop, w in slices(batch.column(text_col), folded=True):
                    clean = np.ones(stop - at, bool)
                    clean[[r for r, *_ in shared.value.find(w.hashes(), w.first)]] = False
                    yield batch.slice(at, stop - at).filter(pa.array(clean))

        return df.mapInArrow(run, df.schema)

    return reduce(without, index_blocks(benchmark, text_col, item_col, **options), docs)
