"""Quality score by nearest-neighbour voting in a latent-semantic space.

Terms of a text, all from its whole length: trigrams of character classes with runs drawn together
(the look of the prose), and repetition terms (words equal to the word 1, 2 or 3 places before them,
words in repeated runs, repeated lines). Term counts are damped, weighted by inverse document
frequency and projected on the leading singular vectors of the labelled texts. Each text's cosine to
every labelled vector is computed in blocks; its nearest labelled texts vote with their similarity.

Fitting uses at most ``max_labelled`` labelled documents, taken in the order of a hash of their id, so
what is broadcast and what the driver holds is bounded: max_labelled x 2,749 counts while fitting and
(max_labelled + 2,749) x ``dimensions`` numbers afterwards. Scoring covers every row.

A null or empty text has no terms and scores the mean label, as does everything if nothing is
labelled (0.5 then). Rows with null ids are scored too. Ties among neighbours are all counted by their
similarity, ordered by label row. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import Words, slices

_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b"!?", b"|", b"%", b"#*", b"$&<>")
_N = len(_GROUPS) + 2  # other ASCII, beyond ASCII
_REPEATS = 5
TERMS = _N**3 + _REPEATS


def _groups() -> np.ndarray:
    table = np.full(256, _N - 2, np.int64)
    for k, members in enumerate(_GROUPS):
        table[list(members)] = k
    table[128:] = 0  # letters of other alphabets look like letters
    return table


_GROUP = _groups()


def terms(w: Words, offsets: np.ndarray) -> np.ndarray:
    """(texts x TERMS) damped counts per thousand."""
    rows = w.rows
    out = np.zeros((rows, TERMS), np.float32)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    look = _GROUP[w.data]
    # One symbol for each run of a class within a text.
    keep = np.ones(len(look), bool)
    keep[1:] = (look[1:] != look[:-1]) | (row[1:] != row[:-1])
    look, row = look[keep], row[keep]
    if len(look) > 2:
        code = (look[:-2] * _N + look[1:-1]) * _N + look[2:]
        inside = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][inside] * _N**3 + code[inside], minlength=rows * _N**3).reshape(rows, -1)
        out[:, : _N**3] = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    n = np.maximum(w.counts, 1)
    h = w.hashes()
    for k in (1, 2, 3):
        if len(h) > k:
            same = (h[k:] == h[:-k]) & (w.row[k:] == w.row[:-k])
            out[:, _N**3 + k - 1] = np.bincount(w.row[k:][same], minlength=rows) / n
    grams, first = w.grams(h, 4)
    keys = grams + w.row[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    out[:, _N**3 + 3] = np.bincount(w.row[first][times[back] > 1], minlength=rows) / n
    # Words of another kind: the share of distinct ones.
    _, at = np.unique(h + w.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)
    out[:, _N**3 + 4] = 1 - np.bincount(w.row[at], minlength=rows) / n
    return np.log1p(1000 * out)


def _term_batches(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    lengths = np.asarray([0 if t is None else len(t.encode()) for t in texts.to_pylist()])
    for at, stop, w in slices(texts):
        yield at, stop, terms(w, np.concatenate(([0], np.cumsum(lengths[at:stop]))))


class Model:
    """Labelled vectors with what turns terms into vectors."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, dimensions: int, neighbours: int, power: float):
        self.neighbours, self.power = neighbours, power
        self.mean = float(labels.mean()) if len(labels) else 0.5
        present = (x > 0).sum(axis=0)
        self.weight = (np.log((1 + len(x)) / (1 + present)) + 0.3).astype(np.float32)
        x = self._unit(x * self.weight)
        k = min(dimensions, *x.shape) if len(x) else 0
        # Leading right singular vectors by subspace iteration from a fixed start.
        basis = np.random.default_rng(7).standard_normal((TERMS, k + 8 if k else 0)).astype(np.float32)
        for _ in range(4 if k else 0):
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        if k:
            _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
            basis = basis @ turn[:k].T
        self.basis = basis.astype(np.float32)
        self.labelled = self._unit(x @ self.basis)
        self.labels = labels.astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.mean)
        k = min(self.neighbours, len(self.labels))
        if not k:
            return out
        own = self._unit((x * self.weight) @ self.basis)
        real = np.linalg.norm(own, axis=1) > 0.5
        for at in range(0, len(x), 256):
            near = own[at : at + 256] @ self.labelled.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(float) ** self.power
            total = weight.sum(axis=1)
            vote = (weight * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
            here = real[at : at + 256] & (total > 1e-9)
            out[at : at + 256][here] = vote[here]
        return np.clip(out, 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = 4000,
    dimensions: int = 48,
    neighbours: int = 25,
    power: float = 4.0,
):
    """A broadcast Model of the labelled documents outside the held-out fold."""
    kind = dict(docs.dtypes)[id_col]
    marked = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.avg(label_col).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labelled)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop, x in _term_batches(batch.column("text")):
                packed = pa.array([v.tobytes() for v in x.astype(np.float16)], pa.binary())
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), packed], ["id", "label", "x"])

    # At most max_labelled rows, so the broadcast is bounded; repeated ids are fitted once.
    fitted = rows.join(F.broadcast(marked), "id").dropDuplicates(["id"]).select("id", "label", "text")
    sample = fitted.mapInArrow(count, f"id {kind}, label double, x binary").toArrow().sort_by("id")
    x = np.frombuffer(b"".join(sample.column("x").to_pylist()), np.float16).reshape(-1, TERMS).astype(np.float32)
    model = Model(x, np.asarray(sample.column("label").to_pylist(), float), dimensions, neighbours, power)
    return docs.sparkSession.sparkContext.broadcast(model)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options) -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = fit(docs, labels, id_col, text_col, **options)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop, own in _term_batches(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.slice(at, stop - at).column("id"), pa.array(shared.value.score(own))], ["id", "score"])

    scored = rows.mapInArrow(judge, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options) -> DataFrame:
    """The input rows, all columns, that score at least ``threshold``; nothing is moved."""
    shared = fit(docs, labels, id_col, text_col, **options)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, stop, own in _term_batches(batch.column(text_col)):
                yield batch.slice(at, stop - at).filter(pa.array(shared.value.score(own) >= threshold))

    return docs.mapInArrow(pick, docs.schema)
