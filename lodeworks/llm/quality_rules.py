"""Rules for text quality, with distributions held against a reference per language.

Counts come from the whole text. Base rules: too few words, or too many words in 8-word windows that
occur twice or more. Beyond them a text is rejected when its histogram of character classes or of its
language's common words is far (Jensen-Shannon distance, 0 to 1) from the language's reference. The
references are sums over all documents that pass the base rules.

A short text is far from its language by chance alone: n draws from a reference of k kinds lie (k - 1) / (8 n ln 2) from
it in expected squared distance. Below ``full_words`` words (``full_chars`` characters) the squared limit grows by ``spread`` of
what that is more than at full length, so that the limit has no step. Guards: texts under ``min_words``, the base rules' limit, or
``min_chars``, and languages without a word list, are left to the base rules.

A null or empty text has no words and fails. Repeated rows are judged alike, a null language has no
reference, other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.words import mix, slices
from lodeworks.session import work_path

#: Frequent words of each language, as they stand inside a sentence.
COMMON = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
}
LANGUAGES = sorted(COMMON)
VOCABULARY = sorted({w for words in COMMON.values() for w in words})

#: Character classes by first byte: lower case, upper case, digits, blanks, sentence marks, symbols,
#: other ASCII, beyond ASCII; continuation bytes belong to no class.
_CLASSES = 8
_SYMBOLS = b"#*$%&|<>"


def _class_of_byte() -> np.ndarray:
    table = np.full(256, 6, np.int64)
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), b".,;:!?'\"-()", _SYMBOLS)):
        table[list(members)] = k
    table[128:] = 7
    table[128:192] = _CLASSES
    return table


_CLASS = _class_of_byte()

STATS = (
    "id {id}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, classes array<long>, common array<long>"
)


def _vocabulary_hashes() -> tuple[np.ndarray, np.ndarray]:
    _, _, words = next(slices(pa.array(VOCABULARY)))
    hashes = words.hashes()
    order = np.argsort(hashes)
    return hashes[order], order


def _duplicate_lines(text: str) -> int:
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    seen, again = set(), 0
    for line in lines:
        if line in seen:
            again += bool(line.strip(" \t\n\x0b\x0c\r"))
        else:
            seen.add(line)
    return again


def _count(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    known, order = _vocabulary_hashes()
    for batch in batches:
        texts = batch.column(2)
        for at, stop, w in slices(texts):
            n, rows = len(w.start), w.rows
            hashes = w.hashes()
            heads = (w.data & 0xC0) != 0x80
            ahead = np.concatenate(([0], np.cumsum(heads)))
            chars = np.bincount(w.row, ahead[w.end] - ahead[w.start], rows).astype(np.int64)
            lengths = np.asarray([0 if t is None else len(t.encode()) for t in texts.slice(at, stop - at).to_pylist()])
            byte_row = np.repeat(np.arange(rows), lengths)
            classes = np.bincount(byte_row * (_CLASSES + 1) + _CLASS[w.data], minlength=rows * (_CLASSES + 1)).reshape(rows, -1)[:, :_CLASSES]
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[near] == hashes
            common = np.bincount(w.row[hit] * len(known) + order[near[hit]], minlength=rows * len(known)).reshape(rows, -1)
            grams, first = w.grams(hashes, window)
            # The row goes into the key: a window repeats only within its own text.
            keys = mix(grams + mix(w.row[first].astype(np.uint64)))
            _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
            begin = first[times[inverse] > 1]
            marks = np.zeros(n + 1, np.int64)
            np.add.at(marks, begin, 1)
            np.add.at(marks, begin + window, -1)
            repeated = np.bincount(w.row, np.cumsum(marks[:-1]) > 0, rows).astype(np.int64)
            lines = [_duplicate_lines(t or "") for t in texts.slice(at, stop - at).to_pylist()]
            part = batch.slice(at, stop - at)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(w.counts, pa.int64()),
                    pa.array(chars),
                    pa.array(classes[:, 5], pa.int64()),
                    pa.array(lines, pa.int64()),
                    pa.array(repeated),
                    _lists(classes),
                    _lists(common),
                ],
                ["id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "common"],
            )


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(values.ravel(), pa.int64()))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of p to q, both counts."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = q / max(q.sum(), 1)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    return np.sqrt(np.maximum(left + right, 0) / 2)


def limits(base: float, kinds: int, n: np.ndarray, full: float, spread: float) -> np.ndarray:
    """The greatest distance allowed to a histogram of n draws."""
    more = (kinds - 1) / (8 * np.log(2)) * np.maximum(1 / np.maximum(n, 1) - 1 / full, 0)
    return np.sqrt(base**2 + spread * more)


def _members(language: str) -> np.ndarray:
    return np.asarray([VOCABULARY.index(w) for w in COMMON[language]])


def apply_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_words: int = 20,
    min_chars: int = 60,
    max_class_distance: float = 0.3,
    max_common_distance: float = 0.29,
    full_words: float = 100,
    full_chars: float = 500,
    spread: float = 0.4,
) -> DataFrame:
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    path = work_path(spark, "quality-rules")
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows.mapInArrow(lambda b: _count(b, 8), STATS.format(id=kind)).write.parquet(path)
    stats = spark.read.parquet(path)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)

    # One row per language that has a word list, whatever the input holds.
    sums = (
        stats.where(~F.col("base_failed") & F.col("lang").isin(LANGUAGES))
        .groupBy("lang")
        .agg(
            *(F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(_CLASSES)),
            *(F.sum(F.col("common")[k]).alias(f"w{k}") for k in range(len(VOCABULARY))),
            F.sum("n_words").alias("n"),
        )
        .collect()
    )
    references = {}
    for row in sums:
        words = np.asarray([row[f"w{k}"] for k in range(len(VOCABULARY))], float)[_members(row["lang"])]
        references[row["lang"]] = (
            np.asarray([row[f"c{k}"] for k in range(_CLASSES)], float),
            np.append(words, row["n"] - words.sum()),
        )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            classes = np.asarray(batch.column("classes").flatten()).reshape(n, _CLASSES).astype(float)
            common = np.asarray(batch.column("common").flatten()).reshape(n, len(VOCABULARY)).astype(float)
            words = np.asarray(batch.column("n_words")).astype(float)
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            by_class, by_word = np.full(n, np.nan), np.full(n, np.nan)
            for lang, (class_sums, word_sums) in references.items():
                mine = (langs == lang) & (words >= min_words) & (classes.sum(axis=1) >= min_chars)
                if mine.any():
                    own = common[mine][:, _members(lang)]
                    own = np.column_stack([own, words[mine] - own.sum(axis=1)])
                    by_class[mine] = distance(classes[mine], class_sums)
                    by_word[mine] = distance(own, word_sums)
            bad = np.asarray(batch.column("base_failed"), bool)
            class_limit = limits(max_class_distance, _CLASSES, classes.sum(axis=1), full_chars, spread)
            word_limit = limits(max_common_distance, len(COMMON["en"]) + 1, words, full_words, spread)
            kept = ~bad & ~(by_class > class_limit) & ~(by_word > word_limit)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
                    pa.array(kept),
                    pa.array(by_class, mask=np.isnan(by_class)),
                    pa.array(by_word, mask=np.isnan(by_word)),
                ],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "common_distance"],
            )

    schema = (
        f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, common_distance double"
    )
    return stats.mapInArrow(judge, schema).withColumnRenamed("id", id_col)
