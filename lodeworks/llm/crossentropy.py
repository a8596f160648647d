"""Score documents by cross-entropy difference between two word-bigram models.

The target model counts the documents labelled 1, the background model all documents. Both share one
vocabulary, one smoothing and one set of bigrams: p(w|v) = weight * c(v,w)/c(v) + (1-weight) * p(w),
p(w) with ``alpha`` added to each count. A document's score is the mean over its words of the target
model's loss minus the background model's; the lower, the more it reads like the target.

Every word and every bigram of every document counts. One pass counts them, as 64-bit hashes; what only one
text holds needs no table, since that text's own count is the count. The other words and bigrams stay in written
tables. The ``WORDS`` most frequent of these words and the ``bigrams`` most frequent of these bigrams are broadcast,
and bit maps of the rest tell what only one text holds, but for a few that they let pass: losses over these are
summed on the spot. Each other bigram of a text meets its counts by a join. Neither the heads nor the bit maps decide
anything; they spare moving rows.

A null or empty text has no words and null scores. A row with a null id takes part in the background
and is scored. An id labelled both ways counts as target; repeated rows count each time. Without labels
the target model is uniform. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.components import marked, stored
from lodeworks.llm.words import Words, mix, slices

#: Kinds of words that no text holds, in the smoothing.
CLASSES = 10
FLUSH = 2_000_000
#: How many words' counts are broadcast.
WORDS = 2_000_000
#: The most 64-bit slots of each bit map, of words and of bigrams that several texts hold.
SLOTS = 1 << 21
#: Stands for the start of a text, before its first word.
START = np.uint64(0x5851F42D4C957F2D)


def _pairs(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigram, word before and word, as hashes, for each word; the start stands before a text's first."""
    words = w.hashes()
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[w.first[:-1][w.counts > 0]] = START
    return mix(mix(before) + words), before, words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words and bigrams, counted within the task as far as memory allows: occurrences, those in the target,
    and 1 for what one text holds, 2 for what several do. The start counts as a word, once for each text that has any."""

    def packed(held: list, is_gram: bool) -> pa.RecordBatch:
        keys, rows, targets = (np.concatenate(c) for c in zip(*held, strict=True))
        turn = np.argsort(keys, kind="stable")  # rows ascend within a key
        keys, rows, targets = keys[turn], rows[turn], targets[turn]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        last = np.append(first[1:], len(keys)) - 1
        columns = [keys[first].view(np.int64), np.diff(np.append(first, len(keys))), np.add.reduceat(targets, first, dtype=np.int64), 1 + (rows[first] != rows[last])]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), is_gram)), *(pa.array(c, pa.int64()) for c in columns)], ["is_gram", "key", "all", "target", "texts"])

    words, grams, size, rows = [], [], 0, 0
    for batch in batches:
        targets = np.asarray(batch.column("wanted"))
        for at, stop, w in slices(batch.column("text")):
            gram, _, word = _pairs(w)
            filled = np.flatnonzero(w.counts > 0)
            flags = targets[at:stop]
            words += [(word, w.row + rows, flags[w.row]), (np.full(len(filled), START), filled + rows, flags[filled])]
            grams.append((gram, w.row + rows, flags[w.row]))
            size, rows = size + len(gram), rows + w.rows
            if size >= FLUSH:
                yield from (packed(words, False), packed(grams, True))
                words, grams, size = [], [], 0
    if size:
        yield from (packed(words, False), packed(grams, True))


def _least_count(counts: DataFrame, limit: int) -> int | None:
    """The count of the limit-th most frequent key; a level that would pass the limit is left out whole."""
    levels = counts.groupBy("all").count().collect()  # as many rows as there are different counts
    least, total = None, 0
    for row in sorted(levels, key=lambda r: -r["all"]):
        total += row["count"]
        if total > limit:
            break
        least = row["all"]
    return least


def _head(counts: DataFrame, limit: int) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """Sorted keys and counts of the most frequent, and the rest."""
    least = _least_count(counts, limit)
    if least is None:
        return (np.empty(0, np.uint64), np.empty((0, 2), np.uint32)), counts
    found = counts.where(F.col("all") >= least).select("key", "all", "target").toArrow()
    keys = np.asarray(found.column("key"), np.int64).view(np.uint64)
    order = np.argsort(keys)
    both = np.column_stack([found.column("all"), found.column("target")])[order]
    return (keys[order], both.astype(np.uint32 if both[:, 0].max(initial=0) < 2**32 else np.int64)), counts.where(F.col("all") < least)


def _bit_map(keys: DataFrame) -> np.ndarray:
    """Some 16 bits for each key, as far as SLOTS allows."""
    slots = min(SLOTS, 1 << (keys.count() // 4).bit_length())
    slot, bit = F.col("key").bitwiseAND(F.lit(slots - 1)).cast("int"), F.shiftright("key", 40).bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    found = keys.select(slot.alias("slot"), one.alias("one")).groupBy("slot").agg(F.bit_or("one").alias("bits")).toArrow()
    bits = np.zeros(slots, np.uint64)
    bits[np.asarray(found.column("slot"))] = np.asarray(found.column("bits"), np.int64).view(np.uint64)
    return bits


def _known(keys: np.ndarray, head: tuple[np.ndarray, np.ndarray], bits: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (all, target) of different keys, whether they are sure, and places in the head or -1. They are from the
    head, or the own ones of a key that no other text holds."""
    shared = (bits[keys & np.uint64(len(bits) - 1)] >> (keys >> np.uint64(40) & np.uint64(63)) & np.uint64(1)).astype(bool)
    counts, sure, place = own.copy(), ~shared, np.full(len(keys), -1)
    if len(head[0]):
        near = np.minimum(np.searchsorted(head[0], keys), len(head[0]) - 1)
        hit = head[0][near] == keys
        counts[hit], sure[hit], place[hit] = head[1][near[hit]], True, near[hit]
    return counts, sure, place


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    bigrams: int = 400_000,
    weight: float = 0.7,
    alpha: float = 0.5,
) -> DataFrame:
    """One row per input row: id, n_tokens, ce_target, ce_background, score (nats per word)."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    wanted = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct()
    # The bit map keeps most texts that are not wanted from being moved for the join.
    split = marked(rows, ["id"], wanted, "perhaps")
    asked = split.where("perhaps").drop("perhaps").join(wanted.withColumn("wanted", F.lit(True)), "id", "left")
    asked = stored(asked.withColumn("wanted", F.coalesce("wanted", F.lit(False))), "crossentropy-asked")
    texts = split.where("NOT perhaps").select("id", "text", F.lit(False).alias("wanted")).unionByName(asked)

    counts = texts.select("text", "wanted").mapInArrow(_count, "is_gram boolean, key long, all long, target long, texts long")
    counts = counts.groupBy("is_gram", "key").agg(F.sum("all").alias("all"), F.sum("target").alias("target"), F.sum("texts").alias("texts"))
    counts = stored(counts.where("NOT is_gram OR texts > 1"), "crossentropy-counts")
    words = counts.where("NOT is_gram").select("key", "all", "target", "texts")
    grams = counts.where("is_gram").select("key", "all", "target")
    start = int(START.view(np.int64))
    total = words.where(F.col("key") != start).agg(F.count(F.lit(1)).alias("n"), F.sum("all").alias("all"), F.sum("target").alias("target")).first()
    size = total["n"] + CLASSES
    below = {which: (total[which] or 0) + alpha * size for which in ("all", "target")}

    word_head, other_words = _head(words.where("texts > 1").drop("texts"), WORDS)
    gram_head, other_grams = _head(grams, bigrams)
    shared = spark.sparkContext.broadcast((word_head, gram_head, _bit_map(other_words), _bit_map(other_grams)))

    def look_up(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        """If whole, a row for each text, with its losses as far as all counts are known here, and one for each other
        bigram of it whose words' counts are known. If not, its bigrams with other words."""
        word_head, gram_head, word_bits, gram_bits = shared.value
        for batch in batches:
            row_ids, targets = np.asarray(batch.column("row_id")), np.asarray(batch.column("wanted")).astype(np.int64)
            for at, stop, w in slices(batch.column("text")):
                gram, before, word = _pairs(w)
                target, texts = targets[at:stop], pa.array(row_ids[at:stop])
                # A key that one text holds has all its occurrences in this slice, which is made of whole texts.
                keys, first, index, n = np.unique(word, return_index=True, return_inverse=True, return_counts=True)
                word_n, word_sure, place = _known(keys, word_head, word_bits, np.column_stack([n, n * target[w.row[first]]]))
                filled = int((w.counts > 0).sum())
                start_n, start_sure, start_place = _known(np.full(1, START), word_head, word_bits, np.array([[filled, int(target[w.counts > 0].sum())]]))
                word_n, word_sure, place = np.concatenate([word_n, start_n]), np.append(word_sure, start_sure), np.append(place, start_place)
                keys, first, gram_index, n = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
                own = w.row[first]
                gram_n, gram_sure, _ = _known(keys, gram_head, gram_bits, np.column_stack([n, n * target[own]]))
                at_start = np.zeros(len(gram), bool)
                at_start[w.first[:-1][w.counts > 0]] = True
                v_index = np.where(at_start, len(word_n) - 1, np.append(0, index[:-1]) if len(index) else index)
                v, y = v_index[first], index[first]
                words_sure = word_sure[v] & word_sure[y]
                gram_sure |= words_sure & ((place[v] < 0) | (place[y] < 0))  # one text holds the word, and so the bigram
                done = words_sure & gram_sure
                names = ["id", "n_tokens", "background_sum", "target_sum", "n", "row_id", "key", *(["places"] if whole else ["before", "word"])]
                if whole:
                    sums = []
                    for k, which in enumerate(("all", "target")):
                        plain = (word_n[y, k] + alpha) / below[which]
                        loss = np.where(done, -np.log(weight * gram_n[:, k] / np.maximum(word_n[v, k], 1) + (1 - weight) * plain), 0.0) if len(keys) else np.empty(0)
                        sums.append(np.bincount(w.row, loss[gram_index], w.rows).astype(float))
                    part = batch.column("id").slice(at, stop - at)
                    none = pa.nulls(w.rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([part, pa.array(w.counts, pa.int64()), *map(pa.array, sums), none, texts, texts, none], names)
                asked = np.flatnonzero((words_sure & ~gram_sure if whole else ~words_sure)[gram_index])
                if not len(asked):
                    continue
                pair, n = np.unique(w.row[asked] * len(keys) + gram_index[asked], return_counts=True)
                row, g = pair // len(keys), pair % len(keys)
                null = [pa.nulls(len(row), t) for t in (batch.schema.field("id").type, pa.int64(), pa.float64(), pa.float64())]
                last = [place[v[g]] << 32 | place[y[g]]] if whole else [before[first[g]].view(np.int64), word[first[g]].view(np.int64)]
                numbers = [np.where(target[row] > 0, -n, n), row_ids[at:stop][row], keys[g].view(np.int64), *last]
                yield pa.RecordBatch.from_arrays([*null, *(pa.array(x, pa.int64()) for x in numbers)], names)

    def near_losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of rows for texts as they are, and the losses of bigrams of words of the head."""
        counts = shared.value[0][1]
        for batch in batches:
            numbers = {c: np.asarray(batch.column(c).fill_null(0)) for c in ("n", "all", "target", "places")}
            summed = batch.column("places").is_null().to_numpy(zero_copy_only=False)
            losses = []
            for k, which in enumerate(("all", "target")):
                sums = np.asarray(batch.column(("background_sum", "target_sum")[k]).fill_null(0.0))
                if len(counts):
                    before, word = counts[numbers["places"] >> 32, k], counts[numbers["places"] & 0xFFFFFFFF, k]
                    plain = (word + alpha) / below[which]
                    with np.errstate(divide="ignore"):
                        loss = numbers["n"] * -np.log(weight * numbers[which] / np.maximum(before, 1) + (1 - weight) * plain)
                    sums = np.where(summed, sums, loss)
                losses.append(pa.array(sums))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row_id", "id", "n_tokens")), *losses], ["row_id", "id", "n_tokens", "b", "t"])

    # n is below zero in texts of the target. Columns that differ from row to row stand side by side, which packs best.
    schema = f"id {kind}, n_tokens long, background_sum double, target_sum double, n long, row_id long, key long"
    numbered = texts.withColumn("row_id", F.monotonically_increasing_id())  # of stored rows: the same in both passes
    # What a bit map let pass without need is in no table: the text's own count is the count.
    counted = [F.coalesce("all", F.abs("n")).alias("all"), F.coalesce("target", F.greatest(-F.col("n"), F.lit(0))).alias("target")]
    grams = grams.hint("shuffle_hash")  # each bigram once; sorting the texts' bigrams costs more
    met = numbered.mapInArrow(lambda b: look_up(b, True), f"{schema}, places long").join(grams, "key", "left")
    losses = met.select("row_id", "id", "n_tokens", "background_sum", "target_sum", F.abs("n").alias("n"), "places", *counted).mapInArrow(near_losses, f"row_id long, id {kind}, n_tokens long, b double, t double")
    if not other_words.isEmpty():
        far = numbered.mapInArrow(lambda b: look_up(b, False), f"{schema}, before long, word long")
        for name in ("before", "word"):
            far = far.join(words.select(F.col("key").alias(name), F.col("all").alias(f"all_{name}"), F.col("target").alias(f"target_{name}")), name)

        def loss(which: str):
            plain = (F.col(f"{which}_word") + alpha) / below[which]
            return F.abs("n") * -F.log(weight * F.col(which) / F.greatest(F.col(f"{which}_before"), F.lit(1)) + (1 - weight) * plain)

        far = far.join(grams, "key", "left").select("*", *(c.alias(f"{name}_here") for c, name in zip(counted, ("all", "target"), strict=True)))
        far = far.drop("all", "target").withColumnsRenamed({"all_here": "all", "target_here": "target"})
        losses = losses.unionByName(far.select("row_id", "id", "n_tokens", loss("all").alias("b"), loss("target").alias("t")))
    scored = losses.groupBy("row_id").agg(F.first("id", ignorenulls=True).alias("id"), F.max("n_tokens").alias("n_tokens"), F.sum("b").alias("b"), F.sum("t").alias("t"))
    many = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    out = scored.select(F.col("id").alias(id_col), "n_tokens", (F.col("t") / many).alias("ce_target"), (F.col("b") / many).alias("ce_background"))
    return out.withColumn("score", F.col("ce_target") - F.col("ce_background"))
