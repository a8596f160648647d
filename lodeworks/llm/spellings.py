"""Spelling variants: words one edit apart, each led to the more frequent one it comes from.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF; A-Z are lower-cased, other letters stay as they are.

Pairs come from a finite-state composition. The words' minimal acyclic acceptor A is composed with the
transducer T that replaces, deletes or inserts one symbol, and with A again. A state of A.T.A is (p, p)
before the edit, as A is deterministic and both sides have read the same, and (p, q) after it. States of A count
the words below them, so a path is a pair of word numbers and no text is spelled out. States of A that
are equal are one state, and what a state or a pair of states accepts is worked out once.

A is never built whole. The composition is cut by initial state:

* the state that A reaches by a prefix of the word. A partition holds the words with that prefix, and
  accepts the pairs whose edit lies behind it;
* the same for the reversed words, for pairs whose edit lies in front of a common suffix.

Prefixes and suffixes have ``LEVELS[0]`` symbols, or as many more (by steps) as it takes to bring a partition down to
``limit`` words. If both have grown so far that an edit between them is seen by neither, the words give
that place up one by one, and those left with equal texts are put side by side (``_between``): such a group holds
at most one word for each letter and place.

What leaves a partition is one row per word: its number of near words, and the best of them. Memory per task is
bound by ``limit`` words, tables of words are only joined by word, and words of any length are handled
without recursion.

A null or empty text has no words. Rows are counted one by one, repeated rows too. A null id counts as an empty one for
``slip``. Input columns other than id and text are ignored. An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.components import stored

LEVELS = (3, 4, 5, 6, 8, 10, 13, 16, 20, 26, 32, 48, 64)
#: Different words held in a task before their counts are handed on.
FLUSH = 300_000
_PAIRS = "word string, n_near bigint, less bigint, best string"


def _count(batches: Iterator[pa.RecordBatch], least_length: int, slip: int | None) -> Iterator[pa.RecordBatch]:
    run = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        total.clear()
        return done

    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for raw, n in Counter(run.findall(text.as_py() or "")).items():
                word = raw.encode().lower()  # ASCII letters only
                if slip and not (h := zlib.crc32(word, seed)) % slip:
                    at = h % len(raw)
                    if len(raw) == least_length:
                        continue
                    letters = word.decode()
                    word = (letters[:at] + letters[at + 1 :]).encode()
                total[word] += n
            if len(total) >= FLUSH:
                yield out()
    if total:
        yield out()


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, slip: int | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least ``least_length`` letters with their occurrences, ``least_count`` or more.

    ``slip`` puts typing errors in, for tests: where it divides the crc32 of ``<id>:<word>``, the letter at
    that number modulo the word's length is left out.
    """
    chosen = docs.select(docs[id_column].cast("string").alias("id"), docs[text].alias("text"))
    counted = chosen.mapInArrow(lambda batches: _count(batches, least_length, slip), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """The minimal acyclic acceptor of sorted different words; state numbers rise from the ends to the root.

    ``edges[p]`` maps a symbol to (next state, words of p in front of it); ``size`` counts a state's words, ``shortest`` is
    the length of the shortest.
    """

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        self.shortest: list[int] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[{}, False]]  # states of the last word's path, open for more edges
        before = ""
        for word in words:
            common, most = 0, min(len(before), len(word))
            while common < most and before[common] == word[common]:
                common += 1
            self._close(path, before, common, known)
            path += [[{}, False] for _ in range(len(word) - common)]
            path[-1][1] = True
            before = word
        self._close(path, before, 0, known)
        self.root = self._state(path[0], known)

    def _close(self, path: list[list], word: str, depth: int, known: dict[tuple, int]) -> None:
        for k in range(len(path) - 1, depth, -1):
            path[k - 1][0][word[k - 1]] = self._state(path.pop(), known)

    def _state(self, node: list, known: dict[tuple, int]) -> int:
        key = (node[1], tuple(node[0].items()))
        state = known.get(key)
        if state is None:
            state = known[key] = len(self.edges)
            at, edges = int(node[1]), {}
            for symbol, to in node[0].items():
                edges[symbol] = (to, at)
                at += self.size[to]
            self.edges.append(edges)
            self.final.append(node[1])
            self.size.append(at)
            self.shortest.append(0 if node[1] else 1 + min((self.shortest[to] for to in node[0].values()), default=0))
        return state


def near_pairs(words: list[str], within: int | None = None) -> np.ndarray:
    """Pairs (rows of two numbers, the smaller first) of the sorted different words that are one edit apart.

    With ``within``, only edits followed by fewer symbols than that.
    """
    a = Acceptor(words)
    edges, final, shortest = a.edges, a.final, a.shortest
    memo: dict[tuple[int, int], tuple] = {}

    def common(p: int, q: int) -> tuple:
        """Numbers below p and below q of the endings that both accept."""
        have = memo.get((p, q))
        if have is not None:
            return have
        todo = [(p, q)]
        while todo:
            x, y = todo[-1]
            ex, ey = edges[x], edges[y]
            shared = [(ex[c], ey[c]) for c in ex if c in ey] if len(ex) <= len(ey) else [(ex[c], ey[c]) for c in ey if c in ex]
            open_ = [(s[0], t[0]) for s, t in shared if (s[0], t[0]) not in memo]
            if open_:
                todo += open_
                continue
            todo.pop()
            found = [(0, 0)] if final[x] and final[y] else []
            for (s, at), (t, to) in shared:
                found += [(at + i, to + j) for i, j in memo[s, t]]
            memo[x, y] = tuple(found)
        return memo[p, q]

    below: dict[int, np.ndarray] = {}  # state: pairs of its words one edit apart
    for p in range(len(edges)):
        found = [below[to] + at for to, at in edges[p].values() if to in below]
        own: list[tuple[int, int]] = []
        out = [x for x in edges[p].values() if within is None or shortest[x[0]] < within]
        for k, (x, at) in enumerate(out):
            for y, to in out[k + 1 :]:  # replaced
                own += [(at + i, to + j) for i, j in common(x, y)]
            own += [(at + i, j) for i, j in common(x, p)]  # left out
        if own:
            found.append(np.array(own, np.int64))
        if found:
            below[p] = np.concatenate(found)
    pairs = below.get(a.root, np.empty((0, 2), np.int64))
    return np.unique(np.sort(pairs, axis=1), axis=0)


def _digest(words: list[str], n: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch | None:
    """(word, near words, minus the best's n, best) for the words of the pairs."""
    if not len(pairs):
        return None
    used = np.unique(pairs)
    rank = np.empty(len(words), np.int64)
    rank[sorted(used.tolist(), key=words.__getitem__)] = np.arange(len(used))
    one, other = np.concatenate([pairs, pairs[:, ::-1]]).T
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1])))
    columns = [[words[k] for k in one[first]], np.diff(np.append(first, len(one))), -n[other[first]], [words[k] for k in other[first]]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "n_near", "less", "best"])


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Consecutive rows that agree in the given columns."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[c] != held[0][c] for c in by):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches, ["side", "leaf"]):
        if len(group) < 2:
            continue
        n = np.array([r["n"] for r in group])
        spelled = [r["spelled"] for r in group]
        if group[0]["side"] == 0:
            done = _digest(spelled, n, near_pairs(spelled))
        else:  # reversed words; pairs with a common prefix up to the prefix partition are seen there
            words = [s[::-1] for s in spelled]
            front = [w[: r["depth"]] if len(w) >= r["depth"] else None for w, r in zip(words, group, strict=True)]
            pairs = near_pairs(spelled, within=max(r["depth"] for r in group))
            new = [front[i] is None or front[i] != front[j] for i, j in pairs.tolist()]
            done = _digest(words, n, pairs[np.array(new, bool)])
        if done is not None:
            yield done


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose edit neither the prefix partitions nor the suffix partitions see."""
    for group in _groups(batches, ["key"]):
        rows = {r["word"]: r for r in group}
        words = sorted(rows)
        number = {w: k for k, w in enumerate(words)}
        places = defaultdict(set)
        for r in group:
            places[r["place"]].add(r["word"])
        pairs = set()
        for place, at in places.items():
            for x in at:
                # with one letter less: the others with that letter's place, and the word that is just the rest
                for y in (at if place is not None else set()) | places.get(None, set()):
                    if x != y and not _seen(rows[x], y):
                        pairs.add(tuple(sorted((number[x], number[y]))))
        done = _digest(words, np.array([rows[w]["n"] for w in words]), np.array(sorted(pairs), np.int64).reshape(-1, 2))
        if done is not None:
            yield done


def _seen(row: dict, other: str) -> bool:
    word, front, back = row["word"], row["front"], row["back"]
    return (len(word) >= front and word[:front] == other[:front]) or (len(word) >= back and word[-back:] == other[-back:])


def _leaves(words: DataFrame, side: str, limit: int) -> DataFrame:
    """words with (side, side_depth): the shortest prefix or suffix of the levels that at most ``limit`` words have."""
    done, todo = [], words
    for depth in LEVELS:
        cut = todo.withColumns({side: F.left("word", F.lit(depth)) if side == "front" else F.right("word", F.lit(depth)), f"{side}_depth": F.lit(depth)})
        hot = stored(cut.groupBy(side).agg(F.count("*").alias("words")).where(F.col("words") > limit).select(side), f"spellings-{side}")
        if hot.isEmpty():
            return _union([*done, cut])
        done.append(cut.join(hot, side, "left_anti"))
        todo = stored(cut.join(hot, side, "left_semi").drop(side, f"{side}_depth"), f"spellings-{side}")
    # Still too many: each word by itself, so that every edit counts as unseen from this side.
    return _union([*done, todo.withColumns({side: F.col("word"), f"{side}_depth": F.length("word") + 1})])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def near_words(words: DataFrame, limit: int = 20_000) -> DataFrame:
    """(word, n_near, less, best): partial results by word, of all pairs of words (word, n) one edit apart.

    Each pair is seen once, by one partition. ``less`` is minus the occurrences of ``best``, the most frequent near word of that partition.
    """
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    cut = stored(_leaves(_leaves(words, "front", limit), "back", limit), "spellings-leaves")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("front").alias("leaf"), F.col("word").alias("spelled"), "n", F.col("front_depth").alias("depth")),
        F.struct(F.lit(1).alias("side"), F.col("back").alias("leaf"), F.reverse("word").alias("spelled"), "n", F.col("front_depth").alias("depth")),
    )
    dealt = cut.select(F.inline(sides)).repartition(tasks, "side", "leaf").sortWithinPartitions("side", "leaf", "spelled")
    composed = dealt.mapInArrow(_composed, _PAIRS)
    # Places of an edit in front of the prefix's end and behind the suffix's start; none where both are short.
    low, high = F.greatest(F.length("word") - F.col("back_depth"), F.lit(0)), F.least(F.col("front_depth"), F.length("word")) - 1
    deep = cut.where(F.col("front_depth") + F.col("back_depth") > F.length("word")).select(
        "word", "n", F.col("front_depth").alias("front"), F.col("back_depth").alias("back"), F.when(low <= high, F.sequence(low, high)).otherwise(F.array()).alias("places")
    )
    less = deep.select("word", "n", "front", "back", F.explode("places").alias("place"))
    less = less.withColumn("key", F.expr("concat(left(word, place), substring(word, place + 2))"))
    whole = deep.drop("places").withColumns({"place": F.lit(None).cast("int"), "key": F.col("word")})
    between = less.unionByName(whole).repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(_between, _PAIRS)
    return composed.unionByName(between)


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without circles: where following the forms ends; by pointer doubling."""
    reached = stored(links.select("word", F.col("form").alias("root")), "spellings-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "spellings-roots")
        reached = step.select("word", "root")
        if step.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, times: int = 10, limit: int = 20_000) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of words (word, n), which are different.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if that is at least ``times`` the word's n;
    ``root`` is where following the forms ends, the word itself without one.
    """
    words = stored(words.select("word", "n"), "spellings-words")
    near = near_words(words, limit)
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("less"), F.lit(None).cast("string").alias("best"))
    rows = rows.unionByName(near.withColumn("n", F.lit(None).cast("long")))
    merged = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best").isNotNull(), F.struct("less", "best"))).alias("top"))
    held = F.col("top").isNotNull() & (-F.col("top.less") >= times * F.col("n"))
    formed = stored(merged.select("word", "n", "n_near", F.when(held, F.col("top.best")).alias("form"), F.when(held, -F.col("top.less")).alias("form_n")), "spellings-forms")
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
