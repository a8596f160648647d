"""Keep one line of each group of near-equal lines, in DataFrame operations only.

Lines are compared without case and outer blanks. A line's shingles are the ``chars`` characters from
each word start, from each character of scripts without spaces, and from every place inside a long word
with that many characters of the word left, so that every character is read. Ten MinHash values, each the least
shingle hash under another XOR mask, form five bands of two. In every band, lines with equal keys are
paired with the least and the greatest line of their bucket; pairs whose exact Jaccard similarity over
all shingles is ``similarity`` or more are linked, and union-find joins linked lines. Then the other lines
of each bucket are compared in full, but for pairs that are joined already, in units of two blocks of about
``BLOCK`` lines. Whatever meets in a bucket is held against each other by sketches first, which a line's rows carry: only
pairs that may be near by these become rows, and only their lines' texts and shingles move.
Of each component, and of each set of equal lines, the first occurrence by (id, line number) stays.

Two lines of 0.8 share a bucket with probability 0.994; lines that share one are joined if they are near.

Lines under ``min_chars`` characters stay: short lines repeat for good reasons. Null and empty texts are
kept as they are. Rows that share an id are one document: their lines of equal number and content are
not told apart, so a repeated row keeps what its first copy keeps. Rows with a null id stay unchanged and do not count as
occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.components import components, free, marked, stored

BANDS, ROWS = 5, 2
#: About how many lines of a bucket are paired with as many others in one unit.
BLOCK = 1000
#: One mask per MinHash value, as signed 64-bit numbers spread evenly, so that they differ in their leading bits.
_MASKS = [k * 0x9E3779B97F4A7C15 % 2**64 - 2**63 for k in range(1, BANDS * ROWS + 1)]

#: The words of a line's sketch, and of the wide one that lines of more than ``LONG`` shingles have besides. Powers of two.
NARROW, WIDE, LONG = 4, 8, 192


def lines_of(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, pos, norm, digest, line): comparable lines with their place."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    lines = rows.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    norm = lines.where(F.length(F.trim("line")) >= min_chars).select("id", "pos", F.lower(F.trim("line")).alias("norm"))
    return norm.withColumns({"digest": F.unhex(F.md5("norm")), "nid": F.xxhash64("norm")})


def shingle_hashes(norm: Column, chars: int) -> Column:
    pattern = rf"(?s)(?:^|\s|(?=[⺀-퟿])|(?=\S{{{chars}}}))(?=(\S.{{0,{chars - 1}}}))"
    return F.transform(F.regexp_extract_all(norm, F.lit(pattern), F.lit(1)), lambda s: F.xxhash64(s))


def _band_keys(hashes: Column) -> Column:
    def masked(mask: int):
        return lambda h: h.bitwiseXOR(F.lit(mask))

    least = [F.array_min(F.transform(hashes, masked(m))) for m in _MASKS]
    return F.array(*(F.xxhash64(F.lit(b), *least[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)))


def _parities(hashes: Column, words: int) -> list[Column]:
    """Each of the 64 bits of a word tells if an odd number of the different hashes fall on it."""

    def word(k: int) -> Column:
        one = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
        mine = lambda h: h.bitwiseAND(F.lit((words - 1) << 6)) == F.lit(k << 6)
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda bits, h: F.when(mine(h), bits.bitwiseXOR(one(h))).otherwise(bits))

    return [word(k) for k in range(words)]


def _sketch(hashes: Column) -> Column:
    wide = F.when(F.size(hashes) > LONG, F.array(*_parities(hashes, WIDE)))
    return F.struct(F.size(hashes).alias("size"), *(w.alias(f"w{k}") for k, w in enumerate(_parities(hashes, NARROW))), wide.alias("wide")).alias("sketch")


def _may_be_near(l: str, r: str, similarity: float) -> Column:
    """False only for lines that are surely not near, by their sketches. A bit in which these differ stands for at least
    one shingle that only one of the lines has, and near lines have few of these."""
    few = (F.col(f"{l}.size") + F.col(f"{r}.size")) * ((1 - similarity) / (1 + similarity)) + 0.001

    def differ(a: list[Column], b: list[Column]) -> Column:
        return sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True))

    narrow = differ(*([F.col(f"{x}.w{k}") for k in range(NARROW)] for x in (l, r)))
    wide = differ(*([F.col(f"{x}.wide")[k] for k in range(WIDE)] for x in (l, r)))  # null if one of them has none
    return (F.abs(F.col(f"{l}.size") - F.col(f"{r}.size")) <= few) & (narrow <= few) & F.coalesce(wide <= few, F.lit(True))


def _sketches(wanted: DataFrame, lines: DataFrame, chars: int) -> DataFrame:
    """(nid, sketch) of the wanted lines, which come with sketches or with texts."""
    if "sketch" not in lines.columns:
        lines = lines.select("nid", F.array_distinct(shingle_hashes(F.col("norm"), chars)).alias("h")).select("nid", _sketch(F.col("h")))
    near = marked(lines.select("nid", "sketch"), ["nid"], wanted, "near").where("near")
    found = near.groupBy("nid").agg(F.collect_set("sketch").alias("found")).join(wanted, "nid", "left_semi")
    return found.select("nid", F.explode("found").alias("sketch"))  # one, if no two lines have a nid


def _shingle_sets(wanted: DataFrame, lines: DataFrame, chars: int) -> DataFrame:
    """(nid, digest, h): the different shingles of the wanted lines. A bit map keeps most others from being moved."""
    near = marked(lines.select("nid", "digest", "norm"), ["nid"], wanted, "near").where("near")
    # Grouped by what the join needs too, so that a text moves once.
    found = near.groupBy("nid").agg(F.collect_set(F.struct("digest", "norm")).alias("found")).join(wanted, "nid", "left_semi")
    texts = found.select("nid", F.explode("found").alias("line")).select("nid", "line.*")
    return texts.select("nid", "digest", F.array_distinct(shingle_hashes(F.col("norm"), chars)).alias("h"))


def _links(pairs: DataFrame, lines: DataFrame, chars: int, similarity: float) -> DataFrame:
    """(x, y, a, b): the pairs (x, y) of nids that are near enough, with their digests."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("nid")).distinct()
    sets = stored(_shingle_sets(wanted, lines, chars), "line-shingles")
    both = pairs.join(sets.toDF("x", "a", "ha"), "x").join(sets.toDF("y", "b", "hb"), "y")
    common = F.size(F.array_intersect("ha", "hb"))
    return both.where(common >= similarity * (F.size("ha") + F.size("hb") - common)).select("x", "y", "a", "b")


def _inner_pairs(rows: DataFrame, buckets: DataFrame, roots: DataFrame, lines: DataFrame, chars: int, similarity: float) -> DataFrame:
    """(x, y): every two lines of a bucket, neither an end of it, that are not joined yet and may be near. ``lines`` have
    their sketches or their texts."""
    inner = rows.select("key", "nid").join(buckets, "key").where("nid <> low AND nid <> high").select("key", "nid").distinct()
    rooted = stored(inner.join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid")), "line-inner")
    counts = rooted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    counts = stored(counts.where("r0 <> r1").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "line-mixed")
    open_ = rooted.join(counts, "key")
    own = stored(open_.groupBy("nid").agg(F.collect_set("key").alias("keys")), "line-keys")  # a key for each band at most
    sketches = stored(_sketches(own.select("nid"), lines, chars).join(own, "nid"), "line-sketches")
    cut = open_.join(sketches, "nid").withColumn("block", F.pmod(F.hash("nid"), F.col("blocks")))
    line = F.struct("nid", "root", "keys", "sketch.*")
    left = cut.select("key", F.col("block").alias("u"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("v"), line.alias("l"))
    right = cut.select("key", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("u"), F.col("block").alias("v"), line.alias("r"))
    met = left.join(right, ["key", "u", "v"]).where("l.root <> r.root AND (u < v OR l.nid < r.nid)")
    # Of the buckets that two lines share, the one of the least key makes their row.
    met = met.where(_may_be_near("l", "r", similarity)).where(F.array_min(F.array_intersect("l.keys", "r.keys")) == F.col("key"))
    return met.select(F.least("l.nid", "r.nid").alias("x"), F.greatest("l.nid", "r.nid").alias("y")).distinct()


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    chars: int = 9,
    similarity: float = 0.8,
) -> DataFrame:
    """(id, pos, keeper): each line to be removed and the place of the line that stays for it."""
    lines = lines_of(docs, id_col, text_col, min_chars)
    hashed = lines.select("id", "pos", "digest", "nid", F.array_distinct(shingle_hashes(F.col("norm"), chars)).alias("h"))
    keys = F.when(F.size("h") > 0, _band_keys(F.col("h"))).alias("keys")
    keyed = stored(hashed.select("id", "pos", "digest", "nid", keys, _sketch(F.col("h"))), "line-bands")

    ends = keyed.select("nid", F.explode("keys").alias("key")).groupBy("key").agg(F.min("nid").alias("low"), F.max("nid").alias("high"))
    shared = stored(ends.where("low <> high").select("key"), "line-shared")
    # Most lines share no bucket; the bit map keeps their rows from being moved again.
    rows = marked(keyed.select("nid", "sketch", F.explode("keys").alias("key")), ["key"], shared, "shared").where("shared")
    rows = stored(rows.select("key", "nid", "sketch"), "line-rows")
    line = F.struct("nid", "sketch.*")
    ends = rows.groupBy("key").agg(F.min(line).alias("low"), F.max(line).alias("high"), F.count(F.lit(1)).alias("n"))
    buckets = stored(ends.where("low.nid <> high.nid"), "line-buckets")
    near = [F.when((F.col("nid") != F.col(f"{end}.nid")) & _may_be_near("sketch", end, similarity), F.col(f"{end}.nid")) for end in ("low", "high")]
    outer = rows.join(buckets, "key").select("nid", F.explode(F.array(*near)).alias("end")).where("end IS NOT NULL")
    pairs = stored(outer.select(F.least("nid", "end").alias("x"), F.greatest("nid", "end").alias("y")).distinct(), "line-pairs")
    linked = stored(_links(pairs, lines, chars, similarity), "line-links")
    joined = components(linked.select(F.col("x").alias("a"), F.col("y").alias("b")), "line-ends").toDF("nid", "root")

    # Two lines besides the ends need a bucket of four rows.
    large = buckets.where("n > 3").select("key", F.col("low.nid").alias("low"), F.col("high.nid").alias("high"))
    inner = stored(_inner_pairs(rows, large, joined, rows, chars, similarity), "line-inner-pairs")
    if not inner.isEmpty():
        linked = stored(linked.unionByName(_links(inner, lines, chars, similarity)), "line-links")
    roots = components(linked.select("a", "b"), "line-components")

    places = keyed.select("id", "pos", "digest")
    rooted = places.join(roots.toDF("digest", "root"), "digest", "left").select("id", "pos", F.coalesce("root", "digest").alias("root"))
    rooted = stored(rooted, "line-places")
    keepers = stored(
        rooted.groupBy("root").agg(F.min(F.struct("id", "pos")).alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "line-keepers"
    )
    gone = rooted.join(keepers, "root").where((F.col("id") != F.col("keeper.id")) | (F.col("pos") != F.col("keeper.pos")))
    return gone.select("id", "pos", "keeper")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed"), **options) -> DataFrame:
    """The input rows and columns, the text without removed lines, and two more columns, named by ``counts``: lines, and
    lines removed. Input columns of these names give way to them; any other names are free."""
    gone = stored(repeated_lines(docs, id_col, text_col, **options).select("id", "pos"), "line-removals")
    docs = docs.drop(*counts)
    lost, key, touched = (free(name, docs) for name in ("_gone", "_id", "_touched"))
    lists = gone.groupBy(F.col("id").alias(key)).agg(F.collect_set("pos").alias(lost))  # at most the lines of one document
    # Documents that lose no line do not move.
    split = marked(docs, [id_col], gone.select(F.col("id").alias(id_col)), touched)
    text = F.col(text_col)

    def counted(df: DataFrame, kept: Column, removed: Column) -> DataFrame:
        lines = F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long")
        return df.select(*(kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns), lines.alias(counts[0]), removed.cast("long").alias(counts[1]))

    still = counted(split.where(~F.col(touched)), text, F.lit(0))
    moved = split.where(F.col(touched)).join(lists, F.col(id_col) == F.col(key), "left")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(F.col(lost), i)), "\n")
    cut = counted(moved, F.when(F.col(lost).isNull(), text).otherwise(kept), F.coalesce(F.size(lost), F.lit(0)))
    return still.unionByName(cut)
