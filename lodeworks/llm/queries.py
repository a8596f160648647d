"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import crossentropy, decontamination, jaccard_join, license_scan, line_dedup, neighbours, periodic_runs, pieces, pii, quality_rules, spellings, substrings, url_filter
from lodeworks.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401


def _url_sql() -> str:
    """The same verdicts in SQL, written from the same rules and terms."""

    def fits(text: str) -> str:
        name, slash, rest = text.partition("/")
        return f"((host = '{name}' OR host LIKE '%.{name}') AND starts_with(path, '{slash}{rest}'))"

    def has(term: str) -> str:
        return f"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"

    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(text)} THEN '{text}'" for _, text in rules)
    said = " ".join(f"WHEN {fits(text)} THEN '{verdict}'" for verdict, text in rules)
    strict = " + ".join(f"CAST({has(t)} AS BIGINT)" for t in url_filter.STRICT)
    soft = " + ".join(f"CAST({has(t)} AS BIGINT)" for t in url_filter.SOFT)
    weight = " + ".join(f"{w}::DOUBLE * CAST({has(t)} AS BIGINT)" for t, w in url_filter.SOFT.items())
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH a AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
    b AS (SELECT page_id, {lower.format('url')} AS u,
                 {lower.format(r"regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's')")} AS host,
                 regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM a),
    c AS (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {said} END AS said,
                 {strict} AS n_strict, {soft} AS n_soft, {weight} AS soft_weight FROM b)
    SELECT page_id, host, path, rule,
           coalesce(said, CASE WHEN n_strict > 0 OR (n_soft >= 2 AND soft_weight >= 1.0) THEN 'block' ELSE 'allow' END) AS verdict,
           n_strict, n_soft, soft_weight FROM c"""


@query("op5_url_filter", _url_sql())
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


@query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def vocabulary_path(name: str) -> str:
    """A public tokenizer's file; the vocabularies are installed, not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_pieces")
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pieces.encode_decode(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_neighbours")
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_substrings")
def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_crossentropy")
def op6_crossentropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossentropy.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_line_dedup")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op1_jaccard_join")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_spellings")
def op11_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(spellings.vocabulary(table(spark, sf_dir, "documents"), slip=31))


def with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one text of ten, by the crc32 of its id, a stretch of words takes the place of what follows it.

    With h the crc32 and n words, a = h / 10 mod n, p = 1 + (n - a) / (3 + h / 10 mod 8): each word i >= a becomes word
    a + (i - a) mod p.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))).alias("words"), F.floor(h / 10).alias("g"))
    counted = chosen.select("*", F.size("words").alias("n")).select("*", F.expr("if(n > 0, int(g % n), 0)").alias("a"))
    cut = counted.select("*", F.expr("1 + (n - a) div (3 + g % 8)").cast("int").alias("p"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)")
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_cycles(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"),
        F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_license_scan")
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    named = F.array_sort(F.array_distinct(F.col("places.label")))
    told = F.array_sort(F.array_union(F.col("places.label"), F.col("matches.label")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.start")).alias("first_word"),
        F.array_max(F.col("places.start")).alias("last_word"),
        F.array_join(named, ",").alias("base_labels"),
        F.array_join(told, ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.col("matches.share")), F.lit(0.0)), F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
