"""Judge URLs by host rules first and by a weighted vocabulary otherwise.

Vocabulary terms are found in one Aho-Corasick pass over the lower-cased URL and count only between
boundaries (no ASCII letter or digit on either side). One strict term rejects; so do at least
``soft_terms`` distinct soft terms whose weights add up to ``soft_weight``.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by the
vocabulary (null: no terms, allowed). Repeated rows are judged alike; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host and path); a rule fits the host and its subdomains below that path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: One of these is enough.
STRICT = (
    "ads-track",
    "adult-x",
    "casino-win",
    "cheap-pills",
    "free-bets",
    "phishing",
    "porn",
    "spam-farm",
    "viagra",
    "xxx",
)
#: Several of these are needed; the weight says how telling a term is.
SOFT = {
    "adult": 1.0,
    "ads": 0.5,
    "bets": 1.0,
    "betting": 1.0,
    "casino": 1.5,
    "cheap": 0.5,
    "farm": 0.5,
    "free": 0.5,
    "loans": 0.5,
    "pills": 1.0,
    "poker": 1.0,
    "slots": 1.0,
    "spam": 1.0,
    "track": 0.5,
    "win": 0.5,
}


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null without one."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _terms(strict: Sequence[str], soft: dict[str, float]):
    """A column function: distinct strict terms, distinct soft terms, weight of the soft ones."""
    machine = None

    def matcher():
        nonlocal machine
        if machine is None:
            machine = ahocorasick.Automaton()
            for term in (*strict, *soft):
                machine.add_word(term, term)
            machine.make_automaton()
        return machine

    def edge(text: str, at: int) -> bool:
        return not (0 <= at < len(text) and text[at].isascii() and text[at].isalnum())

    @F.pandas_udf("n_strict long, n_soft long, soft_weight double")
    def count(urls: pd.Series) -> pd.DataFrame:
        find, rows = matcher(), []
        for url in urls:
            hits = {t for end, t in find.iter(url) if edge(url, end + 1) and edge(url, end - len(t))} if url else set()
            weights = [soft[t] for t in hits if t in soft]
            rows.append((len(hits) - len(weights), len(weights), float(sum(sorted(weights)))))
        return pd.DataFrame(rows, columns=["n_strict", "n_soft", "soft_weight"])

    return count


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: dict[str, float] = SOFT,
    soft_terms: int = 2,
    soft_weight: float = 1.0,
) -> DataFrame:
    host, path = split_url(F.col(url_col))
    base = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), ascii_lower(F.coalesce(F.col(url_col), F.lit(""))).alias("_url"))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    counted = base.select(id_col, "host", "path", rule.alias("rule"), said.alias("_said"), _terms(strict, soft)("_url").alias("_t"))
    rejected = (F.col("_t.n_strict") > 0) | ((F.col("_t.n_soft") >= soft_terms) & (F.col("_t.soft_weight") >= soft_weight))
    return counted.select(
        id_col,
        "host",
        "path",
        "rule",
        F.coalesce("_said", F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "_t.n_strict",
        "_t.n_soft",
        "_t.soft_weight",
    )
