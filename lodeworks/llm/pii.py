"""Find personal data by weak supervision.

Strict patterns give base spans, which always stay. Looser patterns propose further candidates. Five
labelers (shape, validity, cue words, neighbouring characters, company in the same text) vote for,
against or not at all on every candidate of either sort. Expectation-maximisation over the counted
vote patterns estimates how reliable each labeler is; the posteriors train a logistic classifier on
kind and votes, and extra candidates that it accepts become spans.

Only counts of vote patterns reach the driver (at most 5 kinds x 3^5 patterns). Offsets are code
points, ends exclusive. A null or empty text has no spans; repeated rows are treated alike; other
input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.session import work_path

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
LABELERS = 5

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"[\[(]at[\])]", re.I)
_SPELLED_LEFT = re.compile(r"([A-Za-z0-9._%+-]{1,64})\s?\Z")
_SPELLED_RIGHT = re.compile(r"\s?([A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[(]dot[\])]\s?)[A-Za-z0-9-]{1,63})+)", re.I)
_KEY = re.compile(r"(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}\Z", re.I)
_VALUE = re.compile(r"\s{0,3}[\"']?([A-Za-z0-9_/+-]{16,})")

#: Words that announce a kind of data a few characters ahead.
CUES = {
    EMAIL: re.compile(r"mail|contact|write|address", re.I),
    IP: re.compile(r"\bip\b|host|server|addr|login", re.I),
    CARD: re.compile(r"card|visa|master|amex|credit|payment|iban|account", re.I),
    PHONE: re.compile(r"phone|\btel|call|fax|mobile|cell|contact|dial", re.I),
    SECRET: re.compile(r"token|secret|key|passw", re.I),
}
#: Words that announce numbers of another sort.
AGAINST = re.compile(r"isbn|order|invoice|version|page|serial|part|item|ref|no\.|#", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def base_and_loose(text: str) -> tuple[list, list]:
    """(start, kind, end) of the strict patterns, and of looser candidates."""
    base, loose = [], []
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > behind and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            base.append((start, EMAIL, found.end()))
            behind = found.end()
        at = text.find("@", max(at + 1, behind))
    runs = [m.span() for m in _DIGITS.finditer(text)]
    k = 0
    while k + 3 < len(runs):
        four = runs[k : k + 4]
        if all(four[i + 1][0] - four[i][1] == 1 and text[four[i][1]] == "." for i in range(3)):
            (base if all(_small(text[s:e]) for s, e in four) else loose).append((four[0][0], IP, four[3][1]))
            k += 4
        else:
            k += 1
    k = 0
    while k < len(runs):
        j = k
        while j + 1 < len(runs) and runs[j + 1][0] - runs[j][1] == 1 and text[runs[j][1]] in " -":
            j += 1
        count = sum(e - s for s, e in runs[k : j + 1])
        if 12 <= count <= 19:
            good = _luhn("".join(text[s:e] for s, e in runs[k : j + 1]))
            (base if good else loose).append((runs[k][0], CARD, runs[j][1]))
        k = j + 1
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            base.append((m.start(), PHONE, m.end()))
    for k in range(len(runs) - 2):
        (a, b), (c, d), (e, f) = runs[k : k + 3]
        if (b - a, d - c, f - e) == (3, 3, 4) and 1 <= c - b <= 2 and e - d == 1 and text[d] in " .-" and set(text[b:c]) <= set(" .-)"):
            loose.append((a - (a > 0 and text[a - 1] == "("), PHONE, f))
    for m in _SPELLED.finditer(text):
        left = _SPELLED_LEFT.search(text[max(0, m.start() - 66) : m.start()])
        right = _SPELLED_RIGHT.match(text, m.end())
        if left and right:
            loose.append((m.start() - len(left.group()), EMAIL, right.end()))
    at = text.find("=")
    while at >= 0:
        value = _VALUE.match(text, at + 1)
        if value and _KEY.search(text[max(0, at - 24) : at]):
            loose.append((value.start(1), SECRET, value.end(1)))
        at = text.find("=", value.end() if value else at + 1)
    base.sort()
    return base, _apart(sorted(loose), base)


def _apart(loose: list, base: list) -> list:
    """Candidates that touch neither a base span nor an earlier candidate."""
    out, k, behind = [], 0, -1
    for span in loose:
        while k < len(base) and base[k][2] <= span[0]:
            k += 1
        # A base span further on may start later and still be shorter than one before it.
        if span[0] >= behind and not any(b[0] < span[2] and span[0] < b[2] for b in base[max(0, k - 4) : k + 5]):
            out.append(span)
            behind = span[2]
    return out


def votes(text: str, span: tuple, company: int) -> int:
    """The labelers' votes (0 against, 1 none, 2 for) as one number in base 3."""
    start, kind, end = span
    body, before = text[start:end], text[max(0, start - 24) : start]
    digits = [c for c in body if c.isdigit()]
    if kind == EMAIL:
        shape, valid = "@" in body, body.rpartition(".")[2].strip(" )]").isalpha()
    elif kind == IP:
        shape, valid = len(body) >= 7, all(_small(p) for p in body.split("."))
    elif kind == CARD:
        shape, valid = len(digits) in (15, 16), _luhn("".join(digits))
    elif kind == PHONE:
        shape, valid = body[0] in "+(", 9 <= len(digits) <= 15
    else:
        shape, valid = len(body) >= 20, bool(digits) and len(digits) < len(body)
    cue = 2 if CUES[kind].search(before) else 0 if AGAINST.search(before) else 1
    left, right = text[start - 1 : start], text[end : end + 1]
    clean = not (left.isalnum() or right.isalnum() or left in "_/" and left or right in "_/" and right)
    code = 0
    for vote in (2 * shape, 2 * valid, cue, 2 * clean, 2 if company > 1 else 1):
        code = code * 3 + int(vote)
    return code


_SPAN = "array<struct<start:int,kind:int,end:int,code:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("code", pa.int32())]))
    for batch in batches:
        strict, extra, digest = [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base, loose = base_and_loose(text)
            n = len(base) + len(loose)
            digest.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest())
            for out, spans in ((strict, base), (extra, loose)):
                out.append([{"start": s, "kind": k, "end": e, "code": votes(text, (s, k, e), n)} for s, k, e in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(strict, span), pa.array(extra, span), pa.array(digest, pa.string())],
            ["id", "base", "extra", "base_sha256"],
        )


def reliabilities(counts: np.ndarray, seen: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior that a pattern is a true case, by EM over (patterns x labelers) votes 0, 1, 2.

    Each labeler has its own chance of each vote for true and for false cases.
    """
    truth = 0.1 + 0.8 * (counts.mean(axis=1) / 2)
    for _ in range(rounds):
        chance = np.empty((2, counts.shape[1], 3))
        for side, weight in enumerate((1 - truth, truth)):
            for v in range(3):
                chance[side, :, v] = ((counts == v) * (weight * seen)[:, None]).sum(axis=0) + 1.0
            chance[side] /= chance[side].sum(axis=1, keepdims=True)
        prior = ((truth * seen).sum() + 1) / (seen.sum() + 2)
        columns = np.arange(counts.shape[1])
        logs = [np.log(chance[side, columns[None, :], counts]).sum(axis=1) for side in (0, 1)]
        odds = np.log(prior / (1 - prior)) + logs[1] - logs[0]
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return truth


def classify(rows: list[tuple[int, int, int]], accept: float) -> list[int]:
    """Codes (kind * 3^LABELERS + votes) that the trained classifier accepts; rows: kind, votes, count."""
    if not rows:
        return []
    rows = sorted(rows)
    kinds, codes = np.asarray([r[0] for r in rows]), np.asarray([r[1] for r in rows])
    seen = np.asarray([r[2] for r in rows], float)
    digits = (codes[:, None] // 3 ** np.arange(LABELERS - 1, -1, -1)) % 3
    truth = reliabilities(digits, seen)
    x = np.column_stack([np.eye(len(KINDS))[kinds], (digits == 2), (digits == 0)]).astype(float)
    w = np.zeros(x.shape[1])
    share = seen / seen.sum()
    for _ in range(50):  # Newton steps of a ridge logistic fit on soft targets
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (truth - p)) - 1e-3 * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return [int(k * 3**LABELERS + c) for k, c, q in zip(kinds, codes, p, strict=True) if q >= accept]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.9) -> DataFrame:
    """One row per input row: counts of base spans per kind, their digest, and all spans."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    path = work_path(spark, "pii")
    scanned = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _scan, f"id {kind}, base {_SPAN}, extra {_SPAN}, base_sha256 string"
    )
    scanned.write.parquet(path)
    found = spark.read.parquet(path)
    patterns = (
        found.select(F.explode(F.concat("base", "extra")).alias("s"))
        .groupBy("s.kind", "s.code")
        .count()
        .collect()
    )
    taken = classify([(r["kind"], r["code"], r["count"]) for r in patterns], accept)
    chosen = F.array(*map(F.lit, taken)) if taken else F.array().cast("array<int>")
    extra = F.filter("extra", lambda s: F.array_contains(chosen, s["kind"] * 3**LABELERS + s["code"]))
    names = F.array(*map(F.lit, KINDS))

    def of_kind(k: int):
        return lambda s: s["kind"] == k

    text = F.transform(
        F.array_sort(F.concat("base", extra)),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return found.select(
        F.col("id").alias(id_col),
        *(F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
        F.size(extra).cast("long").alias("n_added"),
    )
