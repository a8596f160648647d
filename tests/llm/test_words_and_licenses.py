"""Spelling variants, periodic runs and licence scans against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from lodeworks.llm import license_scan, periodic_runs, queries, spellings
from lodeworks.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, id string, word string, n string, runs string, places int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "clash", "clash", "clash", "clash", 1) for i, t in texts], SCHEMA).repartition(4)


def written(spark, tmp_path, texts):
    """A folder with a table of documents, as the queries read it."""
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- op11 ---


def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    if len(x) < len(y):
        x, y = y, x
    return any(x[:k] + x[k + 1 :] == y for k in range(len(x)))


def variants_of(count):
    out = {}
    for w, n in count.items():
        others = [y for y in count if near(w, y)]
        best = min(others, key=lambda y: (-count[y], y), default=None)
        out[w] = (n, len(others), best if best is not None and count[best] >= 10 * n else None)
    rows = Counter()
    for w, (n, m, form) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows[(w, n, m, form, count[form] if form else None, root)] += 1
    return rows


def vocabulary_of(texts, slip):
    count = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


@pytest.fixture(scope="module")
def spelled():
    r = random.Random(5)
    stems = ["".join(r.choice("abcé") for _ in range(r.choice([7, 8, 8, 9, 12]))) for _ in range(40)] + ["ÉCOLIERS", "mmmmmmmm", "mmmmmmmmm", "straße×maß÷x"]
    out = []
    for i in range(120):
        words = []
        for _ in range(60):
            w = r.choice(stems[: 1 + int(len(stems) * r.random() ** 3)])
            if r.random() < 0.2:
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", "a", "b", "é", w[k] * 2]) + w[k + 1 :]
            words.append(w.upper() if r.random() < 0.1 else w)
        out.append((i, "-".join(words) + "9Ω" + " ".join(words[:3])))
    long = "ab" * 2000
    out += [(None, "mmmmmmmm " * 3), (None, None), (200, ""), (200, "short ones"), (200, "one\ntwo"), (201, f"{long} {long}c {long} {long}c x{long[1:]} x{long[1:]}")]
    chain = " ".join(" ".join([w] * n) for w, n in (("vvvvvvvx", 2), ("vvvvvvxx", 20), ("vvvvvxxx", 200), ("vvvvxxxx", 2000)))
    return out + [(202, chain), out[0], out[0]]


def test_op11_is_brute_force(spark, spelled, tmp_path):
    want = variants_of(vocabulary_of(spelled, 31))
    assert max(r[2] for r in want) > 5 and sum(r[3] is not None for r in want) > 50 and any(r[5] not in (r[0], r[3]) for r in want)
    got = queries.op11_spellings(spark, written(spark, tmp_path, spelled))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert Counter(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("limit", [1, 4, 30])
def test_op11_small_partitions_lose_nothing(spark, spelled, limit):
    count = vocabulary_of(spelled, 31)
    words = spark.createDataFrame(list(count.items()), "word string, n bigint")
    got = spellings.variants(words, limit=limit)
    assert Counter(tuple(r) for r in got.collect()) == variants_of(count)


def test_op11_acceptor_is_minimal_and_pairs_are_all():
    r = random.Random(2)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(1, 8))) for _ in range(120)})
    a = spellings.Acceptor(words)
    seen, todo = [], [("", a.root, 0)]
    while todo:
        text, p, at = todo.pop()
        if a.final[p]:
            seen.append((at, text))
        todo += [(text + c, to, at + before) for c, (to, before) in a.edges[p].items()]
    assert sorted(seen) == list(enumerate(words))
    rest = {w[k:] for w in words for k in range(len(w) + 1)}
    languages = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(a.edges) == len(languages) <= len(rest)
    want = {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if i < j and near(x, y)}
    assert set(map(tuple, spellings.near_pairs(words).tolist())) == want


def test_op11_empty(spark, tmp_path):
    assert queries.op11_spellings(spark, written(spark, tmp_path, [])).count() == 0
    assert spellings.variants(spark.createDataFrame([("abcdefg", 2)], "word string, n bigint")).collect() == [("abcdefg", 2, 0, None, None, "abcdefg")]


# --- op12 ---


def planted(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    if i is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def runs_by_force(words, least=6, times=4):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        at = 0
        while at + q < n:
            to = at
            while to + q < n and words[to] == words[to + q]:
                to += 1
            length = to - at + q
            if to > at and length >= max(least, times * q):
                out.setdefault((at, length), q)  # smaller periods come first
            at = max(to, at + 1)
    return sorted((s, m, q) for (s, m), q in out.items())


def collapsed(words, runs):
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.fixture(scope="module")
def periodic():
    r = random.Random(8)
    out = [(i, " ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(1, 300)))) for i in range(150)]
    for i in range(150, 220):
        parts = []
        for _ in range(r.randrange(1, 5)):
            unit = [r.choice("abc") for _ in range(r.choice([1, 2, 3, 5, 8, 17]))]
            parts += (unit * r.randrange(2, 9))[: r.randrange(4, 90)]
        out.append((i, r.choice(["\n", " ", "\t \r"]).join(parts)))
    out += [(None, "x " * 50), (None, None), (300, ""), (300, " \n"), (301, "a"), (302, "é é é é é é"), (303, "aa " * 5), (304, "aa " * 6), (304, "aa " * 6)]
    return out + [(305, " ".join(f"t{k % 700}" for k in range(40_000))), (306, "漢 " * 9000)]


def test_op12_is_brute_force(spark, periodic, tmp_path):
    want = Counter()
    for i, t in periodic:
        words = planted(i, WORD.findall(t or ""))
        runs = runs_by_force(words) if len(words) < 9000 else {305: [(0, 40_000, 700)], 306: [(0, 9000, 1)]}[i]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        text = collapsed(words, runs) if words != WORD.findall(t or "") or runs else " ".join(words)
        want[(i, len(runs), *figures, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(text))] += 1
    assert sum(r[1] > 1 for r in want) > 20 and sum(r[1] == 0 for r in want) > 20
    got = queries.op12_periodic_runs(spark, written(spark, tmp_path, periodic))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert periodic_runs.find_runs(frame(spark, [])).count() == 0


def test_op12_planted_cycles_are_the_rule(spark, periodic):
    got = Counter((r.doc_id, tuple(WORD.findall(r.text or ""))) for r in queries.with_cycles(frame(spark, periodic)).collect())
    assert got == Counter((i, tuple(planted(i, WORD.findall(t or "")))) for i, t in periodic)


def test_op12_random_strings_of_few_letters():
    r = random.Random(1)
    for least, times in ((6, 4), (3, 3)):
        texts = ["".join(r.choice("ab") for _ in range(r.randrange(0, 60))) for _ in range(150)] + ["".join(r.choice("ab") for _ in range(4)) * 9 for _ in range(30)]
        ((_, _, w),) = slices(pa.array([" ".join(t) for t in texts]))
        start, length, period = periodic_runs.runs_of(w.hashes(), w.row, w.first[w.row + 1], least, times)
        got = [(int(row), int(s - w.first[row]), int(m), int(q)) for row, s, m, q in zip(w.row[start], start, length, period, strict=True)]
        assert got == [(k, *x) for k, t in enumerate(texts) for x in runs_by_force(list(t), least, times)]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(None, times=2)


# --- op13 ---

TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NAMES = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def tokens(text):
    return TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base_of(text):
    words = tokens(text)
    places = sorted((k, label) for name, label in NAMES.items() for k in range(len(words)) if tuple(words[k : k + len(name)]) == name)
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, labels


def noise(r, n):
    return " ".join(r.choice(["the", "of", "software", "public", "use", "license", "copy", "rights", "stone", "river", "é", "BY", "2"]) for _ in range(n))


@pytest.fixture(scope="module")
def licensed():
    r = random.Random(4)
    out = [(i, noise(r, r.randrange(0, 400))) for i in range(60)]
    for k, t in enumerate(license_scan.TEMPLATES):
        out.append((100 + k, f"{noise(r, 50)}\n// {t.text}\n{noise(r, 50)}"))
        out.append((200 + k, t.text.upper()))
        # comment signs and one inserted word far from the key phrases
        words = t.text.split(" ")
        out.append((300 + k, noise(r, 30) + " Copyright 2020 " + "\n * ".join(words)))
    out += [(None, "MIT-License, Apache\tLICENSE"), (None, None), (500, ""), (500, "cc by-cc by"), (500, "cc by-cc by"), (501, "gnu  general (public) license")]
    out += [(502, noise(r, 60_000) + " gnu general public license " + noise(r, 10)), (503, "ſ Kelvin K cc by"), (504, "漢字cc by mit licenses")]
    return out


def test_op13_base_places_and_labels(spark, licensed, tmp_path):
    got = queries.op13_license_scan(spark, written(spark, tmp_path, licensed))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = got.collect()
    assert Counter(tuple(r)[:6] for r in rows) == Counter((i, *base_of(t)) for i, t in licensed)
    for r in rows:
        base, all_labels = set(r.base_labels.split(",")), r.labels.split(",")
        assert base <= set(all_labels) | {""} and all_labels == sorted(set(all_labels)) and 0 <= r.score <= 1
        assert (r.score >= 0.5) == bool(r.labels)
        if r.doc_id is not None and 100 <= r.doc_id < 400:
            assert license_scan.TEMPLATES[r.doc_id % 100].label in all_labels
            assert r.score > 0.99
        elif not r.n_base:
            assert r.labels == ""
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0


def test_op13_matches_are_where_the_text_is(spark):
    t = license_scan.TEMPLATES[5]
    text = "river of stone " * 40 + t.text + " river of stone" * 10
    (row,) = license_scan.scan_licenses(frame(spark, [(1, text)])).collect()
    long = [m for m in row.matches if m.end - m.start == len(tokens(t.text))]
    assert [(m.label, m.start) for m in long] == [("apache", 120)]
    # without its key phrase it is no match, nor is a bag of the same words
    without = text.replace("in compliance with the License", "in keeping with the License").replace("Version 2.0", "Version 1.1")
    shuffled = tokens(t.text)
    random.Random(3).shuffle(shuffled)
    rows = license_scan.scan_licenses(frame(spark, [(1, without), (2, " ".join(shuffled))])).collect()
    assert [r.matches for r in rows] == [[], []]


def test_op13_weights_are_document_frequencies(spark, licensed):
    got = license_scan.weights(frame(spark, licensed), license_scan.TEMPLATES)
    for word in ("license", "software", "mozilla", "apache", "free"):
        seen = sum(word in tokens(t) for _, t in licensed)
        (h,) = license_scan._hashed([word])[0].tolist()
        assert got[h] == pytest.approx(np.log((len(licensed) + 2) / (seen + 1)))
