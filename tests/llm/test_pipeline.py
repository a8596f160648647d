"""The pipeline's stages on a small table: what goes, what stays, and the columns."""

import hashlib
import re
from pathlib import Path

import corpus_pipeline
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_operators import edits, prose

from lodeworks.llm import neighbours
from lodeworks.llm.queries import vocabulary_path

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def test_stages_keep_columns_and_never_add_rows(spark):
    from lodeworks.llm.components import stored

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, DATA), f"test-{name}")
        assert 0 < docs.count() <= n, name
        n = docs.count()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
    assert corpus_pipeline.run(spark, DATA).count() == n


def test_near_duplicate_stage_leaves_one_of_each(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(3, text), (2, text), (5, text + " more"), (7, "other words here and there"), (7, "other words here and there"), (9, None), (None, text), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, DATA).collect())
    assert got == sorted([(2, text), (7, "other words here and there"), (9, ""), (-1, text), (8, "")])


def test_line_stage_drops_documents_left_empty(spark):
    line = "a line that is long enough to be compared with others"
    docs = spark.createDataFrame([(1, line, len(line)), (2, line, len(line)), (3, "", 0), (4, None, None)], "doc_id bigint, text string, n_chars bigint")
    got = corpus_pipeline.lines(spark, docs, DATA)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4] and got.columns == docs.columns
    assert got.where(F.col("n_chars") != F.length("text")).count() == 0


def _near_groups(sets, similarity=0.8):
    """Connected components of the keys whose sets are near."""
    group = {k: {k} for k in sets}
    for a in sets:
        for b in sets:
            if a != b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    return group


def _without_near_lines(rows):
    shingle = re.compile(r"(?s)(?:^|\s)(?=(\S.{0,8}))")  # no long words, no scripts without spaces here
    places = [(i, p, x.strip(" ").lower()) for i, t in rows for p, x in enumerate(t.split("\n")) if len(x.strip(" ")) >= 20]
    group = _near_groups({n: set(shingle.findall(n)) for _, _, n in places})
    first = {}
    for i, p, n in sorted(places):
        first.setdefault(frozenset(group[n]), (i, p))
    gone = {(i, p) for i, p, n in places if first[frozenset(group[n])] != (i, p)}
    cut = [(i, "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone), any(g[0] == i for g in gone)) for i, t in rows]
    return [(i, t) for i, t, touched in cut if not touched or re.search(r"[^\x20\x09-\x0D]", t)]


def _one_of_each(rows):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in rows}
    group = _near_groups({i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items() if w})
    return [(i, t) for i, t in rows if i not in group or min(group[i]) == i]


def test_run_equals_brute_force_stage_by_stage(spark, tmp_path):
    """Lines, near duplicates, leaks and encoding are recomputed here; what the first stage keeps is what its scores say."""
    good = [prose(k, 45) + ".\n" + prose(1000 + k, 45) + "." for k in range(30)]
    items = [(k, prose(2000 + k, 20 + k)) for k in range(4)]
    rows = list(enumerate(good))
    rows += [(40 + k, good[k].replace("\n", " ")) for k in range(4)]  # the same words in other lines
    rows += [(50 + k, prose(3000 + k, 45) + "\n" + good[k + 5].split("\n")[0] + "\n" + prose(3100 + k, 30)) for k in range(4)]  # a line of another text
    rows += [(60 + k, prose(3200 + k, 30) + "\n" + " ".join([*x.split()[:-2], "edited", *x.split()[-1:]]) + "\n" + prose(3300 + k, 30)) for k, x in items]
    rows += [(70, good[9]), (71, good[8].split("\n")[0])]
    rows += [(80 + k, ("##!! 12 " * 40 + "$$ ") * 3) for k in range(12)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i, _ in rows if i % 3], "doc_id bigint, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    well = {r.doc_id for r in neighbours.score_quality(docs, labels).where("predicted = 1").collect()}
    kept = [(i, t) for i, t in rows if i in well]
    assert {i for i, _ in kept} == {i for i, _ in rows if i < 80}
    sizes = [len(kept)]
    for step in (_without_near_lines, _one_of_each, lambda x: [(i, t) for i, t in x if all(edits(w.split(), re.findall("[a-z0-9]+", t)) > len(w.split()) // 5 for _, w in items)]):
        kept = step(kept)
        sizes.append(len(kept))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[2] - 4
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {(i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in kept for ids in [library.encode(t)]}
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want
