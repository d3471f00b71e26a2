"""The pipeline's stages on their own: clashing columns, empty texts, empty tables, no labelled language."""

import random

import pytest

import corpus_pipeline as P

FURTHER = "_row string, score string, margin string, size string, target string, copies string, copy string, items string, spans string, n_hit string, n_words string, _own string, _keep string, _sha string, _nth string, _text string"
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + FURTHER
NAMES = [c.split()[0] for c in FURTHER.split(", ")]


def rows(n=40, lang=True):
    rng = random.Random(8)
    vocab = {"en": ["the", "house", "with", "green", "window", "stands", "there"], "de": ["das", "haus", "mit", "grünem", "fenster", "steht", "dort"]}
    out = []
    for i in range(n):
        own = ("en", "de")[i % 2]
        text = " ".join(rng.choice(vocab[own]) + str(rng.randrange(300)) * (k % 3 == 0) for k in range(rng.randint(5, 60)))
        out.append((i, text, own if lang else None, rng.choice(["a", "b", None]), len(text), *(f"{c}{i}" for c in NAMES)))
    return out + [(n, "", None, "a", 0, *(f"{c}{n}" for c in NAMES)), (n + 1, None, None, None, None, *(f"{c}{n + 1}" for c in NAMES)), (n + 2, out[3][1], "en", "b", 5, *(f"{c}{n + 2}" for c in NAMES))]


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("bench"))
    spark.createDataFrame([("x", "nothing of this is in any document at all here we say")], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_further_columns_keep_their_values(spark, bench, name):
    docs = spark.createDataFrame(rows(), DDL)
    out = dict(P.STAGES)[name](spark, docs, bench)
    last = name == P.STAGES[-1][0]
    own = {"size", "target", "copy"} if last else set()
    assert set(out.columns) == {*docs.columns, *own} and len(out.columns) == len(set(out.columns))
    got = out.collect()
    assert got
    for r in got:
        assert all(r[c] == f"{c}{r.doc_id}" for c in NAMES if c not in own)
    if last:
        assert all(isinstance(r["size"], int) for r in got)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_empty_texts_and_tables(spark, bench, name):
    stage = dict(P.STAGES)[name]
    docs = spark.createDataFrame(rows(), DDL).select(*P.COLUMNS)
    assert stage(spark, docs.limit(0), bench).count() == 0
    kept = {r.doc_id for r in stage(spark, docs, bench).collect()}
    if name == "language_id":
        assert not kept & {40, 41}
    elif name == "exact_dedup":
        assert kept == set(range(41))                         # null counts as empty, and 42 is a copy of 3
    elif name == "decontamination":
        assert kept == set(range(43))
    elif name == "near_dedup":
        assert {40, 41} <= kept and 42 not in kept            # without words nothing is a near copy


def test_no_labelled_language(spark, bench):
    docs = spark.createDataFrame(rows(lang=False), DDL).select(*P.COLUMNS).where("doc_id <> 42")
    assert {r.doc_id for r in P.language_id(spark, docs, bench).collect()} == set(range(40))
