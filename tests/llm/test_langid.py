"""Language ID: the sample reads whole texts of every language, sizes are zstandard's own, margins at every length."""

import random

import zstandard
from pyspark.sql import functions as F

from curate.llm import langid


def test_excerpts_come_from_the_whole_text(spark):
    head = "same header words for every text " * 20
    rng = random.Random(4)
    rows = [(f"l{k % 2}", head + " ".join(rng.choice(["uvx", "wyz"] if k % 2 else ["abc", "def"]) for _ in range(2_000))) for k in range(60)]
    learned = langid.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert b"uvx" in learned["l1"] and b"abc" in learned["l0"] and b"abc" not in learned["l1"]
    again = langid.learn(spark.createDataFrame(rows + rows[:30] * 5, "lang string, text string").repartition(7))
    assert again == learned                                     # repeated rows and partitioning change nothing


def test_every_language_is_learnt(spark):
    n = 300
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}q" for k in range(n)]
    train = [(w, " ".join([w] * 12 + [f"{w}x{w}"] * 4)) for w in words] + [("none", "12 34"), ("null", None), (None, "abc")]
    learned = langid.learn(spark.createDataFrame(train, "lang string, text string"))
    assert set(learned) == {*words, "none"} and learned["none"] == b""
    asked = spark.createDataFrame([(w, " ".join([w, f"{w}x{w}"] * 5)) for w in words[::30]], "own string, text string")
    assert all(r.own == r.lang_pred for r in langid.identify(spark, asked, learned).collect())


def test_dictionaries_share_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL_BYTES", 3 * langid.SAMPLE_CHARS)
    rows = [(lang, f"{lang} word{k} " * 30) for lang in "abc" for k in range(40)]
    learned = langid.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert len(learned) == 3 and all(0 < len(v) <= langid.SAMPLE_CHARS for v in learned.values())


def test_sizes_against_plain_zstandard(spark):
    rng = random.Random(5)
    sample = {lang: " ".join("".join(rng.choice(own) for _ in range(5)) for _ in range(2_000)).encode() for lang, own in (("x", "abcdef"), ("y", "uvwxyz"))}
    rows = [(k, " ".join("".join(rng.choice("abcdef" if k % 2 else "uvwxyz") for _ in range(5)) for _ in range(rng.choice([3, 40, 4_000])))) for k in range(24)]
    got = {r.k: r for r in langid.identify(spark, spark.createDataFrame(rows, "k int, text string"), sample).collect()}

    def size(text, lang):
        held = zstandard.ZstdCompressionDict(sample[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=langid.LEVEL)
        own = zstandard.ZstdCompressor(dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
        raw = text.encode()
        return sum(len(own.compress(raw[i:i + langid.PIECE])) for i in range(0, len(raw), langid.PIECE))

    for k, text in rows:
        x, y = size(text, "x"), size(text, "y")
        if x != y:
            best, second = sorted((x, y))
            assert got[k].lang_pred == ("x" if x < y else "y")
            assert abs(got[k].score - second / (best + second)) < 1e-12 and abs(got[k].margin - (1 - best / second)) < 1e-12
        else:                                                   # the finer compression tells, then the name
            x, y = langid.Compressors(sample, fine=True).sizes(f"{text} {text}".encode())
            assert got[k].lang_pred == ("x" if x <= y else "y")


def test_narrow_margins_go_at_any_length(spark):
    same = {"x": b"one two three", "y": b"one two three"}
    docs = spark.createDataFrame([("short one",), ("one two three " * 100,)], "text string")
    found = langid.identify(spark, docs, same)
    assert found.filter(~langid.rejected()).count() == 0
    assert found.select(F.max("margin")).first()[0] == 0
