"""Fill-in-middle against a plain form of its contract, and exact round trips."""

import hashlib
import random
import re

import pytest
from pyspark.sql import Row

from curate.llm import fim
from curate.llm.catalogue import ORACLE, QUERIES
from curate.plans.verify import compare

from conftest import SF_SMALL

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_form(doc_id, text, rate=50, spm=80, seed=42):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    out = [None, "", " ", "\t\n", "one", " one", "one ", "é　ü <P> x", "a <S>", "<M", "<", "<P <S", "x" * 300_000 + " \U0001f600 y", "a b " * 50_000]
    for _ in range(300):
        out.append("".join(rng.choice(["a", "é", "\U0001f600", " ", "\n", "\x0b", "<", "P>", " "]) for _ in range(rng.randint(0, 40))))
    return out


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 30), (0, 80)])
def test_equals_the_plain_form_and_comes_back(spark, rate, spm):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a b c"), (3, "repeated id"), (20, texts()[20]), (20, texts()[20])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fim.restore(fim.fill_in_middle(docs, rate=rate, spm=spm)).collect()
    want = [(i, t, *plain_form(i, t, rate, spm), t or "") for i, t in rows]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert rate == 0 or {r.form for r in got} == {"plain", "psm", "spm"}


def test_sentinels_at_seams():
    for text in (b"<<P", b"P><", b"<S <P", b"S>M>", b"<", b">"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                for form in ("psm", "spm"):
                    assert fim.recover(fim.arrange(text, a, b, form), form) == text


def test_rotation_exchanges_blocks():
    buf = bytearray(b"0123456789")
    fim.rotate(buf, 2, 5, 9)
    assert buf == b"0156782349"
    fim.rotate(buf, 2, 6, 9)
    assert buf == b"0123456789"


def test_empty_table_and_clashing_columns(spark):
    ddl = "doc_id bigint, text string, n string, output int, form int, `a b` int, _text int, restored int"
    assert fim.restore(fim.fill_in_middle(spark.createDataFrame([], ddl))).count() == 0
    one = fim.restore(fim.fill_in_middle(spark.createDataFrame([Row(1, "a b", "old", 3, 4, 7, 8, 9)], ddl), rate=100)).first().asDict()
    assert one["a b"] == 7 and one["n"] == 2 and one["form"] in ("psm", "spm") and one["restored"] == "a b" and one["_text"] == 8


def test_query_equals_sql(spark, duck_small):
    name = "op13_fill_in_middle"
    r = compare(spark, duck_small, name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert r["ok"], r
