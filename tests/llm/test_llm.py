"""The training-data operators against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from curate.llm import chaining, decontaminate, exactdedup, jaccard, langid, lmscore, mixing, suffixdedup, toxicity, urlfilter

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, score double, kept string"


def corpus(seed: int = 3, n: int = 60) -> list[tuple]:
    """Random texts with exact and near copies, a shared passage, periodic, null, empty and repeated rows."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    texts: list[str | None] = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        if i % 7 == 3:
            words[len(words) // 2:len(words) // 2] = passage.split()
        text = " ".join(words)
        if i % 5 == 4 and texts[i - 3]:
            own = texts[i - 3].split()
            own[rng.randrange(len(own))] = "NEW"
            text = " ".join(own)
        if i % 11 == 10:
            text = texts[i - 4]
        texts.append(text)
    texts += [None, "", " \t\n ", "one", "one", "Ab " * 200, "x" * 5000, passage.replace(" ", "\n")]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["b", "a", "c", None]), len(t or ""), 1, 0.5, "x") for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[5]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("depth", [100, 40])
def test_suffix_dedup_equals_brute_force(docs, depth):
    seen: dict[bytes, tuple] = {}
    distinct = {(r.doc_id, r.text): r for r in docs.collect()}
    want = {}
    for doc_id, text in sorted(distinct, key=lambda k: k[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - depth + 1):
            if raw[k:k + depth] in seen:
                gone[k:k + depth] = b"\1" * depth
            else:
                seen[raw[k:k + depth]] = (doc_id, k)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want[doc_id] = (len(raw), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = rows_of(suffixdedup.suffix_dedup(docs, depth), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted((r.doc_id, *want[r.doc_id]) for r in docs.collect())
    assert any(r[2] for r in got)


def _components(texts: dict[int, str | None], size: int, num: int, den: int) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("size,threshold", [(4, (85, 100)), (5, (80, 100))])
def test_jaccard_components_equal_brute_force(docs, size, threshold):
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = _components(texts, size, *threshold)
    got = rows_of(jaccard.components(docs, size, threshold), "doc_id", "component_id")
    assert got == sorted((r.doc_id, want[r.doc_id]) for r in docs.collect())
    assert len(set(want.values())) < len(want)


def test_jaccard_families_around_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "TREE", 3)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    texts = {}
    for i in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(80)] = f"e{rng.randrange(25)}"
        texts[i] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert dict(rows_of(jaccard.components(df, 4, (85, 100)), "doc_id", "component_id")) == _components(texts, 4, 85, 100)


def test_prefix_tree_probe():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 200, 60)).astype(np.uint64) for _ in range(30)]
    sets += [np.unique(np.append(s[2:], [500, 501])).astype(np.uint64) for s in sets[:10]]
    tree = jaccard.PrefixTree(list(enumerate(sets)))
    for s in sets:
        want = {i for i, x in enumerate(sets) if 100 * len(np.intersect1d(s, x)) >= 80 * len(np.union1d(s, x))}
        assert set(tree.probe(s, 80, 100)) == want


def test_fm_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    seq = rng.integers(0, 4, 400)
    seq[0] = seq[-1] = 0
    index = decontaminate.FMIndex(seq, 3)
    for size in (1, 2, 5):
        phrases = np.array([rng.integers(1, 4, size) for _ in range(40)])
        found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(*index.search(phrases))}
        for k, p in enumerate(phrases):
            assert found.get(k, []) == [i for i in range(len(seq) - size + 1) if (seq[i:i + size] == p).all()]


@pytest.mark.parametrize("block", [200_000, 20])
def test_decontamination_equals_brute_force(spark, docs, block):
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(1, " ".join(texts[3].split()[5:40]).upper()), (2, "one"), (3, None), (4, "!!"), (None, " ".join(texts[7].split()[:12])), (10, texts[8]), (1, "one")]
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: find.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    grams: dict[tuple, set] = {}
    for item, text in items:
        w = low(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            grams.setdefault(tuple(w[k:k + 10]), set()).add(item)
    found = decontaminate.find_phrases(spark, docs, spark.createDataFrame(items, "item_id bigint, text string"), block=block)
    assert found.filter("n_hit > 0").count()
    for r in found.collect():
        w, hit, own = low(r.text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    own |= {str(x) for x in grams[tuple(w[k:k + n])] if x is not None}
        assert (r.n_words, r.n_hit, r["items"]) == (len(w), len(hit), sorted(own))
    clean = {r.doc_id: r.text for r in decontaminate.remove_spans(found).collect()}
    assert all(clean[r.doc_id] == r.text for r in found.collect() if not r.n_hit)


def test_fuse_filter_has_no_false_negative():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 20_000):
        keys = rng.integers(-(1 << 62), 1 << 62, n)
        own = exactdedup.FuseFilter.load(**exactdedup.FuseFilter(keys).dump())
        assert own.contains(keys).all()
        assert own.contains(rng.integers(-(1 << 62), 1 << 62, 50_000)).mean() < 1e-3


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_dedup(docs, batches):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = docs.collect()
    groups: dict[str, list[int]] = {}
    for r in rows:
        groups.setdefault(norm(r.text), []).append(r.doc_id)
    got = exactdedup.exact_dedup(docs, batches).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((r.doc_id, min(groups[norm(r.text)]), len(groups[norm(r.text)])) for r in rows)
    assert sorted(r.keep_id for r in got if r.kept) == sorted(min(g) for g in groups.values())
    kept = exactdedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(norm(r.text) for r in kept.collect()) == sorted(groups)


def test_knapsack_is_optimal():
    rng = random.Random(4)
    for _ in range(60):
        lengths, counts = [rng.randint(1, 30) for _ in range(5)], [rng.randint(0, 4) for _ in range(5)]
        budget = rng.randint(1, 150)
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        taken = mixing.knapsack(np.array(lengths), np.array(counts), budget)
        assert (taken <= counts).all() and int((taken * lengths).sum()) == max(s for s in sums if s <= budget)


def test_mixing(docs):
    first, again = (rows_of(mixing.mix_sources(docs.repartition(n)).fillna("-", "source"), "source", "doc_id", "size", "source_size", "target", "copies", "taken") for n in (1, 5))
    assert first == again and len(first) == docs.count()
    by: dict[str, list] = {}
    for r in first:
        by.setdefault(r[0], []).append(r)
    for own in by.values():
        assert abs(sum(r[6] for r in own) - own[0][4]) <= 2 and max(r[5] for r in own) <= 3
        assert sum(r[2] for r in own) == own[0][3]
    total = sum(r[2] for r in first)
    assert math.isclose(sum(own[0][4] for own in by.values()), total)
    sizes, weight = {s: own[0][3] for s, own in by.items()}, dict(zip(sorted(s for s in by if s != "-"), (1, 2, 3)))
    weight["-"] = (1, 2, 3)[len(weight) % 3]
    free, left, want = set(by), float(total), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        want.update({s: 3.0 * sizes[s] for s in over} if over else {s: unit * weight[s] for s in free})
        left -= sum(want[s] for s in over)
        free = free - over if over else set()
    assert all(math.isclose(by[s][0][4], want[s]) for s in by)


def test_language_id(spark, docs):
    english, german = "the of and with that is was on this from ", "der die und mit das ist war auf dies von "
    rng = random.Random(0)
    train = [(i, " ".join(rng.sample((english if i % 2 else german).split(), 8)), "en" if i % 2 else "de") for i in range(60)]
    learned = langid.learn(spark.createDataFrame([*train, (99, None, "xx"), (98, "abc", None)], "doc_id bigint, text string, lang string"))
    assert list(learned) == ["de", "en"]
    asked = spark.createDataFrame([(1, english * 9, 0.1), (2, german.upper() * 9, 0.2), (3, None, 0.3), (4, "12 !? \u200b", 0.4), (5, english * 2000, None)], "doc_id bigint, text string, score double")
    got = {r.doc_id: r for r in langid.identify(spark, asked, learned).collect()}
    assert {k: r.lang_pred for k, r in got.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "en"}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(spark, docs, {}).collect()} == {"und"}


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(6)
    clean = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        if i % 6 == 0:
            words[rng.randrange(len(words))] = rng.choice(["idiot", f"vileness{i}"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(i % 6 == 0)))
    df = spark.createDataFrame([*rows, (901, None, None), (902, "", "de"), (903, "a " * 20_000, "en")], "doc_id bigint, text string, lang string")
    known = spark.createDataFrame([x for x in labels if x[0] % 4] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(spark, df, toxicity.fit(df, known)).collect()}
    held = [(got[i], y) for i, y in labels if i % 4 == 0]
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(s >= toxicity.CUT) == y for s, y in held]) > 0.95
    none = toxicity.fit(df, known.limit(0))
    assert all(r.score < toxicity.CUT for r in toxicity.score(spark, df, none).collect())


def test_url_rules(spark):
    urls = {"http://A.Example.NET/en/x?q": ("a.example.net", "/en/x", "example.net/en/", "allow"), "https://b.net/": ("b.net", "/", "net/", "block"),
            "x://example.com/de/1#f": ("example.com", "/de/1", "example.com/de/", "block"), "http://sub.org/fr/": ("sub.org", "/fr/", "org/fr/", "allow"),
            "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"), "no-scheme.net/en/": ("", "", None, None), None: ("", "", None, None),
            "http://com.de?x=1": ("com.de", "", None, None), "http://n.net": ("n.net", "", None, None), "": ("", "", None, None)}
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    for r in urlfilter.judge(pages).collect():
        host, path, rule, verdict = list(urls.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_lm_base_equals_brute_force(spark, docs):
    df = docs.selectExpr("doc_id", "text", "crc32(cast(doc_id as string)) % 10 = 0 as held_out")
    counts, end = Counter(), object()
    for r in df.collect():
        if not r.held_out:
            counts.update([*(r.text or "").encode().lower().split(), end])
    total, size = sum(counts.values()), len(counts)
    got = lmscore.score_texts(spark, df).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    assert len(got) == df.count()
    for r in got:
        tokens = [*(texts[r.doc_id] or "").encode().lower().split(), end]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (size + 1))) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)


def test_windows_score_each_token_once():
    count = np.array([1, 5, 32, 33, 61, 300])
    ids = np.arange(count.sum(), dtype=np.int32)
    inputs, targets, scored, _ = lmscore.windows_of(ids, count, -1)
    assert sorted(targets[scored].tolist()) == ids.tolist()
    assert (inputs[scored][1:] < targets[scored][1:]).all()


def test_chain_and_align():
    x = np.arange(200, dtype=np.uint32)
    y = np.concatenate((x[:60], [900, 901], x[62:120], x[125:200])).astype(np.uint32)
    a = np.array([0, 10, 30, 70, 90, 130, 170])
    b = np.array([0, 10, 30, 70, 90, 125, 165])
    own = chaining.chain(chaining.blocks(a, b, 6, 40), 40)
    assert len(own) == 1
    sa, ea, sb, eb, matches = chaining.align(x, y, own[0])
    assert (sa, ea, sb, eb) == (0, 200, 0, 195) and matches == 193
    assert chaining.edit_matches(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2


def test_chain_predecessor_within_gap():
    parts = [(0, 0, 300), (500, 500, 20), (521, 522, 25)]
    assert sorted(chaining.chain(parts, 40)) == [[parts[0]], parts[1:]]
    rng = random.Random(5)
    for _ in range(40):
        parts = sorted({(rng.randrange(300), rng.randrange(300), rng.randint(1, 30)) for _ in range(rng.randint(2, 25))})
        best: list[float] = []
        for a, b, n in parts:  # the best predecessor by brute force
            near = [best[y] - 0.05 * (a - p - m + b - q - m) for y, (p, q, m) in enumerate(parts[:len(best)]) if 0 <= a - p - m <= 40 and 0 <= b - q - m <= 40]
            best.append(n + max([0.0, *near]))
        top = chaining.chain(parts, 40)[0]
        gaps = sum(y[0] - x[0] - x[2] + y[1] - x[1] - x[2] for x, y in zip(top, top[1:]))
        assert math.isclose(sum(p[2] for p in top) - 0.05 * gaps, max(best))


def test_passages_through_differing_words(spark):
    rng = random.Random(8)
    word = lambda n, tag: [f"{tag}{rng.randrange(10 ** 9)}" for _ in range(n)]
    x = np.arange(60, dtype=np.uint32)
    y = x.copy()
    y[[8, 52]] = 999
    assert [p[:5] for p in chaining.passages(x, y, [(20, 20, 17)], 50, 0.8)] == [(0, 60, 0, 60, 58)]
    # exact words that a bad gap chains together stay passages of their own
    y = np.concatenate((x, np.arange(500, 530), x + 100)).astype(np.uint32)
    z = np.concatenate((x, np.arange(700, 730), x + 100)).astype(np.uint32)
    assert [p[:2] for p in chaining.passages(y, z, [(5, 5, 40), (95, 95, 40)], 50, 0.8)] == [(0, 60), (90, 150)]
    # a word changed every eighth leaves one sampled 6-mer or two
    rows, n = [], 40
    for i in range(n):
        own = word(64, "p")
        rows.append((i, " ".join([*word(30, "a"), *own, *word(30, "b")])))
        rows.append((1000 + i, " ".join([*word(40, "c"), *(f"new{i}" if k % 8 == 7 and k < 63 else w for k, w in enumerate(own)), *word(40, "d")])))
    got = {(r.doc_id, r.ref_doc_id) for r in chaining.fuzzy_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.end_word - r.start_word >= 50}
    assert sum((1000 + i, i) in got for i in range(n)) >= 0.8 * n


def test_passage_of_frequent_lines(spark):
    """Every line of the passage, and all but a word of each of two long ones, stand in other documents before."""
    rng = random.Random(9)
    word = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    texts: list[list[str]] = []
    for length in [(20, 20, 20)] * 12 + [(49, 1)] * 6 + [(1, 49)] * 6 + [(30, 30)] * 6:
        lines = [word(n) for n in length]
        texts += [[*word(30), *line, *word(30)] for line in lines]
        both = [w for line in lines for w in line]
        texts += [[*word(30), *both, *word(30)], [*word(30), *both, *word(30)]]
    wanted, seen = set(), {}
    for i, own in enumerate(texts):
        for at in range(len(own) - 49):
            if seen.setdefault(tuple(own[at:at + 50]), i) < i:
                wanted.add((i, at))
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = chaining.fuzzy_passages(df).collect()
    missed = {(i, at) for i, at in wanted if not any(r.doc_id == i and r.start_word <= at and r.end_word >= at + 50 for r in rows)}
    assert wanted and not missed


def test_passage_repeated_in_one_document(spark):
    rng = random.Random(10)
    word = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    passage = word(70)
    once = [*word(200), *passage, *word(50)]
    near = [f"new{i}" if i % 12 == 11 and i < 69 else w for i, w in enumerate(passage)]
    twice = [*word(100), *passage, *word(830), *near, *word(20)]
    df = spark.createDataFrame([(1, " ".join(once)), (2, " ".join(twice))], "doc_id bigint, text string")
    got = {(r.doc_id, r.start_word, r.end_word, r.ref_start) for r in chaining.fuzzy_passages(df).collect()}
    assert got == {(2, 100, 170, 200), (2, 1000, 1070, 200)}


def test_fuzzy_passages(docs, empty):
    texts = {r.doc_id: (r.text or "").lower().split() for r in docs.collect()}
    got = chaining.fuzzy_passages(docs).collect()
    cover: dict[int, list] = {}
    for r in got:
        assert r.ref_doc_id < r.doc_id and r.end_word - r.start_word >= 50 and 0.8 <= r.identity <= 1
        cover.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    holders = [i for i in range(60) if i % 7 == 3 and len(texts[i]) > 71]
    assert all(i in cover for i in holders[1:])
    assert chaining.fuzzy_passages(empty).count() == 0


def test_empty_tables(spark, empty):
    assert suffixdedup.suffix_dedup(empty).count() == 0
    assert jaccard.components(empty).count() == 0
    assert exactdedup.exact_dedup(empty).count() == 0
    assert mixing.mix_sources(empty).count() == 0
    assert langid.identify(spark, empty, langid.learn(empty)).count() == 0
    assert decontaminate.find_phrases(spark, empty, spark.createDataFrame([], "item_id bigint, text string")).count() == 0
    assert lmscore.score_texts(spark, empty.selectExpr("doc_id", "text", "false as held_out")).count() == 0


def test_null_ids(spark):
    text = "some words that stand here twice " * 9
    df = spark.createDataFrame([(None, text), (4, text), (None, None), (7, None)], "doc_id bigint, text string")
    got = {(r.doc_id, r.n_removed > 0) for r in suffixdedup.suffix_dedup(df).collect()}
    assert (None, True) in got and (7, False) in got
    assert {r.component_id for r in jaccard.components(df).filter("n_shingles > 0").collect()} == {4}
    assert {(r.doc_id, r.keep_id) for r in exactdedup.exact_dedup(df).collect()} == {(None, 4), (4, 4), (None, 7), (7, 7)}
    assert mixing.mix_sources(df.withColumn("source", df["text"])).count() == 4


def test_null_and_repeated_ids_in_stages(spark):
    import corpus_pipeline

    rng = random.Random(12)
    text = lambda: [f"w{rng.randrange(10 ** 9)}" for _ in range(80)]
    near, null, one, two, alone = text(), text(), text(), text(), text()
    changed = lambda words: [*words[:-1], "other"]
    rows = [(9, near), (3, changed(near)), (None, null), (None, changed(null)), (5, one), (5, two), (None, alone), (6, changed(alone))]
    df = spark.createDataFrame([(i, " ".join(w), "en", "web", 1) for i, w in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text.split()) for r in corpus_pipeline.near_dedup(spark, df, "").collect()]
    assert len(kept) == 5 and [w for i, w in kept if i is None] in ([null], [changed(null)])
    assert (3, changed(near)) in kept and (5, one) in kept and (5, two) in kept and (6, changed(alone)) in kept
    mixed = corpus_pipeline.mixing_sources(spark, df, "").collect()
    taken = Counter((r.doc_id, r.text, r.copy) for r in mixed)
    assert max(taken.values()) == 1 and {(r.doc_id, r.text) for r in mixed} == {(i, " ".join(w)) for i, w in rows}
    groups = jaccard.components(df.filter("doc_id is null"), 5, (80, 100))
    assert groups.filter("n_shingles > 0").count() == 3
    pairs = jaccard._Join(df.filter("doc_id is null").select("doc_id", "text"), 5, (80, 100))
    ent = [r.entity for r in pairs.rows.collect()]
    every = spark.createDataFrame([(min(a, b), max(a, b)) for a in ent for b in ent if a < b], "a bigint, b bigint")
    assert pairs.links(every).count() == 1


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        assert after.count() <= before.count()
        before = exactdedup.materialise(after, "test")
    out = corpus_pipeline.run(spark, sf)
    assert out.count() and {r.copy for r in out.select("copy").distinct().collect()} <= {1, 2, 3}
