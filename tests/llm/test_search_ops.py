"""FM-index decontamination, lexical ranking and spelling variants against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lodewatch.llm import fm_decontam, lexical_blas, spelling_trie

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


# --- decontamination ---------------------------------------------------------------------------------


def test_suffix_order_equals_sorting():
    rng = random.Random(1)
    for top in (1, 2, 5, 3000):
        symbols = np.array([rng.randrange(top) for _ in range(400)], np.int32)
        want = sorted(range(400), key=lambda i: symbols[i:].tolist())
        assert fm_decontam.suffix_order(symbols).tolist() == want
    same = np.zeros(1000, np.int32)
    assert fm_decontam.suffix_order(same).tolist() == list(range(999, -1, -1))


def test_index_finds_and_locates_every_occurrence():
    rng = random.Random(2)
    symbols = np.array([rng.randrange(1, 5) for _ in range(700)] + [0], np.int32)
    index = fm_decontam.FmIndex(len(symbols), *fm_decontam.FmIndex.made(symbols, np.arange(len(symbols)) % 7 == 0))
    phrases = np.array([[rng.randrange(1, 5) for _ in range(4)] for _ in range(60)])
    lengths = np.array([rng.randrange(1, 5) for _ in range(60)])
    which, low, high = index.search(phrases, lengths)
    found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
    for p, n in enumerate(lengths):
        want = [i for i in range(len(symbols) - n + 1) if (symbols[i : i + n] == phrases[p, :n]).all()]
        assert found.get(p, []) == want


def plain_contamination(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            grams.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(str(f) for f in found))))
    return sorted(out, key=repr)


def contaminated_case():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本", "Ab"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(8, 40))) for i in range(12)] + [(20, "Only Three words"), (21, None), (22, ""), (23, "?!"), (0, "w1 w2 w3")]
    docs = []
    for i in range(40):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(i % 3):
            item = rng.choice(items[:12])[1].split()
            at = rng.randrange(len(item))
            parts += [" ".join(item[at : at + rng.randrange(5, 30)]).upper(), text(rng.randrange(0, 30))]
        docs.append((i, " ; ".join(parts)))
    docs += [(100, None), (100, ""), (101, "only  three\nWORDS"), (None, items[3][1]), (3, docs[5][1]), (3, docs[5][1]), (102, text(3000) + " " + items[4][1])]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"shard_words": 50, "every": 3}, {"block": 40, "shard_words": 400}])
def test_contamination_equals_brute_force(spark, options):
    docs, items = contaminated_case()
    found = fm_decontam.contamination(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, shard string"),
                                      spark.createDataFrame(items, "item_id long, text string"), **options)
    got = sorted(((r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found.collect()), key=repr)
    assert got == plain_contamination(docs, items)
    for r in found.collect():
        assert all(a["end"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in fm_decontam.contamination(docs, items).collect()] == [0]
    assert fm_decontam.contamination(docs.limit(0), items).count() == 0


def test_passages_are_removed_and_other_columns_kept(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"Before, {passage.upper()}! After.", 7, "d"), (1, "clean text", 8, "e"), (None, passage, 9, None), (2, None, 10, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans_ int, digest_ string")
    items = spark.createDataFrame([("a", passage)], "item_id string, text string")
    cleaned = fm_decontam.remove_passages(docs, items)
    assert cleaned.columns == docs.columns
    assert sorted((r["spans_"], r["text"]) for r in cleaned.collect()) == [(7, "Before, ! After."), (8, "clean text"), (9, ""), (10, None)]


# --- ranked search -----------------------------------------------------------------------------------


def plain_ranking(docs, items, top):
    held = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        terms, scored = set(words(text)), []
        for d, c, n in held:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_items": 4, "tile_docs": 7, "tile_terms": 5}, {"block_bytes": 200, "tile_docs": 64}])
def test_ranking_equals_brute_force(spark, options):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)] + ["é", "ß1"]
    text = lambda n: " ".join(rng.choice(vocabulary[: 1 + rng.randrange(len(vocabulary))]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 50))) for i in range(150)]
    docs += [(200 + i, docs[9][1]) for i in range(30)] + [(300, None), (301, "..."), (None, docs[9][1]), (9, docs[9][1]), (302, text(4000))]
    items = [(i, text(rng.randrange(1, 30)).upper()) for i in range(9)] + [(20, None), (21, ""), (22, "unknown"), (23, docs[9][1]), (0, "v0"), (0, "v0")]
    found = lexical_blas.rank_documents(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, rank int").repartition(3),
                                        spark.createDataFrame(items, "item_id long, text string"), top=6, **options)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_ranking(docs, items[:-1], 6)


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    for found in (lexical_blas.rank_documents(docs.limit(0), items), lexical_blas.rank_documents(docs, items.limit(0))):
        assert found.columns == ["item", "rank", "id", "score"] and found.count() == 0


def test_a_tile_never_passes_the_exact_range():
    weights = np.full(5000, 2**40, np.int64)
    tiles = lexical_blas.Tiles(np.zeros(5000, np.int64), np.arange(5000), weights, 1, 2048)
    assert tiles.width * 2**40 * lexical_blas.IMPACT_LIMIT < 2**53 or tiles.width == 1
    got = lexical_blas.Tiles(np.zeros(4, np.int64), np.arange(4), np.full(4, 22_000), 1, 3).scores(np.zeros(4, np.int64), np.arange(4), np.full(4, 999_999), 1)
    assert got.tolist() == [[4 * 22_000 * 999_999]]


# --- spelling variants -------------------------------------------------------------------------------


def plain_counts(docs, noise=97):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def plain_near(a, b):
    def shorter(x):
        return {x[:i] + x[i + 1 :] for i in range(len(x))}

    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and b in shorter(a) or len(b) == len(a) + 1 and a in shorter(b)


def plain_variants(docs):
    counts = plain_counts(docs)
    form, out = {}, []
    for w, n in counts.items():
        near = [x for x in counts if plain_near(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
        out.append((w, n, len(near), form[w], counts[form[w]] if form[w] else None))
    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, n, k, f, m, root(w)) for w, n, k, f, m in out)


def spelled_case():
    rng = random.Random(5)
    base = ["".join(rng.choice("aeinrstàÿ") for _ in range(rng.randrange(4, 11))) for _ in range(60)]
    docs = []
    for i in range(120):
        chosen = []
        for _ in range(rng.randrange(0, 90)):
            w = rng.choice(base[: 1 + rng.randrange(60)])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("aeiß") + w[at:], w[:at] + "s" + w[at + 1 :]])
            chosen.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        docs.append((i, rng.choice([" ", ", ", "1"]).join(chosen)))
    long_ = "langes" * 40
    docs += [(500, None), (501, ""), (None, docs[3][1]), (7, docs[7][1]), (502, " ".join([long_] * 9 + [long_ + "x"] * 4 + [long_[1:]] * 3)), (503, "日本 × ÷ " * 5)]
    return docs


@pytest.mark.parametrize("options", [{}, {"shard": 20, "leaf": 2, "prefix": 2, "groups": 6}, {"prefix": 4, "groups": 4, "leaf": 1}])
def test_variants_equal_brute_force(spark, options):
    docs = spelled_case()
    found = spelling_trie.variants(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string"), **options)
    got = sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in found.collect())
    want = plain_variants(docs)
    assert len(want) > 100 and got == want


def test_variants_of_an_empty_table(spark):
    assert spelling_trie.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_noise_of_long_and_short_runs():
    texts = ["ab " * 40 + "x" * 80 + " " + "y" * 70, "é" * 66 + " a b c d e"] * 60
    ids = [f"{i}:".encode() for i in range(120)]
    want = Counter()
    for i, t in zip(ids, texts):
        for run in t.split():
            h = zlib.crc32(i + run.encode())
            run = run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                want[run.encode("latin-1")] += 1
    assert spelling_trie.slice_counts(ids, texts) == dict(want)
