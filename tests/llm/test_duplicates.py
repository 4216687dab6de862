from __future__ import annotations

import hashlib
import random
import re

import pytest

from lodewatch.llm import exact_dedup, substring_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_groups(rows):
    keyed = [(i, BLANK.sub("", t or ""), len(t or "")) for i, t in rows]
    out = []
    for i, text, _ in keyed:
        group = [(-n, j is None, j or 0) for j, x, n in keyed if x == text]
        best = min(group)
        out.append((i, None if best[1] else best[2], len(group), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy", [1, 256])
def test_exact_groups(spark, heavy):
    rng = random.Random(5)
    texts = ["a b", "ab", " a\tb\n", "A b", "é x", "", None, " \x0b\x0c\r", "long " * 20_000]
    rows = [(i, rng.choice(texts)) for i in range(60)] + [(100 + i, "hot copy") for i in range(60)] + [(7, "ab"), (7, "ab"), (None, "ab"), (None, "only null id"), (None, "only null id")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = exact_dedup.exact_groups(df, heavy=heavy).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], bytes(r["digest"]).hex()) for r in got), key=repr) == plain_groups(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({bytes(r["digest"]) for r in got}) and all(r["id"] == r["keep_id"] for r in kept)
    stays = exact_dedup.keep_exact(df, heavy=heavy)
    assert stays.columns == df.columns
    assert sorted((r["doc_id"] for r in stays.collect()), key=repr) == sorted((r["id"] for r in kept), key=repr)


def test_exact_groups_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert exact_dedup.exact_groups(df).count() == 0 and exact_dedup.keep_exact(df).count() == 0


def plain_removal(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in docs:
        if i is not None:
            for s in range(len(words) - window + 1):
                key = tuple(words[s : s + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in docs:
        gone = set()
        if i is not None:
            for s in range(len(words) - window + 1):
                if first[tuple(words[s : s + window])] < i:
                    gone.update(range(s, s + window))
        out.append((i, len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,anchor", [(50, 16), (6, 3)])
def test_removal_equals_brute_force(spark, window, anchor):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(300)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows = words(70), []
    for i in range(40):
        text = words(rng.randrange(0, 150))
        if i % 2:
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage[rng.randrange(8) :]
        if i % 5 == 4:  # a near copy: one word of the document before changed
            text = rows[-1][1].split()
            text[len(text) // 2 : len(text) // 2 + 1] = ["changed"]
        rows.append((rng.randrange(10_000), "\t".join(text)))
    loop = " ".join(["again and"] * 200)
    rows += [(5, None), (6, ""), (None, rows[1][1]), (20_000, loop), (20_001, "x " + loop), (3, rows[3][1]), (3, rows[3][1]), (9, " ".join(words(20_000)))]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int")
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(df, window=window, anchor=anchor).collect()), key=repr)
    assert got == plain_removal(rows, window)


def test_spans_name_their_source(spark):
    rng = random.Random(2)
    text = " ".join(f"v{rng.randrange(10_000)}" for _ in range(120))
    df = spark.createDataFrame([(1, text), (2, "lead in " + text), (3, "other")], "doc_id long, text string")
    spans = substring_dedup.repeated_spans(df).collect()
    assert {r["id"] for r in spans} == {2} and {r["source_id"] for r in spans} == {1}
    words = text.split()
    for r in spans:
        assert ("lead in " + text).split()[r["first"] : r["end"]] == words[r["source_first"] : r["source_first"] + r["end"] - r["first"]]
    assert min(r["first"] for r in spans) == 2 and max(r["end"] for r in spans) == 122
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def test_rows_that_share_an_id_keep_their_own_words(spark):
    rng = random.Random(8)
    words = lambda n: [f"v{rng.randrange(10_000)}" for _ in range(n)]
    passage = words(60)
    rows = [(1, " ".join(passage)), (2, " ".join(words(10) + passage)), (2, " ".join(words(90))), (2, " ".join(words(12) + passage)), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(df).collect())
    assert got == plain_removal(rows, 50)
    assert sorted(r[2] for r in got) == [0, 0, 0, 60, 60]


def test_unbranched_paths_are_compacted_by_joins(spark, monkeypatch):
    seen, before = [], substring_dedup.compacted
    monkeypatch.setattr(substring_dedup, "compacted", lambda plain: seen.append((plain, before(plain))) or seen[-1][1])
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    shared = [word() for _ in range(5000)]
    rows = [(i, " ".join([*[word() for _ in range(100)], *shared, *[word() for _ in range(100)]])) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = substring_dedup.repeated_spans(df).collect()
    assert sorted((r["id"], r["first"], r["end"], r["source_id"], r["source_first"]) for r in spans) == [(2, 100, 5100, 1, 100), (3, 100, 5100, 1, 100)]
    assert len({bytes(r["digest"]) for r in spans}) == 1 and bytes(spans[0]["digest"]) == hashlib.sha256(" ".join(shared).encode()).digest()
    (plain, heads), = seen
    assert plain.count() > 200 and heads.count() == 1  # log2 of them in rounds
    assert heads.first()["total"] == plain.groupBy().sum("count").first()[0]


def test_collisions_remove_nothing(spark):
    """Hashes of few bits collide everywhere; the words at the source's coordinates differ."""
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(50, 300)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bits in (1, 3, 64):
        got = sorted(tuple(r) for r in substring_dedup.remove_repeats(df, bits=bits).collect())
        assert got == [(i, len(t.split()), 0, t) for i, t in rows], bits


def test_rows_of_one_source_id_keep_their_own_coordinates(spark):
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(10**6)}"
    a, b = [word() for _ in range(120)], [word() for _ in range(120)]
    rows = [(1, " ".join(a)), (1, " ".join([*a[60:], *b])), (5, " ".join([*a, *b])), (5, " ".join([*b, *a])), (6, None), (None, " ".join(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(df).collect()), key=repr)
    assert got == plain_removal(rows, 50)
