from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from lodewatch.llm import bpe, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "Σσς ΑΣ", "İstanbul", "é ﬁ ½ Ⅳ", "don't I'll we've 'S x'D", "<|endoftext|>a<|startoftext|>", "a<|endoftext|", "\x1c\x1f\x85\xa0　x​",
       "12345 ٣٤ ²", "日本語テキスト", "😀👩‍👩‍👧", "\x00\x01", "naïve façade", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "thethethethe", "#*$%&|<>"]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(WORDS)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    return bpe._loaded(bpe._pack(WORDS))


@pytest.mark.parametrize("text", ODD)
def test_encoding_equals_the_library(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert " ".join(p[1] for p in own.parts(text)) == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdehinorst 'sΣß\n\t.,!9é"), st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]))))
def test_any_text_equals_the_library(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_digests_of_a_frame(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(99, None, "x"), (0, "", "x"), (None, "the " * 50_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in bpe.encode_digests(df, WORDS).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.encode_digests(df.limit(0), WORDS).count() == 0
    back = bpe.decode(bpe.encode(df, WORDS), WORDS).where("id = 5").first()
    assert back["decoded"] == library.decode(back["ids"], skip_special_tokens=False)


@pytest.fixture(scope="module")
def counter():
    return token_counts._counter(token_counts._pack(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(e.encode_ordinary(text))


SMALL = st.text(alphabet="ab 'srelv\n\t.!19é", max_size=30)


@settings(max_examples=600, deadline=None)
@given(SMALL, st.lists(st.tuples(st.integers(0, 32), st.integers(0, 8), st.text(alphabet="ab 'srelv\n.9", max_size=6)), max_size=5))
def test_edits_count_as_a_whole_text(counter, whole, text, edits):
    tree, now = token_counts.TokenTree(text, counter), text
    assert tree.total == whole(now)
    for start, n, new in edits:
        start = min(start, len(now))
        tree.edit(start, start + n, new)
        now = now[:start] + new + now[start + n :]
        assert tree.text == now and tree.total == whole(now)


@settings(max_examples=600, deadline=None)
@given(SMALL, st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.text(alphabet="ab 'srelv\n.9", max_size=6)), max_size=6), st.booleans())
def test_disjoint_edits_in_one_pass_and_again_from_leaves(counter, whole, text, gaps, touching):
    edits, at = [], 0
    for gap, n, new in gaps:  # each begins `gap` characters after the one before
        start = min(len(text), at + (0 if touching else gap))
        at = min(len(text), start + n)
        edits.append((start, at, new))
    tree, now = token_counts.TokenTree(text, counter), text
    tree.edit_all(edits)
    for start, end, new in reversed(edits):
        now = now[:start] + new + now[end:]
    assert tree.text == now and tree.total == whole(now)
    chars, tokens = (token_counts._unpacked(token_counts._packed(a)) for a in tree.leaves())
    assert list(chars) == [len(p) for p in counter.split.findall(now)] and tokens.sum() == whole(now)
    again = token_counts.TokenTree(now, counter, (chars, tokens))
    again.edit_all(token_counts.unwrapped(now))
    assert again.encoded == 0 or "\n" in now
    assert again.text == token_counts._LINE_ENDS.sub(" ", now) and again.total == whole(again.text)


def test_only_the_region_is_encoded(counter, whole):
    rng = random.Random(3)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "it's", "  x", "\n9"]) for _ in range(20_000))
    tree = token_counts.TokenTree(text, counter)
    pieces = tree.encoded
    for _ in range(50):
        at = rng.randrange(len(tree.text))
        tree.edit(at, at + rng.randrange(5), rng.choice(["", "new", " ", "\n\n"]))
    assert tree.total == whole(tree.text)
    assert tree.encoded - pieces < 50 * 12


def test_redaction_of_a_frame(spark, whole):
    rows = [(1, "write to a.b@c.org or +1 (706) 555-3138 now", 1), (2, None, 1), (3, "", 1), (4, "key " + "0a" * 20, 1), (4, "key " + "0a" * 20, 1), (None, "plain", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_edits int")
    got = sorted((tuple(r)[:4] for r in token_counts.count_redacted(df, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        new, edits = t or "", token_counts.redactions(t or "")
        for a, b, x in edits:
            new = new[:a] + x + new[b:]
        want.append((i, whole(t or ""), whole(new), len(edits)))
    assert got == sorted(want, key=repr)
    assert token_counts.count_redacted(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    edits = spark.createDataFrame([(1, 2, 0, 5, "x"), (1, 1, 0, 0, "yy "), (9, 1, 0, 1, "z"), (4, 1, 0, 3, None)], "doc_id long, seq int, start int, end int, replacement string")
    after = {r["id"]: r["n_tokens"] for r in token_counts.count_edited(df, edits, RANKS, public_tokenizers.PATTERN).collect()}
    assert after[1] == whole("x" + ("yy " + rows[0][1])[5:]) and after[4] == whole(rows[3][1][3:]) and after[2] == 0


def test_stored_trees_are_revised_twice(spark, whole):
    lines = "\n".join(f"line {i} of this text says don't  stop" for i in range(300))
    rows = [(1, lines, "x", 7), (1, "a\r\n\r\nb +1 (706) 555-3138\n", "y", 7), (2, None, "", 7), (3, "", None, 7), (None, "one line", "z", 7), (None, "one line", "z", 7),
            (4, "a" * 70_000 + "\n" + "b " * 9_000, "long", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, leaf_chars string, n_edits int")
    got = sorted((tuple(r) for r in token_counts.count_revisions(df, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        one = t or ""
        for a, b, x in token_counts.redactions(one):
            one = one[:a] + x + one[b:]
        two = one.replace("\r\n\r\n", "\n").replace("\n", " ")
        edits = len(token_counts.redactions(t or "")) + len(token_counts.unwrapped(one))
        want.append((i, whole(t or ""), whole(one), whole(two), edits))
    assert [g[:5] for g in got] == sorted(want, key=repr)
    first = next(g for g in got if g[0] == 1 and g[4] == 299)
    assert 0 < first[6] < first[7] / 2
    assert all(g[6] == 0 for g in got if g[4] == 0)
    assert token_counts.count_revisions(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_a_revised_table_takes_edits_again(spark, whole):
    df = spark.createDataFrame([(1, "alpha beta gamma"), (2, None)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 1, 0, 5, "omega"), (2, 1, 0, 0, "new text"), (1, 2, 5, 5, "s and")], "doc_id long, seq int, start int, end int, replacement string")
    trees = token_counts.plant(df, RANKS, public_tokenizers.PATTERN)
    for _ in range(2):
        trees = token_counts.revise_by(trees, edits, RANKS, public_tokenizers.PATTERN)
    got = {r["id"]: (r["text"], r["n_tokens"], r["n_edits"]) for r in trees.collect()}
    texts = {1: "omegas ands and beta gamma", 2: "new textnew text"}
    assert got == {i: (t, whole(t), 2 if i == 1 else 1) for i, t in texts.items()}
