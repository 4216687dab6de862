"""Spelling variants grouped by a frequency-vector trie.

A word's vector counts its letters by letter group; the groups are made once from the vocabulary, so that they are
about equally frequent. One inserted letter is a surplus of one in some group, a deleted one a deficit of one, a
replaced one both or neither. The trie arranges the indexed words by their counts, group after group. A depth-first
search carries all words that are looked up at once: each goes on to a child whose count equals its own, or is one above
while its surplus is unspent, or one below while its deficit is. Words at the leaves are verified letter by letter.

The first `prefix` groups are the upper levels of the trie and Spark's partitioning: a word is indexed under one prefix
and looked up under those within the budget. A prefix with many words is cut into parts of `shard` indexed and
`shard` * 4 looked-up words; each pair of parts is one task, so that no task grows with the vocabulary.
Tasks return one row per word (number of near words, the most frequent one), never pairs.

Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z lower-cased) with `least_chars` code points and `least_count`
occurrences at least. A run whose CRC-32 with its document's id is a multiple of `noise` has one letter removed. As these
code points are one Latin-1 byte each, tasks work on bytes in that coding. The CRC of id and run is that of the run, joined to the
id's moved on by as many zero bytes, so each distinct run is hashed once per slice of documents.

A word's form is its most frequent near word (ties: the smaller), if at least `ratio` times as frequent; roots are
found by doubling the links, since counts grow by `ratio` along them: some log2(log2(n)) rounds.

Results by case: null and empty texts have no words; a null id is the empty text in the CRC; rows are counted each; runs
of any length are words; an empty table gives an empty frame; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.session import stored

LEAST_CHARS, LEAST_COUNT, NOISE, RATIO = 5, 3, 97, 2
GROUPS = 20
PREFIX = 3
SHARD = 40_000
LEAF = 16
SLICE = 1000  # documents whose words are held at once
LONG = 64  # longer words are compared one by one
PAIRS = 400_000  # pairs that are verified together

LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32: the remainder of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC_TABLE = _crc_table()


def moved_on(crc: np.ndarray, most: int) -> np.ndarray:
    """CRCs followed by 0 to `most` zero bytes (a row each): what joining a text of that length adds its own CRC to."""
    rows = np.empty((most + 1, len(crc)), np.uint32)
    rows[0] = crc
    for i in range(most):
        rows[i + 1] = CRC_TABLE[rows[i] & np.uint32(0xFF)] ^ (rows[i] >> np.uint32(8))
    return rows


def slice_counts(ids: list[bytes], texts: list[str], noise: int = NOISE, least_chars: int = LEAST_CHARS) -> dict[bytes, int]:
    """Occurrences of the words (Latin-1) of some documents, noise included."""
    spaced = pa.array([t.encode("latin-1", "replace").translate(LETTERS).strip() for t in texts], pa.large_binary())
    lists = pc.ascii_split_whitespace(spaced.view(pa.large_string()))
    n = np.where(pc.binary_length(spaced).to_numpy(zero_copy_only=False) > 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False), 0)
    flat = pc.list_flatten(lists).view(pa.large_binary())
    if n.sum() != len(flat):  # an empty text is one empty word
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
    coded = flat.dictionary_encode()
    words, size = coded.dictionary.to_pylist(), max(1, len(coded.dictionary))
    key, count = np.unique(np.repeat(np.arange(len(n)), n) * size + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    doc, word = key // size, key % size
    utf8 = [w if w.isascii() else w.decode("latin-1").encode() for w in words]
    length, own = np.array([len(u) for u in utf8], np.int64), np.array([zlib.crc32(u) for u in utf8], np.uint32)
    before = np.array([zlib.crc32(i) for i in ids], np.uint32)
    moved = moved_on(before, min(LONG, int(length.max(initial=0))))
    crc = moved[np.minimum(length[word], len(moved) - 1), doc] ^ own[word]
    for i in np.flatnonzero(length[word] >= len(moved)).tolist():
        crc[i] = zlib.crc32(utf8[word[i]], int(before[doc[i]]))
    changed = np.flatnonzero(crc % np.uint32(noise) == 0)
    total = np.bincount(word, weights=count, minlength=len(words)).astype(np.int64)
    np.subtract.at(total, word[changed], count[changed])
    found = {w: k for w, k in zip(words, total.tolist()) if k and len(w) >= least_chars}
    for i in changed.tolist():
        old = words[word[i]]
        at = int(crc[i]) % len(old)
        new = old[:at] + old[at + 1 :]
        if len(new) >= least_chars:
            found[new] = found.get(new, 0) + int(count[i])
    return found


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
               least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences; stored."""
    rows = docs.select(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":")).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, SLICE):
                batch = whole.slice(low, SLICE)
                texts = [b"" if x is None else x for x in batch.column("text").cast(pa.binary()).to_pylist()]
                counts = slice_counts([i.encode() for i in batch.column("id").to_pylist()], [t.decode("utf-8", "replace") for t in texts], noise, least_chars)
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least_count), "words")


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each Latin-1 byte; about equally frequent, the most frequent first. From one row per letter."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n")).collect()
    sums, group_of = [0] * groups, np.zeros(256, np.uint8)
    known = {r["letter"]: r["n"] for r in letters if r["letter"]}
    for letter in sorted((bytes([c]).decode("latin-1") for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]), key=lambda x: (-known.get(x, 0), x)):
        least = sums.index(min(sums))
        group_of[ord(letter)] = least
        sums[least] += known.get(letter, 0)
    order = np.argsort(-np.array(sums), kind="stable")
    return np.argsort(order).astype(np.uint8)[group_of]


def vectors(words: list[bytes], group_of: np.ndarray, groups: int) -> np.ndarray:
    """Counts by group, at most 255 (counts beyond are alike, which keeps every difference within its bound)."""
    size = np.array([len(w) for w in words], np.int64)
    letters = group_of[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    cells = np.bincount(np.repeat(np.arange(len(words)), size) * groups + letters, minlength=len(words) * groups)
    return np.minimum(cells, 255).astype(np.uint8).reshape(len(words), groups)


def _prefix_keys(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The key of each prefix, and the keys within a surplus and a deficit of one (its own first)."""
    weight = 256 ** np.arange(counts.shape[1], dtype=np.int64)
    own, counts = counts @ weight, counts.astype(np.int64)
    near, groups = [own], range(counts.shape[1])
    for up in [None, *groups]:
        for down in [None, *groups]:
            if up == down:
                continue
            possible = np.ones(len(own), bool) if down is None else counts[:, down] > 0
            move = (0 if up is None else weight[up]) - (0 if down is None else weight[down])
            near.append(np.where(possible, own + move, -1))
    return own, near


def _matrix(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


class Side:
    """Words with their letters as a matrix, lengths and vectors."""

    def __init__(self, words: list[bytes], width: int, group_of: np.ndarray, groups: int):
        self.words, self.letters = words, _matrix(words, width)
        self.length = np.array([len(w) for w in words], np.int64)
        self.vectors = vectors(words, group_of, groups).astype(np.int16)


def _verified(asked: Side, kept: Side, q: np.ndarray, i: np.ndarray, width: int) -> np.ndarray:
    """Which pairs are one edit apart."""
    more = asked.length[q] - kept.length[i]
    result = np.zeros(len(q), bool)
    wide = np.maximum(asked.length[q], kept.length[i]) >= width
    for at in np.flatnonzero(wide & (np.abs(more) <= 1)).tolist():
        result[at] = one_edit(asked.words[q[at]], kept.words[i[at]])
    same = np.flatnonzero(~wide & (more == 0))
    result[same] = (asked.letters[q[same]] != kept.letters[i[same]]).sum(axis=1) == 1
    for sign, long_, short, a, b in ((1, asked, kept, q, i), (-1, kept, asked, i, q)):
        at = np.flatnonzero(~wide & (more == sign))
        if not len(at):
            continue
        x, y = long_.letters[a[at]], short.letters[b[at]]
        first = (x != y).argmax(axis=1)
        behind = np.arange(width - 1)[None, :] < first[:, None]
        result[at] = (behind | (x[:, 1:] == y[:, :-1])).all(axis=1)
    return result


def search(kept_words: list[bytes], asked_words: list[bytes], group_of: np.ndarray, groups: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (looked-up word, indexed word) that are one edit apart."""
    width = min(LONG, max(map(len, kept_words + asked_words), default=0)) + 1
    order = np.lexsort(vectors(kept_words, group_of, groups).T[::-1])
    kept_words = [kept_words[k] for k in order]
    kept, asked = Side(kept_words, width, group_of, groups), Side(asked_words, width, group_of, groups)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting, size = [], 0

    def verify() -> None:
        q, i = (np.concatenate(x) for x in zip(*waiting))
        good = _verified(asked, kept, q, i, width)
        found.append((q[good], order[i[good]]))

    none = np.zeros(len(asked_words), bool)
    todo = [(0, 0, len(kept_words), np.arange(len(asked_words)), none, none)]
    while todo:
        depth, low, high, who, surplus, deficit = todo.pop()
        if depth == groups or high - low <= leaf:
            step = max(1, PAIRS // (high - low))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                waiting.append((np.repeat(some, high - low), np.tile(np.arange(low, high), len(some))))
                size += len(waiting[-1][0])
                if size >= PAIRS:
                    verify()
                    waiting, size = [], 0
            continue
        counts = kept.vectors[low:high, depth]
        cuts = np.flatnonzero(np.diff(counts)) + 1
        own = asked.vectors[who, depth]
        for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), high - low]):
            more = counts[first] - own
            up, down = more == 1, more == -1
            go = (more == 0) | (up & ~surplus) | (down & ~deficit)
            if go.any():
                todo.append((depth + 1, low + first, low + end, who[go], (surplus | up)[go], (deficit | down)[go]))
    if waiting:
        verify()
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, i = (np.concatenate(x) for x in zip(*found))
    return q, i


def near_words(words: DataFrame, groups: int = GROUPS, prefix: int = PREFIX, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) with a near word: how many, and the most frequent one."""
    group_of = letter_groups(words, groups)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, near = _prefix_keys(vectors([w.encode("latin-1") for w in batch.column("word").to_pylist()], group_of, groups)[:, :prefix])
                near = np.stack(near, axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(own), lists], names=["word", "n", "key", "near"])

    rows = stored(words.mapInArrow(keyed, "word string, n bigint, key bigint, near array<bigint>"), "word-keys")
    indexed = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    asking = rows.select(F.explode("near").alias("key")).where("key >= 0").groupBy("key").agg(F.count(F.lit(1)).alias("asked"))
    parts = stored(indexed.join(asking, "key").select("key", F.ceil(F.col("size") / shard).alias("p"), F.ceil(F.col("asked") / (4 * shard)).alias("q")), "word-parts")
    part = lambda of: F.pmod(F.xxhash64("word"), F.col(of))
    numbers = lambda of: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1))
    kept = rows.select("word", "n", "key").join(parts, "key").select("key", part("p").alias("i"), numbers("q").alias("j"), F.lit(False).alias("asks"), "word", "n")
    asks = rows.select("word", F.lit(0).cast("bigint").alias("n"), F.explode("near").alias("key")).join(parts, "key")
    asks = asks.select("key", numbers("p").alias("i"), part("q").alias("j"), F.lit(True).alias("asks"), "word", "n")

    def look_up(frame: pd.DataFrame) -> pd.DataFrame:
        asks = frame["asks"].to_numpy(bool)
        kept, asked = frame[~asks], frame["word"][asks].to_numpy()
        names, n = kept["word"].to_numpy(), kept["n"].to_numpy(np.int64)
        q, i = search([w.encode("latin-1") for w in names], [w.encode("latin-1") for w in asked], group_of, groups, leaf)
        rank = np.empty(len(names), np.int64)
        rank[np.argsort(names, kind="stable")] = np.arange(len(names))
        order = np.lexsort((rank[i], -n[i], q))
        q, i = q[order], i[order]
        who, first, count = np.unique(q, return_index=True, return_counts=True)
        return pd.DataFrame({"word": asked[who], "n_near": count.astype(np.int64), "best_n": n[i[first]], "best": names[i[first]]})

    found = kept.unionByName(asks).groupBy("key", "i", "j").applyInPandas(look_up, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form) that have no circle: every round doubles the way that a link covers."""
    now = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "links")
    while now.where("moved").limit(1).count():
        next_ = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(next_, "root", "left")
        now = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "links")
    return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
             noise: int = NOISE, ratio: int = RATIO, groups: int = GROUPS, prefix: int = PREFIX, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = vocabulary(docs, id_col, text_col, least_chars, least_count, noise)
    near = near_words(words, groups, prefix, shard, leaf)
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "near-words")
    return rows.join(roots(rows.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
