"""Token counts that follow edits: a segment tree over pre-tokens for each document.

A document is split into pre-tokens by the tokenizer's pattern; each leaf of its tree holds a pre-token's characters
and tokens, each inner node the sums of both. An edit (start, end, replacement, in characters of the current text)
descends by character sums to the first leaf it can change, splits the text anew from there, and stops as soon as a
new pre-token ends, beyond the edit, where an old one ended: the pattern looks only forward, so from equal places on
equal text the rest splits as before. Only those pre-tokens are encoded; their leaves and the sums above them are
updated. The first leaf goes back over every pre-token that ends less than `CONTEXT` characters before the edit, or is
followed by blanks up to it: the pattern looks ahead over two characters, or over a run of blanks and one more.

Trees are kept: `plant` makes a table of them, one row per document with its text and packed leaves, and `revise` and
`revise_by` turn such a table into the next one. A revision reads leaves and adds them up, but splits and encodes only
what its edits touch. Sorted edits of one text are applied in one pass, so that a long text with many edits is linear.

Documents are spread over tasks as they are read; only a table of edits is joined by a shuffle. Each worker remembers the
counts of up to `CACHE` pre-tokens.

Results by case: null counts as empty; an empty text has 0 tokens and takes insertions; edits are clipped to the text; edits
of a list are applied in their order; null edits or null replacements count as none and as the empty text; repeated
rows are counted alike; an empty table gives an empty frame; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewatch.llm.text import Remembered, map_texts, text_bytes
from lodewatch.session import stored

CACHE = 400_000
CONTEXT = 2

#: Personal data and keys that the redaction of the registered query replaces, tried in this order at each place.
REDACTIONS = {
    "<mail>": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "<key>": r"[0-9a-f]{32,}|[0-9A-F]{32,}",
    "<number>": r"[0-9]{13,}|\+[0-9][0-9 ().-]{7,}[0-9]",
}
_LINE_ENDS = re.compile(r"[\r\n]+")
_MARKS = list(REDACTIONS)
_REDACT = re.compile("|".join(f"({p})" for p in REDACTIONS.values()))


def _only(chars: bytes) -> bytes:
    return bytes(120 if b in chars else 32 for b in range(256))


#: Runs that every redaction but those with @ or + contains, looked for in a text whose other characters are blanked.
_RUNS = [(_only(b"0123456789"), b"x" * 13), (_only(b"0123456789abcdef"), b"x" * 32), (_only(b"0123456789ABCDEF"), b"x" * 32)]


def _may_match(raw: bytes) -> bool:
    """False only for texts without any redaction; several times faster than the patterns."""
    return b"@" in raw or b"+" in raw or any(run in raw.translate(only) for only, run in _RUNS)


class Counter:
    """Splits texts by a pattern and counts the tokens of pre-tokens by a rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = Remembered(lambda piece: len(self.encoding.encode_ordinary(piece)), CACHE)
        self.tokens = self.known.__getitem__


class TokenTree:
    """The segment tree of one text; `leaves` are the characters and tokens of its pre-tokens, where they are known already."""

    def __init__(self, text: str, counter: Counter, leaves: tuple[np.ndarray, np.ndarray] | None = None):
        self.text, self.counter, self.encoded = text, counter, 0
        if leaves is None:
            pieces = counter.split.findall(text)
            self.encoded = len(pieces)
            leaves = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(map(counter.tokens, pieces), np.int64, len(pieces))
        self.leaf_chars, self.leaf_tokens = leaves
        self.total = int(self.leaf_tokens.sum())
        self.changed: dict[int, tuple[list[int], list[int]]] = {}  # the pre-tokens of edited leaves now
        self.chars = self.tokens = None

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the current pre-tokens."""
        out = []
        for which, before in enumerate((self.leaf_chars, self.leaf_tokens)):
            old, now, at = before.tolist(), [], 0
            for leaf in sorted(self.changed):
                now += old[at:leaf]
                now += self.changed[leaf][which]
                at = leaf + 1
            out.append(np.array(now + old[at:], np.int64))
        return out[0], out[1]

    def _grow(self) -> None:
        """Inner nodes bottom up; made at the first edit. Node 1 is the root, leaves start at `self.base`."""
        n, trees = len(self.leaf_chars), []
        self.base = 1 << max(0, n - 1).bit_length()
        for leaves in (self.leaf_chars, self.leaf_tokens):
            levels = [np.concatenate([leaves, np.zeros(self.base - n, np.int64)])]
            while len(levels[-1]) > 1:
                levels.append(levels[-1][::2] + levels[-1][1::2])
            trees.append([0, *np.concatenate(levels[::-1]).tolist()])  # lists: single nodes are read and set
        self.chars, self.tokens = trees

    def _set(self, leaf: int, chars: list[int], tokens: list[int]) -> None:
        self.changed[leaf] = chars, tokens
        node, of_chars, of_tokens = self.base + leaf, self.chars, self.tokens
        chars_more, tokens_more = sum(chars) - of_chars[node], sum(tokens) - of_tokens[node]
        while node:
            of_chars[node] += chars_more
            of_tokens[node] += tokens_more
            node //= 2

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at`, and its first character; descends by character sums."""
        node, start = 1, 0
        while node < self.base:
            left = self.chars[2 * node]
            if at - start < left:
                node = 2 * node
            else:
                start += left
                node = 2 * node + 1
        return node - self.base, start

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replaces characters start to end (exclusive) of the current text."""
        size = len(self.text)
        start, end = max(0, min(start, size)), max(0, min(end, size))
        self.edit_all([(start, max(start, end), replacement)])

    def edit_all(self, edits: list[tuple[int, int, str]]) -> None:
        """Applies edits of the current text that are sorted and disjoint; the text is put together once."""
        if not edits:
            return
        parts, kept = [], 0
        for start, end, new in edits:
            parts += [self.text[kept:start], new]
            kept = end
        text = "".join([*parts, self.text[kept:]])
        if not len(self.leaf_chars) or not self.text:  # nothing to keep
            encoded = self.encoded
            self.__init__(text, self.counter)
            self.encoded += encoded
            return
        if self.chars is None:
            self._grow()
        n, i = len(self.leaf_chars), 0
        shift, done, met = 0, -1, 0  # characters moved by the edits so far, the last leaf made anew and its end in the old text
        while i < len(edits):
            start, end, new = edits[i]
            # back over pre-tokens whose end the edit can reach: two characters, or blanks up to the edit
            reach = start
            while reach > met and self.text[reach - 1].isspace():
                reach -= 1
            reach -= CONTEXT
            first, at = (done + 1, met + shift) if reach <= met else self._find(reach - 1 + shift)
            last, old_end = first - 1, at - shift
            shift += len(new) - (end - start)
            chars, tokens = [], []
            # split anew until a new end meets an old one beyond the edit; edits that begin before that are taken along
            while True:
                while i + 1 < len(edits) and edits[i + 1][0] + shift <= at:
                    i += 1
                    shift += len(edits[i][2]) - (edits[i][1] - edits[i][0])
                if chars and at >= edits[i][1] + shift:
                    while last + 1 < n and old_end < at - shift:
                        last += 1
                        old_end += self.chars[self.base + last]
                    if old_end == at - shift and last >= first:
                        break
                if at >= len(text):
                    last, old_end = n - 1, len(self.text)
                    break
                m = self.counter.split.match(text, at)
                at = m.end()
                chars.append(at - m.start())
                tokens.append(self.counter.tokens(m[0]))
                self.encoded += 1
            self._set(first, chars, tokens)
            for leaf in range(first + 1, last + 1):
                if self.chars[self.base + leaf] or self.tokens[self.base + leaf]:
                    self._set(leaf, [], [])
            done, met, i = last, old_end, i + 1
        self.text, self.total = text, self.tokens[1]


@lru_cache(maxsize=2)
def _counter(packed: bytes, pattern: str) -> Counter:
    lines = zlib.decompress(packed).split(b"\n")
    return Counter({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}, pattern)


def _pack(path: str) -> bytes:
    with open(path, "rb") as f:
        return zlib.compress(f.read())


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that put marks in place of personal data, last place first, so that none moves another."""
    return [(m.start(), m.end(), _MARKS[m.lastindex - 1]) for m in _REDACT.finditer(text)][::-1]


def unwrapped(text: str) -> list[tuple[int, int, str]]:
    """Edits that put one blank in place of line ends, in order."""
    return [(m.start(), m.end(), " ") for m in _LINE_ENDS.finditer(text)]


def _packed(numbers: np.ndarray) -> bytes:
    """One byte a number where all fit, else four; the first byte says which."""
    size = 1 if not len(numbers) or int(numbers.max()) < 256 else 4
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


TREE = {"leaf_chars": "binary", "leaf_tokens": "binary", "n_tokens": "bigint", "n_pieces": "bigint"}


def plant(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, leaf_chars, leaf_tokens, n_tokens, n_pieces): the trees of all texts, to be stored and revised."""
    packed = _pack(path)

    def make(texts: list[bytes]) -> list[tuple]:
        counter, rows = _counter(packed, pattern), []
        for raw in texts:
            tree = TokenTree(raw.decode("utf-8", "replace"), counter)
            rows.append((*map(_packed, tree.leaves()), tree.total, tree.encoded))
        return rows

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return map_texts(docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")), "text", TREE, make)


REVISED = {"text": "string", **TREE, "n_edits": "bigint", "n_encoded": "bigint"}


def _revised(trees: DataFrame, path: str, pattern: str, also: list[str], find: Callable[..., list], apply: Callable[[TokenTree, list], None]) -> DataFrame:
    """The trees after `apply` of the edits that `find` has for a text and the values of the columns `also`; a tree without edits stays as it is."""
    packed = _pack(path)
    kept = [c for c in trees.columns if c not in REVISED and c not in also]
    added = StructType.fromDDL(", ".join(f"{k} {v}" for k, v in REVISED.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(packed, pattern)
        for batch in batches:
            columns = {"text": [raw.decode("utf-8", "replace") for raw in text_bytes(batch, "text")], **{k: batch.column(k).to_pylist() for k in TREE}}
            columns |= {"n_edits": [0] * batch.num_rows, "n_encoded": [0] * batch.num_rows}
            given = [batch.column(c).to_pylist() for c in also]
            for i, text in enumerate(columns["text"]):
                edits = find(text, *[g[i] for g in given])
                if edits:
                    tree = TokenTree(text, counter, (_unpacked(columns["leaf_chars"][i]), _unpacked(columns["leaf_tokens"][i])))
                    apply(tree, edits)
                    chars, tokens = tree.leaves()
                    for name, value in zip(REVISED, (tree.text, _packed(chars), _packed(tokens), tree.total, len(chars), len(edits), tree.encoded)):
                        columns[name][i] = value
            made = [pa.array(columns[k], {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}[v]) for k, v in REVISED.items()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=[*kept, *REVISED])

    read = trees.select(*[F.col(f"`{c}`") for c in kept], "text", *TREE, *also)
    return read.mapInArrow(run, StructType([*[trees.schema[c] for c in kept], *added]))


def revise(trees: DataFrame, path: str, pattern: str, rule: Callable[[str], list[tuple[int, int, str]]]) -> DataFrame:
    """The trees after the disjoint edits that `rule` derives from each text, with n_edits and n_encoded, the pre-tokens encoded for it.

    The result may be stored and revised again; columns besides the trees' are kept.
    """
    return _revised(trees, path, pattern, [], lambda text: sorted(rule(text)), TokenTree.edit_all)


def revise_by(trees: DataFrame, edits: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The same for a table of edits (id, seq, start, end, replacement), applied to each document in the order of `seq`.

    A document's edits are gathered on its row; edits of unknown documents are ignored.
    """
    listed = edits.groupBy(F.col(f"`{id_col}`").alias("edit_id")).agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "replacement"))).alias("edits"))

    def apply(tree: TokenTree, listed: list[dict]) -> None:
        for e in listed:
            tree.edit(e["start"], e["end"], e["replacement"] or "")

    joined = trees.join(listed, F.col("id") == F.col("edit_id"), "left").drop("edit_id")
    return _revised(joined, path, pattern, ["edits"], lambda text, listed: listed or [], apply)


COUNTS = ["n_tokens_before", "n_tokens", "n_edits", "n_pieces", "n_encoded_again"]


def _first(trees: DataFrame) -> DataFrame:
    return trees.withColumn("n_tokens_before", F.col("n_tokens")).withColumn("pieces_before", F.col("n_pieces"))


def _counts(revised: DataFrame) -> DataFrame:
    return revised.withColumn("n_pieces", F.col("pieces_before")).withColumn("n_encoded_again", F.col("n_encoded")).select("id", *COUNTS)


def redact(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """The trees after redaction."""
    return revise(trees, path, pattern, lambda text: redactions(text) if _may_match(text.encode("utf-8", "replace")) else [])


def unwrap(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """The trees after line ends became blanks."""
    return revise(trees, path, pattern, unwrapped)


def count_redacted(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, tokens before and after redaction, edits, pre-tokens, pre-tokens encoded again."""
    return _counts(redact(_first(plant(docs, path, pattern, id_col, text_col)), path, pattern))


def count_edited(docs: DataFrame, edits: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same for a table of edits as `revise_by` takes it."""
    return _counts(revise_by(_first(plant(docs, path, pattern, id_col, text_col)), edits, path, pattern, id_col))


def count_revisions(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document after two revisions of its stored tree, redaction and then unwrapping.

    id, n_tokens_before, n_tokens_redacted, n_tokens, n_edits, n_pieces, n_encoded_again (pre-tokens encoded by both), n_pieces_full
    (those that whole counts after each revision would have encoded).
    """
    trees = stored(plant(docs, path, pattern, id_col, text_col), "trees")
    once = redact(_first(trees), path, pattern)
    kept = {"n_tokens_redacted": "n_tokens", "pieces_redacted": "n_pieces", "edits_redacted": "n_edits", "encoded_redacted": "n_encoded"}
    twice = unwrap(once.withColumns({k: F.col(v) for k, v in kept.items()}), path, pattern)
    return twice.select(
        "id", "n_tokens_before", "n_tokens_redacted", "n_tokens", (F.col("n_edits") + F.col("edits_redacted")).alias("n_edits"), F.col("pieces_before").alias("n_pieces"),
        (F.col("n_encoded") + F.col("encoded_redacted")).alias("n_encoded_again"), (F.col("n_pieces") + F.col("pieces_redacted")).alias("n_pieces_full"))
