"""BPE encoding and decoding with a priority queue of merges over a linked list of symbols.

Reads a tokenizer file of the public `tokenizers` format whose model is BPE with word ends. A text is cut at the
special tokens, each part is normalised (NFC, blanks to one space, lower case by character), split by the file's
pattern, and each piece is written in the byte alphabet. A piece is encoded on its own: its symbols form a doubly
linked list, all neighbouring pairs with a rank go into a heap by (rank, place), and the best entry is merged if
both of its symbols are still the ones it was made for (a stale entry is skipped); the two new neighbours enter the
heap. Decoding joins vocabulary strings, with one space between tokens since the file has no decoder.

Words repeat, so each Python worker keeps the results of a bounded number of words and pieces in memory; nothing else is shared. The
file (under 2 MB) is read by the driver and travels with the tasks, so executors need no copy of it.

Results by case: null counts as empty; an empty text has no tokens and decodes to the empty text; very long texts are taken
whole; repeated rows are encoded alike; an empty table gives an empty frame; further columns are carried only where asked.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
import zlib
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm.text import Remembered, map_texts

WORDS, PIECES = 200_000, 300_000  # words and pieces whose tokens a worker remembers at most

def byte_alphabet() -> list[str]:
    """The character of each byte: printable Latin-1 stands for itself, the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(moved)) for b in range(256)]


class Bpe:
    def __init__(self, definition: dict):
        model = definition["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocabulary.items(), *self.special.items()]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        split = next(p for p in definition["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"]).findall
        letters = byte_alphabet()
        self.inner = [self.vocabulary[c] for c in letters]
        self.last = [self.vocabulary[c + self.end] for c in letters]
        self.ranks: dict[int, int] = {}  # rank by pair: left id * 2^20 + right id
        self.made: list[int] = []  # id that a merge makes, by rank
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[self.vocabulary[a] << 20 | self.vocabulary[b]] = rank
            self.made.append(self.vocabulary[a + b])
        self.words, self.merged = Remembered(self._word, WORDS), Remembered(self.encode_piece, PIECES)

    def encode_piece(self, piece: str) -> list[int]:
        """Merges one piece; ids of its tokens. A heap entry is rank * 2^32 + place of its left symbol."""
        raw = piece.encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n, rank_of, made = len(ids), self.ranks.get, self.made
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # after == n: the end
        heap = []
        for i in range(n - 1):
            if (rank := rank_of(ids[i] << 20 | ids[i + 1])) is not None:
                heap.append(rank << 32 | i)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j >= n or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue  # stale: one of the two has been merged meanwhile (a merged one has id -1)
            new = ids[i] = made[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(new << 20 | ids[k])) is not None:
                    heapq.heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(ids[h] << 20 | new)) is not None:
                heapq.heappush(heap, rank << 32 | h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> tuple[str, str]:
        """Ids and strings of the tokens of a normalised text without blanks, both joined by spaces."""
        if word.isascii() and word.isalpha():
            ids = self.merged[word]
        else:
            ids = [i for piece in self.pieces(word) for i in self.merged[piece]]
        return " ".join(map(str, ids)), self.decode(ids)

    def _words(self, text: str) -> list[str]:
        """The normalised text (NFC, lower case by character) at its blanks, which no piece crosses.

        The pattern takes the four separators of ASCII for characters, Python for blanks: such texts stay whole.
        """
        plain = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")  # by character: no final sigma
        plain = plain.lower()
        return [plain] if _SEPARATORS.search(plain) else plain.split()

    def parts(self, text: str) -> list[tuple[str, str]]:
        """The words of a text with their tokens, special tokens as words of their own."""
        out, at = [], 0
        for m in self.cut.finditer(text) if self.cut and self.cut.search(text) else ():
            out += map(self.words.__getitem__, self._words(text[at : m.start()]))
            out.append((str(self.special[m[0]]), m[0]))
            at = m.end()
        out += map(self.words.__getitem__, self._words(text[at:] if at else text))
        return [p for p in out if p[0]]

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.parts(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings, one space between tokens."""
        return " ".join([self.strings[i] for i in ids])


_SEPARATORS = regex.compile("[\x1c-\x1f]")


@lru_cache(maxsize=2)
def _loaded(packed: bytes) -> Bpe:
    return Bpe(json.loads(zlib.decompress(packed)))


def _pack(path: str) -> bytes:
    with open(path, "rb") as f:
        return zlib.compress(f.read())


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, and SHA-256 (hex) of the decimal ids joined by one space and of the decoded text."""
    packed = _pack(path)

    def digest(texts: list[bytes]) -> list[tuple]:
        bpe, rows = _loaded(packed), []
        for text in texts:
            parts = bpe.parts(text.decode("utf-8", "replace"))
            ids, strings = " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])
            rows.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(strings.encode()).hexdigest()))
        return rows

    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_texts(keyed, "text", {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, digest, keep=["id"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and `ids`, the token ids."""
    packed = _pack(path)
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_texts(keyed, "text", {"ids": "array<int>"}, lambda texts: [(_loaded(packed).encode(t.decode("utf-8", "replace")),) for t in texts], keep=["id"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Appends `decoded` to frames with a column `ids`; null where the ids are null."""
    packed = _pack(path)

    def join(ids):
        return ids.map(lambda x: None if x is None else _loaded(packed).decode(list(x)))

    return encoded.withColumn("decoded", F.pandas_udf(join, "string")(F.col("ids")))
