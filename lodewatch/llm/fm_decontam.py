"""Benchmark decontamination with an FM-index per shard of training text.

A shard is a run of documents of some `shard_words` words, as one sequence of word symbols with a separator after each
document. Its index is the Burrows-Wheeler transform of that sequence as a wavelet matrix, the shard's vocabulary, and
the positions of every `every`-th word of a document. It is made once, without knowing the benchmark, and stored; any
number of phrase blocks can be searched in it afterwards.

The wavelet matrix takes the lowest bit of a symbol first, so its last level is sorted by symbol, and following a
border through all levels is one whole backward step (start of the symbol's suffixes plus the symbol's rank). All phrases of
a block step together. Rows that match are located by stepping on to a sampled position; since the first word of
every document is sampled, no walk crosses a separator. Occurrences are merged to removal spans per document.

Items are cut into windows of `window` words (fewer words: one window); equal windows are searched once. Windows come to
the driver in blocks of at most `block` and travel with the search's code; the number of blocks follows the benchmark, and
the index, not the texts, is read for each. Items are matched to windows by a join.

Memory is that of one shard (a text longer than a shard is a shard of its own). Results by case: null texts have no words;
items without words are nothing to search; repeated rows are documents of their own; an item id that occurs twice is
one item; a null item id is listed as the empty text; empty tables give empty frames; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewatch.llm.text import fresh, text_bytes
from lodewatch.session import stored

WINDOW = 10
SHARD_WORDS = 500_000
EVERY = 8
BLOCK = 50_000

#: Bytes of words: digits, letters (A-Z lower-cased) and all bytes of characters beyond ASCII; others separate.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _valid(texts: list[bytes]) -> pa.Array:
    try:
        return pa.array(texts, pa.binary()).cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8 count as the replacement character
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())


def text_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts in a row, and the number of words of each text."""
    spaced = _valid([t.translate(WORD_BYTES).strip() for t in texts])
    lists = pc.ascii_split_whitespace(spaced)
    counts = np.where(pc.binary_length(spaced).to_numpy(zero_copy_only=False) > 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False), 0)
    words = pc.list_flatten(lists)
    return (words if counts.sum() == len(words) else words.filter(pc.not_equal(words, ""))), counts.astype(np.int64)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array: sorted by as many symbols as fit one number, then groups of equals by doubled lengths."""
    n = len(symbols)
    bits = int(symbols.max() + 1).bit_length() if n else 1
    depth = max(1, 62 // bits)
    key, ahead = np.zeros(n, np.int64), symbols.astype(np.int64) + 1
    for shift in range(depth):
        key <<= bits
        key[: max(0, n - shift)] |= ahead[shift:]
    order = np.argsort(key)
    slots, keys = np.arange(n), key[order]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    while True:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(slots)]
        first = np.maximum.accumulate(np.where(new, slots, 0))
        rank[order[slots]] = first
        alone = new & np.concatenate([new[1:], [True]])[: len(slots)]
        slots = slots[~alone]
        if not len(slots):
            return order
        at = order[slots]
        keys = rank[at] * (n + 1) + rank[np.minimum(at + depth, n)] + 1
        inside = np.argsort(keys)
        order[slots], keys = at[inside], keys[inside]
        depth *= 2


class Bits:
    """A bit vector with ranks; kept as packed bytes, counted when it is loaded."""

    def __init__(self, packed: bytes | np.ndarray, n: int):
        full = np.zeros((n // 64 + 1) * 8, np.uint8)
        raw = np.frombuffer(packed, np.uint8)
        full[: len(raw)] = raw
        self.words = full.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


def _packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits.astype(bool), bitorder="little").tobytes()


class FmIndex:
    """Backward search, and positions of matching rows, in one sequence of symbols."""

    def __init__(self, n: int, levels: list[bytes], marks: bytes, samples: bytes):
        self.n = n
        self.levels = [Bits(level, n) for level in levels]
        self.marks, self.samples = Bits(marks, n), np.frombuffer(samples, np.int32)

    @staticmethod
    def made(symbols: np.ndarray, sampled: np.ndarray) -> tuple[list[bytes], bytes, bytes]:
        """(levels, marks, samples) of symbols; `sampled` are the positions (as a mask) that are kept."""
        order = suffix_order(symbols)
        now, levels = symbols[order - 1], []  # the symbol before each suffix; the first one's is the last separator
        for bit in range(max(1, int(symbols.max()).bit_length() if len(symbols) else 1)):
            ones = (now >> bit) & 1 == 1
            levels.append(_packed(ones))
            now = np.concatenate([now[~ones], now[ones]])
        marked = sampled[order]
        return levels, _packed(marked), order[marked].astype(np.int32).tobytes()

    def step(self, symbol: np.ndarray, border: np.ndarray) -> np.ndarray:
        """One backward step of each border in the sorted suffixes by its symbol."""
        for bit, level in enumerate(self.levels):
            one, ranked = (symbol >> bit) & 1 == 1, level.rank(border)
            border = np.where(one, self.n - level.ones + ranked, border - ranked)
        return border

    def back(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one word earlier."""
        for level in self.levels:
            one, ranked = level.get(rows) == 1, level.rank(rows)
            rows = np.where(one, self.n - level.ones + ranked, rows - ranked)
        return rows

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high) of the phrases that occur; rows of symbols, ended by `lengths`."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(1, phrases.shape[1] + 1 if len(phrases) else 1):
            going = lengths[which] >= back
            at = np.flatnonzero(going)
            symbol = phrases[which[at], lengths[which[at]] - back]
            low[at], high[at] = self.step(symbol, low[at]), self.step(symbol, high[at])
            left = low < high
            which, low, high = which[left], low[left], high[left]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows."""
        found, steps, open_ = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(rows):
            hit = self.marks.get(rows) == 1
            found[open_[hit]] = self.samples[self.marks.rank(rows[hit])] + steps
            rows, open_, steps = rows[~hit], open_[~hit], steps + 1
            rows = self.back(rows)
        return found


def _shard_row(texts: list[bytes], every: int) -> dict:
    """The index of a run of texts."""
    words, counts = text_words(texts)
    coded = words.dictionary_encode()
    ends = np.cumsum(counts + 1)  # a separator, symbol 0, after each document
    n = int(ends[-1])
    symbols = np.zeros(n, np.int32)
    inside = np.ones(n, bool)
    inside[ends - 1] = False
    symbols[inside] = coded.indices.to_numpy() + 1
    starts = ends - counts - 1
    sampled = (np.arange(n) - np.repeat(starts, counts + 1)) % every == 0
    levels, marks, samples = FmIndex.made(symbols, sampled)
    return {"lengths": counts.astype(np.int32), "vocabulary": "\n".join(coded.dictionary.to_pylist()).encode(),
            "levels": levels, "marks": marks, "samples": samples}


SHARD_COLUMNS = "shard bigint, ids array<{id}>, digests array<string>, lengths array<int>, vocabulary binary, levels array<binary>, marks binary, samples binary"


def index_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS, every: int = EVERY) -> DataFrame:
    """The stored index: one row per shard, with the documents' ids, MD5 digests and numbers of words."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType.fromDDL(SHARD_COLUMNS.format(id=rows.schema["id"].dataType.simpleString()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        shard = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def finished() -> pa.RecordBatch:
            row = _shard_row(texts, every)
            row |= {"shard": shard, "ids": pa.concat_arrays(ids).to_pylist(), "digests": [hashlib.md5(t).hexdigest() for t in texts]}
            return pa.RecordBatch.from_pylist([row], schema=kinds)

        for batch in batches:
            whole = text_bytes(batch, "text")
            first = 0
            for i, text in enumerate(whole):
                size += 1 + text.count(b" ") + text.count(b"\n")  # near the number of words; only sets where a shard ends
                if size >= shard_words or i == len(whole) - 1:
                    ids.append(batch.column("id").slice(first, i + 1 - first))
                    texts += whole[first : i + 1]
                    first = i + 1
                if size >= shard_words:
                    yield finished()
                    ids, texts, size, shard = [], [], 0, shard + 1
        if texts:
            yield finished()

    return stored(rows.mapInArrow(run, schema), "fm-index")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(phrase, words, block place) of the distinct windows, and (item, phrase): which items hold them; both stored."""
    rows = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch, "text")):
                words = text.translate(WORD_BYTES).decode("utf-8", "replace").split(" ")
                words = [w for w in words if w]
                windows = {" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()
                if windows:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(windows)), pa.array(sorted(windows))], names=["item", "words"])

    held = stored(rows.mapInArrow(cut, "item string, words string").distinct(), "item-windows")
    phrases = stored(held.select("words").distinct().select(F.monotonically_increasing_id().alias("phrase"), "words"), "phrases")
    return phrases, stored(held.join(phrases, "words").select("item", "phrase"), "item-phrases")


def _search_block(index: DataFrame, names: np.ndarray, words: list[list[str]]) -> DataFrame:
    """(shard, at, spans, phrases): documents, by their place in the shard, that hold phrases of one block."""
    lengths = np.array([len(w) for w in words], np.int64)
    known = sorted({w for phrase in words for w in phrase})
    place = {w: i for i, w in enumerate(known)}
    table = np.zeros((len(words), int(lengths.max())), np.int64)
    for i, phrase in enumerate(words):
        table[i, : len(phrase)] = [place[w] for w in phrase]
    filled = np.arange(table.shape[1])[None, :] < lengths[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                made = search_shard({c: batch.column(c)[row] for c in batch.schema.names})
                if made is not None:
                    yield made

    def search_shard(row: dict) -> pa.RecordBatch | None:
        counts = np.asarray(row["lengths"].values)
        starts = np.cumsum(counts + 1) - counts - 1
        n = int((counts + 1).sum())
        vocabulary = pa.array(row["vocabulary"].as_py().decode("utf-8", "replace").split("\n"))
        symbol = pc.fill_null(pc.index_in(pa.array(known, vocabulary.type), value_set=vocabulary), -1).to_numpy() + 1
        symbols = symbol[table]
        possible = np.flatnonzero(((symbols > 0) | ~filled).all(axis=1))
        if not len(possible):
            return None
        index = FmIndex(n, row["levels"].as_py(), row["marks"].as_py(), row["samples"].as_py())
        which, low, high = index.search(symbols[possible], lengths[possible])
        if not len(which):
            return None
        size = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        which, at = np.repeat(possible[which], size), index.locate(rows)
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + lengths[which], -1)
        covered = np.cumsum(change) > 0
        edge = np.diff(covered.astype(np.int8), prepend=0)
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc_of_span, doc_of_hit = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(np.stack([doc_of_hit, which]), axis=1)
        docs, offsets = np.unique(pairs[0], return_index=True)
        cuts = np.searchsorted(doc_of_span, docs)
        spans = pa.StructArray.from_arrays([pa.array((first - starts[doc_of_span]).astype(np.int32)), pa.array((end - starts[doc_of_span]).astype(np.int32))], ["first", "end"])
        return pa.RecordBatch.from_arrays(
            [pa.array([row["shard"].as_py()] * len(docs), pa.int64()), pa.array(docs.astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(np.append(cuts, len(first)).astype(np.int32)), spans),
             pa.ListArray.from_arrays(pa.array(np.append(offsets, len(pairs[0])).astype(np.int32)), pa.array(names[pairs[1]]))],
            names=["shard", "at", "spans", "phrases"])

    needed = index.select("shard", "lengths", "vocabulary", "levels", "marks", "samples")
    return needed.mapInArrow(run, "shard bigint, at int, spans array<struct<first:int,end:int>>, phrases array<bigint>")


def _merged(spans) -> F.Column:
    """Sorted spans of several blocks, joined where they touch or overlap."""
    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown))
        return F.when((F.size(done) > 0) & (last["end"] >= span["first"]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.expr("cast(array() as array<struct<first:int,end:int>>)"), add)


def find_phrases(index: DataFrame, phrases: DataFrame, block: int = BLOCK) -> DataFrame:
    """(shard, at, spans, phrases) of all documents with any phrase: merged spans of words, and the phrases' names."""
    count = phrases.count()
    blocks = -(-count // block)
    found = []
    for i in range(blocks):
        rows = phrases.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == i).toArrow()
        if rows.num_rows:
            found.append(_search_block(index, rows.column("phrase").to_numpy(), [w.split(" ") for w in rows.column("words").to_pylist()]))
    if not found:
        return index.sparkSession.createDataFrame([], "shard bigint, at int, spans array<struct<first:int,end:int>>, phrases array<bigint>")
    if len(found) == 1:
        return stored(found[0], "fm-hits")
    hits = found[0]
    for part in found[1:]:
        hits = hits.unionByName(part)
    together = stored(hits, "fm-hits").groupBy("shard", "at").agg(F.flatten(F.collect_list("spans")).alias("s"), F.flatten(F.collect_list("phrases")).alias("phrases"))
    return together.select("shard", "at", _merged(F.col("s")).alias("spans"), "phrases")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS, every: int = EVERY, block: int = BLOCK) -> DataFrame:
    """One row per document: id, digest, n_words, spans (first and end word of removals), n_hit, items (sorted texts)."""
    index = index_shards(docs, id_col, text_col, shard_words, every)
    phrases, held = item_windows(items, item_col, item_text_col, window)
    hits = find_phrases(index, phrases, block)
    listed = (
        hits.select("shard", "at", F.explode("phrases").alias("phrase")).join(held, "phrase").groupBy("shard", "at")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    spans = hits.select("shard", "at", "spans").join(listed, ["shard", "at"])
    rows = index.select("shard", F.posexplode(F.arrays_zip("ids", "digests", "lengths")).alias("at", "d"))
    rows = rows.select("shard", "at", F.col("d.ids").alias("id"), F.col("d.digests").alias("digest"), F.col("d.lengths").cast("bigint").alias("n_words"))
    joined = rows.join(spans, ["shard", "at"], "left")
    n_hit = F.aggregate("spans", F.lit(0), lambda sum_, s: sum_ + s["end"] - s["first"])
    return joined.select(
        "id", "digest", "n_words", F.coalesce("spans", F.expr("cast(array() as array<struct<first:int,end:int>>)")).alias("spans"),
        F.coalesce(n_hit, F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    words = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : words[first][0]])
        at = words[end - 1][1]
    return b"".join([*kept, text[at:]])


def remove_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All documents with all their columns, benchmark passages cut out of their texts."""
    found = contamination(docs, items, id_col, text_col, **options).where("n_hit > 0").groupBy("id", "digest").agg(F.first("spans").alias("spans"))
    mine, id_, of_, spans_ = (fresh(name, docs.columns) for name in ("digest_", "id_", "of_", "spans_"))
    keyed = docs.withColumn(mine, F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")))
    renamed = found.withColumnsRenamed({"id": id_, "digest": of_, "spans": spans_})
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(id_)) & (F.col(mine) == F.col(of_))
    joined = keyed.join(renamed, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], spans_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            column = batch.column(place)
            made = [t if not s else without_spans(t.encode(), [(x["first"], x["end"]) for x in s]).decode("utf-8", "replace")
                    for t, s in zip(column.cast(pa.string()).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            arrays = [pa.array(made, column.type) if i == place else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
