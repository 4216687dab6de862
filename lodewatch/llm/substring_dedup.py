"""Repeated passages removed exactly, on a compacted De Bruijn graph of word windows.

Windows of `window` consecutive words are the edges of a De Bruijn graph whose nodes are the windows' ends. The
graph is partitioned by minimisers: a window belongs to the anchor, the least hash among its runs of `anchor` words.
Consecutive windows of a text with one anchor are one row (anchor, hash of the words, anchor of the next row, document,
first word, number of windows), so that a text of n words is about n / 18 rows.

An anchor whose rows all have the same hash does not branch: it is one edge, with n places. One grouped pass gives each edge its
smallest document, n and whether all places have the same successor; an edge and its successor with as many places have
no other neighbour between them. Such unbranched paths are compacted by joins that double pointers, and only their heads
are joined back to the texts' rows: one row per place of a whole path. At anchors that branch (edges of copies and
edited places), windows are compared one by one: their hashes, made anew from the texts of the documents concerned, are
grouped for the smallest document and joined back. Anchors of one document only are dropped before all this.

Spans that touch and lie alike in one source are then joined into long ones, and the source's coordinates verify them: the words
at (source, first word) are read there, and a row loses a span only if its own words have the same SHA-256.

Only narrow rows are shuffled, each hash with partial minima first; hot passages are one row per task there, and the
joins back have one row per document and path, which Spark splits where a key is common. Nothing is collected.

Results by case: null has no words; texts shorter than a window have nothing to remove; very long texts are taken whole (a path
may be as long as its text); ids must be comparable; a row without an id is kept whole and is no source; rows that
share an id are one document for the comparison (none is the smaller one), and each row is cleaned by its own text;
an empty table gives an empty frame; further columns are ignored, names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lodewatch.llm.text import text_bytes
from lodewatch.session import stored

WINDOW = 50
ANCHOR = 16
PLACES = 50_000  # places of one source that are read in one pass over its text
#: Odd multipliers of the two rolling hashes; 3 or 5 modulo 8, so that their powers differ early.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)
_POWERS: dict[int, np.ndarray] = {}


def _inverse(factor: int) -> int:
    return pow(factor, -1, 1 << 64)


def _powers(factor: int, n: int) -> np.ndarray:
    """factor^0 ... factor^(n-1) modulo 2^64; kept and grown by doubling."""
    have = _POWERS.get(factor)
    if have is None or len(have) < n:
        size = 1024
        while size < n:
            size *= 2
        with np.errstate(over="ignore"):
            have = np.ones(size, np.uint64)
            have[1:] = np.uint64(factor)
            have = np.cumprod(have, dtype=np.uint64)
        _POWERS[factor] = have
    return have[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of sums; one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Hashes of runs of words, from prefix sums of word hash times power; fewer `bits` make collisions."""

    def __init__(self, words: list[bytes], bits: int = 64):
        self.n, self.mask = len(words), np.uint64((1 << bits) - 1)
        self.sums, self.back = [], []
        for seed, factor in enumerate(FACTORS):
            own = np.fromiter(map(xxh64_intdigest, words, repeat(seed)), np.uint64, self.n)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * _powers(factor, self.n), dtype=np.uint64)]))
            self.back.append(_powers(_inverse(factor), self.n + 1))

    def runs(self, start: np.ndarray | slice, end: np.ndarray | slice, which: int) -> np.ndarray:
        """Hash of the words start to end (exclusive); slices of places or arrays of them."""
        return _mixed((self.sums[which][end] - self.sums[which][start]) * self.back[which][start]) & self.mask

    def windows(self, size: int, which: int) -> np.ndarray:
        return self.runs(slice(0, self.n - size + 1), slice(size, self.n + 1), which)


def paths(words: list[bytes], window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> tuple[np.ndarray, ...]:
    """(anchor, hash, first word, windows) of the paths of a text with a window at least."""
    hashes = Hashes(words, bits)
    least = hashes.windows(anchor, 0)
    reach, have = window - anchor + 1, 1  # runs that begin in a window
    while have < reach:  # minimum over `have` neighbours, doubled
        step = min(have, reach - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.concatenate([first, [len(least)]]))
    end = first + count + window - 1
    return least[first], hashes.runs(first, end, 1), first, count


PATHS = {"anchor": "bigint", "h1": "bigint", "next": "bigint", "first": "int", "count": "int"}


def document_paths(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """(id, row, anchor, h1, next, first, count): the paths of all texts (id, row, text) with an id; `next` is the anchor of the path that follows."""
    rows = docs.where("id is not null").select("id", "row", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, made = [], []
            for i, text in enumerate(text_bytes(batch, "text")):
                words = text.split()
                if len(words) >= window:
                    made.append(paths(words, window, anchor, bits))
                    whole.append(np.full(len(made[-1][0]), i))
            if made:
                at = pa.array(np.concatenate(whole))
                least, one, first, count = (np.concatenate(c) for c in zip(*made))
                last = np.cumsum([len(m[0]) for m in made]) - 1
                follows = pa.array(np.roll(least, -1).view(np.int64), mask=np.isin(np.arange(len(least)), last))
                arrays = [pa.array(least.view(np.int64)), pa.array(one.view(np.int64)), follows, pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("row").take(at), *arrays], names=["id", "row", *PATHS])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"id {kind}", "row bigint", *[f"{k} {v}" for k, v in PATHS.items()]]))


def _merge(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Sorted spans, joined where they touch."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _windows_of(joined: DataFrame, window: int, bits: int) -> DataFrame:
    """(id, row, h1, h2, first) of the windows of branching paths; `joined` has (id, row, text, parts: first, count)."""
    kind = joined.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, firsts, ones, twos = [], [], [], []
            for i, (text, parts) in enumerate(zip(text_bytes(batch, "text"), batch.column("parts").to_pylist())):
                words = text.split()
                hashes = Hashes(words, bits)
                at = np.unique(np.concatenate([np.arange(p["first"], p["first"] + p["count"]) for p in parts]))
                at = at[at + window <= len(words)]
                whole.append(np.full(len(at), i))
                firsts.append(at.astype(np.int32))
                ones.append(hashes.runs(at, at + window, 0))
                twos.append(hashes.runs(at, at + window, 1))
            if whole:
                at = pa.array(np.concatenate(whole))
                arrays = [pa.array(np.concatenate(x).view(np.int64)) for x in (ones, twos)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("row").take(at), *arrays, pa.array(np.concatenate(firsts))], names=["id", "row", "h1", "h2", "first"])

    return joined.select("id", "row", "text", "parts").mapInArrow(run, f"id {kind}, row bigint, h1 bigint, h2 bigint, first int")


def compacted(plain: DataFrame) -> DataFrame:
    """(anchor, source, count) of the heads of unbranched paths, with the windows of the whole path.

    `plain` has the edges (anchor, source, n, count, next), `next` where the edge has one successor in all its n places. The
    edge after it is its continuation if it has as many places: then it has no other predecessor, and every place of the
    one is followed by a place of the other. Pointers to predecessors are doubled by joins, log2 of the longest path
    rounds; a finite text has an end, so that unbranched paths are no rings.
    """
    before = plain.where("next is not null").select(F.col("next").alias("anchor"), F.col("anchor").alias("up"), F.col("n").alias("up_n"), F.col("count").alias("dist"))
    up = stored(plain.join(before, "anchor").where("n = up_n").select("anchor", "up", F.col("dist").cast("bigint").alias("dist"), "count", F.lit(True).alias("moved")), "links")
    while not up.where("moved").isEmpty():
        over = up.select(F.col("anchor").alias("up"), F.col("up").alias("top"), F.col("dist").alias("more"))
        up = stored(up.join(over, "up", "left").select(
            "anchor", F.coalesce("top", "up").alias("up"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), "count", F.col("top").isNotNull().alias("moved")), "links")
    lengths = up.groupBy(F.col("up").alias("anchor")).agg(F.max(F.col("dist") + F.col("count")).alias("total"))
    heads = plain.join(up, "anchor", "left_anti").join(lengths, "anchor", "left")
    return heads.select("anchor", "source", F.coalesce("total", "count").cast("int").alias("total"))


def _long(spans: DataFrame) -> DataFrame:
    """Spans of one row that touch and lie alike in one source are one."""
    line = ["id", "row", "source_id", "source_row", "shift"]
    met = spans.groupBy(*line).agg(F.collect_list("first").alias("firsts"), F.collect_list("end").alias("ends"))
    kind = spans.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, first, end = [], [], []
            for i in range(batch.num_rows):
                for a, b in _merge(batch.column("firsts")[i].values.to_pylist(), batch.column("ends")[i].values.to_pylist()):
                    at.append(i)
                    first.append(a)
                    end.append(b)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(at, pa.int64())) for c in line], pa.array(first, pa.int32()), pa.array(end, pa.int32())], names=[*line, "first", "end"])

    made = met.mapInArrow(run, f"id {kind}, row bigint, source_id {kind}, source_row bigint, shift int, first int, end int")
    return made.select("id", "row", "first", "end", "source_id", "source_row", (F.col("first") + F.col("shift")).alias("source_first"), (F.col("end") - F.col("first")).alias("length"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text), `row` a hash of the text."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.select("id", F.xxhash64("text").alias("row"), "text")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _at_sources(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans with the SHA-256 of the words at their source's coordinates; those beyond the source's end are left out."""
    place = ["source_id", "source_row", "source_first", "length"]
    order = Window.partitionBy("source_id", "source_row").orderBy("source_first", "length")
    wanted = spans.select(*place).distinct().withColumn("part", F.floor(F.row_number().over(order) / PLACES))
    lists = wanted.groupBy("source_id", "source_row", "part").agg(F.collect_list("source_first").alias("firsts"), F.collect_list("length").alias("lengths"))
    joined = lists.join(texts.withColumnsRenamed({"id": "source_id", "row": "source_row"}), ["source_id", "source_row"])
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, first, length, digest = [], [], [], []
            for i, text in enumerate(text_bytes(batch, "text")):
                words = text.split()
                for a, n in zip(batch.column("firsts")[i].values.to_pylist(), batch.column("lengths")[i].values.to_pylist()):
                    if a + n <= len(words):
                        at.append(i)
                        first.append(a)
                        length.append(n)
                        digest.append(_digest(words[a : a + n]))
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("source_id").take(at), batch.column("source_row").take(at), pa.array(first, pa.int32()), pa.array(length, pa.int32()), pa.array(digest, pa.binary())], names=[*place, "digest"])

    made = joined.select("source_id", "source_row", "firsts", "lengths", "text").mapInArrow(run, f"source_id {kind}, source_row bigint, source_first int, length int, digest binary")
    return spans.join(stored(made.distinct(), "source-words"), place)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """(id, row, first, end, source_id, source_row, source_first, length, digest): long runs of words that repeat those of a smaller document.

    Spans of one row may overlap; their union is what is repeated. `row` is the hash of the text, which tells rows of one
    id apart, and `digest` the SHA-256 of the words found at the source.
    """
    return _spans(_texts(docs, id_col, text_col), window, anchor, bits)


def _spans(texts: DataFrame, window: int, anchor: int, bits: int) -> DataFrame:
    rows = stored(document_paths(texts, window, anchor, bits), "paths")
    edges = rows.groupBy("anchor").agg(
        F.min(F.struct("id", "first", "row")).alias("source"), F.max("id").alias("last"), F.min("h1").alias("low"), F.max("h1").alias("high"),
        F.count("*").alias("n"), F.count("next").alias("follow"), F.min("next").alias("next"), F.max("next").alias("next_high"), F.min("count").alias("count"))
    one_next = F.when((F.col("follow") == F.col("n")) & (F.col("next") == F.col("next_high")), F.col("next"))
    # written before the joins back: Spark splits a common key only where both sides come straight from a shuffle
    shared = stored(edges.where("source.id < last").select("anchor", "source", (F.col("low") != F.col("high")).alias("branches"), "n", one_next.alias("next"), "count"), "edges")
    heads = compacted(shared.where("not branches")).withColumn("branches", F.lit(False))
    looked = stored(heads.unionByName(shared.where("branches").select("anchor", "source", F.lit(None).cast("int").alias("total"), "branches")), "compacted")
    found = stored(rows.join(looked, "anchor").select("id", "row", "first", F.coalesce("total", "count").alias("count"), "source", "branches"), "shared-paths")
    span = ["id", "row", "first", (F.col("first") + F.col("count") + (window - 1)).alias("end"), F.col("source.id").alias("source_id"),
            F.col("source.row").alias("source_row"), (F.col("source.first") - F.col("first")).alias("shift")]
    plain = found.where("not branches and source.id < id").select(*span)
    parts = found.where("branches").groupBy("id", "row").agg(F.collect_list(F.struct("first", "count")).alias("parts"))
    windows = stored(_windows_of(texts.join(parts, ["id", "row"]), window, bits), "windows")
    least = windows.groupBy("h1", "h2").agg(F.min(F.struct("id", "first", "row")).alias("source"), F.max("id").alias("last")).where("source.id < last")
    single = windows.join(stored(least.drop("last"), "sources"), ["h1", "h2"]).where("source.id < id").withColumn("count", F.lit(1)).select(*span)
    return _at_sources(texts, stored(_long(plain.unionByName(single)), "spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    texts = _texts(docs, id_col, text_col)
    return _cleaned(texts, _spans(texts, window, anchor, bits), {"kept": "string"}, lambda kept: (kept.decode("utf-8", "replace"),))


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """The same with the digest of the kept words in place of the text: id, n_words, n_removed, kept_sha256."""
    texts = _texts(docs, id_col, text_col)
    return _cleaned(texts, _spans(texts, window, anchor, bits), {"kept_sha256": "string"}, lambda kept: (hashlib.sha256(kept).hexdigest(),))


def _verified(words: list[bytes], first: list[int], end: list[int], digest: list[bytes]) -> list[tuple[int, int]]:
    """The spans whose words are those at the source, joined."""
    same = [(a, b) for a, b, d in zip(first, end, digest) if b <= len(words) and _digest(words[a:b]) == d]
    return _merge(*zip(*same)) if same else []


def _cleaned(texts: DataFrame, spans: DataFrame, columns: dict[str, str], of) -> DataFrame:
    """A row's spans meet on it: at most as many as it has windows."""
    given = ["first", "end", "digest"]
    by_row = spans.groupBy("id", "row").agg(*[F.collect_list(c).alias(c) for c in given])
    joined = texts.join(by_row, ["id", "row"], "left")
    kind = texts.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", "n_words bigint", "n_removed bigint", *[f"{k} {v}" for k, v in columns.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in enumerate(text_bytes(batch, "text")):
                words, values = text.split(), [batch.column(c)[i].as_py() for c in given]
                kept, at = [], 0
                for start, end in _verified(words, *values) if values[0] else []:
                    kept += words[at:start]
                    at = max(at, end)
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), *of(b" ".join(kept))))
            if rows:
                made = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c) for c in made]], names=["id", "n_words", "n_removed", *columns])

    return joined.select("id", "text", *given).mapInArrow(run, schema)
