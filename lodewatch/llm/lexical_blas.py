"""Ranked lexical search as blocked dense matrix products.

Items are taken in blocks (at most `items` of them, by a hash of their rows). A block's vocabulary is compact: only its own
terms have numbers. One pass over the documents writes each document's length and the counts of those terms; counting
them there gives document frequencies, and so the weights. A second pass over that narrow table multiplies tiles: the
impacts of `tile_docs` documents for up to `tile_terms` terms (dense, float64) times the weights of the terms for
the items that have any of them. Impacts are integers below 10^6 and a tile's weights of one item add up to less than
2^53 / 10^6, so every partial sum is an exact integer; sums over tiles are 64-bit integers.

A tile passes on each item's scores that reach its k-th highest, ties included; a task keeps the best k by score and then
id, and the same order ranks the tasks' results. No pair of item and document but those is ever a row.

A term is a run of digits, letters and characters beyond ASCII; only A-Z are lower-cased. With N documents that have a
term, L their terms, n a document's terms and df the documents with a term: the weight is
floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N) div L and a term's impact (10^9 tf) div (1000 tf + 20 m).

Memory: a block's texts (`block_bytes`, or one longer item), a tile, and k rows per item and task. Results by case: null
and empty texts have no terms, are not counted in N and never found; items without a known term have no rows; very long
texts are taken whole; equal rows of items are ranked once, rows that share an id but not the text each; repeated
documents are found each; null ids of documents come last among equal scores; empty tables give an empty frame.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.llm.fm_decontam import text_words
from lodewatch.llm.text import text_bytes
from lodewatch.session import stored

TOP = 50
ITEMS = 512
BLOCK_BYTES = 1 << 20
TILE_DOCS = 1024
TILE_TERMS = 2048
SLICE = 1000  # documents whose words are held at once
#: Fixed values of the score: scale of weights and impacts, and the shares of a document's length.
WEIGHT_SCALE, IMPACT_SCALE, BASE_LENGTH, LENGTH_SHARE = 1000, 10**9, 50, 50
IMPACT_LIMIT = IMPACT_SCALE // 1000


def term_counts(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(id, n, terms, counts) of all documents (id, text): number of all terms, and counts of those in the vocabulary."""
    kind = docs.schema["id"].dataType.simpleString()
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, SLICE):
                batch = whole.slice(low, SLICE)
                words, n = text_words(text_bytes(batch, "text"))
                term = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy()
                at = np.repeat(np.arange(len(n)), n)[term >= 0]
                key, count = np.unique(at * size + term[term >= 0], return_counts=True)
                cuts = np.searchsorted(key, np.arange(len(n) + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int32))) for x in (key % size, count)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), *lists], names=["id", "n", "terms", "counts"])

    return docs.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, counts array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Tiles:
    """The weights of a block's items, cut into tiles of terms; a tile has only the items with a term in it."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weights: np.ndarray, n_items: int, tile_terms: int):
        """`item` and `term` list each item's terms once; `weights` are those of the terms."""
        heaviest = max(1, int(weights.max(initial=1)))
        self.width = max(1, min(tile_terms, (2**53 - 1) // (IMPACT_LIMIT * heaviest)))
        self.n_items, self.parts = n_items, []
        order = np.argsort(term, kind="stable")
        item, term = item[order], term[order]
        for low in range(0, len(weights), self.width):
            inside = slice(*np.searchsorted(term, [low, low + self.width]))
            columns, place = np.unique(item[inside], return_inverse=True)
            self.parts.append((low, columns, term[inside] - low, place, weights[term[inside]].astype(np.float64)))

    def scores(self, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int) -> np.ndarray:
        """Exact scores (n_rows x items) from the impacts of terms in rows."""
        total = np.zeros((n_rows, self.n_items), np.int64)
        for low, columns, at, place, value in self.parts:
            inside = (term >= low) & (term < low + self.width)
            if not len(columns) or not inside.any():
                continue
            left = np.zeros((n_rows, self.width))
            left[row[inside], term[inside] - low] = impact[inside]
            right = np.zeros((self.width, len(columns)))
            right[at, place] = value
            total[:, columns] += np.rint(left @ right).astype(np.int64)
        return total


def impacts(n: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impacts of terms that occur `tf` times in documents of `n` terms."""
    length = BASE_LENGTH + (LENGTH_SHARE * n * n_docs) // n_terms
    return (IMPACT_SCALE * tf) // (1000 * tf + 20 * length)


def _best(pool: list[tuple], new: list[tuple], top: int) -> list[tuple]:
    """Best `top` of (-score, id is null, id)."""
    return heapq.nsmallest(top, pool + new)


def _block_ranking(rows: DataFrame, tiles: Tiles, names: pa.Array, item_kind: str, n_docs: int, n_terms: int, top: int, tile_docs: int) -> DataFrame:
    """(place, item, id, score): the best of each task."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools: list[list[tuple]] = [[] for _ in range(tiles.n_items)]
        need = np.ones(tiles.n_items, np.int64)  # scores below cannot enter any more
        id_type = None
        for whole in batches:
            id_type = whole.schema.field("id").type
            for low in range(0, whole.num_rows, tile_docs):
                batch = whole.slice(low, tile_docs)
                lists = batch.column("terms")
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), sizes)
                term = lists.flatten().to_numpy(zero_copy_only=False)
                tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                got = tiles.scores(row, term, impacts(batch.column("n").to_numpy()[row], tf, n_docs, n_terms), batch.num_rows)
                border = need
                if batch.num_rows > top:
                    border = np.maximum(need, np.partition(got, batch.num_rows - top, axis=0)[batch.num_rows - top])
                item, at = np.nonzero((got >= border).T)
                ids = batch.column("id").take(pa.array(at)).to_pylist()
                cuts = np.searchsorted(item, np.arange(tiles.n_items + 1))
                score = got[at, item].tolist()
                for q in np.unique(item).tolist():
                    new = [(-score[i], ids[i] is None, ids[i] if ids[i] is not None else 0) for i in range(cuts[q], cuts[q + 1])]
                    pools[q] = _best(pools[q], new, top)
                    if len(pools[q]) == top:
                        need[q] = -pools[q][-1][0]
        flat = [(q, -s, None if null else i) for q, pool in enumerate(pools) for s, null, i in pool]
        if flat:
            place, score, ids = zip(*flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int32()), names.take(pa.array(place)), pa.array(ids, id_type), pa.array(score, pa.int64())], names=["place", "item", "id", "score"])

    return rows.mapInArrow(run, f"place int, item {item_kind}, id {kind}, score bigint")


def _rank_block(texts: DataFrame, items: pa.Table, item_kind: str, top: int, tile_docs: int, tile_terms: int) -> DataFrame | None:
    words, n = text_words(text_bytes(items.combine_chunks().to_batches()[0], "text"))
    if not len(words):
        return None
    coded = words.dictionary_encode()
    size = len(coded.dictionary)
    pairs = np.unique(np.repeat(np.arange(len(n)), n) * size + coded.indices.to_numpy())
    rows = stored(term_counts(texts, coded.dictionary), "term-counts")
    n_docs, n_terms = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    found = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
    tiles = Tiles(pairs // size, pairs % size, weights, len(n), tile_terms)
    names = items.column("item").combine_chunks()
    best = _block_ranking(rows, tiles, names, item_kind, n_docs, n_terms, top, tile_docs)
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return stored(best, "tile-best").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item", "rank", "id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", top: int = TOP, block_items: int = ITEMS, block_bytes: int = BLOCK_BYTES,
                   tile_docs: int = TILE_DOCS, tile_terms: int = TILE_TERMS) -> DataFrame:
    """(item, rank, id, score): each item's `top` documents of the highest scores above 0, equal scores by id."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = stored(items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).distinct(), "items")
    item_kind = asked.schema["item"].dataType.simpleString()
    count, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(math.ceil(count / block_items), math.ceil((size or 0) / block_bytes))
    made = []
    for i in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).toArrow()
        if block.num_rows:
            made.append(_rank_block(texts, block, item_kind, top, tile_docs, tile_terms))
    found = [part for part in made if part is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item {item_kind}, rank int, id {texts.schema['id'].dataType.simpleString()}, score bigint")
    return reduce(DataFrame.unionByName, found)
