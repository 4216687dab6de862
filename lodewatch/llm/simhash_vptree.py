"""Near duplicates by SimHash, linked exactly with vantage-point trees.

A text's fingerprint has a bit set where more than half of its word shingles' hashes have it. Equal fingerprints are
one point. Points link at a Hamming distance of `radius` or less, and classes are the connected components.

Search: a tree over a bounded sample of points gives vantage points and radii for the upper levels. A point goes
to the inner side of a node if its distance d to the vantage point is at most mu + radius, and to the outer side if
d > mu: by the triangle inequality two points within `radius` of each other then share a side, since of a pair that
mu divides the outer point has d <= mu + radius. So shards overlap only along their borders (a point reaches few of
them), and every pair meets in one of them. In a shard the same division goes on without Spark until groups are
small; those are compared in blocks. A group that the division does not make smaller is a dense ball; there points are linked
through their neighbours at distance 1 (points that share one are at most 2 apart, and all such pairs do), which
is linear in the group. A shard gives the links of a spanning forest and not all its pairs.

The tree of the first sample has some two thousand shards at most. A shard with more than four times the points that it aims at is
divided again on Spark, each with a border from a bounded fresh sample of its own points, until none is larger: so the
number of shards follows the number of points. A large shard that no border divides is a dense ball; for radius 2 it
is linked on Spark by the shared neighbours, at most 65 points each, so that no task holds it (for any other radius it is
one group, compared in blocks). Samples only place borders, so results do not depend on them.

Results by case: null and empty texts have the fingerprint 0 and link like any other; ties in the vote are no bit;
repeated rows share a class; null ids are members without being a class's name (a class of null ids only has null);
an empty table gives an empty frame; further columns are ignored here and kept by `keep_one`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lodewatch.llm.components import components
from lodewatch.llm.text import keep_rows, map_texts, row_key
from lodewatch.session import stored

SEED = 42
SHINGLE = 3
RADIUS = 2
SAMPLE = 16_384  # points that place the borders of the shards
SHARD = 20_000  # points that a shard aims at, before overlaps
LARGE = 4  # times this many points, a shard is divided again
BORDER = 4_096  # points of a large shard that place its border
LEAF = 400  # points that are compared in blocks
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def gram_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of the shingles of a text's lower-cased (A-Z) words, in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    return np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64)


def voted(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number; 0 without hashes."""
    if not len(hashes):
        return 0
    columns = hashes.view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BITS for i in range(8)])
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles, as a signed 64-bit number; 0 without words."""
    return voted(gram_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, digest), one row per document, written once; the digest is SHA-256 of the text."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    both = lambda texts: [(fingerprint(t, shingle), hashlib.sha256(t).digest()) for t in texts]
    return stored(map_texts(keyed, "text", {"fp": "bigint", "digest": "binary"}, both, keep=["id"]), "fingerprints")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


class Tree:
    """Upper levels: (vantage, mu, inner, outer) by node; a negative side -s - 1 is shard s."""

    def __init__(self, sample: np.ndarray, shards: int, radius: int, seed: int = 11):
        self.radius, self.nodes, self.shards = radius, [], 0
        rng = np.random.default_rng(seed)
        self.root = self._build(sample, max(0, math.ceil(math.log2(max(1, shards)))), rng)

    def _build(self, points: np.ndarray, levels: int, rng) -> int:
        border = divide(points, self.radius, rng) if levels and len(points) >= 64 else None
        if border is None:
            self.shards += 1
            return -self.shards
        vantage, mu = border
        d = _distance(points, vantage)
        place = len(self.nodes)
        self.nodes.append(None)
        inner = self._build(points[d <= mu + self.radius], levels - 1, rng)
        outer = self._build(points[d > mu], levels - 1, rng)
        self.nodes[place] = (vantage, mu, inner, outer)
        return place

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the point, shard) for each shard that a point reaches."""
        where, shard = [], []
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                where.append(at)
                shard.append(np.full(len(at), -node - 1))
                continue
            vantage, mu, inner, outer = self.nodes[node]
            d = _distance(points[at], vantage)
            todo += [(inner, at[d <= mu + self.radius]), (outer, at[d > mu])]
        return (np.concatenate(where), np.concatenate(shard)) if where else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def divide(points: np.ndarray, radius: int, rng) -> tuple[np.uint64, int] | None:
    """A vantage point and mu so that the larger side is smallest; None where no side is clearly smaller than the whole."""
    best = None
    for vantage in points[rng.integers(0, len(points), 3)]:
        through = np.cumsum(np.bincount(_distance(points, vantage), minlength=65 + radius))  # points within d
        larger = np.maximum(through[radius:65 + radius], len(points) - through[: 65])
        mu = int(larger.argmin())
        if best is None or larger[mu] < best[0]:
            best = (larger[mu], vantage, mu)
    return (best[1], best[2]) if best[0] <= 0.8 * len(points) else None


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    for i, j in zip(a.tolist(), b.tolist()):
        i, j = _root(parent, i), _root(parent, j)
        if i != j:
            parent[max(i, j)] = min(i, j)


def _compare(points: np.ndarray, at: np.ndarray, radius: int, parent: np.ndarray) -> None:
    """Links among the points `at`, in blocks of rows."""
    own = points[at]
    step = max(1, 2_000_000 // max(1, len(own)))
    for low in range(0, len(own), step):
        a, b = np.nonzero(np.bitwise_count(own[low : low + step, None] ^ own[None, low:]) <= radius)
        ahead = b > a
        _join(parent, at[low + a[ahead]], at[low + b[ahead]])


def _dense(points: np.ndarray, at: np.ndarray, parent: np.ndarray) -> None:
    """Links at distance 1 and 2 through shared neighbours at distance 0 or 1."""
    flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
    keys = (points[at][:, None] ^ flips[None, :]).ravel()
    owner = np.repeat(at, len(flips))
    order = np.argsort(keys, kind="stable")
    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    _join(parent, owner[order[same]], owner[order[same + 1]])


def linked(points: np.ndarray, radius: int = RADIUS, leaf: int = LEAF, seed: int = 5) -> np.ndarray:
    """For each distinct point the index of its forest's root, among the points within `radius` of each other."""
    parent = np.arange(len(points))
    rng = np.random.default_rng(seed)
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) < 2:
            continue
        border = divide(points[at], radius, rng) if len(at) > leaf else None
        if border is not None:
            d = _distance(points[at], border[0])
            todo += [at[d <= border[1] + radius], at[d > border[1]]]
        elif radius == 2 and len(at) > 5_000:
            _dense(points, at, parent)
        else:
            _compare(points, at, radius, parent)
    return np.array([_root(parent, i) for i in range(len(points))], np.int64)


def links(points: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect the distinct points `fp` within `radius`, as a spanning forest of each shard."""
    count = points.count()
    placed = points.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = Tree(np.sort(placed), math.ceil(count / shard), radius)

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["fp"].to_numpy(np.int64)
            where, to = tree.route(own.view(np.uint64))
            yield pd.DataFrame({"shard": to.astype(np.int64), "fp": own[where]})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["fp"].to_numpy(np.int64)
        root = linked(own.view(np.uint64), radius, leaf)
        inside = root != np.arange(len(own))
        return pd.DataFrame({"a": own[inside], "b": own[root[inside]]})

    spread_out = points.mapInPandas(spread, "shard long, fp long").withColumn("round", F.lit(0))
    dense = None
    if count > LARGE * shard:
        spread_out, dense = divided(stored(spread_out.drop("round"), "shards"), radius, LARGE * shard, min(sample, BORDER))
    found = spread_out.groupBy("round", "shard").applyInPandas(search, "a long, b long")
    return found if dense is None else found.unionByName(shared_neighbours(dense))


def divided(shards: DataFrame, radius: int, limit: int, sample: int = BORDER) -> tuple[DataFrame, DataFrame | None]:
    """Shards (round, shard, fp) of at most `limit` points, and the points (fp) of dense balls; `shards` is a stored table (shard, fp).

    A round divides all larger shards once; it moves their points only, and each round's points are written.
    """
    def choose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(frame["fp"].to_numpy(np.int64)).view(np.uint64)
        border = divide(own, radius, np.random.default_rng(7))
        chosen = [] if border is None else [(key[0], int(border[0].view(np.int64)), border[1])]
        return pd.DataFrame(chosen, columns=["shard", "vantage", "mu"])

    whole = 1 << 40
    small, balls, step = [], [], 0
    while True:
        sizes = stored(shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit), "large-shards")
        rest = shards if sizes.isEmpty() else shards.join(sizes, "shard", "left_anti")
        small.append(rest.select(F.lit(step).alias("round"), "shard", "fp"))
        if sizes.isEmpty():
            break
        inside = shards.join(sizes, "shard")
        drawn = inside.where(F.pmod(F.xxhash64(F.lit(step), "fp"), F.lit(whole)) < F.lit(whole) * (F.lit(float(sample)) / F.col("n")))
        borders = stored(drawn.groupBy("shard").applyInPandas(choose, "shard long, vantage long, mu int"), "borders")
        ball = shards.join(sizes.join(borders, "shard", "left_anti"), "shard", "left_semi")
        if radius == 2:
            balls.append(ball.select("fp"))
        else:
            small.append(ball.select(F.lit(step).alias("round"), "shard", "fp"))
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage")))
        sides = F.array_compact(F.array(F.when(distance <= F.col("mu") + radius, F.col("shard") * 2), F.when(distance > F.col("mu"), F.col("shard") * 2 + 1)))
        shards = stored(shards.join(borders, "shard").select(F.explode(sides).alias("shard"), "fp"), "shards")
        step += 1
    return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, balls).distinct() if balls else None


def shared_neighbours(points: DataFrame) -> DataFrame:
    """Edges (a, b) among distinct points `fp` that share a neighbour at distance 0 or 1, which has 65 of them at most."""
    flips = F.transform(F.sequence(F.lit(-1), F.lit(63)), lambda i: F.when(i < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))
    by_key = points.select("fp", F.explode(flips).alias("key")).groupBy("key").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("all"))
    return by_key.where(F.size("all") > 1).select(F.explode("all").alias("a"), "b").where("a <> b").distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, sample: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, fp, digest), and names (fp, root, component_id) of the distinct fingerprints."""
    rows = fingerprints(docs, id_col, text_col, shingle)
    points = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "points")
    roots = components(links(points.select("fp"), radius, sample, shard)).withColumnRenamed("vertex", "fp")
    named = points.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return rows, stored(names.select("fp", "root", "component_id"), "names")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                 sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """One row per document: id, fp, component_id (the smallest id of the class)."""
    rows, names = _classes(docs, id_col, text_col, shingle, radius, sample, shard)
    return rows.join(names, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
             sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """One document of each class, that with the smallest id (null last; then by the text's digest), with all columns."""
    rows, names = _classes(docs, id_col, text_col, shingle, radius, sample, shard)
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "digest"))
    by_point = rows.groupBy("fp").agg(first.alias("best")).join(names, "fp")
    kept = by_point.groupBy("root").agg(F.min("best").alias("best")).select(row_key(F.col("best.id"), F.col("best.digest")).alias("row_key_"))
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"), 256))
    return keep_rows(docs, kept, F.col(f"`{id_col}`"), digest)
