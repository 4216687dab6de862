"""Quality rules whose cutoffs are chosen by risk control on labelled documents.

Each rule rejects a document whose metric is above the rule's cutoff of its stratum (the language by default). For
a cutoff, the good labelled documents of the stratum that it would reject are counted, k of n. It is certified if
the exact binomial tail P(Bin(n, limit) <= k) is at most `error` / (rules x strata): then the chance that the true
share of falsely rejected good documents passes `limit` is below that. Cutoffs are tried from lenient to strict and
the first failure ends the row (fixed-sequence testing, so the steps of one rule need no further correction); the
strictest certified cutoff holds. Rules and strata are corrected by Bonferroni, so with probability 1 - `error` no
rule in any stratum wrongly rejects more than `limit` of its good documents.

Strata with so few good labels that not even k = 0 would be certified are pooled to one further stratum, which the correction
counts: its cutoffs hold for all of them together (marked `pooled`), and the limit is kept over the pool and not
in each of its members. The pool is chosen by numbers of labels alone, before any metric is looked at. Where the pool
has too few labels as well, or a stratum has none at all, nothing is certified and nothing rejected.

The metrics are ratios: symbols per word, repeated lines per line, words in repeated windows per word, characters
per word. The holdout is every labelled good document; cutoffs are not fitted to it in any other way.

Results by case: null or empty text has no words and zero metrics; null stratum is one of its own; a document with several
labels is good if all of them are; labels without a document or without a value do nothing; repeated rows are judged alike;
an empty table gives an empty frame; columns of the input stay, new ones get underscores in front where names clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm.text import fresh, map_texts
from lodewatch.session import stored

# fixed values: symbols of the base rule
SYMBOLS = b"#*$%&|<>"
BLANK_BYTES = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 50

#: Metric by rule, with its cutoffs from lenient to strict.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35]),
    "repeats": ("n_repeat_words / n_words", [0.5, 0.45, 0.4, 0.35, 0.3, 0.25]),
    "length": ("word_chars / n_words", [20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0]),
}
LIMIT = 0.005  # share of good documents of a stratum that one rule may reject
ERROR = 0.05  # chance that any of these limits is passed
STATS = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_lines": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint"}


def text_stats(text: bytes) -> tuple[int, int, int, int, int, int]:
    """Words, their characters, symbols, lines with a word, repeats of earlier lines, words in repeated windows of three."""
    words = text.split()
    dense = text.translate(None, BLANK_BYTES)
    chars = len(dense) if dense.isascii() else len(dense.decode("utf-8", "replace"))
    symbols = len(dense) - len(dense.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        covered = 0  # words before this place are counted
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeats += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeats


def _stats(texts: list[bytes]) -> list[tuple]:
    return [text_stats(t) for t in texts]


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed term by term; 1 where k is not below the mean, which no test needs exactly."""
    if k >= n * p:
        return 1.0
    log_p, log_q, whole = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    return math.fsum(math.exp(whole - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * log_p + (n - j) * log_q) for j in range(k + 1))


def _metric(rule: str) -> F.Column:
    above, below = RULES[rule][0].split(" / ")
    return F.coalesce(F.try_divide(F.col(above).cast("double"), F.col(below).cast("double")), F.lit(0.0))


def cutoffs(stats: DataFrame, labels: DataFrame, id_col: str, stratum: str, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """(stratum_, pooled, one column per rule): the certified cutoffs, null where nothing is certified.

    `pooled` tells that they are those of the pool of small strata. One row per stratum; counts are made on the executors, with one partial row per task and stratum.
    """
    good = labels.where("quality is not null").groupBy(F.col("doc_id").alias("good_id_")).agg(F.min("quality").alias("good_")).where("good_ = 1")
    held = stats.join(good, F.col(f"`{id_col}`") == F.col("good_id_"), "left_semi")
    places = [(rule, i) for rule, (_, grid) in RULES.items() for i in range(len(grid))]
    above = [F.sum((_metric(rule) > RULES[rule][1][i]).cast("bigint")).alias(f"{rule}_{i}") for rule, i in places]
    own = F.col(f"`{stratum}`").cast("string").alias("stratum_")
    strata = stored(held.groupBy(own).agg(F.count(F.lit(1)).alias("n"), *above), "rule-counts")
    level = error / (len(RULES) * (strata.count() + 1))
    marked = strata.withColumn("pooled", F.pow(F.lit(1.0 - limit), F.col("n")) > level).withColumn("group", F.when(~F.col("pooled"), F.col("stratum_")))
    counts = marked.groupBy("pooled", "group").agg(*[F.sum(c).alias(c) for c in ["n", *[f"{rule}_{i}" for rule, i in places]]])

    def certify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rule, (_, grid) in RULES.items():
                chosen = []
                for row in frame.to_dict("records"):
                    last = None
                    for i, cutoff in enumerate(grid):
                        if binomial_tail(int(row[f"{rule}_{i}"]), int(row["n"]), limit) > level:
                            break
                        last = cutoff
                    chosen.append(last)
                frame[rule] = pd.array(chosen, dtype="Float64")
            yield frame[["pooled", "group", *RULES]]

    certified = counts.mapInPandas(certify, ", ".join(["pooled boolean", "group string", *[f"{r} double" for r in RULES]])).withColumnRenamed("pooled", "pooled_group")
    same = (F.col("pooled") == F.col("pooled_group")) & F.col("stratum_group").eqNullSafe(F.col("group"))
    members = marked.select("stratum_", "pooled", F.col("group").alias("stratum_group"))
    return stored(members.join(certified, same).select("stratum_", "pooled", *RULES), "rule-cutoffs")


def verdicts(stats: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """Appends `base_failed`, `rejected_by` (the rules that reject), `pooled` (by cutoffs of the pool) and `kept`.

    Statistics must be there by their plain names.
    """
    joined = stats.join(chosen, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col("stratum_")), "left")
    hits = F.array_compact(F.array(*[F.when(_metric(r) > F.col(f"`{r}`"), F.lit(r)) for r in RULES]))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.withColumns({"base_failed": failed, "rejected_by": hits, "pooled": F.coalesce("pooled", F.lit(False))}).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("stratum_", *RULES)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang",
          limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """One row per document: id, statistics, base_failed, rejected_by, pooled, kept. Texts are read once."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{stratum}`").cast("string").alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
    stats = stored(map_texts(keyed, "text", STATS, _stats, keep=["id", "stratum"]), "rule-stats")
    return verdicts(stats, cutoffs(stats, labels, "id", "stratum", limit, error), "stratum").drop("stratum")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang",
              limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """The documents that pass, with all their columns.

    Statistics are made twice, once narrow for the cutoffs and once beside the texts, which is cheaper than a
    shuffle of all texts and needs no unique ids.
    """
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{stratum}`").cast("string").alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
    narrow = stored(map_texts(keyed, "text", STATS, _stats, keep=["id", "stratum"]), "rule-stats")
    chosen = cutoffs(narrow, labels, "id", "stratum", limit, error)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{stratum}`").cast("string").alias("stratum"), F.col(f"`{text_col}`").cast("string").alias("text"))
    judged = verdicts(map_texts(packed, "text", STATS, _stats, keep=["row", "stratum"]), chosen, "stratum")
    return judged.where("kept").select("row.*")
