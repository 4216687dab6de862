"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Two first-order models over characters (letters without case) are learned from labelled samples, one of random
strings and one of ordinary identifiers. A candidate is a run of `LONG` or more letters, digits and `+/_=-`; it is
added as a span of kind `random` if the log-likelihood ratio of its transitions, summed, is at least `ratio` and
no span of the patterns overlaps it. Where the caller has no labelled samples, the corpus labels them itself:
values that the patterns find are random strings, runs of `WORDY` or more characters elsewhere are ordinary, if they
do not have both letters and digits.

Everything is built of Spark expressions: matches and the text between them give positions by running sums of
lengths; transitions are counted by a grouped aggregate with at most 2 x 43 x 43 result rows, which is all that
reaches the driver; the table of ratios, 43 x 43 numbers, goes into the plan as a constant array.

Results by case: null counts as empty; empty texts have no spans; repeated rows get a row each; an empty table
gives an empty frame; further columns of the input are ignored, names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: kinds in the order of the output, their patterns and least lengths
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
VALUE_LENGTH = 8
KINDS = ["assign", "access", "hex", "random"]

LONG = 20  # characters of a candidate
WORDY = 12  # characters of an ordinary identifier that is learned from
RATIO = 8.0  # least sum of log-likelihood ratios
RUN = "[A-Za-z0-9+/_=-]"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-."
N = len(LETTERS) + 1  # place 0: the start of a string


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """array<struct<start, kind, end, value>> of the matches, code points, end exclusive; `value` is the group.

    Matches whose value is shorter than `least` are dropped, but use up what they have matched.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    both = F.zip_with(F.zip_with(found, values, lambda m, v: F.struct(m.alias("m"), v.alias("v"))), between,
                      lambda f, gap: F.struct(F.char_length(gap).alias("gap"), F.char_length(f["m"]).alias("n"), f["v"].alias("v")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["n"]
        span = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), x["v"].alias("value")))
        keep = F.char_length(x["v"]) >= least if least else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.from_json(F.lit("[]"), "array<struct<start:int,kind:int,end:int,value:string>>")
    matched = F.filter(both, lambda x: x["n"].isNotNull())
    spans = F.aggregate(matched, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, per kind leftmost and not overlapping."""
    return F.concat(_spans(text, ASSIGN, "assign", 2, VALUE_LENGTH), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))


def _overlaps(spans: str):
    return lambda c: F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    return rows.withColumn("base", base_spans(F.col("text")))


def label_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(value, secret) from the corpus itself: pattern values, and long runs of letters or of digits that no pattern touches."""
    rows = _base(docs, id_col, text_col)
    secret = rows.where(F.size("base") > 0).select(F.explode("base.value").alias("value"), F.lit(True).alias("secret"))
    runs = F.regexp_extract_all(F.col("text"), F.lit(RUN + "{%d,}" % WORDY), F.lit(0))
    mixed = "[0-9][^0-9]*[A-Za-z]|[A-Za-z][^A-Za-z]*[0-9]"  # letters and digits: may be a secret, not labelled
    free = F.filter(runs, lambda r: ~r.rlike(mixed) & ~F.exists("base", lambda b: F.contains(r, b["value"]) | F.contains(b["value"], r)))
    return secret.unionByName(rows.select(F.explode(free).alias("value"), F.lit(False).alias("secret")))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios random against ordinary, `N` x `N` by last and next character.

    A random string's next character is drawn half as learned and half evenly, since samples of one alphabet
    (hexadecimal keys) must not speak against another; ordinary ones start from one count each. Without samples
    every ratio is 0.
    """
    chars = F.split(F.lower(F.concat(F.lit("\u0001"), "value")), "")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(chars) - 1, F.lit(1))), lambda i: F.struct(F.get(chars, i - 1).alias("a"), F.get(chars, i).alias("b")))
    counted = samples.where(F.length("value") > 0).select("secret", F.explode(pairs).alias("p")).groupBy("secret", "p.a", "p.b").count()
    known = counted.withColumn("i", F.expr(f"instr('{LETTERS}', a)")).withColumn("j", F.expr(f"instr('{LETTERS}', b)")).where("j > 0")
    seen = {True: [[0.0] * N for _ in range(N)], False: [[0.0] * N for _ in range(N)]}
    for r in known.groupBy("secret", "i", "j").agg(F.sum("count").alias("n")).collect():
        seen[r["secret"]][r["i"]][r["j"]] += r["n"]
    table, even = [], 1 / (N - 1)
    for random, plain in zip(seen[True], seen[False]):
        n_random, n_plain = sum(random), sum(plain)
        for j in range(N):
            learned = random[j] / n_random if n_random else even
            ordinary = (plain[j] + 1) / (n_plain + N - 1)
            table.append(math.log((learned + even) / 2) - math.log(ordinary) if j else 0.0)
    return table


def ratio_of(value: Column, table: list[float]) -> Column:
    """Sum of the ratios of a string's transitions; characters outside the alphabet end one chain and start another."""
    ratios = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    step = lambda acc, c: F.struct(
        F.instr(F.lit(LETTERS), c).alias("last"),
        (acc["sum"] + F.get(ratios, acc["last"] * N + F.instr(F.lit(LETTERS), c))).alias("sum"),
    )
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(F.lower(value), ""), start, step, lambda acc: acc["sum"])


def scan(docs: DataFrame, table: list[float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         long: int = LONG, ratio: float = RATIO) -> DataFrame:
    """One row per document: id, base and all: arrays of (start, kind, end, value) in the order of the output."""
    table = train(label_samples(docs, id_col, text_col)) if table is None else table
    rows = _base(docs, id_col, text_col)
    candidates = F.filter(_spans(F.col("text"), RUN + "{%d,}" % long, "random"), lambda c: ~_overlaps("base")(c) & (ratio_of(c["value"], table) >= ratio))
    return rows.select("id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", candidates)).alias("all"))


def listed(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
