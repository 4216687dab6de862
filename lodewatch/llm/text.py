"""Shared helpers on whole texts: words, Arrow batches, fresh column names.

A word is a maximal run of characters other than the six ASCII blanks. Those blanks are single bytes in UTF-8
and are what `bytes.split()` without arguments splits at, so Python tasks work on the bytes that Arrow holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BLANKS = " \t\n\x0b\x0c\r"


class Remembered(dict):
    """Remembers a function's results for the first `most` keys; frequent keys come early. Never grows beyond."""

    def __init__(self, function, most: int):
        self.function, self.most = function, most

    def __missing__(self, key):
        got = self.function(key)
        if len(self) < self.most:
            self[key] = got
        return got


def _each_blank(text: Column, blanks: str, by: str) -> Column:
    """Plain replacements: several times faster than `translate` or a pattern, which look at every character."""
    for blank in blanks:
        text = F.replace(text, F.lit(blank), F.lit(by))
    return text


def without_blanks(text: Column) -> Column:
    """The text without its blanks; null stays null."""
    return _each_blank(text, BLANKS, "")


def row_key(identity: Column, digest: Column) -> Column:
    """One exact join key for (id, digest); a null id differs from every id."""
    return F.unhex(F.sha2(F.concat(digest, F.coalesce(F.concat(F.lit("i"), identity.cast("string")), F.lit("n")).cast("binary")), 256))


def keep_rows(docs: DataFrame, kept: DataFrame, identity: Column, digest: Column) -> DataFrame:
    """The rows of `docs` whose key is in `kept` (row_key_), each key once, with all columns and no others."""
    same = Window.partitionBy("row_key_").orderBy("row_key_")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"), row_key(identity, digest).alias("row_key_"))
    joined = packed.join(kept, "row_key_", "left_semi")
    return joined.withColumn("copy_", F.row_number().over(same)).where("copy_ = 1").select("row_.*")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null.

    Where no two blanks meet, words are the blanks inside the trimmed text and one more; the pattern counts the rest.
    """
    def count(spaced: Column) -> Column:
        blanks = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
        plain = F.when(spaced == "", F.lit(0)).otherwise(blanks + 1)
        return F.when(F.contains(spaced, F.lit("  ")), F.regexp_count(spaced, F.lit("[^ ]+"))).otherwise(plain)

    # the lambda's variable is made once, where a column used several times would be made several times
    one = F.transform(F.array(F.trim(_each_blank(text, BLANKS[1:], " "))), count)
    return F.coalesce(F.get(one, 0).cast("bigint"), F.lit(0).cast("bigint"))


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def fresh(name: str, taken: list[str]) -> str:
    """`name`, with underscores in front until no column (in any letter case) has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def map_texts(df: DataFrame, text: str, columns: dict[str, str], function: Callable[..., list[tuple]],
              keep: list[str] | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Appends columns computed from each text, batch by batch; the rows' order and number stay.

    `columns` are the new names with their SQL types; `function` gets the texts of a batch and returns one
    tuple per text. `keep` are the columns of `df` to carry along (default: all); only they and the text are read.
    `also` are some of them whose values the function gets as further lists.
    """
    keep = df.columns if keep is None else keep
    carried = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(fresh("text_", keep)))
    source = carried.columns[-1]
    added = StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in columns.items()))
    schema = StructType([*carried.schema.fields[:-1], *[StructField(f.name, f.dataType) for f in added]])
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in added]
        for batch in batches:
            if not batch.num_rows:
                continue
            made = list(zip(*function(text_bytes(batch, source), *[batch.column(keep.index(c)).to_pylist() for c in also])))
            old = [batch.column(i) for i in range(len(keep))]
            new = [pa.array(values, kind) for values, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*old, *new], names=[*keep, *names])

    return carried.mapInArrow(run, schema)
