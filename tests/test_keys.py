from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodewatch.functions import keys
from lodewatch.functions.messages import text_units


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_md5_of_source_key(spark):
    expected = hashlib.md5(b"data/assets.csv,csv").hexdigest()
    assert keys.md5_of("data/assets.csv", "csv") == expected
    assert one(spark, keys.md5_key(F.lit("data/assets.csv"), F.lit("csv"))) == expected


def test_null_part_is_an_error(spark):
    with pytest.raises(Exception, match="null part"):
        one(spark, keys.md5_key(F.lit("a"), F.lit(None).cast("string")))


def test_linearize(spark):
    edges = F.expr(
        "array(named_struct('output_field', 'Open', 'input_fields', array('Open')),"
        " named_struct('output_field', 'Intraday_Delta', 'input_fields', array('Adj Close', 'Open')))"
    )
    assert one(spark, keys.linearize(edges)) == "Open:Open,Intraday_Delta:Adj Close-Open"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.text("aBé_ z", min_size=1, max_size=4), st.sampled_from(["int", "string"])), min_size=1, max_size=5, unique_by=lambda f: f[0]))
def test_schema_key_does_not_depend_on_field_order(spark, fields):
    listed = ",".join(f"{n}-{t}" for n, t in sorted(fields))
    expected = hashlib.md5(f"{listed},src".encode()).hexdigest()
    structs = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("dtype")) for n, t in fields[::-1]])
    assert one(spark, keys.schema_key(structs, F.lit("src"))) == expected


def test_paths(spark):
    location, fmt = keys.split_path(F.lit("a.b/c.d.csv"))
    assert (one(spark, location), one(spark, fmt)) == ("a.b/c.d", "csv")
    assert one(spark, keys.base_name(F.lit("a/b/c.csv"))) == "c.csv"
    servers = [one(spark, keys.extract_server(F.lit(p))) for p in ("file:/a", "./a", "/a", "hdfs://n/a", "https://h/a")]
    assert servers == ["local", "local", "local", None, None]


def test_qualified_name(spark):
    def name(*parts):
        cols = [F.lit(p).cast("string") for p in parts]
        return one(spark, keys.qualified_name(*cols, default_catalog="db"))

    assert name("c", "s", "r") == "c.s.r"
    assert name(None, "s", "r") == "db.s.r"
    assert name("", "", "r") == "db.r"
    assert name("c", "s", None) is None and name("c", "s", "") is None


def test_text_functions(spark):
    assert one(spark, keys.raw_table_name(F.lit("pf-mun 2019"))) == "_airbyte_raw_pf_mun_2019"
    assert one(spark, keys.strip_tmp(F.lit("a.b.c__dbt_tmp"))) == "a.b.c"
    assert one(spark, keys.iso_time(F.expr("timestamp_ntz'2024-01-02 03:04:05'"))) == "2024-01-02T03:04:05"
    assert one(spark, keys.iso_time(F.expr("timestamp_ntz'2024-01-02 03:04:05.12'"))) == "2024-01-02T03:04:05.120000"
    assert one(spark, text_units(F.lit("a😀é"))) == 4
    dirty = keys.dirty_version(F.lit("v1"), F.lit(True)), keys.dirty_author(F.lit("a"), F.lit("u"), F.lit(True))
    assert [one(spark, c) for c in dirty] == ["v1 (dirty)", "u"]
