from __future__ import annotations

from pyspark.sql import functions as F

from lodewatch.functions import sqltext
from lodewatch.operators import sqllog

LOG = [
    (1, "/* dbt; from no.no.no */ create table \"db\".\"rep\".\"a__dbt_tmp\" as (\n select x, ';' from db . src.one o\n JOIN \"db\".\"src\".\"two\" t using (x) )"),
    (2, "insert into db.rep.b select 'from db.no.no', %s from db.src.one -- join db.no.no\n"),
    (3, "CREATE OR REPLACE VIEW db.rep.c AS WITH s AS (SELECT * FROM db.src.two) SELECT * FROM s; drop table db.rep.x"),
    (4, "select * from pg_class"),
    (5, "merge into db.rep.d t using db.src.three s on t.k = s.k when matched then update set v = 1"),
    (6, "create table db.rep.e (x int)"),
    (7, "  ;; "),
    (8, "update db.rep.b set x = (select max(x) from db.src.one)"),
    (9, "with s as (select * from db.src.two) insert into db.rep.b select * from s"),
    (10, "insert into rep.b select * from db.src.one"),
    (11, "insert into db.rep.b values ('it''s', 2)"),
]


def log(spark):
    return spark.createDataFrame(LOG, "stmt_id long, sql string")


def test_statements(spark):
    got = {(r["stmt_id"], r["stmt_pos"]): (r["stmt_type"], r["inputs"], r["outputs"]) for r in sqllog.tracked_statements(log(spark)).collect()}
    assert got == {
        (1, 0): ("create_table_as", ["db.src.one", "db.src.two"], ["db.rep.a__dbt_tmp"]),
        (2, 0): ("insert", ["db.src.one"], ["db.rep.b"]),
        (3, 0): ("create_view", ["db.src.two"], ["db.rep.c"]),
        (5, 0): ("merge", ["db.src.three"], ["db.rep.d"]),
        (9, 0): ("insert", ["db.src.two"], ["db.rep.b"]),
        (10, 0): ("insert", ["db.src.one"], []),
        (11, 0): ("insert", [], ["db.rep.b"]),
    }


def test_plain_split_and_internal(spark, rows):
    assert rows(sqllog.split_statements(log(spark).where("stmt_id in (3, 7)")), "stmt_id", "stmt_pos") == [(3, 0), (3, 1)]
    assert 4 not in [r["stmt_id"] for r in sqllog.drop_internal(log(spark)).collect()]


def test_bind_params(spark):
    texts = ["a = %s and b = %s", "%s", "none", ""]
    df = spark.createDataFrame([(t,) for t in texts], "sql string")
    got = {r["sql"]: r["x"] for r in df.select("sql", sqltext.bind_params("sql").alias("x")).collect()}
    assert got == {"a = %s and b = %s": "a = 0 and b = 1", "%s": "0", "none": "none", "": ""}


def test_lineage_of_statements(spark):
    fields = spark.createDataFrame(
        [("db.src.one", 0, "x"), ("db.src.one", 1, "y"), ("db.src.two", 0, "p"), ("db.src.two", 1, "q"),
         ("db.rep.a", 0, "x"), ("db.rep.a", 1, "z"), ("db.rep.b", 0, "y"), ("seed.csv", 0, "y")],
        "table_name string, pos int, name string",
    )
    seeds = spark.createDataFrame([(11, "seed.csv"), (1, "seed.csv")], "stmt_id long, table_name string")
    edges = sqllog.statement_lineage(log(spark), fields, seeds)
    got = {(r["lineage_key"], r["input_schema_id"], r["output_field"]): r["input_fields"] for r in edges.collect()}
    assert got == {
        ("1:0:db.rep.a", "db.src.one", "x"): ["x"],
        ("1:0:db.rep.a", "db.src.two", "x"): ["p", "q"],
        ("1:0:db.rep.a", "db.src.two", "z"): ["p", "q"],
        ("2:0:db.rep.b", "db.src.one", "y"): ["y"],
        ("9:0:db.rep.b", "db.src.two", "y"): ["p", "q"],
        ("11:0:db.rep.b", "seed.csv", "y"): ["y"],
    }


def test_names(spark):
    df = spark.createDataFrame([("m", None, "1.2"), ("m", "env", "1.2")], "model string, env string, version string")
    got = df.select(
        sqltext.model_application("model").alias("app"), sqltext.model_version(F.col("env"), F.col("version")).alias("v"),
        sqltext.source_uri(F.lit("h"), F.lit(5432), "model").alias("uri"),
    ).collect()
    assert [tuple(r) for r in got] == [("dbt :: m", "v1.2", "postgres://h:5432/m"), ("dbt :: m", "env", "postgres://h:5432/m")]
