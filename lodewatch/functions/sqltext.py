"""Questions asked of logged SQL text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodewatch.functions.keys import as_col

# Literals and comments are blanked in one alternation, so that neither can hide the
# other; quoted identifiers are kept (group 1).
# No part repeats a group, which the engine would do by recursion: texts of any length pass.
MASK = r"""(?s)("[^"]*")|'[^']*'|--[^\n]*|/\*.*?\*/"""
PART = r"""(?:"[^"]+"|\w+)"""
NAME = rf"({PART}(?:\s*\.\s*{PART})*)"
# Group 1: what the statement does, group 2: its target.
HEAD = (
    r"(?is)^\s*(?:with\b.*?\b)?"
    r"(create(?:\s+or\s+replace)?(?:\s+(?:global|local|temporary|temp|unlogged|recursive|materialized))*\s+(?:table|view)"
    r"|insert\s+into|merge\s+into)"
    rf"\s+(?:if\s+not\s+exists\s+)?{NAME}"
)
QUERY = r"(?i)\b(?:select|with|values|table)\b"
READ = rf"(?i)\b(?:from|join|using)\s+(?:only\s+)?{NAME}"

CREATE_TABLE_AS = "create_table_as"
INSERT = "insert"
CREATE_VIEW = "create_view"
MERGE = "merge"
UNTRACKED = "untracked"


def clean_sql(sql: Column | str) -> Column:
    """Text without comments and string literals."""
    text = as_col(sql)
    maskable = text.contains("'") | text.contains("--") | text.contains("/*")
    return F.when(maskable, F.regexp_replace(text, MASK, "$1 ")).otherwise(text)


def is_internal(sql: Column | str) -> Column:
    """Statements on the database's own catalog tables."""
    return as_col(sql).rlike(r"\spg_")


def bind_params(sql: Column | str) -> Column:
    """The i-th `%s` becomes the number i."""
    parts = F.split(as_col(sql), "%s", -1)
    last = F.size(parts) - 1
    numbered = F.transform(
        parts, lambda text, i: F.concat(text, F.when(i < last, i.cast("string")).otherwise(F.lit("")))
    )
    return F.array_join(numbered, "")


def statement_type(clean: Column | str) -> Column:
    """Kind of a statement; a table created without a query is untracked, as is any other statement."""
    c = as_col(clean)
    verb = F.lower(F.regexp_extract(c, HEAD, 1))
    after = F.regexp_replace(c, HEAD, "")
    return (
        F.when(verb.startswith("insert"), INSERT)
        .when(verb.startswith("merge"), MERGE)
        .when(verb.endswith("view"), CREATE_VIEW)
        .when(verb.endswith("table") & after.rlike(QUERY), CREATE_TABLE_AS)
        .otherwise(UNTRACKED)
    )


def _unquote(name: Column) -> Column:
    """Name without quotes and without blanks around its dots."""
    return F.translate(name, '" \t\r\n', "")


def input_tables(clean: Column | str) -> Column:
    """Distinct names after FROM, JOIN and USING, in order of appearance."""
    found = F.regexp_extract_all(as_col(clean), F.lit(READ), F.lit(1))
    return F.array_distinct(F.transform(found, _unquote))


def output_tables(clean: Column | str) -> Column:
    """The target of a create, insert or merge; empty for anything else."""
    target = F.nullif(_unquote(F.regexp_extract(as_col(clean), HEAD, 2)), F.lit(""))
    return F.array_compact(F.array(target))


def qualified_only(names: Column | str) -> Column:
    """Names with exactly three parts; drops the aliases of WITH queries."""
    return F.filter(as_col(names), lambda n: F.size(F.split(n, r"\.")) == 3)


def source_uri(host: Column, port: Column, table: Column | str) -> Column:
    return F.format_string("postgres://%s:%s/%s", host, port.cast("string"), as_col(table))


def model_application(model: Column | str) -> Column:
    return F.concat(F.lit("dbt :: "), as_col(model))


def model_version(explicit: Column, project_version: Column) -> Column:
    return F.coalesce(explicit, F.concat(F.lit("v"), project_version))
