"""Content-hash ids and the text functions their parts are made of."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bytes of these formats decide the ids.
KEY_SEPARATOR = ","
NAME_TYPE_SEPARATOR = "-"
DIRTY_SUFFIX = " (dirty)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """Column by its literal name, also when it holds blanks or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def md5_key(*parts: Column | str) -> Column:
    """md5 hex of the comma-joined parts; a null part is an error, never skipped."""
    checked = [
        F.coalesce(as_col(p).cast("string"), F.raise_error(F.lit("null part in an observation key")).cast("string"))
        for p in parts
    ]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *checked))


def md5_of(*parts: str) -> str:
    """The same id for values already known on the driver (one run, one frame)."""
    return hashlib.md5(KEY_SEPARATOR.join(parts).encode("utf-8")).hexdigest()


def packed_id(text: Column | str) -> Column:
    """Bytes of a text, for tables and shuffles: of an md5 id, whose digits hardly compress, half as many as its digits.

    `unpacked_id` gives the text back, whatever it is; the first byte tells which of both it was.
    """
    t = as_col(text)
    short = F.concat(F.unhex(F.lit("01")), F.unhex(t))
    return F.when(t.rlike(r"\A[0-9a-f]{32}\z"), short).otherwise(F.concat(F.unhex(F.lit("00")), t.cast("binary")))


def unpacked_id(packed: Column | str) -> Column:
    p = as_col(packed)
    body = F.substr(p, F.lit(2), F.length(p))
    return F.when(F.substr(p, F.lit(1), F.lit(1)) == F.unhex(F.lit("01")), F.lower(F.hex(body))).otherwise(body.cast("string"))


def sorted_fields(fields: Column | str) -> Column:
    """(name, dtype) structs in code-point order (UTF-8 byte order is the same)."""
    return F.sort_array(as_col(fields))


def field_list_text(fields: Column | str) -> Column:
    """`name-dtype` of every field, sorted and comma-joined."""
    pairs = F.transform(sorted_fields(fields), lambda f: F.concat(f["name"], F.lit(NAME_TYPE_SEPARATOR), f["dtype"]))
    return F.array_join(pairs, KEY_SEPARATOR)


def schema_key(fields: Column | str, data_source_id: Column | str) -> Column:
    return md5_key(field_list_text(fields), data_source_id)


def linearize(edges: Column | str) -> Column:
    """`out:in1-in2` of every edge struct (output_field, input_fields), comma-joined in array order."""
    texts = F.transform(
        as_col(edges), lambda e: F.concat(e["output_field"], F.lit(":"), F.array_join(e["input_fields"], "-"))
    )
    return F.array_join(texts, ",")


def dict_fields(fields: Column | str) -> Column:
    """Fields as a name -> dtype map."""
    return F.map_from_entries(F.transform(as_col(fields), lambda f: F.struct(f["name"], f["dtype"])))


def split_path(path: Column | str) -> tuple[Column, Column]:
    """(location without extension, format) at the last dot of the path."""
    p = as_col(path)
    pattern = r"^(.*)\.([^.]*)$"
    return F.regexp_extract(p, pattern, 1), F.regexp_extract(p, pattern, 2)


def base_name(path: Column | str) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def extract_server(path: Column | str, local: Column | str = "local") -> Column:
    """The local server for file-like paths, null for any other scheme."""
    value = F.lit(local) if isinstance(local, str) else local
    return F.when(as_col(path).rlike(r"^(file:/|\.|/)"), value)


def qualified_name(
    catalog: Column, schema: Column, relation: Column, default_catalog: str | None = None, default_schema: str | None = None
) -> Column:
    """Non-empty parts joined by dots; null when the relation itself is missing."""
    def part(c: Column, default: str | None) -> Column:
        return F.coalesce(F.nullif(c, F.lit("")), F.lit(default).cast("string"))

    rel = F.nullif(relation, F.lit(""))
    return F.when(
        rel.isNotNull(), F.concat_ws(".", part(catalog, default_catalog), part(schema, default_schema), rel)
    )


def alnum_underscore(text: Column | str) -> Column:
    return F.regexp_replace(as_col(text), "[^A-Za-z0-9_]", "_")


def raw_table_name(stream: Column | str) -> Column:
    """Destination table of a replicated stream."""
    # Fixed value: prefix the destination gives to its raw tables.
    return alnum_underscore(F.concat(F.lit("_airbyte_raw_"), as_col(stream)))


def strip_tmp(name: Column | str) -> Column:
    """Final name of a table that was first built under a temporary name."""
    # Fixed value: suffix of temporary relations.
    return F.replace(as_col(name), F.lit("__dbt_tmp"), F.lit(""))


def iso_time(ts: Column | str) -> Column:
    """ISO-8601 text, the fraction in six digits and only when there is one.

    Made from the plain text of the value, so a naive timestamp does not pass through the session's zone.
    """
    text = F.replace(as_col(ts).cast("string"), F.lit(" "), F.lit("T"))
    fraction = F.rpad(F.substring_index(text, ".", -1), 6, "0")
    return F.when(text.contains("."), F.concat(F.substring_index(text, ".", 1), F.lit("."), fraction)).otherwise(text)


def epoch_ms(ts: Column | str) -> Column:
    """Epoch milliseconds; a naive timestamp is read in the session's zone."""
    return F.unix_millis(as_col(ts).cast("timestamp"))


def dirty_version(version: Column, is_dirty: Column) -> Column:
    return F.when(is_dirty, F.concat(version, F.lit(DIRTY_SUFFIX))).otherwise(version)


def dirty_author(author: Column, user: Column, is_dirty: Column) -> Column:
    """Uncommitted code is attributed to the user who runs it."""
    return F.when(is_dirty, user).otherwise(author)


def json_encode(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))
