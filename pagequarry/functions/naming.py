"""Names derived from file names: ids, types, categories and output paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.config import DOC_ID_CHARS, FILE_TYPES


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(filename: Column) -> Column:
    """File name without its last suffix; a leading or trailing dot starts no suffix."""
    return F.regexp_replace(filename, r"(?s)^(.+)\.[^.]+$", "$1")


def suffix(filename: Column) -> Column:
    return F.regexp_extract(filename, r"(?s)^.+(\.[^.]+)$", 1)


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "")


def doc_id(filename: Column) -> Column:
    return F.substring(safe_name(stem(filename)), 1, DOC_ID_CHARS)


def has_supported_suffix(path: Column) -> Column:
    """Case-sensitive, as the folder scan is."""
    return reduce(lambda a, b: a | b, [path.endswith(s) for s in FILE_TYPES])


def file_type(filename: Column) -> Column:
    """Type by lower-cased suffix; null when unsupported."""
    ext = F.lower(suffix(filename))
    return reduce(lambda acc, kv: acc.when(ext == kv[0], kv[1]), FILE_TYPES.items(), F.when(F.lit(False), None))


def category(filename: Column) -> Column:
    name = F.lower(filename)
    return (
        F.when(name.contains("transcript"), "transcript")
        .when(name.contains("bank") | name.contains("statement"), "financial")
        .when(name.contains("report") | name.contains("exhibit") | name.contains("affidavit"), "legal")
        .otherwise("other")
    )


def md_path(cat: Column, name: Column) -> Column:
    return F.concat(F.lit("md/"), cat, F.lit("/"), name, F.lit(".md"))


def csv_path(cat: Column, name: Column) -> Column:
    return F.concat(F.lit("csv/"), cat, F.lit("/"), name, F.lit(".csv"))


def log_path(doc: Column) -> Column:
    return F.concat(F.lit("logs/"), doc, F.lit(".log"))


def page_name(doc: Column, page: Column) -> Column:
    return F.concat(doc, F.lit("_p"), page.cast("string"))


def table_name(doc: Column, table_idx: Column) -> Column:
    return F.concat(doc, F.lit("_table"), table_idx.cast("string"))


def sheet_output_name(doc: Column, sheet: Column) -> Column:
    return F.concat(doc, F.lit("_"), safe_name(sheet))


def page_from_name(file_stem: Column) -> Column:
    """Page number after the last ``_p`` of a stem; null when there is none or it is no integer."""
    tail = F.element_at(F.split(file_stem, "_p"), -1)
    digits = F.element_at(F.split(tail, "_"), 1)
    return F.when(file_stem.contains("_p"), digits.try_cast("int"))
