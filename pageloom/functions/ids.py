"""Vertex ids, edge ids, property keys and sink keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ImportConfig
from .strings import KEY_SEPARATOR, base64_utf8, java_trim


def vertex_id(title: Column, cfg: ImportConfig = DEFAULT_CONFIG) -> Column:
    return F.concat(F.lit(cfg.id_prefix), java_trim(title))


def title_from_id(vid: Column, cfg: ImportConfig = DEFAULT_CONFIG) -> Column:
    return F.substring(vid, len(cfg.id_prefix) + 1, 2**31 - 1)


def edge_id(src: Column, dst: Column, cfg: ImportConfig = DEFAULT_CONFIG) -> Column:
    return F.concat(
        F.lit(cfg.link_id_prefix), title_from_id(src, cfg), F.lit("_"), title_from_id(dst, cfg)
    )


def title_key(target: Column, cfg: ImportConfig = DEFAULT_CONFIG) -> Column:
    """Property key of a title that was only seen through a link."""
    return F.concat(
        F.lit(cfg.multi_value_key + "#"), base64_utf8(F.lower(java_trim(target)))
    )


def sink_key(table: Column, row_key: Column) -> Column:
    """Table name and base64 row key in one string."""
    return F.concat(table, F.lit(KEY_SEPARATOR), base64_utf8(row_key))


def split_key(key: Column) -> Column:
    """Table name of a sink key; a key without the separator is an error."""
    return F.when(
        F.contains(key, F.lit(KEY_SEPARATOR)), F.substring_index(key, KEY_SEPARATOR, 1)
    ).otherwise(F.raise_error(F.concat(F.lit("invalid sink key: "), key)))
