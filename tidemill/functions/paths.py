"""Object keys, prefixes and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_PATTERN = r"^[a-z0-9]+://([^/]*)/?(.*)$"


def bucket_of(uri: Column) -> Column:
    return F.regexp_extract(uri, URI_PATTERN, 1)


def key_of(uri: Column) -> Column:
    return F.regexp_extract(uri, URI_PATTERN, 2)


def is_prefix(key: Column) -> Column:
    """An empty key or one ending in ``/`` names a prefix, not an object."""
    return (key == "") | key.endswith("/")


def name_of(key: Column) -> Column:
    """The last path segment, ignoring a closing ``/``."""
    return F.element_at(F.split(F.rtrim(key, F.lit("/")), "/"), -1)


def relative_to(key: Column, prefix: str) -> Column:
    """The key below ``prefix``; NULL outside it."""
    return F.when(key.startswith(prefix), F.substring(key, F.lit(len(prefix) + 1), F.length(key)))


def join_key(base: Column, relative: Column) -> Column:
    """``base/relative`` with the base's closing slashes dropped; ``relative`` alone on an empty base."""
    trimmed = F.rtrim(base, F.lit("/"))
    return F.when(trimmed == "", relative).otherwise(F.concat(trimmed, F.lit("/"), relative))


def ancestor_prefixes(key: Column) -> Column:
    """``''``, ``a/``, ``a/b/`` ... : every prefix of the key that ends at a ``/``."""
    parts = F.split(key, "/")
    depth = F.size(parts) - 1
    deeper = F.transform(
        F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
        lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")),
    )
    return F.when(depth == 0, F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), deeper))
