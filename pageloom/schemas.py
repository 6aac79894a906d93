"""Schemas shared by the readers and the operators."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

# One <page> element. Only the named fields are read; `text` is a struct because
# the element carries attributes. The first title counts, so all are read.
PAGE_XML = (
    "title array<string>, "
    "revision array<struct<timestamp: string, text: struct<_VALUE: string>>>, "
    f"{CORRUPT} string"
)
