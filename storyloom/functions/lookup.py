"""Dictionary lookups inside a row, on the JVM and without a join or shuffle."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# A table above this size does not belong in a plan; use operators.joins.lookup_join.
MAX_LITERAL_ENTRIES = 50_000


def hash_lookup(table: dict, value_type: str) -> Callable[[Column], Column]:
    """A function ``word -> value`` (null when absent) over a literal hash table.

    Spark scans a map literal from end to end, so the table is spread over buckets
    by ``crc32`` and each lookup scans one bucket of about four entries.
    """
    if len(table) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"{len(table)} entries: use lookup_join for a table of this size")
    if not table:
        return lambda word: F.lit(None).cast(value_type)
    n = 1
    while n * 4 < len(table):
        n *= 2
    buckets: list[dict] = [{} for _ in range(n)]
    for key, value in table.items():
        buckets[zlib.crc32(key.encode("utf-8")) % n][key] = value
    literal = F.from_json(
        F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<map<string,{value_type}>>"
    )
    if n == 1:
        return lambda word: F.get(literal, F.lit(0))[word]
    return lambda word: F.get(literal, F.pmod(F.crc32(word.cast("binary")), F.lit(n)).cast("int"))[word]
