"""Pieces of SQL that several twins share."""

from __future__ import annotations

#: Opens a WITH clause with the table that ``crc32_of`` reads.
CRC32 = """
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS steps
  FROM (SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))
)"""


def crc32_of(value: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, where ``crc_table`` stands in the FROM clause."""
    return (
        f"xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda b: ('0x' || b)::BIGINT), "
        "lambda c, b: xor(steps[xor(c, b) % 256 + 1], c >> 8)))"
    )

