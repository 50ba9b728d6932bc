"""CRC-32 in DuckDB's SQL, which has no function for it: the table of the polynomial from its rule, then byte by byte."""

#: A common table expression crc_table(t), for crc32_sql.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)),
lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(n)))"""


def crc32_sql(text: str) -> str:
    """CRC-32, unsigned, of an ASCII text; t is the table."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
