"""The CRC-32 of a text's UTF-8 bytes as DuckDB SQL, for queries whose contract uses it."""

#: A CTE with the 256 remainders of one byte, made by the usual rule.
CRC_CTE = """crc as (select list(v order by i) as t from (select i, list_reduce(
  list_prepend(i::bigint, range(8)), lambda c, k:
  case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) x(i)))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the text expression; ``crc`` must be among the tables joined."""
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
  regexp_extract_all(hex(encode({text})), '..'), lambda k: ('0x' || k)::bigint)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
