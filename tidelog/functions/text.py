"""Statement text and table-name patterns, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: statement patterns (any case, dot matches newline, whole text)
STATEMENT_PATTERNS: list[tuple[str, str, int]] = [
    # kind, pattern, group holding the table text (0: none)
    ("ALTER", r"\s*ALTER\s*(IGNORE)?\s*TABLE\s*(.*)", 2),
    ("CREATE", r"\s*CREATE\s*(TEMPORARY)?\s*TABLE\s*(.*)", 2),
    ("ERASE", r"\s*DROP\s*(TEMPORARY)?\s*TABLE\s*(.*)", 2),
    ("TRUNCATE", r"\s*TRUNCATE\s*(TABLE)?\s*(.*)", 2),
    ("RENAME", r"\s*RENAME\s*TABLE\s*(.*?)\s*TO\s*(.*?)", 2),
    ("CINDEX", r"\s*CREATE\s*.*?\s*INDEX\s*(.*?)\s*ON\s*(.*?)", 2),
    ("DINDEX", r"\s*DROP\s*INDEX\s*(.*?)\s*ON\s*(.*?)", 2),
    ("INSERT", r"\s*(INSERT|MERGE|REPLACE)(.*)", 0),
    ("UPDATE", r"\s*UPDATE(.*)", 0),
    ("DELETE", r"\s*DELETE(.*)", 0),
]
TABLE_TEXT = r"(?is)\A(?:IF\s*NOT\s*EXISTS\s*)?(?:IF\s*EXISTS\s*)?(.+?[;(\s])"
COMMENT = r"(?s)/\*(?:/|.*?\*/)"
#: Parts of an ALTER that leave the columns as they are, and those that change them.
NOT_COLUMNS = (r"(?i)\b(ADD|DROP|RENAME)\s+(INDEX|KEY|CONSTRAINT|PRIMARY|UNIQUE|FULLTEXT|SPATIAL"
               r"|FOREIGN|PARTITION|CHECK)\b")
CHANGES_COLUMNS = r"(?i)\b(ADD|DROP|CHANGE|MODIFY)[\s`(]|\bRENAME\s+COLUMN\b"
DDL_KINDS = ["ALTER", "CREATE", "ERASE", "TRUNCATE", "RENAME", "CINDEX", "DINDEX"]
DML_KINDS = ["INSERT", "UPDATE", "DELETE"]
# --- End of fixed values ----------------------------------------------------


def _whole(pattern: str) -> str:
    return rf"(?is)\A{pattern}\z"


def strip_comments(query: Column) -> Column:
    """Each comment becomes one space; an unterminated one stays."""
    return F.regexp_replace(query, COMMENT, " ")


def statement_kind(query: Column) -> Column:
    """First matching kind of a statement without comments, else QUERY."""
    (first, pattern, _), *rest = STATEMENT_PATTERNS
    kind = F.when(query.rlike(_whole(pattern)), first)
    for name, pattern, _ in rest:
        kind = kind.when(query.rlike(_whole(pattern)), name)
    return kind.otherwise("QUERY")


def _unquote(text: Column) -> Column:
    """Drop one trailing and one leading back-tick."""
    return F.regexp_replace(F.regexp_replace(text, r"`\z", ""), r"\A`", "")


def table_name(text: Column, default_db: Column) -> Column:
    """``struct(db, tbl)`` named by the text after the statement's keywords."""
    found = F.regexp_extract(F.concat(text, F.lit(" ")), TABLE_TEXT, 1)
    bare = F.regexp_replace(F.regexp_replace(found, r";\z", ""), r"\(\z", "")
    trimmed = F.regexp_replace(bare, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")
    parts = F.filter(F.split(_unquote(trimmed), r"\."), lambda p: p != "")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.struct(
        F.when(second.isNotNull(), _unquote(first)).otherwise(default_db).alias("db"),
        _unquote(F.coalesce(second, first)).alias("tbl"),
    )


def table_text(query: Column) -> Column:
    """Text after the keywords of the first DDL pattern that fits; null for the rest."""
    text = None
    for kind, pattern, group in STATEMENT_PATTERNS:
        if kind in DDL_KINDS:
            fits, value = query.rlike(_whole(pattern)), F.regexp_extract(query, _whole(pattern), group)
            text = F.when(fits, value) if text is None else text.when(fits, value)
    return text


def rename_origin(query: Column) -> Column:
    """Text between RENAME TABLE and the first TO; null when the pattern does not fit."""
    pattern = _whole(next(p for k, p, _ in STATEMENT_PATTERNS if k == "RENAME"))
    return F.when(query.rlike(pattern), F.regexp_extract(query, pattern, 1))


def statement_table(query: Column, default_db: Column) -> Column:
    """``struct(db, tbl)`` a DDL statement acts on; null table when none is named."""
    name = table_name(table_text(query), default_db)
    return F.struct(
        F.coalesce(F.nullif(name["db"], F.lit("")), default_db).alias("db"),
        F.nullif(name["tbl"], F.lit("")).alias("tbl"),
    )


def rename_endpoints(query: Column, default_db: Column) -> Column:
    """Target and original of a RENAME; all null for other statements."""
    is_rename = statement_kind(query) == "RENAME"
    target = table_name(table_text(query), default_db)
    origin = table_name(rename_origin(query), default_db)

    def named(part: Column) -> Column:
        return F.when(is_rename, F.nullif(part, F.lit("")))

    return F.struct(
        named(target["db"]).alias("db"), named(target["tbl"]).alias("tbl"),
        named(origin["db"]).alias("old_db"), named(origin["tbl"]).alias("old_tbl"),
    )


def pattern_list(patterns: str) -> str:
    """Comma list of patterns as one alternation."""
    return "|".join(f"(?:{p})" for p in patterns.split(",") if p)


def matches_any(name: Column, patterns: str | None = None) -> Column:
    """Case-sensitive full match against a comma list of patterns."""
    joined = pattern_list(r".*\.*" if patterns is None else patterns)
    return name.rlike(rf"\A(?:{joined})\z")


def matches_any_ci(name: Column, patterns: str | None) -> Column:
    """Any-case full match; an empty pattern list or an empty name passes."""
    joined = pattern_list(patterns or "")
    if not joined:
        return F.lit(True)
    hit = F.lower(name).rlike(rf"(?is)\A(?:{joined})\z")
    return F.coalesce((name == "") | hit, F.lit(True))


def changes_columns(query: Column, kind: Column) -> Column:
    """Whether a statement without comments leaves its table with other columns: an ALTER that adds,
    drops, changes or renames one; a DROP or RENAME of the table. Indexes, keys, partitions and
    table options are no columns; text in quotes is not looked at."""
    bare = F.regexp_replace(F.regexp_replace(query, r"'[^']*'", "''"), r"`[^`]*`", "`")
    rest = F.regexp_replace(bare, NOT_COLUMNS, " ")
    return F.coalesce(F.when(kind == "ALTER", rest.rlike(CHANGES_COLUMNS)).otherwise(
        kind.isin("ERASE", "RENAME")), F.lit(False))
