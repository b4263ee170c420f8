"""Column values as text: one expression per wire type, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schemas import JDBC, WIRE

ZERO_DATETIME, ZERO_DATE, ZERO_TIME, ZERO_YEAR = (
    "0000-00-00 00:00:00", "0000-00-00", "00:00:00", "0000",
)
# An unsigned number of this byte length moves up to this type.
RAISED_TYPE = {1: "SMALLINT", 2: "INTEGER", 3: "INTEGER", 4: "BIGINT", 8: "DECIMAL"}
TEXT_TYPES = ["TEXT", "TINYTEXT", "MEDIUMTEXT", "LONGTEXT"]
INTEGER_JDBC = [JDBC[t] for t in ("INTEGER", "TINYINT", "SMALLINT", "BIGINT")]
BYTES_JDBC = [JDBC[t] for t in ("BINARY", "VARBINARY", "LONGVARBINARY")]


def _div(a: Column, b: int) -> Column:
    """Integer quotient of a non-negative bigint, exact at any size."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


# Text is laid out by one pattern over zero-padded digits. The cell renderer holds
# every type in one expression, and the JVM compiles only methods that stay small.
def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("bigint").cast("string"), width, "0")


def _datetime_text(yyyymmddhhmmss: Column) -> Column:
    return F.regexp_replace(
        _digits(yyyymmddhhmmss, 14), r"(.{4})(..)(..)(..)(..)(..)", "$1-$2-$3 $4:$5:$6")


def _date_text(yyyymmdd: Column) -> Column:
    return F.regexp_replace(_digits(yyyymmdd, 8), r"(.{4})(..)(..)", "$1-$2-$3")


def _time_text(hhmmss: Column) -> Column:
    """Two or three hour digits, with the sign of the number."""
    text = F.regexp_replace(
        _digits(F.abs(hhmmss), 7), r"\A0?(\d{2,3})(\d\d)(\d\d)\z", "$1:$2:$3")
    return F.concat(F.when(hhmmss < 0, "-").otherwise(""), text)


def effective_type(mysql_type: Column, meta: Column) -> Column:
    """Wire type of a STRING column once its meta says CHAR, ENUM or SET."""
    high = F.shiftright(meta, 8)
    known = high.isin(WIRE["SET"], WIRE["ENUM"], WIRE["STRING"])
    inner = (
        F.when(high.bitwiseAND(0x30) != 0x30, high.bitwiseOR(0x30))
        .when(known, high).otherwise(mysql_type)
    )
    return F.when((mysql_type == WIRE["STRING"]) & (meta >= 256), inner).otherwise(mysql_type)


def sql_type_code(mysql_type: Column, meta: Column, is_binary: Column) -> Column:
    """JDBC type code of a wire type."""
    kind = effective_type(mysql_type, meta)
    groups = {
        "BIGINT": ["LONGLONG"], "INTEGER": ["LONG", "INT24", "ENUM"], "TINYINT": ["TINY"],
        "SMALLINT": ["SHORT"], "DECIMAL": ["NEWDECIMAL", "DECIMAL"],
        "TIMESTAMP": ["DATETIME", "DATETIME2", "TIMESTAMP", "TIMESTAMP2"],
        "REAL": ["FLOAT"], "DOUBLE": ["DOUBLE"], "BIT": ["BIT"], "TIME": ["TIME", "TIME2"],
        "DATE": ["DATE", "NEWDATE"], "BINARY": ["SET", "GEOMETRY"],
    }
    binary = F.coalesce(is_binary, F.lit(False))
    blobs = [WIRE[t] for t in ("TINY_BLOB", "MEDIUM_BLOB", "LONG_BLOB", "BLOB")]
    code = F.when(
        kind.isin(WIRE["VARCHAR"], WIRE["VAR_STRING"]),
        F.when(binary, JDBC["VARBINARY"]).otherwise(JDBC["VARCHAR"]),
    ).when(
        kind.isin(blobs), F.when(meta == 1, JDBC["VARBINARY"]).otherwise(JDBC["LONGVARBINARY"])
    ).when(
        kind == WIRE["STRING"], F.when(binary, JDBC["BINARY"]).otherwise(JDBC["CHAR"])
    ).when(kind == WIRE["YEAR"], JDBC["VARCHAR"])
    for jdbc, wires in groups.items():
        code = code.when(kind.isin([WIRE[w] for w in wires]), JDBC[jdbc])
    return code.otherwise(JDBC["OTHER"])


def widen_unsigned(raw: Column, byte_len: Column, sql_type: Column, unsigned: Column) -> Column:
    """``struct(value, sql_type)``: a negative unsigned number moves up one type."""
    negative = F.coalesce(unsigned, F.lit(False)) & (raw < 0)
    one = F.lit(1).cast("bigint")
    # 20 digits hold every unsigned 8-byte number.
    widest = raw.cast("decimal(20,0)") + F.lit(str(1 << 64)).cast("decimal(20,0)")
    value = F.when(
        byte_len.isin(1, 2, 3, 4), (raw + F.call_function("shiftleft", one, byte_len * 8)).cast("string")
    ).when(byte_len == 8, widest.cast("decimal(20,0)").cast("string"))
    code = sql_type
    for size, raised in RAISED_TYPE.items():
        code = F.when(byte_len == size, JDBC[raised]).otherwise(code)
    return F.struct(
        F.when(negative, value).otherwise(raw.cast("string")).alias("value"),
        F.when(negative, code).otherwise(sql_type).alias("sql_type"),
    )


def _shift_point(n: Column) -> Column:
    """Plain text of struct(sign, whole, digits, exponent)."""
    point, size = n["whole"] + n["exponent"], F.length(n["digits"])
    left = (
        F.when(point <= 0, F.lit("0"))
        .when(point >= size, F.rpad(n["digits"], point, "0"))
        .otherwise(F.substring(n["digits"], F.lit(1), point))
    )
    right = (
        F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), n["digits"]))
        .when(point >= size, F.lit(""))
        .otherwise(F.substring(n["digits"], point + 1, size))
    )
    tail = F.when(right != "", F.concat(F.lit("."), right)).otherwise("")
    return F.concat(n["sign"], F.regexp_replace(left, r"\A0+(?=\d)", ""), tail)


def render_decimal(text: Column) -> Column:
    """Decimal text without an exponent, digits kept as sent."""
    whole = F.regexp_extract(text, r"\A\s*[+-]?(\d*)", 1)
    exponent = F.regexp_extract(text, r"[eE]([+-]?\d+)\z", 1).try_cast("int")
    number = F.struct(
        F.regexp_extract(text, r"\A\s*(-?)", 1).alias("sign"), F.length(whole).alias("whole"),
        F.concat(whole, F.regexp_extract(text, r"\.(\d*)", 1)).alias("digits"),
        F.coalesce(exponent, F.lit(0)).alias("exponent"),
    )
    # Exponents are rare; the lambda reads each part once and stays out of the hot code.
    moved = F.get(F.transform(F.array(number), _shift_point), F.lit(0))
    return F.when(text.rlike("[eE]"), moved).otherwise(text)


def render_bit(raw_bin: Column) -> Column:
    """Big-endian bits as a number; a single byte is read signed."""
    number = F.conv(F.hex(raw_bin), 16, 10)
    byte = number.cast("int")
    signed = F.when(byte > 127, byte - 256).otherwise(byte).cast("string")
    return F.when(F.octet_length(raw_bin) == 1, signed).otherwise(number)


def datetime2_number(packed: Column) -> Column:
    """``YYYYMMDDhhmmss`` of year*13+month, day, hour, minute, second bit fields."""
    ym, days = F.shiftright(packed, 22), F.shiftright(packed, 17) % 32
    hours, minutes = F.shiftright(packed, 12) % 32, F.shiftright(packed, 6) % 64
    date = _div(ym, 13) * 10_000 + ym % 13 * 100 + days
    return date * 1_000_000 + hours * 10_000 + minutes * 100 + packed % 64


def time2_number(packed: Column) -> Column:
    """Signed ``hhmmss`` of hour (10 bits), minute (6) and second (6)."""
    size = F.abs(packed)
    hms = F.shiftright(size, 12) % 1024 * 10_000 + F.shiftright(size, 6) % 64 * 100 + size % 64
    return F.when(packed < 0, -hms).otherwise(hms)


def render_datetime(packed: Column) -> Column:
    """``YYYYMMDDhhmmss`` packed in a bigint."""
    return F.when(packed == 0, ZERO_DATETIME).otherwise(_datetime_text(packed))


def render_datetime2(packed: Column) -> Column:
    """Bit-field date and time; the fraction is ignored."""
    return F.when(packed == 0, ZERO_DATETIME).otherwise(_datetime_text(datetime2_number(packed)))


def render_date(packed: Column) -> Column:
    number = _div(packed, 512) * 10_000 + _div(packed, 32) % 16 * 100 + packed % 32
    return F.when(packed == 0, ZERO_DATE).otherwise(_date_text(number))


def render_time(packed: Column) -> Column:
    """Signed ``hhmmss`` up to 838 hours."""
    return F.when(packed == 0, ZERO_TIME).otherwise(_time_text(packed))


def render_time2(packed: Column) -> Column:
    """Bit-field time of day or span, with its sign."""
    return F.when(packed == 0, ZERO_TIME).otherwise(_time_text(time2_number(packed)))


def render_timestamp(seconds: Column, tz: str | None = None) -> Column:
    """Epoch seconds in the time zone ``tz``, by default the session's.

    With ``tz`` the seconds are added to the epoch in UTC: the session's wall clock, on which an
    hour of autumn stands twice, plays no part.
    """
    if tz is None:
        text = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    else:
        zero = F.lit(0)
        since = F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
        utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
        text = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc).cast("string")
    return F.when(seconds == 0, ZERO_DATETIME).otherwise(text)


def render_timestamp2(
    seconds: Column, micros: Column, fsp: Column | None = None, tz: str | None = None
) -> Column:
    """Epoch seconds, with ``fsp`` fraction digits when asked for."""
    text = render_timestamp(seconds, tz)
    if fsp is None:
        return text
    fraction = F.substring(F.lpad(micros.cast("string"), 6, "0"), F.lit(1), fsp)
    return F.when((seconds == 0) | (fsp == 0), text).otherwise(F.concat_ws(".", text, fraction))


def render_year(value: Column) -> Column:
    return F.when(value == 0, ZERO_YEAR).otherwise((value + 1900).cast("string"))


def is_text_type(column_type: Column) -> Column:
    return F.coalesce(F.upper(column_type).isin(TEXT_TYPES), F.lit(False))


def is_binary_type(column_type: Column) -> Column:
    return F.coalesce(F.contains(F.upper(column_type), F.lit("BINARY")), F.lit(False))


def decode_bytes(raw_bin: Column, is_text: Column, charset: str = "UTF-8") -> Column:
    """``struct(value, sql_type)``: text types by the job charset, all else byte for byte.

    Malformed bytes become the replacement character and never stop the job. UTF-8 needs no
    setting for that; other charsets rest on the two legacy settings in ``session.SETTINGS``.
    """
    if charset.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        text = F.make_valid_utf8(raw_bin.cast("string"))
    else:
        text = F.decode(raw_bin, charset)
    return F.struct(
        F.when(is_text, text)
        .otherwise(F.decode(raw_bin, "ISO-8859-1")).alias("value"),
        F.when(is_text, JDBC["CLOB"]).otherwise(JDBC["BLOB"]).alias("sql_type"),
    )
