"""Table shapes and the fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: event type codes and their display names -----------------
EVENT_NAMES: dict[int, str] = {
    1: "Start_v3",
    2: "Query",
    3: "Stop",
    4: "Rotate",
    5: "Intvar",
    6: "Load",
    7: "Slave",
    8: "Create_file",
    9: "Append_block",
    10: "Exec_load",
    11: "Delete_file",
    12: "New_load",
    13: "RAND",
    14: "User var",
    15: "Format_desc",
    16: "Xid",
    17: "Begin_load_query",
    18: "Execute_load_query",
    19: "Table_map",
    20: "Write_rows_event_old",
    21: "Update_rows_event_old",
    22: "Delete_rows_event_old",
    23: "Write_rows_v1",
    24: "Update_rows_v1",
    25: "Delete_rows_v1",
    26: "Incident",
    27: "Heartbeat",
    28: "Ignorable",
    29: "Rows_query",
    30: "Write_rows",
    31: "Update_rows",
    32: "Delete_rows",
    33: "Gtid",
    34: "Anonymous_Gtid",
    35: "Previous_gtids",
}
UNKNOWN_EVENT_NAME = "Unknown"
QUERY, ROTATE, INTVAR, RAND, USER_VAR, XID, TABLE_MAP = 2, 4, 5, 13, 14, 16, 19
ROWS_QUERY, ANNOTATE_ROWS, EVENT_CODES_END = 29, 160, 164
INSERT_CODES, UPDATE_CODES, DELETE_CODES = (23, 30), (24, 31), (25, 32)
ROWS_CODES = INSERT_CODES + UPDATE_CODES + DELETE_CODES
STATEMENT_CODES = (ROWS_QUERY, ANNOTATE_ROWS, USER_VAR, INTVAR, RAND)
CONVERTIBLE_CODES = (QUERY, XID) + ROWS_CODES + STATEMENT_CODES
END_OF_STATEMENT_FLAG = 1
DEFAULT_LOGFILE = "mysql-bin.000001"
USER_VAR_STRING = 0

# Entry header values.
HEADER_VERSION, HEADER_ENCODING, HEADER_SOURCE = 1, "UTF-8", "MYSQL"

# Column wire types.
WIRE = {
    "DECIMAL": 0, "TINY": 1, "SHORT": 2, "LONG": 3, "FLOAT": 4, "DOUBLE": 5,
    "TIMESTAMP": 7, "LONGLONG": 8, "INT24": 9, "DATE": 10, "TIME": 11,
    "DATETIME": 12, "YEAR": 13, "NEWDATE": 14, "VARCHAR": 15, "BIT": 16,
    "TIMESTAMP2": 17, "DATETIME2": 18, "TIME2": 19, "NEWDECIMAL": 246,
    "ENUM": 247, "SET": 248, "TINY_BLOB": 249, "MEDIUM_BLOB": 250,
    "LONG_BLOB": 251, "BLOB": 252, "VAR_STRING": 253, "STRING": 254,
    "GEOMETRY": 255,
}
# JDBC type codes.
JDBC = {
    "BIT": -7, "TINYINT": -6, "BIGINT": -5, "LONGVARBINARY": -4, "VARBINARY": -3,
    "BINARY": -2, "CHAR": 1, "DECIMAL": 3, "INTEGER": 4, "SMALLINT": 5, "REAL": 7,
    "DOUBLE": 8, "VARCHAR": 12, "DATE": 91, "TIME": 92, "TIMESTAMP": 93,
    "OTHER": 1111, "BLOB": 2004, "CLOB": 2005,
}
# --- End of fixed values ----------------------------------------------------

_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "binary": T.BinaryType(), "double": T.DoubleType(),
}


def _table(fields: str) -> T.StructType:
    """StructType of ``name type`` pairs; unlike ``fromDDL`` it needs no session."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_EVENT = _table(
    "server_id bigint, seq bigint, type_code int, event_len bigint, log_pos bigint, flags int, "
    "rotate_file string, table_id bigint, db string, tbl string, query string, "
    "session_id bigint, session_db string, xid bigint, var_name string, var_type int, "
    "var_text string, num1 bigint, num2 bigint, ts timestamp"
)
CELL = _table(
    "server_id bigint, seq bigint, row_idx int, image string, ordinal int, mysql_type int, "
    "meta int, byte_len int, raw_long bigint, raw_str string, raw_bin binary, raw_double double"
)
TABLE_META = _table(
    "db string, tbl string, version int, ordinal int, name string, column_type string, "
    "nullable string, column_key string, default_value string, extra string"
)
ENTRY = _table(
    "server_id bigint, seq bigint, type_code int, logfile string, logfile_offset bigint, execute_time bigint, "
    "event_length bigint, db string, tbl string, event_type string, entry_type string, "
    "is_ddl boolean, transaction_id string, thread_id bigint, sql string"
)

#: Type code of lines that hold how often a table's columns changed; no event has it.
TABLE_LINE = -1
#: An order value before every event of a log.
BEFORE_ALL = -(1 << 62)
