"""Row images and cells: split, enriched, rendered, compared and nested again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import values as V
from tidelog.operators.context import is_rows_event, row_kind
from tidelog.operators.ordered import DEFAULT_WIDTH, latest, merged

EVENT_KEY = ["server_id", "seq"]
ROW_KEY = ["server_id", "seq", "row_idx"]
CELL_KEY = ["server_id", "seq", "row_idx", "ordinal"]
VALUE_COLUMNS = [
    "ordinal", "sql_type", "name", "is_key", "updated", "is_null", "value", "mysql_type",
]


def explode_rows(entries: DataFrame) -> DataFrame:
    """One line per row of an entry; INSERT has only after, DELETE only before."""
    kind = F.col("event_type")
    keep = [c for c in entries.columns if c != "row_datas"]
    return entries.select(*keep, F.inline("row_datas")).withColumns({
        "before": F.when(kind != "INSERT", F.col("before")),
        "after": F.when(kind != "DELETE", F.col("after")),
    })


def pair_update_images(images: DataFrame, image_idx: str = "image_idx") -> DataFrame:
    """Alternating before/after images as rows; an odd last image has no after."""
    idx = F.col(image_idx)
    rest = [c for c in images.columns if c not in (*EVENT_KEY, image_idx)]
    image = F.struct(*rest)
    # At most two images meet in a group, so its size does not grow with the event.
    return (
        images.groupBy(*EVENT_KEY, F.shiftright(idx, 1).alias("row_idx"))
        .agg(F.max(F.when(idx % 2 == 0, image)).alias("before"),
             F.max(F.when(idx % 2 == 1, image)).alias("after"))
    )


def explode_columns(rows: DataFrame) -> DataFrame:
    """Cells of each row image, with 0-based index and null flag."""
    images = rows.select(*ROW_KEY, F.explode(F.array(
        F.struct(F.lit("B").alias("image"), F.col("before").alias("cols")),
        F.struct(F.lit("A").alias("image"), F.col("after").alias("cols")),
    )).alias("i"))
    cells = images.select(*ROW_KEY, "i.image", F.posexplode("i.cols").alias("ordinal", "c"))
    return cells.select(
        *ROW_KEY, "image", "ordinal",
        F.col("c.value").isNull().alias("is_null"), F.col("c.value").alias("value"),
    )


def attach_table(cells: DataFrame, resolved_rows: DataFrame) -> DataFrame:
    """Database, table and kind of the rows event each cell belongs to."""
    owner = resolved_rows.filter(F.col("table_error").isNull()).select(
        *EVENT_KEY, "db", "tbl", row_kind().alias("event_type")
    )
    return merged(cells, owner, EVENT_KEY)


def enrich_columns(cells: DataFrame, meta: DataFrame) -> DataFrame:
    """Name, key flag, declared type and unsigned flag by ordinal; null without metadata. Cells
    with a ``version`` get those of that version.

    The metadata grows with the schema, not with the log: no hint is given, so
    Spark broadcasts it only below its size threshold and otherwise splits hot
    tables in the shuffled join. Metadata without a measured size (a list, a remote table)
    should be written first, else all cells of a table meet in one task.
    """
    versions = ["version"] if "version" in cells.columns else []
    described = meta.select(
        "db", "tbl", *versions, "ordinal", "name",
        (F.upper("column_key") == "PRI").alias("is_key"),
        "column_type",
        F.contains(F.lower("column_type"), F.lit("unsigned")).alias("is_unsigned"),
        V.is_text_type(F.col("column_type")).alias("is_text"),
        V.is_binary_type(F.col("column_type")).alias("is_binary"),
    )
    return cells.join(described, ["db", "tbl", *versions, "ordinal"], "left")


def fitting_version(cells: DataFrame) -> DataFrame:
    """Cells of events placed by ``statements.with_versions``: an event wider than its version
    takes the next one, as a reload would. ``check``: ok, reloaded, or error if that is too narrow too.

    The width is taken within the event, where its cells already are together.
    """
    wide = F.max("ordinal").over(Window.partitionBy(*EVENT_KEY)) + 1
    fits = F.col("_width") <= F.col("_fits")
    reloads = F.coalesce(F.col("_width") <= F.col("_next"), F.lit(False))
    return cells.withColumn("_width", wide).withColumns({
        "check": F.when(fits, "ok").when(reloads, "reloaded").otherwise("error"),
        "version": F.when(fits | F.col("_next").isNull(), F.col("version")).otherwise(
            F.col("version") + 1),
    }).drop("_width", "_fits", "_next")


def column_error(table: Column, width: Column, named: Column) -> Column:
    """Why an event of ``width`` columns cannot be described by ``named`` ones, else null."""
    return F.when(named == 0, F.concat(F.lit("no metadata for table:"), table)).when(
        width > named, F.concat(
            F.lit("column size is not match for table:"), table, F.lit(","),
            width.cast("string"), F.lit(" vs "), named.cast("string")))


def check_column_count(
    widths: DataFrame, versions: DataFrame, width: int = DEFAULT_WIDTH
) -> DataFrame:
    """Event width against the metadata in force, then once against the next version.

    ``widths``: server_id, seq, db, tbl, width. ``versions``: one line per
    interval (server_id, db, tbl, valid_from, valid_to, meta_width, next_width).
    Each interval is a line of the log at its begin that carries its widths, so an event finds
    them among the lines before it: no join on the table, however hot it is.
    """
    by = ["server_id", "db", "tbl"]
    start = F.lit(-(1 << 62))
    begins = versions.select(
        *by, F.coalesce("valid_from", start).alias("seq"),
        F.struct(*[c for c in versions.columns if c not in by]).alias("_begin"))
    both = widths.unionByName(begins, allowMissingColumns=True)
    placed = latest(both, by, "seq", {"_v": F.col("_begin")}, width=width).filter(
        F.col("width").isNotNull() & F.col("_v").isNotNull())
    joined = placed.select(*widths.columns, "_v.*")
    fits = F.col("width") <= F.col("meta_width")
    reloaded = F.coalesce(F.col("width") <= F.col("next_width"), F.lit(False))
    message = F.concat(
        F.lit("column size is not match for table:"), F.col("db"), F.lit("."), F.col("tbl"),
        F.lit(","), F.col("width").cast("string"), F.lit(" vs "),
        F.coalesce("next_width", "meta_width").cast("string"),
    )
    return joined.withColumns({
        "check": F.when(fits, "ok").when(reloaded, "reloaded").otherwise("error"),
        "error": F.when(~fits & ~reloaded, message),
    })


def event_widths(cells: DataFrame) -> DataFrame:
    """Number of columns of each event."""
    return cells.groupBy(*EVENT_KEY, "db", "tbl").agg((F.max("ordinal") + 1).alias("width"))


def version_widths(versions: DataFrame, meta: DataFrame) -> DataFrame:
    """Width of each metadata version in force, and of the version after it."""
    widths = meta.groupBy("db", "tbl", "version").agg(F.count(F.lit(1)).cast("int").alias("_w"))
    at = ["server_id", "db", "tbl", "interval", "version", "valid_from", "valid_to"]
    spans = versions.select(*at).distinct()
    here = widths.withColumnRenamed("_w", "meta_width")
    after = widths.select("db", "tbl", (F.col("version") - 1).alias("version"),
                          F.col("_w").alias("next_width"))
    keys = ["db", "tbl", "version"]
    return spans.join(here, keys).join(after, keys, "left")


def render_cells(
    cells: DataFrame, charset: str = "UTF-8", tz: str | None = None
) -> DataFrame:
    """Text value and JDBC type of each enriched cell; ``tz`` is the zone of timestamps.

    A TIMESTAMP2 cell with ``raw_micros`` shows as many digits of it as its ``meta`` says.
    """
    w = S.WIRE
    raw, text, data = F.col("raw_long"), F.col("raw_str"), F.col("raw_bin")
    # Logs without floating point columns may leave the cell's number out.
    number = F.col("raw_double") if "raw_double" in cells.columns else F.lit(None).cast("double")
    micros = F.col("raw_micros") if "raw_micros" in cells.columns else F.lit(None).cast("bigint")
    kind, base = F.col("_kind"), F.col("_base")
    staged = cells.withColumn(
        "_kind", V.effective_type(F.col("mysql_type"), F.col("meta"))
    ).withColumn("_base", V.sql_type_code(kind, F.col("meta"), F.col("is_binary")))
    wide = V.widen_unsigned(raw, F.col("byte_len"), base, F.col("is_unsigned"))
    decoded = V.decode_bytes(F.coalesce(data, F.encode(text, charset)), F.col("is_text"), charset)
    is_int, is_bytes = base.isin(V.INTEGER_JDBC), base.isin(V.BYTES_JDBC)
    value = (
        F.when(is_int, wide["value"])
        .when(is_bytes, decoded["value"])
        .when(kind == w["NEWDECIMAL"], V.render_decimal(text))
        .when(kind.isin(w["DATETIME"], w["DATETIME2"]), V.render_datetime(
            F.when(kind == w["DATETIME"], raw).otherwise(V.datetime2_number(raw))))
        .when((kind == w["TIMESTAMP2"]) & micros.isNotNull(), V.render_timestamp2(
            raw, micros, F.coalesce(F.col("meta").cast("int"), F.lit(0)), tz))
        .when(kind.isin(w["TIMESTAMP"], w["TIMESTAMP2"]), V.render_timestamp(raw, tz))
        .when(kind == w["FLOAT"], F.coalesce(number.cast("float").cast("string"), text))
        .when(kind == w["DOUBLE"], F.coalesce(number.cast("string"), text))
        .when(kind == w["DATE"], V.render_date(raw))
        .when(kind.isin(w["TIME"], w["TIME2"]), V.render_time(
            F.when(kind == w["TIME"], raw).otherwise(V.time2_number(raw))))
        .when(kind == w["YEAR"], V.render_year(raw))
        .when(kind == w["BIT"], V.render_bit(data))
        .otherwise(F.coalesce(text, raw.cast("string")))
    )
    present = F.coalesce(raw.isNotNull() | text.isNotNull() | data.isNotNull() | number.isNotNull(), F.lit(False))
    code = (
        F.when(~present, base).when(is_int, wide["sql_type"])
        .when(is_bytes, decoded["sql_type"]).otherwise(base)
    )
    return staged.withColumns(
        {"value": F.when(present, value), "sql_type": code}).drop("_kind", "_base")


def flag_updated(cells: DataFrame) -> DataFrame:
    """After cells that differ, null-safely, from the before cell at their index.

    In a row ordered by index with the before image first, an after cell's
    counterpart is the cell just ahead of it.
    """
    in_row = Window.partitionBy(*ROW_KEY).orderBy("ordinal", F.col("image").desc())
    ahead = F.lag(F.struct("image", "ordinal", "value")).over(in_row)
    old = F.col("_ahead")
    has_old = (old["image"] == "B") & (old["ordinal"] == F.col("ordinal"))
    changed = (F.col("image") == "A") & has_old & ~F.col("value").eqNullSafe(old["value"])
    return cells.withColumn("_ahead", ahead).withColumn(
        "updated", F.coalesce(changed, F.lit(False))).drop("_ahead")


def effective_image(cells: DataFrame) -> DataFrame:
    """The image a listing shows: before for DELETE, after otherwise."""
    shown = F.when(F.col("event_type") == "DELETE", "B").otherwise("A")
    return cells.filter(F.col("image") == shown)


def changed_or_key_columns(cells: DataFrame) -> DataFrame:
    """For UPDATE, the after cells that are key or changed."""
    return cells.filter(
        (F.col("event_type") == "UPDATE") & (F.col("image") == "A")
        & (F.col("is_key") | F.col("updated"))
    )


def row_images(cells: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cells of each row as ordered before and after arrays.

    Cells are placed by event before; sorted by row within that, they are gathered row by row, and
    the rows event by event, in one pass each.
    """
    item = F.struct(*(columns or VALUE_COLUMNS))
    kept, more = [*ROW_KEY], []
    if "_table" in cells.columns:  # also the row's width, and the columns of it that have a name
        kept += ["_table", "ordinal", F.when(F.col("name").isNotNull(), F.col("ordinal")).alias("named")]
        # Not count_distinct: beside other aggregates it groups every cell of the log by itself first.
        more = [F.max("_table").alias("_table"), (F.max("ordinal") + 1).alias("width"),
                F.size(F.collect_set("named")).cast("bigint").alias("named")]
    placed = cells.select(
        *kept, F.when(F.col("image") == "B", item).alias("before"),
        F.when(F.col("image") == "A", item).alias("after")).sortWithinPartitions(*ROW_KEY)
    return placed.groupBy(*ROW_KEY).agg(
        *more,
        F.sort_array(F.collect_list("before")).alias("before"),
        F.sort_array(F.collect_list("after")).alias("after"),
    )


def flag_updated_images(rows: DataFrame) -> DataFrame:
    """``flag_updated`` on row images: each after cell against the before cell of its ordinal."""
    def flagged(cell: Column) -> Column:
        old = F.get(F.filter("before", lambda b: b["ordinal"] == cell["ordinal"]), F.lit(0))
        changed = old.isNotNull() & ~cell["value"].eqNullSafe(old["value"])
        return cell.withField("updated", changed)

    return rows.withColumn("after", F.transform("after", flagged))


def assemble_entries(
    cells: DataFrame, headers: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Cells back to one nested entry per event.

    An entry is one message: its size is bounded by the 32-bit event length of the
    log, not by the table, so an event is the only group gathered here. Cells are
    placed by event first, and every step below reuses that one exchange.
    """
    placed = cells.repartition(*EVENT_KEY)
    rows = row_images(placed, columns)
    body = rows.groupBy(*EVENT_KEY).agg(
        F.sort_array(F.collect_list(F.struct("row_idx", "before", "after"))).alias("row_datas")
    )
    return merged(headers, body, EVENT_KEY)


def simple_entries(entries: DataFrame) -> DataFrame:
    """Reduced envelope: row events and xid ends, blank names as null."""
    is_row = is_rows_event()
    is_end = F.col("type_code") == S.XID

    def filled(name: str) -> Column:
        return F.when(F.trim(name) != "", F.col(name))

    return entries.filter(is_row | is_end).select(
        "server_id", "seq", "logfile", "logfile_offset", F.col("execute_time").alias("ts"),
        F.col("event_length").alias("event_len"), "event_type", "entry_type",
        filled("db").alias("database_name"), filled("tbl").alias("table_name"),
    )


def flat_event_entries(entries: DataFrame) -> DataFrame:
    """One line per changed row with name-to-value maps of its images.

    ``entries``: server_id, seq, db, tbl, event_type, execute_time, row_datas.
    ``cus`` (custom values) has no producer, so it stays null.
    """
    def as_map(side: str) -> Column:
        pairs = F.transform(side, lambda c: F.struct(c["name"], c["value"]))
        return F.when(F.size(side) > 0, F.map_from_entries(pairs))

    rows = explode_rows(entries)
    none = F.lit(None).cast("string")
    return rows.select(
        "server_id", "seq", "row_idx",
        F.col("seq").alias("mid"), "db", F.col("db").alias("sch"), F.col("tbl").alias("tab"),
        F.col("event_type").alias("opt"), F.col("execute_time").alias("ts"),
        none.alias("ddl"), none.alias("err"),
        as_map("before").alias("src"), as_map("after").alias("cur"),
        F.lit(None).cast("map<string,string>").alias("cus"),
    )


def column_dump(entries: Column) -> Column:
    """Map as ``[k,v][k,v]`` text, by key; a null map gives empty text."""
    item = lambda e: F.concat(
        F.lit("["), e["key"], F.lit(","), F.coalesce(e["value"], F.lit("null")), F.lit("]"))
    return F.coalesce(
        F.array_join(F.transform(F.array_sort(F.map_entries(entries)), item), ""), F.lit("")
    )


def first_column_label(entries: DataFrame) -> DataFrame:
    """``name ## value`` of the first after column of the first row, else empty."""
    first = F.get(F.get("row_datas", F.lit(0))["after"], F.lit(0))
    label = F.concat(first["name"], F.lit(" ## "), F.coalesce(first["value"], F.lit("")))
    return entries.withColumn("label", F.coalesce(label, F.lit("")))
