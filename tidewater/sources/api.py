"""Landed API results and outbound requests: paged-result normalisation, the reverse-ETL request
table and its sender, and the incremental high-water-mark filter.

HTTP itself is not done here: pages are read from where they landed, and requests are sent by an injected sender
function (one call per request, from the executors, with retries and an outbox, see ``outbox.py``), so the transport
can be swapped or faked.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources import quarantine
from tidewater.sources.outbox import send

# Status keys of a result page that are not rows.
STATUS_KEYS = ("result_code", "result_message", "result_output")

PAGE = T.MapType(T.StringType(), T.StringType())


def normalize_paged_result(pages: DataFrame, page_col: str, row_schema: T.StructType | str,
                           tag_cols: list[str]) -> DataFrame:
    """A landed page is a JSON object ``{index: row, ..., result_code: .., ...}``. Emit one row per non-status key,
    drop empty rows (null, ``{}``, ``[]``, ""), parse the row with ``row_schema`` and tag it with ``tag_cols``. A page or
    a row that doesn't parse fails the query; ``split_paged_result`` sets them apart instead."""
    m = F.from_json(F.col(page_col), PAGE, {"mode": "FAILFAST"})
    rows = _page_rows(pages.select(*tag_cols, F.explode(m).alias("row_key", "_tw_row")))
    return rows.select(*tag_cols, "row_key", quarantine.strict(F.col("_tw_row"), row_schema).alias("_tw_r")) \
        .select(*tag_cols, "row_key", "_tw_r.*")


def _page_rows(entries: DataFrame) -> DataFrame:
    return entries.where(~F.col("row_key").isin(*STATUS_KEYS) & F.col("_tw_row").isNotNull()
                         & ~F.trim(F.col("_tw_row")).isin("", "{}", "[]", "null"))


def split_paged_result(pages: DataFrame, page_col: str, row_schema: T.StructType | str,
                       tag_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): the rows of ``normalize_paged_result``, and what doesn't parse with its tags, ``row_key`` (null
    for a whole page), text and reason."""
    page = F.col(page_col)
    opened = pages.select(*tag_cols, page.alias("_tw_page"), F.from_json(page, PAGE).alias("_tw_m"))
    # a text that isn't an object gives no map, or a map of one null value under the text itself or no key
    whole = F.col("_tw_m").isNotNull() & F.get_json_object("_tw_page", "$").startswith("{")
    closed = opened.where(~F.coalesce(whole, F.lit(False))).select(
        *tag_cols, F.lit(None).cast("string").alias("row_key"), F.col("_tw_page").alias(quarantine.RAW),
        F.when(page_is_empty("_tw_page"), "empty page").otherwise("malformed page").alias(quarantine.REASON))
    rows = _page_rows(opened.where(whole).select(*tag_cols, F.explode("_tw_m").alias("row_key", "_tw_row")))
    good, broken = quarantine.split(rows, "_tw_row", row_schema, [*tag_cols, "row_key"])
    return good, broken.unionByName(closed)


def page_is_empty(column: str) -> F.Column:
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def event_time(tstamp: str = "tstamp", info: str = "info", default: str = "2020-01-01 00:00:00",
               fmt: str = "yyyy-MM-dd HH:mm:ss") -> F.Column:
    """Event time of a landed row: its own ``tstamp``, else the first ``info[].tstamp``, else ``default``. A text that
    isn't a time fails the query: as a null it would drop its row from every comparison with a mark."""
    raw = F.coalesce(F.col(tstamp), F.get(F.col(info), F.lit(0)).getField("tstamp"), F.lit(default))
    found = F.try_to_timestamp(raw, F.lit(fmt)).cast("timestamp_ntz")
    return F.coalesce(found, F.raise_error(F.concat(F.lit("not a time: "), raw)).cast("timestamp_ntz"))


def incremental_watermark(rows: DataFrame, marks: DataFrame | None, keys: list[str], ts_col: str,
                          default_mark: str = "2020-01-01 00:00:00") -> tuple[DataFrame, DataFrame]:
    """Keep rows newer than their key's stored high-water mark and compute the new marks.

    Returns ``(new_rows, new_marks)``: rows with ``ts > mark`` (a key without a mark uses ``default_mark``) and,
    per key, ``max(ts)`` of all rows seen, kept only where it is higher than the stored mark. Order-independent:
    no early stop on the first old row.
    """
    if marks is None:
        j = rows.withColumn("_tw_mark", F.lit(default_mark).cast("timestamp_ntz"))
    else:
        j = rows.join(marks.select(*keys, F.col("last_ts").alias("_tw_mark")), keys, "left") \
            .withColumn("_tw_mark", F.coalesce(F.col("_tw_mark"), F.lit(default_mark).cast("timestamp_ntz")))
    fresh = j.where(F.col(ts_col) > F.col("_tw_mark")).drop("_tw_mark")
    high = j.groupBy(*keys).agg(F.max(ts_col).alias("last_ts"), F.max("_tw_mark").alias("_tw_old"))
    new_marks = high.where(F.col("last_ts") > F.col("_tw_old")).drop("_tw_old")
    return fresh, new_marks


def request_table(conversions: DataFrame, config: DataFrame, key_cols: list[str], report_click: bool | str,
                  id_col: str) -> DataFrame:
    """One row per request: an optional click request (when ``report_click`` is true, or the named boolean column
    is) followed by the event request whose event id comes from the flattened config on ``key_cols``. Rows without
    a config path get a null event id and are reported as failed by the sender."""
    j = conversions.join(config, key_cols, "left")
    click_flag = F.lit(bool(report_click)) if isinstance(report_click, bool) else F.col(report_click)
    reqs = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("click").alias("kind"), F.lit(None).cast("string").alias("event_id")),
        F.struct(F.lit(2).alias("step"), F.lit("event").alias("kind"), F.col("event_id").cast("string").alias("event_id")))
    out = j.select(F.col(id_col), click_flag.alias("_tw_click"), F.explode(reqs).alias("r")) \
        .where((F.col("r.kind") == "event") | F.col("_tw_click")).select(id_col, "r.*")
    return out


def send_requests(requests: DataFrame, id_col: str, sender: Callable[[dict], int], tries: int = 3,
                  backoff_s: float = 0.0, outbox: str | None = None) -> DataFrame:
    """Send each record's requests in step order from the executors; the event request is sent only if the click
    (when present) succeeded. Output: one status row per request. With ``outbox`` what was sent is on record and a
    repeated run sends the rest only (``outbox.send``)."""
    return send(requests, id_col, sender, outbox, tries, backoff_s)
