"""Composite workloads on the driver tables.

Fixture mapping: session = (user_id, to_date(ts)) of ``events``; page_view / checkout / booking = event types
view / click / purchase; offer key = ``props.$.k``; offer table = ``part``; customer dimension = ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import json_value, to_zone
from tidewater.operators.filters import case_classify, date_range_filter
from tidewater.operators.sequence import lead_within
from tidewater.plans.common import t
from tidewater.plans.registry import query

START, END = "2024-01-01", "2024-02-01"
SYDNEY = "Australia/Sydney"


def classify_event(c="event_type"):
    e = F.col(c)
    return case_classify([(e == "click", F.lit("checkout")), (e == "view", F.lit("page_view")),
                          (e == "purchase", F.lit("booking"))])


def candidate_events(events: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Classified view/checkout/booking events of the window with the next event type in the same session."""
    e = date_range_filter(events, "ts", start, end)
    sessions = e.where(F.col("event_type").isin("view", "click", "purchase") & F.col("user_id").isNotNull()) \
        .select("event_id", "ts", "user_id", F.to_date("ts").alias("session_date"),
                classify_event().alias("event_type"),
                json_value("props", "$.k").cast("bigint").alias("offer_bk"))
    return lead_within(sessions, ["user_id", "session_date"], ["ts", "event_id"], "event_type", "next_event_type")


def abandoned_views_df(spark: SparkSession, sf: str, start: str = START, end: str = END) -> DataFrame:
    cand = candidate_events(t(spark, sf, "events"), start, end)
    av = cand.where((F.col("event_type") == "page_view") & F.col("next_event_type").isin("checkout", "booking")
                    & F.col("offer_bk").isNotNull())
    cust = t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("subscriber_key"))
    grouped = av.join(cust, "user_id").groupBy("session_date", "user_id", "offer_bk", "subscriber_key") \
        .agg(F.max(to_zone("ts", SYDNEY)).alias("view_datetime_sydt"))
    offers = t(spark, sf, "part").select(F.col("p_partkey").alias("offer_bk"), F.col("p_brand").alias("country_code"),
                                         F.col("p_type").alias("offer_type"), F.col("p_name").alias("holiday_types"))
    return grouped.join(offers, "offer_bk", "left").select(
        "view_datetime_sydt", "session_date", F.col("user_id").alias("customer_bk"), "offer_bk", "subscriber_key",
        "country_code", "offer_type", "holiday_types")


ABANDONED_VIEWS_SQL = f"""
WITH sessions AS (
  SELECT event_id, ts, user_id, CAST(ts AS DATE) AS session_date,
         CASE WHEN event_type = 'click' THEN 'checkout' WHEN event_type = 'view' THEN 'page_view'
              WHEN event_type = 'purchase' THEN 'booking' END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS offer_bk
    FROM events
   WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'
     AND event_type IN ('view', 'click', 'purchase') AND user_id IS NOT NULL
), cand AS (
  SELECT *, LEAD(event_type) OVER (PARTITION BY user_id, session_date ORDER BY ts, event_id) AS next_event_type
    FROM sessions
), av AS (
  SELECT session_date, user_id, offer_bk, c.c_name AS subscriber_key,
         MAX(timezone('{SYDNEY}', timezone('UTC', ts))) AS view_datetime_sydt
    FROM cand JOIN customer c ON c.c_custkey = cand.user_id
   WHERE event_type = 'page_view' AND next_event_type IN ('checkout', 'booking') AND offer_bk IS NOT NULL
   GROUP BY session_date, user_id, offer_bk, c.c_name
)
SELECT av.view_datetime_sydt, av.session_date, av.user_id AS customer_bk, av.offer_bk, av.subscriber_key,
       p.p_brand AS country_code, p.p_type AS offer_type, p.p_name AS holiday_types
  FROM av LEFT JOIN part p ON av.offer_bk = p.p_partkey
"""


@query("abandoned_views", ABANDONED_VIEWS_SQL)
def abandoned_views(spark: SparkSession, sf: str) -> DataFrame:
    return abandoned_views_df(spark, sf)
