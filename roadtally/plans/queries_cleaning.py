"""Cleaning, casting and parsing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadtally.functions import parsing
from roadtally.functions.columns import snake_columns
from roadtally.operators import cleaning
from roadtally.plans import stand_ins
from roadtally.plans.registry import query, rounded, table
from roadtally.plans.stand_ins import CLEAN_COUNTS, RAW_COUNTS, as_parsed_date
from roadtally.sources.readers import flatten_disruptions


def _dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer text with null tokens put in by key, and a number with thousands commas."""
    token = F.element_at(
        F.array(*[F.lit(t) for t in ("NULL", " null ", "NaN", "n/a", " NA", "None", "  ", "ok")]),
        (F.col("c_custkey") % 8 + 1).cast("int"),
    )
    whole = F.floor(F.abs("c_acctbal") * 100).cast("bigint")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") < 12, token).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") < 6, token)
        .otherwise(F.concat(F.lit("1,"), F.lpad(whole.cast("string"), 7, "0")))
        .alias("balance_text"),
        F.when(F.col("c_nationkey") == 3, "-").otherwise(F.col("c_nationkey").cast("string")).alias(
            "nation_text"
        ),
    )


DIRTY = """dirty AS (
  SELECT c_custkey,
         CASE WHEN c_nationkey < 12 THEN token ELSE c_name END AS c_name,
         CASE WHEN c_nationkey < 6 THEN token
              ELSE '1,' || lpad(floor(abs(c_acctbal) * 100)::BIGINT::VARCHAR, 7, '0') END
           AS balance_text,
         CASE WHEN c_nationkey = 3 THEN '-' ELSE c_nationkey::VARCHAR END AS nation_text
  FROM (SELECT *, ['NULL', ' null ', 'NaN', 'n/a', ' NA', 'None', '  ', 'ok'][c_custkey % 8 + 1]
          AS token FROM customer))"""


@query(
    f"""WITH {DIRTY}
SELECT c_custkey,
       CASE WHEN trim(c_name) NOT IN ('NULL', 'null', 'NaN', 'nan', '') THEN c_name END AS c_name,
       CASE WHEN trim(balance_text) NOT IN ('NULL', 'null', 'NaN', 'nan', '')
            THEN balance_text END AS balance_text,
       nation_text
FROM dirty"""
)
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.null_tokens(_dirty_customers(spark, sf_dir))


@query(
    f"""WITH {DIRTY}
SELECT c_custkey,
       CASE WHEN upper(trim(c_name)) NOT IN ('NULL', 'N/A', 'NA', 'NONE', '')
            THEN c_name END AS c_name,
       CASE WHEN upper(trim(balance_text)) NOT IN ('NULL', 'N/A', 'NA', 'NONE', '')
            THEN balance_text END AS balance_text,
       nation_text
FROM dirty"""
)
def null_tokens_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.null_tokens(_dirty_customers(spark, sf_dir), fold_case=True)


@query(
    f"""WITH {DIRTY}
SELECT c_custkey,
       CASE WHEN upper(trim(balance_text)) <> 'NAN'
            THEN round(try_cast(replace(balance_text, ',', '') AS DOUBLE), 6) END AS balance,
       try_cast(nation_text AS INT)::DOUBLE AS nation, NULL::DOUBLE AS absent
FROM dirty"""
)
def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows; the text NaN is a null token, so it is no number."""
    rows = _dirty_customers(spark, sf_dir)
    return rounded(
        rows.select(
            "c_custkey",
            parsing.as_number(parsing.plain_number("balance_text")).alias("balance"),
            parsing.to_number(rows, "nation_text", "int").cast("double").alias("nation"),
            F.lit(None).cast("double").alias("absent"),
        )
    )


@query(
    f"""WITH {DIRTY},
clean AS (
  SELECT c_custkey::VARCHAR AS c_custkey, nation_text,
         CASE WHEN upper(trim(balance_text)) NOT IN ('NULL', 'N/A', 'NA', 'NONE', '')
              THEN balance_text END AS balance_text
  FROM dirty)
SELECT round(avg(regexp_matches(replace(c_custkey, ',', ''), '^-?\\d+(\\.\\d+)?$')::INT), 6)
         AS c_custkey,
       round(avg(regexp_matches(replace(balance_text, ',', ''), '^-?\\d+(\\.\\d+)?$')::INT), 6)
         AS balance_text,
       round(avg(regexp_matches(replace(nation_text, ',', ''), '^-?\\d+(\\.\\d+)?$')::INT), 6)
         AS nation_text
FROM clean"""
)
def numeric_inference_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dirty_customers(spark, sf_dir).withColumn("c_custkey", F.col("c_custkey").cast("string"))
    return rounded(cleaning.numeric_ratios(parsing.null_tokens(rows, fold_case=True)))


@query(
    f"""WITH {RAW_COUNTS}
SELECT count_point_id::DOUBLE AS count_point_id, count_date, hour::DOUBLE AS hour,
       year::DOUBLE AS year, region_name, local_authority_name, road_name,
       start_junction_road_name,
       CASE WHEN trim(end_junction_road_name) <> 'null' THEN end_junction_road_name END
         AS end_junction_road_name,
       CASE WHEN link_length_km <> 'NaN' THEN link_length_km::DOUBLE END AS link_length_km,
       try_cast(latitude AS DOUBLE) AS latitude, 
       try_cast(all_motor_vehicles AS DOUBLE) AS all_motor_vehicles,
       CASE WHEN all_hgvs <> 'NULL' THEN replace(all_hgvs, ',', '')::DOUBLE END AS all_hgvs,
       'London' AS region
FROM raw_counts"""
)
def clean_unknown_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_any(stand_ins.raw_files(spark, sf_dir), "London")


@query(
    f"""WITH {CLEAN_COUNTS}
SELECT * REPLACE (count_date::VARCHAR AS count_date), year(count_date)::INT AS p_year,
       strftime(count_date, '%m') AS p_month
FROM clean_counts"""
)
def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_counts(stand_ins.raw_files(spark, sf_dir))
    return clean.withColumn("count_date", F.col("count_date").cast("string"))


@query(
    f"""WITH {RAW_COUNTS}
SELECT year, count_date, hour, region_name, local_authority_name AS local_authority, road_name,
       latitude, all_hgvs, all_motor_vehicles
FROM raw_counts WHERE region_name = 'London' AND year::INT >= 1998"""
)
def region_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.region_extract(stand_ins.raw_counts(spark, sf_dir), "London", 1998)


@query(
    f"""WITH {RAW_COUNTS}
SELECT count_point_id, count_date, hour,
       {as_parsed_date('count_date')} + to_hours(hour::DOUBLE::INT) AS ts_hour,
       year({as_parsed_date('count_date')})::INT AS p_year,
       strftime({as_parsed_date('count_date')}, '%m') AS p_month
FROM raw_counts WHERE hour::DOUBLE < 24"""
)
def mixed_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snake_columns(stand_ins.raw_counts(spark, sf_dir)).select(
        "count_point_id", "count_date", "hour"
    )
    rows = rows.withColumn("ts_hour", parsing.hour_timestamp(rows, "count_date", "hour"))
    return cleaning.month_keys(rows.where(F.col("ts_hour").isNotNull()), "ts_hour")


@query(
    """SELECT o_orderkey, date_trunc('day', o_orderdate::TIMESTAMP) + to_hours((o_orderkey % 24)::BIGINT::INT) AS ts_hour
FROM orders"""
)
def dated_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with a time of their own, with spaces, ISO and day-first: none is lost."""
    day = F.col("o_orderdate").cast("date")
    iso, day_first = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd/MM/yyyy")
    kinds = F.array(F.concat(iso, F.lit(" 00:00:00")), F.concat(F.lit("  "), iso), day_first, F.concat(day_first, F.lit(" 00:00")))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.get(kinds, (F.col("o_orderkey") % 4).cast("int")).alias("day"),
        (F.col("o_orderkey") % 24).cast("string").alias("hour"),
    )
    return rows.select("o_orderkey", parsing.hour_timestamp(rows, "day", "hour").alias("ts_hour"))


@query(
    """SELECT o_orderkey, o_orderdate + to_minutes(CASE WHEN o_orderkey % 4 < 2 THEN 0
                                                    ELSE (o_orderkey % 1440)::INT END) AS ts
FROM orders WHERE o_orderstatus <> 'P'"""
)
def multi_format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four layouts by key, and text that is no time at all where the order is pending."""
    orders = table(spark, sf_dir, "orders")
    moment = F.col("o_orderdate") + F.make_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    layouts = ["yyyy-MM-dd", "dd/MM/yyyy 00:00", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]
    text = F.lit(None).cast("string")
    for n, layout in enumerate(layouts):
        text = F.when(
            F.col("o_orderkey") % 4 == n,
            F.date_format(moment if n > 1 else F.col("o_orderdate"), layout),
        ).otherwise(text)
    feed = orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "soon").otherwise(text).alias("start_time")
    )
    rows = feed.select("o_orderkey", parsing.parse_event_time("start_time").alias("ts"))
    return rows.where(F.col("ts").isNotNull())


@query(
    """SELECT event_id::VARCHAR AS disruption_id, event_type AS category,
       json_extract_string(props, '$.k') AS sub_category,
       CASE WHEN user_id % 3 = 0 THEN 'Minor' ELSE 'Severe' END AS severity,
       CASE WHEN event_type <> 'click' THEN 'status ' || event_type END AS severity_description,
       'J' || user_id AS location,
       CASE WHEN user_id % 3 = 0 THEN event_type || ',' || user_id
            WHEN user_id % 3 = 1 THEN 'L' || user_id ELSE '' END AS corridor_ids,
       CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS start_datetime,
       date_trunc('second', ts) + INTERVAL 1 HOUR AS end_datetime,
       NULL::VARCHAR AS comments,
       CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts) END AS timestamp_hour
FROM events"""
)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested disruption records: empty alternatives, empty lists, missing times."""
    return flatten_disruptions(disruption_records(spark, sf_dir))


def disruption_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.col("user_id").cast("string")
    third = F.col("user_id") % 3
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").alias("subCategory"),
        F.when(third == 0, "Minor").when(third == 1, "").alias("severity"),
        F.lit("Severe").alias("statusSeverity"),
        F.lit("").alias("severityDescription"),
        F.when(F.col("event_type") != "click", F.concat(F.lit("status "), F.col("event_type"))).alias(
            "statusSeverityDescription"
        ),
        F.concat(F.lit("J"), uid).alias("location"),
        F.lit(None).cast("string").alias("comments"),
        F.when(third == 0, F.array("event_type", uid)).when(third == 1, none).alias("corridorIds"),
        F.when(third == 1, F.array(F.concat(F.lit("L"), uid))).alias("roadDisruptionLines"),
        F.when(F.col("event_type") != "view", F.date_format("ts", iso)).alias("startDateTime"),
        F.date_format(F.col("ts") + F.make_interval(hours=F.lit(1)), iso).alias("endDateTime"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS n
  FROM lineitem) WHERE n = 1"""
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    rows = cleaning.latest_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], newest
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query(
    """SELECT event_id, event_type, round(least(value, cap), 6) AS value
FROM events JOIN (SELECT event_type, quantile_disc(value, 0.995) AS cap FROM events GROUP BY 1)
USING (event_type)"""
)
def volume_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rounded(cleaning.cap_by_key(events, "event_type", "value"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def drop_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return cleaning.drop_negative(customers, "c_acctbal")


@query(
    """SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE NOT l_quantity BETWEEN 0 AND 40) AS bad_l_quantity,
       count(*) FILTER (WHERE NOT l_linenumber BETWEEN 0 AND 5) AS bad_l_linenumber,
       count(*) FILTER (WHERE NOT l_tax BETWEEN 0.01 AND 0.07) AS bad_l_tax
FROM lineitem"""
)
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"l_quantity": (0.0, 40.0), "l_linenumber": (0, 5), "l_tax": (0.01, 0.07)}
    return cleaning.range_violations(table(spark, sf_dir, "lineitem"), rules)
