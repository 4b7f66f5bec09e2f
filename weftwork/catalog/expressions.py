"""Column expressions: labels, dates, numbers, addresses, keys."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.constants import DATE, DATETIME, TIME
from weftwork.functions.fields import checked_number, number_value
from weftwork.functions.keys import (
    collection_of_table,
    flat_record,
    message_key,
    message_key_parts,
    table_name,
)
from weftwork.functions.labels import fill_label, label_names
from weftwork.functions.network import ip_to_long, long_to_ip
from weftwork.functions.temporal import (
    convert_fixed,
    convert_temporal,
    parse_date,
    parse_datetime,
)

_TEMPLATES = ("Part ${name} by ${brand} / ${name}", "${brand}: size ${size}, ${colour}", "no variable")


@query("""
SELECT p_partkey, CASE p_partkey % 3
    WHEN 0 THEN 'Part ' || p_name || ' by ' || p_brand || ' / ' || p_name
    WHEN 1 THEN p_brand || ': size ' || p_size || ', ${colour}'
    ELSE 'no variable' END AS label,
  CASE p_partkey % 3 WHEN 0 THEN 'name,brand' WHEN 1 THEN 'brand,size,colour' ELSE '' END AS names
FROM part
""")
def q_label(spark: SparkSession, folder: str) -> DataFrame:
    """Label templates filled from the record; a variable without a value stays."""
    key = F.col("p_partkey") % 3
    template = F.when(key == 0, _TEMPLATES[0]).when(key == 1, _TEMPLATES[1]).otherwise(_TEMPLATES[2])
    values = F.create_map(
        F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string")
    )
    return table(spark, folder, "part").select(
        "p_partkey", fill_label(template, values).alias("label"), F.array_join(label_names(template), ",").alias("names")
    )


PATTERNS = {
    DATE: ["yyyy/MM/dd", "dd.MM.yyyy"],
    DATETIME: ["yyyy/MM/dd HH:mm", "dd.MM.yyyy HH:mm:ss"],
    TIME: ["HH.mm.ss", "HH.mm"],
}


def _moments(spark: SparkSession, folder: str) -> DataFrame:
    seconds = F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    return table(spark, folder, "orders").select("o_orderkey", (F.col("o_orderdate") + seconds).alias("at"))


def _digits(pattern: str) -> Column:
    """Text of a timestamp without a time zone; ``date_format`` would go through the session zone."""
    text = F.col("at").cast("string")
    pieces = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}
    columns, rest = [], pattern
    while rest:
        token = next((t for t in pieces if rest.startswith(t)), None)
        columns.append(F.substring(text, *pieces[token]) if token else F.lit(rest[0]))
        rest = rest[len(token or rest[0]):]
    return F.concat(*columns)


def _short(piece: str) -> Column:
    return _digits(piece).cast("int").cast("string")


_MOMENTS_SQL = "SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS stamp FROM orders"
_FORMS_SQL = f"""
  SELECT o_orderkey, stamp, o_orderkey % 8 AS form, CASE o_orderkey % 8
    WHEN 0 THEN year(stamp) || '-' || month(stamp) || '-' || day(stamp)
    WHEN 1 THEN year(stamp) || '-' || month(stamp) || '-' || day(stamp) || ' ' || hour(stamp) || ':' || minute(stamp) || ':' || second(stamp)
    WHEN 2 THEN CAST(epoch_ms(stamp) AS VARCHAR)
    WHEN 3 THEN strftime(stamp, '%Y/%m/%d')
    WHEN 4 THEN strftime(stamp, '%d.%m.%Y %H:%M:%S')
    WHEN 5 THEN strftime(stamp, '%H.%M')
    WHEN 6 THEN hour(stamp) || ':' || minute(stamp) || ':' || second(stamp)
    ELSE CASE WHEN o_orderkey % 16 = 7 THEN '' ELSE 'on ' || strftime(stamp, '%Y-%m-%d') END END AS text
  FROM ({_MOMENTS_SQL})
"""


def _forms(spark: SparkSession, folder: str) -> DataFrame:
    form = F.col("o_orderkey") % 8
    day = F.concat_ws("-", *[_short(p) for p in ("yyyy", "MM", "dd")])
    clock = F.concat_ws(":", *[_short(p) for p in ("HH", "mm", "ss")])
    epoch = (F.datediff(F.col("at").cast("date"), F.lit("1970-01-01").cast("date")) * 86400 + F.col("o_orderkey") % 86400) * 1000
    text = (
        F.when(form == 0, day)
        .when(form == 1, F.concat_ws(" ", day, clock))
        .when(form == 2, epoch.cast("string"))
        .when(form == 3, _digits("yyyy/MM/dd"))
        .when(form == 4, _digits("dd.MM.yyyy HH:mm:ss"))
        .when(form == 5, _digits("HH.mm"))
        .when(form == 6, clock)
        .otherwise(F.when(F.col("o_orderkey") % 16 == 7, F.lit("")).otherwise(F.concat(F.lit("on "), _digits("yyyy-MM-dd"))))
    )
    return _moments(spark, folder).select("o_orderkey", text.alias("text"))


@query(f"""
SELECT o_orderkey, text,
  CASE WHEN form IN (0, 1, 3) THEN strftime(stamp, '%Y-%m-%d 00:00:00')
       WHEN form = 2 THEN strftime(stamp + INTERVAL 8 HOUR, '%Y-%m-%d 00:00:00') END AS date_text,
  CASE WHEN form = 0 THEN strftime(stamp, '%Y-%m-%d 00:00:00') WHEN form IN (1, 4) THEN strftime(stamp, '%Y-%m-%d %H:%M:%S')
       WHEN form = 2 THEN strftime(stamp + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS datetime_text,
  CASE WHEN form IN (1, 6) THEN strftime(stamp, '%H:%M:%S') WHEN form = 5 THEN strftime(stamp, '%H:%M:00')
       WHEN form = 2 THEN strftime(stamp + INTERVAL 8 HOUR, '%H:%M:%S') END AS time_text
FROM ({_FORMS_SQL})
""")
def q_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates, datetimes and times in eight written forms, read with configured patterns."""
    text = F.col("text")
    return _forms(spark, folder).select(
        "o_orderkey",
        "text",
        *[convert_temporal(t, text, PATTERNS[t]).alias(f"{t}_text") for t in (DATE, DATETIME, TIME)],
    )


@query(f"""
SELECT o_orderkey,
  CASE WHEN form = 0 THEN strftime(stamp, '%Y-%m-%d 00:00:00') WHEN form = 1 THEN strftime(stamp, '%Y-%m-%d %H:%M:%S')
       WHEN form = 2 THEN strftime(stamp + INTERVAL 8 HOUR, '%Y-%m-%d 00:00:00') ELSE nullif(text, '') END AS date_text,
  CASE WHEN form = 0 THEN strftime(stamp, '%Y-%m-%d 00:00:00') WHEN form = 1 THEN strftime(stamp, '%Y-%m-%d %H:%M:%S')
       WHEN form = 2 THEN strftime(stamp + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') ELSE nullif(text, '') END AS datetime_text
FROM ({_FORMS_SQL})
""")
def q_dates_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """The fixed forms only; text in no known form is kept."""
    text = F.col("text")
    return _forms(spark, folder).select(
        "o_orderkey", convert_fixed(DATE, text).alias("date_text"), convert_fixed(DATETIME, text).alias("datetime_text")
    )


@query("""
SELECT o_orderkey,
  strftime(make_date(year(o_orderdate), 1, 1) + to_months(CAST(o_orderkey % 15 - 1 AS INTEGER))
    + to_days(CAST(o_orderkey % 34 - 1 AS INTEGER)), '%Y-%m-%d') AS day,
  strftime(make_date(year(o_orderdate), 1, 1) + to_months(CAST(o_orderkey % 15 - 1 AS INTEGER))
    + to_days(CAST(o_orderkey % 34 - 1 AS INTEGER)) + to_hours(o_orderkey % 30) + to_minutes(o_orderkey % 71)
    + to_seconds(o_orderkey % 67), '%Y-%m-%d %H:%M:%S') AS moment
FROM orders
""")
def q_dates_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """Months, days and hours beyond their range carry over."""
    key = F.col("o_orderkey")
    day = F.concat_ws("-", F.year("o_orderdate").cast("string"), (key % 15).cast("string"), (key % 34).cast("string"))
    clock = F.concat_ws(":", *[(key % n).cast("string") for n in (30, 71, 67)])
    written = table(spark, folder, "orders").select("o_orderkey", day.alias("day"), F.concat_ws(" ", day, clock).alias("at"))
    return written.select(
        "o_orderkey",
        parse_date(F.col("day")).cast("string").alias("day"),
        parse_datetime(F.col("at")).cast("string").alias("moment"),
    )


_NUMBERS_SQL = """
  SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS number FROM events
"""


@query(f"""
SELECT event_id, text, CASE WHEN text = '' THEN NULL WHEN good THEN text ELSE '-1' END AS checked,
  CASE WHEN good THEN CAST(text AS DOUBLE) ELSE -1 END AS number
FROM (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN number WHEN 1 THEN '-' || number WHEN 2 THEN number || 'kg'
      WHEN 3 THEN '' WHEN 4 THEN CAST(event_id AS VARCHAR) || '.' ELSE number || '.5' END AS text,
    event_id % 6 IN (0, 1, 4) AS good
  FROM ({_NUMBERS_SQL}))
""")
def q_number_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers as text, and the sentinel for what is no number."""
    number = F.col("value").cast("decimal(18,2)").cast("string")
    form = F.col("event_id") % 6
    text = (
        F.when(form == 0, number)
        .when(form == 1, F.concat(F.lit("-"), number))
        .when(form == 2, F.concat(number, F.lit("kg")))
        .when(form == 3, F.lit(""))
        .when(form == 4, F.concat(F.col("event_id").cast("string"), F.lit(".")))
        .otherwise(F.concat(number, F.lit(".5")))
    )
    frame = table(spark, folder, "events").select("event_id", text.alias("text"))
    return frame.select(
        "event_id", "text", checked_number(F.col("text")).alias("checked"), number_value(F.col("text")).alias("number")
    )


@query("""
SELECT CASE WHEN bad THEN NULL ELSE n // 256 * 256 END AS subnet, CAST(count(*) AS BIGINT) AS hosts,
  min(CASE WHEN NOT bad THEN n END) AS first_address,
  min(CASE WHEN NOT bad THEN (n // 16777216) || '.' || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) END) AS least_text
FROM (SELECT c_custkey * 7919 % 4294967296 AS n, c_custkey % 10 = 0 AS bad FROM customer) GROUP BY 1
""")
def q_ipv4(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses written, read back and grouped by /24 network; those that are none are null."""
    number = F.col("c_custkey") * 7919 % (2**32)
    text = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("300.1.1."), (F.col("c_custkey") % 256).cast("string")))
    written = table(spark, folder, "customer").select(F.coalesce(text, long_to_ip(number)).alias("address"))
    read = written.withColumn("number", ip_to_long(F.col("address")))
    good = F.when(F.col("number").isNotNull(), F.col("address"))
    return read.groupBy((F.shiftright("number", 8) * 256).alias("subnet")).agg(
        F.count(F.lit(1)).alias("hosts"), F.min("number").alias("first_address"), F.min(good).alias("least_text")
    )


@query("""
SELECT event_id AS sequence_id, event_type AS data_schema_id, CAST(user_id % 7 AS VARCHAR) AS res_id,
  CAST(user_id % 3 AS VARCHAR) AS task_id, json_extract_string(props, '$.k') AS k
FROM events
""")
def q_key_split(spark: SparkSession, folder: str) -> DataFrame:
    """Message keys taken apart, and a flat JSON record as a map."""
    key = message_key(F.col("event_id"), F.col("event_type"), F.col("user_id") % 7, F.col("user_id") % 3)
    messages = table(spark, folder, "events").select(key.alias("key"), "props")
    parts = message_key_parts(F.col("key"), ["sequence_id", "data_schema_id", "res_id", "task_id"])
    return messages.select(*parts, F.try_element_at(flat_record(F.col("props")), F.lit("k")).alias("k"))


@query("""
SELECT DISTINCT 'm_' || lower(p_type) || '_' || CASE WHEN p_size % 2 = 0 THEN 'entity' ELSE 'relation' END || '_' || p_brand AS table_name,
  'm_' || lower(p_type) || '_' || CASE WHEN p_size % 2 = 0 THEN 'entity' ELSE 'relation' END || '_index' AS collection
FROM part
""")
def q_table_names(spark: SparkSession, folder: str) -> DataFrame:
    """Table names of element types and the collections they belong to."""
    kind = F.when(F.col("p_size") % 2 == 0, "Entity").otherwise("Link")
    name = table_name(F.concat(F.lit("m_"), F.lower("p_type")), kind, F.col("p_brand"))
    names = table(spark, folder, "part").select(name.alias("table_name")).distinct()
    return names.withColumn("collection", collection_of_table(F.col("table_name")))
