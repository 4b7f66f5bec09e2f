import hypothesis.strategies as st
import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from weftwork.functions.direction import direction_code, is_reversed
from weftwork.functions.fields import checked_number, typed_fields
from weftwork.functions.identity import composite_id, composite_id_from, row_hash, row_key
from weftwork.functions.keys import collection_of_table, message_key_parts
from weftwork.functions.labels import fill_label, label_names
from weftwork.functions.network import ip_to_long, long_to_ip
from weftwork.functions.properties import BODY_TYPE, property_body, stored_type
from weftwork.functions.temporal import convert_fixed, convert_temporal, parse_time


def values(spark, column, texts):
    """The column, written over ``t``, for each text in turn."""
    rows = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "i int, t string").select("i", column.alias("c"))
    return [r["c"] for r in frame.orderBy("i").collect()]


@pytest.mark.parametrize(
    "root, parts, expected",
    [
        ("person", ["a", "b"], "person~`#a~`#b"),
        ("person", [" a "], "person~`# a "),
        ("", ["a", "b"], "a~`#b"),
        ("person", ["a", None], None),
        ("person", ["a", "  "], None),
        ("person", ["a", "\t\n"], None),
        ("person", ["a", ""], None),
        ("person", ["é", "　"], "person~`#é~`#　"),
        ("person", [" !"], "person~`# !"),
        ("person", [], None),
        ("person", list("abcdef"), "person~`#a~`#b~`#c~`#d~`#e~`#f"),
        ("person", [*"abcde", " "], None),
    ],
)
def test_composite_id(spark, root, parts, expected):
    names = [f"c{i}" for i in range(len(parts))]
    record = F.create_map(*[x for n, p in zip(names, parts) for x in (F.lit(n), F.lit(p).cast("string"))])
    record = record if parts else F.create_map().cast("map<string,string>")
    frame = spark.range(1).select(
        composite_id(root, [F.lit(p).cast("string") for p in parts]).alias("written"),
        composite_id_from(F.lit(root), F.array(*[F.lit(n) for n in names]).cast("array<string>"), record).alias("listed"),
    )
    assert tuple(frame.first()) == (expected, expected)


def test_row_key_and_hash(spark):
    row = spark.range(1).select(
        row_key(F.lit("r"), F.lit("x")).alias("k"),
        row_key(F.lit(None), F.lit("x")).alias("n"),
        row_hash(row_key(F.lit("r"), F.lit("x"))).alias("h"),
    )
    import hashlib

    assert tuple(row.first()) == ("r@x", "null@x", hashlib.md5(b"r@x").hexdigest())


DIRECTIONS = [
    # directed, directivity, result of the direction column, reversed, code
    (False, "NotDirected", None, False, "0"),
    (False, "TargetToSource", "TargetToSource", False, "0"),
    (False, "Bidirectional", "Bidirectional", False, "0"),
    (True, "NotDirected", None, False, "1"),
    (True, "NotDirected", "Bidirectional", False, "1"),
    (True, "SourceToTarget", "TargetToSource", False, "1"),
    (True, "TargetToSource", None, True, "1"),
    (True, "TargetToSource", "SourceToTarget", True, "1"),
    (True, "Bidirectional", "TargetToSource", True, "1"),
    (True, "Bidirectional", "SourceToTarget", False, "1"),
    (True, "Bidirectional", "NotDirected", False, "0"),
    (True, "Bidirectional", "Bidirectional", False, "2"),
    (True, "Bidirectional", None, False, "2"),
    (True, None, None, False, "1"),
    (True, None, "TargetToSource", True, "1"),
    (True, "ByColumn", None, False, "1"),
]


def test_direction_table(spark):
    rows = spark.createDataFrame(
        [(i, *d[:3]) for i, d in enumerate(DIRECTIONS)], "i int, directed boolean, way string, result string"
    )
    arguments = (F.col("directed"), F.col("way"), F.col("result"))
    found = rows.select("i", is_reversed(*arguments).alias("r"), direction_code(*arguments).alias("c")).orderBy("i")
    assert [(r["r"], r["c"]) for r in found.collect()] == [d[3:] for d in DIRECTIONS]


def test_label(spark):
    record = F.create_map(F.lit("a"), F.lit("$1"), F.lit("b"), F.lit("y"))
    texts = ["${a} and ${b}, ${a}", "${missing} ${b}", "plain", ""]
    assert values(spark, fill_label(F.col("t"), record), texts) == ["$1 and y, $1", "${missing} y", "plain", ""]
    assert values(spark, label_names(F.col("t")), texts) == [["a", "b"], ["missing", "b"], [], []]


PATTERNS = {"date": ["yyyy/MM/dd"], "datetime": ["yyyyMMdd HHmmss", "yyyy/MM/dd HH:mm"], "time": ["HH.mm"]}
TEMPORAL = [
    # type, text, multi-pattern result, fixed-form result
    ("date", "", None, None),
    ("date", "2024-1-5", "2024-01-05 00:00:00", "2024-01-05 00:00:00"),
    ("date", "2024-01-05 23:59:58", "2024-01-05 00:00:00", "2024-01-05 23:59:58"),
    ("date", "0", "1970-01-01 00:00:00", "1970-01-01 00:00:00"),
    ("date", "1704499200000", "2024-01-06 00:00:00", "2024-01-06 00:00:00"),
    ("date", "2024-13-01", "2025-01-01 00:00:00", "2025-01-01 00:00:00"),
    ("date", "2024-02-30", "2024-03-01 00:00:00", "2024-03-01 00:00:00"),
    ("date", "2024/01/05", "2024-01-05 00:00:00", "2024/01/05"),
    ("date", "2024/1/5", None, "2024/1/5"),
    ("date", "99999999999999999999999", None, "99999999999999999999999"),
    ("date", "tomorrow", None, "tomorrow"),
    ("datetime", "2024-01-05 1:2:3", "2024-01-05 01:02:03", "2024-01-05 01:02:03"),
    ("datetime", "2024-01-05\t1:2:3", "2024-01-05 01:02:03", "2024-01-05 01:02:03"),
    ("datetime", "2024-01-05 25:61:61", "2024-01-06 02:02:01", "2024-01-06 02:02:01"),
    ("datetime", "2024-01-05", "2024-01-05 00:00:00", "2024-01-05 00:00:00"),
    ("datetime", "1704412800999", "2024-01-05 08:00:00", "2024-01-05 08:00:00"),
    ("datetime", "20240105 010203", "2024-01-05 01:02:03", "20240105 010203"),
    ("datetime", "2024/01/05 01:02", "2024-01-05 01:02:00", "2024/01/05 01:02"),
    ("datetime", "2024-01-05T01:02:03", None, "2024-01-05T01:02:03"),
    ("time", "1:2:3", "01:02:03", "1:2:3"),
    ("time", "25:00:00", "01:00:00", "25:00:00"),
    ("time", "2024-01-05 13:14:15", "13:14:15", "2024-01-05 13:14:15"),
    ("time", "3600000", "09:00:00", "3600000"),
    ("time", "12.30", "12:30:00", "12.30"),
    ("time", "", None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_temporal_forms(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for type_ in ("date", "datetime", "time"):
            rows = [r for r in TEMPORAL if r[0] == type_]
            texts = [r[1] for r in rows]
            multi = values(spark, convert_temporal(type_, F.col("t"), PATTERNS[type_]), texts)
            fixed = values(spark, convert_fixed(type_, F.col("t")), texts)
            assert multi == [r[2] for r in rows]
            assert fixed == [r[3] for r in rows]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zone_is_a_parameter(spark):
    assert values(spark, parse_time(F.col("t"), zone="UTC"), ["3600000"]) == ["01:00:00"]


def test_pattern_with_a_zone(spark):
    column = convert_temporal("datetime", F.col("t"), ["yyyy-MM-dd HH:mm:ssX"])
    # the second text is longer than the pattern
    texts = ["2024-01-05 00:00:00Z", "2024-01-05 00:00:00+08"]
    assert values(spark, column, texts) == ["2024-01-05 08:00:00", None]


def test_numbers(spark):
    texts = ["1", "-1.5", "+2", ".5", "5.", "1e3", "1,5", "-", ".", "", None]
    expected = ["1", "-1.5", "+2", ".5", "5.", "-1", "-1", "-1", "-1", None, None]
    assert values(spark, checked_number(F.col("t")), texts)[:-1] == expected[:-1]


def test_body_and_types(spark):
    body = property_body(
        [
            ("a", F.lit("x"), stored_type("text", False)),
            ("b", F.lit(None).cast("string"), stored_type("text", True)),
            ("c", F.lit(7), stored_type("integer", False)),
        ]
    )
    row = spark.range(1).select(body.alias("b")).first()["b"]
    assert {k: tuple(v) for k, v in row.items()} == {"a": ("x", "string"), "c": ("7", "integer")}


def test_typed_fields_follow_the_load_kind(spark):
    body = {
        "n": ("12x", "number"), "d": (" 2024-1-5 ", "date"), "t": (" x ", "text"), "h": ("1:2:3", "time"),
        "u": ("?", "geo"), "e": ("", "number"), "b": ("true", "bool"), "w": ("soon", "date"),
    }
    frame = spark.createDataFrame([(body,)], f"body {BODY_TYPE}")
    streamed = frame.select(typed_fields(F.col("body"), {}).alias("f")).first()["f"]
    batch = frame.select(typed_fields(F.col("body")).alias("f")).first()["f"]
    assert streamed == {
        "g_de11_n": "-1", "g_rd11_d": "2024-01-05 00:00:00", "g_tt11_t": "x", "g_tk11_h": "01:02:03", "g_bn11_b": "true",
    }
    assert batch == {
        "g_de11_n": "-1", "g_rd11_d": " 2024-1-5 ", "g_tt11_t": " x ", "g_tk11_h": "1:2:3", "g_bn11_b": "true",
        "g_rd11_w": "soon",
    }


def test_names_and_keys(spark):
    names = ["m_x_entity_person", "m_relation_knows", "other"]
    assert values(spark, collection_of_table(F.col("t")), names) == ["m_x_entity_index", "m_relation_index", None]
    parts = F.struct(*message_key_parts(F.col("t"), ["s", "d", "r", "k"]))
    assert [tuple(v) for v in values(spark, parts, ["5@a@b@c", "x@a@b@c", "5@a"])] == [
        (5, "a", "b", "c"), (None, "a", "b", "c"), (5, "a", None, None),
    ]


def test_addresses(spark):
    texts = ["0.0.0.0", "255.255.255.255", "127.0.0.1", "256.1.1.1", "1.2.3", "a.b.c.d", "1.2.3.4.5", None]
    expected = [0, 4294967295, 2130706433, None, None, None, None, None]
    assert values(spark, ip_to_long(F.col("t")), texts) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**32 - 1), min_size=20, max_size=50))
def test_addresses_round_trip(spark, numbers):
    frame = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    assert frame.filter(ip_to_long(long_to_ip(F.col("n"))) != F.col("n")).isEmpty()


def test_epoch_beyond_the_year_9999(spark):
    frame = spark.createDataFrame([("253402300799999",), ("253402300800000",), ("9223371950454775",), ("92233719504547750",)], "t string")
    t = F.col("t")
    rows = frame.select(convert_temporal("datetime", t), convert_temporal("date", t), convert_temporal("time", t), convert_fixed("datetime", t)).collect()
    assert [tuple(r) for r in rows] == [
        ("10000-01-01 07:59:59", "10000-01-01 00:00:00", "07:59:59", "10000-01-01 07:59:59"),
        ("10000-01-01 08:00:00", "10000-01-01 00:00:00", "08:00:00", "10000-01-01 08:00:00"),
        ("294247-01-09 12:00:54", "294247-01-09 00:00:00", "12:00:54", "294247-01-09 12:00:54"),
        (None, None, None, "92233719504547750"),
    ]
