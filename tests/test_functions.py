"""Scalar functions and parsers against hand-written values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tinderbox import schemas
from tinderbox.functions import feed_fields, geo, heat, scalars, text


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(fn(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    ("value", "sep", "expected"),
    [
        ("a;b;", ";", ["a", "b"]), ("a;b", ";", ["a", "b"]), ("", ";", None), (None, ";", None),
        (";", ";", None), (" ", ";", [" "]), ("u1<UDIV>u2", "<UDIV>", ["u1", "u2"]),
    ],
)
def test_split_list(spark, value, sep, expected):
    assert one(spark, value, lambda c: scalars.split_list(c, sep)) == expected


def test_split_ids(spark):
    assert one(spark, "1,x,3", scalars.split_ids) == [1, None, 3]
    assert one(spark, "1,x,3", lambda c: scalars.split_ids(c, default=-1)) == [1, -1, 3]
    assert one(spark, None, lambda c: scalars.split_ids(c, default=-1)) is None


@pytest.mark.parametrize(
    ("value", "expected"),
    [("1.5", 1.5), ("", None), ("1,234.5x", 1234.5), ("#", None), ("1-2", None), (None, None)],
)
def test_ensure_float(spark, value, expected):
    assert one(spark, value, scalars.ensure_float) == expected


def test_dates(spark):
    assert one(spark, 20240811, scalars.int_date, "int") == date(2024, 8, 11)
    assert one(spark, 20241399, scalars.int_date, "int") is None
    assert one(spark, date(2024, 8, 11), scalars.date_int, "date") == 20240811
    two = one(spark, "20240101-20240105.export.parquet", scalars.extract_dates)
    assert two == [date(2024, 1, 1), date(2024, 1, 5)]
    assert one(spark, "date=2024-08-08", scalars.extract_dates) == [date(2024, 8, 8)]
    assert one(spark, "none here", scalars.extract_dates) == []


def test_file_names(spark):
    name = "20240811.export.CSV.sampled_0.1.zip"
    assert one(spark, name, scalars.file_stamp) == "20240811"
    assert one(spark, name, scalars.sample_suffix) == ".sampled_0.1"
    assert one(spark, "20240811.export.CSV.zip", scalars.sample_suffix) == ""


def test_int_or_and_present(spark):
    assert one(spark, "7", scalars.int_or) == 7
    assert one(spark, "x", lambda c: scalars.int_or(c, -1)) == -1
    assert one(spark, float("nan"), scalars.present, "double") is False
    assert one(spark, None, scalars.present, "double") is False
    assert one(spark, 0.0, scalars.present, "double") is True


@pytest.mark.parametrize(
    ("name", "location", "state", "country"),
    [
        ("Lima, Lima, Peru", "Lima", "Lima", "Peru"),
        ("Texas, United States", None, "Texas", "United States"),
        ("Peru", None, None, "Peru"),
        ("a, b, c, d", None, "c", "d"),
        (None, None, None, None),
    ],
)
def test_geo_parts(spark, name, location, state, country):
    for part, want in ((geo.location_part, location), (geo.state_part, state), (geo.country_part, country)):
        assert one(spark, name, lambda c, part=part: part(geo.name_parts(c))) == want


def test_zones(spark):
    rows = [("US", "United States", "Texas"), ("US", "United States", None), ("PE", "Peru", "Lima"),
            ("US", "Texas", "Texas")]
    df = spark.createDataFrame(rows, "code string, country string, state string")
    args = [F.col(c) for c in ("code", "country", "state")]
    got = df.select(
        geo.zone_path(*args).alias("p"), geo.zone_label(*args).alias("l"), geo.zone_state(*args).alias("s")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("United States/Texas", "United States / Texas", "Texas"),
        (None, "United States", None),
        ("Peru", "Peru", "Peru"),
        ("Texas/Texas", "Texas", "Texas"),
    ]


def test_heat(spark):
    df = spark.createDataFrame([(-3.0, 4, 1.0), (2.0, 4, 1.0), (None, 4, 1.0)], "g double, m int, t double")
    g, m, t = F.col("g"), F.col("m"), F.col("t")
    got = df.select(heat.squared(g), heat.mention_weighted(g, m), heat.tone_blend(g, t, m)).collect()
    assert tuple(got[0])[0] == 9.0 and got[1][0] == 0.0 and got[2][0] is None
    assert got[0][1] == pytest.approx(3 * 1.6094379124)
    assert got[0][2] == -4.0


def test_counts(spark):
    value = "KILL#5#civ#4#Lima, Peru#PE#PE15#-12.05#-77.05#-33;PROTEST#x##9##US;"
    rows = [tuple(r) for r in one(spark, value, feed_fields.counts)]
    first = rows[0]
    assert first[:7] == ("KILL", 5, "civ", "WORLDCITY", "Lima, Peru", "PE", "PE15")
    assert first[7:9] == (pytest.approx(-12.05), pytest.approx(-77.05)) and first[9] == "-33"
    assert rows[1] == ("PROTEST", None, "", "9", "", "US", None, None, None, None)
    for empty in ("", None, ";"):
        assert one(spark, empty, feed_fields.counts) is None


def test_count_types_match_schema(spark):
    df = spark.createDataFrame([("A#1",)], "c string")
    kind = df.select(feed_fields.counts(F.col("c")).alias("r")).schema["r"].dataType.elementType
    want = schemas.struct(schemas.COUNT_ENTRY_DDL)
    assert [(f.name, f.dataType) for f in kind] == [(f.name, f.dataType) for f in want]


def test_locations(spark):
    value = "4#Lima, Peru#PE#PE15#-12.05#-77.05#-33;1#Solo;#nowhere"
    rows = [tuple(r) for r in one(spark, value, feed_fields.locations)]
    assert rows[0][0] == "WORLDCITY" and rows[0][6] == "-33"
    assert rows[1] == ("COUNTRY", "Solo", None, None, None, None, None)
    assert rows[2][:2] == (None, "nowhere")


def test_tone(spark):
    full = one(spark, "-1.5,2,3.5,5.5,20,0", feed_fields.tone)
    assert tuple(full) == (-1.5, 2.0, 3.5, 5.5, 20.0, 0.0)
    for empty in ("", None):
        assert tuple(one(spark, empty, feed_fields.tone)) == (None,) * 6


def test_hashes(spark):
    assert one(spark, "http://a", text.url_hash) == "54df484bb282e7e472b74675fab8f1b6"
    assert len(text.template_hash("  a\n  b")) == 12
    assert text.template_hash("a\nb") == text.template_hash("\n    a\n    b\n".replace("    ", ""))


def test_sentence_spacing(spark):
    cols = ["a1", "t1", "root", "desc", "a2", "t2", "place", "url"]
    rows = [
        ("POLICE", "Police", "FIGHT", "Fight hard", "CROWD", None, "Peru / Lima / None", "http://a"),
        (None, "x", None, "d", None, "y", "None / None / None", "u"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = [r[0] for r in df.select(text.event_sentence(*[F.col(c) for c in cols])).collect()]
    assert got[0] == (
        "Actor 1: POLICE (type: Police ) performed action FIGHT, more specifically Fight hard "
        "on Actor 2: CROWD  This took place in: Peru / Lima / None  and was reported in: http://a"
    )
    assert got[1] == (
        " performed action None, more specifically d   This took place in: None / None / None"
        "  and was reported in: u"
    )


def test_prompt(spark):
    template = "\n    Shorten:\n    {news_text}\n"
    assert one(spark, "abc", lambda c: text.build_prompt(template, c)) == "\nShorten:\nabc\n"


@pytest.mark.parametrize(
    ("answer", "topics", "people", "has_error"),
    [
        ("1. flood,fire\n2. 1,500", ["flood", "fire"], 1500, False),
        ("None\n0", [], 0, False),
        ("war,,\nmany", ["war"], None, True),
        ("war", ["war"], None, True),
    ],
)
def test_completion(spark, answer, topics, people, has_error):
    assert one(spark, answer, text.completion_topics) == topics
    assert one(spark, answer, text.completion_people) == people
    assert (one(spark, answer, text.completion_error) is not None) == has_error


def test_page_text():
    html = "<title>T</title><script>var a='<p>';</script><style>x</style><!-- c --><p>a &amp; b</p>\n\n\n<p>c"
    assert text.page_text(html) == "Ta & b\nc"
    assert text.page_text(None) is None


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("MonthYear", "month_year"), ("ActionGeo_Lat", "action_geo_lat"),
        ("Actor2Religion1Code", "actor2_religion1_code"), ("EventID", "event_id"),
    ],
)
def test_snake_case(name, expected):
    assert schemas.snake_case(name) == expected


def test_schemas():
    assert [len(f.schema) for f in schemas.FEEDS.values()] == [58, 11, 15]
    assert len(schemas.SILVER_EVENTS_COLUMNS) == 56 and len(schemas.SILVER_COUNTS_COLUMNS) == 16
    with pytest.raises(ValueError, match="unknown source"):
        schemas.feed("mentions")
    rows = [
        {"column": "Day", "col_renamed": "ev_date", "data_type": "INTEGER"},
        {"column": "AvgTone", "data_type": "FLOAT"},
    ]
    assert schemas.struct_from_rows(rows).names == ["ev_date", "avg_tone"]
    assert schemas.struct_from_rows(rows, original_names=True).names == ["Day", "AvgTone"]
