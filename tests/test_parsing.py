import pytest
from pyspark.sql import functions as F

from marquee.functions import parsing
from marquee.functions import scalars as S
from marquee.operators import ingest


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value STRING")


def test_watch_event(spark, rows):
    found = parsing.watch_events(lines(spark, "2031-05-04T08:15,ana7,GET /data/m/north-light/42.mpg", "### no event", "late,/data/m/half/3.mpg"))
    assert rows(found) == [("ana7", "north-light", 42)]


def test_rating_event_by_pattern_and_by_position(spark, rows):
    log = lines(spark, " 2031-05-04T09,bo,GET /rate/harbor=2", "2031-05-04T10,bo,GET /rate/nothing", "### no event")
    expected = [("2031-05-04T09", "bo", "harbor", 2)]
    assert rows(parsing.rating_events(log)) == expected
    assert rows(parsing.rating_events_by_split(log)) == expected


def test_watch_set(spark, rows):
    log = lines(spark, "5,cy,/data/m/dune/7.mpg", "6,cy,/data/m/dune/8.mpg", "6,cy,/data/m/dune/8.mpg", "9,di,/data/m/echo/3.mpg")
    watched = ingest.watch_aggregate(parsing.watch_events(log))
    assert rows(watched) == [("cy", "dune", 2, 8), ("di", "echo", 1, 3)]


def test_new_pairs_skip_stored_and_failed(spark, rows):
    log = lines(spark, "1,eva,/data/m/fog/6.mpg", "2,eva,/data/m/gate/5.mpg", "3,finn,/data/m/hill/4.mpg")
    stored = spark.createDataFrame([("eva", "fog")], "user_id STRING, movie_id STRING")
    failed = spark.createDataFrame([("hill",)], "movie_id STRING")
    fresh = ingest.new_pairs(ingest.watch_aggregate(parsing.watch_events(log)), stored, failed)
    assert rows(fresh) == [("eva", "gate", 1, 5)]


def test_ratings_need_known_user_and_movie(spark, rows):
    log = lines(spark, "11,gil,GET /rate/isle=3", "12,hana,GET /rate/jade=1")
    users = spark.createDataFrame([("gil",)], "user_id STRING")
    movies = spark.createDataFrame([("isle",)], "movie_id STRING")
    assert rows(ingest.known_ratings(parsing.rating_events(log), users, movies)) == [("11", "gil", "isle", 3)]


def test_ingest_log_summary(spark, rows):
    log = lines(spark, "21,ivo,/data/m/kite/30.mpg", "22,ivo,/data/m/kite/31.mpg", "23,ivo,GET /rate/kite=2")
    nothing = spark.createDataFrame([], "user_id STRING, movie_id STRING")
    result = ingest.ingest_log(log, nothing, nothing.select("movie_id"))
    assert rows(ingest.ingest_summary(result["watch"])) == [(1, 1)]
    assert rows(result["ratings"].select("movie_id", "rating")) == [("kite", 2)]


def test_latest_rating_breaks_equal_timestamps(spark, rows):
    rated = spark.createDataFrame(
        [("t1", "u", "m", 2), ("t2", "u", "m", 3), ("t2", "u", "m", 5), ("t0", "v", "m", 1)],
        "timestamp STRING, user_id STRING, movie_id STRING, rating INT",
    )
    assert rows(ingest.latest_ratings(rated, ["timestamp", "rating"]).select("user_id", "rating")) == [("u", 5), ("v", 1)]


def test_decode_drops_invalid_and_empty(spark, rows):
    messages = spark.createDataFrame([(b"hi",), (b"\xff\xfe",), (b"",), (None,)], "value BINARY")
    assert rows(parsing.decode_messages(messages)) == [("hi",)]


def test_flatten_movie(spark, rows):
    from marquee import schemas

    documents = [
        '{"id": "a/1", "title": "A", "genres": [{"name": "Drama"}, {"id": 3}], "overview": "one\\ntwo",'
        ' "production_countries": [{"iso_3166_1": "US"}], "spoken_languages": [{"name": "English"}]}',
        '{"id": "b"}',
    ]
    parsed = lines(spark, *documents).select(F.from_json("value", schemas.MOVIE_DOCUMENT).alias("d")).select("d.*")
    flat = parsing.flatten_movies(parsed).select(
        "id", "title", "genres", "spoken_languages", "production_countries", "overview"
    )
    assert rows(flat) == [("a/1", "A", "Drama,", "English", "US", "one two"), ("b", None, "", "", "", "")]


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ("12.9", 12), (" 7 ", 7), ("x", None), ("", None), (None, None), ("nan", None)],
)
def test_integer_id(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "raw STRING")
    assert frame.select(S.integer_id(F.col("raw"))).first()[0] == expected


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"recommendations": ["a", "b"]}', ["a", "b"]),
        ('{"recommendations": [{"item_id": "a"}, {"item_id": 2}]}', ["a", "2"]),
        ("[1, 2]", ["1", "2"]),
        ("a, b,, c", ["a", "b", "c"]),
        ("single", ["single"]),
        ('{"other": 1}', []),
        ("", []),
    ],
)
def test_served_items(spark, payload, expected):
    frame = spark.createDataFrame([(payload,)], "p STRING")
    assert frame.select(S.served_items(F.col("p"))).first()[0] == expected


@pytest.mark.parametrize("text, expected", [("120", 100.0), ("-3", 0.0), ("x", 10.0), (None, 10.0), ("55.5", 55.5)])
def test_percentage(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "p STRING")
    assert frame.select(S.percentage(F.col("p"), 10.0)).first()[0] == expected
