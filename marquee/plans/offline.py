"""Queries: offline analyses, refresh statistics, popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators import offline, refresh, rollout
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import materialise, scratch_path
from marquee.sources import sinks

TOTALS = "totals AS (SELECT movie_id, CAST(sum(minute_no) AS BIGINT) AS minutes FROM v_watch GROUP BY 1)"
PER_MOVIE = """per_movie AS (SELECT movie_id, count(*) n, any_value(popularity) popularity FROM v_rating_big
  JOIN v_movies USING (movie_id) GROUP BY 1)"""
SHARE = """share AS (SELECT k, sum(n) FILTER (rn <= k) / CAST(sum(n) AS DOUBLE) AS share FROM
  (SELECT n, row_number() OVER (ORDER BY n DESC) rn, greatest(1, CAST(floor(0.1 * count(*) OVER ()) AS BIGINT)) k FROM per_movie)
  GROUP BY k)"""
GENRE_COUNTS = """genre_counts AS (SELECT user_id, count(DISTINCT g) n FROM (SELECT r.user_id, unnest(str_split(m.genres, ',')) g
  FROM v_rating_big r JOIN v_movies m USING (movie_id)) GROUP BY 1)"""
DIVERSITY = """diversity AS (SELECT count(*) n_users, round(avg(n), 6) mean_genres, median(n) median_genres,
  quantile_cont(n, 0.1) p10_genres, quantile_cont(n, 0.9) p90_genres FROM genre_counts)"""
OVERVIEW = """overview AS (SELECT (SELECT count(*) FROM v_rating_big) n_rows,
  (SELECT round(avg(rating), 6) FROM v_rating_big) mean_rating, (SELECT round(stddev_samp(rating), 6) FROM v_rating_big) std_rating,
  (SELECT min(rating) FROM v_rating_big) min_rating, (SELECT max(rating) FROM v_rating_big) max_rating,
  (SELECT count(*) FROM (SELECT DISTINCT user_id FROM v_rating_big)) n_users,
  (SELECT round(avg(n), 6) FROM (SELECT count(*) n FROM v_rating_big GROUP BY user_id)) mean_interactions_per_user,
  (SELECT median(n) FROM (SELECT count(*) n FROM v_rating_big GROUP BY user_id)) median_interactions_per_user,
  (SELECT count(*) FROM (SELECT DISTINCT movie_id FROM v_rating_big)) n_movies,
  (SELECT round(avg(n), 6) FROM (SELECT count(*) n FROM v_rating_big GROUP BY movie_id)) mean_interactions_per_movie,
  (SELECT median(n) FROM (SELECT count(*) n FROM v_rating_big GROUP BY movie_id)) median_interactions_per_movie)"""
def _stats_sql(where: str = "") -> str:
    return f"""SELECT count(DISTINCT user_id) users, count(DISTINCT item) movies, count(*) FILTER (event_type = 'view') interactions,
    count(*) FILTER (event_type = 'purchase') ratings FROM v_event {where}"""


#: The reports before the current one cover the events up to these shares of the days.
EARLIER = (0.25, 0.5)
REFRESH = f"""cut AS (SELECT CAST(min(ts) AS DATE) + CAST(floor(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) * {EARLIER[-1]}) AS INTEGER) AS day
    FROM v_event), now_stats AS ({_stats_sql()}), old_stats AS ({_stats_sql("WHERE CAST(ts AS DATE) < (SELECT day FROM cut)")})"""


def per_movie_of(v: Views) -> DataFrame:
    return offline.movie_popularity(v.v_rating_big, v.v_movies)


def totals_of(v: Views) -> DataFrame:
    return offline.popularity_totals(v.v_watch)


@query("popularity_total", "SELECT * FROM totals", TOTALS)
def popularity_total(v):
    return totals_of(v)


@query(
    "popularity_top10",
    """SELECT t.movie_id, m.title, t.minutes, row_number() OVER (ORDER BY t.minutes DESC, t.movie_id) AS rank
       FROM (SELECT * FROM totals ORDER BY minutes DESC, movie_id LIMIT 10) t JOIN v_movies m ON m.movie_id = t.movie_id""",
    TOTALS,
)
def popularity_top10(v):
    top = offline.popularity_top(totals_of(v), 10)
    return top.join(v.v_movies.select("movie_id", "title"), "movie_id").select(
        F.col("movie_id").cast("int"), "title", "minutes", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "popularity_summary",
    """SELECT CAST(sum(minutes) AS BIGINT) total, round(avg(minutes), 6) mean, median(minutes) median,
       round(stddev_samp(minutes), 6) std, count(*) n FROM totals""",
    TOTALS,
)
def popularity_summary(v):
    return offline.popularity_summary(totals_of(v))


@query("popularity_corr", "SELECT count(*) n_movies, round(corr(n, popularity), 6) corr FROM per_movie", PER_MOVIE)
def popularity_corr(v):
    return offline.popularity_correlation(per_movie_of(v))


@query("top_share", "SELECT k, round(share, 6) AS share FROM share", PER_MOVIE, SHARE)
def top_share(v):
    return offline.popularity_concentration(per_movie_of(v))


def scored_with_gender(v: Views) -> DataFrame:
    scored = v.v_scored.select("user_id", F.col("label").alias("rating"), "prediction")
    return scored.join(v.v_users.select("user_id", "gender"), "user_id", "left")


FAIRNESS = """fairness AS (SELECT gender, count(*) n, round(avg(label), 6) mean_rating, round(avg(abs(prediction - label)), 6) mae
  FROM v_scored JOIN v_users USING (user_id) WHERE gender IS NOT NULL GROUP BY 1)"""


@query("group_fairness", "SELECT * FROM fairness", FAIRNESS)
def group_fairness(v):
    return offline.group_fairness(scored_with_gender(v))


@query("genre_diversity", "SELECT * FROM diversity", GENRE_COUNTS, DIVERSITY)
def genre_diversity(v):
    return offline.genre_diversity(v.v_rating_big, v.v_movies)


@query("log_overview", "SELECT * FROM overview", OVERVIEW)
def log_overview(v):
    return offline.log_overview(v.v_rating_big)


REPORT_SQL = """SELECT c.n_movies, c.corr, s.share, d.n_users, d.mean_genres, o.n_rows, o.mean_rating, f.groups, f.worst_mae
  FROM (SELECT count(*) n_movies, round(corr(n, popularity), 6) corr FROM per_movie) c,
  (SELECT round(share, 6) AS share FROM share) s, diversity d, overview o,
  (SELECT string_agg(gender, ',' ORDER BY gender) groups, max(mae) worst_mae FROM fairness) f"""
REPORT_CTES = (PER_MOVIE, SHARE, GENRE_COUNTS, DIVERSITY, OVERVIEW, FAIRNESS)


def _report_columns(report: DataFrame) -> DataFrame:
    groups = F.col("fairness_by_gender")
    return report.select(
        "popularity_stats.n_movies", "popularity_stats.corr", "popularity_stats.share",
        "genre_diversity.n_users", "genre_diversity.mean_genres",
        "offline_log_stats.n_rows", "offline_log_stats.mean_rating",
        F.array_join(groups["gender"], ",").alias("groups"),
        F.array_max(groups["mae"]).alias("worst_mae"),
    )


def report_of(v: Views) -> DataFrame:
    # The ratings feed four analyses; here they come from a join, done once.
    ratings = materialise(v.v_rating_big.select("user_id", "movie_id", "rating"), "ratings")
    return offline.feedback_report(ratings, v.v_movies, scored_with_gender(v))


@query("feedback_report", REPORT_SQL, *REPORT_CTES)
def feedback_report(v):
    return _report_columns(report_of(v))


@query("report_sink", REPORT_SQL, *REPORT_CTES)
def report_sink(v):
    report = report_of(v)
    path = scratch_path(v.spark, "report") + ".json"
    sinks.write_report(report, path)
    return _report_columns(v.spark.read.schema(report.schema).json(path))


@query(
    "error_rate_total",
    "SELECT round((SELECT count(*) FROM v_error) / CAST(greatest((SELECT count(*) FROM v_recs), 1) AS DOUBLE), 6) rate",
)
def error_rate_total(v):
    return offline.error_ratio(v.v_error, v.v_recs)


def stats_of(v: Views, share: float | None = None) -> DataFrame:
    """Statistics of all events, or of those before the day that ends the first ``share`` of the days."""
    events = v.v_event
    if share is not None:
        day = F.to_date("ts")
        first, last = F.min(day), F.max(day)
        cut = events.agg(F.date_add(first, F.floor(F.datediff(last, first) * F.lit(share)).cast("int")).alias("d")).scalar()
        events = events.filter(day < cut)
    keys = events.select("user_id", F.col("item").alias("movie_id"))
    return refresh.refresh_stats(
        v.spark, keys, keys, events.filter("event_type = 'view'"), events.filter("event_type = 'purchase'")
    )


@query("refresh_stats", "SELECT * FROM now_stats", REFRESH)
def refreshstats_of(v):
    return stats_of(v)


@query(
    "refresh_delta",
    """SELECT n.*, n.users - o.users delta_users, n.movies - o.movies delta_movies, n.interactions - o.interactions delta_interactions,
       n.ratings - o.ratings delta_ratings FROM now_stats n, old_stats o""",
    REFRESH,
)
def refresh_delta(v):
    path = scratch_path(v.spark, "reports")
    for stats, at in ((stats_of(v, share), f"2024-01-0{k} 00:00:00") for k, share in enumerate(EARLIER, 1)):
        sinks.append_table(stats.withColumn("timestamp", F.lit(at).cast("timestamp")), path, schemas.REFRESH_REPORT)
    stored = v.spark.read.schema(schemas.REFRESH_REPORT).parquet(path)
    return refresh.refresh_delta(stats_of(v), refresh.latest_report(stored))


@query(
    "retrain_gate",
    """SELECT n.users - o.users unseen_users, n.interactions - o.interactions unseen_interactions,
       NOT (n.users - o.users < 50 AND n.interactions - o.interactions < 100) retrain FROM now_stats n, old_stats o""",
    REFRESH,
)
def retrain_gate(v):
    path = scratch_path(v.spark, "retrain-state")
    for k, share in enumerate(EARLIER, 1):
        state = refresh.retrain_state(stats_of(v, share), F.lit(f"2024-01-0{k} 00:00:00").cast("timestamp"))
        sinks.append_table(state, path, schemas.RETRAIN_STATE)
    stored = v.spark.read.schema(schemas.RETRAIN_STATE).parquet(path)
    return rollout.retrain_gate(stats_of(v), refresh.latest_state(stored))
