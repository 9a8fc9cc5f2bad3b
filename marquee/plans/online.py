"""Queries: click-through, attribution, rollout, windowed metrics, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.scalars import share_limit
from marquee.operators import lineage, metrics, online, rollout, windows
from marquee.plans.registry import query
from marquee.plans.views import Views
from marquee.session import scratch_path
from marquee.sources import sinks

HOUR = "1 hour"

CTR = """shown AS (SELECT model_version, ts, user_id, unnest(items) item_id FROM v_recs),
  ctr_all AS (SELECT (SELECT count(*) FROM shown) shown, (SELECT count(*) FROM v_inter i WHERE EXISTS
    (SELECT 1 FROM shown s WHERE s.user_id = i.user_id AND s.item_id = i.item_id)) hits),
  ctr_model AS (SELECT model_version, count(*) shown, (SELECT count(*) FROM v_inter i WHERE EXISTS (SELECT 1 FROM shown s
    WHERE s.user_id = i.user_id AND s.item_id = i.item_id AND s.model_version = t.model_version)) hits FROM shown t GROUP BY 1)"""
GROUPS = """groups AS (SELECT avg(rating) FILTER (gender = 'M') rating_m, avg(rating) FILTER (gender = 'F') rating_f
  FROM v_quality LEFT JOIN v_users USING (user_id))"""
FLAGS = """nullif(concat_ws('+', CASE WHEN ctr < {t} THEN 'feedback_low_ctr' END, CASE WHEN ctr_v2 < {t} THEN 'canary_low_ctr_abs' END,
  CASE WHEN ctr_v1 > 0 AND ctr_v2 < 0.7 * ctr_v1 THEN 'canary_low_ctr_rel' END, CASE WHEN ratio < 0.85 THEN 'fairness_gender' END), '')"""
DAILY = f"""daily_shown AS (SELECT CAST(ts AS DATE) AS day, model_version, user_id, unnest(items) item_id FROM v_recs),
  daily_clicks AS (SELECT CAST(ts AS DATE) AS day, user_id, item_id FROM v_inter),
  daily_model AS (SELECT day, model_version, count(*) / 1.0 shown, (SELECT count(*) FROM daily_clicks c WHERE c.day = t.day AND EXISTS
     (SELECT 1 FROM daily_shown s WHERE s.day = c.day AND s.user_id = c.user_id AND s.item_id = c.item_id
      AND s.model_version = t.model_version)) hits FROM daily_shown t GROUP BY 1, 2),
  daily_all AS (SELECT day, count(*) / 1.0 shown, (SELECT count(*) FROM daily_clicks c WHERE c.day = t.day AND EXISTS
     (SELECT 1 FROM daily_shown s WHERE s.day = c.day AND s.user_id = c.user_id AND s.item_id = c.item_id)) hits
     FROM daily_shown t GROUP BY 1),
  daily_rates AS (SELECT a.day, a.hits / a.shown ctr,
     (SELECT m.hits / m.shown FROM daily_model m WHERE m.day = a.day AND m.model_version = 'v1') ctr_v1,
     (SELECT m.hits / m.shown FROM daily_model m WHERE m.day = a.day AND m.model_version = 'v2') ctr_v2,
     (SELECT count(*) FROM daily_clicks c WHERE c.day = a.day) n_inter,
     CAST(NULL AS DOUBLE) ratio, (SELECT count(*) FROM v_event e WHERE CAST(e.ts AS DATE) = a.day) % 21 * 5.0 current_pct
     FROM daily_all a),
  state AS (SELECT *, {FLAGS.format(t=0.002)} issue FROM daily_rates)"""


@query("ctr_global", "SELECT shown, hits, round(hits / CAST(shown AS DOUBLE), 6) ctr FROM ctr_all", CTR)
def ctr_global(v):
    return online.ctr(v.v_recs, v.v_inter)


@query(
    "ctr_by_model", "SELECT model_version, shown, hits, round(hits / CAST(shown AS DOUBLE), 6) ctr FROM ctr_model", CTR
)
def ctr_by_model(v):
    return online.ctr(v.v_recs, v.v_inter, ["model_version"])


@query(
    "group_rating",
    "SELECT round(rating_m, 6) rating_m, round(rating_f, 6) rating_f, round(rating_f / rating_m, 6) ratio FROM groups",
    GROUPS,
)
def group_rating(v):
    return online.group_rating(v.v_quality, v.v_users)


@query(
    "issue_flags",
    f"""SELECT *, {FLAGS.format(t=0.1)} issue FROM (SELECT hits / CAST(shown AS DOUBLE) ctr,
        (SELECT hits / CAST(shown AS DOUBLE) FROM ctr_model WHERE model_version = 'v1') ctr_v1,
        (SELECT hits / CAST(shown AS DOUBLE) FROM ctr_model WHERE model_version = 'v2') ctr_v2,
        (SELECT rating_f / rating_m FROM groups) ratio, (SELECT count(*) FROM v_recs) n_rec_events,
        (SELECT count(*) FROM v_inter) n_interaction_events, (SELECT count(*) FROM v_quality) n_quality_events FROM ctr_all)""".replace(
        "SELECT *,",
        """SELECT round(ctr, 6) ctr, round(ctr_v1, 6) ctr_v1, round(ctr_v2, 6) ctr_v2, round(ratio, 6) ratio, n_rec_events,
        n_interaction_events, n_quality_events,""",
    ),
    CTR, GROUPS,
)
def issue_flags(v):
    found = online.detection(v.v_recs, v.v_inter, v.v_quality, v.v_users)
    return found.select(
        "ctr", "ctr_v1", "ctr_v2", "ratio", "n_rec_events", "n_interaction_events", "n_quality_events", "issue"
    )


def daily_state(v: Views) -> DataFrame:
    """One row per day with what the rollout policy needs."""
    day = F.to_date("ts").alias("day")
    served = v.v_recs.select("*", day)
    clicks = v.v_inter.select("*", day)
    total = online.ctr(served, clicks, ["day"]).select("day", "ctr")
    models = online.ctr(served, clicks, ["day", "model_version"]).groupBy("day").agg(
        F.max(F.when(F.col("model_version") == "v1", F.col("ctr"))).alias("ctr_v1"),
        F.max(F.when(F.col("model_version") == "v2", F.col("ctr"))).alias("ctr_v2"),
    )
    inter = clicks.groupBy("day").agg(F.count(F.lit(1)).alias("n_inter"))
    load = v.v_event.groupBy(day).agg((F.count(F.lit(1)) % 21 * 5.0).alias("current_pct"))
    joined = total.join(models, "day").join(inter, "day", "left").fillna(0, ["n_inter"]).join(load, "day")
    flags = online.issue_flags(
        F.col("ctr"), F.col("ctr_v1"), F.col("ctr_v2"), F.lit(None).cast("double"), ctr_threshold=0.002
    )
    return joined.withColumn("issue", flags)


@query(
    "rollout_staircase",
    """SELECT day, CAST(current_pct AS DOUBLE) current_pct, issue, CAST(CASE WHEN issue IS NOT NULL THEN 0 WHEN current_pct < 5 THEN 5
       WHEN current_pct < 10 THEN 10 WHEN current_pct < 25 THEN 25 WHEN current_pct < 50 THEN 50 WHEN current_pct < 100 THEN 100
       ELSE current_pct END AS DOUBLE) new_pct FROM state""",
    DAILY,
)
def rollout_staircase(v):
    return daily_state(v).select(
        "day", "current_pct", "issue", rollout.staircase_step(F.col("current_pct"), F.col("issue")).alias("new_pct")
    )


LINEAR = """stepped AS (SELECT *, CASE WHEN current_pct < 10 THEN 10 ELSE least(100, current_pct + 10) END raised FROM state),
  chosen AS (SELECT *, CASE WHEN issue IS NOT NULL THEN 'abort' WHEN ctr_v2 IS NULL THEN 'no_canary' WHEN n_inter < 10 THEN 'too_few'
    WHEN n_inter % 10 <> 0 THEN 'waiting' WHEN raised = current_pct THEN 'unchanged' WHEN raised >= 100 THEN 'promote' ELSE 'ramp' END step
    FROM stepped),
  decided AS (SELECT * FROM chosen UNION ALL SELECT * REPLACE ('reach' AS step) FROM chosen WHERE step = 'promote'),
  linear AS (SELECT day, current_pct, n_inter, issue, step, raised, CASE step WHEN 'abort' THEN 'ABORT' WHEN 'promote' THEN 'PROMOTE_AND_RESET'
    ELSE 'RAMP' END AS action, CASE step WHEN 'abort' THEN 'canary_abort' WHEN 'promote' THEN 'promotion' ELSE 'canary_check' END event_type,
    CASE WHEN step IN ('abort', 'promote') THEN 0 WHEN step IN ('ramp', 'reach') THEN raised ELSE current_pct END new_pct,
    CASE step WHEN 'abort' THEN concat('Issue detected: ', issue, '. Canary release aborted and traffic returned to v1 exclusively.')
      WHEN 'no_canary' THEN 'No canary traffic observed.'
      WHEN 'too_few' THEN concat('Insufficient interactions (', n_inter, '); need >= 10.')
      WHEN 'waiting' THEN concat('Waiting for interaction count multiple of 10 (have ', n_inter, ').')
      WHEN 'unchanged' THEN 'Canary percentage unchanged.'
      WHEN 'reach' THEN 'All metrics healthy. Ramping to 100% for promotion.'
      WHEN 'promote' THEN concat('Canary reached 100% with sustained performance (CTR[v2]=', printf('%.3f', ctr_v2), ' > 70% of v1=',
        printf('%.3f', ctr_v1), '). Promotion successful.')
      ELSE concat('CTR[v2]=', printf('%.3f', ctr_v2), ' > 70% of CTR[v1]=', printf('%.3f', ctr_v1), '. Ramping to ',
        CAST(raised AS INT), '%.') END reason FROM decided)"""


@query(
    "rollout_linear",
    """SELECT day, CAST(current_pct AS DOUBLE) current_pct, n_inter, issue, action, event_type, CAST(new_pct AS DOUBLE) new_pct, reason
       FROM linear""",
    DAILY, LINEAR,
)
def rollout_linear(v):
    return rollout.linear_rollout(daily_state(v)).select(
        "day", "current_pct", "n_inter", "issue", "action", "event_type", "new_pct", "reason"
    )


@query(
    "feedback_event",
    """SELECT CAST(day AS TIMESTAMP) AS "timestamp", event_type, issue, action action_taken,
       CAST(CASE step WHEN 'promote' THEN raised ELSE current_pct END AS DOUBLE) canary_percentage_before, CAST(new_pct AS DOUBLE) canary_percentage_after, reason FROM linear""",
    DAILY, LINEAR,
)
def feedback_event(v):
    path = scratch_path(v.spark, "feedback")
    sinks.append_table(rollout.feedback_event(daily_state(v), F.col("day").cast("timestamp")), path, schemas.FEEDBACK_EVENTS)
    return v.spark.read.schema(schemas.FEEDBACK_EVENTS).parquet(path).drop("details")


ATTRIBUTED = """attributed AS (SELECT c.event_id, s.event_id served_event, coalesce(s.model_version, 'unknown') model_version,
  coalesce(list_contains(s.items, c.item_id), false) AS matched
  FROM v_inter c ASOF LEFT JOIN v_recs s ON c.user_id = s.user_id AND c.ts >= s.ts)"""


@query("click_attribution", "SELECT * FROM attributed", ATTRIBUTED)
def click_attribution(v):
    return online.click_attribution(v.v_recs, v.v_inter)


@query(
    "rating_attribution",
    """SELECT q.event_id, coalesce(s.model_version, 'unknown') model_version FROM v_quality q ASOF LEFT JOIN v_recs s
       ON q.user_id = s.user_id AND q.ts >= s.ts""",
)
def rating_attribution(v):
    return online.rating_attribution(v.v_recs, v.v_quality)


@query(
    "hit_latest",
    """SELECT i.event_id, CAST(coalesce(list_contains(l.items, i.item_id), false) AS DOUBLE) hit FROM v_inter i
       LEFT JOIN (SELECT user_id, arg_max(items, ts) items FROM v_recs GROUP BY 1) l USING (user_id)""",
)
def hit_latest(v):
    return online.hits_against(online.latest_list(v.v_recs), v.v_inter).select("event_id", "hit")


def _metrics_sql(hours: int) -> str:
    cut = f"ts > (SELECT max(ts) FROM v_event) - INTERVAL {hours} HOURS"
    return f"""SELECT {hours} AS hours, (SELECT count(*) FROM v_recs WHERE {cut}) num_recommendations,
      (SELECT count(*) FROM v_inter WHERE {cut}) num_interactions,
      (SELECT round(coalesce(avg(response_time), 0), 6) FROM v_recs WHERE {cut}) avg_response_time,
      (SELECT round(coalesce(quantile_cont(response_time, 0.95), 0), 6) FROM v_recs WHERE {cut}) p95_response_time,
      (SELECT round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM v_recs WHERE {cut}), 6) FROM v_error WHERE {cut}) error_rate,
      (SELECT round(coalesce(avg(CAST(coalesce(list_contains(l.items, i.item_id), false) AS DOUBLE)), 0), 6)
         FROM (SELECT * FROM v_inter WHERE {cut}) i LEFT JOIN (SELECT user_id, arg_min(items, ts) items FROM v_recs WHERE {cut}
         GROUP BY 1) l USING (user_id)) hit_rate,
      (SELECT count(DISTINCT user_id) FROM v_recs WHERE {cut}) user_coverage,
      (SELECT count(DISTINCT i) FROM (SELECT unnest(items) i FROM v_recs WHERE {cut})) item_coverage"""


@query("online_metrics", f"SELECT * FROM ({_metrics_sql(24)} UNION ALL {_metrics_sql(240)})")
def online_metrics(v):
    as_of = v.v_event.agg(F.max("ts")).scalar()
    return online.online_metrics(v.v_recs, v.v_inter, v.v_error, as_of, [24, 240])


@query(
    "online_error",
    """SELECT count(*) n, round(avg(abs(rating - predicted)), 6) mae, round(sqrt(avg((rating - predicted) * (rating - predicted))), 6) rmse
       FROM v_quality""",
)
def online_error(v):
    return online.online_error(v.v_quality)


@query(
    "canary_assign",
    f"""SELECT event_id, user_id, CASE WHEN substr(md5(concat('42:', CAST(user_id AS VARCHAR))), 1, 8) < '{share_limit(0.1)}'
        THEN 'v2' ELSE 'v1' END model FROM v_request""",
)
def canary_assign(v):
    """Sticky: every request of a user goes to the same model."""
    return online.canary_assign(v.v_request, 10, "user_id").select("event_id", "user_id", "model")


@query(
    "traffic_split",
    """SELECT model_version, count(*) n, round(count(*) / CAST((SELECT count(*) FROM v_recs) AS DOUBLE), 6) AS share,
       (SELECT count(*) FILTER (model_version = 'v2') > 0
          AND abs(100.0 * count(*) FILTER (model_version = 'v2') / count(*) - 10) <= 15
          AND CAST(e.n AS DOUBLE) / (count(*) + e.n) < 0.1 FROM v_recs, (SELECT count(*) n FROM v_error) e
          GROUP BY e.n) AS pass
       FROM v_recs GROUP BY 1""",
)
def traffic_split(v):
    n_errors = v.v_error.agg(F.count(F.lit(1))).scalar()
    return online.traffic_split(v.v_recs, n_errors, 10.0)


BUCKET = "time_bucket(INTERVAL 1 HOUR, ts)"


@query("window_status_count", f"SELECT {BUCKET} window_start, status, count(*) n FROM v_request GROUP BY ALL")
def window_status_count(v):
    return windows.count_by(v.v_request, "status", width=HOUR)


@query(
    "window_error_count",
    f"SELECT {BUCKET} window_start, count(*) FILTER (status NOT BETWEEN 200 AND 299) n_errors FROM v_request GROUP BY ALL",
)
def window_error_count(v):
    return windows.error_count(v.v_request, HOUR)


@query(
    "window_event_rate",
    f"SELECT {BUCKET} window_start, path, round(count(*) / 3600.0, 6) rate FROM v_request GROUP BY ALL",
)
def window_event_rate(v):
    return windows.event_rate(v.v_request, "path", width=HOUR)


def _quantile_sql(share: float, counts: list[str], total: str) -> str:
    """Bucket interpolation, as SQL over count columns."""
    cases = []
    for i, bound in enumerate(windows.LATENCY_BOUNDS):
        low, below = (windows.LATENCY_BOUNDS[i - 1], counts[i - 1]) if i else (0.0, "0")
        cases.append(
            f"WHEN {counts[i]} >= {share} * {total} THEN {low} + ({bound} - {low}) * "
            f"((CAST({share} AS DOUBLE) * {total} - {below}) / CAST({counts[i]} - {below} AS DOUBLE))"
        )
    return f"round(CASE {' '.join(cases)} ELSE {windows.LATENCY_BOUNDS[-1]} END, 6)"


N_BOUNDS = len(windows.LATENCY_BOUNDS)
HIST_COLUMNS = ", ".join(f"count(*) FILTER (latency <= {b}) c{i}" for i, b in enumerate(windows.LATENCY_BOUNDS))
HIST_NAMES = [f"c{i}" for i in range(N_BOUNDS)]
HIST = f"hist AS (SELECT {BUCKET} window_start, {HIST_COLUMNS}, count(*) total FROM v_request GROUP BY 1)"
HIST_PATH = f"hist_path AS (SELECT {BUCKET} window_start, path, {HIST_COLUMNS}, count(*) total FROM v_request GROUP BY 1, 2)"
HIST_ALL = f"hist_all AS (SELECT path, {HIST_COLUMNS}, count(*) total FROM v_request GROUP BY 1)"


@query(
    "window_latency_pct",
    "SELECT window_start, "
    + ", ".join(f"{_quantile_sql(s, HIST_NAMES, 'total')} {n}" for n, s in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)))
    + " FROM hist",
    HIST,
)
def window_latency_pct(v):
    return windows.latency_quantiles(v.v_request, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, width=HOUR)


@query(
    "window_latency_path",
    f"SELECT window_start, path, {_quantile_sql(0.9, HIST_NAMES, 'total')} p90 FROM hist_path",
    HIST_PATH,
)
def window_latency_path(v):
    return windows.latency_quantiles(v.v_request, {"p90": 0.9}, "path", width=HOUR)


@query(
    "histogram_quantile",
    f"SELECT path, {_quantile_sql(0.9, HIST_NAMES, 'total')} quantile FROM hist_all",
    HIST_ALL,
)
def histogram_quantile(v):
    return windows.quantile_of_rows(windows.histogram_rows(v.v_request, "path"), 0.9, "path")


@query("offset_lag", "SELECT topic, produced, consumed, produced - consumed lag FROM v_offsets")
def offset_lag(v):
    return windows.offset_lag(v.v_offsets)


WINDOW_CTR = f"""served_w AS (SELECT {BUCKET} window_start, count(*) n FROM v_recs GROUP BY 1),
  hits_w AS (SELECT time_bucket(INTERVAL 1 HOUR, c.ts) window_start, count(*) n FROM v_inter c JOIN attributed a USING (event_id)
    WHERE a.matched GROUP BY 1),
  ctr_w AS (SELECT window_start, coalesce(s.n, 0) served, coalesce(h.n, 0) hits,
    100.0 * coalesce(h.n, 0) / greatest(CAST(coalesce(s.n, 0) AS DOUBLE), 1e-9) ctr_pct
    FROM served_w s FULL JOIN hits_w h USING (window_start))"""


def window_hits(v: Views, width: str) -> DataFrame:
    clicks = online.click_attribution(v.v_recs, v.v_inter).filter("matched").select("event_id")
    return windows.hit_percentage(v.v_recs, v.v_inter.join(clicks, "event_id"), width)


@query("window_ctr", "SELECT window_start, served, hits, round(ctr_pct, 6) ctr_pct FROM ctr_w", ATTRIBUTED, WINDOW_CTR)
def window_ctr(v):
    return window_hits(v, HOUR)


@query(
    "window_gaps",
    """SELECT w window_start, coalesce(n, 0) n, CAST(n IS NOT NULL AS INT) up FROM
       (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 10 MINUTES)) w FROM active)
       LEFT JOIN active ON active.window_start = w""",
    "active AS (SELECT time_bucket(INTERVAL 10 MINUTES, ts) window_start, count(*) n FROM v_event GROUP BY 1)",
)
def window_gaps(v):
    return windows.gaps(v.v_event)


@query(
    "quality_alert",
    "SELECT w AS alert_at FROM alerts WHERE w IS NOT NULL",
    """low AS (SELECT w FROM (SELECT time_bucket(INTERVAL 10 MINUTES, ts) w, count(*) FILTER (status = 200) / CAST(count(*) AS DOUBLE) good
         FROM v_request GROUP BY 1) WHERE good < 0.3),
       alerts AS (SELECT min(w) AS w FROM low UNION ALL
         SELECT (SELECT min(w) FROM low WHERE low.w >= alerts.w + INTERVAL 1 HOUR) FROM alerts WHERE alerts.w IS NOT NULL)""",
)
def quality_alert(v):
    series = windows.windowed(v.v_request).groupBy("window_start").agg(
        (F.count_if(F.col("status") == 200) / F.count(F.lit(1))).alias("good")
    )
    return windows.quality_alerts(series, "good", 0.3)


@query(
    "trace_prediction",
    """SELECT p.request_id, p.model_version, m.training_data_id, d.data_source FROM v_prediction_events p
       LEFT JOIN v_model_registry m USING (model_version) LEFT JOIN v_data_registry d ON m.training_data_id = d.data_id""",
)
def trace_prediction(v):
    return lineage.trace_predictions(v.v_prediction_events, v.v_model_registry, v.v_data_registry).select(
        "request_id", "model_version", "training_data_id", "data_source"
    )


@query(
    "trace_evaluation",
    """SELECT e.eval_id, e.model_version, m.training_data_id, round(e.rmse, 6) rmse FROM v_evaluation_events e
       LEFT JOIN v_model_registry m USING (model_version)""",
)
def trace_evaluation(v):
    return lineage.trace_evaluations(v.v_evaluation_events, v.v_model_registry).select(
        "eval_id", "model_version", "training_data_id", "rmse"
    )


@query(
    "recent_predictions",
    """SELECT model_version, request_id, row_number() OVER (PARTITION BY model_version ORDER BY seq) AS "position" FROM
       (SELECT * FROM v_prediction_events QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY seq DESC) <= 100)""",
)
def recent_predictions(v):
    return lineage.recent_events(v.v_prediction_events, n=100).select(
        "model_version", "request_id", F.col("position").cast("bigint").alias("position")
    )


@query(
    "recent_by_user",
    """SELECT userid, request_id, row_number() OVER (PARTITION BY userid ORDER BY seq) AS "position" FROM
       (SELECT * FROM v_prediction_events QUALIFY row_number() OVER (PARTITION BY userid ORDER BY seq DESC) <= 50)""",
)
def recent_by_user(v):
    return lineage.recent_events(v.v_prediction_events, key="userid", n=50).select(
        "userid", "request_id", F.col("position").cast("bigint").alias("position")
    )


@query(
    "recent_overall",
    "SELECT request_id, model_version FROM v_prediction_events ORDER BY seq DESC LIMIT 1000",
)
def recent_overall(v):
    return lineage.recent_events_overall(v.v_prediction_events).select("request_id", "model_version")


@query(
    "recent_evaluations",
    """SELECT model_version, eval_id, row_number() OVER (PARTITION BY model_version ORDER BY seq) AS "position" FROM
       (SELECT * FROM v_evaluation_events QUALIFY row_number() OVER (PARTITION BY model_version ORDER BY seq DESC) <= 50)""",
)
def recent_evaluations(v):
    return lineage.recent_events(v.v_evaluation_events, n=50).select(
        "model_version", "eval_id", F.col("position").cast("bigint").alias("position")
    )


@query("recent_evaluations_overall", "SELECT eval_id, model_version FROM v_evaluation_events ORDER BY seq DESC LIMIT 100")
def recent_evaluations_overall(v):
    return lineage.recent_events_overall(v.v_evaluation_events, n=100).select("eval_id", "model_version")


@query("model_by_version", "SELECT model_version, training_data_id, artifact_path FROM v_model_registry")
def model_by_version(v):
    return lineage.model_by_version(v.v_model_registry).drop("seq")


SCORES = """model_scores AS (SELECT model, avg((prediction - label) * (prediction - label)) mse, avg(abs(prediction - label)) mae,
  1 - sum((prediction - label) * (prediction - label)) / (var_pop(label) * count(*)) r2 FROM v_scored GROUP BY 1)"""
CLASSES = """classes AS (SELECT model, count(*) FILTER (label >= 3 AND prediction >= 3) / 1.0 tp,
  count(*) FILTER (label < 3 AND prediction >= 3) fp, count(*) FILTER (label >= 3 AND prediction < 3) fn,
  count(*) FILTER ((label >= 3) = (prediction >= 3)) / 1.0 ok, count(*) n FROM v_scored GROUP BY 1)"""


@query(
    "regression_metrics",
    "SELECT model, round(mse, 6) mse, round(sqrt(mse), 6) rmse, round(mae, 6) mae, round(r2, 6) r2 FROM model_scores",
    SCORES,
)
def regression_metrics(v):
    return metrics.regression_metrics(v.v_scored, "model")


@query(
    "classification_metrics",
    """SELECT model, round(CAST(tp / (tp + fp) AS DOUBLE), 6) AS precision, round(CAST(tp / (tp + fn) AS DOUBLE), 6) recall,
       round(CAST(2 * tp / (2 * tp + fp + fn) AS DOUBLE), 6) f1, round(CAST(ok / n AS DOUBLE), 6) accuracy FROM classes""",
    CLASSES,
)
def classification_metrics(v):
    return metrics.classification_metrics(v.v_scored, "model")


@query("model_compare", "SELECT model, round(CAST(ok / n AS DOUBLE), 6) accuracy FROM classes", CLASSES)
def model_compare(v):
    return metrics.model_compare(v.v_scored)


@query(
    "promote_decision",
    """SELECT round(c, 6) candidate, round(a, 6) v1, round(b, 6) v2, CASE WHEN b IS NULL OR c < b - 1e-6 THEN 'promote_v2'
       WHEN a IS NULL OR c < a - 1e-6 THEN 'promote_v1' ELSE 'reject' END decision FROM
       (SELECT sqrt(max(mse) FILTER (model = 'candidate')) c, sqrt(max(mse) FILTER (model = 'v1')) a,
        sqrt(max(mse) FILTER (model = 'v2')) b FROM model_scores)""",
    SCORES,
)
def promote_decision(v):
    return rollout.promotion(metrics.regression_metrics(v.v_scored, "model"))


@query(
    "stage_pointers",
    """SELECT stage, model_version FROM (
         SELECT 'v1' stage, 'old-v2' model_version, d.decision = 'promote_v2' AS held FROM decided_model d
         UNION ALL SELECT CASE d.decision WHEN 'promote_v2' THEN 'v2' ELSE 'v1' END, 'candidate', d.decision <> 'reject' FROM decided_model d)
       WHERE held""",
    SCORES,
    """decided_model AS (SELECT CASE WHEN b IS NULL OR c < b - 1e-6 THEN 'promote_v2' WHEN a IS NULL OR c < a - 1e-6 THEN 'promote_v1'
       ELSE 'reject' END decision FROM (SELECT sqrt(max(mse) FILTER (model = 'candidate')) c, sqrt(max(mse) FILTER (model = 'v1')) a,
        sqrt(max(mse) FILTER (model = 'v2')) b FROM model_scores))""",
)
def stage_pointers(v):
    """The rows a promotion appends to the stage table, read back from it."""
    decision = rollout.promotion(metrics.regression_metrics(v.v_scored, "model"))
    stages = v.spark.createDataFrame([("v1", "old-v1"), ("v2", "old-v2")], "stage STRING, model_version STRING")
    path = scratch_path(v.spark, "stages")
    sinks.append_table(rollout.stage_pointers(stages, decision, "candidate", F.current_timestamp()), path)
    return v.spark.read.schema("stage STRING, model_version STRING").parquet(path)
