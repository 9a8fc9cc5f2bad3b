"""Adapter views: the logical tables of the domain on top of the supplied tables.

Each view is written once as SQL that Spark and DuckDB both run; the few places
where the dialects differ are placeholders.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.files import table

TABLES = ["customer", "events", "lineitem", "nation", "orders", "part", "supplier", "embeddings"]

DIALECT = {
    "spark": {
        "str": "STRING",
        "ts": "CAST(ts AS TIMESTAMP)",
        "item": "get_json_object(props, '$.k')",
        "open": "array(",
        "close": ")",
    },
    "duckdb": {
        "str": "VARCHAR",
        "ts": "ts",
        "item": "json_extract_string(props, '$.k')",
        "open": "[",
        "close": "]",
    },
}

VIEWS = {
    "v_event": "SELECT event_id, <ts> ts, user_id, event_type, value, CAST(<item> AS INT) item FROM {events}",
    "v_log": """SELECT concat(lpad(CAST(event_id AS <str>), 12, '0'), ',', CAST(user_id AS <str>), ',',
        CASE event_type
          WHEN 'view' THEN concat('GET /data/m/m', CAST(item AS <str>), '/', CAST(CAST(floor(value) AS INT) AS <str>), '.mpg')
          WHEN 'purchase' THEN concat('GET /rate/m', CAST(item AS <str>), '=', CAST(1 + CAST(floor(value) AS INT) % 5 AS <str>))
          WHEN 'error' THEN 'garbage'
          ELSE concat('GET /', event_type) END) AS value
        FROM {v_event}""",
    "v_watch": """SELECT event_id, ts, user_id, item movie_id, CAST(floor(value) AS INT) minute_no
        FROM {v_event} WHERE event_type = 'view'""",
    "v_rating": """SELECT event_id, ts, user_id, item movie_id, 1 + CAST(floor(value) AS INT) % 5 rating
        FROM {v_event} WHERE event_type = 'purchase'""",
    "v_rating_big": """SELECT o_custkey user_id, l_partkey movie_id, 1 + CAST(l_quantity AS INT) % 5 rating, o_orderdate ts,
        l_orderkey, l_linenumber FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "v_users": """SELECT c_custkey user_id, CASE WHEN c_custkey % 11 <> 0 THEN CAST(floor(c_acctbal / 100) AS INT) END age,
        CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END occupation,
        CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END gender
        FROM {customer}""",
    "v_movies": """SELECT p_partkey movie_id, p_name title, replace(p_name, ' ', ',') genres,
        lower(substr(p_type, 1, 2)) original_language,
        CASE p_size % 4 WHEN 0 THEN 'English,Français' WHEN 1 THEN 'Deutsch' WHEN 2 THEN 'Español;English' END spoken_languages,
        CASE p_partkey % 4 WHEN 0 THEN 'US,CA' WHEN 1 THEN 'FR' WHEN 2 THEN 'US' END production_countries,
        CASE WHEN p_partkey % 19 = 0 THEN 'unknown' ELSE concat(CAST(1950 + p_partkey % 75 AS <str>), '-06-15') END release_date,
        CASE WHEN p_partkey % 13 <> 0 THEN p_size * 15 END runtime, p_retailprice popularity,
        1 + p_size % 10 vote_average, p_size - 10 vote_count
        FROM {part}""",
    "v_movie_json": """SELECT p_partkey, concat('{{"id":"m/', CAST(p_partkey AS <str>), '","title":"', p_name, '","runtime":',
        CAST(p_size AS <str>), ',"genres":[{{"name":"', split_part(p_name, ' ', 1), '"}},{{"name":"',
        split_part(p_name, ' ', 2), '"}}]}}') value FROM {part}""",
    "v_failed": "SELECT p_partkey movie_id FROM {part} WHERE p_partkey % 23 = 0",
    "v_holdout": "SELECT c_custkey user_id FROM {customer} WHERE c_custkey % 10 = 0",
    "v_existing_pairs": "SELECT DISTINCT user_id, movie_id FROM {v_watch} WHERE event_id % 2 = 0",
    "v_recs": """SELECT event_id, ts, user_id, <open>item, (item + 7) % 100, (item + 13) % 100<close> items,
        CASE WHEN event_id % 10 = 0 THEN 'v2' ELSE 'v1' END model_version, value / 100 response_time
        FROM {v_event} WHERE event_type = 'view'""",
    "v_inter": "SELECT event_id, ts, user_id, item item_id FROM {v_event} WHERE event_type = 'click'",
    "v_error": "SELECT event_id, ts, user_id FROM {v_event} WHERE event_type = 'error'",
    "v_quality": """SELECT event_id, ts, user_id, 1 + CAST(floor(value) AS INT) % 5 rating,
        least(5.0, greatest(1.0, value / 20)) predicted FROM {v_event} WHERE event_type = 'purchase'""",
    "v_request": """SELECT event_id, ts, user_id, event_type path,
        CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END status, value / 100 latency
        FROM {v_event}""",
    "v_offsets": """SELECT event_type topic, max(event_id) produced, max(CASE WHEN value < 50 THEN event_id END) consumed
        FROM {v_event} GROUP BY event_type""",
    "v_data_registry": """SELECT concat('d', CAST(n_nationkey AS <str>)) data_id, n_name data_source
        FROM {nation} WHERE n_nationkey % 5 <> 0""",
    "v_model_registry": """SELECT concat('v', CAST(s_suppkey AS <str>)) model_version,
        concat('d', CAST(s_nationkey AS <str>)) training_data_id, s_name artifact_path, s_suppkey seq FROM {supplier}""",
    "v_prediction_events": """SELECT o_orderkey request_id, o_custkey userid,
        concat('v', CAST(o_custkey % 120 AS <str>)) model_version, o_totalprice prediction, o_orderkey seq FROM {orders}""",
    "v_evaluation_events": """SELECT p_partkey eval_id, concat('v', CAST(p_partkey % 120 AS <str>)) model_version,
        p_size / 10 rmse, p_partkey seq FROM {part}""",
    "v_scored": """SELECT user_id, movie_id, rating label, rating + (l_linenumber - 4) / 4 prediction,
        CASE l_orderkey % 3 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2' ELSE 'candidate' END model FROM {v_rating_big}""",
}


def view_text(name: str, engine: str) -> str:
    text = VIEWS[name]
    for mark, value in DIALECT[engine].items():
        text = text.replace(f"<{mark}>", value)
    return text


def inputs_of(name: str) -> list[str]:
    """Tables and views a view reads."""
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", VIEWS[name])


class Views:
    """The adapter views over one folder of tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str, **replaced: DataFrame):
        self.spark = spark
        self.folder = folder
        self._known = dict(replaced)

    def __getattr__(self, name: str) -> DataFrame:
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._build(name)
        return self._known[name]

    def _build(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.spark.sql(view_text(name, "spark"), **{i: self[i] for i in inputs_of(name)})
        return table(self.spark, self.folder, name)


def with_views(sql: str, *ctes: str) -> str:
    """DuckDB SQL preceded by the views it names and by further common table expressions."""
    text = " ".join([*ctes, sql])
    needed: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in needed:
            for source in inputs_of(name):
                add(source)
            needed.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            add(name)
    parts = [
        f"{name} AS ({view_text(name, 'duckdb').format(**{i: i for i in inputs_of(name)})})" for name in needed
    ]
    parts += ctes
    return f"WITH RECURSIVE {', '.join(parts)} {sql}" if parts else sql
