"""Online analytics: click-through, attribution, group ratings, windowed health metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalars import in_share, number, ratio
from marquee.operators.asof import attach_latest
from marquee.operators.quantiles import exact_quantiles
from marquee.operators.summary import report_row
from marquee.session import materialise

CTR_THRESHOLD = 0.10
CANARY_CTR_RATIO = 0.70
GROUP_RATIO = 0.85


def ctr(served: DataFrame, interactions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Items shown, hits and click-through rate, overall or per ``by`` column.

    An interaction is a hit if its (user, item) was ever shown, and counts as often
    as it happened. Interactions and lists are both reduced to one row per key
    before they meet, so a hot user or item never multiplies rows in the join.
    ``by`` columns the interactions also carry (a day, say) must match too.
    """
    by = list(by)
    shared = [c for c in by if c in interactions.columns]
    shown = served.groupBy(*by).agg(F.coalesce(F.sum(F.size("items")), F.lit(0)).cast("bigint").alias("shown"))
    lists = served.select(*by, "user_id", F.explode("items").alias("item_id")).distinct()
    clicked = interactions.groupBy("user_id", "item_id", *shared).agg(F.count(F.lit(1)).alias("n"))
    hits = lists.join(clicked, ["user_id", "item_id", *shared]).groupBy(*by).agg(F.sum("n").alias("hits"))
    if by:
        joined = shown.join(hits, by, "left").withColumn("hits", F.coalesce("hits", F.lit(0)).cast("bigint"))
    else:
        joined = report_row(served.sparkSession, shown, hits.select(F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits")))
    rate = F.when(F.col("shown") > 0, ratio(F.col("hits"), F.col("shown"))).otherwise(0.0)
    return joined.withColumn("ctr", rate)


def group_rating(quality: DataFrame, users: DataFrame, value: str = "rating", count: str | None = None) -> DataFrame:
    """Mean value for each gender and the ratio female to male; ``count`` names a column for the number of rows.

    Sums are taken per user first; the join then sees one row per user.
    """
    rated = quality.select("user_id", number(F.col(value)).alias("v"))
    per_user = rated.groupBy("user_id").agg(F.sum("v").alias("total"), F.count("v").alias("n"), F.count(F.lit(1)).alias("rows"))
    gender = F.coalesce("gender", F.lit("unknown"))

    def mean(code: str) -> Column:
        return F.try_divide(F.sum(F.when(gender == code, F.col("total"))), F.sum(F.when(gender == code, F.col("n"))))

    sizes = [F.coalesce(F.sum("rows"), F.lit(0)).alias(count)] if count else []
    return (
        per_user.join(users.select("user_id", "gender"), "user_id", "left")
        .agg(mean("M").alias("rating_m"), mean("F").alias("rating_f"), *sizes)
        .withColumn("ratio", F.when(F.col("rating_m") > 0, F.try_divide("rating_f", "rating_m")))
    )


def issue_flags(
    ctr_all: Column,
    ctr_stable: Column,
    ctr_canary: Column,
    group_ratio: Column,
    ctr_threshold: float = CTR_THRESHOLD,
    canary_ratio: float = CANARY_CTR_RATIO,
    group_threshold: float = GROUP_RATIO,
) -> Column:
    """Names of the detected issues joined by '+', NULL when there is none."""
    flags = [
        F.when(ctr_all < ctr_threshold, "feedback_low_ctr"),
        F.when(ctr_canary < ctr_threshold, "canary_low_ctr_abs"),
        F.when((ctr_stable > 0) & (ctr_canary < canary_ratio * ctr_stable), "canary_low_ctr_rel"),
        F.when(group_ratio < group_threshold, "fairness_gender"),
    ]
    return F.nullif(F.concat_ws("+", *flags), F.lit(""))


def detection(served: DataFrame, interactions: DataFrame, quality: DataFrame, users: DataFrame, **thresholds) -> DataFrame:
    """One row with every figure the rollout decision needs, and the issue found.

    Every input is read once: lists and interactions are reduced to one row per (user, item) and met
    there, and all rates are conditional sums over these rows.
    """
    models = ("v1", "v2")
    item = F.posexplode_outer("items").alias("_place", "item_id")
    listed = served.select("user_id", "model_version", item)
    first = F.coalesce("_place", F.lit(0)) == 0  # one row per list, an empty or missing one too
    shown = listed.groupBy("user_id", "item_id").agg(
        F.count("_place").alias("shown"),
        F.count_if(first).alias("lists"),
        *[F.count_if((F.col("model_version") == m) & F.col("_place").isNotNull()).alias(f"shown_{m}") for m in models],
    )
    clicked = interactions.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    met = shown.join(clicked, ["user_id", "item_id"], "full")

    def rate(column: str) -> Column:
        hits = F.sum(F.when(F.col(column) > 0, F.col("n")))
        return ratio(F.coalesce(hits, F.lit(0)), F.sum(column))

    figures = met.agg(
        F.when(F.sum("shown") > 0, rate("shown")).otherwise(0.0).alias("ctr"),
        *[F.when(F.sum(f"shown_{m}") > 0, rate(f"shown_{m}")).alias(f"ctr_{m}") for m in models],
        F.coalesce(F.sum("lists"), F.lit(0)).alias("n_rec_events"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_interaction_events"),
    )
    row = report_row(served.sparkSession, figures, group_rating(quality, users, count="n_quality_events"))
    flags = issue_flags(F.col("ctr"), F.col("ctr_v1"), F.col("ctr_v2"), F.col("ratio"), **thresholds)
    return row.withColumn("issue", flags)


def click_attribution(served: DataFrame, clicks: DataFrame) -> DataFrame:
    """Each click with the list last served to its user, and whether that list held the item."""
    history = served.select("user_id", "ts", "event_id", "items", "model_version")
    matched = attach_latest(clicks.select("user_id", "ts", "event_id", "item_id"), history, "user_id", "ts", "event_id")
    return matched.select(
        "event_id",
        F.col("latest.event_id").alias("served_event"),
        F.coalesce("latest.model_version", F.lit("unknown")).alias("model_version"),
        F.coalesce(F.array_contains("latest.items", F.col("item_id")), F.lit(False)).alias("matched"),
    )


def rating_attribution(served: DataFrame, ratings: DataFrame) -> DataFrame:
    """Each rating event with the model that last served its user."""
    history = served.select("user_id", "ts", "event_id", "model_version")
    matched = attach_latest(ratings.select("user_id", "ts", "event_id"), history, "user_id", "ts", "event_id")
    return matched.select("event_id", F.coalesce("latest.model_version", F.lit("unknown")).alias("model_version"))


def latest_list(served: DataFrame) -> DataFrame:
    return served.groupBy("user_id").agg(F.max_by("items", F.struct("ts", "event_id")).alias("list"))


def first_list(served: DataFrame) -> DataFrame:
    return served.groupBy("user_id").agg(F.min_by("items", F.struct("ts", "event_id")).alias("list"))


def hits_against(lists: DataFrame, interactions: DataFrame) -> DataFrame:
    """Every interaction with 1.0 when its user's list holds the item, else 0.0."""
    hit = F.coalesce(F.array_contains("list", F.col("item_id")), F.lit(False)).cast("double")
    return interactions.join(lists, "user_id", "left").withColumn("hit", hit).drop("list")


def online_metrics(
    served: DataFrame, interactions: DataFrame, errors: DataFrame, as_of: Column, hours: int | Sequence[int] = 24
) -> DataFrame:
    """Health metrics over the last ``hours`` before ``as_of``; one row for each number of hours.

    Every input is read once, for all spans together: a row counts in each span it lies in. Lists are
    reduced to one row per user and interactions to one per (user, item) before they meet.
    """
    spans = sorted({int(hours)} if isinstance(hours, int) else {int(h) for h in hours})
    spark = served.sparkSession

    def inside(df: DataFrame, *columns: str) -> DataFrame:
        recent = df.filter(F.col("ts") > as_of - F.expr(f"INTERVAL {spans[-1]} HOURS"))
        age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
        aged = recent.select(age.alias("_age"), *columns)
        held = F.filter(F.array(*[F.lit(h) for h in spans]), lambda h: F.col("_age") < h.cast("bigint") * 3_600_000_000)
        return aged.select(F.explode(held).alias("hours"), *columns)

    lists = materialise(inside(served, "ts", "event_id", "user_id", "items", "response_time"), "served")
    users = lists.groupBy("hours", "user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("response_time").alias("time"),
        F.count("response_time").alias("timed"),
        F.min_by("items", F.struct("ts", "event_id")).alias("list"),
    )
    clicked = inside(interactions, "user_id", "item_id").groupBy("hours", "user_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
    hit = F.coalesce(F.array_contains("list", F.col("item_id")), F.lit(False))
    hits = clicked.join(users.select("hours", "user_id", "list"), ["hours", "user_id"], "left").groupBy("hours").agg(
        F.sum("n").alias("num_interactions"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("_hits")
    )
    counts = users.groupBy("hours").agg(
        F.sum("n").alias("num_recommendations"),
        F.try_divide(F.sum("time"), F.sum("timed")).alias("avg_response_time"),
        F.count("user_id").alias("user_coverage"),
    )
    items = lists.select("hours", F.explode("items").alias("item")).distinct().groupBy("hours").agg(F.count("item").alias("item_coverage"))
    failed = inside(errors).groupBy("hours").agg(F.count(F.lit(1)).alias("_errors"))
    p95 = exact_quantiles(lists, "response_time", [0.95], by="hours").select("hours", F.col("quantile").alias("p95_response_time"))

    row = spark.createDataFrame([(h,) for h in spans], "hours INT")
    for part in (counts, hits, items, failed, p95):  # one row for each span
        row = row.join(F.broadcast(part), "hours", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    none = lambda column, name: F.coalesce(column, F.lit(0.0)).alias(name)
    return row.select(
        "hours",
        zero("num_recommendations"),
        zero("num_interactions"),
        none(F.col("avg_response_time"), "avg_response_time"),
        none(F.col("p95_response_time"), "p95_response_time"),
        none(ratio(F.coalesce("_errors", F.lit(0)), F.col("num_recommendations")), "error_rate"),
        none(ratio(F.col("_hits"), F.col("num_interactions")), "hit_rate"),
        zero("user_coverage"),
        zero("item_coverage"),
    )


def online_error(quality: DataFrame) -> DataFrame:
    """Count, MAE and RMSE of predictions against ratings."""
    error = F.col("rating") - F.col("predicted")
    return quality.agg(
        F.count(error).alias("n"),
        F.try_divide(F.sum(F.abs(error)), F.count(error)).alias("mae"),
        F.sqrt(F.try_divide(F.sum(error * error), F.count(error))).alias("rmse"),
    )


def canary_assign(requests: DataFrame, percent: float, key: str, has_canary: bool = True, seed: int = 42) -> DataFrame:
    """Model of every request: a sticky share of the keys goes to v2."""
    to_canary = in_share(percent / 100, F.col(key), seed=seed) & F.lit(has_canary)
    return requests.withColumn("model", F.when(to_canary, "v2").otherwise("v1"))


def traffic_split(served: DataFrame, n_errors: Column, target_pct: float, tolerance: float = 15.0) -> DataFrame:
    """Requests and share per model, and whether the split is as intended."""
    counts = served.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(
        F.struct(F.sum("n").alias("n"), F.sum(F.when(F.col("model_version") == "v2", F.col("n"))).alias("v2")).alias("t")
    ).scalar()
    canary = F.coalesce(total["v2"], F.lit(0))
    near = F.abs(100 * ratio(canary, total["n"]) - target_pct) <= tolerance
    seen = (canary > 0) & near if target_pct > 0 else canary == 0
    few_errors = ratio(n_errors, total["n"] + n_errors) < 0.1
    return counts.select("model_version", "n", ratio(F.col("n"), total["n"]).alias("share"), (seen & few_errors).alias("pass"))
