import hashlib
import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.operators.ingest import latest_ratings, watch_aggregate
from marquee.functions import parsing
from marquee.operators import models, online, retrain
from marquee.sources import files, registry, sinks, streams
from marquee.streaming import attribution, counters, ingest

START = datetime(2024, 1, 1)


def test_optional_source(spark, tmp_path):
    absent = files.optional_table(spark, str(tmp_path / "none"), schemas.USERS)
    assert absent.count() == 0 and absent.columns == ["user_id", "age", "occupation", "gender"]


def test_csv_scan_tolerates_bad_fields(spark, tmp_path, rows):
    (tmp_path / "u.csv").write_text("user_id,age,occupation,gender\n1,25,student,M\n2,old,,F\n")
    assert rows(files.csv_table(spark, str(tmp_path / "u.csv"), schemas.USERS)) == [(1, 25, "student", "M"), (2, None, None, "F")]


def test_movie_folder(spark, tmp_path, rows):
    with pytest.raises(ValueError):
        files.movie_documents(spark, str(tmp_path / "absent"))
    folder = tmp_path / "movies"
    folder.mkdir()
    with pytest.raises(ValueError):
        files.movie_documents(spark, str(folder))
    for name in ("a", "b"):
        (folder / f"{name}.json").write_text(json.dumps({"id": name, "title": name.upper()}, indent=1))
    assert rows(files.movie_documents(spark, str(folder)).select("id", "title")) == [("a", "A"), ("b", "B")]


def test_telemetry_document_with_absent_arrays(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(
        json.dumps(
            {
                "recommendations": [
                    {"timestamp": "2025-10-23T20:50:10.251030", "user_id": "u1", "items": ["m1", "m2"]},
                    {"timestamp": "2025-10-23T20:50:11", "user_id": "u2", "items": []},
                ],
                "response_times": [0.4, 0.6],
                "recommendation_quality": [{"timestamp": "bad", "user_id": "u1", "rating": 4.0}],
            },
            indent=2,
        )
    )
    tables = files.telemetry_document(spark, str(path))
    served = {r["user_id"]: r for r in tables["recommendations"].collect()}
    assert served["u1"]["response_time"] == 0.4 and served["u2"]["response_time"] == 0.6
    assert served["u1"]["timestamp"] == datetime(2025, 10, 23, 20, 50, 10, 251030)
    assert tables["interactions"].count() == 0 and tables["errors"].count() == 0
    assert tables["quality"].first()["rating"] == 4.0


def test_telemetry_append_partitions_by_day(spark, tmp_path):
    errors = spark.createDataFrame([(START, "x", "m"), (START + timedelta(days=1), "y", "n")], schemas.ERROR)
    for _ in range(2):
        path = sinks.append_telemetry(errors, str(tmp_path), "errors")
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.select("day").distinct().count() == 2


def test_report_formats(spark, tmp_path):
    report = spark.createDataFrame([(1, 0.5)], "n INT, rmse DOUBLE")
    sinks.write_report(report, str(tmp_path / "r.json"))
    sinks.write_report(report, str(tmp_path / "r.csv"))
    assert spark.read.json(str(tmp_path / "r.json")).first()["rmse"] == 0.5
    with pytest.raises(ValueError):
        sinks.write_report(report, str(tmp_path / "r.xml"))


def test_registry_checks_and_defaults(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(ValueError):
        registry.append_registry(spark.createDataFrame([("d",)], "training_data_id STRING"), folder, "models")
    with pytest.raises(Exception, match="artifact_path"):
        bad = spark.createDataFrame([("d", None)], "training_data_id STRING, artifact_path STRING")
        registry.append_registry(bad, folder, "models")
    evaluation = spark.createDataFrame(
        [("v1", "offline", "p", "m", "e", 0.42, 0.38, 0.89)],
        "model_version STRING, eval_type STRING, preproc_path STRING, model_path STRING, eval_data_path STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE",
    )
    row = spark.read.parquet(registry.append_registry(evaluation, folder, "evaluations")).first()
    assert row["eval_id"].startswith("eval_") and row["rmse"] == 0.42
    served = spark.createDataFrame([("7", "v1", "a", 3, None)], "userid STRING, model_version STRING, prediction STRING, age INT, gender STRING")
    event = spark.read.parquet(registry.append_registry(served, folder, "predictions", inputs=["age", "gender"])).first()
    assert event["input_missing_count"] == 1 and len(event["input_hash"]) == 64 and event["request_id"]


def test_register_candidate(spark, tmp_path):
    data = spark.createDataFrame([("raw", "training.parquet")], "data_source STRING, file_path STRING")
    scores = spark.createDataFrame([(0.5,)], "rmse DOUBLE")
    row = registry.register_candidate(spark, str(tmp_path), data, scores, "models/candidate").first()
    stored = spark.read.parquet(f"{tmp_path}/data").first()
    assert row["training_data_id"] == stored["data_id"] and stored["data_id"].startswith("data_")
    assert row["model_version"].startswith("v") and json.loads(row["metrics_json"]) == {"rmse": 0.5}


def test_file_fingerprint(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"abc")
    digest = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert files.file_fingerprints(spark, str(tmp_path / "f")).first()["file_hash"] == digest
    assert files.file_fingerprints(spark, str(tmp_path / "none")).first()["file_hash"] == "unknown"


def test_large_files_are_hashed_as_streams(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LARGE_FILE", 1000)
    contents = {"small": b"x" * 1000, "large": bytes(range(256)) * 50, "larger é %41#b?": b"y" * 100_000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = {r["path"].rsplit("/", 1)[1]: r["file_hash"] for r in files.file_fingerprints(spark, str(tmp_path)).collect()}
    assert found == {name: hashlib.sha256(content).hexdigest() for name, content in contents.items()}


@pytest.mark.parametrize("openssl", [True, False])
def test_no_task_reads_a_long_file_whole(spark, tmp_path, monkeypatch, openssl):
    """A hash goes on where the task before left it; empty rests and equal lengths too."""
    monkeypatch.setattr(files, "LARGE_FILE", 1000)
    monkeypatch.setattr(files, "STRETCH", 1003)
    if not openssl:
        monkeypatch.setattr(files, "_sha256", lambda: None)
    elif files._sha256() is None:
        pytest.skip("no OpenSSL here")
    contents = {f"f{n}": random.Random(n).randbytes(n) for n in (1001, 1003, 1004, 2006, 5000, 5015)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    rounds, write = [], files.materialise
    monkeypatch.setattr(files, "materialise", lambda df, name: (rounds.append(name), write(df, name))[1])
    found = {r["path"].rsplit("/", 1)[1]: r["file_hash"] for r in files.file_fingerprints(spark, str(tmp_path)).collect()}
    assert found == {name: hashlib.sha256(content).hexdigest() for name, content in contents.items()}
    assert len(rounds) == 5


def test_hash_of_three_gigabytes(spark, tmp_path):
    with (tmp_path / "zeros").open("wb") as file:
        file.truncate(3 << 30)  # takes no room on disk
    digest = hashlib.sha256()
    for _ in range(3 << 10):
        digest.update(bytes(1 << 20))
    assert files.file_fingerprints(spark, str(tmp_path / "zeros")).first()["file_hash"] == digest.hexdigest()


def test_retraining_goes_on_where_it_stopped(spark, tmp_path):
    stats = spark.createDataFrame([(500, 40, 900, 80)], "users BIGINT, movies BIGINT, interactions BIGINT, ratings BIGINT")
    states = spark.createDataFrame([], schemas.RETRAIN_STATE)
    incumbents = spark.createDataFrame([("v1", 0.9), ("v2", 0.8)], "model STRING, rmse DOUBLE")
    stages = spark.createDataFrame([("v1", "a"), ("v2", "b")], "stage STRING, model_version STRING")
    calls = []

    def train():
        calls.append("train")
        return "models/new"

    def broken(path):
        raise RuntimeError("lost")

    def evaluate(path):
        calls.append(path)
        return spark.createDataFrame([(0.7,)], "rmse DOUBLE")

    with pytest.raises(RuntimeError):
        retrain.retrain_run(str(tmp_path / "run"), stats, states, train, broken, incumbents, stages)
    for _ in range(2):
        done = retrain.retrain_run(str(tmp_path / "run"), stats, states, train, evaluate, incumbents, stages)
    assert calls == ["train", "models/new"] and done["decision"].first()["decision"] == "promote_v2"
    assert sorted((r["stage"], r["model_version"]) for r in done["stages"].collect()) == [("v1", "b"), ("v2", "models/new")]
    idle = retrain.retrain_run(str(tmp_path / "next"), stats, done["state"], train, evaluate, incumbents, stages)
    assert list(idle) == ["gate"] and calls == ["train", "models/new"]


def test_watch_stream_reads_only_its_own_batch(spark, tmp_path, rows):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    failed = spark.createDataFrame([], "movie_id STRING")
    parts = log_parts(4, 30, seed=5)
    for n, part in enumerate(parts):
        write_part(spark, source, n, part)
        ingest.collect_watch_pairs(line_stream(spark, source), out, mark, failed)
        if n == 1:  # what is stored is not read again: without it the stream still knows its pairs
            known = rows(ingest.watch_table(spark, out))
            Path(out).rename(tmp_path / "moved")
    later = {r[:2] for r in rows(ingest.watch_table(spark, out))}
    assert not later & {r[:2] for r in known} and later


def test_latest_params(spark):
    empty = spark.createDataFrame([], schemas.TUNING_RESULTS)
    assert models.latest_params(empty) == models.DEFAULT_PARAMS
    runs = [
        (START, {"model__max_depth": 2.0}, 0.7, 1.0, 2, 10),
        (START + timedelta(days=1), {"model__max_depth": 5.0}, 0.6, 1.0, 2, 10),
    ]
    assert models.latest_params(spark.createDataFrame(runs, schemas.TUNING_RESULTS))["max_depth"] == 5.0


def log_parts(n_parts, n_lines, seed=1):
    rng = random.Random(seed)
    lines = []
    for i in range(n_parts * n_lines):
        user, movie = rng.randrange(6), rng.randrange(5)
        if rng.random() < 0.5:
            lines.append(f"{i:06d},u{user},GET /data/m/m{movie}/{rng.randrange(9)}.mpg")
        else:
            lines.append(f"{i:06d},u{user},GET /rate/m{movie}={rng.randrange(1, 6)}")
    return [lines[p * n_lines : (p + 1) * n_lines] for p in range(n_parts)]


def write_part(spark, folder, number, lines):
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.parquet(f"{folder}/part{number}")


def line_stream(spark, folder):
    return streams.parquet_stream(spark, f"{folder}/part*", "value STRING", files_per_batch=1)


def test_streamed_ratings_equal_batch_after_restart_and_compaction(spark, tmp_path, rows):
    parts = log_parts(3, 40)
    source, out, snaps, mark = (str(tmp_path / n) for n in ("in", "out", "snaps", "mark"))

    def batch(n):
        text = [x for p in parts[:n] for x in p]
        events = parsing.rating_events(spark.createDataFrame([(x,) for x in text], "value STRING"))
        return rows(latest_ratings(events, ["timestamp", "rating"]))

    def stream():
        ingest.collect_ratings(line_stream(spark, source), out, mark)
        return rows(ingest.current_ratings(spark, out, snaps).drop("batch"))

    write_part(spark, source, 0, parts[0])
    write_part(spark, source, 1, parts[1])
    assert stream() == batch(2)
    ingest.compact_ratings(spark, out, snaps)
    assert stream() == batch(2)
    write_part(spark, source, 2, parts[2])
    assert stream() == batch(3)
    ingest.compact_ratings(spark, out, snaps)
    assert rows(ingest.current_ratings(spark, out, snaps).drop("batch")) == batch(3)


def test_streamed_watch_pairs_are_written_once(spark, tmp_path, rows):
    parts = log_parts(2, 40, seed=2)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    failed = spark.createDataFrame([("m4",)], "movie_id STRING")
    for n, part in enumerate(parts):
        write_part(spark, source, n, part)
        ingest.collect_watch_pairs(line_stream(spark, source), out, mark, failed)
    got = ingest.watch_table(spark, out)
    assert got.count() == got.select("user_id", "movie_id").distinct().count()
    assert got.filter("movie_id = 'm4'").count() == 0
    per_part = [rows(watch_aggregate(parsing.watch_events(spark.createDataFrame([(x,) for x in p], "value STRING")))) for p in parts]
    known = {r[:2] for r in per_part[0]}
    expected = [r for r in per_part[0] + [r for r in per_part[1] if r[:2] not in known] if r[1] != "m4"]
    assert rows(got) == sorted(expected, key=repr)


SERVED = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, items ARRAY<STRING>, model_version STRING, item_id STRING"


def served_events(n, seed=4, step=20):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        at = START + timedelta(seconds=i * step)
        user = 1 if rng.random() < 0.4 else rng.randrange(8)
        if rng.random() < 0.4:
            data.append((i, at, user, [str(rng.randrange(6)) for _ in range(2)], rng.choice(["v1", "v2"]), None))
        else:
            data.append((i, at, user, None, None, str(rng.randrange(6))))
    return data


def attribute_in_runs(spark, folder, batches, **options):
    """Each batch comes in a run of its own, which goes on from the checkpoint."""
    source, out, mark = (f"{folder}/{n}" for n in ("in", "out", "mark"))
    for p, data in enumerate(batches):
        spark.createDataFrame(data, SERVED).coalesce(1).write.parquet(f"{source}/part{p}")
        events = streams.parquet_stream(spark, f"{source}/part*", SERVED, files_per_batch=1)
        attribution.attribute_clicks(events, out, mark, **options)
    return attribution.attributed(spark, out), spark.read.parquet(out)


def batch_answers(spark, data):
    whole = spark.createDataFrame(data, SERVED)
    return online.click_attribution(whole.filter("items IS NOT NULL"), whole.filter("item_id IS NOT NULL"))


def test_streamed_attribution_equals_batch(spark, tmp_path, rows):
    data = served_events(300)
    got, _ = attribute_in_runs(spark, tmp_path, [data[p * 100 : (p + 1) * 100] for p in range(3)])
    assert rows(got) == rows(batch_answers(spark, data))


def test_late_lists_and_late_clicks(spark, tmp_path, rows):
    data = served_events(240, seed=9)
    rng = random.Random(1)
    late = {r[0] for r in data if rng.random() < 0.3}  # lists and clicks alike come up to two batches after their time
    batches = [[] for _ in range(6)]
    for r in data:
        batches[r[0] // 60 + (rng.choice((1, 2)) if r[0] in late else 0)].append(r)
    got, answers = attribute_in_runs(spark, tmp_path, [b for b in batches if b])
    assert rows(got) == rows(batch_answers(spark, data))
    assert answers.count() > got.count()  # some answers were corrected


def test_served_state_expires(spark, tmp_path):
    late = START + timedelta(days=3)
    batches = [
        [(1, START, 1, ["a"], "v1", None)],
        [(2, late, 2, ["b"], "v2", None)],
        [(3, late, 1, None, None, "a"), (4, late + timedelta(seconds=1), 2, None, None, "b")],
        [(5, late + timedelta(hours=3), 2, None, None, "x")],
        [(6, late + timedelta(days=9), 3, ["c"], "v1", None)],
        [(7, late + timedelta(days=9), 3, None, None, "c")],
    ]
    answers, _ = attribute_in_runs(spark, tmp_path, batches)
    got = {r["event_id"]: (r["model_version"], r["matched"]) for r in answers.collect()}
    assert got == {3: ("unknown", False), 4: ("v2", True), 5: ("v2", False), 7: ("v1", True)}
    state = spark.read.format("statestore").option("stateVarName", "served").load(f"{tmp_path}/mark")
    assert [r["key"]["user_id"] for r in state.collect()] == [3]  # timers have ended the others


HEALTH = "ts TIMESTAMP, kind STRING, user_id BIGINT, items ARRAY<STRING>, response_time DOUBLE, rating INT, predicted DOUBLE"


def test_streamed_health_over_several_batches(spark, tmp_path):
    source, out, totals = (str(tmp_path / n) for n in ("in", "out", "totals"))
    data = [
        (START + timedelta(minutes=25 * i), "served" if i % 3 else "error", i % 2, ["a", f"i{i}"] if i % 3 else None, 0.2 if i % 3 else None, None, None)
        for i in range(12)
    ]
    data += [(START, "rating", 1, None, None, 4, 3.0)]
    for p in range(2):  # the second part is hours late for its windows
        spark.createDataFrame(data[p::2], HEALTH).coalesce(1).write.parquet(f"{source}/part{p}")
    stream = lambda: streams.parquet_stream(spark, f"{source}/part*", HEALTH, files_per_batch=1)
    counters.hourly_health(stream(), out, str(tmp_path / "mark1"))
    last = counters.sliding_health(spark, out, 24).orderBy(F.desc("window_end_hour")).first()
    assert (last["num_recommendations"], last["num_errors"]) == (8, 4) and last["avg_response_time"] == pytest.approx(0.2)
    assert (last["user_coverage"], last["item_coverage"], last["p95_sketched"]) == (2, 9, 0.2)
    counters.compact_hours(spark, out, str(tmp_path / "compact"))
    again = counters.sliding_health(spark, str(tmp_path / "compact"), 24).orderBy(F.desc("window_end_hour")).first()
    assert again == last
    counters.running_counters(stream(), totals, str(tmp_path / "mark2"))
    assert tuple(counters.latest_totals(spark, totals).first()) == (8, 4, 1, 1.0, 1.0)


def test_late_events_join_their_hour(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    for p, at in enumerate((START + timedelta(days=40), START)):  # forty days late
        spark.createDataFrame([(at, "served", p, ["a"], 1.0, None, None)], HEALTH).coalesce(1).write.parquet(f"{source}/part{p}")
        counters.hourly_health(streams.parquet_stream(spark, f"{source}/part*", HEALTH, files_per_batch=1), out, mark)
    assert counters.sliding_health(spark, out).agg(F.sum("num_recommendations")).first()[0] == 2


def test_collected_lines(spark, tmp_path, rows):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(b"hi",), (b"\xff",), (b"",)], "value BINARY").coalesce(1).write.parquet(f"{source}/part0")
    messages = streams.parquet_stream(spark, f"{source}/part*", "value BINARY")
    for _ in range(2):
        ingest.collect_lines(messages, out, str(tmp_path / "mark"))
    assert rows(spark.read.parquet(out)) == [("hi",)]
