from __future__ import annotations

import itertools
import json
import os
import time

import pytest

from postlake.operators import annotate, summary
from postlake.plans import models, runs
from postlake.schemas import ANNOTATION_COLUMNS, TOPICS
from postlake.sources import tables
from tests.conftest import utc

SOUND = {
    "post_id": "a",
    "primary_group": "clinical",
    "primary_topic": "labor_delivery",
    "secondary_topics": [],
    "trimester": "first",
    "sentiment": "neutral",
    "urgency_0_3": 0,
    "keywords": ["a", "b", "c", "d", "e"],
    "safety_flags": [],
    "post_summary": "One. Two. Three.",
    "care_response": " ".join(["w"] * 120),
}


def parsed(spark, *responses):
    rows = [("a", r if isinstance(r, str) else json.dumps(r)) for r in responses]
    return annotate.parse_responses(spark.createDataFrame(rows, "post_id string, response string"))


@pytest.fixture
def fail_on_odd():
    def annotator(prompts):
        if any(int(p) % 2 for p in prompts):
            raise RuntimeError("odd")
        return [(json.dumps({"sentiment": p}), 1, None) for p in prompts]

    return annotator


def test_one_bad_prompt_spoils_no_other(spark, fail_on_odd):
    prompts = spark.range(100).selectExpr("concat('p', id) as post_id", "cast(id as string) as prompt")
    replies = annotate.annotate(prompts, fail_on_odd, partitions=3, batch=16).collect()
    assert len(replies) == 100
    for r in replies:
        odd = int(r.post_id[1:]) % 2
        assert (r.status, r.error) == (("failed", "RuntimeError: odd") if odd else ("ok", None))
        assert (r.input_tokens, r.output_tokens) == ((None, None) if odd else (1, None))
        assert odd or json.loads(r.response)["sentiment"] == r.post_id[1:]


def test_several_requests_in_flight(spark):
    """64 slow prompts in one task, 16 at a time; ids and order stay, some fail."""
    prompts = spark.range(64).selectExpr("concat('p', id) as post_id", "cast(id as string) as prompt")

    def slow(texts):
        time.sleep(0.1 if int(texts[0]) % 2 else 0.05)
        if texts == ["13"]:
            raise RuntimeError("unlucky")
        return [(json.dumps({"sentiment": t}), 1, 1) for t in texts]

    annotate.annotate(prompts.limit(1), slow, partitions=1).collect()  # starts the worker
    start = time.time()
    replies = annotate.annotate(prompts, slow, partitions=1, batch=1, in_flight=16).collect()
    assert time.time() - start < 3 < 64 * 0.075
    asked = [r.post_id for r in prompts.repartition(1, "post_id").collect()]
    assert [r.post_id for r in replies] == asked
    for r in replies:
        assert r.status == ("failed" if r.post_id == "p13" else "ok")
        assert r.status == "failed" or json.loads(r.response)["sentiment"] == r.post_id[1:]


def test_failed_calls_are_made_again(spark, tmp_path):
    """Each prompt fails twice; two more tries are enough, one is not."""
    prompts = spark.range(6).selectExpr("concat('p', id) as post_id", "cast(id as string) as prompt")

    def flaky(name):
        def annotator(texts):
            for t in texts:
                seen = len(list(tmp_path.glob(f"{name}-{t}-*")))
                (tmp_path / f"{name}-{t}-{seen}").touch()
                if seen < 2:
                    raise RuntimeError("busy")
            return [("{}", 1, 1) for _ in texts]

        return annotator

    def failed(name, retries):
        asked = annotate.annotate(prompts, flaky(name), 2, batch=1, in_flight=2, retries=retries, wait=0.01)
        return asked.filter("status = 'failed'").count()

    assert failed("two", 2) == 0 and failed("one", 1) == 6


def test_wrong_number_of_replies_is_a_failure(spark):
    prompts = spark.range(4).selectExpr("cast(id as string) as post_id", "'x' as prompt")
    replies = annotate.annotate(prompts, lambda batch: [], partitions=1)
    assert replies.filter("status = 'failed' and error like 'ValueError%'").count() == 4


@pytest.mark.parametrize(
    ("reply", "error"),
    [
        (("{}", 1), "three parts"),
        ("{}", "three parts"),
        (None, "three parts"),
        (("{}", 1.5, 1), "1.5 is no number"),
        (("{}", True, 1), "True is no number"),
        (("{}", 1, 1 << 31), "2147483648 is no number"),
        (("{}", -1, None), "-1 is no number"),
        (({"a": 1}, 1, 1), "the response is dict"),
    ],
)
def test_badly_typed_reply_fails_alone(spark, reply, error):
    prompts = spark.range(4).selectExpr("cast(id as string) as post_id", "cast(id as string) as prompt")
    answer = lambda batch: [reply if p == "2" else ("{}", None, 3) for p in batch]
    rows = {r.post_id: r for r in annotate.annotate(prompts, answer, partitions=1).collect()}
    assert rows["2"].status == "failed" and error in rows["2"].error
    assert all(rows[i].status == "ok" and rows[i].output_tokens == 3 for i in "013")


def test_limited_prompts_are_asked_from_several_tasks(spark):
    from pyspark import TaskContext

    prompts = spark.range(1000).selectExpr("cast(id as string) as post_id", "'x' as prompt")
    asker = lambda batch: [(str(TaskContext.get().partitionId()), 0, 0) for _ in batch]
    replies = annotate.annotate(prompts.orderBy("post_id").limit(100), asker)
    assert replies.select("response").distinct().count() >= 3


def test_replies_of_many_requests_leave_a_task_together(spark):
    """Small requests of several threads: replies in order, in few Arrow batches."""
    prompts = spark.range(700).selectExpr("concat('p', id) as post_id", "cast(id as string) as prompt")

    def answer(texts):
        return [(f"r{text}", int(text), None) for text in texts]

    replies = annotate.annotate(prompts, answer, 1, batch=2, in_flight=3)
    rows = {r.post_id: r for r in replies.collect()}
    assert len(rows) == 700
    assert all(r.response == f"r{k[1:]}" and r.input_tokens == int(k[1:]) and r.output_tokens is None for k, r in rows.items())
    assert "MapInArrow" in replies._jdf.queryExecution().toString()


def test_no_prompts(spark, fail_on_odd):
    prompts = spark.range(0).selectExpr("cast(id as string) as post_id", "'x' as prompt")
    assert annotate.annotate(prompts, fail_on_odd, partitions=2).count() == 0


def test_parse(spark):
    sound, broken, listed, quoted, extra = parsed(
        spark, SOUND, '{"post_id": "a"', "[1]", SOUND | {"urgency_0_3": "2"}, SOUND | {"new_key": 1}
    ).collect()
    assert (sound.status, sound.error, sound.keywords) == ("ok", None, ["a", "b", "c", "d", "e"])
    assert (broken.status, broken.error, broken.sentiment) == ("failed", "not a JSON object", None)
    assert listed.status == "failed"
    assert (quoted.status, quoted.urgency_0_3, quoted.sentiment) == ("ok", None, "neutral")
    assert extra.status == "ok"


@pytest.mark.parametrize(
    ("form", "sentiment"),
    [
        ("%s and more", None),
        ("so: %s", None),
        ("%s]", None),
        ("%s}", None),
        ("%s,%s", None),
        ('%s,"x":1', None),
        ("[%s]", None),
        ("```json\n%s\n```", None),
        ("  %s\n ", "neutral"),
    ],
)
def test_only_a_whole_object_is_parsed(spark, form, sentiment):
    text = form.replace("%s", json.dumps(SOUND))
    row = parsed(spark, text).first()
    assert (row.status, row.sentiment) == ("ok" if sentiment else "failed", sentiment)


def test_odd_objects(spark):
    rows = parsed(spark, "null", "3", "", "{}", "{'sentiment': 'x'}", '{"sentiment": "a", "sentiment": "b"}', '{"sentiment": 3}').collect()
    assert [r.status for r in rows] == ["failed"] * 3 + ["ok", "failed", "ok", "ok"]
    assert [r.sentiment for r in rows[5:]] == ["b", "3"]


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({}, []),
        ({"primary_group": "x"}, ["primary_group", "primary_topic"]),
        ({"primary_topic": "sleep_fatigue"}, ["primary_topic"]),
        ({"secondary_topics": ["a", "b", "c"]}, []),
        ({"secondary_topics": None}, []),
        ({"secondary_topics": ["a", "b", "c", "d"]}, ["secondary_topics"]),
        ({"trimester": "fourth"}, ["trimester"]),
        ({"sentiment": None}, ["sentiment"]),
        ({"urgency_0_3": 4}, ["urgency_0_3"]),
        ({"urgency_0_3": "2"}, ["urgency_0_3"]),
        ({"keywords": ["k"] * 4}, ["keyword_count"]),
        ({"keywords": ["k"] * 20}, []),
        ({"keywords": ["k"] * 21}, ["keyword_count"]),
        ({"keywords": ["K"] + ["k"] * 5}, ["keyword_case"]),
        ({"keywords": None}, ["keyword_count", "keyword_case"]),
        ({"safety_flags": ["urgent_pain", "other_concern"]}, []),
        ({"safety_flags": ["Urgent_Pain"]}, ["safety_flags"]),
        ({"safety_flags": None}, ["safety_flags"]),
        ({"post_summary": "1. 2. 3. 4."}, ["post_summary"]),
        ({"post_summary": None}, ["post_summary"]),
        ({"care_response": " ".join(["w"] * 119)}, ["care_response"]),
        ({"care_response": " ".join(["w"] * 220)}, []),
        ({"care_response": " ".join(["w"] * 221)}, ["care_response"]),
        ({"post_id": "b"}, ["echoed_id"]),
    ],
)
def test_contract(spark, change, broken):
    row = annotate.validate(parsed(spark, SOUND | change)).first()
    assert (row.violations, row.is_valid) == (broken, not broken)


def test_every_topic_is_valid_in_its_group_only(spark):
    pairs = [(group, topic) for group in TOPICS for topics in TOPICS.values() for topic in topics]
    answers = [SOUND | {"primary_group": g, "primary_topic": t} for g, t in pairs]
    rows = annotate.validate(parsed(spark, *answers)).collect()
    assert len(rows) == 6 * 29
    for row in rows:
        assert row.is_valid == (row.primary_topic in TOPICS[row.primary_group])


def test_summary_counts_failures(spark):
    row = summary.annotation_summary(parsed(spark, SOUND, "nope", SOUND)).first()
    assert (row.n_total, row.n_ok, row.n_failed) == (3, 2, 1)


def test_annotation_run(spark, make_raw, tmp_path):
    """Pending posts are annotated once; failures stay pending; a re-run adds nothing."""
    table = "run_annotations"
    tables.create_annotation_table(spark, table, str(tmp_path / "a"))
    raw = make_raw(
        *[{"post_id": f"p{i}", "content": f"one two three four five {i}"} for i in range(6)],
        {"post_id": "short", "content": "too short"},
        {"post_id": "bad", "content": "this one will explode for sure"},
    )

    def label(prompts):
        replies = []
        for prompt in prompts:
            if "explode" in prompt:
                raise RuntimeError("no")
            answer = SOUND | {"post_id": "wrong", "post_summary": 'He "said"\nso.'}
            replies.append((json.dumps(answer), len(prompt), 5))
        return replies

    number = itertools.count()

    def run(limit=None):
        return runs.annotate_pending(
            spark, raw, table, label, "{{POST_ID}}: {{POST_TEXT}}", "m", "1", utc(2024, 1, 1),
            str(tmp_path / f"run{next(number)}"), limit,
        )

    assert summary.annotation_summary(run(limit=2)).first().n_total == 2
    first = summary.annotation_summary(run()).first()
    assert (first.n_total, first.n_ok, first.n_failed) == (6, 5, 1)
    again = summary.annotation_summary(run()).first()
    assert (again.n_total, again.n_failed) == (1, 1)

    stored = tables.annotation_table(spark, table)
    assert stored.columns == ANNOTATION_COLUMNS
    rows = {r.post_id: r for r in stored.collect()}
    assert sorted(rows) == [f"p{i}" for i in range(6)]
    assert rows["p0"].post_summary == "He 'said' so."
    assert (rows["p0"].model_name, rows["p0"].input_tokens) == ("m", len("p0: one two three four five 0"))
    assert [r.post_id for r in models.pending(raw, stored).collect()] == ["bad"]


def test_repeated_run_asks_only_what_has_no_good_reply(spark, make_raw, tmp_path):
    """A run that stopped between its replies and the append asks nothing twice."""
    tables.create_annotation_table(spark, "first_try", str(tmp_path / "a"))
    tables.create_annotation_table(spark, "second_try", str(tmp_path / "b"))
    raw = make_raw(*[{"post_id": f"p{i}", "content": f"one two three four five {i}"} for i in range(20)])
    log, folder = tmp_path / "asked", str(tmp_path / "run")
    log.mkdir()

    def asker(bad):
        def label(prompts):
            replies = []
            for p in prompts:
                (log / f"{bad}-{p.split(':')[0]}").touch()
                summary = "x" * (2000 if bad and p.startswith("p3") else 5)
                replies.append((json.dumps(SOUND | {"post_summary": summary}), 1, 1) if not (bad and p.startswith("p1:")) else ("{}",))
            return replies

        return label

    def run(table, bad):
        return runs.annotate_pending(
            spark, raw, table, asker(bad), "{{POST_ID}}: {{POST_TEXT}}", "m", "1", utc(2024, 1, 1), folder, saves=3
        )

    first = {r.post_id: r for r in run("first_try", True).collect()}
    assert first["p1"].status == "failed" and "three parts" in first["p1"].error
    assert first["p3"].error == "post_summary is longer than 1000"
    assert first["p2"].status == "ok" and "echoed_id" in first["p2"].violations
    assert tables.annotation_table(spark, "first_try").count() == 18
    run("second_try", False)
    assert sorted(p.name for p in log.glob("False-*")) == ["False-p1", "False-p3"]
    assert tables.annotation_table(spark, "second_try").count() == 20


def test_finished_tasks_of_a_failed_run_are_kept(spark, make_raw, tmp_path):
    """One task dies every time; what the others were told is there, and not asked again."""
    tables.create_annotation_table(spark, "broken_run", str(tmp_path / "a"))
    raw = make_raw(*[{"post_id": f"p{i}", "content": f"one two three four five {i}"} for i in range(40)])
    log, folder = tmp_path / "asked", str(tmp_path / "run")
    log.mkdir()

    def asker(deadly):
        def label(prompts):
            for p in prompts:
                if deadly and p == "p7":
                    time.sleep(8)
                    os._exit(1)
                (log / f"{deadly}-{p}").touch()
            return [(json.dumps(SOUND), 1, 1) for _ in prompts]

        return label

    def run(deadly):
        return runs.annotate_pending(
            spark, raw, "broken_run", asker(deadly), "{{POST_ID}}", "m", "1", utc(2024, 1, 1), folder,
            partitions=8, batch=1,
        )

    with pytest.raises(Exception):  # noqa: B017
        run(True)
    kept = {r.post_id for r in spark.read.parquet(f"{folder}/replies").collect()}
    assert 20 < len(kept) < 40 and "p7" not in kept
    assert tables.annotation_table(spark, "broken_run").count() == 0
    assert run(False).count() == 40
    assert {p.name for p in log.glob("False-*")} == {f"False-p{i}" for i in range(40) if f"p{i}" not in kept}
    assert tables.annotation_table(spark, "broken_run").count() == 40


def test_tasks_are_of_bounded_length(spark, make_raw, tmp_path):
    tables.create_annotation_table(spark, "many_tasks", str(tmp_path / "a"))
    raw = make_raw(*[{"post_id": f"p{i}", "content": f"one two three four five {i}"} for i in range(60)])
    label = lambda prompts: [(json.dumps(SOUND), 1, 1) for _ in prompts]
    runs.annotate_pending(
        spark, raw, "many_tasks", label, "{{POST_ID}}", "m", "1", utc(2024, 1, 1), str(tmp_path / "run"), task_rows=5
    )
    files = [f for f in (tmp_path / "run" / "replies").glob("*.parquet")]
    assert len(files) > 8 and tables.annotation_table(spark, "many_tasks").count() == 60


def test_run_on_a_stored_silver_table(spark, make_raw, tmp_path):
    tables.create_annotation_table(spark, "of_silver", str(tmp_path / "a"))
    raw = make_raw(*[{"post_id": f"p{i}", "content": f"one two three four five {i}"} for i in range(9)])
    models.silver(models.bronze(raw)).write.parquet(str(tmp_path / "silver"))
    silver = spark.read.parquet(str(tmp_path / "silver"))
    label = lambda prompts: [(json.dumps(SOUND), 1, 1) for _ in prompts]
    results = runs.annotate_pending(
        spark, silver, "of_silver", label, "{{POST_ID}}", "m", "1", utc(2024, 1, 1), str(tmp_path / "run"), limit=4
    )
    assert sorted(r.post_id for r in results.collect()) == ["p0", "p1", "p2", "p3"]
    assert tables.annotation_table(spark, "of_silver").count() == 4


def test_append_keeps_one_annotation_per_post(spark, make_annotations, tmp_path):
    table = "kept_annotations"
    tables.create_annotation_table(spark, table, str(tmp_path / "a"))
    many = make_annotations(
        *[{"post_id": "hot", "sentiment": str(i), "annotated_at": utc(2024, 1, 1, 0, i)} for i in range(50)],
        {"post_id": "x", "sentiment": "s"},
        {"post_id": None, "sentiment": "s"},
    )
    for _ in range(2):
        tables.append_annotations(many, table)
    rows = {r.post_id: r.sentiment for r in spark.table(table).collect()}
    assert rows == {"hot": "49", "x": "s"} and spark.table(table).count() == 2
    tables.append_annotations(many.limit(0), table)
    assert spark.table(table).count() == 2


def test_ingest_run(spark):
    records = spark.createDataFrame(
        [(json.dumps({"id": f"p{i}", "created_utc": 1704067200 + i, "subreddit": "s"}),) for i in range(5)],
        "value string",
    )
    spark.sql("drop table if exists ingest_posts")
    report = runs.ingest_archive(records, "ingest_posts", utc(2024, 1, 2))
    runs.ingest_archive(records, "ingest_posts", utc(2024, 1, 3))
    assert [(r.subreddit, r.n_posts) for r in report.collect()] == [("s", 5)]
    stored = tables.raw_table(spark, "ingest_posts")
    assert stored.count() == 10
    assert models.bronze(stored).count() == 5
    spark.sql("drop table ingest_posts")
