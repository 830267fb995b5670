"""States that hold what changed: what a landing writes, and that nothing is lost by it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postlake.operators.dedupe import latest_annotations, latest_posts
from postlake.plans import models
from postlake.schemas import RAW_POST
from postlake.streaming import carry, incremental, state
from tests.conftest import utc
from tests.test_carry import Chain, same


@pytest.fixture
def chain(spark, tmp_path):
    return Chain(spark, tmp_path)


def rows_by_version(spark, folder):
    found = spark.read.parquet(str(folder)).groupBy("version").count().collect()
    return {row.version: row["count"] for row in found}


def test_a_landing_writes_what_changed_and_no_more(spark, chain, make_raw, make_annotations):
    """Each bucket has a dozen posts; a landing of one post rewrote them all."""
    chain.land(make_raw(*[{"post_id": f"p{i}", "content": "x"} for i in range(200)]), make_annotations())
    chain.run()
    new = {"post_id": "p7", "content": "new", "scraped_at": None, "score": 9}
    old = {"post_id": "p9", "content": "older", "scraped_at": utc(2020, 1, 1)}
    chain.land(make_raw(new, old, {"post_id": "q", "content": "first"}), make_annotations({"post_id": "p8", "sentiment": "neutral"}))
    chain.run()
    assert rows_by_version(spark, chain.root / "state") == {0: 200, 1: 2}
    assert rows_by_version(spark, chain.root / "note_state") == {0: 1}
    assert rows_by_version(spark, chain.root / "silver" / "data") == {1: 200, 2: 2}
    assert rows_by_version(spark, chain.root / "gold" / "data") == {1: 200, 2: 3}
    found = {r.post_id: (r.text_raw, r.sentiment) for r in chain.gold().collect()}
    assert len(found) == 201 and chain.gold().count() == 201
    assert found["p7"] == ("new", None) and found["p8"] == ("x", "neutral") and found["p9"] == ("x", None)
    # The same landing again changes nothing.
    chain.land(make_raw(new, old))
    assert chain.run() == ([], [])


@pytest.mark.parametrize("most", [1, 64])
def test_odd_rows_in_turns_equal_one_batch(spark, chain, make_raw, make_annotations, monkeypatch, most):
    """Null ids, texts that come and go, ties; buckets written whole often, or when worn."""
    monkeypatch.setattr(state, "MOST_VERSIONS", most)
    monkeypatch.setattr("tests.test_carry.BUCKETS", 3)
    rng = random.Random(most)

    def row(number):
        return {
            "post_id": rng.choice([None, *(f"p{i}" for i in range(12))]),
            "score": rng.choice([None, 1]),
            "title": rng.choice(["a", "b"]),
            "content": rng.choice(["x", "y www.x.io", None]),
            "scraped_at": rng.choice([None, utc(2024, 1, 1 + number)]) if rng.random() < 0.3 else utc(2024, 1, 2 + number),
        }

    def note():
        return {
            "post_id": rng.choice([None, *(f"p{i}" for i in range(15))]),
            "annotated_at": rng.choice([None, utc(2024, 2, rng.randint(1, 2))]),
            "keywords": rng.choice([None, ["k"], ["l"]]),
        }

    for number in range(3):
        chain.land(make_raw(*(row(number) for _ in range(12))), make_annotations(*(note() for _ in range(5 * (number % 3)))))
        chain.run()
    raw = latest_posts(spark.read.schema(RAW_POST).parquet(chain.posts))
    silver = models.silver(models.bronze(raw))
    stored = latest_annotations(spark.read.schema(incremental.NOTE).parquet(chain.notes))
    assert same(incremental.merged_posts(spark, chain.path("state")), raw)
    assert same(carry.State(chain.path("note_state"), incremental.NOTE).current(spark), stored)
    assert same(chain.silver(), silver)
    assert same(chain.gold(), models.gold(silver, stored))


def test_worn_buckets_are_written_whole(spark, make_raw, tmp_path):
    """Rows that were replaced never outnumber those that count by more than a landing."""
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "target", "progress"))
    for day in range(1, 5):
        make_raw(
            *[{"post_id": f"p{i}", "score": day, "scraped_at": utc(2024, 1, day)} for i in range(20 if day > 1 else 21)]
        ).write.mode("append").parquet(landed)
        incremental.merge_new(spark, landed, RAW_POST, target, progress, 1)
    found = {r.post_id: r.score for r in incremental.merged_posts(spark, target).collect()}
    assert len(found) == 21 and found["p20"] == 1 and found["p3"] == 4
    # The third landing finds 20 rows replaced and 21 that count, the fourth finds 40.
    assert rows_by_version(spark, target) == {0: 21, 1: 20, 2: 20, 3: 21}
    assert state.State(target, RAW_POST).heads(spark) == {0: state.Head(3, 3, 0)}


def test_states_of_whole_versions_are_carried_on(spark, chain, make_raw, make_annotations):
    """Folders from before there was a ledger of posts, and a model's ledger of before."""
    n = 16
    first = make_raw(*[{"post_id": f"p{i}", "content": "old"} for i in range(40)])
    second = first.withColumn("content", F.lit("newer"))
    for version, rows in ((0, first), (1, second)):
        rows = rows.withColumn("bucket", incremental.bucket_of(n))
        rows = rows if version == 0 else rows.filter("bucket < 8")
        rows.write.partitionBy("bucket").parquet(f"{chain.path('state')}/version={version}")
    whole = first.withColumn("bucket", incremental.bucket_of(n))
    now = whole.filter("bucket >= 8").unionAll(second.withColumn("bucket", incremental.bucket_of(n)).filter("bucket < 8"))
    assert same(incremental.merged_posts(spark, chain.path("state")), now.drop("bucket"))

    old = models.silver(models.bronze_of_latest(first))
    spark.createDataFrame([], old.schema).write.parquet(f"{chain.path('silver')}/data")
    old.withColumn("bucket", incremental.bucket_of(n)).write.partitionBy("bucket").parquet(
        f"{chain.path('silver')}/data/version=1"
    )
    made = spark.createDataFrame([(b, 1, {"posts": 0}) for b in range(n)], "bucket int, run long, inputs map<string,long>")
    made.write.parquet(f"{chain.path('silver')}/ledger")
    assert same(chain.silver(), old)

    news = make_raw({"post_id": "p3", "content": "last", "score": 1}, {"post_id": "z", "content": "z"})
    chain.land(news, make_annotations())
    chain.run()
    raw = now.drop("bucket").filter("post_id <> 'p3'").unionAll(news)
    assert same(incremental.merged_posts(spark, chain.path("state")), raw)
    assert same(chain.silver(), models.silver(models.bronze(raw)))


def test_versions_that_were_not_entered_do_not_count(spark, chain, make_raw, make_annotations):
    chain.land(make_raw(*[{"post_id": f"p{i}", "content": "old"} for i in range(30)]), make_annotations())
    chain.run()
    left = make_raw({"post_id": "p3", "content": "left"}).withColumn("bucket", incremental.bucket_of(16))
    left.write.partitionBy("bucket").parquet(f"{chain.path('state')}/version=1")
    assert {r.content for r in incremental.merged_posts(spark, chain.path("state")).collect()} == {"old"}
    chain.land(make_raw({"post_id": "p4", "content": "new", "score": 1}))
    chain.run()
    found = {r.post_id: r.content for r in incremental.merged_posts(spark, chain.path("state")).collect()}
    assert len(found) == 30 and found["p3"] == "old" and found["p4"] == "new"


def test_posts_may_be_shaped_from_landed_rows(spark, make_raw, tmp_path):
    """A landed row may make several posts."""
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "target", "progress"))
    make_raw({"post_id": "a", "score": 1}, {"post_id": "b", "score": 2}).write.parquet(landed)

    def shape(rows):
        return rows.withColumn("post_id", F.explode(F.array("post_id", F.concat("post_id", F.lit("2")))))

    incremental.merge_new(spark, landed, RAW_POST, target, progress, 4, shape)
    found = {r.post_id: r.score for r in incremental.merged_posts(spark, target).collect()}
    assert found == {"a": 1, "a2": 1, "b": 2, "b2": 2}


def test_arrays_come_back_from_the_shuffle_as_they_were(spark, make_annotations, monkeypatch):
    monkeypatch.setattr(carry, "PACK_BYTES", 100)
    lists = [None, [], [None], [""], ['a "b"', None, "\\n\n", "é☃\u0001"], ["w" * 200], ["x"] * 5]
    notes = make_annotations(*[{"post_id": f"p{i}", "keywords": words} for i, words in enumerate(lists)])
    broken = F.array(F.decode(F.unhex(F.lit("61")), "UTF-8"), F.unhex(F.lit("61C3")).cast("string"), F.unhex(F.lit("A9")).cast("string"))
    notes = notes.unionAll(notes.limit(1).withColumns({"post_id": F.lit("b"), "keywords": broken}))
    assert set(carry.ARRAYS) == {"secondary_topics", "keywords", "safety_flags"}
    again = carry._unpacked(carry._packed(notes))
    assert again.schema["keywords"].dataType == notes.schema["keywords"].dataType

    def bits(df):
        words = F.transform("keywords", lambda word: F.hex(word.cast("binary")))
        return {r[0]: r[1] for r in df.select("post_id", words).collect()}

    assert bits(again) == bits(notes) and len(bits(notes)) == 8
