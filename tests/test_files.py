from __future__ import annotations

import json
from pathlib import Path

import pytest

from postlake.schemas import ANNOTATION, RAW_POST
from postlake.sources import files, tables
from tests.conftest import utc

NASTY = [
    'quote " inside',
    "comma, semicolon;",
    "line\nbreak\r\nand return\r",
    "  edge spaces  ",
    "",
    None,
    "\\ backslash \\n",
    '"quoted"',
    "é \U0001f600",
    "tab\tend",
    "#hash",
    "null",
]


def nasty_posts(make_raw):
    return make_raw(
        *[
            {"post_id": str(i), "content": t, "title": t, "score": i, "scraped_at": utc(2024, 1, 1, 0, 0, i)}
            for i, t in enumerate(NASTY)
        ]
    )


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_round_trip(spark, make_raw, tmp_path, kind):
    posts = nasty_posts(make_raw)
    path = str(tmp_path / kind)
    getattr(files, f"write_{kind}")(posts, path)
    back = getattr(files, f"read_{kind}")(spark, path, RAW_POST)
    assert sorted(back.collect(), key=str) == sorted(posts.collect(), key=str)


def test_arrays_in_csv(spark, make_annotations, tmp_path):
    notes = make_annotations(
        {"post_id": "a", "keywords": ["x", 'y "q"', "é", None], "safety_flags": []}, {"post_id": "b"}
    )
    files.write_csv(notes, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), ANNOTATION)
    assert sorted(back.collect()) == sorted(notes.collect())
    header = next(Path(tmp_path / "c").glob("*.csv")).read_text().splitlines()[0]
    assert header.split(",") == ANNOTATION.fieldNames()


def test_json_keeps_nulls_and_iso_times(make_raw, tmp_path):
    posts = make_raw({"post_id": "a", "content": "é", "scraped_at": utc(2024, 1, 2, 3, 4, 5)})
    files.write_json(posts, str(tmp_path / "j"))
    line = next(p for p in Path(tmp_path / "j").glob("*.json") if p.stat().st_size).read_text("utf-8")
    assert "é" in line
    record = json.loads(line)
    assert set(record) == set(RAW_POST.fieldNames())
    assert record["title"] is None
    assert record["scraped_at"] == "2024-01-02T03:04:05.000000Z"


def test_tables_are_made_once_and_check_lengths(spark, make_raw, tmp_path):
    for _ in range(2):
        tables.create_raw_table(spark, "lengths", str(tmp_path / "t"))
    tables.append_posts(make_raw({"post_id": "a"}), "lengths")
    tables.append_posts(make_raw(), "lengths")
    assert tables.raw_table(spark, "lengths").count() == 1
    mixed = make_raw({"post_id": "a" * 256}, {"post_id": "b", "title": "t" * 2000}, {"post_id": "c", "url": "u" * 2001})
    tables.append_posts(mixed, "lengths")
    assert {r.post_id for r in tables.raw_table(spark, "lengths").collect()} == {"a", "b"}
    assert {r.reason for r in tables.post_rejects(mixed).collect()} == {
        "post_id is longer than 255",
        "url is longer than 2000",
    }


def test_one_long_annotation_keeps_no_other_out(spark, make_annotations, tmp_path):
    tables.create_annotation_table(spark, "long_notes", str(tmp_path / "n"))
    notes = make_annotations({"post_id": "a", "post_summary": "x" * 1001}, {"post_id": "b", "post_summary": "x" * 1000})
    tables.append_annotations(notes, "long_notes")
    assert [r.post_id for r in tables.annotation_table(spark, "long_notes").collect()] == ["b"]
    assert [r.reason for r in tables.annotation_rejects(notes).collect()] == ["post_summary is longer than 1000"]


def test_csv_files_are_bounded(spark, make_raw, tmp_path):
    posts = make_raw(*[{"post_id": str(i), "content": "a\nb"} for i in range(25)]).coalesce(1)
    files.write_csv(posts, str(tmp_path / "c"), rows_per_file=10)
    assert len(list(Path(tmp_path / "c").glob("*.csv"))) == 3
    assert files.read_csv(spark, str(tmp_path / "c"), RAW_POST).count() == 25


def test_day_folders(spark, make_raw, tmp_path):
    path = str(tmp_path / "days")
    for day in (1, 2):
        tables.append_posts_by_day(
            make_raw(*[{"post_id": str(i), "post_date": utc(2024, 1, day, i)} for i in range(5)]), path
        )
    assert sorted(p.name for p in Path(path).glob("post_day=*")) == ["post_day=2024-01-01", "post_day=2024-01-02"]
    assert tables.raw_posts(spark, path).count() == 10
