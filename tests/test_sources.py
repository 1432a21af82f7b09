"""Files in and out, whole runs, streaming."""

from __future__ import annotations

import json
import struct
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog.queries import OPTIONS, RULES, SQL_RULE
from plumbrule import audit_report, load_rules, row_violations, run_checks, scan_csv, scan_report, scan_summary
from plumbrule.constants import REPORT_ORDER, UNIQUE
from plumbrule.operators import images
from plumbrule.operators.splitting import batch_numbers, batch_split, subset_ends
from plumbrule.plans.options import RuleOptions
from plumbrule.sources import sinks, tables
from plumbrule.streaming.violations import stream_violations, write_violation_stream


def test_csv_with_byte_order_mark_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('﻿id,note\n1,"say ""x""\nnext"\n2,\n3,  padded \n'.encode())
    table = scan_csv(spark, str(tmp_path / "t.csv"), view="t_csv", stage_to=str(tmp_path / "staged"))
    assert table.columns == ["id", "note"]
    assert [row["note"] for row in spark.table("t_csv").orderBy("id").collect()][:2] == ['say "x"\nnext', None]


def test_report_survives_the_csv(spark, tmp_path):
    rows = [("r", " padded ", "two\nlines", 'a "quote"', ""), ("s", "1", None, "back\\slash,comma", "x")]
    names = ("rule_id", "record_id", "phase", "failed_field", "failed_value")
    frame = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))
    for single in (False, True):
        path = str(tmp_path / f"report{single}.csv")
        sinks.write_report_csv(frame, path, single_file=single)
        sinks.write_report_csv(frame, path, single_file=single)
        found = sorted(tuple(row) for row in scan_report(spark, path).collect())
        assert found == sorted(tuple(value or None for value in row) for row in rows)
    assert (tmp_path / "reportTrue.csv").is_file()


def test_single_file_keeps_the_order(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    sinks.write_report_csv(spark.range(0, 5000, 1, 7).orderBy(F.desc("id")), path, single_file=True)
    assert (tmp_path / "x.csv").read_text().split() == ["id", *(str(n) for n in range(4999, -1, -1))]


def test_absent_summary(spark, tmp_path):
    assert scan_summary(spark, str(tmp_path / "none.csv")) is None


def test_rules_file(spark, tmp_path):
    (tmp_path / "rules.yaml").write_text(json.dumps({"rules": fx.RULE_DEFINITIONS}))
    assert load_rules(spark, str(tmp_path / "rules.yaml")) == RULES


def test_run_then_audit(spark, projects, tmp_path):
    projects.createOrReplaceTempView("t_projects")
    base = str(tmp_path / "out")
    run = run_checks(projects, RULES, base, OPTIONS, [SQL_RULE], "t_projects", run_id="r1")
    saved = tables.scan_full_report(spark, run.manifest.place("fail_report"))
    assert saved.count() == run.report.count() > 0
    assert {row["status"] for row in sinks.read_run_log(spark, base).collect()} == {"OK"}
    parts = sorted(Path(run.manifest.place("fail_report")).glob("part-*.csv"))
    keys = [tuple(row[name] or "" for name in REPORT_ORDER) for part in parts for row in tables.scan_full_report(spark, str(part)).collect()]
    assert keys == sorted(keys)
    assert sinks.read_rule_rows(spark, run.manifest.place("rule_rows"), "Q1").columns[-1] == fx.GATES[4]
    assert sinks.latest_run(spark, base).first()["run_id"] == "r1"
    assert sinks.read_run_rules(spark, base).count() == len(RULES) + 1
    declared = saved.where("rule_id <> 'Q1'")
    summary = scan_summary(spark, run.manifest.place("rule_summary") + ".csv")
    audit = audit_report(projects, RULES, declared, OPTIONS, summary, truth_path=str(tmp_path / "truth"))
    assert all(row["count_match"] for row in audit.comparison.collect())
    checked = audit.summary.collect()
    assert all(row["dq_summary_matches_generated_report"] for row in checked) and len(checked) == len(RULES)
    # An id that is blank reads back from CSV as it was written, so nothing is missed or invented.
    assert audit.missed.count() == audit.invented.count() == 0


def test_latest_run(spark, tmp_path):
    for year in ("2001", "2003", "2002"):
        sinks.write_run_manifest(spark, str(tmp_path), sinks.RunManifest(year, year, year, year, "o"))
    assert sinks.latest_run(spark, str(tmp_path)).first()["run_ts"] == "2003"


def test_an_interrupted_run_is_not_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    sinks.write_run_manifest(spark, base, sinks.RunManifest("1", "done", "1", "1", "o"), RULES)
    write = sinks._append

    def interrupted(spark, path, rows):
        if path.endswith("/runs"):
            raise RuntimeError("lost")
        write(spark, path, rows)

    monkeypatch.setattr(sinks, "_append", interrupted)
    with pytest.raises(RuntimeError):
        sinks.write_run_manifest(spark, base, sinks.RunManifest("2", "lost", "2", "2", "o"), RULES)
    assert sinks.latest_run(spark, base).first()["run_id"] == "done"
    assert {row["run_id"] for row in sinks.read_run_rules(spark, base).collect()} == {"done"}


def test_stream_equals_batch(spark, projects, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    projects.repartition(3).write.parquet(source)
    rules = [rule for rule in RULES if rule.check_type != UNIQUE]
    stream = spark.readStream.schema(projects.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write_violation_stream(stream_violations(stream, rules, OPTIONS), target, str(tmp_path / "c")).awaitTermination()
    batch = row_violations(projects, rules, OPTIONS)
    found = spark.read.schema(batch.schema).parquet(target)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))
    with pytest.raises(ValueError, match="uniqueness"):
        stream_violations(stream, RULES, OPTIONS)
    with pytest.raises(ValueError, match="run date"):
        stream_violations(stream, rules, RuleOptions())


def bmp(pixels):
    """A 2 x 2 24-bit BMP of (r, g, b) rows, top row first."""
    body = b"".join(b"".join(bytes(p[::-1]) for p in row) + b"\0\0" for row in reversed(pixels))
    header = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
    return header + struct.pack("<IiiHHIIiiII", 40, 2, 2, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def test_image_folder(spark, tmp_path):
    red, blue, white, black = (255, 0, 0), (0, 0, 255), (255, 255, 255), (0, 0, 0)
    for name, content in (("a", bmp([[red, blue], [white, black]])), ("b", b"GIF89a....")):
        folder = tmp_path / "data" / ("sick" if name == "a" else "well")
        folder.mkdir(parents=True)
        (folder / f"{name}.bmp").write_bytes(content)
    files = tables.scan_images(spark, str(tmp_path / "data"))
    kept = images.image_allowlist(files).collect()
    assert [(row["class"], row["image_format"]) for row in kept] == [("sick", "bmp")]
    rejected = images.image_quarantine(files)
    assert rejected.first()["reason"] == "format not allowed: gif"
    labels = {row["class"]: row["label"] for row in images.class_index(files, "class").collect()}
    assert labels == {"sick": 0, "well": 1}
    decoded = images.without_rejected(tables.scan_decoded_images(spark, str(tmp_path / "data")), rejected)
    same = images.image_prepare(decoded, keep=("path", "class"), side=2).first()
    assert same["class"] == "sick" and same["pixels"] == [1, 0, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0]
    big = images.image_prepare(decoded, side=256).first()["pixels"]
    assert len(big) == 256 * 256 * 3 and big[:3] == [1, 0, 0] and 0 <= min(big) <= max(big) <= 1


def test_split_sizes():
    assert subset_ends(10 * 32) == [("train", 8), ("test", 10), ("val", 10)]
    assert subset_ends(32 * 32) == [("train", 23), ("test", 30), ("val", 32)]
    assert subset_ends(0)[-1] == ("val", 0)


@pytest.mark.parametrize("rows", [0, 1, 31, 33, 320, 1000])
def test_split_is_contiguous(spark, rows):
    frame = spark.range(rows).selectExpr("id * 7919 % 100003 AS k", "id").repartition(5)
    numbered = batch_numbers(frame, "k").orderBy("k").collect()
    assert [row["row_index"] for row in numbered] == list(range(rows))
    expected = []
    for place in range(rows):
        expected.append(next((name for name, end in subset_ends(rows) if place // 32 < end), None))
    assert [row["subset"] for row in numbered] == expected
    assert [row["subset"] for row in batch_split(frame, "k").orderBy("k").collect()] == expected


def test_split_needs_an_identifying_key(spark):
    with pytest.raises(ValueError, match="identify"):
        batch_split(spark.range(1000).selectExpr("id % 2 AS k"), "k").count()
