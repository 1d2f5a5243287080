"""Drills, objects and their formats, text blocks and tickets, reports."""

import hashlib
import json
import os
import struct
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.operators import checks, text
from gneiss.plans import drill, kpi
from gneiss.sources import batches, files, formats, planted

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DRILL = """
import sys
from pyspark.sql import SparkSession
from gneiss.plans import drill
from gneiss.sources import batches
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(0, 1000, 1, 4).selectExpr("id", "id * 2 as v")
drill.fail_on_partition(rows, 1).write.parquet(sys.argv[1] + "/once")
assert sorted(map(tuple, spark.read.parquet(sys.argv[1] + "/once").collect())) == [(i, 2 * i) for i in range(1000)]
try:
    drill.fail_on_partition(rows, 1, None).write.parquet(sys.argv[1] + "/never")
    raise SystemExit("the write should have failed")
except Exception as e:
    assert "attempt 2" in str(e), e
assert not batches.finished(spark, sys.argv[1] + "/never") and not [n for n in batches.names(spark, sys.argv[1] + "/never") if n.startswith("part-")]
batches.replace_batch(rows, sys.argv[1] + "/t", "B1")
try:
    drill.fail_on_partition(rows.limit(10), 0, None).write.mode("append").parquet(sys.argv[1] + "/t/batch_key=B1")
except Exception:
    pass
assert batches.read_batches(spark, sys.argv[1] + "/t").count() == 1000
print("drilled")
"""


def test_failure_drill(tmp_path):
    """A retried task gives the same rows; a write that fails for good leaves nothing that a reader sees."""
    run = subprocess.run([sys.executable, "-c", DRILL, str(tmp_path)], capture_output=True, text=True, timeout=240, env=os.environ | {"PYTHONPATH": ROOT})
    assert run.stdout.strip().endswith("drilled"), run.stderr[-2000:]


def test_drill_on_one_attempt(spark):
    with pytest.raises(Exception, match="partition 0, attempt 0"):
        drill.fail_on_partition(spark.range(5).coalesce(1)).collect()
    assert drill.fail_on_partition(spark.range(5).coalesce(1), partition=3).count() == 5


def avi_of(frames, micros=500_000, width=640, height=480):
    chunk = lambda tag, body: tag + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    head = chunk(b"avih", struct.pack("<I", micros) + b"\0" * 28 + struct.pack("<II", width, height) + b"\0" * 16)
    movi = b"LIST" + struct.pack("<I", 0) + b"movi" + b"".join(chunk(b"00dc", f) for f in frames) + chunk(b"idx1", b"")
    return b"RIFF" + struct.pack("<I", 0) + b"AVI " + b"LIST" + struct.pack("<I", 0) + b"hdrl" + head + movi


def png_of(pixels):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    h, w = pixels.shape
    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_good_video_sidecar_and_image(spark):
    video = avi_of([b"a" * 10, b"a" * 10, b"b" * 21, b"c" * 5])
    sidecar = json.dumps({"video_id": "v", "file": "a.avi", "captured_at": "2026-01-01T00:00:00Z", "fps": 2}).encode()
    image = png_of(np.array([[0, 255, 255], [255, 255, 100]]))
    df = spark.createDataFrame([("a.avi", video), ("a.json", sidecar), ("d.png", image), ("e.png", image[:40]), ("f.txt", b"x")], "file_name string, content binary")
    rows = [(r["file_name"], r["kind"], json.loads(r["facts"])) for r in formats.extract(df).collect()]
    assert [(f["frame"], f["t_s"], f["bytes"]) for n, k, f in rows if k == "video_keyframe"] == [(0, 0.0, 10), (2, 1.0, 21), (3, 1.5, 5)]
    assert [f["fps"] for n, k, f in rows if k == "sidecar"] == [2]
    assert [(f["width"], f["height"], f["dark_share"]) for n, k, f in rows if k == "drawing_image"] == [(3, 2, pytest.approx(2 / 6))]
    found = {r["file_name"]: r["format_verdict"] for r in formats.verdicts(df, least={"avi": 4}).collect()}
    assert found == {"a.avi": "VIDEO_TOO_SHORT", "a.json": "OK", "d.png": "OK", "e.png": "PNG_UNREADABLE", "f.txt": "UNKNOWN_FORMAT"}


def test_objects_are_stored_once(spark, tmp_path):
    rows = [("a", b"one"), ("b", b"two"), ("c", b"one"), ("d", None), ("e", b"")]
    df = spark.createDataFrame(rows, "path string, content binary").repartition(5)
    for _ in range(2):  # a second run finds all files there
        index = {r["path"]: r for r in files.store_objects(df, f"file://{tmp_path}/store").collect()}
        held = {p.name: p.read_bytes() for p in (tmp_path / "store").rglob("*") if p.is_file()}
        assert held == {hashlib.sha256(c).hexdigest(): c for c in (b"one", b"two", b"")}
        assert index["a"]["stored"] == index["c"]["stored"] and index["d"]["sha256"] is None and index["e"]["size"] == 0


def test_a_name_is_taken_once(tmp_path):
    from pyarrow import fs

    store = fs.LocalFileSystem()
    assert files.put_once(store, f"{tmp_path}/x/f", b"1") and not files.put_once(store, f"{tmp_path}/x/f", b"1")
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["f"]


def test_planted_send_times_hold_their_shares(spark):
    found = spark.range(200_000).select(planted.send_delay_ms(F.col("id")).alias("d")).agg(*(F.avg((F.col("d").between(1000 * a, 1000 * b)).cast("int")).alias(f"s{i}") for i, (_, a, b) in enumerate(planted.DELAYS)), F.avg((F.col("d") == 0).cast("int")).alias("none")).first()
    for i, (share, _, _) in enumerate(planted.DELAYS):
        assert found[f"s{i}"] == pytest.approx(share, rel=0.2)
    assert found["none"] == pytest.approx(1 - sum(s for s, _, _ in planted.DELAYS), abs=0.005)


def test_block_and_ticket_scope(spark):
    df = spark.createDataFrame([("x\nEQUIPMENT LIST (2)\nP-101A pump\nV-7 valve\n\nP-999",), ("no list",), ("EQUIPMENT LIST\nP-1",)], "t string")
    assert [r[0] for r in df.select(text.block(F.col("t"), "EQUIPMENT LIST")).collect()] == ["P-101A pump\nV-7 valve", None, "P-1"]
    drafts = spark.createDataFrame([("P-1.PV", "Repair", "shut down the unit", ""), ("P-2", "Sensor", "check", ""), ("Q", "Repair", "shut down", "")], "asset_tag string, ticket_type string, description string, evidence string")
    assets = spark.createDataFrame([("P-1", True), ("P-2", True)], "asset_tag string, is_abstained boolean")
    found = {r["asset_tag"]: (r["scope"], r["flags"]) for r in text.ticket_scope(drafts, assets, forbidden=[r"shut\s+down"]).collect()}
    assert found == {"P-1": ("KEPT", ["ABSTAINED_ASSET", "FORBIDDEN_ACTION"]), "P-2": ("KEPT", []), "Q": ("DROPPED", [])}


def test_report_parameters_and_publishing(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "a double, b double")
    checks.report(checks.check(rows, "bronze", "e", "c", F.col("a"), F.col("b")), f"file://{tmp_path}/report")
    (part,) = (tmp_path / "report").glob("*.csv")
    assert [line.split(",")[6] for line in part.read_text().splitlines()] == ["status", "MISMATCH"]
    found = kpi.dated_parameters(spark, "2026-01-01", {"a": {"b": 1, "c": [1, 2]}, "d": "x"}).collect()
    assert sorted((r["parameter"], r["value"]) for r in found) == [("a.b", "1"), ("a.c", "[1, 2]"), ("d", "x")]
    for n in (1, 2):
        batches.publish(spark, f"file://{tmp_path}/events", [{"event": "trained", "value": float(n)}], "event string, value double, note string", "run-7")
    assert [tuple(r) for r in batches.read_batches(spark, f"file://{tmp_path}/events").collect()] == [("trained", 2.0, None, "run-7")]


def test_named_checks_without_a_run(spark):
    audit = spark.createDataFrame([], "stage string, batch_id string, entity string, status string, message string, at double")
    accepted = spark.createDataFrame([("e", 3)], "entity string, n long")
    found = checks.union([checks.batch_status(audit, "bronze", "B"), checks.load_status(audit, accepted, "bronze", "B")]).collect()
    assert [(r["status"], r["detail"]) for r in found] == [("MISMATCH", "last bronze run NOT RUN"), ("MISMATCH", "the table holds 3 rows of an earlier run")]


def test_topics_are_one_stream(spark, tmp_path):
    from gneiss.sources import readers

    for topic, n in (("a", 3), ("b", 2)):
        rows = spark.range(n).select(F.lit("k").alias("key"), F.col("id").alias("timestamp"), F.lit("{}").alias("value"))
        rows.write.json(f"file://{tmp_path}/in/{topic}")
    stream = readers.topic_files(spark, f"file://{tmp_path}/in", ["a", "b"])
    query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r["topic"], r["count"]) for r in spark.read.parquet(f"{tmp_path}/out").groupBy("topic").count().collect()} == {("a", 3), ("b", 2)}


def test_small_files(spark, tmp_path):
    path = f"file://{tmp_path}/a/_manifest.json"
    assert batches.read_text(spark, path) is None and batches.names(spark, f"file://{tmp_path}/a") == []
    for body in ("{}", "größer"):
        batches.write_text(spark, path, body)
        assert batches.read_text(spark, path) == body
    assert "_manifest.json" in batches.names(spark, f"file://{tmp_path}/a")
    batches.remove(spark, path)
    assert not batches.exists(spark, path)


def test_tags_of_a_drawing(spark):
    body = b"BT (EQUIPMENT LIST) Tj 0 -14 Td (P-101A feed pump) Tj 0 -14 Td (V-7 valve) Tj 0 -14 Td (P-101A again) Tj ET"
    pdf = b"%PDF-1.4\n1 0 obj\n<< /Length " + str(len(body)).encode() + b" >>\nstream\n" + body + b"\nendstream\nendobj\n%%EOF\n"
    pages = formats.extract(spark.createDataFrame([("d.pdf", pdf)], "file_name string, content binary")).where("kind = 'doc_page'")
    rows = pages.select(text.tags(text.block(F.get_json_object("facts", "$.text"), "EQUIPMENT LIST"), r"[A-Z]+-\d+[A-Z]?").alias("tags"))
    assert rows.first()["tags"] == ["P-101A", "V-7"]


def test_judged_and_counted_rows(spark):
    from gneiss.operators import windows

    rows = [("a", i, float(v), i != 7, i != 9) for i, v in enumerate([1, 2, 1, 2, 1, 2, 1, 90, 1, 80, 2, 70])]
    df = spark.createDataFrame(rows, "k string, t long, v double, counts boolean, judge boolean")
    found = windows.rolling_zscore(df, "k", ["t"], "v", rows=4, threshold=2.0, judged=F.col("judge"), counted=F.col("counts"), segment_rows=3)
    assert sorted(r["t"] for r in found.collect()) == [7]  # 9 is not judged, and it is in the reference of 11
    assert {r["t"] for r in windows.rolling_zscore(df, "k", ["t"], "v", rows=4, threshold=2.0, counted=F.col("counts"), segment_rows=3).collect()} == {7, 9}


def test_gate_with_a_champion_and_asset_checks(spark):
    metrics = spark.createDataFrame([(0.90, 0.2)], "auroc double, brier double")
    found = {r["metric"]: (r["limit_value"], r["passed"]) for r in checks.gate(metrics, {"auroc": (">=", 0.8), "brier": ("<=", 0.1)}, champion=0.93).collect()}
    assert found == {"auroc": (0.8, True), "brier": (0.1, False), "auroc_vs_champion": (pytest.approx(0.92), False)}
    df = spark.createDataFrame([(1.0, None), (200.0, 5.0)], "a double, b double")
    assert [r["failed_checks"] for r in checks.asset_checks(df, {"a": (0, 100), "b": (0, 10)}).collect()] == [["b:MISSING"], ["a:OUT_OF_RANGE"]]
