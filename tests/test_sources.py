import io
import json
import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.plans import contracts
from gneiss.sources import batches, dumps, formats, readers
from gneiss.sources.batches import Audit, committed_since_complete

DUMP = """CREATE TABLE `equi` (
  `equnr` varchar(18) NOT NULL,
  `eqktx` varchar(40),
  `press` decimal(9,1)
) ENGINE=InnoDB;
INSERT INTO `equi` VALUES ('E1','O''Brien, \\'x\\' (a)',12.5),('E2',NULL,NULL),
('E3','line\\nend',-3);
"""


def test_dump(spark, tmp_path):
    (tmp_path / "a.sql").write_text(DUMP)
    rows = readers.read_dump(spark, str(tmp_path / "a.sql"), "equi", ["press", "equnr", "eqktx", "absent"]).orderBy("_source_row").collect()
    assert [(r["equnr"], r["eqktx"], r["press"], r["absent"]) for r in rows] == [("E1", "O'Brien, 'x' (a)", "12.5", None), ("E2", None, None, None), ("E3", "line\nend", "-3", None)]


def dump_value(rnd):
    """(as written in a dump, as read) of a value."""
    kind = rnd.random()
    if kind < 0.3:
        return ("NULL", None) if kind < 0.15 else (str(n := rnd.randint(-99, 99)), str(n))
    bits = ["a", "'", "\\", ",", "(", ")", ";", "\n", "--", " ", "#", "/*", "*/", '"', "`", "INSERT INTO `t` VALUES (1);", "é"]
    s = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))
    slashed = s.replace("\\", "\\\\")
    if '"' not in s and kind > 0.9:
        return f'"{slashed}"', s
    return "'" + (slashed.replace("'", "''") if kind > 0.6 else slashed.replace("'", "\\'").replace("\n", "\\n")) + "'", s


def dump_of(rnd):
    """A dump of table t with comments, other statements and column lists, and the rows it holds."""
    out = ["-- dump; it's a \"test\"\n/*!40101 SET x='y;' */;\n/* c ' */ # it's\nCREATE TABLE `t` (\n `a` int DEFAULT 'x,y',\n `b` decimal(9,1),\n PRIMARY KEY (`a`,`b`)\n) ENGINE=x;\nINSERT INTO `u` VALUES (1,2);\n"]
    rows = []
    for _ in range(rnd.randint(0, 6)):
        pairs = [(dump_value(rnd), dump_value(rnd)) for _ in range(rnd.randint(1, 4))]
        rows += [(a[1], b[1]) for a, b in pairs]
        head = rnd.choice(["INSERT INTO `t` VALUES ", "insert ignore into db.t\nvalues\n", "-- x'\nINSERT INTO t (`a`, b) VALUES "])
        out.append(head + rnd.choice([",", ",\n", " , "]).join(f"({a[0]},{b[0]})" for a, b in pairs) + rnd.choice([";\n", ";", " ;\n"]))
    return "".join(out), rows


@pytest.mark.parametrize("range_bytes", [1, 7, 40, 1 << 20])
def test_dump_ranges_in_any_place(range_bytes):
    rnd = random.Random(range_bytes)
    for _ in range(60):
        text, expected = dump_of(rnd)
        data, state, found, creates = text.encode(), "", [], []
        for at in range(0, len(data), range_bytes):
            f = io.BytesIO(data)
            begin, end = (dumps._from_mark(f, min(len(data), x), len(data)) for x in (at, at + range_bytes))
            for s in dumps.statements(f, begin, end, state, len(data)) if end > begin else ():
                s = s[dumps._LEADING.match(s).end() :]
                rows = dumps.insert_rows(s, "t")
                found += map(tuple, rows[1]) if rows else ()
                creates += [c for c in [dumps.create_columns(s, "t")] if c]
            state = dumps.after(data[begin:end], state) if end > begin else state
        assert (found, creates, state) == (expected, [["a", "b"]], "")


def test_dump_in_many_tasks(spark, tmp_path):
    rnd, expected = random.Random(9), []
    for name in ("a.sql", "b.sql"):
        text, rows = dump_of(rnd)
        while len(rows) < 6:
            text, rows = dump_of(rnd)
        (tmp_path / name).write_text(text)
        expected += [(name, i, b, a, None) for i, (a, b) in enumerate(rows, 1)]
    found = dumps.read_dump(spark, str(tmp_path), "t", ["b", "a", "absent"], range_bytes=50)
    assert found.rdd.getNumPartitions() > 4 and sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == expected
    assert dumps.read_dump(spark, str(tmp_path), "nothing", ["a"]).count() == 0
    (tmp_path / "c.txt").write_text("")
    assert dumps.read_dump(spark, str(tmp_path / "c.txt"), "t", ["a"]).count() == 0


def test_psv_and_trailer(spark, tmp_path):
    (tmp_path / "w.psv").write_text("aufnr|cost|extra\n1|2.5|x\n2||y\nT|3|2.50\n")
    rows = readers.read_psv(spark, str(tmp_path / "w.psv"), ["cost", "aufnr", "none"]).orderBy("aufnr").collect()
    assert [(r["aufnr"], r["cost"], r["none"]) for r in rows] == [("1", "2.5", None), ("2", None, None)]
    s = readers.psv_stats(spark, str(tmp_path / "w.psv")).first()
    assert (s["n_lines"], s["trailer_count"], s["trailer_total"]) == (2, 3, 2.5)


def test_jsonl(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"op":"U","fields":{"a":1}}\nnot json\n[1]\n')
    rows = readers.read_jsonl(spark, str(tmp_path / "c.jsonl"), ["op", "fields"]).orderBy("_source_row").collect()
    assert [(r["op"], r["fields"], r["_parse_error"]) for r in rows] == [("U", '{"a":1}', None), (None, None, "MALFORMED_JSON"), (None, None, "MALFORMED_JSON")]


def test_manifest_and_objects(spark, tmp_path):
    d = tmp_path / "src" / "2026-10-05"
    d.mkdir(parents=True)
    (d / "a.las").write_bytes(b"x")
    (d / "_manifest.json").write_text(json.dumps({"source": "src", "files": [{"name": "a.las", "size": 1, "sha256": "0" * 64}, {"name": "b.pdf", "size": 2, "sha256": "1"}]}))
    listed = readers.manifests(spark, str(tmp_path), "2026-10-05")
    found = readers.manifest_checks(listed, readers.binary_objects(spark, str(d)).where("file_name <> '_manifest.json'"))
    assert {r["name"]: r["verdict"] for r in found.collect()} == {"a.las": "SHA_MISMATCH", "b.pdf": "MISSING_FILE"}


def test_contract(spark):
    text = json.dumps({"entity": "wo", "key": "id", "format": "psv", "columns": [{"name": "id", "type": "bigint", "required": True}, {"name": "d", "type": "date", "formats": ["yyyy-MM-dd", "dd.MM.yyyy"]}, {"name": "s", "allowed": ["A", "B"]}, {"name": "v", "type": "double", "min": 0}]})
    c = contracts.Contract.parse(text)
    df = spark.createDataFrame([("1", "05.10.2026", "A", "1"), ("1", "2026-10-05", "Z", "-1"), ("x", "nope", "A", ""), (" ", None, None, None)], "id string, d string, s string, v string")
    rows = contracts.validate(df, c).collect()
    assert [r["_reject_reasons"] for r in rows] == [[], ["v:BELOW_MIN"], ["id:NOT_INTEGER", "d:INVALID_DATE"], ["id:REQUIRED"]] or {tuple(r["_reject_reasons"]) for r in rows} == {
        (), ("v:BELOW_MIN",), ("id:NOT_INTEGER", "d:INVALID_DATE"), ("id:REQUIRED",)
    }
    by = {r["s"]: r["_warnings"] for r in rows if r["id"] == "1"}
    assert by == {"A": ["id:DUPLICATE_IN_BATCH"], "Z": ["s:NOT_ALLOWED", "id:DUPLICATE_IN_BATCH"]}


def test_stream_contract(spark):
    c = contracts.Contract("r", (), (contracts.Field("tag", required=True, pattern="^T"), contracts.Field("value", "double", required=True)))
    df = spark.createDataFrame([('{"tag":"T1","value":"2.5","producer_run":"p"}',), ('{"tag":"X","value":"a"}',), ("oops",), (None,), ("[1]",)], "value string")
    rows = contracts.parse_stream(df, c).collect()
    assert [r["reject_reasons"] for r in rows] == [[], ["tag:PATTERN", "value:NOT_NUMBER"], ["value:MALFORMED_JSON"], ["value:MALFORMED_JSON"], ["value:MALFORMED_JSON"]]


def test_batches_replace_themselves(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    row = lambda *x: spark.createDataFrame([*x], "k int, v string, d string")
    batches.replace_batch(row((1, "a", "x"), (2, "b", "y")), path, "B1", ["d"])
    batches.replace_batch(row((1, "c", "x")), path, "B2", ["d"])
    batches.replace_batch(row((1, "d", "z"), (3, "e", "z")), path, "B2", ["d"])  # again, with another partition
    found = sorted((r["batch_key"], r["k"], r["v"]) for r in batches.read_batches(spark, path).collect())
    assert found == [("B1", 1, "a"), ("B1", 2, "b"), ("B2", 1, "d"), ("B2", 3, "e")]
    assert sorted((r["k"], r["v"]) for r in batches.as_of_batch(spark, path, ["k"], "B1").collect()) == [(1, "a"), (2, "b")]
    batches.replace_batch(row((0, "", "")).where("false"), path, "B1", ["d"])
    assert {r["batch_key"] for r in batches.read_batches(spark, path).collect()} == {"B2"}


def test_fold_and_its_repeats(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    row = lambda *x: spark.createDataFrame([*x], "k int, v string, n long, d string")
    read = lambda: sorted((r["k"], r["v"], r["d"]) for r in spark.read.parquet(path).collect())
    batches.fold(row((1, "a", 1, "x"), (2, "b", 1, "y"), (3, "c", 1, "y")), path, ["k", "d"], "n", "d", "r1")
    for _ in range(3):
        batches.fold(row((2, "B", 2, "y"), (4, "D", 2, "z")), path, ["k", "d"], "n", "d", "r2")
        assert read() == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y"), (4, "D", "z")]
    assert len(list((tmp_path / "t" / "d=y").glob("*.parquet"))) == 1 and [x.name for x in (tmp_path / "t" / "_stage").iterdir()] == ["r2"]
    # A run that dies while partitions are replaced: some are gone, and the repeat brings all back from its stage.
    from pyspark.sql.readwriter import DataFrameWriter

    own = DataFrameWriter.parquet

    def dies(self, place, *rest, **options):
        if "_stage" not in place:
            raise RuntimeError("lost")
        return own(self, place, *rest, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies)
    with pytest.raises(RuntimeError):
        batches.fold(row((3, "C", 3, "y")), path, ["k", "d"], "n", "d", "r3")
    monkeypatch.setattr(DataFrameWriter, "parquet", own)
    batches.remove(spark, f"{path}/d=y")
    batches.fold(row((3, "C", 3, "y")), path, ["k", "d"], "n", "d", "r3")
    assert read() == [(1, "a", "x"), (2, "B", "y"), (3, "C", "y"), (4, "D", "z")]


def test_lines_of_split_files(spark, tmp_path):
    text = "".join(f'{{"op":"{i}"}}\r\n' + ("\n" if i % 7 == 0 else "") for i in range(3000))
    (tmp_path / "big.jsonl").write_text(text)
    (tmp_path / "small.jsonl").write_text('{"op":"only"}')
    lines = text.replace("\r", "").split("\n")
    want = [("big.jsonl", i, json.loads(x)["op"]) for i, x in enumerate(lines, 1) if x] + [("small.jsonl", 1, "only")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_jsonl(spark, str(tmp_path), ["op"])
        assert rows.rdd.getNumPartitions() > 3
        assert sorted((r["_source_file"], r["_source_row"], r["op"]) for r in rows.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_audit(spark, tmp_path):
    a = Audit(spark, f"file://{tmp_path}/audit", "bronze", "B1")
    for entity, status in (("e1", "COMMITTED"), ("*", "COMPLETED"), ("e2", "COMMITTED")):
        a.load(entity, status)
    a.transform("s", "join", ["a", "b"], "c")
    a.flush()
    assert [r["entity"] for r in committed_since_complete(a.loads(), "B1").collect()] == ["e2"]
    assert batches.read_batches(spark, f"file://{tmp_path}/audit/lineage").first()["sources"] == ["a", "b"]
    contracts.require_completed(a.loads(), "bronze", "B1")
    with pytest.raises(RuntimeError):
        contracts.require_completed(a.loads(), "silver", "B1")


def test_formats(spark):
    las = b"~V\nVERS. 2.0 : v\n~W\nWELL. W01 : name\nNULL. -999.25 : null\n~C\nDEPT.M : d\nGR.API : g\n~A\n1.0 5.5\n2.0 -999.25\n"
    head = bytearray(3600)
    struct.pack_into(">H", head, 3216, 2000)
    struct.pack_into(">H", head, 3220, 4)
    struct.pack_into(">h", head, 3224, 5)
    trace = bytearray(240 + 16)
    struct.pack_into(">i", trace, 0, 7)
    struct.pack_into(">h", trace, 70, -100)
    struct.pack_into(">ii", trace, 72, 12345, 200)
    page = zlib.compress(b"BT 1 0 0 1 50 700 Tm (Report No: A-1) Tj 0 -20 Td (second) Tj ET")
    pdf = b"%PDF-1.4\n1 0 obj << /Filter /FlateDecode /Length " + str(len(page)).encode() + b" >>\nstream\n" + page + b"\nendstream endobj\n%%EOF"
    files = [("a.las", las), ("b.sgy", bytes(head + trace)), ("c.pdf", pdf), ("d.pdf", pdf[:-6]), ("e.las", b"~A\n"), ("f.json", b"{}"), ("g.avi", b"RIFF"), ("h.xyz", b"")]
    rows = formats.extract(spark.createDataFrame(files, "file_name string, content binary")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["file_name"], []).append((r["kind"], json.loads(r["facts"])))
    assert [k for k, _ in by["a.las"]] == ["well_log_header", "well_log_curve"] and by["a.las"][1][1]["value"] == 5.5
    assert by["b.sgy"][0][1] == {"trace": 7, "x": 123.45, "y": 2.0} and by["b.sgy"][1][1]["samples"] == 4
    assert by["c.pdf"][0][1]["text"] == "Report No: A-1\nsecond"
    assert {k: by[k][0][1]["code"] for k in ("d.pdf", "e.las", "f.json", "g.avi", "h.xyz")} == {
        "d.pdf": "PDF_TRUNCATED", "e.las": "LAS_MISSING_SECTION", "f.json": "JSON_MISSING_KEYS", "g.avi": "VIDEO_UNDECODABLE", "h.xyz": "UNKNOWN_FORMAT"
    }


def test_png_filters():
    image = np.random.default_rng(0).integers(0, 256, (5, 6)).astype(np.uint8)
    wide = np.pad(image.astype(int), ((1, 0), (1, 0)))
    lines = []
    for y, kind in enumerate((0, 1, 2, 3, 4)):
        line = [kind]
        for x in range(6):
            v, left, up, corner = wide[y + 1, x + 1], wide[y + 1, x], wide[y, x + 1], wide[y, x]
            p = left + up - corner
            paeth = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            line.append((v - (0, left, up, (left + up) // 2, paeth)[kind]) % 256)
        lines.append(bytes(line))
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + b"\0\0\0\0"
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (formats.png_gray(data) == image).all()


def test_text_operators(spark):
    from gneiss.operators import text

    md = "```ticket\nasset_tag: `P-1`\ntype: repair\npriority: urgent\ndue_in_days: 900 days\ndescription: fix it\n```\n```ticket\ntag: X\n```"
    rows = text.tickets(spark.createDataFrame([(1, md)], "id int, md string"), "id", "md").collect()
    assert [(r["asset_tag"], r["ticket_type"], r["priority"], r["due_in_days"]) for r in rows] == [("P-1", "Repair", "Medium", 180)]
    df = spark.createDataFrame([("Loss was 12.4 % and 1,250 psi on 2026-10-05, tag PI-101A, 99", "12.38 measured, 1250")], "o string, c string")
    assert df.select(text.ungrounded(F.col("o"), F.col("c"))).first()[0] == [99.0]
    assert df.select(text.snippet(F.col("o"), ["psi"], 20)).first()[0].count("psi") == 1


def test_gps_override_and_nearest(spark):
    from gneiss.operators import history, spatial

    points = spark.createDataFrame([("p1", 10.0, 10.0), ("p2", 50.0, 50.0), ("p3", None, 1.0)], "p string, lat double, lon double")
    sites = spark.createDataFrame([("s1", 10.001, 10.0), ("s2", 10.003, 10.0), ("s0", None, None)], "s string, lat double, lon double")
    near = spatial.nearest(points, sites, "p", "s", 500.0, crossed_sites=0)
    assert sorted((r["p"], r["s"], r["in_band"]) for r in near.collect()) == [("p1", "s1", True), ("p2", "s2", False)]
    resolved = spark.createDataFrame(
        [("p1", "s2", "NORMALISED_TAG", 0.95, "MATCHED"), ("p2", None, "NOT_IN_REGISTER", 0.0, "REVIEW")],
        "p string, s string, rule string, score double, match_status string",
    )
    out = history.gps_override(resolved, near, "p", "s", F.lit(True)).collect()
    assert sorted((r["p"], r["s"], r["match_status"]) for r in out if r["p"] == "p1") == [("p1", "s1", "MATCHED"), ("p1", "s2", "REJECTED")]


def test_nearest_rings_against_crossing(spark):
    """Poles, both sides of 180 degrees, copies, ties, a far cluster; first cells far too small and too large."""
    from gneiss.operators import spatial

    rnd = random.Random(4)
    odd = [(90.0, 0.0), (90.0, 77.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0), (10.0, 179.9999), (10.0, -179.9999), (80.0, 179.99), (80.0, -179.99), (0.0, 0.0)]
    places = odd + [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(60)] + [(45 + rnd.random() / 1e4, 45 + rnd.random() / 1e4) for _ in range(60)]
    points = spark.createDataFrame([(i, *x) for i, x in enumerate(places)], "p int, lat double, lon double")
    sites = spark.createDataFrame([(i, *x) for i, x in enumerate(rnd.sample(places, 40) * 2 + [(45.0, 45.0), (-10.0, 179.9)])], "s int, lat double, lon double")
    rows = lambda df: sorted((r["p"], r["s"], round(r["distance_m"], 3)) for r in df.collect())
    crossed = rows(spatial.nearest(points, sites, "p", "s", crossed_sites=10_000))
    assert len(crossed) == len(places)
    for side, full in ((None, 64), (0.01, 64), (2.0, 1000), (0.05, 3), (1e-6, 0)):
        assert rows(spatial.nearest(points, sites, "p", "s", crossed_sites=0, first_side=side, full_cell=full)) == crossed
    assert spatial.nearest(points, sites.where("s < 0"), "p", "s").count() == 0 and spatial.nearest(points.where("p < 0"), sites, "p", "s", crossed_sites=0).count() == 0


def _rows_made(df, kind):
    """Rows that the operators whose name contains kind gave out in the run of df."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        children, metrics = node.children(), node.metrics()
        todo += [children.apply(i) for i in range(children.size())]
        if kind in name and metrics.contains("numOutputRows"):
            n += metrics.apply("numOutputRows").value()
    return n


def test_nearest_places_searched_once(spark, monkeypatch):
    """Copies of places do not multiply the search's rows, and a repeated point key stays one row."""
    from gneiss.operators import spatial

    points = spark.range(4000).selectExpr("id AS p", "id % 5 * 1e-7 + 45 AS lat", "id % 2 * 1e-7 + 45 AS lon")
    sites = spark.range(200).selectExpr("id AS s", "id % 20 * 1e-7 + 45 AS lat", "id % 7 * 1e-7 + 45.0 AS lon")
    sizes = []
    settle = spatial.settle
    monkeypatch.setattr(spatial, "settle", lambda df: [out := settle(df), sizes.append(out.count())][0])
    rows = lambda df: sorted(map(tuple, df.collect()))
    found = spatial.nearest(points, sites, "p", "s", crossed_sites=0)
    assert rows(found) == rows(spatial.nearest(points, sites, "p", "s", crossed_sites=1000)) and found.count() == 4000
    assert len(sizes) > 2 and max(sizes) <= 10 * 140
    assert spatial.nearest(points.unionByName(points), sites, "p", "s", crossed_sites=0).count() == 4000
    assert spatial.nearest(points.unionByName(points), sites, "p", "s", crossed_sites=1000).count() == 4000


def test_few_sites_make_no_pairs(spark):
    from gneiss.operators import spatial

    points = spark.range(500).selectExpr("id AS p", "id % 90 * 1D AS lat", "id % 180 * 1D AS lon")
    sites = spark.range(25).selectExpr("id AS s", "id * 3D AS lat", "id * 7D AS lon")
    assert 0 < _rows_made(spatial.nearest(points, sites, "p", "s"), "Join") <= 500


def test_long_series_in_segments(spark):
    """Rolling scores and alarms of one long series, cut in many segments, equal those of one window and of a loop."""
    from gneiss.operators import windows
    from gneiss.streaming import telemetry

    rnd = random.Random(1)
    rows = [(k, i, float(rnd.choice([50, 90, 86, 84, 120, 130, 260, 251, 249]))) for k in ("a", "b") for i in range(400 if k == "a" else 30)]
    df = spark.createDataFrame(rows, "k string, t long, v double").withColumn("s", F.col("t")).repartition(6)
    active, expected = {}, []
    for k, t, v in rows:
        active[k], event = telemetry.alarm_step(active.get(k), v, 100.0, 250.0)
        expected += [(k, t, *event)] if event else []
    for n in (1, 7, 1000):
        found = telemetry.alarms(df, "k", "t", "v", "s", 100.0, 250.0, segment_rows=n)
        assert sorted((r["k"], r["event_ts"], r["alarm_type"], r["state"]) for r in found.collect()) == sorted(expected)
    scores = lambda n: sorted((r["k"], r["t"], r["baseline"], r["zscore"]) for r in windows.rolling_zscore(df, "k", ["t"], "v", rows=5, threshold=1.0, segment_rows=n).collect())
    assert len(scores(1000)) > 20 and scores(3) == scores(7) == scores(1000)


def test_search_index(spark, tmp_path):
    from gneiss.operators import search

    docs = spark.createDataFrame([(1, "The pump house pump"), (2, "a valve-7 by the pump house"), (3, None), (4, "nothing else here"), (5, "the pump house pump")], "k int, text string")
    one, many = f"file://{tmp_path}/one", f"file://{tmp_path}/many"
    search.build_index(docs.coalesce(1), "k", "text", one)
    search.build_index(docs.repartition(3), "k", "text", many, segment_tokens=2)
    found = [[tuple(r) for r in search.search(spark, f, "pump House, the unknown", 3).collect()] for f in (one, many)]
    assert found[0] == found[1] and [k for k, _ in found[0]] == [1, 5, 2] and found[0][0][1] == found[0][1][1]
    assert search.search(spark, one, "unknown words").count() == 0
    search.build_index(docs.where("false"), "k", "text", f"file://{tmp_path}/none")
    assert search.search(spark, f"file://{tmp_path}/none", "pump").count() == 0


def test_search_terms_by_bytes():
    """Tokens, pairs and counts of a segment equal those of the pattern, in the order of terms."""
    import numpy as np
    import pyarrow as pa

    from gneiss.operators import search

    rnd = random.Random(7)
    texts = ["", "a", "-", "--ab-", "a-", "-a", "ab", "b-\u00e9-c--d1", *("".join(rnd.choices("ab1-- \u00e9.", k=rnd.randrange(40))) for _ in range(300)), "ab-"]
    column = pa.array(["xx", *texts]).slice(1)
    tokens, lengths = search._tokens(column)
    assert tokens.to_pylist() == [t for x in texts for t in search.TOKEN.findall(x)] and lengths.tolist() == [len(search.TOKEN.findall(x)) for x in texts]
    coded = tokens.dictionary_encode()
    docs = [i for i, n in enumerate(lengths) for _ in range(n)]
    rows = [r for b in search._postings(coded.dictionary, coded.indices.to_numpy().astype("int64"), np.array(docs), pa.array(range(len(texts)))) for r in b.to_pylist()]
    expected: dict[str, dict[int, int]] = {}
    for i, x in enumerate(texts):
        for t, n in search.terms_of(x).items():
            expected.setdefault(t, {})[i] = n
    assert [r["term"] for r in rows] == sorted(expected) and all(r["n"] == len(r["keys"]) for r in rows)
    assert {r["term"]: dict(zip(r["keys"], r["counts"], strict=True)) for r in rows} == expected
    assert [len(x) for x in search._tokens(pa.array([], pa.string()))] == [0, 0]


def test_stream_alarms_and_batch_folders(spark, tmp_path):
    from gneiss.streaming import telemetry

    path = f"file://{tmp_path}/alarms"
    src = tmp_path / "in"
    src.mkdir()
    for i, v in enumerate((120.0, 260.0, 50.0)):
        (src / f"{i}.json").write_text(json.dumps({"tag": "a", "ts": f"2026-01-01T00:0{i}:00", "value": v, "seq": i}))
        os.utime(src / f"{i}.json", (1_760_000_000 + i, 1_760_000_000 + i))  # files come in the order of their times
    stream = spark.readStream.schema("tag string, ts timestamp, value double, seq long").option("maxFilesPerTrigger", 1).json(str(src))
    events = telemetry.stream_alarms(stream, "tag", "ts", "value", "seq", 100.0, 250.0)
    sink = telemetry.batch_folders({"alarms": (lambda b: b.select("tag", "seq", "alarm_type", "state"), path)})
    events.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["seq"], r["alarm_type"], r["state"]) for r in spark.read.parquet(f"{path}/_b=*").collect()) == [(0, "HI", "ACTIVE"), (1, "HIHI", "ACTIVE"), (2, "HIHI", "CLEARED")]
