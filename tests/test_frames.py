import numpy as np

from gneiss.operators import frames


def test_frames(spark):
    rng = np.random.default_rng(0)
    sharp = rng.integers(0, 200, (256, 300, 3)).astype(np.uint8)
    dark = np.zeros((256, 300, 3), np.uint8)
    bright = np.full((100, 100, 3), 255, np.uint8)
    df = spark.createDataFrame([(i, x.shape[0], x.shape[1], bytearray(x.tobytes())) for i, x in enumerate((sharp, dark, bright))], "id int, height int, width int, pixels binary")
    rows = frames.frame_checks(frames.frame_rows(df, "id")).orderBy("id").collect()
    assert rows[0]["failed_checks"] == [] and len(rows[0]["features"]) == 49
    assert rows[1]["failed_checks"] == ["TOO_DARK", "LOW_CONTRAST", "BLURRED"]
    assert rows[2]["failed_checks"] == ["TOO_SMALL", "TOO_BRIGHT", "LOW_CONTRAST", "BLURRED", "GLARE"]
    p = frames.linear_scores(frames.frame_rows(df, "id"), np.zeros(49), 0.0).first()["p_severe"]
    assert p == 0.5


def test_feedback(spark):
    labels = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "frame string, at int, label string")
    tests = spark.createDataFrame([("b",)], "frame string")
    assert [(r["frame"], r["label"]) for r in frames.feedback(labels, tests, "frame", "at").collect()] == [("a", "y")]
