"""Column expressions: typing, normalising, hashing, masking, distances, scores and bands. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
BAR_TO_PSI = 14.5038
#: Weights of the criticality classes in the rule score.
CRITICALITY = {"A": 1.0, "B": 0.6, "C": 0.3}
DATE_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy")
SEPARATOR, NULL_TEXT = "\u0001", "\u0000"


def lookup(key: Column, table: dict, default=None) -> Column:
    """A small constant map applied to a key; null or the default for keys not in it."""
    found = F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def typed(text: Column, kind: str, formats: Sequence[str] = ()) -> Column:
    """A source string as its contract type; a value that does not parse is null. Formats are tried in order."""
    value = blank_to_null(text)
    if kind == "date":
        return F.coalesce(*(F.try_to_timestamp(value, F.lit(f)).cast("date") for f in formats or DATE_FORMATS))
    if kind == "timestamp":
        return F.coalesce(*(F.try_to_timestamp(value, F.lit(f)) for f in formats)) if formats else F.try_to_timestamp(value)
    names = {"int": "int", "bigint": "bigint", "double": "double", "decimal": "decimal(18,2)", "boolean": "boolean", "string": "string"}
    return value.try_cast(names[kind])


def norm_tag(text: Column) -> Column:
    """Upper case, without a point suffix (.PV .SP .OP .MV); runs of blanks, slashes, underscores and dashes as one dash."""
    bare = F.regexp_replace(F.upper(F.trim(text)), r"\.(PV|SP|OP|MV)$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"[\s_/]+", "-"), "-+", "-")


def match_key(name: Column) -> Column:
    """One key for all namings of an asset: PL03-001 for pipe segments, W01 for wells, 101A for loop numbers, else the bare name."""
    bare = F.regexp_replace(F.upper(F.trim(name)), r"^(?:PI|TI|VI|CP)-(.+?)(?:\.(?:PV|SP|OP|MV))?$", "$1")
    bare = F.regexp_replace(bare, r"^(?:REF-U\d+|FLD-\d+)-", "")
    loop = F.regexp_extract(bare, r"^(?:[A-Z]{1,3}-?)?(\d{3}[AB]?)$", 1)
    return (
        F.when(bare.rlike(r"^PL-?\d{2}-?SEG-?\d{3}$"), F.regexp_replace(bare, r"^PL-?(\d{2})-?SEG-?(\d{3})$", "PL$1-$2"))
        .when(bare.rlike(r"^PL\d{2}-\d{3}$"), bare)
        .when(bare.rlike(r"^W-?\d{2}$"), F.replace(bare, F.lit("-"), F.lit("")))
        .when(loop != "", loop)
        .when(bare != "", bare)
    )


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns' texts in order; nulls and neighbouring values cannot be confused."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def record_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def masked(column: str, rule: str) -> Column:
    """HASH: a SHA-256; NULL: nothing; MASK: letters become x and digits n."""
    value = F.col(column).cast("string")
    if rule == "HASH":
        return F.sha2(value, 256).alias(column)
    if rule == "NULL":
        return F.lit(None).cast("string").alias(column)
    if rule == "MASK":
        return F.mask(value, F.lit("x"), F.lit("x"), F.lit("n")).alias(column)
    raise ValueError(f"unknown masking rule {rule}")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a1, o1, a2, o2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def to_psi(value: Column, unit: Column) -> Column:
    return F.when(unit == "bar", value * BAR_TO_PSI).otherwise(value)


def rule_score(wall_loss: Column, previous: Column, breaches: Column, corrective: Column, overdue_days: Column, cui: Column, coating: Column, criticality: Column) -> Column:
    """0 to 100: capped shares of wall loss, its trend, breaches, corrective orders and delay, scaled by criticality."""
    zero = F.lit(0.0)
    loss = F.coalesce(wall_loss, zero)
    capped = [
        (35.0, loss * 1.2),
        (10.0, 2 * F.greatest(zero, loss - F.coalesce(previous, loss))),
        (20.0, F.coalesce(breaches, zero) * 0.5),
        (10.0, F.coalesce(corrective, zero) * 3.0),
        (10.0, F.greatest(zero, overdue_days) / 30.0),
        (5.0, F.when(cui == "YES", 5.0).otherwise(0.0)),
        (5.0, F.when(coating == "POOR", 5.0).otherwise(0.0)),
    ]
    total = reduce(lambda a, b: a + b, [F.least(F.lit(cap), part) for cap, part in capped])
    return F.least(F.lit(100.0), total * (0.6 + 0.4 * lookup(criticality, CRITICALITY, CRITICALITY["C"])))


def risk_band(score: Column) -> Column:
    return F.when(score >= 40, "HIGH").when(score >= 20, "MEDIUM").otherwise("LOW")


def policy_band(p: Column, threshold: float, p1: float, margin: float, inputs_ok: Column, criticality: Column | None = None) -> Column:
    """P1, P2, P3, UNCERTAIN near the threshold, NA without a score or with failed inputs; class A is raised to P2 at least."""
    band = F.when(p >= p1, "P1").when(F.abs(p - threshold) < margin, "UNCERTAIN").when(p >= threshold, "P2").otherwise("P3")
    if criticality is not None:
        band = F.when((criticality == "A") & band.isin("P3", "UNCERTAIN"), "P2").otherwise(band)
    return F.when(p.isNull() | ~F.coalesce(inputs_ok, F.lit(False)), "NA").otherwise(band)


def recon_status(expected: Column, actual: Column, explained: Column | None = None, tolerance: float = 0.005) -> Column:
    """MATCHED within the tolerance, EXPLAINED if the known difference covers it, else MISMATCH."""
    gap = F.coalesce(expected, F.lit(0.0)) - F.coalesce(actual, F.lit(0.0))
    out = F.when(F.abs(gap) <= tolerance, "MATCHED")
    if explained is not None:
        out = out.when(F.abs(gap - F.coalesce(explained, F.lit(0.0))) <= tolerance, "EXPLAINED")
    return out.otherwise("MISMATCH")


def finding_severity(wall_loss: Column, coating: Column, corrosion: Column) -> Column:
    """severe from 20 % wall loss or for pitting under a poor coating; surface from 10 % or a fair or poor coating."""
    severe = (wall_loss >= 20.0) | ((coating == "POOR") & (corrosion == "PITTING"))
    return F.when(severe, "severe").when((wall_loss >= 10.0) | coating.isin("FAIR", "POOR"), "surface").otherwise("none")


def frame_severity(area: Column, boxes: Column, severe_area: float = 0.02, severe_boxes: int = 3) -> Column:
    return F.when(boxes == 0, "none").when((area >= severe_area) | (boxes >= severe_boxes), "severe").otherwise("surface")
