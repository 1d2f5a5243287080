"""Record contracts: JSON descriptions compiled to schemas and to columns of reject and warning codes."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.columns import blank_to_null, record_hash, record_json, typed


@dataclass(frozen=True)
class Field:
    """A column of a contract. severity: what a failed pattern or allowed check does; ``minimum`` always rejects unless told."""

    name: str
    kind: str = "string"
    required: bool = False
    pattern: str | None = None
    allowed: tuple[str, ...] = ()
    minimum: float | None = None
    formats: tuple[str, ...] = ()
    severity: str | None = None


@dataclass(frozen=True)
class Contract:
    entity: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    control_field: str | None = None
    options: dict = field(default_factory=dict, compare=False)

    @classmethod
    def parse(cls, text: str) -> Contract:
        raw = json.loads(text)
        fields = tuple(
            Field(c["name"], c.get("type", "string"), c.get("required", False), c.get("pattern"), tuple(c.get("allowed", ())), c.get("min"), tuple(c.get("formats", [c["format"]] if "format" in c else [])), c.get("severity"))
            for c in raw.get("columns") or raw.get("fields")
        )
        key = raw.get("key", [])
        return cls(raw.get("entity") or raw.get("table"), tuple([key] if isinstance(key, str) else key), fields, raw.get("control_field"), raw)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


_CODES = {"int": "NOT_INTEGER", "bigint": "NOT_INTEGER", "double": "NOT_NUMBER", "decimal": "NOT_NUMBER", "date": "INVALID_DATE", "timestamp": "INVALID_TIMESTAMP"}


def checks(contract: Contract, all_reject: bool = False) -> tuple[list[Column], list[Column]]:
    """(reject codes, warning codes), each null where its check holds. In streams every failed check rejects."""
    reject, warn = [], []
    for f in contract.fields:
        value = blank_to_null(F.col(f.name))
        code = lambda bad, what: F.when(bad, F.lit(f"{f.name}:{what}"))  # noqa: B023, E731
        if f.required:
            reject.append(code(value.isNull(), "REQUIRED"))
        if f.kind in _CODES:
            reject.append(code(value.isNotNull() & typed(F.col(f.name), f.kind, f.formats).isNull(), _CODES[f.kind]))
        soft = reject if all_reject or f.severity == "reject" else warn
        if f.pattern:
            soft.append(code(value.isNotNull() & ~value.rlike(f.pattern), "PATTERN"))
        if f.allowed:
            soft.append(code(value.isNotNull() & ~value.isin(*f.allowed), "NOT_ALLOWED"))
        if f.minimum is not None:
            (warn if f.severity == "warn" else reject).append(code(typed(F.col(f.name), "double") < f.minimum, "BELOW_MIN"))
    return reject, warn


def reasons(codes: list[Column]) -> Column:
    """The codes that fired, in order; an empty array of strings if none."""
    return F.array_compact(F.array(*codes)) if codes else F.array().cast("array<string>")


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Adds _reject_reasons, _warnings (a repeated key in the batch warns) and _record_hash.

    Keys are counted with partial sums and only repeated ones are joined back, so that one key, or none, on many rows is
    no task of its own.
    """
    reject, warn = checks(contract)
    columns = df.columns
    if contract.key:
        own = {f"_key{i}": F.col(c) for i, c in enumerate(contract.key)}
        counted = df.groupBy(*(c.alias(k) for k, c in own.items())).agg(F.count(F.lit(1)).alias("_n"))
        repeated = counted.where("_n > 1").withColumn("_again", F.lit(True)).drop("_n")
        df = df.join(repeated, reduce(lambda a, b: a & b, (c.eqNullSafe(F.col(k)) for k, c in own.items())), "left")
        warn = [*warn, F.when(F.col("_again"), F.lit(f"{'+'.join(contract.key)}:DUPLICATE_IN_BATCH"))]
    found = {"_reject_reasons": reasons(reject), "_warnings": reasons(warn), "_record_hash": record_hash(contract.names)}
    return df.withColumns(found).select(*columns, *found)


def split(validated: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine rows with the record as JSON)."""
    good = validated.where(F.size("_reject_reasons") == 0).drop("_reject_reasons")
    bad = validated.where(F.size("_reject_reasons") > 0)
    return good, bad.select(F.lit(contract.entity).alias("_entity"), "_reject_reasons", "_warnings", record_json(contract.names).alias("_record"), "_record_hash")


def reject_histogram(quarantine: DataFrame, reasons_col: str = "_reject_reasons", most: int = 5) -> DataFrame:
    """The most frequent reasons; ties by name."""
    counts = quarantine.select(F.explode(reasons_col).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "reason").limit(most)


def typed_columns(contract: Contract) -> list[Column]:
    return [typed(F.col(f.name), f.kind, f.formats).alias(f.name) for f in contract.fields]


def parse_stream(df: DataFrame, contract: Contract, value_col: str = "value") -> DataFrame:
    """JSON messages as typed columns, ``payload`` and ``reject_reasons``; text that is no JSON object is MALFORMED_JSON."""
    schema = ", ".join(f"`{n}` string" for n in [*contract.names, "producer_run", "_corrupt"])
    m = F.from_json(F.col(value_col), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    rest = [c for c in df.columns if c != value_col]
    rows = df.select(*rest, F.col(value_col).alias("payload"), m.alias("m"))
    rows = rows.select(
        *rest, "payload", *(F.col("m")[n].alias(n) for n in contract.names), F.col("m")["producer_run"].alias("producer_run"),
        (F.col("payload").isNull() | F.col("m")["_corrupt"].isNotNull() | ~F.col("payload").rlike(r"^\s*\{")).alias("_bad"),
    )
    reject, _ = checks(contract, all_reject=True)
    found = F.when(F.col("_bad"), F.array(F.lit("value:MALFORMED_JSON"))).otherwise(reasons(reject))
    return rows.withColumn("reject_reasons", found).select(*rest, "payload", *typed_columns(contract), "producer_run", "reject_reasons")


def require_completed(audit: DataFrame, stage: str, batch_id: str) -> None:
    """Refuse to go on unless the newest run state of an upstream stage is COMPLETED."""
    states = audit.where((F.col("stage") == stage) & (F.col("batch_id") == batch_id) & F.col("status").isin("STARTED", "COMPLETED", "FAILED"))
    newest = states.orderBy(F.desc("at")).select("status").first()
    if newest is None or newest[0] != "COMPLETED":
        raise RuntimeError(f"{stage} of {batch_id} is {newest[0] if newest else 'missing'}, not COMPLETED")
