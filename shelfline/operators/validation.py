"""Declared constraints, checked in the pass that writes a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Constraint:
    """`holds` is a SQL condition on a row. A row fails where it is false; null holds unless `strict`."""

    name: str
    holds: str
    strict: bool = False

    def fails(self) -> Column:
        return ~F.coalesce(F.expr(self.holds), F.lit(not self.strict))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(column: str) -> Constraint:
    return Constraint(f"{column} is known", f"{column} is not null")


def within(column: str, low: float, high: float) -> Constraint:
    return Constraint(f"{column} from {low:g} to {high:g}", f"{column} between {low!r} and {high!r}")


def at_most(column: str, other: str) -> Constraint:
    return Constraint(f"{column} at most {other}", f"{column} <= {other}")


def one_of(column: str, values: list[str]) -> Constraint:
    return Constraint(f"{column} is listed", f"{column} in ({', '.join(map(_text, values))})")


def matches(column: str, pattern: str) -> Constraint:
    return Constraint(f"{column} has its form", f"rlike({column}, {_text(pattern)})")


#: Constraints of a cleaned catalog.
CATALOG_CONSTRAINTS = [
    not_null("product_id"), not_null("product_name"), not_null("main_category"), within("rating", 0, 5),
    within("discount_percentage", 0, 100), within("discounted_price", 0, 1_000_000_000), at_most("discounted_price", "actual_price"),
    matches("product_id", "^[A-Z0-9]+$"),
]


def _metrics(constraints: list[Constraint], key: str, witnesses: int) -> list[Column]:
    """The rows, each rule's failures, and the smallest failing key of each of `witnesses` classes of keys."""
    place = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 7), 16, 10).cast("int"), F.lit(witnesses))
    out = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(constraints):
        out.append(F.count_if(c.fails()).alias(f"failed_{i}"))
        out += [F.min(F.when(c.fails() & (place == w), F.col(key).cast("string"))).alias(f"witness_{i}_{w}") for w in range(witnesses)]
    return out


def observed(df: DataFrame, constraints: list[Constraint], key: str = "product_id", witnesses: int = 3) -> tuple[DataFrame, Observation]:
    """`df` unchanged, and the observation that its next action fills."""
    observation = Observation("constraints")
    return df.observe(observation, *_metrics(constraints, key, witnesses)), observation


def report(df: DataFrame, observation: Observation, constraints: list[Constraint], witnesses: int = 3) -> DataFrame:
    """(constraint, rows, failed, passed, witnesses) from a filled observation; a row per rule, up to `witnesses` keys each."""
    found = observation.get
    rows = []
    for i, c in enumerate(constraints):
        keys = [found[f"witness_{i}_{w}"] for w in range(witnesses)]
        rows.append((c.name, found["rows"], found[f"failed_{i}"], found[f"failed_{i}"] == 0, sorted(k for k in keys if k is not None)))
    return df.sparkSession.createDataFrame(rows, "constraint string, rows long, failed long, passed boolean, witnesses array<string>")


def validated_write(df: DataFrame, path: str, constraints: list[Constraint] = CATALOG_CONSTRAINTS, key: str = "product_id",
                    witnesses: int = 3, file_format: str = "parquet") -> DataFrame:
    """Write `df` and return the report of its constraints; both come from one scan of `df`."""
    watched, observation = observed(df, constraints, key, witnesses)
    watched.write.mode("overwrite").format(file_format).save(path)
    return report(df, observation, constraints, witnesses)
