"""Data rules over whole tables.

All rules of a table are counted in one aggregation pass. Each rule names the column it checks; the
same predicates give the violation counts, the failing check and the row-level quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardwarden.schema import DATE_FORMAT, LABEL, ROW_ID, TIMESTAMP_FORMAT, TRANSACTION_COLUMNS
from cardwarden.session import settle_table

# The accepted forms, ranges and codes.
REQUIRED_TEXT = ["merchant", "category", "first", "last", "street", "city", "job"]
PATTERNS = {
    "trans_date_trans_time": r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
    "cc_num": r"\d+",
    "state": r"[A-Z]{2}",
    "zip": r"\d{4,5}",
    "dob": r"\d{4}-\d{2}-\d{2}",
    "trans_num": r"[0-9a-f]{32}",
}
NON_NEGATIVE = [ROW_ID, "city_pop", "unix_time", "amt"]
CODES = {"gender": ["F", "M"], LABEL: [0, 1]}
RANGES = {
    "lat": (-90.0, 90.0),
    "merch_lat": (-90.0, 90.0),
    "long": (-180.0, 180.0),
    "merch_long": (-180.0, 180.0),
}


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    holds: Column

    @property
    def broken(self) -> Column:
        """True also where a missing value leaves the rule undecided."""
        return ~F.coalesce(self.holds, F.lit(False))


def whole_match(column: str, pattern: str) -> Column:
    """The whole text has to match; ``$`` would let a trailing line break through."""
    return F.col(column).cast("string").rlike(rf"\A(?:{pattern})\z")


def in_range(column: str, low: float, high: float) -> Column:
    value = F.col(column).try_cast("double")
    return value.between(low, high) & ~F.isnan(value)


def at_least_zero(column: str) -> Column:
    value = F.col(column)
    return (value >= 0) & ~F.isnan(value.cast("double"))


def calendar_time(column: str, fmt: str) -> Column:
    return F.try_to_timestamp(F.col(column), F.lit(fmt)).isNotNull()


def transaction_rules() -> list[Rule]:
    rules = [Rule("non_empty", c, whole_match(c, ".+")) for c in REQUIRED_TEXT]
    rules += [Rule("pattern", c, whole_match(c, p)) for c, p in PATTERNS.items()]
    rules += [Rule("non_negative", c, at_least_zero(c)) for c in NON_NEGATIVE]
    rules += [Rule("allowed_values", c, F.col(c).isin(v)) for c, v in CODES.items()]
    rules += [Rule("range", c, in_range(c, *bounds)) for c, bounds in RANGES.items()]
    rules += [
        Rule("calendar", "trans_date_trans_time", calendar_time("trans_date_trans_time", TIMESTAMP_FORMAT)),
        Rule("calendar", "dob", calendar_time("dob", DATE_FORMAT)),
    ]
    return rules


def request_rules() -> list[Rule]:
    """Scoring requests: every field present, a few of them checked for their value."""
    fields = [c for c in TRANSACTION_COLUMNS if c not in (ROW_ID, "trans_date_trans_time", LABEL)]
    rules = [Rule("required", c, F.col(c).isNotNull()) for c in fields]
    rules += [Rule("non_negative", c, at_least_zero(c)) for c in ("amt", "city_pop", "unix_time")]
    rules += [
        Rule("pattern", "gender", whole_match("gender", "[FM]")),
        Rule("pattern", "state", whole_match("state", "[A-Z]{2}")),
    ]
    rules += [Rule("range", c, in_range(c, *bounds)) for c, bounds in RANGES.items()]
    return rules


def column_contract(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Expected and actual column per position; needs no data."""
    expected = expected or TRANSACTION_COLUMNS
    actual = df.columns
    rows = [
        (i, expected[i] if i < len(expected) else None, actual[i] if i < len(actual) else None)
        for i in range(max(len(expected), len(actual)))
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, expected string, actual string"
    ).withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def violations(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Rows ``(rule, column_name, violations)``, all counted in one pass."""
    rules = rules or transaction_rules()
    counted = df.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)])
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column_name"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def store_checked(df: DataFrame, name: str, measures: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` below the shared folder and check it by that write, so that its source is read once.

    Rule violations and the given aggregates are observed while the rows pass. Returns the stored table and the
    aggregates with ``rows``; a breach is the same error as in :func:`enforce`, and the stored table is not handed on.
    """
    if [c for c in df.columns if c in TRANSACTION_COLUMNS] != TRANSACTION_COLUMNS:
        raise ValueError(f"columns differ: expected {TRANSACTION_COLUMNS}, got {df.columns}")
    rules, seen = transaction_rules(), Observation()
    counts = [F.count_if(r.broken).alias(f"rule_{i}") for i, r in enumerate(rules)]
    extra = [c.alias(n) for n, c in (measures or {}).items()]
    stored = settle_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, *extra), name)
    found = seen.get
    for i, rule in enumerate(rules):
        _refuse(rule.name, rule.column, found[f"rule_{i}"])
    return stored, {n: found[n] for n in ("rows", *(measures or {}))}


def _refuse(rule: str, column: str, rows: int) -> None:
    if rows:
        raise ValueError(f"column '{column}' breaks rule '{rule}' in {rows} rows")


def enforce(df: DataFrame) -> DataFrame:
    """``df`` itself if it satisfies the contract, otherwise an error naming the first breach."""
    if df.columns != TRANSACTION_COLUMNS:
        raise ValueError(f"columns differ: expected {TRANSACTION_COLUMNS}, got {df.columns}")
    broken = violations(df).where("violations > 0").collect()  # at most one row per rule
    if broken:
        _refuse(broken[0]["rule"], broken[0]["column_name"], broken[0]["violations"])
    return df


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Append ``reasons`` (``rule:column`` of every broken rule) and ``valid``."""
    reasons = F.array_compact(
        F.array(*[F.when(r.broken, F.lit(f"{r.name}:{r.column}")) for r in rules])
    )
    return df.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


def quarantine(df: DataFrame, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their reasons."""
    checked = with_reasons(df, rules or transaction_rules())
    return (
        checked.where("valid").drop("reasons", "valid"),
        checked.where("NOT valid").drop("valid"),
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, and over all columns as ``(total)``."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0).cast("bigint"))
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    entries.append(F.struct(F.lit("(total)").alias("column_name"), total.alias("nulls")))
    return counted.select(F.inline(F.array(*entries)))


def filled_counts(df: DataFrame) -> DataFrame:
    """Rows with a value, per column."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in df.columns]
    return counted.select(F.inline(F.array(*entries)))
