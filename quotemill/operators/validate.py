"""Validation: clean a table and report what was found.

``clean`` gives the cleaned rows, ``report`` the findings as rows (level, rule, detail,
count), both lazily. The findings are an aggregation of their own and not metrics observed
while the cleaned rows are written: observed metrics count a map task twice when a lost
executor makes Spark run it again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .keyed import keep_one

Range = tuple[float | None, float | None]


@dataclass(frozen=True)
class Rules:
    """What to check, in this order: required columns, null keys, duplicates, blanks, ranges."""

    required: Sequence[str] = ()
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    order: Sequence[str] = ()  # arrival order of rows; needed where rows of a key differ
    keep: str = "last"
    strip: bool = False
    ranges: dict[str, Range] = field(default_factory=dict)


# Names, columns and limits of the presets.
DAILY = Rules(
    required=("symbol", "date", "close"),
    not_null=("symbol", "date"),
    unique=("symbol", "date"),
    strip=True,
    ranges={"close": (0.001, None), "volume": (0.0, None), "amount": (0.0, None)},
)
BASIC = Rules(required=("symbol", "name"), not_null=("symbol",), unique=("symbol",), strip=True)
PRESETS = {"daily": DAILY, "basic": BASIC}


Spec = str | dict | list | Rules


def rules_from(spec: Spec) -> list[Rules]:
    """Rules from a preset name, a dict (required, dedup_keys, ranges) or a list of these.

    The members of a list run one after the other.
    """
    if isinstance(spec, Rules):
        return [spec]
    if isinstance(spec, str):
        if spec not in PRESETS:
            raise ValueError(f"unknown preset {spec!r}, known are {sorted(PRESETS)}")
        return [PRESETS[spec]]
    if isinstance(spec, dict):
        rules = Rules(
            required=tuple(spec.get("required", ())),
            unique=tuple(spec.get("dedup_keys", ())),
            order=tuple(spec.get("order", ())),
            ranges=dict(spec.get("ranges", {})),
        )
        return [rules]
    return [rules for part in spec for rules in rules_from(part)]


def with_order(spec: Spec, order: Sequence[str]) -> list[Rules]:
    return [replace(rules, order=tuple(order)) for rules in rules_from(spec)]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    present = [k for k in keys if k in df.columns]
    return df.dropna(subset=present) if present else df


def strip_strings(df: DataFrame) -> DataFrame:
    """Trim every text column; null stays null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.trim(F.col(c)) for c in texts}) if texts else df


def deduplicate(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key. Rows have no arrival order in Spark, so ``order`` names it; without
    it the remaining columns decide, which is arbitrary but the same on every run."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    order = list(order) or [c for c in df.columns if c not in present]
    if not order:
        return df.distinct()
    return keep_one(df, present, order, keep)


def out_of_range(column: str, limits: Range) -> Column:
    """Null, not a number or outside [low, high]."""
    low, high = limits
    number = F.col(column).try_cast("double")
    tests = [number.isNotNull(), ~F.isnan(number)]
    if low is not None:
        tests.append(number >= low)
    if high is not None:
        tests.append(number <= high)
    return ~F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def flag_ranges(df: DataFrame, ranges: dict[str, Range]) -> DataFrame:
    """A boolean ``<column>_bad`` per checked column; no row is dropped."""
    flags = {f"{c}_bad": out_of_range(c, lim) for c, lim in ranges.items() if c in df.columns}
    return df.withColumns(flags) if flags else df


def clean(df: DataFrame, spec: Spec) -> DataFrame:
    for rules in rules_from(spec):
        df = drop_null_keys(df, rules.not_null)
        df = deduplicate(df, rules.unique, rules.order, rules.keep) if rules.unique else df
        df = strip_strings(df) if rules.strip else df
    return df


def _limits_text(limits: Range) -> str:
    return "[" + ", ".join("-" if x is None else f"{x:g}" for x in limits) + "]"


def _findings(counts: DataFrame, df: DataFrame, rules: Rules) -> DataFrame:
    """One row of counts to one row per finding with a count above zero."""
    keys = [k for k in rules.not_null if k in df.columns]
    unique = [k for k in rules.unique if k in df.columns]
    rows = []

    def add(level: str, rule: str, detail: str, count: Column) -> None:
        rows.append(F.struct(
            F.lit(level).alias("level"), F.lit(rule).alias("rule"),
            F.lit(detail).alias("detail"), count.cast("bigint").alias("count"),
        ))

    missing = missing_columns(df, rules.required)
    if missing:
        add("error", "missing_columns", ", ".join(missing), F.lit(len(missing)))
    if keys:
        add("warn", "null_keys", ", ".join(keys), F.col("null_keys"))
    if rules.unique and not unique:
        add("warn", "dedup_skipped", ", ".join(rules.unique), F.lit(1))
    if unique:
        add("warn", "dedup", ", ".join(unique),
            F.col("rows_before") - F.col("null_keys") - F.col("rows_after"))
    for c, limits in rules.ranges.items():
        if c in df.columns:
            # an all-null column is not reported, it was never delivered
            bad = F.when(F.col(f"some_{c}") > 0, F.col(f"bad_{c}")).otherwise(0)
            add("warn", "range", f"{c} {_limits_text(limits)}", bad)
    add("warn", "total_dropped", "rows", F.col("rows_before") - F.col("rows_after"))
    return counts.select(F.inline(F.array(*rows))).where(F.col("count") > 0)


def report(df: DataFrame, spec: Spec) -> DataFrame:
    """Findings (level, rule, detail, count) of all rules, with one total of dropped rows."""
    stages = rules_from(spec)
    if len(stages) == 1:
        return _report(df, stages[0])
    findings = None
    for i, rules in enumerate(stages):
        stage = _report(clean(df, stages[:i]), rules)
        findings = stage if findings is None else findings.unionByName(stage)
    total = F.col("rule") == "total_dropped"
    dropped = findings.where(total).groupBy("level", "rule", "detail").agg(F.sum("count").alias("count"))
    return findings.where(~total).unionByName(dropped)


def _report(df: DataFrame, rules: Rules) -> DataFrame:
    """Findings of one set of rules, in one scan and one shuffle.

    Rows are first counted per key, partially before the shuffle; of the row that would be
    kept only a bit mask of its range checks travels.
    """
    keys = [k for k in rules.not_null if k in df.columns]
    unique = [k for k in rules.unique if k in df.columns]
    checked = [c for c in rules.ranges if c in df.columns]
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    mask = F.lit(0)
    for i, c in enumerate(checked):
        number = F.col(c).try_cast("double")
        is_number = number.isNotNull() & ~F.isnan(number)
        mask = mask + F.when(out_of_range(c, rules.ranges[c]), 1 << (2 * i)).otherwise(0)
        mask = mask + F.when(is_number, 2 << (2 * i)).otherwise(0)

    def per_row(weight: Column, bits: Column, dropped: Column) -> list[Column]:
        zero = F.lit(0).cast("bigint")
        out = [
            F.coalesce(F.sum(weight), zero).alias("rows_before"),
            F.coalesce(F.sum(F.when(dropped, weight)), zero).alias("null_keys"),
            F.count_if(~dropped).alias("rows_after"),
        ]
        for i, c in enumerate(checked):
            out.append(F.count_if(~dropped & (bits.bitwiseAND(1 << (2 * i)) > 0)).alias(f"bad_{c}"))
            out.append(F.count_if(~dropped & (bits.bitwiseAND(2 << (2 * i)) > 0)).alias(f"some_{c}"))
        return out

    if unique:
        order = list(rules.order) or [c for c in df.columns if c not in unique]
        if rules.keep == "last":
            pick, rank = F.max_by, F.struct(*order) if len(order) != 1 else F.col(order[0])
        else:  # nulls come last in arrival order
            pick, rank = F.min_by, F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
        # a null key may differ from the dedup key, so the drop is part of the group
        groups = df.withColumns({"_mask": mask, "_null": null_key}).groupBy(*unique, "_null").agg(
            F.count(F.lit(1)).alias("_n"),
            F.coalesce(pick("_mask", rank), F.max("_mask")).alias("_mask"),
        )
        counts = groups.agg(*per_row(F.col("_n"), F.col("_mask"), F.col("_null")))
    else:
        counts = df.select(mask.alias("_mask"), null_key.alias("_null")).agg(
            *per_row(F.lit(1).cast("bigint"), F.col("_mask"), F.col("_null"))
        )
    return _findings(counts, df, rules)


def is_ok(findings: list[dict]) -> bool:
    return not any(f["level"] == "error" for f in findings)


def summary_line(findings: list[dict]) -> str:
    if not findings:
        return "clean"
    return ", ".join(f"{f['level']} {f['rule']}: {f['detail']} (n={f['count']})" for f in findings)
