"""Constraint checks, good/bad split, key uniqueness and column defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the trades table.
PURCHASE_CHOICES = ["BUY", "SELL"]


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c}_not_null": F.col(c).isNotNull() for c in columns}


def in_list(column: str, allowed: Sequence[str]) -> dict[str, Column]:
    """CHECK (column IN ...): like SQL, an unknown (NULL) result satisfies the check."""
    return {f"{column}_in_list": F.coalesce(F.col(column).isin(*allowed), F.lit(True))}


def trade_constraints() -> dict[str, Column]:
    return not_null(
        "trade_id", "stock_name", "stock_price", "stock_purchase_choice", "trader_id", "created_at", "updated_at"
    ) | in_list("stock_purchase_choice", PURCHASE_CHOICES)


def with_violations(df: DataFrame, constraints: Mapping[str, Column], into: str = "violations") -> DataFrame:
    """Add an array with the names of the constraints each row breaks."""
    return df.withColumn(into, F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in constraints.items()])))


def split_rows(df: DataFrame, constraints: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: both stay lazy over the same scan; bad rows keep their reasons."""
    marked = with_violations(df, constraints)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def violation_counts(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """One row per constraint with the number of rows breaking it, in a single pass."""
    counts = df.agg(*[F.count_if(~ok).alias(name) for name, ok in constraints.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_bad")) for n in constraints]))
    return counts.select(pairs.alias("p")).select("p.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial counts: a hot key reaches the shuffle as one row per task)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill NULL or absent columns with their default expression."""
    return df.withColumns({c: F.coalesce(F.col(c), e) if c in df.columns else e for c, e in defaults.items()})


def trade_defaults(now: Column | None = None) -> dict[str, Column]:
    """Generated ids and the statement's time, as the trades table fills them in."""
    now = F.current_timestamp() if now is None else now
    return {"trade_id": F.uuid(), "trader_id": F.uuid(), "created_at": now, "updated_at": now}
