"""Does a table keep the promises of its contract?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import GOLD_CONTRACT, Contract


def unheld(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """The source has a value that the target type cannot hold (NaN and infinity among them)."""
    return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def _rules(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Each rule's violation, from source and target value side by side.

    A column is missing only if its source is; a known value that does not fit breaks the range rule instead. Columns
    that have the target's type already cannot break it.
    """
    rules = {f"{c}_not_null": F.col(c).isNull() for c in contract.required}
    for name, width in contract.max_length.items():
        rules[f"{name}_max_length"] = F.length(name) > width
    for f in contract.schema.fields:
        if f.name in df.columns and isinstance(f.dataType, T.DecimalType):
            rules[f"{f.name}_in_range"] = unheld(df, f.name, f.dataType)
    for name in contract.counts:
        rules[f"{name}_in_range"] = unheld(df, name, contract.schema[name].dataType)
    return rules


def check_contract(df: DataFrame, contract: Contract = GOLD_CONTRACT) -> DataFrame:
    """(rule, violations) for every rule of the contract, over rows before they are cast to it.

    All rules are counted in one pass: rows are first counted by key, with the rules' counts beside, which
    also reduces copies of a key before the shuffle.
    """
    rules = _rules(df, contract)
    per_key = df.groupBy(*contract.key).agg(
        F.count("*").alias("_copies"), *[F.count_if(cond).alias(name) for name, cond in rules.items()]
    )
    counted = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("key_unique"),
    )
    names = ", ".join(f"'{n}', `{n}`" for n in [*rules, "key_unique"])
    return counted.selectExpr(f"stack({len(rules) + 1}, {names}) AS (rule, violations)")


def breaches(df: DataFrame, contract: Contract = GOLD_CONTRACT) -> DataFrame:
    """The rows that break a column rule, with the names of the rules in ``broken``: their dead letters."""
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in _rules(df, contract).items()]), lambda r: r.isNotNull())
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def apply_defaults(df: DataFrame, contract: Contract = GOLD_CONTRACT) -> DataFrame:
    """Fill the columns that have a default."""
    return df.fillna({k: v for k, v in contract.defaults.items() if k in df.columns})


def evolution_errors(old: T.StructType, new: T.StructType) -> list[str]:
    """Why ``new`` may not replace ``old``: tables may gain columns, never lose or retype them."""
    have = {f.name: f.dataType for f in new.fields}
    errors = []
    for f in old.fields:
        if f.name not in have:
            errors.append(f"column {f.name} is gone")
        elif have[f.name] != f.dataType:
            errors.append(
                f"column {f.name} changed from {f.dataType.simpleString()} "
                f"to {have[f.name].simpleString()}"
            )
    return errors
