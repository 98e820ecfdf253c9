"""Prompts and parameter grids."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed


def build_prompt(question: Column, contexts: Column, system: Column | str | None = None) -> Column:
    """Prompt text from a question and its ordered (pid, passage) contexts."""
    if system is None or isinstance(system, str):
        system = F.lit(system or fixed.SYSTEM_PROMPT)
    blocks = F.transform(
        contexts,
        lambda c: F.concat(
            F.lit("["), c["pid"].cast("string"), F.lit("] "), F.coalesce(c["passage"], F.lit(""))
        ),
    )
    listed = F.coalesce(F.array_join(blocks, "\n\n"), F.lit(""))
    return F.concat(
        system, F.lit("\n\nContext:\n"), listed, F.lit("\n\nQuestion: "), question,
        F.lit("\nAnswer:"),
    )


def first_rows(df: DataFrame, n: int, *order_by: Column) -> DataFrame:
    """The first n rows in a stated order; n of zero or less means all rows."""
    return df.orderBy(*order_by).limit(n) if n > 0 else df


def expand_grid(df: DataFrame, **choices) -> DataFrame:
    """Repeat every row for each combination of the given parameter values.

    The combinations are a literal array, so rows are expanded in place without a join.
    """
    names = list(choices)
    combinations = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, values)])
        for values in product(*choices.values())
    ]
    expanded = df.withColumn("_variant", F.explode(F.array(*combinations)))
    return expanded.select(*df.columns, *[F.col("_variant")[n].alias(n) for n in names])
