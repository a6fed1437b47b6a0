"""Tables of another database through JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Types of which quantiles can be sketched, by the kind of sketch.
_SKETCHED = {
    "bigint": (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint),
    "double": (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double),
}


@dataclass(frozen=True)
class Split:
    """Cuts a JDBC read into parallel range queries on a numeric or date column."""

    column: str
    lower: int | str
    upper: int | str
    parts: int = 8


def jdbc_options(
    url: str,
    table: str,
    *,
    where: str | None = None,
    split: Split | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Options of the JDBC source; `where` is evaluated by the database."""
    source = table if where is None else f"(SELECT * FROM {table} WHERE {where}) selected_rows"
    options = {"url": url, "dbtable": source, "fetchsize": str(fetch_size), **connection}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **settings) -> DataFrame:
    """A JDBC table or part of it; `settings` are those of `jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **settings)).load()


def equal_depth(column: str, bounds: list[int | float]) -> list[str]:
    """Conditions of a database query that cut at `bounds` and hold of each row exactly once.

    NULLs are a part of their own, and there are no more parts than different bounds allow.
    """
    cuts = sorted(set(bounds))
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [
        f"{column} >= {low!r} AND {column} < {high!r}"
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]
    return [f"{column} < {cuts[0]!r}", *inner, f"{column} >= {cuts[-1]!r}", f"{column} IS NULL"]


def quantile_bounds(known: DataFrame, column: str, parts: int) -> list[int | float]:
    """Where to cut a numeric column into parts of about equally many rows.

    `known` is a copy that was loaded before, or any other rows of like distribution.  Tasks
    sketch their rows; one sketch of a few kB is what meets.
    """
    kind = "double" if known.schema[column].dataType.typeName() in ("float", "double") else "bigint"
    sketch, quantile = _SKETCHED[kind]
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    made = known.agg(sketch(F.col(column).cast(kind)).alias("sketch"), F.count(column).alias("n"))
    row = made.select(F.when(F.col("n") > 0, quantile("sketch", ranks)).alias("at")).first()
    return list(row["at"] or [])


def read_equal_depth(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    known: DataFrame,
    parts: int = 8,
    **connection: str,
) -> DataFrame:
    """A JDBC table read by tasks of about equally many rows, however skewed `column` is.

    A value that is in more rows than a part should have is not split.
    """
    conditions = equal_depth(column, quantile_bounds(known, column, parts))
    return spark.read.jdbc(url, table, predicates=conditions, properties=connection)
