"""Foreign columns travel out of reach of the names that operators use inside."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def carrying(*added: str, named: tuple[str, ...] = ()) -> Callable:
    """An operator whose documents may have columns of any name.

    Operators begin names of their own columns with an underscore.  Columns of the documents that
    do so too travel as one struct and come back under their names and in their places, before the
    `added` ones.  `named` are parameters that name a column, which stays as it is.
    """

    def wrap(operator: Callable) -> Callable:
        @wraps(operator)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            used = {options.get(parameter) for parameter in named}
            names = [c for c in docs.columns if c not in added]
            clashing = [c for c in names if c.startswith("_") and c not in used]
            if not clashing:
                return operator(docs, *args, **options)
            plain = [c for c in names if c not in clashing]
            # Numbered fields: names of any form pass through schemas that are written as text.
            fields = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(clashing)]
            packed = "carried"
            while packed in {c.lower() for c in docs.columns}:
                packed += "1"
            rows = docs.select(*[f"`{c}`" for c in plain], F.struct(*fields).alias(packed))
            out = operator(rows, *args, **options)
            back = {c: F.col(f"{packed}.c{i}").alias(c) for i, c in enumerate(clashing)}
            return out.select(*[back.get(c, F.col(f"`{c}`")) for c in names], *added)

        return run

    return wrap
