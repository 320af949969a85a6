"""Restricted views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cardlake.fixed_values import READABLE_USER_COLUMNS, SECRET_USER_COLUMNS


def governed_view(
    users: DataFrame, name: str, allowed: Sequence[str] = READABLE_USER_COLUMNS
) -> DataFrame:
    """Expose only the allowed columns as a view.

    Names count without regard to case, as Spark resolves them. A list that names a secret column,
    or anything that is no column, is refused.
    """
    hidden = {c.lower() for c in SECRET_USER_COLUMNS}
    secret = sorted(c for c in allowed if c.lower() in hidden)
    if secret:
        raise PermissionError(f"not allowed in a view: {', '.join(secret)}")
    columns = {c.lower() for c in users.columns}
    unknown = sorted(c for c in allowed if c.lower() not in columns)
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    users.select(*allowed).createOrReplaceTempView(name)
    return users.sparkSession.table(name)
