"""The order of columns in rows that are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DecimalType

_FIXED = ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz")


def _is_fixed(kind: DataType) -> bool:
    if isinstance(kind, DecimalType):
        return kind.precision <= 18
    return kind.typeName() in _FIXED


def quoted(names: Sequence[str]) -> list[str]:
    return ["`" + n.replace("`", "``") + "`" for n in names]


def narrow_first(df: DataFrame, varying: Sequence[str] = ()) -> DataFrame:
    """The columns as: fixed widths, texts, and last the texts whose lengths vary most.

    A row holds the place of each text beside its fixed values. A text shifts the places of all that stand
    behind it, so where the varying ones are last, those of the others are equal from row to row and a
    shuffle compresses them.
    """
    fixed = [f.name for f in df.schema if _is_fixed(f.dataType)]
    last = [c for c in dict.fromkeys(varying) if c in df.columns and c not in fixed]
    texts = [c for c in df.columns if c not in fixed and c not in last]
    return df.select(*quoted([*fixed, *texts, *last]))
