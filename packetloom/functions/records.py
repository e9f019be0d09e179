"""Opaque payloads to typed rows: a table function whose columns follow from its arguments.

Payloads whose shape is known at every row are better read with ``from_json``; this is for
payloads that hold a record, a list of records or of scalars, or a table (a map of columns),
and differ from row to row.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql.types import (
    BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
)
from pyspark.sql.udtf import AnalyzeResult

# Workers get the function below with the plan and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "payload_records"
VALUE = "value"
_WHOLE = {ShortType: 1 << 15, IntegerType: 1 << 31, LongType: 1 << 63}
# The worker that plans a call has no session to read a schema text with.
_KINDS = {
    "smallint": ShortType(), "int": IntegerType(), "bigint": LongType(), "float": FloatType(), "double": DoubleType(),
    "boolean": BooleanType(), "string": StringType(),
}


def parsed(text):
    """The records of a payload: a list of dicts. Text that is no JSON is one scalar record."""
    if text is None:
        return []
    try:
        found = json.loads(text)
    except ValueError:
        return [{VALUE: text}]
    if isinstance(found, list):
        return [r if isinstance(r, dict) else {VALUE: r} for r in found]
    if isinstance(found, dict):
        columns = list(found.values())
        if columns and all(isinstance(c, list) for c in columns):
            return [
                {name: c[k] if k < len(c) else None for name, c in found.items()} for k in range(max(map(len, columns)))
            ]
        return [found]
    return [{VALUE: found}]


def typed(value, kind):
    """A JSON value as a column's type; null where it does not fit."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(value, (bool, list, dict)):
        return None
    try:
        if isinstance(kind, (DoubleType, FloatType)):
            return float(value)
        most = _WHOLE[type(kind)]
        whole = int(value)
        return whole if whole == float(value) and -most <= whole < most else None
    except (ValueError, OverflowError):
        return None


class PayloadRecords:
    """``payload_records(payload, columns)``: one row per record of the payload.

    ``columns`` is a constant such as ``'k INT, name STRING'``; a record that is a scalar has
    the one column ``value``. ``nth`` counts the records of a payload from 0.
    """

    @staticmethod
    def analyze(payload, columns):
        if not columns.isConstantExpression or columns.value is None:
            raise ValueError("the columns must be a constant text")
        fields = [StructField("nth", IntegerType())]
        for part in columns.value.split(","):
            name, _, kind = part.strip().partition(" ")
            if kind.strip().lower() not in _KINDS:
                raise ValueError(f"{part.strip()!r}: a column is a name and one of {', '.join(_KINDS)}")
            fields.append(StructField(name, _KINDS[kind.strip().lower()]))
        return AnalyzeResult(StructType(fields))

    def __init__(self, analyzed):
        self.fields = analyzed.schema.fields[1:]

    def eval(self, payload, columns):
        for nth, record in enumerate(parsed(payload)):
            yield (nth, *(typed(record.get(f.name), f.dataType) for f in self.fields))


def register(spark, name: str = NAME) -> None:
    """Makes the function known to the session's SQL."""
    from pyspark.sql.functions import udtf

    spark.udtf.register(name, udtf(PayloadRecords))
