"""

The operators read JSON as VARIANT so dynamic records keep unknown keys and
the difference between a missing key and a JSON ``null``.  When a stream has
a fixed layout, ``from_json`` with these schemas is the typed alternative.
Times are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()


def _s(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


APP_LOG = _s(
    ("common", _s(("mid", S), ("is_new", S))),
    ("ts", L),
    ("start", T.VariantType()),
    ("page", _s(("page_id", S), ("last_page_id", S))),
    ("displays", T.ArrayType(T.VariantType())),
)

STUDENT = _s(("name", S), ("age", I), ("student", _s(("name", S), ("age", I))))
