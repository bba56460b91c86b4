"""Column shapes shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

VALUE_T = "struct<kind:string,num:double,int:decimal(20,0),str:string,bool:boolean,json:string>"

# The same as a type object: UDFs are declared before any session exists.
VALUE_STRUCT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("num", T.DoubleType()),
        T.StructField("int", T.DecimalType(20, 0)),
        T.StructField("str", T.StringType()),
        T.StructField("bool", T.BooleanType()),
        T.StructField("json", T.StringType()),
    ]
)

POINTS = f"msg_id bigint, pos int, name string, value {VALUE_T}, ts_ns bigint, error string"

SERIES = (
    "measurement string, tags map<string,string>, "
    f"fields map<string,{VALUE_T}>, ts_ns bigint"
)


@dataclass(frozen=True)
class SeriesMapping:
    """How acquisition messages become series rows.

    ``measurement`` and tag values may hold ``${msg.x}`` / ``${metadata.x}``
    templates. ``fields`` are (stored key, source key) pairs; none keeps all.
    A blank measurement turns the mapping off.
    """

    measurement: str = ""
    tags: tuple[tuple[str, str], ...] = field(default=())
    fields: tuple[tuple[str, str], ...] = field(default=())

    @property
    def enabled(self) -> bool:
        return self.measurement != ""
