"""Record schemas of the order topics and by-name conforming.

Records are flat structs of string / long / double fields.  Each schema
carries its field defaults and the list of required fields; ``conform``
resolves a frame to a schema by name, fills defaults and splits off rows
that miss a required field.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class RecordSchema:
    name: str
    struct: T.StructType
    defaults: dict = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        return [f.name for f in self.struct.fields]

    @property
    def required(self) -> list[str]:
        """Fields without a default: a record missing one is rejected."""
        return [f for f in self.fields if f not in self.defaults]


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# Record layouts (field order and defaults) of the six order
# records, as declared by the topics they model.
ELECTRONIC_ORDER = RecordSchema(
    "electronic_order",
    _struct(("order_id", S), ("electronic_id", S), ("user_id", S), ("price", D), ("time", L)),
    {"price": 0.0},
)
APPLIANCE_ORDER = RecordSchema(
    "appliance_order",
    _struct(("order_id", S), ("appliance_id", S), ("user_id", S), ("time", L)),
)
COMBINED_ORDER = RecordSchema(
    "combined_order",
    _struct(("electronic_order_id", S), ("appliance_order_id", S), ("appliance_id", S),
            ("user_name", S), ("time", L)),
    {"user_name": ""},
)
USER = RecordSchema("user", _struct(("name", S), ("address", S), ("user_id", S)))
PRODUCT_ORDER = RecordSchema(
    "product_order", _struct(("order_id", S), ("product", S), ("user_id", S), ("time", L)))
PROCESSED_ORDER = RecordSchema(
    "processed_order", _struct(("time_processed", L), ("product", S)))

RECORDS = {r.name: r for r in (ELECTRONIC_ORDER, APPLIANCE_ORDER, COMBINED_ORDER, USER,
                               PRODUCT_ORDER, PROCESSED_ORDER)}


DATE_COL = "date"


def topic_schema(value_type: T.DataType = S, by_date: bool = False) -> T.StructType:
    """Columns of a topic table -- the same names Spark's Kafka source uses.

    ``by_date`` adds the ``date`` folder column of a date-partitioned topic.
    """
    fields = [
        T.StructField("topic", S, True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", L, True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("key", S, True),
        T.StructField("value", value_type, True),
    ]
    if by_date:
        fields.append(T.StructField(DATE_COL, T.DateType(), True))
    return T.StructType(fields)


def _field_or_default(df: DataFrame, rs: RecordSchema, name: str, prefix: str) -> Column:
    dtype = rs.struct[name].dataType
    present = {f.name for f in (df.schema[prefix[:-1]].dataType.fields if prefix
                                else df.schema.fields)}
    c = F.col(prefix + name).try_cast(dtype) if name in present else F.lit(None).cast(dtype)
    if name in rs.defaults:
        c = F.coalesce(c, F.lit(rs.defaults[name]).cast(dtype))
    return c.alias(name)


def conform(df: DataFrame, rs: RecordSchema, value_col: str | None = None,
            keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Resolve ``df`` to record schema ``rs`` by field name.

    Missing fields take their default (or null), extra fields are dropped,
    types are cast.  Returns ``(good, rejected)``: ``rejected`` holds rows with
    a null required field (``missing`` names them) or a value that does not
    cast to its field's type (``invalid`` names them; a default hides none).
    ``value_col`` names a struct column to conform instead of the top level;
    ``keep`` lists top-level columns (e.g. key, offset) carried along.
    """
    prefix = f"{value_col}." if value_col else ""
    rec = F.struct(*[_field_or_default(df, rs, n, prefix) for n in rs.fields])
    present = {f.name for f in (df.schema[value_col].dataType.fields if value_col else df.schema.fields)}
    wrong = [F.when(F.col(prefix + n).isNotNull() & F.col(prefix + n).try_cast(rs.struct[n].dataType).isNull(), F.lit(n))
             for n in rs.fields if n in present]
    invalid = F.filter(F.array(*(wrong or [F.lit(None).cast(S)])), lambda x: x.isNotNull())
    out = df.select(*keep, rec.alias("_rec"), invalid.alias("_invalid"))
    missing = F.filter(
        F.array(*[F.when(F.col(f"_rec.{n}").isNull(), F.lit(n)) for n in rs.required]
                or [F.lit(None).cast(S)]),
        lambda x: x.isNotNull())
    out = out.withColumn("_missing", missing)
    rejected = (F.size("_missing") > 0) | (F.size("_invalid") > 0)
    good = out.filter(~rejected)
    bad = out.filter(rejected)
    if value_col:
        good = good.select(*keep, F.col("_rec").alias(value_col))
        bad = bad.select(*keep, F.col("_rec").alias(value_col), F.col("_missing").alias("missing"),
                         F.col("_invalid").alias("invalid"))
    else:
        good = good.select(*keep, "_rec.*")
        bad = bad.select(*keep, "_rec.*", F.col("_missing").alias("missing"),
                         F.col("_invalid").alias("invalid"))
    return good, bad
