"""Star schema: five dimensions keyed by a 64-bit hash, one fact row per line.

Surrogate ids are ``xxhash64`` of the natural key columns, set only when
every key column is non-NULL (a NULL key never equals anything, so those rows
get a NULL id, as an equi-join would give). Because the id is a function of
the row, the fact computes its ids in place: no join of the (large) fact to
any dimension is needed to build it.

Dimensions are the distinct natural keys. Only ``dim_ip`` needs a lookup
(the country), and it is done on the distinct addresses, never per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from weblake.operators.detect import ANOMALY_TYPES
from weblake.operators.geo import (
    DEFAULT_BUCKET_PREFIX,
    DEFAULT_MAX_BROADCAST_ROWS,
    lookup_countries,
)


@dataclass(frozen=True)
class Dim:
    name: str
    id_col: str
    keys: tuple[str, ...]
    attrs: tuple[str, ...] = ()
    # rows of the flagged events that own an entry in this dimension
    rows: str | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.id_col, *self.keys, *self.attrs)

    @property
    def schema(self) -> StructType:
        """Stored layout: id, string keys and attributes, the writing batch."""
        return StructType(
            [StructField(self.id_col, LongType())]
            + [StructField(c, StringType()) for c in (*self.keys, *self.attrs)]
            + [StructField("batch_id", LongType())]
        )


DIMS: dict[str, Dim] = {
    d.name: d
    for d in (
        Dim("dim_ip", "ip_id", ("ip",), ("country",)),
        Dim("dim_request", "request_id", ("request", "method", "page", "referrer")),
        Dim("dim_user_agent", "agent_id", ("agent",)),
        Dim("dim_error_details", "error_details_id", ("log_level", "error_message"),
            rows="log_type = 'error'"),
        Dim("dim_anomaly_type", "anomaly_type_id", ("anomaly_type",), rows="is_anomaly = 1"),
    )
}

# stored fact, layout columns included (declared so partition values keep their type)
FACT_SCHEMA = StructType([
    StructField("timestamp", TimestampType()),
    StructField("log_type", StringType()),
    StructField("ip_id", LongType()),
    StructField("request_id", LongType()),
    StructField("agent_id", LongType()),
    StructField("error_details_id", LongType()),
    StructField("anomaly_type_id", LongType()),
    StructField("status", IntegerType()),
    StructField("bytes", LongType()),
    StructField("is_anomaly", IntegerType()),
    StructField("event_month", StringType()),
    StructField("batch_id", LongType()),
])

SPREAD = 200

FACT_COLUMNS = (
    "timestamp", "log_type", "ip_id", "request_id", "agent_id", "error_details_id",
    "anomaly_type_id", "status", "bytes", "is_anomaly",
)


def _owns(d: Dim) -> Column:
    conds = [F.col(k).isNotNull() for k in d.keys]
    if d.rows:
        conds.append(F.expr(d.rows))
    return reduce(lambda a, b: a & b, conds)


def surrogate_id(d: Dim) -> Column:
    return F.when(_owns(d), F.xxhash64(*[F.col(k) for k in d.keys]))


def event_month(ts: Column | str = "timestamp") -> Column:
    return F.date_format(ts, "yyyyMM")


def with_ids(events: DataFrame) -> DataFrame:
    """Events with the ids of all dims but the anomaly's in place of their keys (`ip` stays): narrow rows, for a shuffle before the flags."""
    ids = [surrogate_id(d).alias(d.id_col) for d in DIMS.values() if d.name != "dim_anomaly_type"]
    keys = {k for d in DIMS.values() for k in d.keys} - {"ip"}
    return events.select(*[c for c in events.columns if c not in keys], *ids)


def build_fact(flagged: DataFrame) -> DataFrame:
    """Fact rows with ids computed in place where the rows don't hold them yet, plus the layout column `event_month`."""
    ids = {d.id_col: F.col(d.id_col) if d.id_col in flagged.columns else surrogate_id(d) for d in DIMS.values()}
    return flagged.select(
        "timestamp", "log_type",
        *[ids[c].alias(c) for c in ("ip_id", "request_id", "agent_id", "error_details_id",
                                    "anomaly_type_id")],
        "status", "bytes", "is_anomaly",
        event_month().alias("event_month"),
    )


def build_dim(flagged: DataFrame, d: Dim) -> DataFrame:
    """Distinct natural keys (all non-NULL) with their id; not for dim_ip."""
    return (
        flagged.filter(_owns(d)).select(*d.keys).distinct()
        .select(F.xxhash64(*[F.col(k) for k in d.keys]).alias(d.id_col), *d.keys)
    )


def build_dim_ip(
    flagged: DataFrame,
    ranges: DataFrame,
    bucket_prefix: int = DEFAULT_BUCKET_PREFIX,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    ips = flagged.filter(F.col("ip").isNotNull()).select("ip").distinct()
    return lookup_countries(ips, ranges, bucket_prefix, max_broadcast_rows).select(
        F.xxhash64("ip").alias("ip_id"), "ip", "country"
    )


def anomaly_types(fact: DataFrame) -> DataFrame:
    """`dim_anomaly_type` of a fact whose flags come from :func:`weblake.operators.detect.flag`: the types that its ids name."""
    types = fact.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, ANOMALY_TYPES))).alias("anomaly_type"))  # needs no Python worker
    names = types.select(F.xxhash64("anomaly_type").alias("anomaly_type_id"), "anomaly_type")
    return names.join(fact.filter("is_anomaly = 1").select("anomaly_type_id").distinct(), "anomaly_type_id", "left_semi")


def build_dims(events: DataFrame, ranges: DataFrame, **geo) -> dict[str, DataFrame]:
    """All dims whose keys the rows hold: of events that are not flagged yet, those but the anomaly's."""
    dims = {name: build_dim(events, d) for name, d in DIMS.items() if name != "dim_ip" and set(d.keys) <= set(events.columns)}
    dims["dim_ip"] = build_dim_ip(events, ranges, **geo)
    return dims


def keep_last(df: DataFrame, key: str, version: str, columns: list[str]) -> DataFrame:
    """One row per `key`: the values of the row with the highest `version`.

    A ``groupBy`` (not ``row_number() = 1``), so Catalyst knows the result is
    unique on `key` and can drop a left join to it that no column uses.
    """
    rest = [c for c in columns if c not in (key, version)]
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(version))
    return df.groupBy(key).agg(last.alias("_last")).select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


@dataclass
class Star:
    """Fact plus dimensions, as built in memory or read from the lake."""

    fact: DataFrame
    dims: dict[str, DataFrame] = field(default_factory=dict)
    rollup: DataFrame | None = None  # see weblake.plans.rollups; None where a lake has none for all of its fact
    sketches: DataFrame | None = None
    months: tuple[str, ...] = ()  # months with rows, if known

    @classmethod
    def build(cls, flagged: DataFrame, ranges: DataFrame, **geo) -> Star:
        return cls(build_fact(flagged), build_dims(flagged, ranges, **geo))

    def dim(self, name: str) -> DataFrame:
        return self.dims[name]

    def attach(self, df: DataFrame, names) -> DataFrame:
        """Left-join the named dimensions to `df` on their ids. Rows with a NULL id (most rows, for some ids)
        match nothing; if a dim is large enough to be shuffled, they spread over `SPREAD` keys that no id meets."""
        for name in names:
            d = DIMS[name]
            dim = self.dims[name].select(*d.columns).withColumn("_part", F.lit(0)).withColumnRenamed(d.id_col, "_id")
            part = F.when(F.col(d.id_col).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
            df = (df.withColumn("_key", F.coalesce(d.id_col, F.lit(0))).withColumn("_row_part", part)
                  .join(dim, (F.col("_key") == F.col("_id")) & (F.col("_row_part") == F.col("_part")), "left")
                  .drop("_key", "_row_part", "_id", "_part"))
        return df

    def joined(self, names=tuple(DIMS)) -> DataFrame:
        """The star view: fact with the named dimensions."""
        return self.attach(self.fact, names)
