"""Run context, control rows and the schemas of the control and log tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.sql import types as T

from tidegate import fixed

# Integer families and the Spark types they are cast to.
INT_CASTS = {"smallint": "smallint", "integer": "int", "bigint": "bigint"}

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("aurora_schema", T.StringType()),
        T.StructField("aurora_table", T.StringType()),
        T.StructField("target_work_schema", T.StringType()),
        T.StructField("target_work_table", T.StringType()),
        T.StructField("target_schema", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("target_column", T.StringType()),
        T.StructField("search_key", T.BooleanType()),
        T.StructField("validation", T.StringType()),
        T.StructField("max_length", T.IntegerType()),
        T.StructField("min_length", T.IntegerType()),
        T.StructField("max_value", T.DecimalType(38, 6)),
        T.StructField("min_value", T.DecimalType(38, 6)),
        T.StructField("seq", T.IntegerType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("process_id", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("message_cd", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("target_file", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("occurred_key", T.StringType()),
        T.StructField("total_num", T.LongType()),
        T.StructField("normal_num", T.LongType()),
        T.StructField("error_num", T.LongType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("create_id", T.StringType()),
        T.StructField("create_dtt", T.TimestampNTZType()),
        T.StructField("last_upd_id", T.StringType()),
        T.StructField("last_upd_dtt", T.TimestampNTZType()),
        T.StructField("customer_id", T.StringType()),
    ]
)


@dataclass(frozen=True)
class RunContext:
    """The one clock of a run. ``run_ts`` is wall time in the run's own zone (UTC+9 by default)."""

    run_ts: datetime
    customer_id: str = ""
    term_hours: int = 24
    tag: str = ""
    """Tells runs of the same second apart, as the loads of dropped files are."""

    @classmethod
    def now(cls, customer_id: str = "", term_hours: int = 24, utc_offset: int = 9) -> RunContext:
        wall = datetime.now(UTC).replace(tzinfo=None) + timedelta(hours=utc_offset)
        return cls(wall, customer_id, term_hours)

    @property
    def process_id(self) -> str:
        return self.run_ts.strftime("%Y%m%d%H%M%S")

    @property
    def run_name(self) -> str:
        """Names the run's folder in the log."""
        return f"{self.process_id}-{self.tag}" if self.tag else self.process_id

    @property
    def run_dt(self) -> str:
        return self.run_ts.strftime("%Y%m%d_%H%M%S")

    @property
    def log_stamp(self) -> str:
        return self.run_ts.strftime("%Y/%m/%d %H:%M:%S")

    @property
    def cutoff(self) -> datetime:
        # The extract compares whole seconds.
        return (self.run_ts - timedelta(hours=self.term_hours)).replace(microsecond=0)


@dataclass(frozen=True)
class TargetType:
    """A target column's type by its catalogue name, e.g. ``TargetType("numeric", 18, 2)``."""

    name: str
    precision: int | None = None
    scale: int | None = None

    @property
    def family(self) -> str:
        name = self.name.lower()
        for family, names in (
            ("smallint", fixed.SMALLINT_TYPES),
            ("integer", fixed.INTEGER_TYPES),
            ("bigint", fixed.BIGINT_TYPES),
            ("float", fixed.FLOAT_TYPES),
            ("decimal", fixed.DECIMAL_TYPES),
            ("date", fixed.DATE_TYPES),
            ("timestamp", fixed.TIMESTAMP_TYPES),
            ("time", fixed.TIME_TYPES),
            ("string", fixed.STRING_TYPES),
            ("boolean", fixed.BOOLEAN_TYPES),
        ):
            if name in names:
                return family
        return "other"

    @property
    def single_byte(self) -> bool:
        return self.name.lower() in fixed.SINGLE_BYTE_TYPES

    @classmethod
    def of(cls, data_type: T.DataType) -> TargetType:
        """The catalogue name of a Spark type."""
        if isinstance(data_type, T.DecimalType):
            return cls("numeric", data_type.precision, data_type.scale)
        names = {
            T.ShortType: "smallint",
            T.IntegerType: "integer",
            T.LongType: "bigint",
            T.FloatType: "real",
            T.DoubleType: "double precision",
            T.DateType: "date",
            T.TimestampNTZType: "timestamp without time zone",
            T.TimestampType: "timestamp with time zone",
            T.CharType: "character",
            T.VarcharType: "character varying",
            T.StringType: "character varying",
            T.BooleanType: "boolean",
        }
        return cls(names.get(type(data_type), data_type.simpleString()))


@dataclass(frozen=True)
class ControlColumn:
    """One control row: a target column, its type and its rules."""

    name: str
    type: TargetType
    search_key: bool = False
    rules: str = ""
    max_length: int | None = None
    min_length: int | None = None
    max_value: object | None = None
    min_value: object | None = None
    label: str = ""

    @property
    def shown(self) -> str:
        """The name as the control table spells it, for log lines."""
        return self.label or self.name

    def has(self, rule: str) -> bool:
        return rule in (self.rules or "")


@dataclass(frozen=True)
class LoadSpec:
    """All control rows of one source table, in ``seq`` order."""

    table: str
    columns: tuple[ControlColumn, ...]
    target_table: str = ""
    target_schema: str = ""
    work_table: str = ""
    work_schema: str = ""
    source_schema: str = ""
    _keys: tuple[str, ...] = field(init=False, repr=False, default=())

    def __post_init__(self) -> None:
        object.__setattr__(self, "_keys", tuple(c.name for c in self.columns if c.search_key))

    @property
    def keys(self) -> list[str]:
        return list(self._keys)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def key_labels(self) -> list[str]:
        return [c.shown for c in self.columns if c.search_key]

    def column(self, name: str) -> ControlColumn:
        return next(c for c in self.columns if c.name == name)
