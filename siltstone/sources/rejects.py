"""Delimited text and JSON lines split into rows that fit the declared schema and rejects with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.quality import against_limits

RAW = "raw"
REASON = "reason"

_RECORD, _PARSED, _TEXTS = "__record", "__parsed", "__texts"


@dataclass(frozen=True)
class Scan:
    """A text source read once: every record with what the schema makes of it.

    ``good`` are the rows of the declared schema, ``rejects`` the others as (raw, reason). Both are views of one
    scan; write ``judged`` or ``without_good_text`` once (``staging.staged``) and hand it to ``of`` where both are needed.
    """

    judged: DataFrame
    schema: T.StructType

    @property
    def good(self) -> DataFrame:
        return self.judged.where(F.col(REASON).isNull()).select(*(F.col(f"{_PARSED}.`{n}`").alias(n) for n in self.schema.names))

    @property
    def rejects(self) -> DataFrame:
        return self.judged.where(F.col(REASON).isNotNull()).select(F.col(_RECORD).alias(RAW), REASON)

    @property
    def without_good_text(self) -> DataFrame:
        """``judged`` with the text of rejects alone, which is all that ``good`` and ``rejects`` need."""
        return self.judged.withColumn(_RECORD, F.when(F.col(REASON).isNotNull(), F.col(_RECORD)))

    def of(self, written: DataFrame) -> Scan:
        return Scan(written, self.schema)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _first_bad(schema: T.StructType, required: Sequence[str]) -> Column:
    """The first field, in order, that is required and absent, or present as text but not in its type."""
    reasons = []
    for f in schema:
        text, value = F.col(f"{_TEXTS}.`{f.name}`"), F.col(f"{_PARSED}.`{f.name}`")
        if f.name in required:
            reasons.append(F.when(text.isNull(), F.lit(f"missing {f.name}")))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"bad {f.name}")))
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    escape: str = "\\",
    required: Sequence[str] = (),
) -> Scan:
    """Text with a header line, one record per line; lines are split across tasks.

    Reasons, the first that holds: ``short line`` and ``long line`` by the number of fields, ``missing <column>`` for an
    empty field of ``required``, ``bad <column>`` for a value that is not of its type. Empty fields
    are NULL. ``escape='"'`` reads doubled quotes as one. Blank lines are no records, as in Spark's own scan;
    a field does not hold line breaks.

    Any line that holds the declared names, quoted or not, is a header. A quote that is not closed takes the rest of its line.
    """
    lines = spark.read.text(path).withColumnRenamed("value", _RECORD).where(F.length(F.trim(_RECORD)) > 0)
    options = {"sep": delimiter, "escape": escape, "mode": "PERMISSIVE"}
    tokens = "__tokens"
    header = delimiter.join(schema.names)
    quoted = delimiter.join(f'"{n}"' for n in schema.names)
    parsed = lines.where(~F.trim(_RECORD).isin(header, quoted)).select(
        _RECORD,
        F.from_csv(_RECORD, _ddl(schema), options).alias(_PARSED),
        F.from_csv(_RECORD, _ddl(_as_text(schema)), options).alias(_TEXTS),
        _field_count(F.col(_RECORD), delimiter, escape).alias(tokens),
    )
    wanted = F.lit(len(schema))
    reason = F.coalesce(
        F.when(F.col(tokens) < wanted, F.lit("short line")),
        F.when(F.col(tokens) > wanted, F.lit("long line")),
        _first_bad(schema, required),
    )
    return Scan(parsed.select(_RECORD, _PARSED, reason.alias(REASON)), schema)


def _field_count(line: Column, delimiter: str, escape: str) -> Column:
    """Fields of a line: quoted ones are put out of the way, then delimiters are counted."""
    between = f"\\Q{delimiter}\\E"
    inner = '(?:[^"]|"")*' if escape == '"' else r'(?:[^"\\]|\\.)*'
    # a quote that is not closed takes all that follows
    plain = F.regexp_replace(line, f'(?:^|(?<={between}))"{inner}(?:"|$)', "q")
    return F.size(F.split(plain, between, -1))


def scan_json(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> Scan:
    """One JSON object per line; lines are split across tasks.

    Reasons, the first that holds: ``no object``, ``missing <field>`` for an absent or null field of ``required``,
    ``bad <field>`` for a value that is not of its type. Other absent fields are NULL. Blank lines are no records.
    """
    lines = spark.read.text(path).withColumnRenamed("value", _RECORD).where(F.length(F.trim(_RECORD)) > 0)
    return judge_json(lines.select(_RECORD), schema, required)


def judge_json(records: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> Scan:
    """As ``scan_json`` for records that are the frame's only column."""
    record = records.columns[0]
    broken = "__broken"
    texts = T.StructType([*_as_text(schema).fields, T.StructField(broken, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    parsed = records.select(
        F.col(record).alias(_RECORD),
        F.from_json(record, schema, {"mode": "PERMISSIVE"}).alias(_PARSED),
        F.from_json(record, texts, options).alias(_TEXTS),
    )
    is_object = F.trim(_RECORD).startswith("{") & F.col(f"{_TEXTS}.{broken}").isNull()
    reason = F.coalesce(F.when(~F.coalesce(is_object, F.lit(False)), F.lit("no object")), _first_bad(schema, required))
    return Scan(parsed.select(_RECORD, _PARSED, reason.alias(REASON)), schema)


def reject_counts(rejects: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """Rows (reason, rejected, max_allowed, passed): rejects by reason against the largest tolerated numbers.

    A reason without a limit must not occur.
    """
    counts = rejects.groupBy(REASON).agg(F.count("*").alias("rejected"))
    return against_limits(counts, REASON, "rejected", limits or {})


def check_rejects(rejects: DataFrame, limits: Mapping[str, int], name: str = "") -> None:
    """Raises for the first reason, in alphabetical order, that is met too often."""
    over = reject_counts(rejects, limits).where("NOT passed").orderBy(REASON).first()
    if over is not None:
        subject = f" of '{name}'" if name else ""
        raise ValueError(f"{over.rejected} records{subject} rejected: {over.reason} (limit {over.max_allowed})")
