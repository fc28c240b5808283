"""Taking CSV tables in: one pass over the source that types its rows and sets bad ones aside.

The pass reads the text, stores every record as Parquet in a folder of its own and finds the
types meanwhile, where none are given. Records that do not fit are stored beside the others with their
file, their text and a reason, instead of ending the load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadwarden.sources.files import CSV_FIDELITY

ROWS, REJECTED = "rows", "rejected"
OTHER_FIELDS = "another number of fields"
WRONG_TYPE = "not of its type: "

REJECTED_SCHEMA = StructType(
    [StructField(name, StringType()) for name in ("file", "text", "reason")]
)

# Kinds of a field's text, each a bit; the bits that a column has tell its type.
_INT, _LONG, _DECIMAL, _DOUBLE, _DATE, _TIMESTAMP, _BOOLEAN, _TEXT = (1 << i for i in range(8))
_NUMBERS, _TIMES = _INT | _LONG | _DECIMAL | _DOUBLE, _DATE | _TIMESTAMP
_WHOLE = r"^[+-]?[0-9]+$"
_REAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?$|^[+-]?Infinity$|^-?Inf$|^NaN$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9].*)?$"


class TooManyRejected(ValueError):
    """More records were set aside than the load allows; they are stored, and nothing was loaded."""


@dataclass(frozen=True)
class Intake:
    """A source as it was taken in: the rows that fit, and those that do not."""

    rows: DataFrame
    rejected: DataFrame
    num_rows: int
    num_rejected: int


def take_in_csv(
    spark: SparkSession,
    path: str,
    folder: str,
    schema: StructType | str | None = None,
    *,
    most_rejected: int | None = None,
    **options: str,
) -> Intake:
    """Store the records of a CSV table with a header line in ``folder``, reading it once.

    With a ``schema``, records with another number of fields or with a value that is not of its type are
    rejected. A header that does not have its columns in its order is an error. Without one, types are found by
    ``column_type`` from the values of all records in the same pass, and only records with another number of
    fields are rejected; what else the header needs is read from the first lines. More
    than ``most_rejected`` rejected ones are an error, which leaves them in the folder.

    Rows taken in plus rejected ones are the records of the source. A source with a header alone
    has no rows; without a schema its columns are texts. Fields and quotes are read as by ``read_csv``.
    """
    settings = {**CSV_FIDELITY, **options}
    found = Observation() if schema is None else None
    if schema is None:
        names = spark.read.options(header=True, **settings).csv(path).columns
        wanted = StructType([StructField(name, StringType()) for name in names])
    else:
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        settings = {"enforceSchema": False, **settings}
    corrupt = _free_name("_corrupt", wanted.names)
    read = StructType([*wanted.fields, StructField(corrupt, StringType())])
    permissive = {**settings, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    records = spark.read.options(header=True, **permissive).csv(path, schema=read)
    bad = F.col(f"`{corrupt}`").isNotNull()
    record = F.struct(*(F.col(f"`{name}`") for name in wanted.names))
    taken = records.select(
        F.when(~bad, record).alias("record"),
        F.when(bad, F.col("_metadata.file_path")).alias("file"),
        F.col(f"`{corrupt}`").alias("text"),
        F.when(bad, _reason(corrupt, wanted, settings)).alias("reason"),
        F.when(bad, REJECTED).otherwise(ROWS).alias("kind"),
    )
    if found is not None:
        taken = taken.observe(found, *_traits(wanted.names))
    taken.write.mode("overwrite").partitionBy("kind").parquet(folder)
    stored = spark.read.schema(taken.schema).parquet(folder)
    rejected = stored.where(F.col("kind") == REJECTED).select(*REJECTED_SCHEMA.names)
    # Rows are counted in the files that were written, as in a load's manifest.
    counts = {r["kind"]: r["count"] for r in stored.groupBy("kind").count().collect()}
    num_rejected = counts.get(REJECTED, 0)
    if most_rejected is not None and num_rejected > most_rejected:
        raise TooManyRejected(
            f"{num_rejected} records of {path} were rejected, more than {most_rejected}; they are in {folder}"
        )
    rows = stored.where(F.col("kind") == ROWS)
    if found is None:
        rows = rows.select("record.*")
    else:
        traits = found.get
        rows = rows.select(
            *(
                _typed(F.col(f"record.`{name}`"), column_type(traits.get(f"kinds{i}") or 0, traits.get(f"digits{i}") or 0))
                .alias(name)
                for i, name in enumerate(wanted.names)
            )
        )
    return Intake(rows, rejected, counts.get(ROWS, 0), num_rejected)


def column_type(kinds: int, digits: int = 0) -> str:
    """The narrowest type that holds values of all ``kinds``; whole numbers have at most ``digits`` digits.

    int, bigint, decimal and double hold each other in this order; timestamps hold dates; any
    other mixture is text, as is a column without values. It depends on which kinds there are, not on their order or number:
    tasks' findings can be merged in any order, and those of a task that ran twice change nothing.
    """
    if kinds and not kinds & ~_NUMBERS:
        if kinds & _DOUBLE or (kinds & _DECIMAL and digits > 38):
            return "double"
        if kinds & _DECIMAL:
            return f"decimal({max(digits, 20)},0)"
        return "bigint" if kinds & _LONG else "int"
    if kinds and not kinds & ~_TIMES:
        return "timestamp" if kinds & _TIMESTAMP else "date"
    return "boolean" if kinds == _BOOLEAN else "string"


def _traits(names: list[str]) -> list[Column]:
    """Per column the kinds of its values and the most digits of a whole number."""
    traits = []
    for i, name in enumerate(names):
        text = F.col(f"record.`{name}`")
        whole = text.rlike(_WHOLE)
        kind = (
            F.when(text.isNull() | (text == ""), 0)
            .when(whole & text.try_cast("int").isNotNull(), _INT)
            .when(whole & text.try_cast("bigint").isNotNull(), _LONG)
            .when(whole, _DECIMAL)
            .when(text.rlike(_REAL), _DOUBLE)
            .when(text.rlike(_DAY) & text.try_cast("date").isNotNull(), _DATE)
            .when(text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(), _TIMESTAMP)
            .when(F.lower(text).isin("true", "false"), _BOOLEAN)
            .otherwise(_TEXT)
        )
        digits = F.when(whole, F.length(F.regexp_replace(text, "^[+-]?0*", "")))
        traits += [F.bit_or(kind).alias(f"kinds{i}"), F.max(digits).alias(f"digits{i}")]
    return traits


def _typed(text: Column, kind: str) -> Column:
    # An empty text is a value among texts and no value among others.
    return text if kind == "string" else F.nullif(text, F.lit("")).cast(kind)


def _reason(corrupt: str, schema: StructType, settings: dict[str, str]) -> Column:
    """Which fields of a rejected record have a text but no value."""
    texts = ", ".join(f"f{i} string" for i in range(len(schema)))
    fields = F.from_csv(F.col(f"`{corrupt}`"), texts, {k: str(v) for k, v in settings.items() if k != "enforceSchema"})
    wrong = [
        F.when(fields[f"f{i}"].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for i, f in enumerate(schema)
    ]
    names = F.concat_ws(", ", *wrong)
    return F.when(names == "", OTHER_FIELDS).otherwise(F.concat(F.lit(WRONG_TYPE), names))


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name
