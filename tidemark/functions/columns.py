"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import CORRUPT


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double, 0.0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))


def is_blank(value: Column) -> Column:
    """True for NULL or empty strings; never NULL itself."""
    return value.isNull() | (F.length(value) == 0)


def event_time(value: Column) -> Column:
    """ISO-8601 text to timestamp, NULL where it does not parse (ANSI-safe)."""
    return F.try_to_timestamp(value)


def moment(as_of: datetime | date | str | Column | None) -> Column:
    """The instant a run treats as "now"; the wall clock unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime) and as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def first_reason(rules: dict[str, Column]) -> Column:
    """Name of the first rule whose failure condition holds, NULL if none does."""
    return F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules.items()])


def all_reasons(rules: dict[str, Column]) -> Column:
    """Names of every rule whose failure condition holds, in rule order."""
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in rules.items()]))


def no_amount(value: Column) -> Column:
    """True for negative numbers, NaN and infinities; NULL for NULL."""
    return (value < 0) | F.isnan(value) | (value == F.lit(float("inf")))


# A number as JSON writes it. Casts alone would also take NaN, Infinity and literals of other languages.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def finite_number(text: Column) -> Column:
    """The double that a text writes as JSON would, NULL where it writes none or one out of range."""
    number = F.when(text.rlike(JSON_NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def typed_numbers(raw: DataFrame) -> DataFrame:
    """Duration and revenue from the text they were read as, so ``18.0`` and ``"9.99"`` count as numbers.

    The fraction of a duration is cut off. A row with a text that is no finite number (or no int) keeps
    both texts in ``_corrupt_record``.
    """
    duration, revenue = F.col("duration_seconds"), F.col("revenue")
    numbers = {"duration_seconds": finite_number(duration).try_cast("int"), "revenue": finite_number(revenue)}
    mistyped = F.lit(False)
    for name, number in numbers.items():
        mistyped = mistyped | (F.col(name).isNotNull() & number.isNull())
    texts = F.when(mistyped, F.to_json(F.struct("duration_seconds", "revenue")))
    return raw.withColumns({**numbers, CORRUPT: F.coalesce(F.col(CORRUPT), texts)})


def known_metadata(df: DataFrame) -> Column:
    """The two documented metadata keys as a struct, whatever form ``metadata`` arrives in."""
    kind = df.schema["metadata"].dataType
    if isinstance(kind, T.VariantType):
        group = F.try_variant_get("metadata", "$.experiment_group", "string")
        referrer = F.try_variant_get("metadata", "$.referrer", "string")
    else:
        group, referrer = F.col("metadata.experiment_group"), F.col("metadata.referrer")
    known = F.struct(group.alias("experiment_group"), referrer.alias("referrer"))
    return F.when(F.col("metadata").isNotNull(), known)
