"""Scalar column functions: safe casts, hashes, calendar parts, text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Texts that a delimited file uses for "no value".
NULL_TOKENS = ["NULL", "", "N/A", "n/a", "\\N"]

BYTE_ORDER_MARK = "\ufeff"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# A quoted or a bare field, with the comma that ends it.
FIELD_PATTERN = '( *"[^"]*(?:""[^"]*)*" *|[^,"]*),'


def blank_to_null(text: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Trim, then turn every no-value token into NULL."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(tokens), trimmed)


def token_to_null(text: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Turn a no-value token into NULL and leave other text, blanks included, as it is."""
    return F.when(~text.isin(tokens), text)


def safe_decimal(text: Column, precision: int = 18, scale: int = 4) -> Column:
    """Decimal or NULL; rounds half up at the last digit, NULL on overflow."""
    return text.try_cast(DecimalType(precision, scale))


def strict_date(text: Column) -> Column:
    """Date of the form 2024-01-31, or NULL.

    The plain cast would also take `2024` or `2024-1-5`.  Checking the form first
    and casting is about twice as fast as parsing with a date pattern.
    """
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def code(text: Column) -> Column:
    """Normalised short code: trimmed, upper case."""
    return F.upper(F.trim(text))


def weekday(day: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(day) - 1


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")


def pad_number(number: Column, width: int) -> Column:
    """Left-pad with zeros, never cutting a number that is already wider."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def key_hash(business_key: Column | None, file_name: Column) -> Column:
    """Hash of business key and file; one value per file when no key is given."""
    key = F.lit("") if business_key is None else F.coalesce(business_key.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", key, file_name))


def hash_sums(name: str, hashed: Column) -> dict[str, Column]:
    """A 64-bit hash in three pieces of at most 22 bits, so that a bigint holds the sum of each over 2^41 rows; decimals cost far more."""
    return {f"{name}_{i}": F.shiftrightunsigned(hashed, 22 * i).bitwiseAND((1 << 22) - 1) for i in range(3)}


def row_hash(named: dict[str, Column]) -> Column:
    """Hash of a row's values, independent of column order and of absent columns."""
    ordered = [named[name].alias(name) for name in sorted(named)]
    return F.md5(F.to_json(F.struct(*ordered)))


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole units elapsed between two timestamps."""
    return F.timestamp_diff(unit, start, end)


def header_fields(line: Column) -> Column:
    """The fields of one header line as written, without a byte-order mark."""
    return F.regexp_extract_all(F.concat(_plain(line), F.lit(",")), F.lit(FIELD_PATTERN), F.lit(1))


def header_names(line: Column) -> Column:
    """Split one header line into trimmed names without their quotes."""
    return F.transform(header_fields(line), _unquote)


def stray_quote(line: Column) -> Column:
    """True if a quote stands where none can, so that the fields do not make up the line."""
    return F.array_join(header_fields(line), ",") != _plain(line)


def _plain(line: Column) -> Column:
    return F.regexp_replace(line, f"^{BYTE_ORDER_MARK}", "")


def _unquote(field: Column) -> Column:
    inner = F.regexp_replace(F.trim(field), '^"|"$', "")
    return F.trim(F.replace(inner, F.lit('""'), F.lit('"')))


def header_fingerprint(names: Column) -> Column:
    """First 12 hex digits of the md5 of the comma-joined names; order matters."""
    return F.substring(F.md5(F.concat_ws(",", names)), 1, 12)
