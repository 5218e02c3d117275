"""Text expressions: defaults, number text, URL encoding, composite keys."""

from pyspark.sql import Column, functions as F, types as T


def truthy(col: Column, default) -> Column:
    """`default` where `col` is null or empty text."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col, F.lit("")), fallback)


def float_text(x: Column) -> Column:
    """Shortest round-trip text of a double, positional for 1e-4 <= |x| < 1e16.

    The JVM prints 0.001 <= |x| < 1e7 this way. Outside that range its layout differs, and a text
    of 16 digits or more may hold one too many, so 15, 16, then 17 digits are tried.
    """
    jvm = x.cast("string")
    rounded = [F.format_string(f"%.{digits}e", x) for digits in (14, 15, 16)]
    shortest = (
        F.when(F.length(jvm) <= 16, jvm)
        .when(rounded[0].cast("double") == x, rounded[0])
        .when(rounded[1].cast("double") == x, rounded[1])
        .otherwise(rounded[2])
    )
    size = F.abs(x)
    digits = shortest.cast("decimal(38,21)").cast("string")
    positional = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    trimmed = F.regexp_replace(F.lower(shortest), r"\.?0*e", "e")
    signed = F.regexp_replace(trimmed, r"e(?=\d)", "e+")
    scientific = F.regexp_replace(signed, r"([+-])(\d)$", "$10$2")
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when((x == 0) | ((size >= 1e-3) & (size < 1e7)), jvm)
        .when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(scientific)
    )


def value_text(col: Column, dtype: T.DataType) -> Column:
    """Text under which a value of type `dtype` is stored."""
    if isinstance(dtype, T.DoubleType):
        return float_text(col)
    if isinstance(dtype, T.FloatType):
        return float_text(col.cast("string").cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    return col.cast("string")


def json_number_text(text: Column) -> Column:
    """Number text out of `from_json`: undo the JVM's E notation, keep everything else."""
    jvm_float = text.rlike(r"^-?\d\.\d+E-?\d+\z")
    return F.when(jvm_float, float_text(text.try_cast("double"))).otherwise(text)


def json_text(raw: Column, kind: Column) -> Column:
    """Text of a decoded JSON value, from its raw text and its variant type (`schema_of_variant`).

    Texts stay as they are, numbers are spelled like stored values, true and false like booleans.
    """
    number = (
        F.when(raw == '"Infinity"', F.lit("inf"))
        .when(raw == '"-Infinity"', F.lit("-inf"))
        .when(raw == '"NaN"', F.lit("nan"))
        .otherwise(json_number_text(raw))
    )
    boolean = F.when(raw == "true", F.lit("True")).otherwise(F.lit("False"))
    return F.when(kind == "STRING", raw).when(kind == "BOOLEAN", boolean).otherwise(number)


def variant_text(value: Column) -> Column:
    """Text under which a variant's value is stored; null for a null.

    A whole number within 64 bits that was written with a point keeps it; beyond, and from 39 digits on, a variant
    no longer tells a whole number from one with a point.
    """
    return _variant_text(*variant_parts(value).values())


def variant_parts(value: Column) -> dict[str, Column]:
    """Type, plain text and number of a variant: columns to select first, so that each is taken once, for `parts_text`."""
    return {
        "_kind": F.schema_of_variant(value),
        "_plain": value.cast("string"),
        "_real": F.try_variant_get(value, "$", "double"),
    }


def parts_text() -> Column:
    """`variant_text` of a row that has its `variant_parts`."""
    return _variant_text(F.col("_kind"), F.col("_plain"), F.col("_real"))


def _variant_text(kind: Column, plain: Column, real: Column) -> Column:
    whole = kind.rlike(r"^DECIMAL\(\d+,0\)") & (F.abs(real) >= 2.0**63)
    is_real = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    boolean = F.when(plain == "true", F.lit("True")).otherwise(F.lit("False"))
    return F.when(kind == "BOOLEAN", boolean).when(is_real & ~whole, float_text(real)).otherwise(plain)


def is_missing_text(text: Column) -> Column:
    """Null or a not-a-number marker as JSON decoding leaves it."""
    return text.isNull() | text.isin("nan", "NaN", '"NaN"')


def form_encode(col: Column) -> Column:
    """Form encoding (space becomes `+`); the JVM differs on `*` and `~` only."""
    encoded = F.url_encode(col.cast("string"))
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def path_quote(col: Column) -> Column:
    """Path quoting: space becomes `%20`, slashes stay."""
    return F.replace(F.replace(form_encode(col), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def compact_date(col: Column) -> Column:
    """`2024-01-31` -> `20240131`."""
    return F.replace(col, F.lit("-"), F.lit(""))


def int_list(col: Column) -> Column:
    """`"1, 2,3"` -> array of ints."""
    return F.transform(F.split(col, ","), lambda part: F.trim(part).cast("int"))


def composite_key(*cols: Column) -> Column:
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def market_symbol(code: Column) -> Column:
    """Exchange suffix of a stock code: Shanghai codes start with 6."""
    return F.concat(code, F.when(code.startswith("6"), F.lit(".SS")).otherwise(F.lit(".SZ")))


def percentage(part: Column, whole: Column) -> Column:
    """Percentage to one decimal; 0 where there is nothing to divide by."""
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 1)).otherwise(F.lit(0.0))


def money(col: Column) -> Column:
    return F.format_string("%.2f", col)
