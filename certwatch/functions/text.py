"""Null-safe casts, DN normalisation and the small list parsers.

All of them are built-in Spark expressions; none leaves the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from certwatch.config import UNKNOWN

# The characters str.strip() removes.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def strip(c: Column) -> Column:
    """Leading and trailing whitespace removed, any Unicode blank included."""
    return F.trim(c, F.lit(_BLANKS))


def _is_null_word(c: Column) -> Column:
    return F.lower(strip(c)).isin("null", "")


def safe_str(c: Column, floating: bool = False) -> Column:
    """Trimmed string, with NULL for blanks and the literal 'null'.

    ``floating`` marks a double column, whose NaN also becomes NULL.
    """
    text = strip(c.cast("string"))
    out = F.when(~F.lower(text).isin("null", ""), text)
    return F.when(~F.isnan(c), out) if floating else out


def safe_bigint(c: Column) -> Column:
    return c.try_cast("bigint")


def safe_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def serial_norm(c: Column) -> Column:
    return F.upper(safe_str(c))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order: bad values and absent columns become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in schema.fields
        ]
    )


def dn_clean(c: Column, noise_words: Sequence[str]) -> Column:
    """Common name (or whole DN), lower case, separators and noise words blanked."""
    common_name = F.regexp_extract(c, r"(?i)CN=([^,]+)", 1)
    out = F.when(common_name != "", common_name).otherwise(c)
    out = F.regexp_replace(F.lower(out), r"[.\-_]", " ")
    words = [re.escape(w.lower()) for w in noise_words if w]
    if words and all(re.fullmatch(r"\w+", w) for w in words):
        # plain words cannot create new matches for each other, so one pass is enough
        out = F.regexp_replace(out, rf"(?U)\b(?:{'|'.join(words)})\b", " ")
    else:
        for w in words:
            out = F.regexp_replace(out, rf"(?U)\b{w}\b", " ")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def token_sorted(c: Column) -> Column:
    """Whitespace tokens in code-point order, joined by one space."""
    tokens = F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")
    return F.array_join(F.sort_array(tokens), " ")


def token_sorted_clean(c: Column) -> Column:
    """``token_sorted`` of a cleaned DN, whose only blanks are single spaces."""
    return F.array_join(F.sort_array(F.split(c, " ")), " ")


def length_ratio(a: Column, b: Column) -> Column:
    la, lb = F.length(a), F.length(b)
    return F.when((la == 0) | (lb == 0), F.lit(0.0)).otherwise(F.least(la, lb) / F.greatest(la, lb))


def split_list(c: Column) -> Column:
    parts = F.filter(F.transform(F.split(c, ","), strip), lambda p: p != "")
    empty = F.array().cast("array<string>")
    return F.when(c.isNull() | _is_null_word(c), empty).otherwise(parts)


_QUOTED = r"""[uU]?'(?:[^'\\]|\\.)*'|[uU]?"(?:[^"\\]|\\.)*\""""
_ITEM = rf"(?:{_QUOTED}|None|\d+)"
_LIST_LITERAL = rf"^\[\s*(?:{_ITEM}\s*,\s*)*(?:{_ITEM}\s*)?\]$"
_STRING_LITERAL = rf"^(?:{_QUOTED})$"


def _unquote(c: Column) -> Column:
    inner = F.regexp_replace(c, r"""^[uU]?['"]|['"]$""", "")
    return F.regexp_replace(inner, r"""\\(['"\\])""", "$1")


def parse_san(c: Column) -> Column:
    """SAN text to a list: list literal, quoted literal, comma list or single value."""
    raw = strip(c)
    empty = F.array().cast("array<string>")
    literal_items = F.transform(
        F.filter(
            F.transform(
                F.filter(F.regexp_extract_all(raw, F.lit(_ITEM), F.lit(0)),
                         lambda t: ~t.isin("None", "0")),
                lambda t: F.when(t.rlike(_STRING_LITERAL), _unquote(t)).otherwise(t),
            ),
            lambda t: t != "",
        ),
        strip,
    )
    comma_items = F.transform(
        F.filter(F.transform(F.split(raw, ","), strip), lambda t: t != ""),
        lambda t: F.regexp_replace(t, r"""^['"]+|['"]+$""", ""),
    )
    return (
        F.when(raw.isNull() | F.lower(raw).isin("null", ""), empty)
        .when(raw.rlike(_LIST_LITERAL), literal_items)
        .when(raw.rlike(_STRING_LITERAL), F.array(strip(_unquote(raw))))
        .when(F.contains(raw, F.lit(",")), comma_items)
        .otherwise(F.array(raw))
    )


def parse_triple(c: Column) -> Column:
    """``cluster_project_service`` to a struct; absent parts are 'unknown'."""
    parts = F.split(strip(c), "_", 3)
    blank = c.isNull() | _is_null_word(c)

    def part(i: int) -> Column:
        value = F.try_element_at(parts, F.lit(i))
        return F.when(blank, F.lit(UNKNOWN)).otherwise(F.coalesce(value, F.lit(UNKNOWN)))

    return F.struct(part(1).alias("cluster"), part(2).alias("project"), part(3).alias("service_name"))
