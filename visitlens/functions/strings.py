"""String Column helpers: blanks, comma lists, packed ``k=v|k=v`` text.

Packed text follows the rules of the analysed application's Java string
splitting: a piece counts as a field only when splitting it on ``=``
leaves exactly two parts after trailing empty parts are dropped, so
``k=`` and ``k=a=b`` are skipped, ``k=a=`` reads ``a``, and the first
matching piece wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed separators of the packed format.
PACK_SEPARATOR = "|"
LIST_SEPARATOR = ","


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    """NULL for the empty string.  A plain CASE rather than nullif: Spark
    rewrites nullif into a per-call common-expression binding, which stops
    identical subexpressions from being computed once."""
    c = _col(c)
    return F.when(c != F.lit(""), c)


def is_blank(c: Column | str) -> Column:
    """NULL or empty string."""
    c = _col(c)
    return c.isNull() | (c == F.lit(""))


def is_not_blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


# Regular expressions run on Java's engine, where "$" also matches before a
# final line break; "\z" is the true end of the text.


def trim_one_comma(c: Column | str) -> Column:
    """Drop one leading and one trailing comma (not all of them)."""
    return F.regexp_replace(_col(c), r"^,|,\z", "")


def zero_fill_2(c: Column | str) -> Column:
    """Text of length 2 is kept; anything else gets one '0' in front
    (so '7' -> '07' but '123' -> '0123', unlike lpad).  Length counts
    UTF-16 units, as Java strings do (an emoji has length 2)."""
    c = _col(c)
    utf16_len = F.octet_length(F.encode(c, "UTF-16BE")) / 2
    return F.when(utf16_len == 2, c).otherwise(F.concat(F.lit("0"), c))


def split_list(c: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Comma text -> array of its non-empty elements."""
    parts = F.split(_col(c), _regex_quote(sep))
    return F.filter(parts, lambda x: x != F.lit(""))


def java_split(c: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Split like Java's ``String.split``: inner and leading empty pieces
    are kept, trailing ones dropped; "" gives [""] and ",," gives []."""
    c = _col(c)
    q = _regex_quote(sep)
    stripped = F.regexp_replace(c, f"(?:{q})+\\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q)))


def lists_overlap(a: Column | str, b: Column | str) -> Column:
    """Any piece of comma list ``a`` equals a piece of comma list ``b``
    (pieces as Java's split makes them); false, not NULL, when either side
    is NULL."""
    return F.coalesce(F.arrays_overlap(java_split(a), java_split(b)), F.lit(False))


def packed_field(s: Column | str, field: str) -> Column:
    """Value of ``field`` in ``k=v|k=v`` text, NULL when absent.

    One regular expression finds the first *valid* piece named ``field``:
    it starts the text or follows a '|', its value is non-empty and holds
    no '=', and only '=' may trail it before the next '|' or the end.
    """
    pattern = "(?:^|[|])" + _regex_quote(field) + "=([^=|]+)=*(?=[|]|\\z)"
    # The value group is never empty, so "" means "no valid piece".
    return empty_to_null(F.regexp_extract(_col(s), pattern, 1))


def set_packed_field(s: Column | str, field: str, value: Column | str) -> Column:
    """Replace the value of the first piece named ``field`` (its name is
    the text before its first '=', or the whole piece); trailing empty
    pieces are dropped first.  Text without such a piece is unchanged."""
    value = F.lit(value) if isinstance(value, str) else value
    value = F.coalesce(value, F.lit("null"))  # Java's "k=" + null
    stripped = F.regexp_replace(_col(s), "[|]+\\z", "")
    pieces = F.split(stripped, "[|]")
    at = F.array_position(F.transform(pieces, lambda p: F.substring_index(p, "=", 1)), F.lit(field)).cast("int")
    changed = F.concat(F.slice(pieces, F.lit(1), at - 1), F.array(F.concat(F.lit(field + "="), value)),
                       F.slice(pieces, at + 1, F.size(pieces)))
    return F.when(at > 0, F.array_join(changed, "|")).otherwise(stripped)


def pack_fields(fields: dict[str, Column | str]) -> Column:
    """``{"a": col_a, ...}`` -> ``a=<col_a>|b=<col_b>``; a NULL value is
    written as the text ``null``."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(_col(c).cast("string"), F.lit("null")))
        for name, c in fields.items()
    ]
    return F.concat_ws(PACK_SEPARATOR, *parts)


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in sep)
