"""Text and number parsing as native column expressions.

Patterns follow Unicode rules (``U``), ignore case where the documents vary (``i``) and treat only
``\\n`` as a line end (``d``).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns of the order documents.
ORDER_NUMBER = r"BH\d{2}\.\d{4}"
DATE = r"(?iU)Ng[àa]y[:\s]+(\d{1,2}[/.\-]\d{1,2}[/.\-]\d{4})"
TAX_CODE = r"(?iU)MST[:\s]+(\d{9,13})"
# the free start counts at the front of the text only: elsewhere the first label is found without it, in one look per character
BUYER = r"(?isU)(?:\A.{0,5})?i\s*l[ýy][:\s]+(.+?)\s+MST[:\s]+\d{9,13}"
ADDRESS = r"(?isU)(?:\A.{0,5})?a\s*ch[ỉi■][:\s]+(.+?)(?=\n\s*(?:STT|M[aã]\s*h[aà]|\d+\s+\d{10})|\n\n)"
FOOTER_TOTAL = r"(?idU)T.{0,4}ng\s+gi.{0,3}\s*tr.{0,3}\s*.{0,5}n\s*h.{0,3}ng[:\s]+([\d.,]+)"
PRODUCT_CODE = r"^(?:\d{10,18}|[A-Z]{1,4}\d+(?:[.\-]\d+)+|\d{2,}\.\d{2}\.\d{2}\.\d{3,})$"
TEXT_LINE = (
    r"(?iU)^\s*(\d+)\s+(\d{10,18})\s+(.+?)\s+(Chi[ếe]c|C[áa]i|B[ộo])\s+([\d.,]+)\s+([\d.,]+)\s+([\d.,]+)\s*$"
)
DEALER_LABEL = r"(?idU)(?:Đại lý|Tên|Khách hàng)\s*:\s*(.+)"
INNER_LABEL = r"(?iU)^Tên\s*:\s*"
BODY_TAX_CODE = r"(?U)MST\s*:\s*(\d{9,13})"
BODY_AMOUNT = r"(?iU)tr[ịi]\s*gi[áa]\s*([\d.,]+)\s*[đd]"
UNITS = ["chiếc", "cái", "bộ"]
DEFAULT_UNIT = "Chiếc"
HEADER_WORDS = ["mã", "stt"]
LEGAL_FORMS = ["công ty cổ phần", "công ty tnhh", "công ty cp", "cty tnhh", "cty"]

_NUMBER_CHARACTERS = "0123456789.+-eE"


@F.pandas_udf(StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(col: Column) -> Column:
    """Unicode NFC. Pure ASCII text never leaves the JVM."""
    beyond_ascii = F.octet_length(col) != F.length(col)
    return F.coalesce(_compose(F.when(beyond_ascii, col)), col)


# What counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITE_SPACE))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row instead of once per mention."""
    return F.transform(F.array(value), use)[0]


def squeeze(col: Column) -> Column:
    return strip(F.regexp_replace(col, r"(?U)\s+", " "))


def found(col: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group; NULL when the pattern does not occur. Searched once also under a condition."""
    return let(F.regexp_extract(col, pattern, group), lambda match: F.nullif(match, F.lit("")))


def order_number(subject: Column, stem: Column, pattern: str = ORDER_NUMBER) -> Column:
    """Order number in the subject, else in the file name, upper-cased."""
    any_case = f"(?i){pattern}"
    return F.upper(F.coalesce(found(subject, any_case, 0), found(stem, any_case, 0)))


def dealer_name(body: Column) -> Column:
    """Dealer named after a label in the mail body; NULL when shorter than four characters."""
    name = strip(F.regexp_replace(strip(found(body, DEALER_LABEL)), INNER_LABEL, ""))
    name = F.rtrim(name, F.lit(".,;:"))
    return F.when(F.length(name) >= 4, F.left(name, F.lit(200)))


def doc_order_number(text: Column, pattern: str = ORDER_NUMBER) -> Column:
    return found(text, pattern, 0)


def doc_date(text: Column) -> Column:
    """Order date; NULL for a day that does not exist."""
    return F.try_to_date(F.translate(found(text, DATE), ".-", "//"), "d/M/yyyy")


def buyer_tax(text: Column, own: str) -> Column:
    """First tax code that is not the seller's own."""
    codes = F.regexp_extract_all(text, F.lit(TAX_CODE), F.lit(1))
    return F.try_element_at(F.filter(codes, lambda c: c != own), F.lit(1))


def doc_buyer(text: Column) -> Column:
    return squeeze(found(text, BUYER))


def doc_address(text: Column) -> Column:
    return squeeze(found(text, ADDRESS))


def _digits_only(col: Column) -> Column:
    return F.translate(col, ".,", "")


def footer_total(text: Column) -> Column:
    return _digits_only(found(text, FOOTER_TOTAL)).try_cast("bigint")


def is_product_code(col: Column) -> Column:
    return col.rlike(PRODUCT_CODE)


def _as_number(col: Column, kind: str = "double") -> Column:
    """A plain decimal number; words a cast would accept (``NaN``, ``1d``) are not numbers."""
    plain = (F.translate(col, _NUMBER_CHARACTERS, "") == "") & (col != "")
    return F.when(plain, col.try_cast(kind))


def _compact(col: Column) -> Column:
    return F.replace(strip(col), F.lit(" "), F.lit(""))


def to_int(col: Column, mode: str = "reference") -> Column:
    """Money text as an integer, 0 when unreadable, halves to even.

    ``reference`` reads ``.`` as thousands and ``,`` as decimal mark when both occur, and drops a lone
    ``,`` whatever follows it. ``locale`` takes the last mark as the decimal one when both occur, and a
    single mark not followed by exactly three digits as decimal.
    """
    if mode not in _MONEY_READERS:
        raise ValueError(mode)
    value = let(let(_compact(col), _MONEY_READERS[mode]), lambda t: F.bround(_as_number(t), 0))
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def _marks(text: Column) -> tuple[Column, Column]:
    return F.contains(text, F.lit(".")), F.contains(text, F.lit(","))


def _reference_money(text: Column) -> Column:
    dot, comma = _marks(text)
    return F.when(dot & comma, F.translate(text, ",.", ".")).otherwise(_digits_only(text))


def _locale_money(text: Column) -> Column:
    dot, comma = _marks(text)
    comma_last = F.locate(",", F.reverse(text)) < F.locate(".", F.reverse(text))
    decimal_tail = text.rlike(r"^[^.,]*[.,](?:\d{1,2}|\d{4,})$")
    return (
        F.when(dot & comma & comma_last, F.translate(text, ",.", "."))
        .when(dot & comma, F.translate(text, ",", ""))
        .when(decimal_tail, F.translate(text, ",", "."))
        .otherwise(_digits_only(text))
    )


_MONEY_READERS = {"reference": _reference_money, "locale": _locale_money}


def parse_qty(col: Column) -> Column:
    """Quantity text, decimal comma or point; 0 when unreadable."""
    value = let(F.translate(_compact(col), ",", "."), lambda t: _as_number(t, "decimal(18,3)"))
    return F.coalesce(value, F.lit(0).cast("decimal(18,3)"))


def strict_int(col: Column) -> Column:
    """Validator's reading of money: every mark is dropped, the rest is cut to an integer."""
    value = _as_number(_digits_only(strip(col)))
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def strict_qty(col: Column) -> Column:
    """Validator's reading of a quantity: decimal comma, thousands point only next to a comma."""
    text = _compact(col)
    dot, comma = _marks(text)
    plain = F.when(dot & comma, F.translate(text, ",.", ".")).otherwise(F.translate(text, ",", "."))
    return F.coalesce(_as_number(plain), F.lit(0.0))


def strict_numeric_cell(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(strip(col), r"(?U)[.,\s]", "").rlike(r"^\d+$"), F.lit(False))


def strict_qty_in_bounds(qty: Column, high: float = 10000) -> Column:
    return (qty > 0) & (qty <= high)


def body_triple(body: Column) -> Column:
    """Order number, tax code and amount stated in a mail body."""
    return F.struct(
        found(body, ORDER_NUMBER, 0).alias("so_number"),
        found(body, BODY_TAX_CODE).alias("tax_code"),
        _digits_only(found(body, BODY_AMOUNT)).try_cast("bigint").alias("amount"),
    )


def normalize_name(col: Column) -> Column:
    """Lower case, single spaces, legal forms removed from the front one after another."""
    out = squeeze(F.lower(col))
    for form in LEGAL_FORMS:
        out = F.regexp_replace(out, rf"(?U)^{form}\s*", "")
    return F.coalesce(out, F.lit(""))
