"""Phone-key normalisation to E.164 as Catalyst expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

DEFAULT_COUNTRY_CODE = "84"
E164 = r"^\+[1-9][0-9]{6,14}\z"


def is_valid_e164(phone: Column) -> Column:
    """True for a well-formed E.164 number; null and anything else are false."""
    return F.coalesce(phone.rlike(E164), F.lit(False))


def normalize_key(phone: Column, country_code: Column | str = DEFAULT_COUNTRY_CODE) -> Column:
    """The E.164 form of ``phone``, or null when it has none.

    ``country_code`` may be a column, so that a schema can bring its own. Each step reads the one
    before it once, which keeps the expression small wherever it is inlined; a step leaves alone
    what already starts with a plus sign.
    """
    if isinstance(country_code, str):
        cc = country_code.strip().removeprefix("+") or DEFAULT_COUNTRY_CODE
        national, own_code, short = f"+{cc}", f"^({cc})", f"+{cc}$1"
    else:
        cc = F.regexp_replace(F.trim(country_code), r"^\+", "")
        cc = F.coalesce(F.nullif(cc, F.lit("")), F.lit(DEFAULT_COUNTRY_CODE))
        national = F.concat(F.lit("+"), cc)
        own_code, short = F.concat(F.lit("^("), cc, F.lit(")")), F.concat(F.lit("+"), cc, F.lit("$1"))

    number = F.regexp_replace(phone, r"^[\x00-\x20]+|[\x00-\x20]+$|[\s\-.()]", "")
    number = F.regexp_replace(number, "^00", "+")
    number = F.regexp_replace(number, "^0", national)
    number = F.regexp_replace(number, own_code, "+$1")
    number = F.regexp_replace(number, "^([^+].{6,9})$", short)
    number = F.regexp_replace(number, "^([^+])", "+$1")
    return F.nullif(F.regexp_extract(number, r"^(\+[1-9][0-9]{6,14})\z", 1), F.lit(""))


def in_countries(key: Column, codes: list[str] | None) -> Column:
    """True when the normalised ``key`` starts with one of the country ``codes`` (none given: any)."""
    if not codes:
        return F.lit(True)
    return F.coalesce(reduce(or_, [key.startswith("+" + c) for c in codes]), F.lit(False))
