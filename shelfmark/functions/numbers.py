"""Text as exact numbers: nothing is rounded on the way in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_A_NUMBER = "not_a_number"
DOES_NOT_FIT = "does_not_fit"

_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
# Numbers with an exponent of which a DECIMAL(38,18) loses no digit.
_WIDE = "decimal(38,18)"
_SCIENTIFIC = r"^\s*[+-]?(?=\.?[0-9])[0-9]*\.?[0-9]{0,9}[eE][+-]?0*[0-9]\s*$"


def exact_number(text: Column, whole: int, places: int) -> Column:
    """The number that `text` spells, as DECIMAL with `whole` digits before and `places` after the point; NULL where it spells
    none, or one that this DECIMAL does not hold exactly (see `number_fault`).

    Blanks around a number, a sign and an exponent are allowed, and zeros at its ends are no digits; `nan` and `inf` are no
    numbers. A number spelled with an exponent, and either that or its places beyond nine, counts as one that does not fit.
    """
    kind = f"decimal({whole + places},{places})"
    before = f"0*[0-9]{{0,{whole}}}" if whole else "0*"
    after = f"[0-9]{{0,{places}}}0*" if places else "0*"
    fits = text.rlike(rf"^\s*[+-]?(?=\.?[0-9]){before}(?:\.{after})?\s*$")
    wide = text.try_cast(_WIDE)
    narrow = wide.try_cast(kind)
    return F.when(fits, text.try_cast(kind)).when(text.rlike(_SCIENTIFIC) & (wide == narrow), narrow)


def number_fault(text: Column, value: Column) -> Column:
    """Why `exact_number` gave no `value` for `text`: `not_a_number` (NULL included) or `does_not_fit`; NULL where it gave one."""
    return F.when(value.isNull(), F.when(text.rlike(_NUMBER), DOES_NOT_FIT).otherwise(NOT_A_NUMBER))
