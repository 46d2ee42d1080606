"""Text clean-up, e-mail tests and masking expressions. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_TOKENS = ("", "NULL", "None", "nan")
MISSING_CONTACT = "Not Provided"
STRICT_EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"


def name_case(text: Column, after: str = "space") -> Column:
    """Trim and capitalise words.

    `after="space"` starts a word after a space only (`T-shirt`), `after="non_letter"` after every
    character that is no letter (`T-Shirt`, `O'Neil`, `3D`).
    """
    if after == "space":
        return F.trim(F.initcap(text))
    if after != "non_letter":
        raise ValueError(f"after must be 'space' or 'non_letter', not {after!r}")
    # A marker plus a space behind every non-letter turns the next letter into a word start.
    marked = F.regexp_replace(F.trim(text), r"([^\p{L}])", "$1\u0001 ")
    return F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))


def blank_to_null(text: Column) -> Column:
    """The usual spellings of a missing value become NULL."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def format_phone(text: Column) -> Column:
    """`(XXX) XXX-XXXX` from the digits of `text`; NULL stays NULL."""
    digits = digits_only(text)
    area, prefix, line = (F.substring(digits, start, size) for start, size in ((1, 3), (4, 3), (7, 4)))
    return F.concat(F.lit("("), area, F.lit(") "), prefix, F.lit("-"), line)


def last_part(text: Column, separator: str) -> Column:
    return F.element_at(F.split(text, separator), -1)


def email_has_at(email: Column) -> Column:
    """Loosest e-mail rule, used by the profile."""
    return email.contains("@")


def email_strict(email: Column) -> Column:
    """E-mail rule of the customer clean-up; a missing address is not valid."""
    return F.coalesce(email.rlike(STRICT_EMAIL), F.lit(False))


def email_flag(email: Column) -> Column:
    """1 where there is an `@` and a dot behind the last one, else 0."""
    valid = email.contains("@") & last_part(email, "@").contains(".")
    return F.coalesce(valid, F.lit(False)).cast("int")


def token(key: Column, secret: str | None = None) -> Column:
    """SHA-256 of a key. Without a secret, tokens of a small key space can be found by trying all
    keys; pass one wherever tokens leave the house."""
    text = key.cast("string")
    return F.sha2(text if secret is None else F.concat(F.lit(secret), text), 256)


def keep_first(text: Column) -> Column:
    return F.concat(F.left(text, F.lit(1)), F.lit("***"))


def mask_email(email: Column) -> Column:
    return F.concat(F.left(email, F.lit(1)), F.lit("***@"), last_part(email, "@"))


def mask_phone(phone: Column) -> Column:
    return F.concat(F.lit("(XXX) XXX-"), F.right(phone, F.lit(4)))


def mask_address(address: Column) -> Column:
    return F.concat(F.lit("*** "), last_part(address, " "))


def mask_card(card: Column) -> Column:
    return F.concat(F.lit("*" * 12), F.right(card.cast("string"), F.lit(4)))


def tier(value: Column, steps: list[tuple[float, str]], top: str) -> Column:
    """Label of the first step whose upper bound lies above `value`, else `top`; NULL stays NULL."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in steps:
        label = label.when(value < bound, F.lit(name))
    return label.otherwise(F.lit(top))
