"""Phones, e-mail addresses, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.text import fold

# Mobile prefixes, and mail hosts of governing bodies.
MOBILE = ("91", "92", "93", "95", "97", "98", "99")
GOVERNING_MAIL = (
    r"(?i)(?:^|@)(?:nszz|nszns|nszg|nszsd|nsosbz|nsizz|nssmz|nssloga|savez|nogometni-savez|hns)\.[a-z]+$|"
    r"^(?:tajnik|info|ured|admin)@(?:nszz|nszns|nssmz|nssloga|hns)"
)
# Phones and addresses as they stand in texts, and platforms whose mail is no contact.
PHONE = r"\+?\s?385[\s/-]?[0-9][\s/0-9-]{6,12}[0-9]|0[0-9]{1,2}[\s/-]?[0-9]{3,4}[\s/-]?[0-9]{3,4}"
PLATFORM_MAIL = r"(?i)@(facebook|fb|instagram)\.com$"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[A-Za-z]{2,}"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def national_digits(c: Column) -> Column:
    """Without country code and leading zero; null unless 8 or 9 digits are left."""
    d = F.regexp_replace(F.regexp_replace(digits(c), "^(00385|385)", ""), "^0", "")
    return F.when(F.length(d).isin(8, 9), d)


def phone_kind(c: Column) -> Column:
    n = national_digits(c)
    return F.when(n.isNull(), "unknown").when(F.left(n, F.lit(2)).isin(*MOBILE), "mobile").otherwise("landline")


def e164(c: Column) -> Column:
    return F.concat(F.lit("+385"), national_digits(c))


def phones_in(text: Column, least: int = 8, most: int = 13) -> Column:
    """International or local phones in a text, by their digit counts, in order."""
    found = F.regexp_extract_all(text, F.lit(PHONE), F.lit(0))
    return F.filter(found, lambda x: F.length(digits(x)).between(least, most))


def first_phone(block: Column, text: Column) -> Column:
    """The first phone of a contact block, else of the whole text."""
    return F.coalesce(F.get(phones_in(block), F.lit(0)), F.get(phones_in(text), F.lit(0)))


def first_number(c: Column) -> Column:
    return F.trim(F.split(c, "[,;]")[0])


def is_international(c: Column) -> Column:
    return c.startswith("+385") | c.startswith("00385")


def emails_in(text: Column) -> Column:
    """Addresses in a text, in order, without those of platforms."""
    return F.filter(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), lambda x: ~F.rlike(x, F.lit(PLATFORM_MAIL)))


def email_accepted(c: Column) -> Column:
    return F.rlike(c, F.lit(f"^{EMAIL}$")) & ~F.rlike(c, F.lit(GOVERNING_MAIL))


def norm_email(c: Column) -> Column:
    s = fold(c)
    return F.when(s.contains("@") & F.element_at(F.split(s, "@"), -1).contains("."), s)


def norm_oib(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) == 11, d)


def iban_digits(c: Column) -> Column:
    s = F.regexp_replace(c, r"\s+", "")
    return F.when(F.rlike(s, F.lit("^[0-9]{15,}$")), s)
