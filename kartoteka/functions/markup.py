"""HTML, Markdown and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.pages import squeeze, unescape

def html_text(html: Column) -> Column:
    """Visible text: scripts, styles and tags dropped, references decoded once, whitespace collapsed."""
    s = F.regexp_replace(html, "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return squeeze(unescape(F.regexp_replace(s, "(?s)<[^>]*>", " ")))


def html_title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1)), F.lit(""))


def markdown_section(md: Column, heading: str) -> Column:
    """The body under a heading, up to the next one."""
    return F.nullif(F.trim(F.regexp_extract(md, rf"(?s)(?:^|\n)#+ {heading}[^\n]*\n(.*?)(?:\n#|$)", 1)), F.lit(""))


def contact_blocks(md: Column) -> Column:
    """(contact, websites): what stands under the headings of contact data and of websites, up to the next heading of the second level; null without one."""
    part = lambda heading: F.nullif(F.regexp_extract(md, rf"(?s)##\s*{heading}(.*?)(?=\n##\s|\z)", 1), F.lit(""))
    return F.struct(part("Contact info").alias("contact"), part(r"Websites?\s*(?:and social[^\n]*)?").alias("websites"))


def merged_json_lists(*lists: Column) -> Column:
    """JSON arrays of texts as one, sorted, each text once; null, empty and broken ones count as empty."""
    none = F.expr("array() :: array<string>")
    return F.to_json(F.array_sort(F.array_distinct(F.flatten(F.array(*[F.array_compact(F.coalesce(F.from_json(x, "array<string>"), none)) for x in lists])))))


def numbered_fields(text: Column) -> Column:
    """`1. label value 2. label value` as an array of fields."""
    return F.filter(F.split(text, r"(?:^|\s)(?=[0-9]{1,2}\.\s)"), lambda x: F.trim(x) != "")


# Numbered fields of a registry page with their labels, and section titles that follow the last field of a section.
FIELD_LABELS = {
    "13": ("adresa", "Adresa sjedišta"), "16": ("djelatnost", "Šifra djelatnosti"), "17": ("iban", "Račun (IBAN)"), "19": ("kontakt", "Osoba za kontakt"),
    "21": ("telefon", "Telefon"), "23": ("email", "e-mail"), "24": ("web", "Web stranica"), "25": ("zastupnik", "Ime i prezime"),
}
SECTIONS = r"(?is)\s+(PODACI O |OSNOVNI PODACI|IZVJE|POVEZANI|OPCIJE).*$"


def labelled_fields(text: Column) -> Column:
    """A struct of the fields that a registry page numbers with two digits: label dropped, cut before the next section's title, null if nothing is left.

    The last of a repeated number counts; a null text gives nulls.
    """
    parts = F.split(text, r"(?<![0-9])(?=[0-9]{2}\.\s)")

    def field(number: str, key: str, label: str) -> Column:
        body = F.trim(F.substring(F.try_element_at(F.filter(parts, lambda p: F.rlike(p, F.lit(rf"^{number}\.\s"))), F.lit(-1)), 5, 1 << 30))
        body = F.when(F.startswith(body, F.lit(label)), F.trim(F.substring(body, len(label) + 1, 1 << 30))).otherwise(body)
        return F.nullif(F.trim(F.regexp_replace(body, SECTIONS, "")), F.lit("")).alias(key)

    return F.struct(*[field(n, key, label) for n, (key, label) in FIELD_LABELS.items()])
