"""Telling from a column's name whether it holds names of people or companies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from maskmetrics.functions.text import as_column

# Words that mark a column, on the normalized name.
DATA_WORDS = ("name", "email", "phone", "address")
CLIENT_WORDS = ("company", "account")
RESOURCE_WORDS = ("resource", "technician", "employee")
CONTACT_WORDS = ("contact", "email", "phone", "address")
CONTACT_PHRASES = ("first name", "last name", "full name")
FREE_TEXT_WORDS = (
    "description", "desc", "note", "notes", "comment", "summary",
    "subject", "title", "body", "detail", "details", "resolution",
)
DESCRIPTIVE_WORDS = ("role", "specialty", "speciality", "jobtitle", "department", "sector", "industry")
DESCRIPTIVE_PHRASE = "job title"


def normalize_column_name(name: Column | str) -> Column:
    """CompanyName, company_name and "Company Name" all become "company name"."""
    spaced = F.regexp_replace(as_column(name), r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.trim(F.regexp_replace(F.lower(spaced), r"[^a-z0-9]+", " "))


def classify_column(name: Column | str) -> Column:
    """client, resource, contact or null; the bare category word is not enough."""
    words = normalize_column_name(name)
    padded = F.concat(F.lit(" "), words, F.lit(" "))

    def has(wanted: tuple[str, ...]) -> Column:
        return F.arrays_overlap(F.split(words, " "), F.array(*map(F.lit, wanted)))

    phrase = padded.rlike(" (?:" + "|".join(CONTACT_PHRASES) + ") ")
    return F.when(has(DATA_WORDS),
                  F.when(has(CLIENT_WORDS), "client").when(has(RESOURCE_WORDS), "resource")
                  .when(has(CONTACT_WORDS) | phrase, "contact"))


def classify_unprotected_column(name: Column | str) -> Column:
    """descriptive, free_text or null: columns that are never masked by their name."""
    words = normalize_column_name(name)

    def has(wanted: tuple[str, ...]) -> Column:
        return F.arrays_overlap(F.split(words, " "), F.array(*map(F.lit, wanted)))

    return (F.when(has(DESCRIPTIVE_WORDS) | F.contains(words, F.lit(DESCRIPTIVE_PHRASE)), "descriptive")
            .when(has(FREE_TEXT_WORDS), "free_text"))
