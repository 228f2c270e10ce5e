"""Expressions on WhatsApp and SMS messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text in a WhatsApp template name and the language it stands
# for, in order of precedence, and the language of every other template.
TEMPLATE_LANGUAGES = (
    ("tamil", "ta"),
    ("kannada", "kn"),
    ("bengali", "be"),
    ("telugunew", "te"),
)
DEFAULT_LANGUAGE = "en"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def present(value: Column) -> Column:
    """1 where a value is there, 0 where it is NULL."""
    return value.isNotNull().cast("int")


def template_language(template: Column) -> Column:
    """Language of a WhatsApp template; NULL for a NULL template."""
    name = F.lower(template)
    languages = [F.when(name.contains(part), F.lit(code)) for part, code in TEMPLATE_LANGUAGES]
    return F.when(template.isNotNull(), F.coalesce(*languages, F.lit(DEFAULT_LANGUAGE)))


def message_language(type_of_comm: Column, sms_language: Column, template: Column) -> Column:
    """Language by channel. Only the exact spellings ``sms`` and ``whatsapp`` count here."""
    return F.when(type_of_comm == "sms", sms_language).when(
        type_of_comm == "whatsapp", template_language(template)
    )
