"""Expressions on clicked links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Link-tag patterns and the channel each stands for, in order
# of precedence. In LIKE, an underscore matches any one character.
LINK_TAG_CHANNELS = (
    ("%predue%_wa%", "whatsapp"),
    ("%predue%_sms%", "sms"),
)


def click_channel(link_tag: Column) -> Column:
    """Channel a link was sent through, NULL for other links."""
    return F.coalesce(*[F.when(link_tag.like(p), F.lit(c)) for p, c in LINK_TAG_CHANNELS])
