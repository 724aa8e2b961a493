"""Title, brand and category expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered category rules, the first match wins. The patterns are unanchored, so
# they also match inside words.
CATEGORY_RULES = (
    ("camera", "camera|camcorder"),
    ("computer", "laptop|computer"),
    ("storage_memory", "ssd|hard drive|memory card|gb|tb"),
    ("speaker", "speaker|soundbar|subwoofer"),
    ("receiver_amplifier", "receiver|amplifier"),
    ("accessory", "adapter|charger|battery|bag|keyboard|mouse"),
)
OTHER_CATEGORY = "other"
REFURBISHED_PATTERN = "refurbished|renewed"

_ACCESSORY_PATTERN = dict(CATEGORY_RULES)["accessory"]


def clean_text(c: Column) -> Column:
    """Lower case, one space between words, no outer spaces; NULL becomes ''."""
    return F.trim(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))


def first_word(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def title_category(title: Column) -> Column:
    lowered = F.lower(F.coalesce(title, F.lit("")))

    def hit(words: str) -> Column:
        # The patterns are plain words: looked for as bytes, without a regular expression.
        return reduce(or_, [lowered.contains(w) for w in words.split("|")])

    return reduce(
        lambda rest, rule: F.when(hit(rule[1]), rule[0]).otherwise(rest),
        reversed(CATEGORY_RULES),
        F.lit(OTHER_CATEGORY),
    )


def accessory_flag(title: Column, category: Column) -> Column:
    hit = (category == "accessory") | F.lower(title).rlike(_ACCESSORY_PATTERN)
    return F.coalesce(hit.cast("int"), F.lit(0))


def refurbished_flag(clean_title: Column) -> Column:
    return F.coalesce(clean_title.rlike(REFURBISHED_PATTERN).cast("int"), F.lit(0))


def brand_or_first_word(brand: Column, title: Column) -> Column:
    """The given brand, otherwise the first word of the title."""
    return clean_text(F.coalesce(brand, first_word(clean_text(title))))


def surrogate_order_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("||", *parts), 256)


def padded_id(prefix: str, number: Column, width: int = 5) -> Column:
    """Zero-padded id that keeps longer numbers whole (lpad alone would cut them)."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    )
