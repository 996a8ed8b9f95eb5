"""Caption parsing as column expressions: hashtags, mentions and their long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and the cap that decide what counts as a tag or a mention.
HASHTAG_PATTERN = r"#([\p{L}\p{N}\p{M}_]+)"
MENTION_PATTERN = r"@([A-Za-z0-9._]{1,30})"
DIGITS_ONLY = r"^[0-9]+$"
TRAILING_PERIODS = r"\.+$"
MAX_VALUE_LENGTH = 255

# Code points of the white space that may surround a tag name.
BLANK = r"[\x{0009}-\x{000D}\x{0020}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def normalize_tag(raw: Column) -> Column:
    """``  ##Matcha `` -> ``matcha``."""
    trimmed = F.regexp_replace(raw, f"^{BLANK}|{BLANK}$", "")
    return strip_tag(trimmed)


def strip_tag(raw: Column) -> Column:
    """Leading ``#`` removed and lower-cased, white space kept (the read query's rule)."""
    return F.lower(F.regexp_replace(raw, "^#+", ""))


def _matches(caption: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(caption, F.lit("")), F.lit(pattern), F.lit(1))


def _fold_case(value: Column) -> Column:
    return F.substring(F.lower(value), 1, MAX_VALUE_LENGTH)


def caption_hashtags(caption: Column) -> Column:
    """Distinct lower-cased tags in order of first appearance, never null."""
    values = F.transform(_matches(caption, HASHTAG_PATTERN), _fold_case)
    return F.array_distinct(F.filter(values, lambda v: ~v.rlike(DIGITS_ONLY)))


def caption_mentions(caption: Column) -> Column:
    """Distinct lower-cased account names in order of first appearance, never null."""
    values = F.transform(
        _matches(caption, MENTION_PATTERN),
        lambda v: _fold_case(F.regexp_replace(v, TRAILING_PERIODS, "")),
    )
    return F.array_distinct(F.filter(values, lambda v: v != ""))


def with_caption_arrays(df: DataFrame, caption: str = "caption") -> DataFrame:
    """Add ``caption_hashtags`` and ``caption_mentions``."""
    return df.withColumns(
        {
            "caption_hashtags": caption_hashtags(F.col(caption)),
            "caption_mentions": caption_mentions(F.col(caption)),
        }
    )


def caption_entities(df: DataFrame, *keep: str) -> DataFrame:
    """One row per (type, value), hashtags before mentions; posts without any vanish."""

    def tagged(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))

    both = F.concat(
        tagged("hashtag", caption_hashtags(F.col("caption"))),
        tagged("mention", caption_mentions(F.col("caption"))),
    )
    return df.select(*keep, F.posexplode(both).alias("entity_no", "entity")).select(
        *keep, "entity_no", "entity.type", "entity.value"
    )
