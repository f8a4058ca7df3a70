"""Cleaning expressions on single values: clips, tolerant casts, flags, names and keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgecurve.schemas import FALSE_WORDS, TRUE_WORDS


def clip(value: Column, low, high) -> Column:
    """Bound ``value``; NULL stays NULL and NaN, which sorts last, becomes ``high``."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def flag(value: Column) -> Column:
    """Yes/no words of any case as 1/0; everything else is NULL."""
    word = F.lower(value.cast("string"))
    return F.when(word.isin(TRUE_WORDS), 1).when(word.isin(FALSE_WORDS), 0).cast("int")


def finite_or(value: Column, default: float) -> Column:
    """``value`` as a double, or ``default`` where it is no finite number."""
    number = value.try_cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(usable, number).otherwise(F.lit(float(default)))


def joined_words(text: str, empty: str = "") -> str:
    """The words of a text (ASCII letters and digits), lower-cased and joined by underscores; ``empty`` if it has none."""
    return "_".join(re.findall("[0-9a-z]+", text.lower())) or empty


def snake_name(name: str) -> str:
    """A column name in snake case."""
    return joined_words(name)


def category_suffix(value: str | None) -> str:
    """The part of a one-hot column name that stands for a category value; the same as ``safe_category`` gives."""
    return joined_words(value or "", "unknown")


def safe_category(value: Column) -> Column:
    """A category value as lower-case words joined by underscores, 'unknown' when none are left."""
    words = F.regexp_replace(F.lower(F.trim(value)), "[^0-9a-z]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(words, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def day_type(weekend: Column) -> Column:
    return F.when(weekend == 1, "weekend").otherwise("weekday")


def segment_name(season: Column, weekend: Column) -> Column:
    """``{season}_season_{weekday|weekend}``"""
    return F.concat(season, F.lit("_season_"), day_type(weekend))


def segment_key(city: Column, season: Column, weekend: Column) -> Column:
    """``{city}_{season}_season_{weekday|weekend}``"""
    return F.concat_ws("_", city, segment_name(season, weekend))


# Fixed format: the last three words of a segment key are season, a filler and the day type.
_SEGMENT_KEY = r"^(.+)_([^_]+)_[^_]+_([^_]+)$"


def parse_segment_key(key: Column) -> dict[str, Column]:
    """City, season and weekend of a key; all NULL where the key has under four words."""
    known = key.rlike(_SEGMENT_KEY)
    return {
        "city": F.when(known, F.regexp_extract(key, _SEGMENT_KEY, 1)),
        "season": F.when(known, F.regexp_extract(key, _SEGMENT_KEY, 2)),
        "weekend": F.when(known, (F.regexp_extract(key, _SEGMENT_KEY, 3) == "weekend").cast("int")),
    }


def hash_number(*key: Column, salt: int | str = "") -> Column:
    """A non-negative 32-bit number that depends only on the key and the salt; a NULL part counts as one."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("\0")) for k in key], F.lit(str(salt)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
