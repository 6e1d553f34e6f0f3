"""Functions of tokens, scene names and descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_seed(token: Column) -> Column:
    """The first eight hex digits of the token's MD5 as a number."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long")


def scene_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^scene-(\d+)", 1)


def scene_template(name: Column) -> Column:
    return F.element_at(F.split(name, "-"), -1)


def infer_weather(description: Column) -> Column:
    low = F.lower(description)
    return F.when(low.contains("rain"), "rain").when(low.contains("fog"), "fog").otherwise("clear")


def infer_time_of_day(description: Column) -> Column:
    low = F.lower(description)
    return F.when(low.contains("night"), "night").when(low.contains("dusk") | low.contains("dawn"), "dusk").otherwise("day")


def manifest_hash(tokens: Column) -> Column:
    """SHA-256 of the sorted tokens of an array, each with a line end; of an empty array, that of no bytes."""
    return F.sha2(F.array_join(F.transform(F.array_sort(tokens), lambda t: F.concat(t, F.lit("\n"))), ""), 256)
