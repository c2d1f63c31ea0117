"""Small value helpers: tolerant casts and the genre-vector map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GENRE_MAP = "map<string,double>"


def safe_int(text: Column) -> Column:
    """Decoded integer field; malformed text becomes 0."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def safe_double(text: Column) -> Column:
    """Decoded float field; malformed text becomes 0.0."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def genre_map(vector: Column) -> Column:
    """Genre vector JSON as a map; anything that is not a JSON object is empty."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    return F.coalesce(F.from_json(vector, GENRE_MAP), empty)


def genre_weight(vector_map: Column, genre: Column | str) -> Column:
    key = F.lit(genre) if isinstance(genre, str) else genre
    return F.coalesce(F.try_element_at(vector_map, key), F.lit(0.0))
