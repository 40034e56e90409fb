"""Column contracts of the layers and the mapping that lets other tables take the place of rank observations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

METRIC_SOURCES = {
    "numeric_popularity": "popularity",
    "numeric_read_count": "read_count",
    "numeric_score": "score",
    "numeric_words": "words_num",
}
METRICS = tuple(METRIC_SOURCES)

# Columns some later step reads: never removed for being empty.
NEEDED = frozenset(
    "book_id title author category1_name category2_name words_num status number unit rank_name rank_date "
    "score read_count popularity gender_type created_at updated_at".split()
)

DWD_TYPES = {
    **{name: "string" for name in "book_id title author category1_name category2_name rank_name status gender_type number unit".split()},
    "rank_date": "date",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    **{name: "double" for name in METRICS},
}


def as_observations(df: DataFrame, mapping: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Shape any table into the DWD contract. ``mapping`` is contract column -> SQL expression over ``df``;
    contract columns left out come from ``defaults`` or are NULL."""
    unknown = set(mapping) - set(DWD_TYPES)
    if unknown:
        raise ValueError(f"not in the contract: {sorted(unknown)}")
    defaults = defaults or {}
    return df.select(
        *(
            (F.expr(mapping[name]) if name in mapping else F.lit(defaults.get(name))).cast(kind).alias(name)
            for name, kind in DWD_TYPES.items()
        )
    )
