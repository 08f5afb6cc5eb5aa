"""Surrogate keys that outlive a reload.

The map from business key to id is a staged table of its own. A load adds the keys it
has not met yet, with ids after the largest one, and changes no old id, so facts staged
by earlier loads still point to the members they were given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staged import shared_folder, stage
from .dims import surrogate_key
from .joins import lookup_join


def extend_key_map(
    known: DataFrame | None, rows: DataFrame, key: Sequence[str], id_column: str, **limits: int
) -> DataFrame:
    """The key map after a load: ``id_column`` and the key columns.

    ``known`` is the map so far, None for the first load. New keys are numbered
    densely after its largest id (0 and less are left to unknown members). NULLs in a
    key are equal to each other. Stage the result, to a new path, for the next load.
    """
    names = list(key)
    new = rows.select(*names).distinct()
    if known is None:
        return surrogate_key(new, names, id_column)
    # An earlier run of the same load may be part of the map: nothing is new then.
    new = lookup_join(new, known.select(*names), names, "left_anti", null_safe=True, **limits)
    new = stage(new, shared_folder(rows.sparkSession, "new-keys"))
    largest = known.agg(F.greatest(F.coalesce(F.max(id_column), F.lit(0)), F.lit(0))).first()[0]
    numbered = surrogate_key(new, names, id_column).withColumn(
        id_column, F.col(id_column) + F.lit(largest)
    )
    return known.select(id_column, *names).unionByName(numbered)


def with_ids(
    rows: DataFrame, key_map: DataFrame, key: Sequence[str], id_column: str,
    unknown: int = 0, **limits: int,
) -> DataFrame:
    """Rows with the id of their key, or that of the unknown member."""
    joined = lookup_join(rows, key_map.select(id_column, *key), list(key), null_safe=True, **limits)
    return joined.withColumn(id_column, F.coalesce(id_column, F.lit(unknown)).cast("long"))
