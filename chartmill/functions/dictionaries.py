"""Code dictionaries as small tables.

A ladder of `CASE` arms with a hundred conditions is evaluated arm by arm for every row; the same ladder as a
table costs one hash probe.  The tables below come from fixed lists, so their size is known and broadcasting
them is safe whatever the data's size.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.functions import fixed_values as fixed
from chartmill.operators.lookups import dimension


def first_wins(pairs: Iterable[tuple]) -> list[tuple]:
    """Keep the first pair of each key, as an ordered ladder of conditions would."""
    kept: dict = {}
    for key, *rest in pairs:
        kept.setdefault(key, (key, *rest))
    return list(kept.values())


def dead_arms(pairs: Iterable[tuple]) -> list[tuple]:
    """The pairs an earlier pair with the same key hides."""
    seen: set = set()
    hidden = []
    for pair in pairs:
        if pair[0] in seen:
            hidden.append(pair)
        seen.add(pair[0])
    return hidden


def untrimmed_keys(pairs: Iterable[tuple]) -> list[str]:
    """Keys with blanks around them: kept as they are, but they will hardly ever match."""
    return [key for key, *_ in pairs if isinstance(key, str) and key != key.strip()]


def encounter_type_rows() -> list[tuple[int, int | None, str]]:
    rows = []
    for line in fixed.ENCOUNTER_TYPES.split("\n"):
        if line:
            source, target_id, target_uuid = line.split()
            rows.append((int(source), None if target_id == "-" else int(target_id), target_uuid))
    return first_wins(rows)


def disagreeing_types() -> list[int]:
    """Source types without a target id, or whose target uuid usually goes with another id."""
    rows = encounter_type_rows()
    usual: dict[str, dict] = {}
    for _, target_id, target_uuid in rows:
        counts = usual.setdefault(target_uuid, {})
        counts[target_id] = counts.get(target_id, 0) + 1
    return [
        source for source, target_id, target_uuid in rows
        if target_id is None or usual[target_uuid][target_id] < max(usual[target_uuid].values())
    ]


def identifier_type_rows() -> list[tuple[str, str]]:
    return first_wins(tuple(line.split()) for line in fixed.IDENTIFIER_TYPES.split("\n") if line)


def program_rows() -> list[tuple[str, str]]:
    return first_wins(fixed.PROGRAMS)


def encounter_types(spark: SparkSession) -> DataFrame:
    columns = zip(*encounter_type_rows())
    return _table(spark, ["encounter_type_id", "target_type_id", "target_type_uuid"], columns,
                  [pa.int32(), pa.int32(), pa.string()])


def identifier_types(spark: SparkSession) -> DataFrame:
    return _table(spark, ["type_uuid", "target_type_uuid"], zip(*identifier_type_rows()), [pa.string()] * 2)


def programs(spark: SparkSession) -> DataFrame:
    return _table(spark, ["program_uuid", "target_program_uuid"], zip(*program_rows()), [pa.string()] * 2)


def map_codes(df: DataFrame, dictionary: DataFrame, key: str, dictionary_key: str, default: str | None = None):
    """Add the dictionary's other columns to every row; unmapped rows get nulls, or `default` as text."""
    targets = [c for c in dictionary.columns if c != dictionary_key]
    renamed = dictionary.withColumnRenamed(dictionary_key, "_key")
    out = df.join(dimension(renamed), df[key] == F.col("_key"), "left").drop("_key")
    if default is not None:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in targets})
    return out


def _table(spark: SparkSession, names: list[str], columns, types) -> DataFrame:
    arrays = [pa.array(list(values), type=kind) for values, kind in zip(columns, types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=names))
