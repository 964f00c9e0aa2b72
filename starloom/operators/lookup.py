"""Foreign-key lookups that never lose a row, nor multiply one if the lookup side's keys are unique.

``refuse_repeated`` sees to that before a load looks anything up.

No broadcast is forced: dimensions are read from written tables, so the planner
knows their size, broadcasts a small one and sort-merges a large one, where
adaptive execution splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import refuse_repeated_values
from starloom.schema import UNKNOWN_KEY


def lookup_fk(df: DataFrame, key: str, dim: DataFrame, dim_key: str, sk: str) -> DataFrame:
    """Add ``sk`` found by ``key = dim_key``; -1 where nothing is found.

    The -1 row takes no part in the match: its label may also occur as a spelling,
    and such a row would match twice.
    """
    known = dim.where(F.col(sk) != UNKNOWN_KEY).select(
        F.col(dim_key).alias("__match"), F.col(sk).alias("__found")
    )
    joined = df.join(known, F.col(key) == F.col("__match"), "left")
    return joined.withColumn(sk, F.coalesce("__found", F.lit(UNKNOWN_KEY))).drop("__match", "__found")


def refuse_repeated(lookup: DataFrame, key: str, sk: str, name: str) -> None:
    """Raise with some of the keys that stand on more than one row of the lookup side, if there are any."""
    refuse_repeated_values(lookup.where(F.col(sk) != UNKNOWN_KEY), key, name)


def store_lookup(stores: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Lookup side for store names: every store key plus every alias (``apelido``, ``chave_loja``).

    An alias goes before a store of that very name. An alias of no known store stays unresolved. An alias
    given twice counts once.
    """
    keys = stores.select("chave_loja", "sk_loja")
    if aliases is None:
        return keys
    aliases = aliases.select("apelido", "chave_loja").distinct()
    plain = keys.join(aliases, keys["chave_loja"] == aliases["apelido"], "left_anti")
    renamed = aliases.join(keys, "chave_loja").select(F.col("apelido").alias("chave_loja"), "sk_loja")
    return plain.unionByName(renamed)
