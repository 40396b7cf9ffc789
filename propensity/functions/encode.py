"""Categorical encoders as map literals inside codegen (X9-X13) and struct packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def map_code(col: str, mapping: dict, on_unseen: str = "error") -> Column:
    """Look ``col`` up in ``mapping``.  ``on_unseen='error'`` fails the query on
    a value (or NULL) outside the map; ``'null'`` yields NULL."""
    lit_map = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    code = F.try_element_at(lit_map, F.col(col))
    if on_unseen == "null":
        return code
    if on_unseen != "error":
        raise ValueError("on_unseen must be 'error' or 'null'")
    msg = F.concat(F.lit(f"unseen value for {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))
    return F.coalesce(code, F.raise_error(msg).cast("int"))


def encode(df: DataFrame, maps: dict = S.ENCODERS, prefix: str = "x_",
           on_unseen: str = "error") -> DataFrame:
    """Ordinal codes for Gender, Vehicle_Age, Vehicle_Damage, written to
    ``prefix + col`` (``prefix=''`` overwrites in place), in one projection."""
    return df.withColumns({f"{prefix}{c}": map_code(c, m, on_unseen) for c, m in maps.items()})


def factor_codes(df: DataFrame, cols: list[str], base: int = 1) -> DataFrame:
    """Codes by alphabetical (binary / code point) order of the distinct
    values, starting at ``base``; NULL stays NULL.  The levels of all columns
    come from one pass (unpivot, distinct), are ranked by the distributed
    index and joined back by value, however many there are."""
    from ..operators.sampling import dense_index, materialize

    if not cols:
        return df
    levels = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "name", "value").where(F.col("value").isNotNull()).distinct())
    ranked = materialize(dense_index(levels, ["name"], ["value"], name="code"), "levels")
    out = df
    for i, c in enumerate(cols):
        mine = ranked.where(F.col("name") == c).select(
            F.col("value").alias(f"_v{i}"), (F.col("code") + base).cast("int").alias(f"_f{i}"))
        out = out.join(mine, F.col(c).cast("string") == F.col(f"_v{i}"), "left")
    return out.select(*[F.col(f"_f{cols.index(c)}").alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def pack(df: DataFrame, cols: list[str], name: str = "features") -> DataFrame:
    """The given columns packed into one struct column."""
    return df.withColumn(name, F.struct(*cols))
