"""Latest revisions and the statement join chain.

Skew.  Rows whose record key has a NULL part can never match, so they skip every join and are added back at the end.  Keys
with more than ``HOT_ROWS`` rows in any table are found by an exact count (see ``heavy``).  Their rows are ranked in place,
against the top revision that the count has found, and joined in blocks; all other keys take one window and the plain joins.

Order.  A record key has eight columns, mostly text.  Rows are sorted by a hash of the key before the key itself, so that one
number decides most comparisons of the window.  The join chain goes by two independent 64-bit hashes of the key, 128 bits together, in
place of it: only the left-most table carries the key itself through shuffles, sorts and what they spill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from .. import keys as K
from . import heavy as H
from .heavy import HeavyKeys, heavy_keys

# Rows of one key that a single task may hold.
HOT_ROWS = 2_000_000
# Hash of the record key, first in sorts and joins.
HASH = "__hash"
# A second one, independent of the first: together they stand for the key.
HASH2 = "__hash2"
# Read alone when heavy keys are looked for.
FRONT = (K.COMPANY,)


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rows with a NULL key part)."""
    incomplete = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.where(~incomplete), df.where(incomplete)


def latest_revision(
    df: DataFrame,
    keys: Sequence[str] = K.RECORD_KEYS,
    revision: str = K.REVISION,
    hot_rows: int = HOT_ROWS,
    rank_column: str | None = None,
) -> DataFrame:
    """Rows that carry the highest revision of their key; ties all stay, and NULL equals NULL in a key.

    Rows of a key with more than ``hot_rows`` rows stay where they are: the count that finds such a key also knows its
    highest revision.
    """
    kept = _latest(df, "rows", heavy_keys({"rows": df}, keys, hot_rows, revision, FRONT), keys, revision)
    return kept.withColumn(rank_column, F.lit(1)) if rank_column else kept


def _latest(df: DataFrame, name: str, heavy: HeavyKeys | None, keys: Sequence[str], revision: str) -> DataFrame:
    light = hashed(df if heavy is None else heavy.light(df), keys)
    light = H.ranked_window(light, selective_first([HASH, *keys]), revision).drop(HASH)
    return light if heavy is None else light.unionByName(heavy.latest(df, name, revision))


def hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``HASH``, a hash of its key."""
    return df.withColumn(HASH, F.xxhash64(*keys))


def _by_hashes(tables: Mapping[str, DataFrame], base: str, keys: Sequence[str]) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables with ``HASH`` and ``HASH2`` and what they are joined on: these, without the key in all tables but ``base``.  Keys have no
    NULL part.  Where equal keys of other types would hash to others, the tables are as they were and joined on the key."""
    types = {tuple(df.schema[k].dataType for k in keys) for df in tables.values()}
    if len(types) > 1:
        return dict(tables), list(keys)
    both = {name: hashed(df, keys).withColumn(HASH2, F.xxhash64(F.lit(HASH2), *keys)) for name, df in tables.items()}
    return {name: df if name == base else df.drop(*keys) for name, df in both.items()}, [HASH, HASH2]


def selective_first(keys: Sequence[str]) -> list[str]:
    """The same keys, company ids in front: a sort then mostly decides on its first column."""
    return H.selective_first(keys, (HASH, HASH2, K.SERIES_ID, K.COMPANY))


def join_no_dup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a non-key column found on both sides is taken from the left."""
    shared = (set(left.columns) & set(right.columns)) - set(on)
    joined = left.join(right.drop(*shared), selective_first(on), how)
    return joined.select(*on, *[c for c in joined.columns if c not in on])


def join_statements(
    tables: Mapping[str, DataFrame],
    rank: str = "all",
    keys: Sequence[str] = K.RECORD_KEYS,
    order: Sequence[str] = K.STATEMENT_ORDER,
    revision: str = K.REVISION,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join the statement tables on the record key, left columns winning.

    ``rank='all'`` keeps the latest revision of every table, ``rank='none'`` keeps all
    revisions, and the name of one table ranks that table alone and requires a match in it.
    """
    base, *others = [name for name in order if name in tables]
    names = [base, *others]
    ranked = [name for name in names if rank in ("all", name)]
    heavy = heavy_keys({name: tables[name] for name in names}, keys, hot_rows, revision if ranked else None, FRONT)
    complete, incomplete = {}, None
    for name in names:
        complete[name], rest = split_null_keys(tables[name], keys)
        if name == base:
            incomplete = _latest(rest, base, heavy, keys, revision) if base in ranked else rest
    hows = {name: "inner" if rank == name else "left" for name in others}

    def chain(rows: Mapping[str, DataFrame]) -> DataFrame:
        rows, on = _by_hashes(rows, base, keys)
        tops = {name: H.ranked_window(df, selective_first(on), revision) if name in ranked else df for name, df in rows.items()}
        out = reduce(lambda out, name: join_no_dup(out, tops[name], on, hows[name]), others, tops[base]).drop(HASH, HASH2)
        return out.select(*keys, *[c for c in out.columns if c not in keys]) if others else out

    if heavy is None:
        out = chain(complete)
    else:
        light = chain({name: heavy.light(df) for name, df in complete.items()})
        hot = {name: heavy.latest(df, name, revision) if name in ranked else df for name, df in complete.items()}
        combine = {name: join_no_dup for name in others}
        out = light.unionByName(_heavy_chain(heavy, hot, names, ranked, keys, hows, combine))
    if rank in others:
        return out
    return out.unionByName(incomplete, allowMissingColumns=True)


def _heavy_chain(heavy: HeavyKeys, tables, names, ranked, keys, hows, combine) -> DataFrame:
    """The chain over the rows of heavy keys, dealt out in blocks at every join."""
    blocks = heavy.blocks(names, ranked)
    base, *others = names
    # The base keeps its name, so that its columns can be told from others of the same name.
    out = H.numbered(heavy.heavy(tables[base], *blocks), "__id").alias(base)
    for step, name in enumerate(others, 1):
        right = H.numbered(heavy.heavy(tables[name], *blocks), "__rid")
        out = H.dealt_join(out, right, keys, step, hows[name], combine[name])
    return out.drop("__id", *[c for c in out.columns if c.startswith(("__bl", "__br"))])


def left_join_chain(
    tables: Mapping[str, DataFrame],
    keys: Sequence[str] = K.RECORD_KEYS,
    order: Sequence[str] = K.ALL_COLUMNS_ORDER,
) -> DataFrame:
    """Left-join the tables and keep all columns; each table is addressable by its name."""
    base, *others = [name for name in order if name in tables]
    return reduce(
        lambda out, name: out.join(tables[name].alias(name), selective_first(keys), "left"),
        others,
        tables[base].alias(base),
    )


def join_and_select(
    tables: Mapping[str, DataFrame],
    sectors: DataFrame | None = None,
    columns: Sequence[str] = K.JOINED_COLUMNS,
    keys: Sequence[str] = K.RECORD_KEYS,
    order: Sequence[str] = K.ALL_COLUMNS_ORDER,
    company: str = K.COMPANY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The join chain, the sector of each company, and the wanted columns of the result."""
    base, *others = [name for name in order if name in tables]
    complete, incomplete = split_null_keys(tables[base], keys)
    rights = {name: split_null_keys(tables[name], keys)[0] for name in others}
    heavy = heavy_keys({base: complete, **rights}, keys, hot_rows, front=FRONT)
    light = {base: complete, **rights}
    if heavy is not None:
        light = {name: heavy.light(df) for name, df in light.items()}
    joined = left_join_chain(light, keys, order)
    parts = [joined]
    if heavy is not None:
        # Bound now: the name of the right table goes with each join.
        combine = {
            name: lambda left, right, on, how, name=name: left.join(right.alias(name), selective_first(on), how)
            for name in others
        }
        hows = dict.fromkeys(others, "left")
        parts.append(_heavy_chain(heavy, {base: complete, **rights}, [base, *others], [], keys, hows, combine))
    unmatched = incomplete.alias(base)
    if sectors is not None:
        parts = [part.join(sectors, company, "left") for part in parts]
        unmatched = unmatched.join(sectors, company, "left")
    names = [c.rsplit(".", 1)[-1] for c in columns]
    chosen = [part.select([F.col(c).alias(n) for c, n in zip(columns, names)]) for part in parts]
    selected = reduce(DataFrame.unionByName, chosen)
    types = {f.name: f.dataType for f in selected.schema.fields}
    present = set(unmatched.columns)
    rest = unmatched.select(
        [
            F.col(c).alias(n)
            if n in present and ("." not in c or c.startswith(base + "."))
            else F.lit(None).cast(types[n]).alias(n)
            for c, n in zip(columns, names)
        ]
    )
    return selected.unionByName(rest)


def add_sector(df: DataFrame, sectors: DataFrame, company: str = K.COMPANY) -> DataFrame:
    """Left join of the company's sector code."""
    return df.join(sectors, company, "left")
