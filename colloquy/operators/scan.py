"""Running values per key, split so no key is one task.

A plain ``last(..) OVER (PARTITION BY key ORDER BY ...)`` puts a whole key in
one task. ``running`` splits each key into chunks (a caller-chosen expression
that grows with the order columns, e.g. hour of ``ts`` or ``turn div 4096``):

1. a window per (key, chunk) gives the values inside the chunk;
2. a grouped aggregate gives each chunk's last values;
3. a window over the small chunk table carries them across chunks;
4. a join on (key, chunk) fills rows whose chunk had no value yet.

Any number of values and previous rows go through one pass (one shuffle of the
rows). Keys and chunk travel as one struct, whose equality treats nulls as
equal, so null keys behave as in the plain window. The result equals the
single window; hot keys spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def chunked(df: DataFrame, keys: Sequence[str] | str, chunk: Column | None) -> DataFrame:
    """Add ``_k``: the key columns and the chunk as one struct."""
    c = (chunk if chunk is not None else F.lit(0)).alias("_chunk")
    return df.withColumn("_k", F.struct(F.struct(*[F.col(k) for k in _list(keys)]).alias("_key"), c))


def before_chunk() -> "Window":
    """Window over a chunk table (one row per ``_k``): the chunks before, oldest first."""
    return Window.partitionBy("_k._key").orderBy("_k._chunk").rowsBetween(Window.unboundedPreceding, -1)


def running(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str,
            values: Mapping[str, Column] | None = None, previous: Mapping[str, tuple[Column, int]] | None = None,
            inclusive: bool = True, chunk: Column | None = None) -> DataFrame:
    """For each ``values`` item add its latest non-null value at or before
    (``inclusive``) or strictly before each row; for each ``previous`` item
    ``name: (column, n)`` add ``name1`` .. ``name<n>``, the column's values (nulls
    included) 1..n rows back. Rows of a key are ordered by ``order``, a total order.

    Wrap a value in a struct to carry explicit nulls (a struct is non-null even
    when its field is)."""
    order, values, previous = _list(order), dict(values or {}), dict(previous or {})
    ocols = [F.col(c) for c in order]
    at = F.struct(*ocols)
    rows = chunked(df, keys, chunk)
    rows = rows.withColumns({f"_v_{n}": c for n, c in values.items()}
                            | {f"_p_{n}": F.struct(c.alias("v")) for n, (c, _) in previous.items()})
    here = Window.partitionBy("_k").orderBy(*ocols)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    local = rows.withColumns(
        {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in values}
        | {f"_b_{n}": F.array_compact(F.array(*[F.lag(f"_p_{n}", i).over(here) for i in range(1, k + 1)]))
           for n, (_, k) in previous.items()})
    # each chunk's last values; of its last rows, nearest first, as many as are asked for
    ends = [F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_e_{n}") for n in values]
    ends += [F.max_by(F.slice(F.concat(F.array(f"_p_{n}"), f"_b_{n}"), 1, k), at).alias(f"_t_{n}")
             for n, (_, k) in previous.items()]
    chunks = local.groupBy("_k").agg(*ends)
    w = before_chunk()
    carry = chunks.select(
        "_k", *[F.last(f"_e_{n}", ignorenulls=True).over(w).alias(f"_c_{n}") for n in values],
        *[F.flatten(F.reverse(F.collect_list(f"_t_{n}").over(w.rowsBetween(-k, -1)))).alias(f"_c_{n}")
          for n, (_, k) in previous.items()])
    out = local.join(carry, "_k", "left")
    out = out.withColumns(
        {n: F.coalesce(F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n in values}
        | {f"{n}{i}": F.get(F.concat(f"_b_{n}", f"_c_{n}"), F.lit(i - 1))["v"]
           for n, (_, k) in previous.items() for i in range(1, k + 1)})
    return out.drop("_k", *[f"_{p}_{n}" for n in values for p in "vlc"], *[f"_{p}_{n}" for n in previous for p in "pbc"])


def carry_last(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str, value: Column,
               out: str, inclusive: bool = True, chunk: Column | None = None) -> DataFrame:
    """``running`` for one value."""
    return running(df, keys, order, {out: value}, inclusive=inclusive, chunk=chunk)


def time_chunk(ts: str = "ts", unit: str = "hour") -> Column:
    """Chunk expression for event-time ordered keys: the ``unit`` (hour by
    default) holding the event, so a busy key is cut into many chunks."""
    return F.date_trunc(unit, F.col(ts))


def turn_chunk(turn: str = "turn", width: int = 4096) -> Column:
    """Chunk expression for turn-ordered conversations."""
    return F.floor(F.col(turn) / F.lit(width))
