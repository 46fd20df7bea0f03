"""Ranks, neighbours and running values that survive a hot key.

Spark evaluates one window group in one task, so a key that holds a third of all rows would
put a third of the data on one core. Here the rows are first laid out in order: dealt by
ranges of (keys, all sort columns, a hash of the row, a number that tells equal rows apart) and
sorted. So a key is cut wherever its share of the rows ends, also among equal sort columns and
among rows that are equal in every column. Windows run per (key, part) and their results are written
to the shared folder with the running number. Only the first and the last key of a part can go
on in another part, so one small row per part carries counts, ties, sums and edge rows across the
cuts, whatever the data.

``Ordered`` keeps the layout: one layout serves all windows over the same keys and order, also
after rows were filtered or columns added.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.session import stage

ID, PART = "__id", "__part"
_PART_SHIFT = 33  # monotonically_increasing_id puts the partition above 33 bits of row number
# Bytes of the files that the rows come from, per part.
PART_BYTES = 64 << 20


@dataclass(frozen=True)
class Sort:
    """One sort column. Nulls come first ascending and last descending, as in Spark."""

    column: str
    descending: bool = False

    def column_expr(self, reverse: bool = False) -> Column:
        down = self.descending != reverse
        return F.col(self.column).desc() if down else F.col(self.column).asc()


def sort_exprs(order: list[Sort], reverse: bool = False) -> list[Column]:
    return [s.column_expr(reverse) for s in order]


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a frame is computed from."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def part_count(df: DataFrame) -> int:
    """Parts of about PART_BYTES, and no fewer than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A frame made from rows in memory has no measured size; its estimate may be beyond all bounds.
    return max(least, min(100_000, math.ceil(source_bytes(df) / PART_BYTES)))


def told_apart(df: DataFrame, mix: str, number: str) -> DataFrame:
    """Add a hash of each row and a number that tells equal rows apart.

    Rows are numbered after a sort by their hash inside each partition: equal rows are neighbours
    there, so a repeated task gives the same rows the same numbers in whatever order it reads them.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.withColumn(mix, F.xxhash64(*hashed)).sortWithinPartitions(mix).withColumn(number, F.monotonically_increasing_id())


def laid_out(df: DataFrame, keys: list[str], order: list[Sort]) -> DataFrame:
    """The rows in order of keys and sort columns, with their running number and part."""
    numbered = told_apart(df, "__mix", "__tell")
    by = [*[F.col(k).asc() for k in keys], *sort_exprs(order), F.col("__mix"), F.col("__tell")]
    placed = numbered.repartitionByRange(part_count(df), *by).sortWithinPartitions(*by).drop("__mix", "__tell")
    placed = placed.withColumn(ID, F.monotonically_increasing_id())
    return placed.withColumn(PART, F.shiftright(ID, _PART_SHIFT))


def _without_helpers(df: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__") and c not in but])


def _struct(columns) -> Column:
    """Columns as a struct that is not null, whatever its fields."""
    return F.struct(F.lit(1).alias("is"), *[F.col(c) for c in dict.fromkeys(columns)])


class Ordered:
    """A frame laid out by keys and order. ``frame`` has the helper columns, ``rows()`` has not."""

    def __init__(self, frame: DataFrame, keys: list[str], order: list[Sort]):
        self.frame, self.keys, self.order = frame, keys, order

    @classmethod
    def of(cls, df: DataFrame, keys: list[str], order: list[Sort]) -> Ordered:
        return cls(laid_out(df, keys, order), keys, order)

    def replaced(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """The same layout with rows left out or columns added; helper columns must stay."""
        return Ordered(change(self.frame), self.keys, self.order)

    def rows(self) -> DataFrame:
        return _without_helpers(self.frame)

    def windows(
        self,
        ranks: dict[str, bool] | None = None,
        previous: dict[str, str] | None = None,
        before_previous: dict[str, str] | None = None,
        following: dict[str, str] | None = None,
        running: dict[str, Column] | None = None,
    ) -> Ordered:
        """Add any of these columns per key; the rows are written once, read for the edges and once more.

        * ranks: output name -> whether ties share a rank (``rank``) or not (``row_number``)
        * previous, before_previous, following: output name -> column of the row one before, two before, one after
        * running: output name -> expression whose sum over the rows up to this one is wanted
        """
        ranks, running = ranks or {}, running or {}
        previous, before_previous, following = previous or {}, before_previous or {}, following or {}
        inside = Window.partitionBy(*self.keys, PART)
        walk = inside.orderBy(ID)
        so_far = walk.rowsBetween(Window.unboundedPreceding, 0)
        ties = any(ranks.values())
        depth = 2 if before_previous else 1 if previous else 0
        back = _struct([*previous.values(), *before_previous.values()])
        value = F.struct(F.lit(1).alias("is"), *[F.col(s.column).alias(f"s{i}") for i, s in enumerate(self.order)])

        added = {"__n": F.row_number().over(walk).cast("long"), "__ends": F.lead(F.lit(1)).over(walk).isNull()}
        added |= {f"__p{n}": F.lag(back, n).over(walk) for n in range(1, depth + 1)}
        if following:
            added["__next"] = F.lead(_struct(following.values())).over(walk)
        if ties:
            added["__like"] = F.lag(value).over(walk).eqNullSafe(value)
        added |= {f"__sum{i}": F.sum(e).over(so_far) for i, e in enumerate(running.values())}
        body = self.frame.withColumns(added)
        if ties:
            # Place of the first row of each tie.
            body = body.withColumn("__tie", F.max(F.when(~F.col("__like"), F.col("__n"))).over(so_far))
        body = stage(body, "ordered")

        heads = {"low": value if ties else None, "head": _struct(following.values()) if following else None}
        tail = F.filter(F.array("__p1", back) if depth == 2 else F.array(back), lambda r: r.isNotNull())
        lasts = {"size": F.col("__n"), "high": value if ties else None, "tie": F.col("__tie") if ties else None, "tail": tail if depth else None}
        lasts |= {f"sum{i}": F.col(f"__sum{i}") for i in range(len(running))}
        summary = self._across(body, {k: e for k, e in heads.items() if e is not None}, {k: e for k, e in lasts.items() if e is not None})
        carried = self._carried(summary, ties, depth, bool(following), len(running))
        done = body.join(F.broadcast(carried), self._same(), "left")

        out = {}
        for name, tied in ranks.items():
            before = F.coalesce(F.col("__before"), F.lit(0))
            at_start = F.coalesce(F.col("__tied"), before + 1) if tied else None
            out[name] = F.when(F.col("__tie") == 1, at_start).otherwise(before + F.col("__tie")) if tied else before + F.col("__n")
        for i, name in enumerate(running):
            out[name] = F.coalesce(F.col(f"__sum{i}") + F.coalesce(F.col(f"__over{i}"), F.lit(0)), F.col(f"__over{i}"))
        if depth:
            found = {"__p1": F.coalesce("__p1", F.try_element_at("__tail", F.lit(-1)))}
            if depth == 2:
                # Only the first row of a slice looks two rows back into the tail.
                found["__p2"] = F.coalesce("__p2", F.try_element_at("__tail", F.when(F.col("__p1").isNull(), -2).otherwise(-1)))
            done = done.withColumns(found)
        if following:
            done = done.withColumn("__next", F.coalesce("__next", "__head"))
        out |= {o: F.col(f"__p1.{c}") for o, c in previous.items()}
        out |= {o: F.col(f"__p2.{c}") for o, c in before_previous.items()}
        out |= {o: F.col(f"__next.{c}") for o, c in following.items()}
        return Ordered(_without_helpers(done.withColumns(out), (ID, PART)), self.keys, self.order)

    def _same(self) -> Column:
        pairs = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)]
        return reduce(Column.__and__, pairs, F.col(PART) == F.col("__of"))

    def _across(self, body: DataFrame, heads: dict[str, Column], lasts: dict[str, Column]) -> DataFrame:
        """One row for the first and one for the last key of every part (one, if it is the same key).

        The first key has what its first row shows, and what its last row shows only if it is the last key too.
        """
        key = [F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)]
        head = F.struct(*key, *[e.alias(n) for n, e in heads.items()])
        last = F.struct(*key, *[e.alias(n) for n, e in lasts.items()])
        ends = body.where((F.col("__n") == 1) | F.col("__ends")).groupBy(PART).agg(
            F.min_by(head, ID).alias("first"), F.max_by(last, ID).alias("last")
        )
        names = [f"k{i}" for i in range(len(self.keys))]
        same = reduce(Column.__and__, [F.col(f"first.{n}").eqNullSafe(F.col(f"last.{n}")) for n in names], F.lit(True))
        ends = ends.withColumn("same", same)
        opening = F.struct(
            *[F.col(f"first.{n}").alias(n) for n in [*names, *heads]], *[F.when(F.col("same"), F.col(f"last.{n}")).alias(n) for n in lasts]
        )
        closing = F.struct(
            *[F.col(f"last.{n}").alias(n) for n in names], *[F.when(F.col("same"), F.col(f"first.{n}")).alias(n) for n in heads],
            *[F.col(f"last.{n}").alias(n) for n in lasts],
        )
        both = F.when(F.col("same"), F.array(opening)).otherwise(F.array(opening, closing))
        slices = ends.select(F.col(PART).alias("__of"), F.explode(both).alias("s"))
        return slices.select("__of", *[F.col(f"s.{n}").alias(f"__{n}") for n in [*names, *heads, *lasts]])

    def _carried(self, slices: DataFrame, ties: bool, depth: int, following: bool, sums: int) -> DataFrame:
        """What every slice gets from the slices of its key in earlier parts, and the head of the one after it."""
        names = [f"__k{i}" for i in range(len(self.keys))]
        across = Window.partitionBy(*names).orderBy("__of")
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        out = {"__before": F.coalesce(F.sum("__size").over(earlier), F.lit(0).cast("long"))}
        out |= {f"__over{i}": F.sum(f"__sum{i}").over(earlier) for i in range(sums)}
        if depth:
            # A slice may be shorter than ``depth``, so the rows before it come from several slices.
            out["__tail"] = F.flatten(F.collect_list("__tail").over(across.rowsBetween(-depth, -1)))
        if following:
            out["__head"] = F.lead("__head").over(across)
        if ties:
            out["__goes_on"] = F.coalesce(F.lag("__high").over(across).eqNullSafe(F.col("__low")) & F.lag("__of").over(across).isNotNull(), F.lit(False))
        done = slices.select("__of", *names, *[F.col(c) for c in ("__tie",) if ties], *[e.alias(c) for c, e in out.items()])
        if ties:
            # The rank of the tie that a slice ends with, if it starts in that slice.
            begins = F.when(~(F.col("__goes_on") & (F.col("__tie") == 1)), F.col("__before") + F.col("__tie"))
            carried = F.last(begins, ignorenulls=True).over(earlier)
            done = done.withColumn("__tied", F.when(F.col("__goes_on"), carried)).drop("__tie", "__goes_on")
        return done


def ranked(df: DataFrame, keys: list[str], order: list[Sort], out: str, ties: bool = False) -> DataFrame:
    """Add ``row_number`` (or ``rank`` when ``ties``) per key for every row.

    For a top-1 filter use ``windows.newest`` instead: it limits before the shuffle. Filter on
    the keys before ranking: the rows are written in order first.
    """
    return Ordered.of(df, keys, order).windows(ranks={out: ties}).rows()


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[Sort],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    before_previous: dict[str, str] | None = None,
) -> DataFrame:
    """Add columns of the previous row, the one before it, and the following row per key.

    Each argument maps an output name to the column it is taken from. The sort must be unique
    per key for a defined result.
    """
    return Ordered.of(df, keys, order).windows(previous=previous, before_previous=before_previous, following=following).rows()
