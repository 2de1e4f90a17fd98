"""Ordered per-key work that survives a hot key.

A window over ``partitionBy(key)`` puts a whole key in one task.  :func:`cut`
first counts rows per key (combined before the shuffle).  Where no key is large
the plain window is used.  Every large key is cut along its position at quantiles
of its own rows, so one far position or one busy hour does not fill a piece; each
piece is its own window partition, and what earlier pieces contribute (last value,
running total) arrives as one small carry row per piece.  The rows themselves are
shuffled once, by key and piece.

There are fewer pieces than ``rows / rows_per_piece`` and keys, and cut points and
carries are broadcast while that number is at most ``BROADCAST_PIECES``; beyond it
they are joined.  A single key is cut into ``MOST_PIECES`` at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from logweave.plans.sizing import settled

ROWS_PER_PIECE = 2_000_000
MOST_PIECES = 10_000
BROADCAST_PIECES = 200_000

PIECE = "__piece"
CUTS = "__cuts"
SLOT, AT, LENT = "__slot", "__at", "__lent"
NOT_CUT = -1


def _join_left(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null-safe left join on equal column names, keeping the left columns once."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in columns]
    condition = reduce(lambda a, b: a & b, same)
    return left.join(renamed, condition, "left").drop(*[f"__r_{c}" for c in columns])


@dataclass(frozen=True)
class Pieces:
    """Rows with their piece; operations return the same rows with one more column."""

    df: DataFrame
    keys: tuple[str, ...]
    position: str
    hot: bool
    # What the rows per key were counted on, and how many a piece may have.
    source: DataFrame
    rows_per_piece: int
    cuts: DataFrame | None = None
    most: int = 0
    small: bool = True

    def rows(self) -> DataFrame:
        return self.df.drop(PIECE)

    def _few(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def _with_piece(self, df: DataFrame, position: Column, name: str) -> DataFrame:
        """``name``: the number of the key's cut points below ``position``, by binary search."""
        steps = [1 << k for k in range(self.most.bit_length(), -1, -1)]
        cuts = F.col(CUTS)
        found = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(F.get(cuts, at + step - 1) < position, at + step).otherwise(at),
        )
        joined = _join_left(df, self._few(self.cuts), self.keys)
        return joined.withColumn(name, F.when(cuts.isNull(), F.lit(NOT_CUT)).otherwise(found)).drop(CUTS)

    def with_column(self, name: str, value: Column) -> Pieces:
        return replace(self, df=self.df.withColumn(name, value))

    def filter(self, condition: Column | str) -> Pieces:
        return replace(self, df=self.df.filter(condition))

    def _window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, PIECE) if self.hot else Window.partitionBy(*self.keys)

    def _with_carry(
        self, here: DataFrame, summary: Column, fold, combine, out: str, descending: bool = False
    ) -> DataFrame:
        """``combine(own, carry)``, the carry folding the summaries of the pieces before."""
        if not self.hot:
            return here.withColumn(out, F.col("__here")).drop("__here")
        order = F.col(PIECE).desc() if descending else F.col(PIECE)
        before = Window.partitionBy(*self.keys).orderBy(order)
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            self.df.filter(F.col(PIECE) != NOT_CUT)
            .groupBy(*self.keys, PIECE)
            .agg(summary.alias("__summary"))
            .select(*self.keys, PIECE, fold(F.col("__summary")).over(before).alias("__carry"))
        )
        return (
            _join_left(here, self._few(carry), [*self.keys, PIECE])
            .withColumn(out, combine(F.col("__here"), F.col("__carry")))
            .drop("__here", "__carry")
        )

    def last_known(
        self, order: Sequence[str], value: str, out: str, strictly_before: bool = False
    ) -> Pieces:
        """Last non-null ``value`` at or before each row."""
        rows = self._window().orderBy(*order)
        rows = rows.rowsBetween(Window.unboundedPreceding, -1 if strictly_before else 0)
        here = self.df.withColumn("__here", F.last(value, ignorenulls=True).over(rows))
        at = F.when(F.col(value).isNotNull(), F.struct(*order))
        joined = self._with_carry(
            here,
            F.max_by(value, at),
            lambda s: F.last(s, ignorenulls=True),
            F.coalesce,
            out,
        )
        return replace(self, df=joined)

    def running_total(
        self, order: Sequence[str], amount: str, out: str, newest_first: bool = False
    ) -> Pieces:
        """Sum of ``amount`` from one end of the order up to and with each row."""
        columns = [F.col(c).desc() if newest_first else F.col(c) for c in order]
        rows = self._window().orderBy(*columns)
        rows = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        here = self.df.withColumn("__here", F.sum(amount).over(rows))
        joined = self._with_carry(
            here,
            F.sum(amount),
            F.sum,
            lambda own, carry: own + F.coalesce(carry, F.lit(0)),
            out,
            newest_first,
        )
        return replace(self, df=joined)

    def trailing_sum(self, span: int, amount: str, out: str) -> Pieces:
        """Sum over rows whose position lies in ``[position - span, position]``, of those rows alone.

        Positions are laid out in slots as long as a window, so a window is the beginning
        of its row's slot and the end of the slot before.  Every row also goes to the next
        slot, and each part is a running total there, from either end: no window is summed
        anew and nothing is subtracted.  Large slots are cut as large keys are.
        """
        kept = [c for c in self.df.columns if c not in {*self.keys, amount}]
        lent = F.col(LENT)
        shown = {c: F.when(~lent, F.col(c)).alias(f"__kept_{c}") for c in kept}
        amounts = {"__own": F.when(~lent, F.col(amount)), "__borrowed": F.when(lent, F.col(amount))}
        sent = _lent(self.df, self.position, span).withColumns(amounts)
        sent = sent.select(*self.keys, SLOT, AT, LENT, *amounts, *shown.values())
        counted = _lent(self.source.select(*self.keys, self.position), self.position, span)
        split = cut(sent, [*self.keys, SLOT], AT, self.rows_per_piece, counted)
        # Rows of one position are in each other's windows.
        since = Window.unboundedPreceding, Window.currentRow
        for part, order in (("__own", F.col(AT)), ("__borrowed", F.col(AT).desc())):
            rows = split._window().orderBy(order).rangeBetween(*since)
            here = split.df.withColumn("__here", F.sum(part).over(rows))
            split = replace(
                split, df=split._with_carry(here, F.sum(part), F.sum, _added, f"{part}_sum", part == "__borrowed")
            )
        summed = split.rows().filter(~lent).withColumn(out, _added(F.col("__own_sum"), F.col("__borrowed_sum")))
        kept_again = {c: F.col("__own" if c == amount else c if c in self.keys else f"__kept_{c}") for c in self.df.columns}
        return replace(self, df=summed.select(*(v.alias(c) for c, v in kept_again.items()), out))


def _added(one: Column, other: Column) -> Column:
    """The sum of two sums, either of which may be null."""
    return F.coalesce(one + other, one, other)


def _lent(df: DataFrame, position: str, span: int) -> DataFrame:
    """Rows in their own slot of ``span + 1`` positions and once more, moved on by ``span``, in the next."""
    at, width = F.col(position), F.lit(span + 1)
    own = F.round((at - F.pmod(at, width)) / width).cast("bigint")
    both = F.when(at.isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    spread = df.withColumn(LENT, F.explode(both))
    moved = F.col(LENT).cast("int")
    return spread.withColumns({SLOT: own + moved, AT: at + moved * F.lit(span)})


def cut(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows_per_piece: int | None = None,
    source: DataFrame | None = None,
) -> Pieces:
    """Rows ready for ordered work per key; ``position`` is a bigint the order starts with.

    Runs the counting job, and where keys are large a second one for their
    quantiles.  Rows of equal position always share a piece; rows without a
    position are in the first.  ``source`` has the same keys and positions where
    ``df`` is dear to compute for those jobs.
    """
    rows_per_piece = rows_per_piece or ROWS_PER_PIECE
    source = df if source is None else source
    wanted = F.least(F.ceil(F.col("n") / F.lit(rows_per_piece)), F.lit(MOST_PIECES))
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = counted.filter(F.col("n") > F.lit(rows_per_piece)).select(*keys, wanted.cast("int").alias("__wanted"))
    large = settled(large, "large-keys")
    found = large.agg(F.max("__wanted").alias("most"), F.sum("__wanted").alias("all")).first()
    if found["most"] is None:
        return Pieces(df, tuple(keys), position, False, source, rows_per_piece)
    most, small = found["most"], found["all"] <= BROADCAST_PIECES
    marked = _join_left(source.select(*keys, position), F.broadcast(large) if small else large, keys)
    shares = F.array(*(F.lit(k / most) for k in range(1, most)))
    every = F.percentile_approx(F.col(position).cast("bigint"), shares, F.lit(max(10_000, 20 * most)))
    points = marked.filter("__wanted IS NOT NULL").groupBy(*keys).agg(every.alias("__all"), F.max("__wanted").alias("w"))

    def chosen(point: Column, k: Column) -> Column:
        return F.floor((k + 1) * F.col("w") / most) > F.floor(k * F.col("w") / most)

    points = points.select(*keys, F.array_distinct(F.filter("__all", chosen)).alias(CUTS))
    split = Pieces(df, tuple(keys), position, True, source, rows_per_piece, settled(points, "cut-points"), most, small)
    return replace(split, df=split._with_piece(df, F.col(position), PIECE))


def as_of(
    data: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    position: str,
    sequence: str,
    state: str = "state",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Each data row with the latest control ``state`` at or before its position.

    Both sides carry ``keys``, a bigint ``position`` (event time in
    microseconds, say) and a tie-breaking ``sequence``; at equal position
    control comes before data.  ``state`` is never null on the control side;
    data rows without any earlier control get null.

    One shuffle of the two sides together, no join between them.  ``state`` may not
    be a column of the data: a column of that name would be lost.
    """
    if state in data.columns:
        raise ValueError(f"the data has a column named {state}")
    events = control.select(*keys, position, sequence, F.col(state).alias("__given"), F.lit(0).alias("__kind"))
    tagged = data.withColumn("__kind", F.lit(1)).unionByName(events, allowMissingColumns=True)
    known = cut(tagged, keys, position, rows_per_piece).last_known(
        [position, "__kind", sequence], "__given", state
    )
    return known.filter(F.col("__kind") == 1).rows().drop("__kind", "__given")
