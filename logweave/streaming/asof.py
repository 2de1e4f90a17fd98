"""As-of state on streams.

Control and data rows of different logs arrive in any order.  Rows are held per
key until the watermark has passed them, then replayed in event-time order
(control before data at equal time), which gives what
:func:`logweave.plans.pieces.as_of` gives on the finished log.  Rows that come too
late are told apart, and a closing row lets go of those still held.

Data rows of one key do not depend on each other, so a hot key is spread over
``salts`` state instances; its control rows go to each of them.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField, StructType

from logweave.functions.times import epoch_micros
from logweave.session import ROCKSDB

CONTROL, DATA, CLOSING = 0, 1, 2
# Rows are late or due by buckets of this much event time.
BUCKET_MILLIS = 1000
# Arriving rows are sorted in runs of so many, and wait in chunks of so many.
RUN_ROWS, CHUNK_ROWS = 20_000, 1_000
# A map task packs so many rows, or bytes, at a time; a packed result has so many items of sets at most.
PACK_ROWS, PACK_BYTES, RESULT_ITEMS = 200_000, 32 << 20, 500_000
_ITEMS = StructType([StructField("items", ArrayType(StringType()))])
_SEEN = StructType([*_ITEMS.fields, StructField("last", LongType())])
_CHUNK = StructType([StructField("first", LongType()), StructField("number", LongType())])


def changed(items: set[str], action: str, arguments: Sequence[str]) -> set[str]:
    """One control event applied to a set: replace, add or remove."""
    given = {a for a in arguments if a}
    if action == "replace":
        return given
    return items | given if action == "add" else items - given


class DecideAtOnce(StatefulProcessor):
    """Emits data rows with the set of their key as far as it is known; nothing is held back.

    The rows of a batch are replayed in event-time order; a control row that
    arrives in a later batch than a data row after it comes too late for that row.
    The rows that a batch has of one key and salt are sorted in memory; for batches
    without a bound, :func:`logweave.streaming.jobs.filter_products_writer` cuts them.
    """

    def __init__(self, given: StructType, emitted: Sequence[str]):
        self._schema = given
        self._emitted = list(emitted)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._current = handle.getValueState("current", _ITEMS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        items = set(self._current.get()[0]) if self._current.exists() else set()
        before, out = set(items), []
        for row in sorted(rows, key=lambda r: (r["pos"], r["kind"], r["seq"])):
            if row["kind"] == CONTROL:
                items = changed(items, row["action"], row["arguments"] or [])
            else:
                out.append(Row(**{n: row[n] for n in self._emitted}, items=sorted(items, key=str.encode)))
        if items != before:
            self._current.update((sorted(items),))
        return iter(out)

    def close(self) -> None:
        pass


class HoldUntilWatermark(StatefulProcessor):
    """Holds rows of a key until the watermark passes them; emits data rows with the set.

    Rows wait in a map of buckets of event time, and a timer at its end replays one
    bucket, so neither a timer nor an arrival touches the rest of what waits.  A row
    whose bucket has been replayed is late: a data row is emitted at once, ``late``,
    with the set as it is known, and a control row counts from now on, unless a later
    one has been applied.  A CLOSING row is nobody's: it only moves the watermark.
    """

    def __init__(self, held: StructType, emitted: Sequence[str], bucket_millis: int = BUCKET_MILLIS):
        self._schema = held
        self._emitted = list(emitted)
        self._bucket = bucket_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        bucket = StructType([StructField("bucket", LongType())])
        self._pending = handle.getMapState("pending", bucket, StructType([StructField("rows", ArrayType(self._schema))]))
        self._begin(handle)

    def _begin(self, handle: StatefulProcessorHandle) -> None:
        self._current = handle.getValueState("current", _SEEN)
        self._row, self._out = Row(*self._schema.names), Row(*self._emitted, "items", "late")

    def _replayed(self, rows: Iterator[Row], late: bool) -> Iterator[Row]:
        """``rows``, in their turn, applied to the set of the key."""
        items, last = set(), None
        if self._current.exists():
            known = self._current.get()
            items, last = set(known[0]), known[1]
        shown, out, moved = sorted(items, key=str.encode), [], False
        for row in rows:
            if row["kind"] != CONTROL:
                out.append(self._out(*(row[n] for n in self._emitted), shown, late))
            elif last is None or (row["pos"] is not None and row["pos"] >= last):
                items = changed(items, row["action"], row["arguments"] or [])
                shown, last, moved = sorted(items, key=str.encode), row["pos"], True
        if moved:
            self._current.update((sorted(items), last))
        return iter(out)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names, width = self._schema.names, self._bucket * 1000
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        fresh, late = {}, []
        for row in rows:
            if row["kind"] == CLOSING:
                continue
            bucket = None if row["pos"] is None else row["pos"] // width
            if bucket is None or (bucket + 1) * width <= passed:
                late.append(row)
            else:
                fresh.setdefault(bucket, []).append(tuple(row[n] for n in names))
        for bucket, added in fresh.items():
            if self._pending.containsKey((bucket,)):
                added = [*map(tuple, self._pending.getValue((bucket,))[0]), *added]
            else:
                self._handle.registerTimer((bucket + 1) * self._bucket)
            self._pending.updateValue((bucket,), (added,))
        return self._replayed(sorted(late, key=_turn), True) if late else iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bucket = expiredTimerInfo.getExpiryTimeInMs() // self._bucket - 1
        if not self._pending.containsKey((bucket,)):
            return iter([])
        due = [self._row(*row) for row in self._pending.getValue((bucket,))[0]]
        self._pending.removeKey((bucket,))
        return self._replayed(sorted(due, key=_turn), False)

    def close(self) -> None:
        pass


class HoldInChunks(HoldUntilWatermark):
    """:class:`HoldUntilWatermark` with state read and written once per chunk of rows, not per bucket.

    Waiting rows lie in chunks sorted by time, a map entry each, named by their first
    bucket, and are merged when they are due.  A chunk that the watermark has only partly
    passed is read, and its rest waits on as a chunk; the others are not touched.  One
    timer, at the first bucket that waits, is enough.
    """

    def __init__(
        self,
        held: StructType,
        emitted: Sequence[str],
        bucket_millis: int = BUCKET_MILLIS,
        run_rows: int = RUN_ROWS,
        chunk_rows: int = CHUNK_ROWS,
    ):
        super().__init__(held, emitted, bucket_millis)
        self._run_rows, self._chunk_rows = run_rows, chunk_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getMapState("waiting", _CHUNK, StructType([StructField("rows", BinaryType())]))
        self._chunks = handle.getValueState("chunks", StructType([StructField("count", LongType())]))
        self._arrow = to_arrow_schema(self._schema)
        self._begin(handle)

    def _bucket_of(self, row: Row) -> int:
        return row["pos"] // (self._bucket * 1000)

    def _is_past(self, bucket: int, timerValues) -> bool:
        return (bucket + 1) * self._bucket <= timerValues.getCurrentWatermarkInMs()

    def _put(self, rows: Sequence[Row], number: int) -> int:
        """Rows in their turn as one chunk; returns its first bucket."""
        first = self._bucket_of(rows[0])
        columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), self._arrow)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self._arrow) as stream:
            stream.write_batch(pa.record_batch(columns, schema=self._arrow))
        self._waiting.updateValue((first, number), (sink.getvalue().to_pybytes(),))
        return first

    def _get(self, chunk: tuple[int, int]) -> list[Row]:
        with pa.ipc.open_stream(self._waiting.getValue(chunk)[0]) as stream:
            columns = stream.read_all().to_pydict()
        return [self._row(*values) for values in zip(*(columns[n] for n in self._schema.names))]

    def _wake_at(self, first: int) -> None:
        self._handle.registerTimer((first + 1) * self._bucket)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        late = []

        def fresh() -> Iterator[Row]:
            for row in rows:
                if row["kind"] == CLOSING:
                    continue
                if row["pos"] is None or self._is_past(self._bucket_of(row), timerValues):
                    late.append(row)
                else:
                    yield row

        waiting, firsts = fresh(), []
        number = before = self._chunks.get()[0] if self._chunks.exists() else 0
        while run := sorted(islice(waiting, self._run_rows), key=_turn):
            for at in range(0, len(run), self._chunk_rows):
                firsts.append(self._put(run[at : at + self._chunk_rows], number))
                number += 1
        if number > before:
            self._chunks.update((number,))
            self._wake_at(min(firsts))
        return self._replayed(sorted(late, key=_turn), True) if late else iter([])

    def _due(self, chunks: Sequence[tuple[int, int]], timerValues) -> Iterator[Row]:
        """Rows of sorted ``chunks`` that the watermark has passed, in their turn; what it has not passed is put back."""
        opened: list[tuple] = []

        def advance(rows: Iterator[Row], number: int) -> None:
            row = next(rows, None)
            if row is not None:
                heapq.heappush(opened, (_turn(row), number, row, rows))

        to_open = deque(chunks)
        while to_open or opened:
            # A chunk is read when its first bucket comes.
            while to_open and (not opened or to_open[0][0] <= self._bucket_of(opened[0][2])):
                chunk = to_open.popleft()
                found = self._get(chunk)
                self._waiting.removeKey(chunk)
                past = bisect_left(found, True, key=lambda row: not self._is_past(self._bucket_of(row), timerValues))
                if past < len(found):
                    self._put(found[past:], chunk[1])
                advance(iter(found[:past]), chunk[1])
            _, number, row, rest = heapq.heappop(opened)
            yield row
            advance(rest, number)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting = sorted(tuple(chunk) for chunk in self._waiting.keys())
        due = [chunk for chunk in waiting if self._is_past(chunk[0], timerValues)]
        if not due:
            return iter([])
        out = self._replayed(self._due(due, timerValues), False)
        left = min((chunk[0] for chunk in self._waiting.keys()), default=None)
        if left is not None:
            self._wake_at(left)
        return out


def _columns(schema: StructType) -> pa.Schema:
    """The Arrow form of packed rows, the same wherever they are packed and read."""
    return pa.schema([pa.field(f.name, f.type) for f in to_arrow_schema(schema)])


def _in_turn(rows: pa.Table, *before: str) -> pa.Table:
    """Rows by ``before`` and then by their turn, as :func:`_turn` has it."""
    order = [(name, "ascending") for name in (*before, "pos", "kind", "seq")]
    return rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))


def _blob(rows: pa.Table) -> bytes:
    """A table as the bytes of one record batch, without its schema."""
    batches = rows.combine_chunks().to_batches()
    return batches[0].serialize().to_pybytes()


def _pack(rows: pa.Table, groups: Sequence[str], columns: pa.Schema) -> pa.RecordBatch:
    """One row per group with all its rows, in their turn, as bytes."""
    rows = rows.filter(pc.not_equal(rows["kind"], CLOSING)).combine_chunks()
    codes = {f"__{i}": _codes(rows[name]) for i, name in enumerate(groups)}
    for name, code in codes.items():
        rows = rows.append_column(name, pa.array(code))
    rows = _in_turn(rows, *codes).combine_chunks()
    new = np.zeros(max(rows.num_rows, 1), dtype=bool)
    new[:1] = rows.num_rows > 0
    for name in codes:
        code = rows[name].to_numpy()
        new[1:] |= code[1:] != code[:-1]
    starts = np.flatnonzero(new)
    held = rows.select(columns.names).cast(columns).combine_chunks()
    blobs = [_blob(held.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], rows.num_rows])]
    keys = rows.select(groups).take(pa.array(starts, pa.int64()))
    return keys.append_column("rows", pa.array(blobs, pa.binary()))


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """A number for every value of a column; null has one too."""
    return pa.chunked_array([column.combine_chunks().dictionary_encode("encode").indices], pa.int32()).to_numpy()


def packed(groups: Sequence[str], held: StructType):
    """What a map task does before the rows go to their groups: many rows of a group become one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, taken, rows, size = _columns(held), [], 0, 0
        for batch in batches:
            taken.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= PACK_ROWS or size >= PACK_BYTES:
                yield from _pack(pa.Table.from_batches(taken), groups, columns).to_batches()
                taken, rows, size = [], 0, 0
        if rows:
            yield from _pack(pa.Table.from_batches(taken), groups, columns).to_batches()

    return pack


def unpacked(given: StructType):
    """The rows of packed results."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _columns(given)
        for batch in batches:
            for blob in batch["rows"]:
                yield pa.ipc.read_record_batch(blob.as_buffer(), columns)

    return unpack


class HoldPacked(HoldInChunks):
    """:class:`HoldInChunks` on packed rows: sorted, kept, merged and emitted as columns.

    Python sees one row per run of a key, not per row of the log; only control rows are
    applied one by one.  What is due is merged from chunks that are opened as their time
    comes, at least as many rows anew as are still open.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._arrow = _columns(self._schema)
        self._given = _columns(StructType([f for f in self._schema if f.name in self._emitted]))
        self._result = pa.schema([*self._given, *_columns(_ITEMS), pa.field("late", pa.bool_())])
        self._packed = Row("rows")

    def _table(self, blob: bytes) -> pa.Table:
        return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(blob), self._arrow)])

    def _begin_of_time(self, timerValues) -> int:
        """The first position that the watermark has not passed."""
        return timerValues.getCurrentWatermarkInMs() // self._bucket * self._bucket * 1000

    def _put_table(self, rows: pa.Table, number: int) -> int:
        first = rows["pos"][0].as_py() // (self._bucket * 1000)
        self._waiting.updateValue((first, number), (_blob(rows),))
        return first

    def _replay(self, tables: Iterator[pa.Table], late: bool) -> Iterator[Row]:
        """Sorted ``tables``, one after the other, applied to the set of the key; data rows come out packed."""
        items, last, moved = set(), None, False
        if self._current.exists():
            known = self._current.get()
            items, last = set(known[0]), known[1]
        shown = None
        for rows in tables:
            kinds = rows["kind"].to_numpy()
            control = np.flatnonzero(kinds == CONTROL)
            told = rows.select(["pos", "action", "arguments"]).take(pa.array(control, pa.int64()))
            orders = zip(control.tolist(), *(column.to_pylist() for column in told.itercolumns()))
            data = rows.select(self._given.names).filter(pa.array(kinds != CONTROL))
            done = at = 0
            sets, counts, weight = [], [], 0
            for turn, pos, action, arguments in [*orders, (rows.num_rows, None, None, None)]:
                if turn > at:
                    shown = sorted(items, key=str.encode) if shown is None else shown
                    sets.append(shown)
                    counts.append(turn - at)
                    weight += len(shown)
                    if weight >= RESULT_ITEMS:
                        yield from self._results(data.slice(done, sum(counts)), sets, counts, late)
                        done += sum(counts)
                        sets, counts, weight = [], [], 0
                at = turn + 1
                if turn < rows.num_rows and (last is None or (pos is not None and pos >= last)):
                    items = changed(items, action, arguments or [])
                    shown, last, moved = None, pos, True
            yield from self._results(data.slice(done), sets, counts, late)
        if moved:
            self._current.update((sorted(items), last))

    def _results(self, data: pa.Table, sets: list, counts: list[int], late: bool) -> Iterator[Row]:
        if not counts:
            return
        own = np.repeat(np.arange(len(sets)), counts)
        kinds = pa.array(sets, self._result.field("items").type)
        step = max(1, RESULT_ITEMS // max(1, max(map(len, sets))))
        for at in range(0, data.num_rows, step):
            part = data.slice(at, step)
            columns = [*part.itercolumns(), kinds.take(pa.array(own[at : at + step])), pa.array([late] * part.num_rows)]
            yield self._packed(_blob(pa.table(columns, schema=self._result)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        begin = self._begin_of_time(timerValues)
        late, firsts = [], []
        number = before = self._chunks.get()[0] if self._chunks.exists() else 0
        blobs = iter(rows)
        while run := self._next_run(blobs):
            table = _in_turn(pa.concat_tables(run))
            # Rows without a time come first.
            past = table["pos"].null_count
            past += int(np.searchsorted(table["pos"].slice(past).to_numpy(), begin))
            if past:
                late.append(table.slice(0, past))
            for at in range(past, table.num_rows, self._chunk_rows):
                firsts.append(self._put_table(table.slice(at, self._chunk_rows), number))
                number += 1
        if number > before:
            self._chunks.update((number,))
            self._wake_at(min(firsts))
        if late:
            yield from self._replay(iter([_in_turn(pa.concat_tables(late))]), True)

    def _next_run(self, rows: Iterator[Row]) -> list[pa.Table]:
        run, taken = [], 0
        while taken < self._run_rows and (row := next(rows, None)) is not None:
            run.append(self._table(row["rows"]))
            taken += run[-1].num_rows
        return run

    def _due_tables(self, chunks: Sequence[tuple[int, int]], timerValues) -> Iterator[pa.Table]:
        """Rows of ``chunks`` that the watermark has passed, in their turn; what it has not passed is put back."""
        begin, to_open, open_rows = self._begin_of_time(timerValues), deque(chunks), None
        while to_open or open_rows is not None:
            found = [] if open_rows is None else [open_rows]
            wanted, fresh = max(self._run_rows, open_rows.num_rows if found else 0), 0
            while to_open and fresh < wanted:
                chunk = to_open.popleft()
                rows = self._table(self._waiting.getValue(chunk)[0])
                self._waiting.removeKey(chunk)
                past = int(np.searchsorted(rows["pos"].to_numpy(), begin))
                if past < rows.num_rows:
                    self._put_table(rows.slice(past), chunk[1])
                found.append(rows.slice(0, past))
                fresh += past
            rows = _in_turn(pa.concat_tables(found)).combine_chunks()
            ready = rows.num_rows
            if to_open:
                ready = int(np.searchsorted(rows["pos"].to_numpy(), to_open[0][0] * self._bucket * 1000))
            open_rows = rows.slice(ready) if ready < rows.num_rows else None
            if ready:
                yield rows.slice(0, ready)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting = sorted(tuple(chunk) for chunk in self._waiting.keys())
        due = [chunk for chunk in waiting if self._is_past(chunk[0], timerValues)]
        if not due:
            return
        yield from self._replay(self._due_tables(due, timerValues), False)
        left = min((chunk[0] for chunk in self._waiting.keys()), default=None)
        if left is not None:
            self._wake_at(left)


def _turn(row: Row) -> tuple:
    return (row["pos"] is not None, row["pos"] or 0, row["kind"], row["seq"])


def closing(rows: DataFrame, ts: str, delay: str, bucket_millis: int = BUCKET_MILLIS) -> DataFrame:
    """One row, with a time by which everything in ``rows`` is past its delay, to be added to a log that ends.

    It has ``ts`` alone; the other columns of the log are the caller's to fill.
    """
    wait = F.expr(f"INTERVAL {delay}") + F.make_dt_interval(secs=F.lit(2 * bucket_millis / 1000))
    return rows.agg(F.max(ts).alias("__last")).select((F.col("__last") + wait).alias(ts))


def as_of_stream(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    delay: str | None = "10 seconds",
    salts: int = 1,
) -> DataFrame:
    """Data rows of a mixed stream with ``items``, the set of their key at their time.

    ``rows`` has the keys, ``ts`` (timestamp), ``seq`` (bigint), ``kind``
    (CONTROL, DATA or CLOSING), ``action`` and ``arguments`` of control rows, and the
    columns of data rows.  With a ``delay`` rows wait for the watermark, and a row that
    comes after it is not lost but emitted with ``late`` true; those of the last
    ``delay`` of a finished input wait until a :func:`closing` row comes.  With None
    every row is decided in the batch that brings it, and there is no ``late``.  Keyed
    state of this kind needs the RocksDB provider, which is set on the session here.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    salt = F.pmod(F.xxhash64("seq"), F.lit(salts)).cast("int")
    own = F.when(F.col("kind") == DATA, F.array(salt)).otherwise(
        F.sequence(F.lit(0), F.lit(salts - 1))
    )
    placed = rows.withColumn("pos", epoch_micros(ts)).withColumn("salt", F.explode(own))
    if delay is not None:
        # The watermark follows this column; the operator sees a copy of it, by which it drops nothing.
        placed = placed.withWatermark(ts, delay).withColumn(ts, F.timestamp_micros("pos"))
    held = StructType([f for f in placed.schema.fields if f.name != "salt"])
    hidden = {"kind", "action", "arguments", "pos"}
    kept = [f for f in held.fields if f.name not in hidden]
    late = [] if delay is None else [StructField("late", BooleanType())]
    output = StructType([*kept, *_ITEMS.fields, *late])
    emitted, groups = [f.name for f in kept], [*keys, "salt"]
    if delay is None:
        return placed.groupBy(*groups).transformWithState(
            statefulProcessor=DecideAtOnce(held, emitted),
            outputStructType=output,
            outputMode="Append",
            timeMode="None",
        )
    # Rows go to their keys, wait and come back in packs; one by one Python would convert each of their fields.
    rows_of = StructType([*(placed.schema[name] for name in groups), StructField("rows", BinaryType())])
    seen = placed.mapInArrow(packed(groups, held), rows_of).groupBy(*groups).transformWithState(
        statefulProcessor=HoldPacked(held, emitted),
        outputStructType=StructType([StructField("rows", BinaryType())]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return seen.mapInArrow(unpacked(output), output)


def without_items(seen: DataFrame) -> DataFrame:
    """Rows whose key was in no denied or blocked state at their time."""
    return seen.filter(F.size("items") == 0).drop("items")
