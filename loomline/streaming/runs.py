"""Runs of equal values on a stream: each key's open run is state, and closed ones come out."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OpenRun(StatefulProcessor):
    """Holds, for a key, the run that its last row is in, and gives a run out when another begins or the key falls silent.

    A run's distinct values are in a map state, so that neither a long run nor its many values
    are one value; only values that a batch brings are looked up.
    """

    def __init__(self, order: list[str], change: list[str], firsts: dict[str, str], lasts: dict[str, str], distincts: dict[str, str], count: str | None, starts: dict[str, str], deltas: dict[str, str], kinds: dict[str, T.DataType], idle_ms: int, fields: list[str]):
        self.order, self.change, self.firsts, self.lasts, self.distincts, self.count, self.starts, self.deltas, self.idle_ms, self.fields = order, change, firsts, lasts, distincts, count, starts, deltas, idle_ms, fields
        # What a first run has before it: nothing, as a value of the column's own type.
        self.before = {n: 0.0 if isinstance(kinds[lasts[n]], (T.DoubleType, T.FloatType)) else 0 for n in (*starts.values(), *deltas.values())}
        named = [*[(f"at_{c}", kinds[c]) for c in order], *[(f"is_{c}", kinds[c]) for c in change], *[(f"first_{n}", kinds[c]) for n, c in firsts.items()], *[(f"last_{n}", kinds[c]) for n, c in lasts.items()]]
        named += [(f"before_{n}", kinds[lasts[n]]) for n in self.before] + [(f"met_{n}", T.LongType()) for n in distincts] + [("segment", T.LongType()), ("rows", T.LongType()), ("timer", T.LongType())]
        self.state_schema = T.StructType([T.StructField(n, k) for n, k in named])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", self.state_schema)
        self.values = handle.getMapState("values", "name string, value string", "there boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802
        run = self.held()
        timer, latest, fresh = run and run["timer"], 0, {n: set() for n in self.distincts}
        for row in sorted(rows, key=lambda r: [r[c] for c in self.order]):
            latest = max(latest, row["_ms"])
            if run and [row[c] for c in self.order] <= [run[f"at_{c}"] for c in self.order]:
                continue  # came after what follows it
            if run is None or self.differs(run, row):
                if run:
                    yield self.closed(key, run, fresh)
                run = self.begun(run, row)
                fresh = {n: set() for n in self.distincts}
                self.values.clear()
            run["rows"] += 1
            run |= {f"at_{c}": row[c] for c in self.order} | {f"last_{n}": row[c] for n, c in self.lasts.items()}
            for n, c in self.distincts.items():
                if row[c] is not None:
                    fresh[n].add(str(row[c]))
        for n, found in fresh.items():
            for value in self.unknown(n, found):
                self.values.updateValue((n, value), (True,))
                run[f"met_{n}"] += 1
        if timer:
            self.handle.deleteTimer(timer)
        run["timer"] = max(latest + self.idle_ms, timer or 0)
        self.handle.registerTimer(run["timer"])
        self.run.update(tuple(run[f.name] for f in self.state_schema))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        if self.run.exists():
            yield self.closed(key, self.held(), {n: set() for n in self.distincts})
            self.run.clear()
            self.values.clear()

    def held(self) -> dict | None:
        return dict(zip(self.state_schema.names, self.run.get(), strict=True)) if self.run.exists() else None

    def differs(self, run: dict, row: Row) -> bool:
        """A comparison with null counts as a change, unless another column already settles it: so any null does."""
        return any(row[c] is None or run[f"is_{c}"] is None or row[c] != run[f"is_{c}"] for c in self.change)

    def begun(self, before: dict | None, row: Row) -> dict:
        run = {f.name: None for f in self.state_schema} | {"segment": before["segment"] + 1 if before else 1, "rows": 0} | {f"met_{n}": 0 for n in self.distincts}
        run |= {f"is_{c}": row[c] for c in self.change} | {f"first_{n}": row[c] for n, c in self.firsts.items()}
        return run | {f"before_{n}": before[f"last_{n}"] if before else zero for n, zero in self.before.items()}

    def unknown(self, name: str, values: set[str]) -> list[str]:
        return [v for v in sorted(values) if not self.values.containsKey((name, v))]

    def closed(self, key: tuple, run: dict, fresh: dict[str, set[str]]) -> Row:
        met = [run[f"met_{n}"] + len(self.unknown(n, fresh[n])) for n in self.distincts]
        less = lambda a, b: None if a is None or b is None else a - b
        out = [*key, run["segment"], *[run[f"first_{n}"] for n in self.firsts], *[run[f"last_{n}"] for n in self.lasts], *([run["rows"]] if self.count else []), *met]
        out += [run[f"before_{c}"] for c in self.starts.values()] + [less(run[f"last_{c}"], run[f"before_{c}"]) for c in self.deltas.values()]
        return Row(**dict(zip(self.fields, out, strict=True)))


def stream_runs(
    events: DataFrame,
    *,
    partition: list[str],
    order: list[str],
    change: list[str],
    ts: str,
    idle: str = "1 hour",
    segment: str = "segment",
    firsts: dict[str, str] | None = None,
    lasts: dict[str, str] | None = None,
    distincts: dict[str, str] | None = None,
    count: str | None = None,
    starts: dict[str, str] | None = None,
    deltas: dict[str, str] | None = None,
) -> DataFrame:
    """The rows of ``segments.gaps_and_islands``, as an append stream, of events whose ``ts`` carries a watermark.

    A run comes out when the next one of its key begins, or when the watermark has passed the
    key's last event by ``idle``; then the key is forgotten, and would begin anew. A key's rows
    may come in any order within a batch; one that comes in a later batch than what
    follows it is left out, as is one behind the watermark. The session needs PROVIDER as its state store.
    """
    firsts, lasts, distincts, starts, deltas = firsts or {}, lasts or {}, distincts or {}, starts or {}, deltas or {}
    kinds = {f.name: f.dataType for f in events.schema}
    idle_ms = int(events.sparkSession.sql(f"SELECT CAST(unix_millis(timestamp_seconds(0) + INTERVAL {idle}) AS BIGINT)").first()[0])
    read = list(dict.fromkeys([*partition, *order, *change, *firsts.values(), *lasts.values(), *distincts.values()]))
    rows = events.select(*read, *([] if ts in read else [ts]), F.unix_millis(F.col(ts).cast("timestamp")).alias("_ms"))
    fields = [*[(c, kinds[c]) for c in partition], (segment, T.LongType()), *[(n, kinds[c]) for n, c in firsts.items()], *[(n, kinds[c]) for n, c in lasts.items()]]
    fields += [(n, T.LongType()) for n in [*([count] if count else []), *distincts]] + [(n, kinds[lasts[c]]) for n, c in [*starts.items(), *deltas.items()]]
    processor = OpenRun(order, change, firsts, lasts, distincts, count, starts, deltas, kinds, idle_ms, [n for n, _ in fields])
    schema = T.StructType([T.StructField(n, k) for n, k in fields])
    return rows.groupBy(*partition).transformWithState(processor, schema, "Append", "EventTime")
