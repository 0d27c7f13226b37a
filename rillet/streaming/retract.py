"""Changelog streams: joins, aggregates and sinks that take results back.

A changelog is a stream of rows with ``op``: ``+I``, ``+U`` add a row, ``-U``, ``-D`` take one
away.  As signed counts of equal rows the operators here need no order within a micro-batch: a
batch's changes of a key are netted first, applied to state, and only net changes go out, so
the rows that a stream's changes add up to (:func:`current_rows`) don't depend on how the
input falls into batches.  Filters and projections work on a changelog as on a table: HAVING is a
``where`` behind :func:`aggregate_changes`, and a group that no longer passes goes out as ``-U`` alone.

State is one entry per distinct row (joins, sinks) or per group (aggregates), in Spark's state
store.  Rows travel as JSON of their columns and come back typed.  A hot key is split with
``salts``: the left side of a join by row, an aggregate in two levels.

A call of Python and each of its state calls cost a millisecond or so whatever a key's size, so keys
are handled by buckets of a hash (``buckets``, fixed for the life of a checkpoint): one call and one
log of state changes for all keys of a bucket.  A batch reads the state of the buckets that it touches;
where small batches meet much state, ``buckets=None`` gives every key a call and a state of its own.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from decimal import Decimal
from fractions import Fraction
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, FloatType, LongType, StructField, StructType, TimestampType

from rillet.operators.over import _micros
from rillet.streaming.operators import keep_above_watermark

OP = "op"
#: Text forms that keep microseconds, so that a row read back equals the row written.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _packed(df: DataFrame, cols: Sequence[str]) -> Column:
    """Columns of ``df`` as one JSON text, equal for equal rows; timestamps as microseconds, which are read and written faster than text."""
    held = [F.unix_micros(F.col(f"`{c}`")).alias(c) if isinstance(df.schema[c].dataType, TimestampType) else F.col(f"`{c}`") for c in cols]
    return F.to_json(F.struct(*held), _JSON) if cols else F.lit("{}")


def _unpacked(text: str, df: DataFrame, cols: Sequence[str], name: str, many: bool = False) -> Column:
    """What :func:`_packed` has packed, to be read by :func:`_field`; with ``many`` the text is a JSON list of such rows."""
    row = StructType([StructField(c, LongType()) if isinstance(df.schema[c].dataType, TimestampType) else df.schema[c] for c in cols])
    return F.from_json(F.col(text), ArrayType(row) if many else row, _JSON).alias(name)


def _field(name: str, df: DataFrame, col: str) -> Column:
    value = F.col(f"{name}.`{col}`")
    return (F.timestamp_micros(value) if isinstance(df.schema[col].dataType, TimestampType) else value).alias(col)


def sign() -> Column:
    """1 for a row that is added, -1 for one that is taken away."""
    return F.when(F.col(OP).startswith("-"), F.lit(-1)).otherwise(F.lit(1))


def inserts(df: DataFrame) -> DataFrame:
    """An append-only stream as a changelog."""
    return df.withColumn(OP, F.lit("+I"))


def current_rows(changes: DataFrame) -> DataFrame:
    """C3 (batch): the rows that a changelog adds up to, equal rows as often as they are there."""
    cols = [c for c in changes.columns if c != OP]
    held = changes.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum(sign()).alias("_n")).where("_n > 0")
    return held.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*cols)


#: Buckets of keys of an operator.
BUCKETS = 1024
#: Rows of a frame that goes to Spark and characters after which it ends; characters of a piece of a bucket's state.
FRAME, FRAME_CHARS, PIECE = 10_000, 1 << 22, 1 << 20
#: Rows of a side in one text of a join's result.
FACTOR = 1000


def _net(changes: Counter) -> list[tuple]:
    """Net changes of a key, those taken away first; U where rows go and others come."""
    values = changes.values()
    minus, plus = ("-U", "+U") if values and min(values) < 0 < max(values) else ("-D", "+I")
    out = [(minus, *row) for row, n in changes.items() if n < 0 for _ in range(-n)]
    out += [(plus, *row) for row, n in changes.items() if n > 0 for _ in range(n)]
    return out


def _frames(rows: Iterable[tuple], columns: Sequence[str]) -> Iterator[pd.DataFrame]:
    part, chars = [], 0
    for row in chain(rows, (None,)):
        if part and (row is None or len(part) == FRAME or chars > FRAME_CHARS):
            yield pd.DataFrame(dict(zip(columns, map(list, zip(*part, strict=True)), strict=True)), dtype=object)
            part, chars = [], 0
        if row is not None:
            part.append(row)
            chars += sum([len(v) for v in row if isinstance(v, str)])


class _Keyed(StatefulProcessor):
    """A processor of one key: ``added`` collects the key's new rows (``takes``) in what ``empty`` gives,
    ``changed`` applies them to state and gives rows to go out (``gives``)."""

    takes: tuple[str, ...]
    gives: tuple[str, ...]

    def empty(self):
        raise NotImplementedError

    def added(self, new, rows: Iterable[tuple]) -> None:
        raise NotImplementedError

    def changed(self, key: str, new, clock: int) -> Iterable[tuple]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = self.empty()
        for pdf in rows:
            self.added(new, zip(*[pdf[c].tolist() for c in self.takes], strict=True))
        yield from _frames(self.changed(key[0], new, timerValues.getCurrentWatermarkInMs() * 1000), self.gives)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from _frames(self.changed(key[0], self.empty(), timerValues.getCurrentWatermarkInMs() * 1000), self.gives)

    def close(self) -> None:
        pass


class _Log:
    """One state of all keys of a bucket, as a processor of one key sees it: a log of JSON pieces, each a list of
    [key, entries, whether they replace earlier ones].  It is read when a key asks for it, gets one call
    a batch, and is rewritten when it has grown to twice what it says."""

    def __init__(self, bucket: _Bucket, name: str) -> None:
        self.bucket, self.state = bucket, bucket.handle.getListState(name, "piece string")
        self.begin()

    def begin(self) -> None:
        self.held: dict[str, list[tuple]] | None = None
        self.changes: list[tuple] = []

    def load(self) -> dict[str, list[tuple]]:
        if self.held is None:
            self.held, self.size = {}, 0
            for piece, in self.state.get():
                for change in json.loads(piece):
                    self._apply(*change)
            for change in self.changes:
                self._apply(*change)
        return self.held

    def _apply(self, key: str, entries: list, anew: bool) -> None:
        self.size += 1 + len(entries)
        if anew:
            self.held.pop(key, None)
        if entries:
            self.held.setdefault(key, []).extend(map(tuple, entries))

    def _change(self, entries: list, anew: bool) -> None:
        change = (self.bucket.key, entries, anew)
        while anew and self.changes and self.changes[-1][0] == self.bucket.key:
            self.changes.pop()
        self.changes.append(change)
        if self.held is not None:
            self._apply(*change)

    def end(self) -> None:
        if not self.changes:
            return
        changes = self.changes
        if self.held is not None and self.size > 2 * sum(1 + len(e) for e in self.held.values()) + 16:
            changes = [(key, entries, False) for key, entries in self.held.items()]
            self.state.clear()
        piece, length = [], 0
        for key, entries, anew in changes:
            for at in range(0, len(entries), 1000) if len(entries) > 1000 else (0,):   # a hot key's entries in parts
                text = json.dumps((key, entries[at:at + 1000], anew and at == 0), ensure_ascii=False)
                if piece and length + len(text) > PIECE:
                    self.state.appendList([(f"[{','.join(piece)}]",)])
                    piece, length = [], 0
                piece.append(text)
                length += len(text)
        if piece:
            self.state.appendList([(f"[{','.join(piece)}]",)])

    # what list and value states offer
    def put(self, entries: Sequence[tuple]) -> None:
        self._change(list(entries), True)

    def appendList(self, entries: Sequence[tuple]) -> None:
        self._change(list(entries), False)

    def update(self, value: tuple) -> None:
        self._change([value], True)

    def clear(self) -> None:
        self._change([], True)


class _ListLog(_Log):
    def get(self) -> Iterator[tuple]:
        return iter(self.load().get(self.bucket.key, ()))


class _ValueLog(_Log):
    def get(self) -> tuple | None:
        return self.load().get(self.bucket.key, (None,))[0]


class _Bucket(StatefulProcessor):
    """Runs a processor of one key for all keys of a bucket and is the handle of its states."""

    def __init__(self, one: _Keyed) -> None:
        self.one = one

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.logs, self.key = handle, [], None
        self.one.init(self)

    def getValueState(self, name: str, schema: str) -> _ValueLog:
        self.logs.append(_ValueLog(self, name))
        return self.logs[-1]

    def getListState(self, name: str, schema: str) -> _ListLog:
        self.logs.append(_ListLog(self, name))
        return self.logs[-1]

    def registerTimer(self, at: int) -> None:
        self.timer = min(at, self.timer or at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._begin()
        new: dict = {}
        for pdf in rows:
            parts: dict[str, list] = {}
            for k, row in zip(pdf["key_json"], zip(*[pdf[c].tolist() for c in self.one.takes], strict=True), strict=True):
                parts.setdefault(k, []).append(row)
            for k, part in parts.items():
                if k not in new:
                    new[k] = self.one.empty()
                self.one.added(new[k], part)
        yield from self._run(new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._begin()
        yield from self._run({k: self.one.empty() for log in self.logs for k in log.load()}, timerValues)

    def _begin(self) -> None:
        self.timer = None
        for log in self.logs:
            log.begin()

    def _run(self, new: dict, timerValues) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs() * 1000

        def changed() -> Iterator[tuple]:
            while new:
                self.key, rows = new.popitem()
                yield from self.one.changed(self.key, rows, clock)

        yield from _frames(changed(), self.one.gives)
        for log in self.logs:
            log.end()
            log.begin()
        if self.timer is not None:
            self.handle.registerTimer(self.timer)

    def close(self) -> None:
        pass


def _by_key(source: DataFrame, one: _Keyed, schema: str, buckets: int | None, time_mode: str = "None") -> DataFrame:
    """``one`` run on every ``key_json``."""
    if buckets is None:
        return source.groupBy("key_json").transformWithStateInPandas(one, schema, "Append", time_mode)
    bucket = F.pmod(F.xxhash64("key_json"), F.lit(buckets)).cast("int")
    return source.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(_Bucket(one), schema, "Append", time_mode)


class _Rows:
    """Equal rows and how many there are of each: a log of their changes, written with one call
    a batch, netted when it is read and rewritten when it has grown to twice its rows."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.state = handle.getListState(name, "row string, n long")

    def all(self) -> dict[str, int]:
        held: Counter = Counter()
        entries = 0
        for row, n in self.state.get():
            held[row] += n
            entries += 1
        net = {row: n for row, n in held.items() if n}
        if entries > 2 * len(net) + 16:
            if net:
                self.state.put(list(net.items()))
            else:
                self.state.clear()
        return net

    def add(self, changes: dict[str, int]) -> None:
        if changes:
            self.state.appendList(list(changes.items()))


class _ExpiringRows:
    """The same with one entry per row, each of which expires by itself."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, ttl: int) -> None:
        self.state = handle.getMapState(name, "row string", "n long", ttl)

    def all(self) -> dict[str, int]:
        return {k[0]: v[0] for k, v in self.state.iterator()}

    def add(self, changes: dict[str, int]) -> None:
        for row, n in changes.items():
            held = self.state.getValue((row,))
            n += held[0] if held else 0
            if n > 0:
                self.state.updateValue((row,), (n,))
            elif held:
                self.state.removeKey((row,))


class _Order:
    """What rows (as packed) sort by: NULL first, numbers by value with NaN last, texts by code point,
    times by microseconds; equal ones by the whole row."""

    def __init__(self, df: DataFrame, cols: Sequence[str]) -> None:
        self.cols = [(c, isinstance(df.schema[c].dataType, DoubleType | FloatType)) for c in cols]

    def __call__(self, row: str) -> tuple:
        held, out = json.loads(row, parse_float=Decimal), []
        for c, floating in self.cols:
            v = held.get(c)
            if floating and v is not None:
                v = float(v)
                v = (v != v, 0.0 if v != v else v)
            out.append((v is not None, v))
        return (*out, row)


def _ordered(cols: Sequence[str], df: DataFrame) -> _Order:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return _Order(df, cols)


# ------------------------------------------------------------------ upsert stream -> changelog
class _Upsert(_Keyed):
    takes, gives = ("row_json",), (OP, "row_json")

    def __init__(self, order: _Order) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current = handle.getValueState("current", "row string")

    def empty(self) -> list[tuple]:
        return []   # the order of the largest row, whose last part is the row

    def added(self, new: list[tuple], rows: Iterable[tuple]) -> None:
        new[:] = [max([*new, *(self.order(row) for row, in rows)])]

    def changed(self, key: str, new: list[tuple], clock: int) -> Iterator[tuple]:
        before = (self.current.get() or (None,))[0]
        now = max([*new, *([] if before is None else [self.order(before)])])[-1]
        if now != before:
            self.current.update((now,))
            yield from _net(Counter({(now,): 1} if before is None else {(before,): -1, (now,): 1}))


def upsert_changes(df: DataFrame, *, key: str | Sequence[str], order_cols: Sequence[str], buckets: int | None = BUCKETS) -> DataFrame:
    """The changelog of an upsert stream: per key the row with the largest ``order_cols`` so far.

    A row below the current one changes nothing whenever it arrives, so every split of the
    input into files ends in the same rows.  NULL is a key like any other.  State: one row per key.
    """
    source = df.select(_packed(df, _cols(key)).alias("key_json"), _packed(df, df.columns).alias("row_json"))
    out = _by_key(source, _Upsert(_ordered(order_cols, df)), f"{OP} string, row_json string", buckets)
    return out.select(OP, _unpacked("row_json", df, df.columns, "_r")).select(OP, *[_field("_r", df, c) for c in df.columns])


class _History(_Keyed):
    """Per key the rows above the clock and the last row released."""

    takes, gives = ("t", "row_json"), (OP, "row_json")

    def __init__(self, order: _Order) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, row string")
        self.last = handle.getValueState("last", "row string")

    def empty(self) -> list[tuple]:
        return []

    def added(self, new: list[tuple], rows: Iterable[tuple]) -> None:
        new += rows

    def changed(self, key: str, new: list[tuple], clock: int) -> Iterator[tuple]:
        if new:
            self.waiting.appendList(new)
        waiting = list(self.waiting.get())
        later = [w for w in waiting if w[0] > clock]
        if later:
            self.handle.registerTimer(max(min(later)[0], clock) // 1000 + 1)
        ready = sorted((w for w in waiting if w[0] <= clock), key=lambda w: (w[0], self.order(w[1])))
        if not ready:
            return
        last = (self.last.get() or (None,))[0]
        for _, row in ready:
            if last is None:
                yield "+I", row
            else:
                yield "-U", last
                yield "+U", row
            last = row
        self.last.update((last,))
        if later:
            self.waiting.put(later)
        else:
            self.waiting.clear()


def changelog_history(df: DataFrame, *, key: str | Sequence[str], time_col: str, order_cols: Sequence[str] = (),
                      buckets: int | None = BUCKETS) -> DataFrame:
    """C2 on a watermarked stream: every version of a key as ``+I`` or as ``-U`` (the one before) and ``+U``,
    in order of time, then ``order_cols``, whatever order they arrive in; a row goes out once the clock has
    passed it, later ones for that time are late.  State per key: rows above the clock and the last one below.
    """
    source = df.select(_packed(df, _cols(key)).alias("key_json"), F.col(f"`{time_col}`").alias("at"), F.unix_micros(F.col(f"`{time_col}`")).alias("t"),
                       _packed(df, df.columns).alias("row_json"))
    out = _by_key(source, _History(_ordered(order_cols, df)), f"{OP} string, row_json string", buckets, "EventTime")
    return out.select(OP, _unpacked("row_json", df, df.columns, "_r")).select(OP, *[_field("_r", df, c) for c in df.columns])


# ------------------------------------------------------------------ joins
class _Join(_Keyed):
    takes, gives = ("side", "n", "row_json"), (OP, "_l", "_r")

    def __init__(self, pad_left: bool, pad_right: bool, ttl: tuple[int | None, int | None]) -> None:
        self.pad_left, self.pad_right, self.ttl = pad_left, pad_right, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left, self.right = (_Rows(handle, name) if ttl is None else _ExpiringRows(handle, name, ttl)
                                 for name, ttl in zip(("left", "right"), self.ttl, strict=True))
        if self.pad_left or self.pad_right:
            self.counts = handle.getValueState("counts", "l long, r long")

    def empty(self) -> tuple[Counter, Counter]:
        return Counter(), Counter()

    def added(self, new: tuple[Counter, Counter], rows: Iterable[tuple]) -> None:
        for side, n, row in rows:
            new[side][row] += n

    def changed(self, key: str, new: tuple[Counter, Counter], clock: int) -> Iterator[tuple]:
        new_left, new_right = ({r: n for r, n in c.items() if n} for c in new)
        # each side's earlier rows are read where the other side changes
        right = self.right.all() if new_left else {}
        left = self.left.all() if new_right else {}
        terms: list[tuple[dict, dict]] = []   # products of counted rows, no pair in two of them
        if not new_right:
            terms.append((new_left, right))
        else:
            now = _plus(right, new_right)
            again = new_left.keys() & left.keys()
            terms += [({l: n for l, n in new_left.items() if l not in again}, now), ({l: n for l, n in left.items() if l not in again}, new_right)]
            terms += [({l: 1}, _plus({r: n * left[l] for r, n in new_right.items()}, {r: n * new_left[l] for r, n in now.items()})) for l in again]
        if self.pad_left or self.pad_right:
            n_left, n_right = self.counts.get() or (0, 0)
            then = (n_left + sum(new_left.values()), n_right + sum(new_right.values()))
            if self.pad_left:
                terms.append((self._pad(left, new_left, n_right, then[1]), {None: 1}))
            if self.pad_right:
                terms.append(({None: 1}, self._pad(right, new_right, n_left, then[0])))
            self.counts.update(then)
        self.left.add(new_left)
        self.right.add(new_right)
        yield from self.told(terms)

    def told(self, terms: list[tuple[dict, dict]]) -> Iterable[tuple]:
        """The products as rows to go out: a row for each pair."""
        return _net(Counter({(l, r): n * m for ls, rs in terms for l, n in ls.items() for r, m in rs.items()}))

    @staticmethod
    def _pad(held: dict[str, int], new: dict[str, int], partners: int, partners_then: int) -> dict[str, int]:
        """Rows without a partner stand alone; the first partner takes them back, the last one's
        end restores them."""
        if partners <= 0:
            return new if partners_then <= 0 else {row: -n for row, n in held.items()}
        return _plus(held, new) if partners_then <= 0 else {}


class _Products(_Join):
    """The same with a row for each product: JSON lists of left and of right rows, all pairs of which are meant;
    Spark reads each row's text once per product instead of once per pair."""

    gives = (OP, "_ls", "_rs")

    def told(self, terms: list[tuple[dict, dict]]) -> Iterator[tuple]:
        parts = [(sl * sr, ls, rs) for term in terms for sl, ls in self._signed(term[0]) for sr, rs in self._signed(term[1])]
        both = len({sign for sign, _, _ in parts}) > 1
        for sign, ls, rs in sorted(parts, key=lambda part: part[0]):
            op = ("-U" if both else "-D") if sign < 0 else "+U" if both else "+I"
            rs = list(self._texts(rs))
            for l in self._texts(ls):
                for r in rs:
                    yield op, l, r

    @staticmethod
    def _signed(rows: dict) -> list[tuple[int, list]]:
        """The rows added and those taken away, equal ones as often as they are meant."""
        up, down = ([row for row, n in rows.items() for _ in range(sign * n)] for sign in (1, -1))
        return [(sign, part) for sign, part in ((1, up), (-1, down)) if part]

    @staticmethod
    def _texts(rows: list) -> Iterator[str | None]:
        for at in range(0, len(rows), FACTOR):
            yield None if rows[at] is None else f"[{','.join(rows[at:at + FACTOR])}]"


def _plus(one: dict[str, int], other: dict[str, int]) -> dict[str, int]:
    total = Counter(one)
    for row, n in other.items():
        total[row] += n
    return {row: n for row, n in total.items() if n}


def join_changes(left: DataFrame, right: DataFrame, *, key: str | Sequence[str], how: str = "inner", salts: int = 1,
                 ttl: str | None = None, right_ttl: str | None = None, buckets: int | None = BUCKETS) -> DataFrame:
    """The join of two changelogs on equal keys, as a changelog: op, the key, the left
    side's other columns, the right side's.  ``how``: inner, left, right or full.

    A change of either side goes out as changes of all rows it takes part in; a padded row is
    taken back when its first partner comes and returns when the last one goes.  NULL keys match nothing.

    ``salts``: parts of a key; left rows are dealt to them, right rows are held in each (inner and
    left only).  ``ttl``, ``right_ttl`` (C7, inner only): rows leave a side's state so long after their last
    change by processing time and meet no later row; results stand.  A query with a TTL asks for
    further batches for ever: end it yourself, or set spark.sql.streaming.noDataMicroBatches.enabled to false.
    """
    keys, how = _cols(key), {"left_outer": "left", "right_outer": "right", "outer": "full", "full_outer": "full"}.get(how, how)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    if salts > 1 and how in ("right", "full"):
        raise ValueError("a right row without a partner is not known to one salt: salts need an inner or left join")
    if (ttl or right_ttl) and how != "inner":
        raise ValueError("rows that expire can't be counted as partners: a TTL needs an inner join")
    ls, rs = ([c for c in d.columns if c not in (*keys, OP)] for d in (left, right))
    if clash := set(ls) & set(rs):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()

    def side(df: DataFrame, number: int, salt: Column) -> DataFrame:
        row = _packed(df, [c for c in df.columns if c != OP])
        return df.where(known).select(_packed(df, keys).alias("key_json"), salt.alias("salt"), F.lit(number).alias("side"), sign().alias("n"), row.alias("row_json"))

    both = side(left, 0, F.pmod(F.xxhash64(_packed(left, ls)), F.lit(salts)).cast("int")).unionByName(
        side(right, 1, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    millis = tuple(None if t is None else max(1, _micros(t) // 1000) for t in (ttl, right_ttl))
    both = both.select(F.to_json(F.struct("key_json", "salt")).alias("key_json"), "side", "n", "row_json")
    expires = millis != (None, None)   # Spark ends rows one by one: each key has its own state
    out = _by_key(both, _Products(how in ("left", "full"), how in ("right", "full"), millis), f"{OP} string, _ls string, _rs string",
                  None if expires else buckets, "ProcessingTime" if expires else "None")
    out = out.select(OP, _unpacked("_ls", left, [*keys, *ls], "_ls", many=True), _unpacked("_rs", right, [*keys, *rs], "_rs", many=True))
    out = out.select(OP, "_rs", F.explode_outer("_ls").alias("_l")).select(OP, "_l", F.explode_outer("_rs").alias("_r")).select(
        OP, *[F.coalesce(_field("_l", left, k), _field("_r", right, k)).alias(k) for k in keys],
        *[_field("_l", left, c) for c in ls], *[_field("_r", right, c) for c in rs])
    for df, pads in ((left, ("left", "full")), (right, ("right", "full"))):
        if how in pads:   # rows that can't match need no state
            out = out.unionByName(df.where(~known), allowMissingColumns=True)
    return out


# ------------------------------------------------------------------ aggregates
class _Sum:
    """Values added and taken away, exactly: non-NULL ones, their finite sum, NaN, +inf, -inf."""

    def __init__(self, text: str | None = None) -> None:
        self.n, self.total, self.odd = 0, Fraction(0), [0, 0, 0]
        if text:
            n, total, *odd = text.split()
            self.n, self.total, self.odd = int(n), Fraction(total), [int(x) for x in odd]

    def add(self, value: str | None, n: int, floating: bool) -> None:
        if value is None:
            return
        self.n += n
        odd = {"NaN": 0, "Infinity": 1, "-Infinity": 2}.get(value)
        if odd is None:
            self.total += n * Fraction(float(value) if floating else value)
        else:
            self.odd[odd] += n

    def merge(self, other: str, n: int) -> None:
        other = _Sum(other)
        self.n, self.total, self.odd = self.n + n * other.n, self.total + n * other.total, [a + n * b for a, b in zip(self.odd, other.odd, strict=True)]

    def text(self) -> str:
        return f"{self.n} {self.total} {' '.join(map(str, self.odd))}"

    def result(self, scale: int | None) -> str | None:
        """As text of a number with ``scale`` decimals, of a double if that is None."""
        if not self.n:
            return None
        if scale is not None:
            return str(Decimal(int(self.total * 10**scale)).scaleb(-scale)) if scale else str(int(self.total))
        nan, up, down = self.odd
        if nan or up and down:
            return "NaN"
        try:
            return repr(float("inf") if up else -float("inf") if down else float(self.total)).replace("inf", "Infinity")
        except OverflowError:
            return "Infinity" if self.total > 0 else "-Infinity"


class _Aggregate(_Keyed):
    """Per group the row count, other counts and sums; results of its state before and after."""

    takes, gives = ("n", "counts", "sums"), (OP, "key_json", "_c", "_s")

    def __init__(self, scales: list[int | None], n_counts: int, merges: bool, ends: bool) -> None:
        self.scales, self.n_counts, self.merges, self.ends = scales, n_counts, merges, ends

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("group", "counts string, sums array<string>")

    def empty(self) -> tuple[list[int], list[Counter]]:
        return [0] * (self.n_counts + 1), [Counter() for _ in self.scales]

    def added(self, new: tuple[list[int], list[Counter]], rows: Iterable[tuple]) -> None:
        counts, values = new
        for n, row_counts, row_sums in rows:
            for i, c in enumerate(row_counts):
                counts[i] += n * int(c)
            for held, v in zip(values, row_sums, strict=True):
                held[v] += n   # equal values are summed once

    def changed(self, key: str, new: tuple[list[int], list[Counter]], clock: int) -> Iterator[tuple]:
        sums, counts, before = [_Sum() for _ in self.scales], [0] * (self.n_counts + 1), None
        if (held := self.state.get()) is not None:
            counts, sums = [int(c) for c in held[0].split()], [_Sum(s) for s in held[1]]
            before = self._row(counts, sums)
        counts = [c + x for c, x in zip(counts, new[0], strict=True)]
        for s, values, scale in zip(sums, new[1], self.scales, strict=True):
            for v, n in values.items():
                if n:
                    s.merge(v, n) if self.merges else s.add(v, n, scale is None)
        if counts[0] > 0 or any(counts):   # more taken away than added so far: wait for the rest
            self.state.update((" ".join(map(str, counts)), [s.text() for s in sums]))
        elif held is not None:
            self.state.clear()
        after = self._row(counts, sums)
        if before != after:
            out: Counter = Counter()
            if before is not None:
                out[before] -= 1
            if after is not None:
                out[after] += 1
            for op, shown_counts, shown_sums in _net(out):
                yield op, key, list(shown_counts), list(shown_sums)

    def _row(self, counts: list[int], sums: list[_Sum]) -> tuple | None:
        if counts[0] <= 0:
            return None
        return tuple(counts), tuple(s.result(scale) if self.ends else s.text() for s, scale in zip(sums, self.scales, strict=True))


def aggregate_changes(changes: DataFrame, *, keys: str | Sequence[str], sums: dict[str, Column] | None = None,
                      counts: dict[str, Column] | None = None, salts: int = 1, buckets: int | None = BUCKETS) -> DataFrame:
    """``SUM`` and ``COUNT`` per group of a changelog, as a changelog: op, keys, sums, counts.

    A group changes as ``-U`` old, ``+U`` new and leaves (``-D``) with its last row.  Sums are exact
    whatever is taken away again, doubles too (rounded once, at the end); a sum of no values is NULL.
    NULL keys are a group.  ``salts``: rows of a group are summed in so many parts, then the parts are.
    State: counts and sums per group and part.
    """
    keys, sums, counts = _cols(keys), sums or {}, counts or {}
    kinds: list[DataType] = [changes.select(F.sum(v)).schema[0].dataType for v in sums.values()]
    scales = [k.scale if isinstance(k, DecimalType) else 0 if isinstance(k, LongType) else None for k in kinds]
    ones = [F.lit(1).cast("long"), *[F.when(c.isNotNull(), 1).otherwise(0).cast("long") for c in counts.values()]]
    values = [v.cast(kind).cast("string") for v, kind in zip(sums.values(), kinds, strict=True)]
    part = F.pmod(F.xxhash64(_packed(changes, [c for c in changes.columns if c != OP])), F.lit(salts)).cast("int")
    source = changes.select(_packed(changes, keys).alias("key_json"), part.alias("part"), sign().alias("n"), F.array(*ones).alias("counts"),
                            F.array(*values).cast("array<string>").alias("sums"))
    out = f"{OP} string, key_json string, _c array<long>, _s array<string>"
    if salts > 1:
        part_key = F.to_json(F.struct("key_json", "part")).alias("key_json")
        done = _by_key(source.select(part_key, "n", "counts", "sums"), _Aggregate(scales, len(counts), False, False), out, buckets)
        source = done.select(F.get_json_object("key_json", "$.key_json").alias("key_json"), sign().alias("n"), F.col("_c").alias("counts"), F.col("_s").alias("sums"))
    done = _by_key(source.select("key_json", "n", "counts", "sums"), _Aggregate(scales, len(counts), salts > 1, True), out, buckets)
    return done.select(OP, _unpacked("key_json", changes, keys, "_k"), "_c", "_s").select(
        OP, *[_field("_k", changes, k) for k in keys], *[F.col("_s")[i].cast(kind).alias(n) for i, (n, kind) in enumerate(zip(sums, kinds, strict=True))],
        *[F.col("_c")[i + 1].alias(n) for i, n in enumerate(counts)])


# ------------------------------------------------------------------ sink on another key
class _Winner(_Keyed):
    """Per sink key all candidates; the largest is what the sink shows."""

    takes, gives = ("n", "row_json"), (OP, "row_json")

    def __init__(self, order: _Order) -> None:
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = _Rows(handle, "rows")
        self.shown = handle.getValueState("shown", "row string")

    def empty(self) -> Counter:
        return Counter()

    def added(self, new: Counter, rows: Iterable[tuple]) -> None:
        for n, row in rows:
            new[row] += n

    def changed(self, key: str, change: Counter, clock: int) -> Iterator[tuple]:
        self.rows.add({row: n for row, n in change.items() if n})
        before = (self.shown.get() or (None,))[0]
        if change.get(before, 0) < 0:
            left = [r for r, n in self.rows.all().items() if n > 0]   # the next best one returns
        else:
            left = [r for r, n in change.items() if n > 0] + ([before] if before is not None else [])
        after = max(left, key=self.order, default=None)
        if after != before:
            out: Counter = Counter()
            if before is not None:
                out[before,] -= 1
            if after is not None:
                out[after,] += 1
                self.shown.update((after,))
            else:
                self.shown.clear()
            yield from _net(out)


def sink_changes(changes: DataFrame, *, sink_key: str | Sequence[str], order_cols: Sequence[str], buckets: int | None = BUCKETS) -> DataFrame:
    """What a sink with primary key ``sink_key`` shows of a changelog whose own key is another one.

    Of several rows with one sink key the largest by ``order_cols`` is shown; when it is taken
    back, the next one returns instead of the key being lost.  The result is a changelog with at most one
    row per sink key.  State: the rows of each sink key.
    """
    cols = [c for c in changes.columns if c != OP]
    source = changes.select(_packed(changes, _cols(sink_key)).alias("key_json"), sign().alias("n"), _packed(changes, cols).alias("row_json"))
    out = _by_key(source, _Winner(_ordered(order_cols, changes)), f"{OP} string, row_json string", buckets)
    return out.select(OP, _unpacked("row_json", changes, cols, "_r")).select(OP, *[_field("_r", changes, c) for c in cols])


# ------------------------------------------------------------------ versioned join
class _Versioned(_Keyed):
    """Per key the versions that may still be asked for, and the rows that wait for the clock."""

    takes, gives = ("side", "t", "row_json"), ("_l", "_v")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "t long, row string")
        self.waiting = handle.getListState("waiting", "t long, row string")

    def empty(self) -> tuple[list, list]:
        return [], []

    def added(self, new: tuple[list, list], rows: Iterable[tuple]) -> None:
        for side, t, row in rows:
            if t == t:   # a row without a time is at no version's time
                new[side].append((int(t), row))

    def changed(self, key: str, new: tuple[list, list], clock: int) -> Iterator[tuple]:
        for state, entries in zip((self.versions, self.waiting), new, strict=True):
            if entries:
                state.appendList(entries)
        waiting = list(self.waiting.get())
        ready, later = sorted(w for w in waiting if w[0] <= clock), [w for w in waiting if w[0] > clock]
        if later:
            self.handle.registerTimer(max(min(later)[0], clock) // 1000 + 1)
        if not ready:
            return
        versions = sorted(self.versions.get())
        times = [t for t, _ in versions]
        for t, row in ready:
            if v := bisect_right(times, t):
                yield row, versions[v - 1][1]
        self._rewrite(self.waiting, later)
        past = bisect_right(times, clock) - 1   # of these no row that is still to come asks
        if past > len(versions) - past:
            self._rewrite(self.versions, versions[past:])

    @staticmethod
    def _rewrite(state, entries: list[tuple]) -> None:
        if entries:
            state.put(entries)
        else:
            state.clear()


def versioned_join(left: DataFrame, versions: DataFrame, *, key: str | Sequence[str], left_time: str, version_time: str,
                   version_cols: Sequence[str], buckets: int | None = BUCKETS) -> DataFrame:
    """J1 on streams: each left row with the version of its key that was valid at its time (inner join).

    Both sides come with a watermark on their own time column.  Their clock is the lesser of the
    two (``spark.sql.streaming.multipleWatermarkPolicy`` = min, the default), so a row waits until the
    versions up to its time are complete, however far they lag.  Of versions of one time the last by their
    columns' JSON counts.  Rows below the clock on arrival are late and go.  NULL keys match nothing.

    State per key: rows above the clock, versions above the clock, the last one below it and at most as
    many older ones.
    """
    keys = _cols(key)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()

    def side(df: DataFrame, number: int, time: str, cols: Sequence[str]) -> DataFrame:
        # the filter stays above the watermark: rows that match nothing still move the clock
        return df.where(keep_above_watermark(known, time)).select(
            _packed(df, keys).alias("key_json"), F.lit(number).alias("side"), F.col(f"`{time}`").alias("at"),
            F.unix_micros(F.col(f"`{time}`")).alias("t"), _packed(df, cols).alias("row_json"))

    both = side(left, 1, left_time, left.columns).unionByName(side(versions, 0, version_time, version_cols))
    out = _by_key(both, _Versioned(), "_l string, _v string", buckets, "EventTime")
    named = {c: f"version_{c}" if c in left.columns else c for c in version_cols}
    return out.select(_unpacked("_l", left, left.columns, "_l"), _unpacked("_v", versions, version_cols, "_v")).select(
        *[_field("_l", left, c) for c in left.columns], *[_field("_v", versions, c).alias(named[c]) for c in version_cols])
