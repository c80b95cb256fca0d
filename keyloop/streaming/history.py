"""Histories maintained from streams: validity intervals (H4) and change rows captured from row
states (S8 / ST1).  A micro-batch reads and writes the state of the keys it touches, no more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from keyloop.operators.history import (CT, DEFAULT_BUCKET_WIDTH, DELETE, INSERT, POSTIMAGE, PREIMAGE, TS, VER,
                                       not_preimage)
from keyloop.operators.keyed import _all_not_null
from keyloop.streaming.deltas import PUBLISHED, held_entries

_KEEP = {"ignoreNullFields": "false"}


def _as_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """The columns as one JSON text, every value by its own text (``_from_text`` turns it back)."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]), _KEEP)


def _from_text(text: Column, df: DataFrame, cols: Sequence[str]) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    parsed = F.from_json(text, ", ".join(f"c{i} string" for i in range(len(cols))))
    return [parsed[f"c{i}"].cast(types[c]).alias(c) for i, c in enumerate(cols)]


#: Entries of the state that the keys of a bucket share.
SLOTS = 16


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows with their bucket, the unit of work of a batch, and the slot of their key in it."""
    slot = F.pmod(F.xxhash64("key"), F.lit(buckets * SLOTS))
    return rows.withColumn("slot", slot).withColumn("bucket", F.col("slot") % buckets)


# ------------------------------------------------------------------ H4
def _splice(width: int):
    """The processor of ``interval_changes``.  State: per key and window of versions the sorted rows
    [version, time, deleted], and per key the windows that have rows.  Keys of a slot share an entry of
    a window.  A batch loads the windows of its versions and, where a neighbour lies outside, the
    nearest window that has one, slot after slot."""
    entries, most = held_entries(), PUBLISHED

    class Splice(StatefulProcessor):
        def init(self, handle):
            self.cells = entries(handle.getMapState("cells", "slot long, cell long", entries.FORMAT), "string")
            self.index = entries(handle.getMapState("windows", "slot long", entries.FORMAT), "string")

        def handleInputRows(self, key, rows, timerValues):
            import json
            from bisect import bisect_left, bisect_right

            import pandas as pd

            def changes(out):
                return pd.DataFrame(
                    out, columns=["key", "version", "valid_from", "valid_to", "is_current", "change"]).astype(
                    {"version": "int64", "is_current": "bool", "change": "int32"})

            slots, out = {}, []
            for frame in rows:
                for slot, k, v, ts, gone in zip(*(frame[c].tolist() for c in ("slot", "key", "version", "at", "gone"))):
                    slots.setdefault(slot, {}).setdefault(k, {}).setdefault(v, [v, ts, bool(gone)])
            while slots:
                slot, new = slots.popitem()
                index, held, changed = self.index.read((slot,)), {}, set()
                for k, arrived in new.items():
                    windows = json.loads(index[k]) if k in index else []
                    loaded, dirty = {}, set()

                    def cell(c, k=k, loaded=loaded, slot=slot, held=held):
                        if c not in loaded:
                            if c not in held:
                                held[c] = self.cells.read((slot, c))
                            loaded[c] = json.loads(held[c][k]) if k in held[c] else []
                        return loaded[c]

                    def near(v, step, cell=cell, windows=windows):
                        """The row before (step -1) or after version v."""
                        rows_ = cell(v // width)
                        at = bisect_left(rows_, [v]) - 1 if step < 0 else bisect_right(rows_, v, key=lambda r: r[0])
                        if 0 <= at < len(rows_):
                            return rows_[at]
                        w = bisect_left(windows, v // width) - 1 if step < 0 else bisect_right(windows, v // width)
                        return cell(windows[w])[-1 if step < 0 else 0] if 0 <= w < len(windows) else None

                    def bounds(row, near=near):
                        if row[2]:
                            return None
                        then = near(row[0], 1)
                        return (row[1], then and then[1], then is None)

                    def has(v, cell=cell):
                        rows_ = cell(v // width)
                        at = bisect_left(rows_, [v])
                        return at < len(rows_) and rows_[at][0] == v

                    fresh = [arrived[v] for v in sorted(arrived) if not has(v)]   # versions known are replays
                    touched = {row[0]: (row, None) for row in fresh}
                    for row in fresh:
                        left = near(row[0], -1)
                        if left is not None and left[0] not in touched:
                            touched[left[0]] = (left, bounds(left))
                    for row in fresh:
                        c = row[0] // width
                        rows_ = cell(c)
                        rows_.insert(bisect_left(rows_, [row[0]]), row)
                        dirty.add(c)
                        if len(rows_) == 1 and c not in windows:
                            windows.insert(bisect_left(windows, c), c)
                    for row, before in touched.values():
                        after = bounds(row)
                        if before != after:
                            out += [(k, row[0], *b, n) for b, n in ((before, -1), (after, 1)) if b is not None]
                    for c in dirty:
                        held[c][k] = json.dumps(loaded[c])
                    if fresh:
                        index[k] = json.dumps(windows)
                    changed |= dirty
                for c in changed:
                    self.cells.write((slot, c), held[c])
                if changed:
                    self.index.write((slot,), index)
                if len(out) > most:
                    yield changes(out)
                    out = []
            yield changes(out)

        def close(self):
            pass

    return Splice()


def interval_changes(history: DataFrame, pk: Sequence[str], buckets: int = 64, width: int = DEFAULT_BUCKET_WIDTH
                     ) -> DataFrame:
    """H4 maintained: the stream of changes of the validity intervals of a history stream, signed rows
    (pk, _commit_version, valid_from, valid_to, is_current, change).

    A new change closes the open interval of its key, a late one splits the interval it falls into, a
    delete closes one and opens none.  The sum equals ``validity_intervals`` after every batch, in
    whatever order the changes come.  A key has one non-preimage change a version (a version that comes again
    is a replay); rows without a key or a version are left out.
    """
    pk = list(pk)
    rows = not_preimage(history).filter(_all_not_null([*pk, VER])).select(
        _as_text(history, pk).alias("key"), F.col(VER).cast("long").alias("version"),
        F.col(TS).cast("string").alias("at"), F.col(CT).eqNullSafe(DELETE).alias("gone"))
    out = _by_bucket(rows, buckets).groupBy("bucket").transformWithStateInPandas(
        _splice(width), "key string, version long, valid_from string, valid_to string, is_current boolean, change int",
        "Update", "None")
    ts = history.schema[TS].dataType
    return out.select(*_from_text(F.col("key"), history, pk), F.col("version").alias(VER),
                      F.col("valid_from").cast(ts).alias("valid_from"), F.col("valid_to").cast(ts).alias("valid_to"),
                      "is_current", "change")


def intervals_of(history: DataFrame, bounds: DataFrame, pk: Sequence[str]) -> DataFrame:
    """The interval table: the rows of the history with the bounds that the changes add up to."""
    return not_preimage(history).join(bounds, [*pk, VER])


# ------------------------------------------------------------------ S8 / ST1
def _diff_states():
    """The processor of ``captured_changes``.  State: per key the last version seen and the image;
    keys of a slot share an entry."""
    entries, most = held_entries(), PUBLISHED

    class Diff(StatefulProcessor):
        def init(self, handle):
            self.held = entries(handle.getMapState("images", "slot long", entries.FORMAT), "string")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            def changes(out):
                return pd.DataFrame(out, columns=["key", "version", "image", "kind"]).astype(
                    {"version": "int64", "kind": "int32"})

            slots, out = {}, []
            for frame in rows:
                for slot, k, v, image in zip(*(frame[c].tolist() for c in ("slot", "key", "version", "image"))):
                    slots.setdefault(slot, {}).setdefault(k, []).append((v, image or ""))
            while slots:
                slot, new = slots.popitem()
                held = self.held.read((slot,))
                for k, states in new.items():
                    last, image = None, ""
                    if k in held:
                        last, _, image = held[k].partition(" ")
                        last = int(last)
                    for v, now in sorted(states):
                        if last is not None and v <= last:      # late or repeated: the log is past it
                            continue
                        if now != image:
                            if image:
                                out.append((k, v, image, 1 if now else 3))
                            if now:
                                out.append((k, v, now, 2 if image else 0))
                        last, image = v, now
                    held[k] = f"{last} {image}"
                self.held.write((slot,), held)
                if len(out) > most:
                    yield changes(out)
                    out = []
            yield changes(out)

        def close(self):
            pass

    return Diff()


def captured_changes(states: DataFrame, pk: Sequence[str], version: str, deleted: Column, payload: Sequence[str],
                     buckets: int = 64) -> DataFrame:
    """S8 / ST1: change rows with images from a stream of row states that holds no change type.

    Each state (``pk``, ``payload``, at ``version``; ``deleted``: the row is gone) is compared with the key's
    image in the state store: an insert, an update as its preimage and postimage, a delete with
    the image that went, or nothing if the row is as it was.  States of a micro-batch are taken in the order
    of their versions; one not above the last version of its key is late or a replay and gives
    nothing.  States without a key or a version are left out.  The commit timestamp is the time of capture.
    """
    pk, payload = list(pk), list(payload)
    image = F.when(~F.coalesce(deleted, F.lit(False)), _as_text(states, payload))
    rows = states.filter(_all_not_null([*pk, version])).select(
        _as_text(states, pk).alias("key"), F.col(version).cast("long").alias("version"), image.alias("image"))
    out = _by_bucket(rows, buckets).groupBy("bucket").transformWithStateInPandas(
        _diff_states(), "key string, version long, image string, kind int", "Update", "None")
    kinds = F.array(*[F.lit(c) for c in (INSERT, PREIMAGE, POSTIMAGE, DELETE)])
    return out.select(*_from_text(F.col("key"), states, pk), *_from_text(F.col("image"), states, payload),
                      kinds[F.col("kind")].alias(CT), F.col("version").alias(VER), F.localtimestamp().alias(TS))
