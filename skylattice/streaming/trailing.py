"""Trailing sums over a stream, with keyed state that stays bounded."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skylattice.operators.windows import DAY


def _answers(asked: np.ndarray, seconds: np.ndarray, sums: np.ndarray, start: int, end: int) -> np.ndarray:
    """The sum over ``[asked - start, asked - end]`` of sums by rising second."""
    until = np.concatenate([sums[:0].sum(keepdims=True), np.cumsum(sums)])
    first = np.searchsorted(seconds, asked - start, "left")
    last = np.searchsorted(seconds, asked - end, "right")
    return until[np.maximum(last, first)] - until[first]


def _merged(of: np.ndarray, seconds: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sum per entity number and second, rising."""
    order = np.lexsort((seconds, of))
    of, seconds, sums = of[order], seconds[order], sums[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (seconds[1:] != seconds[:-1])
    out = np.zeros(int(new.sum()), sums.dtype)
    np.add.at(out, np.cumsum(new) - 1, sums)
    return of[new], seconds[new], out


def stream_trailing_sum(
    rows: DataFrame,
    entity: str,
    time: str,
    value: str,
    out: str,
    keep: Sequence[str],
    delay: str,
    start: int = DAY,
    end: int = 3 * 3600,
    buckets: int | None = None,
) -> DataFrame:
    """(entity, ``keep``, ``out``): the sum of ``value`` over ``[time - start, time - end]`` seconds.

    The rows of ``operators.windows.trailing_sum``, each given once, when the
    watermark, ``delay`` behind the newest time, has passed ``time - end``: no row
    of its window can come any more. Rows behind the watermark are dropped and
    counted by the query. With ``delay`` below ``end`` seconds every row is given in the
    end; with a longer one the last rows wait for newer ones. Rows without entity
    or time get 0 at once. A null value counts nothing. Whole numbers are exact.

    An entity's state is a ring of sums by second, which is cut at ``start``
    seconds before the watermark or the oldest waiting row, and the waiting rows. An
    entity that has not been seen for ``start`` seconds has no state. With ``buckets`` the
    entities are dealt by a hash to so many rows of state, each worked on as one:
    for streams of very many entities, where a call per entity and batch costs more than
    its rows. A bucket's waiting rows and rings are held at once. Use the same
    number for all runs of one checkpoint.
    """
    schema = rows.schema
    whole = isinstance(schema[value].dataType, T.IntegralType)
    kind, number = ("long", np.int64) if whole else ("double", np.float64)
    names = list(keep)
    fields = [schema[c] for c in names]
    result = T.StructType(
        [schema[entity], *fields, T.StructField(out, T.LongType() if whole else T.DoubleType())]
    )
    state_type = T.StructType(
        [
            T.StructField("of", T.ArrayType(T.LongType())),
            T.StructField("seconds", T.ArrayType(T.LongType())),
            T.StructField("sums", T.ArrayType(T.LongType() if whole else T.DoubleType())),
            T.StructField("asker", T.ArrayType(T.LongType())),
            T.StructField("asked", T.ArrayType(T.LongType())),
            *[T.StructField(f"kept_{i}", T.ArrayType(f.dataType)) for i, f in enumerate(fields)],
            T.StructField("entities", T.ArrayType(schema[entity].dataType)),
        ]
    )

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            *numbers, entities = state.get
            of, seconds, asker, asked = (np.array(x, np.int64) for x in (*numbers[:2], *numbers[3:5]))
            sums, entities, kept = np.array(numbers[2], number), list(entities), [list(k) for k in numbers[5:]]
        else:
            of, seconds, asker, asked = (np.zeros(0, np.int64) for _ in range(4))
            sums, entities, kept = np.zeros(0, number), [], [[] for _ in names]
        code = {e: i for i, e in enumerate(entities)}
        for frame in frames:
            new = frame["__s"].to_numpy(np.int64)
            has = frame["__v"].notna().to_numpy()
            values, which = pd.factorize(frame[entity], use_na_sentinel=False)[::-1]
            own = np.array([code.setdefault(e, len(code)) for e in pd.Series(values).tolist()], np.int64)[which]
            of, seconds, sums = _merged(
                np.concatenate([of, own[has]]),
                np.concatenate([seconds, new[has]]),
                np.concatenate([sums, frame["__v"].to_numpy()[has].astype(number)]),
            )
            asker, asked = np.concatenate([asker, own]), np.concatenate([asked, new])
            for store, name in zip(kept, names):
                store.extend(frame[name].tolist())
        entities = list(code)
        passed = state.getCurrentWatermarkMs() // 1000
        ready = asked - end < passed
        if ready.any():
            done = np.flatnonzero(ready)
            done = done[np.argsort(asker[done], kind="stable")]
            who, first = np.unique(asker[done], return_index=True)
            found = []
            for e, at in zip(who.tolist(), np.split(done, first[1:])):
                ring = slice(*np.searchsorted(of, [e, e + 1]))
                found.append(_answers(asked[at], seconds[ring], sums[ring], start, end))
            yield pd.DataFrame(
                {
                    entity: pd.Series([entities[e] for e in asker[done].tolist()], dtype=object),
                    **{name: pd.Series([store[i] for i in done], dtype=object) for name, store in zip(names, kept)},
                    out: np.concatenate(found),
                }
            )
            asker, asked = asker[~ready], asked[~ready]
            kept = [[x for x, r in zip(store, ready) if not r] for store in kept]
        # of every entity: its oldest waiting row and, once there is none, its newest second
        never = np.iinfo(np.int64).max
        waits = np.full(len(entities), never)
        np.minimum.at(waits, asker, asked)
        held = seconds >= np.minimum(waits, passed)[of] - start
        of, seconds, sums = of[held], seconds[held], sums[held]
        if len(asked) == 0 and len(seconds) == 0:
            if state.exists:
                state.remove()
            return
        newest = np.full(len(entities), np.iinfo(np.int64).min)
        np.maximum.at(newest, of, seconds)
        there = np.unique(np.concatenate([of, asker]))
        # woken when the oldest row can be answered, or when a last second is of no use
        idle = waits[there] == never
        wake = np.where(idle, newest[there] + start + 1, waits[there] - end + 1).min()
        of, asker = np.searchsorted(there, of), np.searchsorted(there, asker)
        left = [entities[e] for e in there.tolist()]
        state.update((of.tolist(), seconds.tolist(), sums.tolist(), asker.tolist(), asked.tolist(), *kept, left))
        state.setTimeoutTimestamp(max(int(wake), passed + 1) * 1000)

    group = F.col(entity) if buckets is None else F.pmod(F.xxhash64(entity), F.lit(buckets))
    timed = (
        rows.where(F.col(entity).isNotNull() & F.col(time).isNotNull())
        .withWatermark(time, delay)
        .select(
            entity, *[c for c in names if c not in (entity, time)], time,
            F.unix_seconds(time).alias("__s"), F.col(value).cast(kind).alias("__v"),
        )
    )
    answered = timed.withColumn("__bucket", group).groupBy("__bucket").applyInPandasWithState(
        update, result, state_type, "append", GroupStateTimeout.EventTimeTimeout
    )
    without = rows.where(F.col(entity).isNull() | F.col(time).isNull()).select(
        entity, *names, F.lit(0).cast(kind).alias(out)
    )
    return answered.unionByName(without)
