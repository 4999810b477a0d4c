"""Suffix-array dedup: bytes covered by long strings that start anywhere else too.

Prefix doubling names every position by the string that starts there, and renames it by
pairs of names at growing offsets until it is unique or past the threshold. Done on all
bytes, every round would shuffle some twenty times the input. Here it is done on a
synchronised sample, which gives the same answer: of any ``SPAN`` consecutive starts the
one with the smallest hash of its next few bytes is an anchor, so equal strings of
``size`` bytes have their anchor at the same place. Ranks are fingerprints, the names
that sorting would give.

1. A string of ``size`` bytes holds the ``size - SPAN`` bytes after its anchor. Anchors
   whose such core is unique drop out: most of them.
2. All strings of an anchor lie in one stretch. Stretches that occur twice settle all
   their strings at once. Of the rest, one each, strings are ranked by cores that are
   ``STEP - 1`` bytes short of the threshold, and unique ones drop out again.
3. What is left is ranked by whole strings.

Rows are joined by names, counted before they meet, so that a passage of a third of all
documents is nobody's task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.frames import bitmap, holds
from souk.llm.text import Fingerprints, Texts, mixed, slices
from souk.plans.tables import materialize

SIZE = 400
SPAN = 128
STEP = 32
_SEED = 16  # bytes that choose an anchor
_POSITION_BITS = 36
_SLICE = 1 << 18  # some ten numbers a byte are held at once
#: Starts of a text that are joined to runs together.
_BLOCK = 1 << 16


def repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE
) -> DataFrame:
    """Rows (id, n_bytes, spans, kept), one per row of ``docs``, in no order.

    ``spans`` are the maximal runs (start, until) of removed bytes, ascending; ``kept`` the
    other bytes. A byte goes if a string of ``size`` bytes covers it that also starts
    elsewhere, in this text or another row's; strings may overlap. Strings are judged on
    the input and never cross texts. NULL counts as empty. Repeated rows are other
    places: both lose what they share. Other columns are ignored. Runs jobs.
    """
    if size < SPAN + _SEED + STEP:
        raise ValueError(f"size must be {SPAN + _SEED + STEP} or more")
    docs = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("key", F.xxhash64("text"))
    strings = materialize(_repeated_strings(docs, size))
    wanted = holds(docs.sparkSession, bitmap(strings, "key"))
    marks = strings.groupBy(F.col("key").alias("marked")).agg(
        F.collect_list(F.struct("at", "count")).alias("marks")
    )
    touched = docs.filter(wanted(F.col("key"))).join(marks, F.col("key") == F.col("marked"), "left")
    others = docs.filter(~wanted(F.col("key"))).withColumn(
        "marks", F.lit(None).cast("array<struct<at:bigint,count:bigint>>"))
    kind = docs.schema["id"].dataType.simpleString()
    return touched.select("id", "text", "marks").unionByName(
        others.select("id", "text", "marks")
    ).mapInArrow(
        partial(_kept, size=size),
        f"id {kind}, n_bytes long, spans array<struct<start:long,until:long>>, kept binary",
    ).withColumnRenamed("id", id_col)


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept_sha256) of ``repeated``'s."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.until - s.start)
    return rows.select(
        id_col, "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def _repeated_strings(docs: DataFrame, size: int) -> DataFrame:
    """Rows (key, at, count): strings that start at ``at`` and the next ``count - 1`` bytes
    of the text named ``key`` occur elsewhere."""
    anchors = docs.select("key", "text").mapInArrow(
        partial(_anchors, size=size), "core long, stretch long, key long, place long"
    )
    cores = anchors.groupBy("core").agg(F.count("*").alias("times")).filter("times > 1")
    # Dealt anew after the join, so that Spark can split a core that many places share.
    place = ["core", "stretch", "key", "place"]
    places = materialize(
        anchors.join(cores.select("core"), "core", "left_semi").repartition(*place)
        .groupBy(*place).agg(F.count("*").alias("copies"))
    )
    stretches = materialize(places.groupBy("core", "stretch").agg(
        F.sum("copies").alias("times"), F.min(F.struct("key", "place")).alias("first")
    ))
    settled = places.join(
        stretches.filter("times > 1").select("core", "stretch"), ["core", "stretch"], "left_semi"
    ).select("key", F.shiftright("place", 16).alias("at"),
             (F.col("place").bitwiseAND(F.lit(255)) + 1).alias("count"))
    # Of each stretch of a core that has an unsettled one, the strings of one place.
    unsettled = stretches.filter("times = 1").select("core").distinct()
    asked = materialize(stretches.join(unsettled, "core", "left_semi").groupBy(
        F.col("first.key").alias("asked")
    ).agg(F.collect_list(F.struct(
        F.col("core"), F.col("first.place").alias("place"), (F.col("times") == 1).alias("open")
    )).alias("places")))
    wanted = holds(docs.sparkSession, bitmap(asked, "asked"))
    texts = docs.select("key", "text").filter(wanted(F.col("key")))
    steps = materialize(
        texts.join(asked, F.col("key") == F.col("asked"))
        .dropDuplicates(["key"]).select("key", "text", "places")
        .mapInArrow(
            partial(_steps, size=size),
            "core long, key long, at long, open boolean, names binary",
        )
    )
    twice = steps.groupBy("core").agg(
        F.count("*").alias("times"), F.bool_or("open").alias("open")
    ).filter("times > 1 AND open").select("core")
    strings = materialize(steps.join(twice, "core", "left_semi").mapInArrow(
        _strings, "name long, key long, at long, open boolean"
    ))
    names = strings.groupBy("name").agg(
        F.count("*").alias("times"), F.bool_or("open").alias("any_open")
    ).filter("times > 1 AND any_open").select("name")
    found = strings.filter("open").join(names, "name", "left_semi").select("key", "at")
    return settled.unionByName(_in_runs(found))


def _in_runs(starts: DataFrame) -> DataFrame:
    """Rows (key, at, count) of starts (key, at): those that follow each other are one."""
    blocks = starts.distinct().withColumn("block", F.floor(F.col("at") / _BLOCK))
    place = F.row_number().over(Window.partitionBy("key", "block").orderBy("at"))
    return blocks.withColumn("run", F.col("at") - place).groupBy("key", "block", "run").agg(
        F.min("at").alias("at"), F.count("*").alias("count")).select("key", "at", "count")


def _anchors(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text", _SLICE):
        first, count, anchor, prints = anchors(texts, size)
        if not len(first):
            continue
        core = prints.of(anchor, anchor + size - SPAN)
        # Equal stretches hold equal strings at equal distances from their anchors.
        stretch = mixed(
            prints.of(first, first + count - 1 + size)
            + mixed(((anchor - first) << 8 | (count - 1)).astype(np.uint64))
        )
        text = np.searchsorted(texts.bounds, first, "right") - 1
        key = batch.column("key").to_numpy()[text]
        place = (first - texts.bounds[text]) << 16 | (anchor - first) << 8 | (count - 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(core.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(key),
             pa.array(place)],
            ["core", "stretch", "key", "place"],
        )


def anchors(texts: Texts, size: int):
    """Runs of string starts with one anchor: first start, number, anchor; fingerprints."""
    data, bounds = texts.data, texts.bounds
    prints = Fingerprints(data, 1)
    count = len(data) - size + 1
    nothing = np.zeros(0, np.int64)
    if count <= 0:
        return nothing, nothing, nothing, prints
    seeds = prints.windows(_SEED)[:count + SPAN - 1]
    # The smallest seed of SPAN starts, the leftmost of equals, by doubling.
    least = (seeds >> np.uint64(_POSITION_BITS)) << np.uint64(_POSITION_BITS)
    least |= np.arange(len(least), dtype=np.uint64)
    reach = 1
    while reach < SPAN:
        step = min(reach, SPAN - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    at = (least[:count] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    lengths = np.diff(bounds)
    change = np.zeros(len(data) + 1, np.int32)
    long = lengths >= size
    change[bounds[:-1][long]] += 1
    np.subtract.at(change, bounds[1:][long] - size + 1, 1)
    valid = np.cumsum(change)[:count] > 0
    new = np.ones(count, bool)
    new[1:] = at[1:] != at[:-1]
    starts = bounds[:-1][long]
    new[starts] = True
    edges = np.flatnonzero(new | ~valid)
    ends = np.append(edges[1:], count)
    run = valid[edges]
    return edges[run], (ends - edges)[run], at[edges[run]], prints


def _steps(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The strings of asked places, in runs of up to STEP that share nearly all their bytes.

    ``core`` names what a run's strings share, ``names`` packs the strings' own names.
    """
    for batch, texts in slices(batches, "text", _SLICE):
        asked = batch.column("places")
        flat, parents = asked.flatten(), asked.value_lengths().to_numpy()
        core = flat.field("core").to_numpy().view(np.uint64)
        place = flat.field("place").to_numpy()
        is_open = flat.field("open").to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(len(texts)), parents)
        first = (place >> 16) + texts.bounds[text]
        far = (place >> 8) & 255  # from the first start to the anchor
        last = far - (place & 255)  # from the last
        low = last // STEP
        runs = far // STEP - low + 1
        owner = np.repeat(np.arange(len(place)), runs)
        stops = np.cumsum(runs)
        step = np.arange(len(owner)) - np.repeat(stops - runs, runs) + low[owner]
        anchor = (first + far)[owner]
        shared = anchor - STEP * step
        near, deep = Fingerprints(texts.data, 1), Fingerprints(texts.data, 2)
        name = mixed(
            near.of(shared, shared - STEP + 1 + size)
            + mixed(core[owner] + mixed(step.astype(np.uint64)))
        )
        begin = anchor - np.minimum(far[owner], STEP * step + STEP - 1)
        count = anchor - np.maximum(last[owner], STEP * step) - begin + 1
        edges = np.append(0, np.cumsum(count))
        string = np.arange(edges[-1]) + np.repeat(begin - edges[:-1], count)
        distance = np.repeat(anchor, count) - string
        names = mixed(deep.of(string, string + size) + mixed(
            np.repeat(core[owner], count) + mixed(distance.astype(np.uint64))))
        packed = names.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(name.view(np.int64)),
             pa.array(batch.column("key").to_numpy()[text][owner]),
             pa.array(begin - texts.bounds[text][owner]), pa.array(is_open[owner]),
             pa.array([packed[a * 8:b * 8] for a, b in zip(edges, edges[1:])], pa.binary())],
            ["core", "key", "at", "open", "names"],
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = batch.column("names").to_pylist()
        count = np.fromiter((len(p) // 8 for p in packed), np.int64, len(packed))
        stops = np.cumsum(count)
        total = int(stops[-1]) if len(stops) else 0
        begin = batch.column("at").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(b"".join(packed), np.int64)),
             pa.array(np.repeat(batch.column("key").to_numpy(), count)),
             pa.array(np.arange(total) + np.repeat(begin - (stops - count), count)),
             pa.array(np.repeat(batch.column("open").to_numpy(zero_copy_only=False), count))],
            ["name", "key", "at", "open"],
        )


def _kept(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("until", pa.int64())]))
    for whole in batches:
        for batch, texts in slices([whole], "text", _SLICE):
            spans, kept = [], []
            for i, marks in enumerate(batch.column("marks")):
                data = texts.blob(i)
                runs = _union(marks, size) if marks.is_valid else []
                spans.append([{"start": a, "until": b} for a, b in runs])
                if runs:
                    edges = [0, *(e for run in runs for e in run), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                kept.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(texts.bounds)), pa.array(spans, kind),
                 pa.array(kept, pa.binary())],
                ["id", "n_bytes", "spans", "kept"],
            )


def _union(marks: pa.ListScalar, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by marked strings; runs that touch are one."""
    rows = marks.values
    start = rows.field("at").to_numpy()
    until = start + rows.field("count").to_numpy() - 1 + size
    order = np.argsort(start, kind="stable")
    start, until = start[order], np.maximum.accumulate(until[order])
    head = np.concatenate(([True], start[1:] > until[:-1]))
    tail = np.append(np.flatnonzero(head)[1:] - 1, len(start) - 1)
    return list(zip(start[head].tolist(), until[tail].tolist()))
