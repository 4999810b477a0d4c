"""N-gram Jaccard join: groups of texts that share most of their word shingles.

Texts are rows of a sparse incidence matrix of shingles; a link is an entry of its
product with its transpose that reaches the threshold. Three bounds from set sizes keep
the product small, and none loses a link:

1. *Prune.* Two linked sets of m <= n shingles share all but ``slack(n)`` of the larger,
   so among the ``slack(n) + extra`` smallest hashes of either at least ``extra`` are
   common. Only those are shuffled, packed; a text with too few that occur twice is alone.
2. *Prefix.* Among survivors, ordered by frequency, linked sets share one of their
   ``slack(n) + 1`` rarest shingles. Every such shingle has a leader, its smallest text,
   and texts that share a shingle meet in the leader's block.
3. *Product.* A block multiplies its dense column strips, accumulates overlaps, and stops
   when no pair can still reach its bound.

A block holds at most a few hundred texts: larger groups are dealt over blocks that also
hold some common pivots, and only texts outside the group's largest component are then
compared with the other blocks. Blocks return spanning edges, never all their pairs.
Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.components import components
from souk.llm.frames import bitmap, column_counts, grouped, holds
from souk.llm.text import SHINGLE_WORDS, Words, mixed, slices
from souk.plans.tables import materialize

BLOCK = 512
PIVOTS = 16
#: Parts that the texts of one group are in when they learn what is known of the group.
SALTS = 32
#: Packed shingles that one task takes of a shuffle.
PART_ENTRIES = 500_000
#: Shingles in more sets than this, or than eight times what a counter holds on average,
#: are ordered by their rough count.
OFTEN = 1000
_FLUSH = 1 << 19  # packed entries a task holds before it sends them


def slack(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's ``n`` shingles a set linked with it may lack."""
    return n - -(-n * percent // 100)


def extra(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, n // 10)


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    percent: int = 75, block: int = BLOCK,
) -> DataFrame:
    """Rows (id, n_shingles, component_id), one per row of ``docs``.

    Two texts link when ``100 * |A & B| >= percent * |A | B|`` over their distinct
    shingles; ``component_id`` is the smallest id reachable by links. A text that is
    NULL, empty or without words has 0 shingles and its own id. Equal texts link; rows
    may repeat, and a NULL id is never the smallest unless no other id is reachable.
    Other columns are ignored. Runs jobs; the result reads written tables.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes = materialize(_keyed(docs).mapInArrow(
        _sizes, f"id {docs.schema['id'].dataType.simpleString()}, key long, n long, set long"
    ))
    classes = sizes.filter("n > 0").groupBy("set").agg(
        F.min("id").alias("smallest"), F.min("key").alias("key"), F.min("n").alias("n")
    )
    survivors = materialize(_survivors(docs, sizes, classes, percent))
    sets = materialize(_sets(docs, survivors))
    edges = _edges(sets, percent, block)
    labels = components(edges)
    labelled = classes.select("set", "smallest").join(labels, F.col("set") == labels.node, "left")
    labelled = materialize(labelled.select(
        "set", "smallest", F.coalesce("component", "set").alias("component")
    ))
    smallest = labelled.groupBy("component").agg(F.min("smallest").alias("component_id"))
    by_set = labelled.join(smallest, "component").select("set", "component_id")
    return sizes.join(by_set, "set", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the smallest id stays.

    Of rows that repeat that id one stays. NULL ids come last. Texts without words are
    copies of nothing and stay. All columns are kept as they are.
    """
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("row")).select(
        F.struct(
            F.col("row")[id_col].isNull().alias("unnamed"), F.col("row")[id_col].alias("id"),
            F.monotonically_increasing_id().alias("number"),
        ).alias("key"), "row", F.col("row")[text_col].alias("text"),
    )
    joined = ngram_join(rows.select("key", "text"), "key", "text", percent)
    copies = joined.filter("n_shingles > 0 AND key != component_id").select(
        F.col("key").alias("copy"))
    return rows.join(copies, F.col("key") == F.col("copy"), "left_anti").select(
        *(F.col("row")[n].alias(n) for n in names))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.xxhash64("text").alias("key"), "text")


def _names(sets: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per set, equal for equal sets."""
    sums = np.fromiter((int(s.sum(dtype=np.uint64)) for s in sets), np.uint64, len(sets))
    sizes = np.fromiter(map(len, sets), np.uint64, len(sets))
    return mixed(sums + mixed(sizes)).view(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches, "text"):
        sets = Words(texts).sets()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"),
             pa.array([len(s) for s in sets], pa.int64()), pa.array(_names(sets))],
            ["id", "key", "n", "set"],
        )


# --- prune --------------------------------------------------------------------------------


def _survivors(docs, sizes, classes, percent: int) -> DataFrame:
    """Rows (set, key) of sets that may have a link to another set."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total * (100 - percent + 10) // 100 // PART_ENTRIES))
    packed = docs.select("text").mapInArrow(
        partial(_send, percent=percent, parts=parts), "part int, tokens binary, sets binary"
    )
    counts = packed.groupBy("part").applyInArrow(
        grouped(_count_shared, parts=parts), "part int, sets binary, shared binary"
    ).groupBy("part").applyInArrow(_add_shared, "set long, shared long")
    needed = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 10))
    return classes.join(counts, "set").filter(F.col("shared") >= needed).select("set", "key")


def _send(
    batches: Iterator[pa.RecordBatch], percent: int, parts: int
) -> Iterator[pa.RecordBatch]:
    """Each text's smallest hashes, packed by hash partition.

    A hash that a task holds twice is sent once, marked by set 0, and counted here, so a
    shingle of a third of all texts costs a task one entry.
    """
    tokens, names, held = [], [], 0

    def flush():
        token, name = np.concatenate(tokens), np.concatenate(names)
        order = np.argsort(token)
        token, name = token[order], name[order]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        repeats = np.diff(np.append(first, len(token)))
        many = np.repeat(repeats > 1, repeats)
        counted, counts = np.unique(name[many], return_counts=True)
        token, name = token[first], np.where(repeats > 1, np.uint64(0), name[first])
        part = _part(token, parts)  # ascending, as the tokens are
        edges = np.searchsorted(part, np.arange(parts + 1))
        rows = [
            (p, token[a:b].tobytes(), name[a:b].tobytes())
            for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a
        ]
        if len(counted):
            where = parts + int(counted[0] % np.uint64(parts))
            rows.append((where, counts.astype(np.uint64).tobytes(), counted.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
            ["part", "tokens", "sets"],
        )

    for _, texts in slices(batches, "text"):
        sets = Words(texts).sets()
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        kept = np.where(n > 0, slack(n, percent) + extra(n), 0)
        tokens += [s[:k] for s, k in zip(sets, kept)]
        names.append(np.repeat(_names(sets).view(np.uint64), kept))
        held += int(kept.sum())
        if held >= _FLUSH:
            yield flush()
            tokens, names, held = [], [], 0
    if held:
        yield flush()


def _part(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _count_shared(group: pa.Table, parts: int) -> pa.Table:
    token, name = (
        np.frombuffer(b"".join(group.column(c).to_pylist()), np.uint64)
        for c in ("tokens", "sets")
    )
    if group.column("part")[0].as_py() < parts:
        _, where, repeats = np.unique(token, return_inverse=True, return_counts=True)
        marked = np.bincount(where, weights=name == 0)
        shared = ((repeats + marked) > 1)[where] & (name != 0)
        found, counts = np.unique(name[shared], return_counts=True)
    else:
        found, where = np.unique(name, return_inverse=True)
        counts = np.bincount(where, weights=token)
    # Packed by set: a row for each set and part would be one for almost every shingle.
    part, counts = _part(found, parts), counts.astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(edges))
    return pa.table({
        "part": pa.array(full, pa.int32()),
        **{name: pa.array([column[order[edges[p]:edges[p + 1]]].tobytes() for p in full], pa.binary())
           for name, column in (("sets", found), ("shared", counts))},
    })


def _add_shared(group: pa.Table) -> pa.Table:
    names, shared = (
        np.frombuffer(b"".join(group.column(c).to_pylist()), np.int64) for c in ("sets", "shared")
    )
    found, where = np.unique(names, return_inverse=True)
    total = np.bincount(where, weights=shared, minlength=len(found)).astype(np.int64)
    return pa.table({"set": found, "shared": total})


# --- sets of the survivors ------------------------------------------------------------------


def _sets(docs, survivors) -> DataFrame:
    """Rows (set, n, tokens): each surviving set once, its hashes packed."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(bitmap(survivors, "key"))
    rows = _keyed(docs).select("key", "text").mapInArrow(
        partial(_wanted_sets, wanted=wanted), "set long, n long, tokens binary"
    )
    # Grouped first: the join then finds its rows dealt by set already.
    return rows.groupBy("set").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens")
    ).join(survivors.select("set"), "set", "left_semi")


def _wanted_sets(batches: Iterator[pa.RecordBatch], wanted) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        held = wanted.value.holds(batch.column("key").to_numpy(zero_copy_only=False))
        batch = batch.filter(pa.array(held))
        for part, texts in slices([batch], "text"):
            sets = Words(texts).sets()
            names = _names(sets)
            new = []
            for i, name in enumerate(names.tolist()):
                if name not in seen and len(sets[i]):
                    seen.add(name)
                    new.append(i)
            if len(seen) > 1_000_000:  # only saves repeats; the query drops them anyway
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[new]), pa.array([len(sets[i]) for i in new], pa.int64()),
                 pa.array([sets[i].tobytes() for i in new], pa.binary())],
                ["set", "n", "tokens"],
            )


# --- blocks ---------------------------------------------------------------------------------


def _edges(sets, percent: int, block: int) -> DataFrame:
    """Spanning edges (a, b) of the links between different sets."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    rough = spark.sparkContext.broadcast(column_counts(sets, "tokens"))
    often = max(OFTEN, 8 * total // len(rough.value.counts))
    parts = max(1, -(-total // PART_ENTRIES))
    packed = "part int, sets binary, tokens binary, counts binary, sizes binary, held binary"
    rare = sets.select("set", "tokens").mapInArrow(
        partial(_send_rare, rough=rough, often=often, parts=parts),
        "part int, tokens binary, sets binary",
    ).groupBy("part").applyInArrow(grouped(_frequencies, parts=parts), packed)
    common = sets.select("set", "tokens").mapInArrow(
        partial(_common, percent=percent, rough=rough, often=often, parts=parts), packed
    )
    prefixes = materialize(rare.unionByName(common).groupBy("part").applyInArrow(
        grouped(_prefixes, percent=percent), "token long, set long"
    ))
    leaders = prefixes.groupBy("token").agg(
        F.min("set").alias("leader"), F.count("*").alias("times")
    ).filter("times > 1").select("token", "leader")
    members = materialize(
        prefixes.join(leaders, "token").select("leader", "set").distinct()
    )
    crowds = members.groupBy("leader").agg(F.count("*").alias("crowd")).filter(
        F.col("crowd") > block)
    # Dealt by hash; a crowd's pivots go to each of its blocks.
    dealt = _beside(members, crowds, "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("crowd") / block), F.lit(1)).cast("int")
    ).withColumn("draw", F.xxhash64("set", "leader"))
    whole = F.sequence(F.lit(0), F.col("blocks") - 1)
    pivot = (F.col("blocks") > 1) & (F.pmod("draw", "crowd") < PIVOTS)
    own = F.array(F.pmod(F.shiftright("draw", 20), F.col("blocks")).cast("int"))
    placed = dealt.select(
        "leader", "set", "blocks", F.explode(F.when(pivot, whole).otherwise(own)).alias("block")
    )
    # Most sets share no prefix with another: those stay where they are.
    linked = holds(spark, bitmap(dealt, "set"))
    sets = sets.filter(linked(F.col("set"))).select("set", "tokens")
    first = materialize(
        placed.join(sets, "set").groupBy("leader", "block")
        .applyInArrow(grouped(_link_block, percent=percent), "a long, b long")
    )
    wide = materialize(dealt.filter("blocks > 1").select("leader", "set", "blocks"))
    if wide.isEmpty():
        return first
    sets = sets.filter(holds(spark, bitmap(wide, "set"))(F.col("set")))
    # A pair of different blocks that is not yet joined has a side outside the group's
    # largest component: those sides visit all blocks.
    labels = components(first)
    joined = wide.join(labels, wide["set"] == labels.node, "left").select(
        "leader", "set", "blocks", F.coalesce("component", "set").alias("component")
    )
    main = joined.groupBy("leader", "component").agg(F.count("*").alias("held")).groupBy(
        "leader").agg(F.max_by("component", "held").alias("main"))
    outside = _beside(joined, main).filter("component != main")
    # Visitors come in waves of a block's size; a wave meets each resident block in a task.
    waves = outside.groupBy("leader").agg(F.ceil(F.count("*") / block).cast("int").alias("waves"))
    visits = _beside(outside, waves).select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "set",
        F.lit(True).alias("visits"),
        F.pmod(F.xxhash64("set"), F.col("waves")).cast("int").alias("wave"),
    )
    stays = _beside(placed.filter("blocks > 1"), waves).select(
        "leader", "block", "set", F.lit(False).alias("visits"),
        F.explode(F.sequence(F.lit(0), F.col("waves") - 1)).alias("wave"),
    )
    second = (
        stays.unionByName(visits).join(sets, "set").groupBy("leader", "block", "wave")
        .applyInArrow(grouped(_link_block, percent=percent), "a long, b long")
    )
    return materialize(first.unionByName(second))


def _beside(rows: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` (leader, set, ...) with what ``facts`` holds of their leader.

    Facts are of groups larger than a block, a row each, so that a copy for every salt is
    still few rows beside the groups' own. A group's rows are spread over the salts.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("set"), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", salt).join(
        facts.select("*", salts), ["leader", "salt"], how).drop("salt")


def _send_rare(
    batches: Iterator[pa.RecordBatch], rough, often: int, parts: int
) -> Iterator[pa.RecordBatch]:
    """Shingles that are not common, with their sets, packed by hash partition."""
    for batch in batches:
        tokens, names = _unpacked(batch)
        kept = rough.value.of(tokens) <= often
        tokens, names = tokens[kept], names[kept]
        part = _part(tokens, parts)
        order = np.argsort(part, kind="stable")
        tokens, names = tokens[order], names[order]
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(edges))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()),
             *(pa.array([x[edges[p]:edges[p + 1]].tobytes() for p in full], pa.binary())
               for x in (tokens, names))],
            ["part", "tokens", "sets"],
        )


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    packed = batch.column("tokens").to_pylist()
    tokens = np.frombuffer(b"".join(packed), np.uint64)
    names = np.repeat(batch.column("set").to_numpy(), [len(p) // 8 for p in packed])
    return tokens, names


def _packed(
    part: np.ndarray, parts: int, columns: list[np.ndarray], place: int
) -> list[tuple]:
    """Rows (part, five cells) of entries: ``columns`` fill the cells from ``place`` on."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    rows = []
    for p in np.flatnonzero(np.diff(edges)).tolist():
        cells = [b""] * 5
        here = order[edges[p]:edges[p + 1]]
        for number, column in enumerate(columns):
            cells[0 if number == 0 else place + number - 1] = column[here].tobytes()
        rows.append((p, *cells))
    return rows


_PACKED = ["part", "sets", "tokens", "counts", "sizes", "held"]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), *[pa.binary()] * 5)
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _PACKED)


def _frequencies(group: pa.Table, parts: int) -> pa.Table:
    """Shingles here that several sets have, with the sets and how many, packed by set."""
    tokens = np.frombuffer(b"".join(group.column("tokens").to_pylist()), np.uint64)
    names = np.frombuffer(b"".join(group.column("sets").to_pylist()), np.int64)
    _, where, times = np.unique(tokens, return_inverse=True, return_counts=True)
    times = times[where]
    shared = times > 1
    tokens, names, times = tokens[shared], names[shared], times[shared]
    return pa.Table.from_batches([_as_batch(_packed(
        _part(names.view(np.uint64), parts), parts, [names, tokens, times.astype(np.uint32)], 1))])


def _common(
    batches: Iterator[pa.RecordBatch], percent: int, rough, often: int, parts: int
) -> Iterator[pa.RecordBatch]:
    """Each set's size and number of common shingles, and as many as a prefix could take.

    Their counts are rough ones above all that are not common.
    """
    for batch in batches:
        names = batch.column("set").to_numpy()
        sizes, held = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        kept, times_of = [], []
        for number, packed in enumerate(batch.column("tokens").to_pylist()):
            tokens = np.frombuffer(packed, np.uint64)
            times = rough.value.of(tokens)
            hot = np.flatnonzero(times > often)
            sizes[number], held[number] = len(tokens), len(hot)
            order = hot[np.lexsort((tokens[hot], times[hot]))]
            order = order[:int(slack(sizes[number], percent)) + 1]
            kept.append(tokens[order])
            times_of.append(times[order].astype(np.uint32) | _COMMON)
        if not len(names):
            continue
        part = _part(names.view(np.uint64), parts)
        rows = _packed(part, parts, [names, sizes, held], 3)
        owner = np.repeat(np.arange(len(names)), [len(k) for k in kept])
        rows += _packed(
            part[owner], parts, [names[owner], np.concatenate(kept), np.concatenate(times_of)], 1)
        yield _as_batch(rows)


_COMMON = np.uint32(1 << 31)


def _prefixes(group: pa.Table, percent: int) -> pa.Table:
    """The shared shingles in each set's prefix. Those that no other set has come first in
    the order and lead to nobody."""
    def column(name: str, kind, wanted: str) -> np.ndarray:
        cells = zip(group.column(name).to_pylist(), group.column(wanted).to_pylist())
        return np.frombuffer(b"".join(cell for cell, filled in cells if filled), kind)

    names, sizes = column("sets", np.int64, "sizes"), column("sizes", np.int64, "sizes")
    held = column("held", np.int64, "sizes")
    owner, tokens = column("sets", np.int64, "tokens"), column("tokens", np.uint64, "tokens")
    times = column("counts", np.uint32, "tokens")
    order = np.argsort(names)
    names, sizes, held = names[order], sizes[order], held[order]
    which = np.searchsorted(names, owner)
    rare = np.bincount(which[times < _COMMON], minlength=len(names))
    keep = slack(sizes, percent) + 1 - (sizes - held - rare)
    order = np.lexsort((tokens, times, which))
    which, tokens = which[order], tokens[order]
    first = np.searchsorted(which, np.arange(len(names)))
    chosen = np.arange(len(which)) - first[which] < keep[which]
    return pa.table({"token": tokens[chosen].view(np.int64), "set": names[which[chosen]]})


def _link_block(group: pa.Table, percent: int) -> pa.Table:
    """Spanning edges of the links within a block; of those with a visitor, if it has any."""
    group = group.combine_chunks()
    visits = np.zeros(group.num_rows, bool)
    if "visits" in group.column_names:
        visits = group.column("visits").to_numpy(zero_copy_only=False).astype(bool)
        if not visits.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    names = group.column("set").to_numpy()
    sets = [np.frombuffer(b, np.uint64) for b in group.column("tokens").to_pylist()]
    links = overlaps_reach(sets, percent, np.flatnonzero(visits) if visits.any() else None)
    label = np.arange(len(names))
    a, b = links
    while True:  # smallest label over links, then over labels of labels
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if (label == before).all():
            break
    joined = np.flatnonzero((label != np.arange(len(names))) & (names != names[label]))
    return pa.table({"a": names[joined], "b": names[label[joined]]})


def overlaps_reach(
    sets: list[np.ndarray], percent: int, rows: np.ndarray | None = None, strip: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``sets`` that link, as two index arrays; only those with a side in ``rows``."""
    rows = np.arange(len(sets)) if rows is None else rows
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    owner = np.repeat(np.arange(len(sets)), n)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    new = np.concatenate(([True], column[1:] != column[:-1])) if len(column) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    width = int(column[-1]) + 1 if len(column) else 0
    small, large = np.minimum(n[rows, None], n), np.maximum(n[rows, None], n)
    both = n[rows, None] + n
    alive = 100 * small >= percent * large  # sizes alone rule the others out
    alive[np.arange(len(rows)), rows] = False
    overlap = np.zeros((len(rows), len(sets)), np.float32)
    left = np.bincount(owner, minlength=len(sets))
    for low in range(0, width, strip):
        if not alive.any():
            break
        a, b = np.searchsorted(column, [low, low + strip])
        part = np.zeros((len(sets), min(strip, width - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        overlap += part[rows] @ part.T
        left = left - np.bincount(owner[a:b], minlength=len(sets))
        most = overlap + np.minimum(left[rows, None], left)
        alive &= (100 + percent) * most >= percent * both
    linked = alive & ((100 + percent) * overlap.astype(np.int64) >= percent * both)
    found, other = np.nonzero(linked)
    return rows[found], other


#: The rows of ``ngram_join`` over documents in DuckDB's SQL.
ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[p:p + size - 1], ' ') AS shingle FROM (
    SELECT r, w, least(5, len(w)) AS size, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p
    FROM texts WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.r <> b.r
  JOIN sizes x ON x.r = a.r JOIN sizes y ON y.r = b.r
  WHERE 4 * x.n >= 3 * y.n AND 4 * y.n >= 3 * x.n
  GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached AS (
  SELECT r, r AS other FROM sizes UNION SELECT reached.r, b FROM reached JOIN links ON a = other)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, coalesce(min(o.doc_id), t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes USING (r) LEFT JOIN reached USING (r) LEFT JOIN texts o ON o.r = other
GROUP BY t.r, t.doc_id, n
"""
