"""Exact self-join of documents on the Jaccard similarity of their word shingles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import attach_groups, bitmap_of, components, filter_bit, in_bitmap
from siltstone.llm.shingles import shingle_sets, slices
from siltstone.sinks.staging import stage, staged

SHARED = 3  # prefix elements that a pair must have in common
SMALL_MOST = 16  # sets above this size are always large
CHUNK_SHINGLES = 2_000_000
CHUNK_REPEATS = 3
LONG_LIST = 32
CHUNK_SETS = 512
CHUNK_ELEMENTS = 1 << 18
DEALINGS = 4
HELPS = 0.01  # share of the members of long lists that must join a component for a further dealing
LARGE_COMPONENT = 64
SLAB = 4096  # columns of a membership matrix that are multiplied at a time
LISTED_MOST = 2_000_000


def least_overlap(a: int, b: int, percent: int) -> int:
    """The smallest o with 100 o >= percent (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    """Any partner has SHARED elements, or all it must, among the first so many, in an order common to all sets.

    A partner of any allowed size shares at least ceil(percent / 100 size) elements.
    """
    least = -(-percent * size // 100)
    return size - least + min(SHARED, least)


def subset_keys(values: np.ndarray, percent: int, largest: int) -> Iterator[tuple[bytes, int]]:
    """Keys of the fixed-size subsets of a small set, and its side: 0 the smaller, 1 the larger, 2 of equal sizes.

    Sets of sizes a <= b are similar exactly if they share a subset of ``least_overlap(a, b)``.
    """
    size = len(values)
    for other in range(-(-percent * size // 100), min(largest, size * 100 // percent) + 1):
        low, high = min(size, other), max(size, other)
        head = bytes([low, high])
        side = 2 if size == other else int(size > other)
        for chosen in combinations(values, least_overlap(size, other, percent)):
            yield head + np.array(chosen, dtype=np.uint64).tobytes(), side


def _enumerated(size: int, percent: int) -> int:
    partners = range(-(-percent * size // 100), size * 100 // percent + 1)
    return sum(math.comb(size, least_overlap(size, o, percent)) for o in partners if least_overlap(size, o, percent) <= size)


def size_boundary(percent: int, list_length: float) -> int:
    """The largest size at which enumerating subsets costs no more than scanning lists, for all sizes up to it."""
    size = 0
    while size < SMALL_MOST and _enumerated(size + 1, percent) <= prefix_length(size + 1, percent) * (1 + list_length):
        size += 1
    return size


def common_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles of many documents, sorted: those that come last in the common order.

    Tasks count whole chunks of CHUNK_SHINGLES and send what occurs CHUNK_REPEATS times
    in one; a shingle counts as common above one in 2,000 documents. That bounds their
    number by 2,000 average sets. Copies count once a chunk. The order decides
    what is compared with what, never what is found.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: dict[bytes, np.ndarray] = {}
        total = 0

        def counted() -> pd.DataFrame:
            values, times = np.unique(np.concatenate([*held.values(), np.zeros(0, np.uint64)]), return_counts=True)
            often = times >= CHUNK_REPEATS
            held.clear()
            return pd.DataFrame({"shingle": values[often].view(np.int64), "n": times[often]})

        for batch in slices(batches):
            for found in shingle_sets(batch.column(0).to_pylist(), words):
                if len(found):
                    held[xxhash.xxh3_128_digest(found.tobytes())] = found
                    total += len(found)
                if total > CHUNK_SHINGLES:
                    yield counted()
                    total = 0
        yield counted()

    def in_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in count(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    rows = docs.count()
    counts = docs.select("text").mapInArrow(in_arrow, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return np.sort(_hashes(counts.where(F.col("n") > max(8, rows // 2000)), "shingle"))


def _hashes(rows: DataFrame, column: str) -> np.ndarray:
    """A column on the driver, 8 bytes a value: Arrow, as rows take many times that."""
    return np.asarray(rows.select(column).toArrow().column(column), dtype=np.int64).view(np.uint64)


def in_long_lists(docs: DataFrame, words: int, percent: int, common: np.ndarray) -> np.ndarray:
    """Prefix elements, under the order given, whose lists are long: LISTED_MOST at most, by the length asked for."""
    entries = profiles(docs, words, percent, common).select(F.explode("prefix").alias("shingle"))
    lengths = stage(entries.groupBy("shingle").agg(F.count("*").alias("length")).where(F.col("length") > LONG_LIST), "lengths")
    rows = lengths.agg(F.sum("length")).first()[0] or 0
    return _hashes(lengths.where(F.col("length") > rows / LISTED_MOST), "shingle")


def profiles(docs: DataFrame, words: int, percent: int, last_in_order: np.ndarray) -> DataFrame:
    """(doc_id, n, sig_a, sig_b, prefix, whole): size, digest, first elements in the common order, small sets."""
    common = docs.sparkSession.sparkContext.broadcast(last_in_order)
    schema = "doc_id long, n long, sig_a long, sig_b long, prefix array<long>, whole array<long>"

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for batch in slices(batches):
            rows = []
            ids = batch.column(0).to_pylist()
            for doc_id, found in zip(ids, shingle_sets(batch.column(1).to_pylist(), words)):
                size = len(found)
                sig = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype=np.int64)
                first = found
                if len(last) and size:
                    at = np.minimum(np.searchsorted(last, found), len(last) - 1)
                    is_last = last[at] == found
                    first = np.concatenate([found[~is_last], found[is_last]])
                prefix = first[: prefix_length(size, percent)].view(np.int64)
                whole = found.view(np.int64) if size <= SMALL_MOST else None
                rows.append((doc_id, size, int(sig[0]), int(sig[1]), prefix, whole))
            if rows:
                columns = [
                    pa.array(c, t)
                    for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig_a", "sig_b", "prefix", "whole"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(profile, schema)


def _small_links(reps: DataFrame, percent: int, largest: int) -> DataFrame:
    """Links between small sets: a star around the least member for every shared subset."""

    def enumerate_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*np.frombuffer(xxhash.xxh3_128_digest(key), dtype=np.int64).tolist(), side, rep)
                for rep, whole in zip(batch["rep"], batch["whole"])
                for key, side in subset_keys(np.asarray(whole, dtype=np.int64).view(np.uint64), percent, largest)
            ]
            yield pd.DataFrame(rows, columns=["key_a", "key_b", "side", "rep"])

    small = reps.where((F.col("n") > 0) & (F.col("n") <= largest)).select("rep", "whole")
    keys = small.mapInPandas(enumerate_keys, "key_a long, key_b long, side int, rep long")
    least = lambda side: F.min(F.when(F.col("side") == side, F.col("rep")))
    ends = keys.groupBy("key_a", "key_b").agg(
        least(0).alias("low"), least(1).alias("high"), least(2).alias("equal"), F.count("*").alias("rows")
    )
    ends = ends.where("rows > 1").drop("rows")
    met = keys.join(ends, ["key_a", "key_b"])
    centre = F.when(F.col("side") == 0, F.col("high")).when(F.col("side") == 1, F.col("low")).otherwise(F.col("equal"))
    return met.select(F.col("rep").alias("a"), centre.alias("b")).where("a <> b").distinct()


def kept_sets(docs: DataFrame, wanted: DataFrame, words: int, bits: int) -> DataFrame:
    """(rep, values): the shingle sets of the ``wanted`` documents, sorted, the top ``bits`` of every hash.

    Texts are read again, so that no sets are kept but those asked for.
    """
    asked = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted, "rep"))
    kind, shift = f"<u{bits // 8}", np.uint64(64 - bits)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hit = np.flatnonzero(in_bitmap(asked.value, batch.column(2).to_numpy()))
            if not len(hit):
                continue
            part = batch.take(pa.array(hit))
            found = shingle_sets(part.column(1).to_pylist(), words)
            values = [(f >> shift).astype(kind).tobytes() for f in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.binary())], names=["rep", "values"])

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("rep"), "text")
    sets = stage(rows.withColumn("bit", filter_bit("rep")).mapInArrow(keep, "rep long, values binary"), "sets")
    asked.destroy()
    return sets


def prefix_entries(reps: DataFrame) -> DataFrame:
    """(rep, n, shingle, length): entries of the inverted lists that have more than one."""
    entries = reps.select("rep", "n", F.explode("prefix").alias("shingle"))
    lengths = entries.groupBy("shingle").agg(F.count("*").alias("length")).where("length > 1")
    lengths = stage(lengths, "lengths")
    shared = reps.sparkSession.sparkContext.broadcast(bitmap_of(lengths, "shingle"))

    def probable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, batch.column(3).to_numpy()))).select(["rep", "n", "shingle"])

    some = entries.withColumn("bit", filter_bit("shingle")).mapInArrow(probable, "rep long, n long, shingle long")
    lists = stage(some.join(lengths, "shingle"), "lists")
    shared.destroy()
    return lists


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted arrays share; equal elements pair off one to one."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    if a.dtype.itemsize == 8:  # sets: an element occurs once on each side
        return int((both[1:] == both[:-1]).sum())
    values = np.concatenate([[True], both[1:] != both[:-1]])
    left = np.searchsorted(a, both[values], "right") - np.searchsorted(a, both[values], "left")
    right = np.searchsorted(b, both[values], "right") - np.searchsorted(b, both[values], "left")
    return int(np.minimum(left, right).sum())


def _similar(pairs: DataFrame, sets: DataFrame, bits: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    kind = f"<u{bits // 8}"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                left = np.frombuffer(a.as_buffer(), dtype=kind)
                right = np.frombuffer(b.as_buffer(), dtype=kind)
                shared = common_count(left, right)
                keep.append(100 * shared >= percent * (len(left) + len(right) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    of_a = sets.select(F.col("rep").alias("a"), F.col("values").alias("of_a"))
    of_b = sets.select(F.col("rep").alias("b"), F.col("values").alias("of_b"))
    joined = pairs.select("a", "b").join(of_a, "a").join(of_b, "b").select("a", "b", "of_a", "of_b")
    return stage(joined.mapInArrow(compare, "a long, b long").distinct(), "similar")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep"))


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs that are similar by their sets of 64-bit hashes.

    Truncated to 16 bits, sets share at least as much, so what fails there fails; that
    comparison moves a quarter of the bytes, and few other pairs pass it.
    """
    likely = _similar(pairs, kept_sets(docs, _ends(pairs), words, 16), 16, percent)
    return _similar(likely, kept_sets(docs, _ends(likely), words, 64), 64, percent)


def repeated_ids(found: DataFrame) -> DataFrame:
    """(doc_id, low): ids of several rows, and the smallest class representative among these."""
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("low"), F.count("*").alias("rows"))
    return ids.where("rows > 1").select("doc_id", "low")


def same_id_links(found: DataFrame, repeated: DataFrame) -> DataFrame:
    """Links between the classes that the rows of one id belong to."""
    classes = found.select("doc_id", "rep").distinct().join(repeated, "doc_id")
    return classes.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()


def _once(rows: DataFrame, repeated: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of repeated ids that agree in ``columns`` once; all other rows stay where they are."""
    ids = repeated.select("doc_id")
    several = rows.join(ids, "doc_id", "left_semi").dropDuplicates(columns)
    return rows.join(ids, "doc_id", "left_anti").unionByName(several)


def similar_in_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one of ``left``, one of ``right``) of similar sets; intersections are products of membership matrices."""
    sizes = np.array([len(s) for s in sets])
    exact = np.float32 if sizes.max(initial=0) < 1 << 24 else np.float64
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = held > 1
    columns = int(several.sum())
    place = np.cumsum(several) - 1
    keep = several[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(left), len(right)), exact)
    for first in range(0, columns, SLAB):
        low, high = np.searchsorted(column, [first, first + SLAB])
        holds = np.zeros((len(sets), min(SLAB, columns - first)), exact)
        holds[owner[low:high], column[low:high] - first] = 1
        shared += holds[left] @ holds[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    i, j = np.nonzero((100 * shared.astype(np.float64) >= percent * union) & (shared > 0))
    return left[i], right[j]


def spanning_star(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index reachable from each index along the pairs (a, b)."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        then = label.copy()
        np.minimum.at(then, a, low)
        np.minimum.at(then, b, low)
        np.minimum.at(then, label[a], low)
        np.minimum.at(then, label[b], low)
        then = then[then]
        if (then == label).all():
            return label
        label = then


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with the same (one, two), whole, of rows sorted by these."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (batch.column(at).to_numpy() for at in (0, 1))
        cuts = np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            block = (one[low], two[low])
            if held and block != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = block
    if held:
        yield pa.Table.from_batches(held)


def block_links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): a star for every connected part of each block of ``rows`` (one, two, chunk, rep, values).

    A block compares the chunks ``one`` and ``two``, or a chunk with itself. It has at
    most about CHUNK_SETS sets and CHUNK_ELEMENTS elements a side, a single larger set excepted, so no task holds a whole list.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_blocks(batches):
            sets = [np.frombuffer(v.as_buffer(), dtype="<u8") for v in block.column(4)]
            reps, chunk = block.column(3).to_numpy(), block.column(2).to_numpy()
            left = np.flatnonzero(chunk == block.column(0)[0].as_py())
            right = np.flatnonzero(chunk == block.column(1)[0].as_py())
            least = spanning_star(len(reps), *similar_in_block(sets, left, right, percent))
            linked = np.flatnonzero(least != np.arange(len(reps)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[least[linked]])], names=["a", "b"])

    blocks = rows.select("one", "two", "chunk", "rep", "values").repartition("one", "two").sortWithinPartitions("one", "two")
    return blocks.mapInArrow(compare, "a long, b long").where("a <> b").distinct()


def _dealt(members: DataFrame, keys: list[str], seed: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``members`` with a ``chunk``: those that agree in ``keys`` are dealt evenly over as many chunks as they need.

    ``members`` is read several times, so it should be written already; ``keep`` writes the sizes.
    """
    sizes = members.groupBy(*keys).agg(F.sum("n").alias("elements"), F.count("*").alias("rows"))
    parts = F.greatest(F.ceil(F.col("elements") / CHUNK_ELEMENTS), F.ceil(F.col("rows") / CHUNK_SETS))
    sizes = keep(sizes.select(*keys, "rows", parts.cast("long").alias("parts")), "sizes")
    dealt = attach_groups(members, sizes, keys, "rows", members.count())
    part = F.pmod(F.xxhash64("own", F.lit(seed)), F.col("parts"))
    return dealt.withColumn("chunk", F.xxhash64(*keys, part)).drop("rows", "parts")


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    found = rows.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    return found.withColumn("component", F.coalesce("component", "rep"))


def _open_lists(entries: DataFrame, members: DataFrame) -> DataFrame:
    """(shingle): lists with members of several components."""
    by_list = entries.join(members.select("rep", "component").distinct(), "rep").groupBy("shingle")
    return by_list.agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")


def long_list_links(docs: DataFrame, entries: DataFrame, links: DataFrame, words: int, percent: int) -> DataFrame:
    """Links that join all similar pairs which share one of the lists ``entries`` (rep, n, shingle, length).

    Members of the same longest list and of like size are dealt into bounded chunks, and a task
    compares all sets of a chunk. Dealings with other seeds follow while they
    join components. What is left are lists with members of several components: any two chunks
    that meet in one are compared whole, unless both hold one and the same component, or their sizes do not allow it. Members of large
    components are dealt apart from the rest, so this concerns few pairs of chunks.
    """
    with ExitStack() as stack:

        def keep(df: DataFrame, label: str) -> DataFrame:
            return stack.enter_context(staged(df, label))

        tops = keep(entries.groupBy("rep").agg(F.max(F.struct("length", "shingle")).alias("top")), "tops")
        sets = kept_sets(docs, tops, words, 64).withColumn("own", F.xxhash64("values"))
        sets = keep(sets.join(tops.select("rep", F.col("top.shingle").alias("list")), "rep"), "sets")
        n = (F.length("values") / 8).cast("long")
        members = sets.where(n > 0).select("rep", "own", n.alias("n"), "list", F.floor(F.log(n.cast("double")) / math.log(1.5)).alias("band"))
        members, sets = keep(members, "members"), sets.select("rep", "own", "values")
        count, merged, found = members.count(), 0, links
        open_members = members
        for seed in range(DEALINGS):
            chunks = _dealt(open_members, ["list", "band"], seed, keep)
            rows = chunks.join(sets, ["rep", "own"]).withColumn("one", F.col("chunk")).withColumn("two", F.col("chunk"))
            found = keep(found.unionByName(keep(block_links(rows, percent), "found")), "links")
            groups = components(found, keep)
            labelled = keep(_labelled(members, groups), "labelled")
            open_lists = keep(_open_lists(entries, labelled), "open")
            joined = labelled.where("component <> rep").count()
            if open_lists.isEmpty() or joined - merged <= HELPS * count:
                break
            merged = joined
            still = entries.join(open_lists, "shingle", "left_semi").select("rep").distinct()
            open_members = keep(members.join(still, "rep", "left_semi"), "still")

        sizes = labelled.groupBy("component").agg(F.count("*").alias("rows")).where(F.col("rows") > LARGE_COMPONENT)
        apart = attach_groups(labelled, keep(sizes, "sizes"), ["component"], "rows", count)
        # written, as each of the joins of _dealt would repeat the plan of this one
        apart = keep(apart.withColumn("large", F.when(F.col("rows").isNotNull(), F.col("component"))).drop("rows"), "apart")
        chunks = keep(_dealt(apart, ["list", "band", "large"], 0, keep).select("rep", "own", "n", "component", "chunk"), "chunks")
        still = entries.join(open_lists, "shingle", "left_semi").select("rep", "n", "shingle").join(chunks, ["rep", "n"])
        met = still.groupBy("shingle", "chunk").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")
        )
        met = keep(met, "met")
        one, two = met.alias("one"), met.alias("two")
        fit = "one.most * 100 >= two.least * {0} AND two.most * 100 >= one.least * {0}".format(percent)
        blocks = one.join(two, F.col("one.shingle") == F.col("two.shingle")).where(
            f"one.chunk <= two.chunk AND least(one.low, two.low) < greatest(one.high, two.high) AND {fit}"
        )
        blocks = keep(blocks.select(F.col("one.chunk").alias("one"), F.col("two.chunk").alias("two")).distinct(), "blocks")
        sides = blocks.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("chunk"))
        rows = sides.join(chunks.select("rep", "own", "chunk"), "chunk").join(sets, ["rep", "own"])
        return stage(found.unionByName(block_links(rows, percent)), "links")


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Two documents link when 100 |intersection| >= ``percent`` |union| of their shingle sets;
    ``component_id`` is the smallest doc_id reachable by links, itself included. All links
    between different sets are respected; equal sets form a class first, and are not compared.

    Size-aware: sets up to a boundary are joined among themselves by the subsets that they
    must share, which are enumerated; where a larger set is concerned, the inverted lists
    of prefix elements are scanned. The boundary is where the one costs more than the other,
    by the list lengths measured. The common order has rare shingles first, and by hash.
    A pair in several lists is compared once, if it shares at least SHARED prefix elements.

    A list of more than LONG_LIST members is not expanded into pairs: its members' sets are compared
    inside tasks, chunk by chunk, and only stars of connected parts come out (``long_list_links``).
    A pair that shares no such list shares SHARED of the short ones.

    Null and empty texts, or texts without words, have size 0 and link with nothing. Rows with
    the same doc_id are one document: linked, whatever their texts, and linked to all that one of them is like. A null doc_id has the component of the copies it
    has, and null if it has none. An empty table gives no rows; other columns are ignored.
    """
    common = common_shingles(docs, words)
    # what still makes long lists comes last as well
    common = np.union1d(common, in_long_lists(docs, words, percent, common))
    rows = stage(profiles(docs, words, percent, common), "profiles")
    sig = ["n", "sig_a", "sig_b"]
    classes = rows.where("n > 0").groupBy(*sig).agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    classes = stage(classes, "classes")
    total = rows.count()
    found = attach_groups(rows.select("doc_id", *sig), classes.where("rows > 1"), sig, "rows", total)
    found = stage(found.select("doc_id", *sig, F.coalesce("rep", "doc_id").alias("rep")), "members")
    repeated = stage(repeated_ids(found), "repeated")

    # the row that stands for its class; a class of one stands for itself
    not_first = found.where("rep <> doc_id").select("doc_id", *sig)
    reps = rows.where("n > 0 AND doc_id IS NOT NULL").join(not_first, ["doc_id", *sig], "left_anti")
    if not repeated.isEmpty():
        reps = _once(reps, repeated, ["doc_id", *sig])
        docs = _once(docs.select(F.col("doc_id").cast("long"), "text"), repeated, ["doc_id", "text"])
    with staged(reps.withColumnRenamed("doc_id", "rep").select("rep", "n", "prefix", "whole"), "reps") as reps:
        entries = prefix_entries(reps)
        # a document with fewer common elements has no partner
        able = entries.groupBy("rep").agg(F.count("*").alias("lists"), F.min("n").alias("n"))
        able = stage(able.where(F.col("lists") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100))), "able")
        entries = stage(entries.join(able.select("rep"), "rep", "left_semi"), "lists")
        scanned = entries.agg(F.sum("length"), F.count("*")).first()
        boundary = size_boundary(percent, (scanned[0] or 0) / max(1, scanned[1]))

        links = _small_links(reps, percent, boundary)
        links = stage(links.unionByName(same_id_links(found, repeated)), "links")
    lengths = entries.groupBy("shingle").agg(F.count("*").alias("length")).where("length > 1")
    lists = attach_groups(entries.drop("length"), lengths, ["shingle"], "length", scanned[1])
    lists = stage(lists.where("length IS NOT NULL"), "lists")
    links = long_list_links(docs, lists.where(F.col("length") > LONG_LIST), links, words, percent)

    short = lists.where(F.col("length") <= LONG_LIST)
    one, two = short.alias("one"), short.alias("two")
    pairs = one.join(two, F.col("one.shingle") == F.col("two.shingle")).where(
        (F.col("one.rep") < F.col("two.rep")) & (F.greatest("one.n", "two.n") > boundary) & _sizes_fit("one.n", "two.n", percent)
    )
    pairs = pairs.groupBy(F.col("one.rep").alias("a"), F.col("two.rep").alias("b")).agg(
        F.count("*").alias("lists"), F.min("one.n").alias("n_a"), F.min("two.n").alias("n_b")
    )
    least = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    pairs = stage(pairs.where(F.col("lists") >= F.least(F.lit(SHARED), least)).select("a", "b"), "pairs")
    links = links.unionByName(verified(docs, pairs, words, percent))
    groups = components(links).withColumnRenamed("node", "rep")
    return found.join(groups, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )


def _sizes_fit(a: str, b: str, percent: int):
    """Sizes that allow the similarity: the smaller set inside the larger one."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def keep_representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the smallest doc_id, with its columns as they were.

    Rows with a null doc_id stay; rows that share a doc_id stay together.
    """
    found = jaccard_components(docs, words, percent)
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__id"], "left_anti")
