"""N-gram Jaccard self-join by T-occurrence search.

Two shingle sets are similar when enough shingles of one occur in the other. That
is a T-occurrence problem: of a set's inverted lists, find what occurs on at least
T. DivideSkip merges the short lists and probes the long ones.

To bring only texts together that can be similar, each set's rarest shingles (its
prefix) are compared first: similar sets share a shingle of their prefixes under
any one order of all shingles. Counting every shingle would move them all. So a
set first shows its window, its shingles of smallest hash, somewhat more than a
prefix; a set with a prefix of shingles that no other window has can only be similar
to a set without, and what is left are few. Of those all shingles are counted, and
the prefixes in order of frequency give clusters, within which the search runs.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from barline.llm.common import free_name, join_few, row_key, text_bytes
from barline.llm.components import components
from barline.sources.tables import discard, stage

#: Odd constants that mix the word hashes of a shingle.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

#: Sets that one task of the search holds at once.
BLOCK = 1024


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Hashes of the distinct shingles in ascending order; a text with fewer words is one shingle."""
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in text.lower().split()], np.uint64)
    if len(hashes) == 0:
        return hashes
    n = max(1, len(hashes) - words + 1)
    mixed = np.full(n, min(words, len(hashes)), np.uint64)
    for j in range(min(words, len(hashes))):
        mixed = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(MIX[j % 3]) + hashes[j : j + n]) * np.uint64(MIX[0])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(MIX[1])
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def needed(n: int, percent: int) -> int:
    """Smallest overlap a set of ``n`` has with any similar set."""
    return -(-percent * n // 100)


def jaccard_join(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    slack: float = 1.5,
    block: int = BLOCK,
) -> DataFrame:
    """The class of each document: ``doc_id``, ``n_shingles``, ``component_id``, ``class_key``, ``row_key``.

    Documents link when 100 times the common shingles are at least ``percent`` times
    all their shingles; ``component_id`` is the smallest id that links reach. A text
    with fewer than ``words`` words is one shingle. NULL, empty and blank texts have
    no shingles and link with nothing, each other included: their ``component_id`` is
    their own id. Rows with equal sets link, repeated rows and ids too. A NULL id never
    is the smallest unless all are NULL. An empty table gives no rows. Columns
    besides the two named are not read. ``class_key`` names the class even where ids
    repeat (NULL without shingles), ``row_key`` is a hash of id and text. ``slack`` sizes the windows and ``block`` the
    search's tasks; neither changes the result.

    Shingles are compared by 64-bit hashes.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn(
        "row_key", row_key("id", "text")
    )
    windows = stage(_windows(named, words, percent, slack), "jaccard-windows")
    sets = stage(_distinct_sets(windows), "jaccard-sets")
    rows = stage(windows.select("id", "n", "set_key", "row_key"), "jaccard-rows")
    discard(windows)
    members = _members(named, sets, words, percent, slack)
    clusters = components(_lists(_prefixes(members, percent), percent))
    links = _search(members, clusters, percent, block)
    return _classes(rows, sets, components(links))


def _windows(named: DataFrame, words: int, percent: int, slack: float) -> DataFrame:
    """Per row its set's size, digest and window."""

    def shingle(batches):
        for b in batches:
            sizes, keys, windows = [], [], []
            for text in text_bytes(b, "text"):
                found = shingle_set(text, words)
                n = len(found)
                prefix = n - needed(n, percent) + 1 if n else 0
                sizes.append(n)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                windows.append(found[: math.ceil(slack * prefix)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("row_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(windows, pa.binary())],
                ["id", "row_key", "n", "set_key", "window"],
            )

    return named.mapInArrow(shingle, "id long, row_key long, n long, set_key binary, window binary")


def _distinct_sets(windows: DataFrame) -> DataFrame:
    """Each set once, numbered. What is numbered is written, so the numbers stay."""
    once = windows.filter("n > 0").groupBy("set_key").agg(
        F.min("n").alias("n"), F.min("id").alias("id"), F.min("row_key").alias("row_key"), F.first("window").alias("window")
    )
    return once.withColumn("node", F.monotonically_increasing_id())


def _unpacked(packed: DataFrame) -> DataFrame:
    """``node``, ``n`` and packed ``shingles`` as a row per shingle."""

    def unpack(batches):
        for b in batches:
            found = [np.frombuffer(w, np.int64) for w in b.column("shingles").to_pylist()]
            times = [len(f) for f in found]
            nodes, sizes = (np.repeat(b.column(c).to_numpy(), times) for c in ("node", "n"))
            shingles = np.concatenate([np.array([], np.int64), *found])
            for at in range(0, len(shingles), 1 << 20):
                part = [pa.array(x[at : at + (1 << 20)]) for x in (nodes, sizes, shingles)]
                yield pa.RecordBatch.from_arrays(part, ["node", "n", "shingle"])

    return packed.mapInArrow(unpack, "node long, n long, shingle long")


def _whole_sets(named: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """``node``, ``n`` and the packed ``shingles`` of ``chosen`` sets, read from a text of each."""

    def shingle(batches):
        for b in batches:
            nodes, sizes, packed = [], [], []
            keys = zip(b.column("node").to_pylist(), b.column("n").to_pylist(), b.column("set_key").to_pylist())
            for (node, n, key), text in zip(keys, text_bytes(b, "text")):
                found = shingle_set(text, words).tobytes()
                if hashlib.blake2b(found, digest_size=16).digest() == key:  # else another row has this row's key
                    nodes.append(node), sizes.append(n), packed.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], ["node", "n", "shingles"]
            )

    texts = join_few(named.select("row_key", "text"), chosen.select("row_key", "node", "n", "set_key"), "row_key")
    return texts.dropDuplicates(["node"]).mapInArrow(shingle, "node long, n long, shingles binary")


def _members(named: DataFrame, sets: DataFrame, words: int, percent: int, slack: float) -> DataFrame:
    """``node``, ``n`` and packed ``shingles`` of all sets that can be similar to another.

    Two sets whose windows each hold a prefix of shingles of their own are not similar.
    So of two similar sets one is poor in such shingles. All but a prefix (less one) of
    the other's window is in the poor set too, and there among the ``wide`` smallest.
    """
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1
    held = F.octet_length("window") / 8
    window = _unpacked(sets.select("node", "n", F.col("window").alias("shingles"))).select("node", "shingle")
    common = stage(window.groupBy("shingle").agg(F.count("*").alias("windows")).filter("windows > 1").drop("windows"), "jaccard-common")
    shared = window.join(common, "shingle").groupBy("node").agg(F.count("*").alias("shared"))
    poor = stage(sets.join(shared, "node").filter(held - F.col("shared") < prefix).select("row_key", "set_key", "node", "n"), "jaccard-poor")
    poor_sets = stage(_whole_sets(named, poor, words), "jaccard-poor-sets")
    largest = F.floor(F.col("n") * F.lit(100) / F.lit(percent))
    wide = F.ceil(F.lit(slack) * (largest - F.ceil(largest * F.lit(percent) / F.lit(100)) + 1)) + prefix - 1
    smallest = poor_sets.withColumn("wide", (8 * wide).cast("int")).selectExpr("node", "n", "substring(shingles, 1, wide) as shingles")
    met = window.join(_unpacked(smallest).select("shingle").distinct(), "shingle", "left_semi")
    met = met.join(poor.select("node"), "node", "left_anti").groupBy("node").agg(F.count("*").alias("met"))
    touched = sets.join(met, "node").filter(F.col("met") > held - prefix).select("row_key", "set_key", "node", "n")
    others = _whole_sets(named, stage(touched, "jaccard-touched"), words)
    return poor_sets.union(stage(others, "jaccard-other-sets"))


def _prefixes(members: DataFrame, percent: int) -> DataFrame:
    """``node``, ``n``, ``shingle``: what of the members' prefixes is on a list of two or more.

    The order is that of frequency among the members, ties by hash. Shingles of one
    member come first and are on no list, so only the others are ranked.
    """
    every = _unpacked(members)
    common = stage(every.groupBy("shingle").agg(F.count("*").alias("times")).filter("times > 1"), "jaccard-frequencies")
    own = Window.partitionBy("node")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1
    ranked = every.join(common, "shingle").withColumn("rank", F.row_number().over(own.orderBy("times", "shingle")))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("n") - F.count("*").over(own))
    return stage(ranked.filter(F.col("rank") <= prefix).select("node", "n", "shingle"), "jaccard-prefixes")


def _lists(prefixes: DataFrame, percent: int) -> DataFrame:
    """Links from the sets on a list to its first. A list holds sets of one shingle and two neighbouring size
    bands, since similar sets are at most one band apart. A list is never gathered."""
    band = F.floor(F.log("n") / (math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0)).cast("int")
    entries = prefixes.select("node", "shingle", F.explode(F.array(band, band + 1)).alias("band"))
    first = entries.groupBy("shingle", "band").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    return entries.join(first, ["shingle", "band"]).select(F.col("node").alias("a"), F.col("first").alias("b")).filter("a <> b").distinct()


def _search(members: DataFrame, clusters: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (``a``, ``b``) that connect all sets of a cluster that similarity connects.

    A cluster of more than ``block`` sets is dealt out to blocks, and each pair of
    blocks is searched by itself.
    """
    placed = clusters.join(members.select("node", "n"), "node")
    size = placed.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("n") / F.lit(block * 1500))).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = placed.select("node", "root").join(size, "root").withColumn("own", own)
    paired = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "node", "root", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    whole = members.join(paired, "node")

    def search(batches):
        at, held = None, ([], [], [])
        for b in batches:
            links = []
            keys = zip(*(b.column(c).to_pylist() for c in ("root", "low", "high")))
            # The shingles stay in the batch, as buffers: a copy of each would double it.
            for key, node, own, packed in zip(keys, *(b.column(c).to_pylist() for c in ("node", "own")), b.column("shingles")):
                if key != at:
                    links.extend(_linked(at, *held, percent))
                    at, held = key, ([], [], [])
                held[0].append(node), held[1].append(own), held[2].append(np.frombuffer(packed.as_buffer(), np.uint64))
            if links:
                yield _link_batch(links)
        if links := _linked(at, *held, percent):
            yield _link_batch(links)

    dealt_out = whole.select("root", "low", "high", "node", "own", "shingles").repartition("root", "low", "high")
    return dealt_out.sortWithinPartitions("root", "low", "high").mapInArrow(search, "a long, b long")


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _linked(key, nodes: list[int], blocks: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of one block's (or, between two blocks, their crossing) links."""
    if key is None or len(nodes) < 2:
        return []
    side = None if key[1] == key[2] else np.array(blocks)
    return [(nodes[i], nodes[j]) for i, j in t_occurrence(sets, percent, side)]


def t_occurrence(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Positions of similar sets, as many pairs as it takes to connect all that similarity connects.

    Sets are queries in order of size, each against those before it, so the overlap
    to reach is ``needed`` of the query. The longest lists, as many as DivideSkip's
    rule gives, are set aside; the others are merged on a heap. What can still reach
    the overlap is probed by binary search in the long lists. Sets that are already
    connected with the query are passed over. ``side`` restricts pairs to those of
    different sides.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order])
    shingles, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    holder = np.repeat(np.arange(len(order)), sizes)
    entries = array("i", holder[np.argsort(ids, kind="stable")].astype(np.intc).tobytes())  # of list after list, each in order of size
    lengths = np.bincount(ids, minlength=len(shingles))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    group, sides = np.arange(len(order)), None if side is None else side[order]

    found = []
    for q in range(1, len(order)):
        least = needed(int(sizes[q]), percent)
        low = int(np.searchsorted(sizes, least))
        if low >= q:
            continue
        own = ids[offsets[q] : offsets[q + 1]]
        own = own[np.argsort(lengths[own], kind="stable")]
        longest = int(lengths[own[-1]])
        n_long = min(len(own) - 1, least - 1, int(least / (0.0085 * math.log2(max(2, longest)) + 1)))
        short, long = own[: len(own) - n_long], np.sort(own[len(own) - n_long :])
        merge = ListMerge(entries, zip(starts[short].tolist(), starts[short + 1].tolist()), low, q)
        wanted = np.arange(low, q) if sides is None else low + np.flatnonzero(sides[low:q] != sides[q])
        left = wanted.tolist()
        while left and (hit := merge.next(least - n_long, left)):
            c, count = hit
            theirs = ids[offsets[c] : offsets[c + 1]]
            at = np.searchsorted(theirs, long)
            at[at == len(theirs)] = 0
            both = count + int((theirs[at] == long).sum())
            if 100 * both >= percent * (int(sizes[q]) + int(sizes[c]) - both):
                group[group == group[c]] = group[q]
                wanted = wanted[group[wanted] != group[q]]
                left = wanted.tolist()
                found.append((int(order[q]), int(order[c])))
    return found


class ListMerge:
    """Sorted lists, stretches of ``entries``, merged on a heap from ``low`` up to ``end`` (exclusive)."""

    def __init__(self, entries: Sequence[int], stretches: Iterable[tuple[int, int]], low: int, end: int) -> None:
        self.entries, self.heap = entries, []  # heap: (entry, its place, where its list ends)
        for first, last in stretches:
            self._enter(low, first, bisect_left(entries, end, first, last))

    def _enter(self, entry: int, place: int, last: int) -> None:
        """A list joins the heap from its first ``entry`` or larger on."""
        place = bisect_left(self.entries, entry, place, last)
        if place < last:
            heappush(self.heap, (self.entries[place], place, last))

    def next(self, least: int, left: list[int]) -> tuple[int, int] | None:
        """The next of ``left`` (ascending) that is on ``least`` lists, and on how many; None after the last.

        Of the entries before the one that ``least`` minus one lists are behind, none
        is on enough lists, so these lists skip ahead to it.
        """
        heap = self.heap
        while len(heap) >= least:
            at = bisect_left(left, heap[0][0])
            if at == len(left):
                return None
            entry = left[at]
            while heap and heap[0][0] < entry:
                _, place, last = heappop(heap)
                self._enter(entry, place, last)
            taken = []
            while heap and heap[0][0] == entry:
                taken.append(heappop(heap))
            if (count := len(taken)) >= least:
                ahead = entry + 1
            else:
                while heap and len(taken) < least - 1:
                    taken.append(heappop(heap))
                if not heap:
                    return None
                ahead = max(entry + 1, heap[0][0])
            for _, place, last in taken:
                self._enter(ahead, place, last)
            if count >= least:
                return entry, count
        return None


def _classes(rows: DataFrame, sets: DataFrame, reached: DataFrame) -> DataFrame:
    linked = sets.select("node", "id", "set_key").join(reached, "node")
    smallest = linked.groupBy("root").agg(F.min("id").alias("smallest"), F.min("set_key").alias("first_key"))
    named = linked.join(smallest, "root").select("node", "smallest", "first_key")
    classes = sets.select("set_key", "node", "id").join(named, "node", "left").select(
        "set_key", F.coalesce("smallest", "id").alias("component_id"), F.coalesce("first_key", "set_key").alias("class_key")
    )
    return rows.join(classes, "set_key", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "class_key", "row_key",
    )


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, with the row of smallest id of each class, or one of those that repeat it.

    Rows without shingles stay; of rows that repeat both id and text one stays.
    """
    classes = stage(jaccard_join(docs, id_col=id_col, text_col=text_col, **options), "jaccard-classes")
    key = free_name(docs, "_key")
    alone = classes.filter("class_key is null").select(F.col("row_key").alias(key))
    first = classes.filter("class_key is not null").groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    stay = alone.union(first.select(F.col("first.row_key").alias(key)))
    keyed = docs.withColumn(key, row_key(F.col(id_col).cast("long"), text_col))
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).drop(key)
