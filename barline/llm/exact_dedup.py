"""Exact dedup by owners in Patricia tries.

Texts are dealt by length and content hash, and inserted whole into compressed
radix tries; a terminal node holds the best identifier of its text and how many
rows had it. Tries are built twice: once where the rows are read, so that a text
leaves a task once however many copies it has there, and once after the shuffle,
where what is left of each text meets. A trie above its memory bound hands its
largest subtree on and forgets it, so nothing is spilled to a local disk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from barline.llm.common import free_name, row_key, text_bytes
from barline.sources.tables import stage

#: Bytes of text that a task's tries hold before the largest is handed on.
TRIE_BYTES = 48 << 20
SUBTREES = 256


class Trie:
    """A compressed radix trie: each edge carries a byte string, branches differ in its first byte."""

    def __init__(self) -> None:
        self.root: list = [{}, None]  # node: edges by first byte, (best id, rows) of the text that ends here
        self.bytes = 0

    def add(self, text: bytes, best: int | None, rows: int, better) -> None:
        node, at = self.root, 0
        while at < len(text):
            edge = node[0].get(text[at])
            if edge is None:
                edge = node[0][text[at]] = [text[at:], [{}, None]]
                self.bytes += len(text) - at
            elif not text.startswith(edge[0], at):
                shared = _shared(edge[0], text, at)
                lower = [edge[0][shared:], edge[1]]
                edge[0], edge[1] = edge[0][:shared], [{lower[0][0]: lower}, None]
            at += len(edge[0])
            node = edge[1]
        if node[1] is None:
            node[1] = (best, rows)
        else:
            node[1] = (better(node[1][0], best), node[1][1] + rows)

    def owners(self) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(b"", self.root)]
        while stack:
            text, node = stack.pop()
            if node[1] is not None:
                yield (text, *node[1])
            for label, child in node[0].values():
                stack.append((text + label, child))


def _shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the longest common prefix of ``label`` and ``text`` from ``at``, found by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if text.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


def _larger(a, b):
    return b if a is None or b is not None and b > a else a


def _smaller(a, b):
    return b if a is None or b is not None and b < a else a


def owners(docs: DataFrame, *, id_col: str, text_col: str, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: ``text_sha256``, ``keep_id``, ``group_size``."""
    better = _larger if keep == "largest" else _smaller

    def local(batches):
        tries: dict[int, Trie] = {}
        held = 0
        for b in batches:
            out = []
            for best, raw in zip(b.column("id").to_pylist(), text_bytes(b, "text")):
                text = raw.lower()
                part = (len(text) * 31 + xxhash.xxh3_64_intdigest(text)) % SUBTREES
                trie = tries.setdefault(part, Trie())
                held -= trie.bytes
                trie.add(text, best, 1, better)
                held += trie.bytes
                while held > trie_bytes:
                    largest = max(tries, key=lambda p: tries[p].bytes)
                    held -= tries[largest].bytes
                    out.extend(tries.pop(largest).owners())
            if out:
                yield _owner_batch(out)
        for trie in tries.values():
            if found := list(trie.owners()):
                yield _owner_batch(found)

    def merged(batches):
        at, trie = None, Trie()
        for b in batches:
            out = []
            keys = zip(b.column("length").to_pylist(), b.column("hash").to_pylist())
            for key, best, rows, text in zip(keys, b.column("id").to_pylist(), b.column("rows").to_pylist(), text_bytes(b, "text")):
                if key != at:
                    out.extend(trie.owners())
                    at, trie = key, Trie()
                trie.add(text, best, rows, better)
            if out:
                yield _final_batch(out)
        if out := list(trie.owners()):
            yield _final_batch(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    partial = rows.mapInArrow(local, "length long, hash long, text binary, id long, rows long")
    dealt = partial.repartition("length", "hash").sortWithinPartitions("length", "hash")
    return dealt.mapInArrow(merged, "text_sha256 string, keep_id long, group_size long")


def _owner_batch(found: list[tuple[bytes, int | None, int]]) -> pa.RecordBatch:
    texts, ids, rows = zip(*found)
    hashes = [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(t) for t in texts], pa.int64()), pa.array(hashes, pa.int64()), pa.array(texts, pa.binary()),
         pa.array(ids, pa.int64()), pa.array(rows, pa.int64())],
        ["length", "hash", "text", "id", "rows"],
    )


def _final_batch(found: list[tuple[bytes, int | None, int]]) -> pa.RecordBatch:
    texts, ids, rows = zip(*found)
    digests = [hashlib.sha256(t).hexdigest() for t in texts]
    return pa.RecordBatch.from_arrays(
        [pa.array(digests, pa.string()), pa.array(ids, pa.int64()), pa.array(rows, pa.int64())],
        ["text_sha256", "keep_id", "group_size"],
    )


def digests(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text_sha256`` of each row's normalised text."""

    def digest(batches):
        for b in batches:
            hexes = [hashlib.sha256(t.lower()).hexdigest() for t in text_bytes(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(hexes, pa.string())], ["doc_id", "text_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(digest, "doc_id long, text_sha256 string")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The verdict on every row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. Of
    equal texts the row with the largest (or smallest) id stays. A NULL id loses
    against any other; where all are NULL, ``keep_id`` is NULL and one row stays. Of
    rows that repeat both id and text one stays. An empty table gives no rows.
    Columns besides the two named are not read.
    """
    counted = digests(docs, id_col=id_col, text_col=text_col).groupBy("doc_id", "text_sha256").agg(F.count("*").alias("times"))
    found = owners(docs, id_col=id_col, text_col=text_col, keep=keep)
    return (
        counted.join(found, "text_sha256")
        .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs``, all columns, with one row of each group of equal texts; which one as in ``exact_dedup``."""
    found = stage(owners(docs, id_col=id_col, text_col=text_col, keep=keep), "text-owners")
    sha, key = free_name(docs, "_sha"), free_name(docs, "_key")
    names, place = docs.columns, T.StructType([*docs.schema.fields, T.StructField(sha, T.StringType())])

    def digest(batches):
        for b in batches:
            hexes = [hashlib.sha256(t.lower()).hexdigest() for t in text_bytes(b, text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hexes, pa.string())], [*names, sha])

    rows = docs.mapInArrow(digest, place).withColumn(key, row_key(F.col(id_col).cast("long"), sha))
    stay = found.select(row_key("keep_id", "text_sha256").alias(key), F.col("text_sha256").alias(sha))
    # Only rows that repeat both id and text are still more than one.
    return rows.join(stay, [key, sha], "left_semi").dropDuplicates([key, sha]).drop(key, sha)
