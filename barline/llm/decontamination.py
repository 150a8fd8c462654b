"""Benchmark decontamination: size-partitioned MinHash containment search.

A long document has little in common with a short item by Jaccard similarity, so
documents are partitioned by the size of their shingle sets and signed accordingly:
a document of n shingles gets about n / load MinHash bins, each of which keeps its
smallest hash. An item's hashes are looked up in the bins. The load follows from
the smallest overlap that any item needs, so that a contained item is missed with
a probability of at most ``miss``. Every pair that is found is verified: the
item's exact shingles, the document's exact shingles. All of it is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barline.functions.once import with_computed
from barline.llm.common import BLANKS, free_name, join_few, row_key
from barline.sources.tables import stage


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    miss: float = 1e-9,
) -> DataFrame:
    """Pairs of a document and an item whose shingles it contains to ``percent`` or more.

    Returns ``doc_id``, ``item_id``, ``n_shared``, ``n_item`` (distinct shingles) and
    ``containment``. Texts are lower-cased and split at blanks; a text with fewer
    than ``words`` words is one shingle, an empty or NULL one has none and is in no
    pair. A document may pair with many items. Repeated rows, and rows with NULL or
    repeated ids, each have their pairs. Empty tables give no rows. Columns besides
    those named are not read.
    """
    return _pairs(_rows(docs, id_col, text_col), _items(items, item_col, item_text_col, words), words, percent, miss).drop("key")


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, without the rows that contain an item."""
    key = free_name(docs, "_leak_key")
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    rows = _rows(docs, id_col, text_col)
    words, percent, miss = (options.pop(k, v) for k, v in (("words", 5), ("percent", 80), ("miss", 1e-9)))
    columns = {"item_col": "item_id", "text_col": "text"} | {k.replace("item_text", "text"): v for k, v in options.items()}
    pairs = _pairs(rows, _items(items, columns["item_col"], columns["text_col"], words), words, percent, miss)
    leaks = stage(pairs.select(F.col("key").alias(key)).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").drop(key)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key")
    )


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS), "")


def _shingles(of: str, words: int, join) -> Column:
    """``join`` of each run of ``words`` in the array column ``of``; of all words if there are fewer."""
    w = F.col(of)
    starts = F.sequence(F.lit(0), F.size(w) - words)
    runs = F.transform(starts, lambda i: join([F.get(w, i + j) for j in range(words)]))
    return (
        F.when(F.size(w) >= words, runs)
        .when(F.size(w) > 0, F.array(join([F.get(w, F.lit(j)) for j in range(words)])))
        .otherwise(F.array().cast(runs_type(join)))
    )


def runs_type(join) -> str:
    return "array<bigint>" if join is _hashed else "array<string>"


def _hashed(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _joined(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def _items(items: DataFrame, item_col: str, text_col: str, words: int) -> DataFrame:
    """Each item once per row: ``nth``, ``item_id``, its distinct ``shingles`` and their ``hashes``."""
    split = with_computed(items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")), {"w": _split(F.col("text"))})
    both = split.filter(F.size("w") > 0).select(
        F.monotonically_increasing_id().alias("nth"), "item_id",
        F.array_distinct(_shingles("w", words, _joined)).alias("shingles"),
        F.array_distinct(_shingles("w", words, _hashed)).alias("hashes"),
    )
    return stage(both, "benchmark-items")


def _pairs(rows: DataFrame, items: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    least = items.select(F.min(F.ceil(F.size("shingles") * F.lit(percent) / 100))).first()[0] or 1
    # A bin keeps a given one of its hashes with a probability of about 1 - load / 2.
    load = min(1.0, 2 * miss ** (1 / least))
    split = with_computed(rows, {"w": _split(F.col("text"))}).select("key", "w")
    hashed = with_computed(split, {"h": F.sort_array(F.array_distinct(_shingles("w", words, _hashed)))}).select("key", "h")
    # The size partition: documents of up to 2^p shingles have 2^(p + extra) bins, named by a hash's first bits.
    bits = F.least(F.lit(63), F.ceil(F.log2(F.greatest(F.size("h"), F.lit(1)) / F.lit(load)))).cast("int")
    sized = hashed.filter(F.size("h") >= least).withColumn("shift", F.lit(64) - bits)
    signature = F.expr("filter(h, (x, i) -> i = 0 or shiftright(x, shift) <> shiftright(get(h, i - 1), shift))")
    signed = sized.select("key", F.size("h").alias("n"), F.explode(signature).alias("hash"))
    probes = stage(
        items.select("nth", F.ceil(F.size("shingles") * F.lit(percent) / 100).alias("least"), F.explode("hashes").alias("hash")),
        "benchmark-probes",
    )
    met = join_few(signed, probes, "hash").filter("n >= least").select("key", "nth").distinct()
    candidates = stage(met, "leak-candidates")
    texts = with_computed(join_few(rows, candidates.select("key").distinct(), "key", "left_semi"), {"w": _split(F.col("text"))})
    documents = with_computed(texts.select("key", "doc_id", "w"), {"own": _shingles("w", words, _joined)}).select("key", "doc_id", "own")
    checked = documents.join(candidates, "key").join(items.select("nth", "item_id", "shingles"), "nth")
    counted = with_computed(
        checked, {"n_shared": F.size(F.array_intersect("shingles", "own")).cast("long")}
    ).withColumn("n_item", F.size("shingles").cast("long"))
    return counted.filter(F.col("n_shared") * 100 >= F.col("n_item") * percent).select(
        "key", "doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )
