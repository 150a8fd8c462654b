"""The Merkle manifest against trees built in plain Python."""

import hashlib

from pyspark.sql import functions as F

from barline.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, i):
    path = []
    for level in tree[:-1]:
        start = i // 3 * 3
        path.append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
        i //= 3
    return path


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, path) of (doc_id, text, lang, source, n_chars, ...) rows."""
    groups = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = digest("".join(map(told, (doc_id, source, lang, n_chars, text))))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([leaf for *_, leaf in sorted(groups[s])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (name, tree) in enumerate(zip(names, trees)):
        for i, (known, doc_id, leaf) in enumerate(sorted(groups[name])):
            out.append((doc_id if known else None, leaf, tree[-1][0], top[-1][0], way(tree, i) + way(top, k)))
    return sorted(out, key=str)


def found(frame):
    rows = frame.select("doc_id", "leaf", "subroot", "root", "path").collect()
    return sorted(((*r[:4], [tuple(p) for p in r.path]) for r in rows), key=str)


def test_odd_rows(odd):
    assert found(merkle.manifest(odd)) == brute(odd.collect())


def test_tiers_of_small_blocks(spark):
    """Blocks of three rows make three tiers; a third of the rows repeat one another."""
    rows = [(i if i % 3 else 7, f"text {i if i % 3 else 0}", "en", "hot" if i % 4 else f"s{i % 7}", 1) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(merkle.manifest(docs, levels=1)) == brute(rows)
    assert found(merkle.manifest(docs, levels=2)) == brute(rows)


def test_lone_row_and_empty_table(spark, none):
    one = spark.createDataFrame([(3, "only", None, None, 4)], none.schema)
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert merkle.manifest(none).count() == 0


def test_proofs_tell_changed_rows(odd):
    changed = {"text": F.replace("text", F.lit("one"), F.lit("two"))}
    rows = merkle.manifest(odd, changed=changed)
    root = rows.withColumn("now", merkle.folded(F.col("found"), F.col("path"))).select("doc_id", (F.col("now") == F.col("root")).alias("ok"))
    assert [r.doc_id for r in root.filter("not ok").collect()] == [7]
