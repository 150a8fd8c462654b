import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from barline.llm.components import components
from barline.llm.jaccard_join import ListMerge, drop_near_copies, jaccard_join, t_occurrence


def roots(n, links):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return [top(i) for i in range(n)]


def similar(a, b, percent):
    both = len(a & b)
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows, words, percent):
    sets = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    fits = lambda a, b: min(len(a), len(b)) * 100 >= percent * max(len(a), len(b))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if fits(sets[i], sets[j]) and similar(sets[i], sets[j], percent)]
    of = roots(len(sets), links)
    least = {}
    for r, root in zip(rows, of):
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    return sorted(((r.doc_id, len(s), least.get(root)) for r, s, root in zip(rows, sets, of)), key=str), of


@settings(deadline=None, max_examples=100)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=12), min_size=2, max_size=12), st.integers(50, 95), st.booleans())
def test_t_occurrence_connects_what_similarity_connects(sets, percent, crossing):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    side = np.arange(len(sets)) % 2 if crossing else None
    found = t_occurrence(arrays, percent, side)
    every = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if similar(sets[i], sets[j], percent) and (side is None or side[i] != side[j])
    ]
    assert roots(len(sets), found) == roots(len(sets), every)
    assert all((max(p), min(p)) in every for p in found)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=8), st.integers(1, 4), st.sets(st.integers(0, 30), min_size=1))
def test_a_merge_finds_what_is_on_enough_lists(lists, least, wanted):
    entries, stretches = [], []
    for held in lists:
        stretches.append((len(entries), len(entries) + len(held)))
        entries.extend(sorted(held))
    merge, found, left = ListMerge(entries, stretches, 3, 25), [], sorted(wanted)
    while hit := merge.next(least, left):
        found.append(hit)
    times = {i: sum(i in held for held in lists) for i in left if 3 <= i < 25}
    assert found == [(i, n) for i, n in times.items() if n >= least]


@pytest.mark.parametrize("words,percent,slack,block", [(3, 90, 2.0, 1024), (5, 80, 1.5, 3), (3, 60, 1.0, 2)])
def test_classes_are_those_of_all_pairs(spark, sf, words, percent, slack, block):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    near = docs.selectExpr("doc_id + 1000 as doc_id", "concat(text, ' zz zy') as text").limit(40)
    docs = docs.select("doc_id", "text").union(near).cache()
    got = jaccard_join(docs, words=words, percent=percent, slack=slack, block=block).collect()
    expected, of = brute(docs.collect(), words, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected
    assert drop_near_copies(docs, words=words, percent=percent, slack=slack).count() == len(set(of))


def test_odd_rows(odd, none):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(odd).collect()), key=str)
    assert got == brute(odd.select("doc_id", "text").collect(), 5, 80)[0]
    # Of 13 rows four are one text, two link, and four have no words.
    stay = drop_near_copies(odd)
    assert stay.columns == odd.columns and stay.count() == 9
    assert jaccard_join(none).count() == 0 and drop_near_copies(none).count() == 0


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (6, 5), (1, 2), (3, 2), (20, 21), (4, 4)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 1: 1, 2: 1, 3: 1, 20: 20, 21: 20} | {i: 100 for i in range(100, 160)}
