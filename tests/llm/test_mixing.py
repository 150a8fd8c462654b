from itertools import product

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barline.llm.mixing import fit_counts, mix


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(1, 3)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.floats(0, 1))
def test_fit_is_as_near_as_any_choice_the_proportional_part_leaves(lengths, part):
    sizes, counts = (np.array(x) for x in zip(*sorted(lengths)))
    budget = part * int(sizes @ counts)
    taken = fit_counts(sizes, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    floor = np.floor(counts * (budget / int(sizes @ counts))).astype(int)
    choices = [np.array(c) @ sizes for c in product(*(range(f, n + 1) for f, n in zip(floor, counts)))]
    best = min(abs(c - round(budget)) for c in choices)
    assert abs(int(taken @ sizes) - round(budget)) == best


def test_large_budgets_stay_near():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.choice(np.arange(1, 30_000), 3_000, replace=False))
    counts = rng.integers(1, 2_000, 3_000)
    budget = 0.37 * int(sizes @ counts)
    assert abs(int(fit_counts(sizes, counts, budget) @ sizes) - budget) <= 1
    assert fit_counts(np.array([100_000]), np.array([1]), 99_000.0).tolist() == [1]
    assert fit_counts(np.array([100_000]), np.array([1]), 20_000.0).tolist() == [0]


def level(sizes, weights, share=1.5, cap=2.0):
    """Targets by giving again and again what is above a cap to the others."""
    target, left = dict.fromkeys(sizes, 0.0), share * sum(sizes.values())
    free = set(sizes)
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total >= cap * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_takings(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mix(docs).toPandas()
    again = mix(docs.repartition(5)).toPandas()
    by = ["doc_id", "copies"]
    assert got.sort_values(by)[by].values.tolist() == again.sort_values(by)[by].values.tolist()
    words = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    assert (got["size"] == got.doc_id.map(words)).all()
    sizes = got.groupby("source")["size"].sum().to_dict()
    expected = level(sizes, dict(zip(sorted(sizes), [5, 2, 1] * 20)))
    for source, rows in got.groupby("source"):
        assert abs(rows.target.iloc[0] - expected[source]) < 1e-6 * expected[source] + 1e-6
        assert abs(rows.taken.sum() - expected[source]) <= max(2, 0.02 * expected[source])
    assert (got.taken <= 2 * got["size"]).all()


def test_odd_rows(odd, none):
    got = mix(odd)
    assert got.count() == odd.count()
    assert got.filter("doc_id in (4, 5, 6) and (size > 0 or taken > 0)").count() == 0
    assert got.filter(F.col("source").isNull()).select("source_size").distinct().count() == 1
    assert mix(none).count() == 0
