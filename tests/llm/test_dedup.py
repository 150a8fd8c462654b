import hashlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from barline.llm.exact_dedup import Trie, drop_copies, exact_dedup, owners

UPPER = {i: i + 32 for i in range(65, 91)}


@settings(deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 9)), max_size=40))
def test_a_trie_holds_the_best_of_each_text(entries):
    trie, expected = Trie(), defaultdict(list)
    for text, i in entries:
        trie.add(text, i, 1, max)
        expected[text].append(i)
    assert sorted(trie.owners()) == sorted((t, max(i), len(i)) for t, i in expected.items())


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(UPPER)].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, stays = max(known, default=None), True
        for i in ids:
            kept = i == best and stays
            stays = stays and not kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_verdicts(spark, sf, odd, none):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd):
        got = sorted((tuple(r) for r in exact_dedup(docs).collect()), key=str)
        assert got == brute(docs.select("doc_id", "text").collect())
        assert drop_copies(docs).columns == docs.columns
        assert drop_copies(docs).count() == sum(r[3] for r in got)
    assert exact_dedup(none).count() == 0 and drop_copies(none).count() == 0


def test_a_small_trie_hands_on_and_the_result_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    options = {"id_col": "doc_id", "text_col": "text"}
    assert sorted(owners(docs, **options).collect()) == sorted(owners(docs, **options, trie_bytes=5_000).collect())
