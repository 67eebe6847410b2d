"""Rows that share a key but not a text give the same result in any order."""

from demandtide.llm import minhash_dedup as mh


def test_components_do_not_depend_on_the_order_of_rows(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (1, a + " more"), (2, b + " more"), (9, b), (0, min(a, b)), (3, "x y"), (3, a + " else")]
    results = set()
    for order in ((0, 1, 2, 3, 4, 5, 6, 7), (7, 1, 0, 6, 2, 3, 4, 5)):
        frame = spark.createDataFrame([rows[k] for k in order], "doc_id long, text string").coalesce(1)
        results.add(frozenset((r.doc_id, r.n_shingles, r.component_id) for r in mh.minhash_dedup(frame, n=2).collect()))
    assert len(results) == 1
    by = {d: c for d, _, c in next(iter(results))}
    assert by[0] == by[1] == 0 and by[9] in (2, by[5])
