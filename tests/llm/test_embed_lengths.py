"""Each length of vectors is compared as a group of its own, whichever row is read first."""

from pagewright.llm import embed_dedup


def test_vectors_of_two_lengths(spark):
    rows = [(9, [1.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.01]), (3, [0.0, 1.0, 0.0]), (7, [3.0, 0.01]), (8, [0.0, 1.0])]
    want = {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 7: (1, 7, True), 8: (0, 8, True), 9: (1, 7, False)}
    for order in (rows, rows[::-1]):
        got = embed_dedup.near_duplicates(spark.createDataFrame(order, "vec_id long, embedding array<double>").coalesce(1)).collect()
        assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want and len(got) == 6
