import numpy as np

from kestrel.llm.caps import list_decode, near_vectors, product_code
from kestrel.llm.common import table
from tests.llm import brute


def expected(rows, cosine=0.9):
    """{id: (links, component)} for distinct ids."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    u = brute.Union()
    links = {i: 0 for i, _ in rows}
    for i, _ in rows:
        u.find(i)
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                u.join(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], u.find(i)) for i, _ in rows}


def as_dict(df):
    return {r["id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_groups_equal_brute_force(spark):
    """Clusters of several widths, one larger than a block, and exact copies."""
    rng = np.random.default_rng(3)
    rows = []
    for size, spread in ((90, 0.05), (40, 0.35), (30, 0.5), (60, 3.0)):
        centre = rng.standard_normal(24)
        rows += [centre + spread * rng.standard_normal(24) for _ in range(size)]
    rows += [rows[0]] * 25 + [2 * rows[1], -rows[2]]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = as_dict(near_vectors(df, filters=60, block=16, pool=64)), expected(rows)
    assert all(got[i][0] <= want[i][0] for i in want)  # no pair below 0.9, none twice
    found, there = sum(x[0] for x in got.values()), sum(x[0] for x in want.values())
    assert found >= 0.99 * there
    whole = [i for i in want if got[i] == want[i]]
    assert len(whole) >= 0.97 * len(want)


def test_list_decoding_is_complete():
    rng = np.random.default_rng(1)
    unit = rng.standard_normal((50, 12))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    books = product_code(12, 3, 5)
    scores = [unit @ b.T for b in books]
    every = (scores[0][:, :, None, None] + scores[1][:, None, :, None] + scores[2][:, None, None, :]).reshape(50, -1)
    row, filt = list_decode(unit, books, 1.0, 6)
    got = set(zip(row.tolist(), filt.tolist(), strict=True))
    for i in range(50):
        over = set(np.flatnonzero(every[i] >= 1.0).tolist())
        want = over if len(over) >= 6 else set(np.argsort(-every[i], kind="stable")[:6].tolist())
        assert {f for r, f in got if r == i} == want


def test_query_on_given_vectors(spark, mid_dir):
    from kestrel.llm.caps import op4_embedding_near_dedup

    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, mid_dir, "embeddings").collect()]
    got = op4_embedding_near_dedup(spark, mid_dir)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got.collect()} == expected(rows)


def test_edges(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [None, 1.0, 0.0]),
            (7, []), (8, [1.0, 0.0]), (9, [float("inf"), 0.0, 0.0]), (10, [1e200, 1e190, 0.0]), (11, [0.0, 1.0, 0.0])]
    schema = "vec_id long, embedding array<double>, id string, filters int, dim string"
    df = spark.createDataFrame([(i, v, "x", 0, "y") for i, v in rows] + [(None, [1.0, 0.0, 0.0], "x", 0, "y"), (12, [0.0, 1.0, 0.0], "x", 0, "y"), (12, [0.0, 0.0, 1.0], "x", 0, "y")], schema)
    got = near_vectors(df, filters=8)
    assert got.count() == 14
    by = {}
    for r in got.collect():
        by.setdefault(r["id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    for i in (3, 4, 5, 6, 7, 8, 9):
        assert by[i] == [(0, i, True)]
    assert by[1] == [(2, 1, True)] and by[2] == [(2, 1, False)] and by[10] == [(2, 1, False)]
    assert by[None] == [(0, None, True)]
    assert sorted(by[12]) == [(0, 12, True), (1, 11, False)]
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
