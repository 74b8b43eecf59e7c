from kestrel.llm.common import table
from kestrel.llm.windows import deduplicate_windows, op8_substring_dedup
from tests.llm import brute


def test_query_equals_brute_force(spark, mid_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, mid_dir, "documents").collect()]
    expected = brute.windows(docs)
    rows = op8_substring_dedup(spark, mid_dir).collect()
    assert len(rows) == len(docs) and sum(r["n_removed"] for r in rows) > 0
    for r in rows:
        assert expected[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_sha256"])


def test_short_windows_and_intervals(spark):
    docs = [(i, " ".join(f"t{(i * j) % 7}" for j in range(40))) for i in range(30)]
    expected = brute.windows(docs, 6)
    for r in deduplicate_windows(spark.createDataFrame(docs, "doc_id long, text string"), 6).collect():
        assert expected[r["doc_id"]] == (r["n_words"], r["n_removed"], r["kept_sha256"])
        assert sum(s["end"] - s["start"] for s in r["intervals"] or []) == r["n_removed"]
        stops = [s["end"] for s in r["intervals"] or []]
        assert all(s["start"] > e for s, e in zip((r["intervals"] or [])[1:], stops, strict=False))


def test_edges(spark, edge, empty):
    rows = deduplicate_windows(edge, 50).collect()
    assert len(rows) == edge.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert (by[9]["n_removed"], by[10]["n_removed"]) == (0, 60)
    assert by[8]["n_removed"] == 60_000 and by[8]["kept_sha256"] == brute.sha("tail")
    assert by[11]["n_removed"] == 0 and by[4]["n_words"] == 0 and by[4]["kept_sha256"] == brute.sha("")
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] is None)
    assert deduplicate_windows(empty).count() == 0


def test_repeated_doc_id_with_other_text(spark):
    text = " ".join(f"a{i}" for i in range(70))
    docs = [(1, text), (1, text + " b"), (2, "c " + text), (2, "d " + text), (3, text)]
    rows = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in deduplicate_windows(spark.createDataFrame(docs, "doc_id long, text string"), 50).collect()}
    assert rows == {(1, 70): 0, (1, 71): 0, (2, 71): 70, (3, 70): 70}
