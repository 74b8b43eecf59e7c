import duckdb
import pytest

import __spark_entry__ as E
from kestrel.llm.common import table
from kestrel.llm.lines import deduplicate_lines, line_dedup
from kestrel.llm.mixing import mix, mixed
from tests.compare import norm
from tests.llm import brute


@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_mix_sources"])
def test_query_equals_sql(spark, mid_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{mid_dir}/documents.parquet')")
    df = E.queries()[name](spark, mid_dir)
    cols = sorted(df.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert sorted(tuple(norm(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_line_edges(spark, edge, empty):
    rows = line_dedup(edge, min_docs=2).collect()
    assert len(rows) == edge.count()
    by = {r["row"]["doc_id"]: r for r in rows if r["row"]["doc_id"] is not None}
    # "one" is in documents 5 and 11; a key needs a code point, so empty lines stay
    assert by[5]["kept_text"] == by[11]["kept_text"] == "" and by[5]["keep_runs"] == [0, 1, 0]
    assert (by[3]["n_lines"], by[3]["n_dropped"], by[4]["n_lines"], by[4]["kept_text"]) == (1, 0, 1, "")
    # a key twice in one document is in one document
    assert by[13]["n_dropped"] == 0 and by[13]["keep_runs"] == [4]
    first = {r["row"]["doc_id"]: r["n_dropped"] for r in line_dedup(edge, min_docs=2, keep_first=True).collect()}
    assert (first[5], first[11]) == (0, 1)
    assert line_dedup(empty).count() == 0
    out = deduplicate_lines(edge, min_docs=2)
    assert out.columns == edge.columns and out.count() == edge.count()


def test_kept_runs_and_bitmap(spark):
    docs = [(i, "\n".join(["head", f"own {i}", "Foot ", " head\t", f"more {i}", "foot"])) for i in range(12)]
    for r in line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=10).collect():
        i = r["row"]["doc_id"]
        assert (r["n_lines"], r["n_dropped"], r["keep_runs"]) == (6, 4, [0, 1, 1, 2, 1, 1, 0])
        assert r["kept_text"] == f"own {i}\nmore {i}"


def test_mix_meets_targets(spark, mid_dir):
    rows = mixed(table(spark, mid_dir, "documents"), max_epochs=3).collect()
    assert all(0 <= r["copies"] <= 3 for r in rows)
    by = {}
    for r in rows:
        s = by.setdefault(r["row"]["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += r["copies"] * r["size"]
        s[1] = max(s[1], r["size"])
    assert abs(sum(s[2] for s in by.values()) - sum(s[3] for s in by.values())) < 1
    for taken, largest, target, size in by.values():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= largest / 2 + 1


def test_mix_edges(spark, edge, empty):
    rows = mixed(edge).collect()
    assert len(rows) == edge.count()
    assert {r["row"]["doc_id"]: r["size"] for r in rows if r["row"]["doc_id"] in (3, 4, 6)} == {3: 0, 4: 0, 6: 0}
    again = sorted((str(r["row"]["doc_id"]), r["copies"]) for r in mixed(edge.repartition(3)).collect())
    assert again == sorted((str(r["row"]["doc_id"]), r["copies"]) for r in rows)
    assert mix(edge).columns == edge.columns
    assert mixed(empty).count() == 0 and mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r["target"] for r in mixed(blank).collect()] == [0.0, 0.0]
    assert brute.words(" a\x0bb\x85c ") == ["a", "b\x85c"]
