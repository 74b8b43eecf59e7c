"""Line dedup by DataFrame functions alone.

 1. Every whole text is split at newlines; each line's key (white space stripped at both ends,
    A-Z lower-cased) becomes 128 hash bits.  The skinny rows (hash, document, position) are stored.
 2. They are range-partitioned by (hash, document) and sorted by (hash, document, position), so a key
    that a third of all lines share is spread over as many partitions as its rows need.
 3. Streaming a sorted partition gives the first occurrence of a key in each document; partial sums per
    key leave a partition as one row, so documents per key are counted with almost no shuffle.
 4. Keys found in ``min_docs`` documents join back to their lines (splittable when hot), which are gathered
    per document into a run-length compressed keep bitmap: lengths of kept and dropped runs
    in turn, beginning and ending with a kept run.  No text moves until a caller applies the bitmaps.

With ``keep_first`` the corpus-wide first line of such a key (smallest document, then position) stays.

Defined results: a null or empty text is one empty line and stays.  Keys shorter than ``min_chars``
code points are never dropped.  Rows with the same doc_id count as one document; null doc_ids count
as one document too.  Each row gives a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kestrel.llm.common import LOWER, SPACES, UPPER, store, table


def line_key(line: Column) -> Column:
    bare = F.trim(line, F.lit(SPACES))
    # lower() is the plain A-Z mapping where every character is one byte
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _identity(docs: DataFrame) -> list[Column]:
    """Columns that name a row for joins: doc_id, and its text for rows that repeat a doc_id."""
    return [docs["doc_id"].alias("doc"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("digest")]


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, digest, pos, h1, h2) of every line whose key is long enough."""
    lines = docs.select(*_identity(docs), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "digest", "pos", line_key(F.col("line")).alias("line_key")).where(F.char_length("line_key") >= min_chars)
    return keyed.select("doc", "digest", "pos", F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(7), "line_key").alias("h2"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc, digest, gone) of the documents that lose lines; ``gone`` holds the sorted positions of the dropped lines."""
    rows = store(line_rows(docs, min_chars), "lines")
    ordered = rows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("pos"))
    firsts = ordered.select("h1", "h2", "doc", "pos", nth.alias("nth")).where("nth = 1")
    keys = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "pos")).alias("first")).where(F.col("n") >= min_docs)
    # stored, so that the join below is dealt by Spark alone and a hot key can be split
    keys = store(keys.select("h1", "h2", "first"), "line-keys")
    lost = rows.join(keys, ["h1", "h2"])
    if keep_first:
        lost = lost.where(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("pos") == F.col("first.pos"))))
    return lost.groupBy("doc", "digest").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def _marked(docs: DataFrame, **options) -> DataFrame:
    """(row, lines, n, gone, starts, ends): ``starts`` and ``ends`` bound the dropped runs of lines."""
    gone = keep_bitmaps(docs.select("doc_id", "text"), **options)
    whole = docs.select(F.struct("*").alias("row"), *_identity(docs), F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    both = whole.join(gone.withColumnsRenamed({"doc": "doc2", "digest": "digest2"}),
                      F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("digest") == F.col("digest2")), "left")
    g = F.col("gone")
    return both.select(
        "row", "lines", F.size("lines").alias("n"), "gone",
        F.filter(g, lambda x, i: (i == 0) | (F.get(g, i - 1) != x - 1)).alias("starts"),
        F.transform(F.filter(g, lambda x, i: (i == F.size(g) - 1) | (F.get(g, i + 1) != x + 1)), lambda x: x + 1).alias("ends"))


def _kept_text(marked: DataFrame) -> Column:
    """The kept lines joined by newlines (the text itself where nothing goes)."""
    runs = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("ends")).alias("a"), F.concat(F.col("starts"), F.array(F.col("n"))).alias("b"))
    kept = F.flatten(F.transform(runs, lambda r: F.slice(F.col("lines"), r["a"] + 1, r["b"] - r["a"])))
    return F.when(F.col("gone").isNull(), F.coalesce(F.col("row.text"), F.lit(""))).otherwise(F.array_join(kept, "\n"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(row, n_lines, n_dropped, keep_runs, kept_text): ``row`` holds the columns of ``docs``."""
    marked = _marked(docs, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    edges = F.concat(F.flatten(F.transform(F.arrays_zip(F.col("starts").alias("s"), F.col("ends").alias("e")), lambda z: F.array(z["s"], z["e"]))), F.array("n"))
    marked = marked.withColumn("edges", F.coalesce(edges, F.array("n")))
    runs = F.transform("edges", lambda x, i: F.when(i == 0, x).otherwise(x - F.get(F.col("edges"), i - 1)))
    return marked.select("row", F.col("n").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         runs.alias("keep_runs"), _kept_text(marked).alias("kept_text"))


def deduplicate_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated lines cut from text (same columns; n_chars follows the text)."""
    out = line_dedup(docs, **options)
    new = {"text": F.when(F.col("n_dropped") == 0, F.col("row.text")).otherwise(F.col("kept_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(F.char_length("kept_text")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


# ---------------------------------------------------------------- registered query

def op5_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"), "keep_runs")


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key),
b AS (SELECT *, CASE WHEN gone IS DISTINCT FROM lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) THEN 1 ELSE 0 END AS flip FROM m),
r AS (SELECT *, sum(flip) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM b),
c AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
runs AS (
  SELECT doc_id, CASE WHEN min(run) = 1 THEN [0] ELSE [] END || list(n ORDER BY run) || CASE WHEN max(run) % 2 = 1 THEN [0] ELSE [] END AS keep_runs
  FROM c GROUP BY doc_id)
SELECT r.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256,
       any_value(keep_runs)::INTEGER[] AS keep_runs
FROM r JOIN runs USING (doc_id) GROUP BY r.doc_id
"""
