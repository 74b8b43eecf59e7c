"""Order MinHash fingerprints of documents, by DataFrame functions alone.

A text becomes its word k-mers (``k`` words; a shorter text is one k-mer), each with its occurrence
number, so repeated k-mers are distinct elements.  Every element hashes to 64 bits; the hash range is cut into
``bins`` equal parts, one a component.  A component takes the ``tuple_size`` smallest elements of its own order of
all elements: those of its part by hash, then all others by that hash mixed with the component's number.  So a part
with too few elements is filled from the whole text, at any length.  The elements taken are put back into text order
and hashed together.  Texts with the same k-mers in another order share few components, so likeness follows edit
distance rather than set overlap.

All of this is array expressions inside one row: linear apart from two sorts of long values, no shuffle.

The query's next document needs one shuffle: documents are dealt by ranges of doc_id, each range is
ordered, and gets a copy of the head of the range below, so that the successor is a plain lead().

Defined results: null counts as the empty text.  A text without words has null components only, one with fewer than
``tuple_size`` elements has all of them in every component; likeness is the
share of equal components among those set in either fingerprint, and 1 if neither has any.  Documents that
repeat a doc_id are ordered by a hash of their text; a null doc_id comes last.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kestrel.llm.common import store, table, word_array

#: A hashed element keeps 37 hash bits above 27 bits of text position (Java arrays of words stay below that).
POS_BITS = 27
POS_MASK = (1 << POS_BITS) - 1


def _packed(h: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftright(h, POS_BITS), POS_BITS).bitwiseOR(pos.cast("long"))


def _hash(x: Column) -> Column:
    return F.shiftright(x, POS_BITS)


def _pos(x: Column) -> Column:
    return x.bitwiseAND(F.lit(POS_MASK).cast("long"))


def add_fingerprint(df: DataFrame, text: str, out: str, k: int = 3, bins: int = 32, tuple_size: int = 2) -> DataFrame:
    """``df`` with the array column ``out`` of ``bins`` components (int, or null for a text without words).

    Intermediate columns begin with ``out`` and a double underscore.
    """
    if bins & (bins - 1) or not 2 <= bins <= 1024:
        raise ValueError("bins must be a power of two from 2 to 1024")
    rest = df.columns
    c = lambda x: f"{out}__{x}"
    df = df.select(*rest, F.transform(word_array(F.col(text)), lambda x: F.xxhash64(x)).alias(c("w")))
    w = F.col(c("w"))
    none = F.array().cast("array<bigint>")
    kmers = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(1))),
                        lambda x, i: _packed(F.xxhash64(x, *(F.get(w, i + j) for j in range(1, k))), i))
    df = df.select(*rest, F.when(F.size(w) == 0, none).otherwise(F.sort_array(kmers)).alias(c("s")))
    # the first occurrence of a k-mer hashes as the k-mer itself, a later one with its number
    s = F.col(c("s"))
    first = F.filter(s, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(s, i - 1))))
    df = df.select(*rest, c("s"), first.alias(c("f")))
    f = F.col(c("f"))
    # runs of equal k-mers as [start, end); only texts with repeats come here
    heads = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (_hash(F.get(s, i)) != _hash(F.get(s, i - 1))))
    runs = F.flatten(F.transform(F.array(F.struct(heads.alias("h"))), lambda z: F.transform(
        z["h"], lambda i, j: F.struct(i.alias("a"), F.coalesce(F.get(z["h"], j + 1), F.size(s)).alias("b")))))
    later = F.flatten(F.transform(F.filter(runs, lambda r: r["b"] > r["a"] + 1), lambda r: F.transform(
        F.sequence(r["a"] + 1, r["b"] - 1), lambda i: _packed(F.xxhash64(_hash(F.get(s, i)), i - r["a"]), _pos(F.get(s, i))))))
    df = df.select(*rest, F.when(F.size(f) == F.size(s), s).otherwise(F.sort_array(F.concat(f, later))).alias(c("v")))
    shift = 64 - (bins.bit_length() - 1)
    part = lambda x: F.shiftright(x, shift)
    v = F.col(c("v"))
    df = df.select(*rest, c("v"), F.filter(v, lambda x, i: (i < tuple_size) | (part(F.get(v, i - tuple_size)) != part(x))).alias(c("m")))
    m = F.col(c("m"))
    starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (part(F.get(m, i)) != part(F.get(m, i - 1))))
    # the whole text goes on only where some part lacks elements
    short = F.when(F.size(m) < bins * tuple_size, v).otherwise(none)
    df = df.select(*rest, c("m"), short.alias(c("v")), F.when(F.size(m) == 0, F.array().cast("array<int>")).otherwise(starts).alias(c("a")))
    a = F.col(c("a"))
    members = F.transform(a, lambda i, j: F.slice(m, i + 1, F.coalesce(F.get(a, j + 1), F.size(m)) - i))
    in_order = lambda t: F.transform(F.array_sort(F.transform(t, lambda x: F.struct(_pos(x).alias("p"), _hash(x).alias("u")))), lambda z: z["u"])
    hashed = lambda t: F.shiftright(F.xxhash64(in_order(t)), 32).cast("int")

    def filled(own, b, every):
        others = F.transform(F.filter(every, lambda x: part(x) != b), lambda x: F.struct(F.xxhash64(_hash(x), b).alias("h"), x.alias("x")))
        return F.concat(own, F.transform(F.slice(F.sort_array(others), 1, F.lit(tuple_size) - F.size(own)), lambda o: o["x"]))

    # bound by a one-element array: a plain column used in a lambda only could be inlined and computed for each part
    found = F.array(F.struct(members.alias("g"), F.transform(a, lambda i: part(F.get(m, i)).cast("int")).alias("b"), F.col(c("v")).alias("v")))
    own = lambda z, b: F.get(z["g"], F.coalesce(F.array_position(z["b"], b), F.lit(0)).cast("int") - 1)
    at = F.flatten(F.transform(found, lambda z: F.when(F.size(z["v"]) == 0, F.when(F.size(z["b"]) == 0, F.array_repeat(F.lit(None).cast("int"), bins))
                                                       .otherwise(F.transform(z["g"], hashed))).otherwise(F.transform(
        F.sequence(F.lit(-bins // 2), F.lit(bins // 2 - 1)),
        lambda b: F.get(F.transform(F.array(F.coalesce(own(z, b), none)), lambda t: hashed(
            F.when(F.size(t) == tuple_size, t).otherwise(filled(t, b, z["v"])))), F.lit(0))))))
    return df.select(*rest, at.alias(out))


def fingerprint_text(parts: Column) -> Column:
    """Eight hex digits a component, eight dashes for an empty part."""
    return F.array_join(F.transform(parts, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), F.lit("--------"))), "")


def likeness(a: Column, b: Column) -> Column:
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z))
    both = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda z: z))
    return F.when(both == 0, F.lit(1.0)).otherwise(same / both)


def fingerprints(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, parts, fingerprint) of every row."""
    out = add_fingerprint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "parts", **options)
    return out.select("doc_id", "parts", fingerprint_text(F.col("parts")).alias("fingerprint"))


def with_next(docs: DataFrame, rows_a_range: int = 1000, most_ranges: int = 10_000, **options) -> DataFrame:
    """(doc_id, text, parts, next_text, next_parts): every document and the one after it by descending doc_id (the first after the last).

    Ranges come from quantiles of doc_id; at most ``most_ranges`` boundaries reach the driver.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = texts.count()
    ranges = int(min(most_ranges, max(1, count // rows_a_range)))
    cuts = texts.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * most_ranges)).first()[0] if ranges > 1 else []
    cuts = sorted(set(cuts or []))
    if cuts:
        bounds = F.array(*map(F.lit, cuts))
        dealt = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda x: x < F.col("doc_id"))))
    else:
        dealt = F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    texts = texts.select("doc_id", "text", dealt.alias("range"), F.xxhash64("text").alias("tie"))
    # the head of each range: one row a range, so this window and join are bounded by most_ranges
    heads = texts.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
    ring = Window.orderBy("range")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = store(heads.select(
        F.coalesce(F.lead("range").over(ring), F.first("range").over(whole)).alias("goes_to"), F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie")), "heads")
    copies = (texts.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
              .select("doc_id", "text", F.col("goes_to").alias("range"), "tie").dropDuplicates(["range"]))
    rows = texts.withColumn("copy", F.lit(False)).union(store(copies, "heads").withColumn("copy", F.lit(True)))
    rows = add_fingerprint(rows, "text", "parts", **options)
    after = Window.partitionBy("range").orderBy("copy", F.desc_nulls_last("doc_id"), F.desc("tie"))
    both = rows.withColumn("next_text", F.lead("text").over(after)).withColumn("next_parts", F.lead("parts").over(after))
    return both.where("NOT copy").select("doc_id", "text", "parts", "next_text", "next_parts")


# ---------------------------------------------------------------- registered query

def op3_order_minhash(spark, sf_dir):
    rows = with_next(table(spark, sf_dir, "documents"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "parts", "next_parts")
    rows = rows.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    rows = add_fingerprint(rows, "edited", "edited_parts")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("parts")).alias("fingerprint"),
        fingerprint_text(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"), likeness(F.col("parts"), F.col("next_parts")).alias("near_next"))
