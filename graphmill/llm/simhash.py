"""Operator 6: SimHash document fingerprints, with DataFrame functions only.

Every word of a text (lower-cased, split at white space) votes with its 64-bit hash on 64 signed bits, as often as it occurs
(its weight).  A fingerprint's bit is 1 where more than half of the votes are.  Votes of several bits are summed in one long:
``LANES`` longs hold four 16-bit counters each for runs of ``RUN`` words, and the runs' counters are then split, so a text of
any length fits.  Fingerprints print as 16 hex digits.

``within_radius`` finds all fingerprints within a Hamming radius r of the queries': of r + 1 blocks of bits, one is equal, so
each table holds the fingerprints by one block, permuted to the front, and equal blocks are compared in full.

Defined results: null is the empty text; a text without words has the fingerprint 0; equal texts have equal fingerprints;
rows that are equal count as one, and come back as often as they are given; "next" is by ascending doc_id, null ids last,
equal ids by a hash; the next of the last is the first, so a single row is its own next; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphmill.llm.common import parts, release, stored
from graphmill.session import table

BITS = 64
LANES = 16
_SPREAD = 0x0001000100010001
#: Words per run: the most that leaves the sign of the uppermost 16-bit counter free.
RUN = 32767
RADIUS = 3
SEED = 6


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and fingerprint (long) of every row; the first key tells the rows apart."""
    rows = texts.select(*keys, F.posexplode(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+")).alias("_at", "_word"))
    real = F.col("_word") != ""
    h = F.when(real, F.xxhash64("_word", F.lit(SEED))).otherwise(F.lit(0).cast("long"))
    rows = rows.select(*keys, F.expr(f"_at div {RUN}").alias("_run"), real.cast("int").alias("_n"), h.alias("_h"))
    lanes = [F.sum(F.shiftrightunsigned("_h", i).bitwiseAND(F.lit(_SPREAD))).alias(f"_l{i}") for i in range(LANES)]
    runs = rows.groupBy(*keys, "_run").agg(F.sum("_n").alias("_n"), *lanes)
    # bit 16 * j + i is counter j of lane i
    votes = [F.sum(F.shiftrightunsigned(f"_l{i}", 16 * j).bitwiseAND(F.lit(0xFFFF))).alias(f"_v{16 * j + i}") for j in range(4) for i in range(LANES)]
    docs = runs.groupBy(*keys).agg(F.sum("_n").alias("_n"), *votes)
    bits = F.lit(0).cast("long")
    for b in range(BITS):
        bit = F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long")
        bits = bits.bitwiseOR(F.when(F.col(f"_v{b}") * 2 > F.col("_n"), bit).otherwise(F.lit(0).cast("long")))
    return docs.select(*keys, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def with_next(spark: SparkSession, rows: DataFrame, order: list[str], key: str) -> DataFrame:
    """``rows`` with next: the ``key`` of the following row in ``order``; the last one's is the first's.

    Rows go to tasks by ranges of the order; each task leads within its range, and a row per range gives the first key of
    the next.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    ranged = stored(spark, rows.repartitionByRange(parts(spark), *by).withColumn("_part", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_part").orderBy(*by)
    led = ranged.withColumn("_next", F.lead(key).over(own)).withColumn("_rank", F.row_number().over(own))
    firsts = led.where("_rank = 1").select(F.col("_part").alias("_at"), F.col(key).alias("_first"))
    # one row per range
    after = Window.orderBy("_at")
    firsts = firsts.select(F.col("_at"), F.coalesce(F.lead("_first").over(after), F.first("_first").over(after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_follow"))
    return led.join(firsts, F.col("_part") == F.col("_at")).select(*rows.columns, F.coalesce("_next", "_follow").alias("next"))


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, fingerprint): every pair of a query's and a row's distinct fingerprints within ``radius``, once."""
    n = radius + 1
    cuts = [BITS * i // n for i in range(n + 1)]

    def block(c: Column, i: int) -> Column:
        """Block i of the fingerprint, permuted to the front."""
        return F.shiftrightunsigned(F.shiftleft(c, BITS - cuts[i + 1]), BITS - cuts[i + 1] + cuts[i])

    def tables(df: DataFrame, name: str) -> DataFrame:
        c = F.col("fingerprint")
        own = df.select("fingerprint").distinct()
        return own.select(c.alias(name), F.posexplode(F.array(*[block(c, i) for i in range(n)])).alias("table", "block"))

    a, b = F.col("query"), F.col("fingerprint")
    close = F.bit_count(a.bitwiseXOR(b)) <= radius
    first = F.lit(False)  # no table before this one has the pair
    for i in reversed(range(n)):
        first = F.when(F.col("table") == i, F.lit(True)).when(block(a, i) == block(b, i), F.lit(False)).otherwise(first)
    found = tables(queries, "query").join(tables(rows, "fingerprint"), ["table", "block"])
    return found.where(close & first).select("query", "fingerprint")


def document_fingerprints(spark: SparkSession, docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and n_within: for
    ids divisible by 100, the different rows (itself included) whose fingerprint is within ``radius``; null for others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    own = own.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")
    rows = own.groupBy("uid", "doc_id").agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("copies"))
    rows = stored(spark, with_next(spark, stored(spark, rows, "rows"), ["doc_id", "uid"], "uid"), "next")

    # each text's head, as long as its predecessor asks for, goes to the predecessor's text
    texts = own.groupBy("uid").agg(F.first("text").alias("text"))
    asked = rows.select(F.col("uid").alias("of"), F.col("next").alias("uid"), F.expr("cast(n_chars div 2 as int)").alias("k"))
    heads = asked.join(texts, "uid").select(F.col("of").alias("uid"), F.expr("substring(text, 1, k)").alias("head"), "k")
    edited = texts.join(heads, "uid").select("uid", "text", F.concat(F.expr("substring(text, 1, length(text) - k)"), F.col("head")).alias("edited"))
    both = edited.select("uid", F.sha2("edited", 256).alias("sha"), F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    found = fingerprints(both, ["uid", "sha", "kind"])
    found = found.groupBy("uid", "sha").agg(F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fp"))
    found = stored(spark, found.join(rows, "uid"), "fingerprints")
    release(spark)

    after = found.select(F.col("uid").alias("_next"), F.col("fp").alias("next_fp"))
    out = found.join(after, F.col("next") == F.col("_next"))
    asks = found.where("doc_id % 100 = 0").select(F.col("fp").alias("fingerprint"))
    counts = found.groupBy(F.col("fp").alias("fingerprint")).agg(F.count("*").alias("rows"))
    near = within_radius(asks, counts, radius).join(counts, "fingerprint").groupBy("query").agg(F.sum("rows").alias("n_within"))
    out = out.withColumn("_asks", F.when(F.col("doc_id") % 100 == 0, F.col("fp"))).join(near, F.col("_asks") == F.col("query"), "left")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_within",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(spark, table(spark, sf_dir, "documents"))
