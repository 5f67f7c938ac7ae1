"""Catalogue: scans, writes and storage layouts on ``customer``.

Builders that write put their files in a fresh folder under the session's
shared checkpoint folder and return a lazy read of what they wrote.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import index as IX
from ..operators import storage as S
from ..session import work_dir
from ..sources.files import integer_range
from ..sources.inference import read_csv_split
from ..operators.array_store import ArrayStore
from ..sources.tables import matrix, table
from .registry import query

LOOKUP_KEY = 42
TILES = 4


@query("parquet_scan", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0""", ids="SRC-9")
def parquet_scan(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal") \
        .filter(F.col("c_acctbal") > 0)


@query("parquet_roundtrip", "SELECT * FROM customer", ids="SNK-2")
def parquet_roundtrip(spark, sf):
    c = table(spark, sf, "customer")
    path = S.write_parquet(c, work_dir(spark, "roundtrip"), compression="zstd")
    return spark.read.parquet(path)


# Regions as shares of the vector count n: a whole write, then an overlapping
# replacement of vectors [n/4, n/2) and components [16, 48); the slice read
# back is [n/8, 3n/8).
@query("keyed_store_regions", """
WITH n AS (SELECT count(*) AS n FROM embeddings),
cells AS (SELECT vec_id AS i, unnest(range(len(embedding))) AS j, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)
SELECT i, j, CASE WHEN i >= n // 4 AND i < n // 2 AND j >= 16 AND j < 48 THEN 2 * value ELSE value END AS value
FROM cells, n WHERE i >= n // 8 AND i < 3 * n // 8""", ids="SRC-10, SNK-3, GR-3")
def keyed_store_regions(spark, sf):
    cells = matrix(spark, sf).select("i", "j", F.col("value").cast("double").alias("value"))
    n, width = table(spark, sf, "embeddings").count(), 1 << 31
    store = ArrayStore(spark, work_dir(spark, "arrays"))
    store.write("x", [(0, width), (0, width)], cells, ["i", "j"])
    block = cells.filter((F.col("i") >= n // 4) & (F.col("i") < n // 2) & (F.col("j") >= 16) & (F.col("j") < 48))
    store.write("x", [(n // 4, n // 2), (16, 48)], block.withColumn("value", F.col("value") * 2), ["i", "j"])
    return store.read("x", [(n // 8, 3 * n // 8), (0, width)])


@query("sorted_store_lookup", f"""
SELECT * FROM customer WHERE c_custkey = {LOOKUP_KEY}""", ids="SNK-4, PRJ-6")
def sorted_store_lookup(spark, sf):
    c = table(spark, sf, "customer")
    path = S.write_sorted_store(c, "c_custkey", work_dir(spark, "sorted"))
    return S.lookup(spark, path, "c_custkey", LOOKUP_KEY)


@query("categorize", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT)
       AS c_mktsegment_code
FROM customer""", ids="SNK-5")
def categorize(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    coded, _ = S.categorize(c, "c_mktsegment")
    return coded.select("c_custkey", "c_mktsegment", "c_mktsegment_code")


@query("set_index_divisions", f"""
SELECT CAST(tile AS INTEGER) AS tile, min(c_name) AS lo, max(c_name) AS hi, CAST(count(*) AS BIGINT) AS n
FROM (SELECT c_name, ntile({TILES}) OVER (ORDER BY c_name) AS tile FROM customer) t
GROUP BY tile""", ids="SL-6")
def set_index_divisions(spark, sf):
    return S.exact_divisions(table(spark, sf, "customer"), "c_name", TILES)


INDEX_PARTS = 8


# A repeated key; the look-up opens only the parts whose divisions meet it.
@query("set_index_loc", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey BETWEEN 40 AND 60""", ids="SL-5, SL-6, PRJ-7")
def set_index_loc(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    path = IX.write_index(o, "o_custkey", work_dir(spark, "index"), INDEX_PARTS)
    return IX.loc(spark, path, "o_custkey", 40, 60)


# The divisions of an index on five values (each spans parts): how many rows
# they hold, and how many parts begin below the end of the part before.
@query("set_index_kept_divisions", """
SELECT CAST(count(*) AS BIGINT) AS n, min(c_mktsegment) AS lo, max(c_mktsegment) AS hi, CAST(0 AS BIGINT) AS disordered
FROM customer WHERE c_mktsegment IS NOT NULL""", ids="SL-5, SL-6")
def set_index_kept_divisions(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment", "c_custkey").filter("c_mktsegment IS NOT NULL")
    kept = IX.divisions(spark, IX.write_index(c, "c_mktsegment", work_dir(spark, "index"), INDEX_PARTS))
    order = Window.orderBy(IX.PART)                    # INDEX_PARTS rows
    return kept.withColumn("before", F.lag("hi").over(order)) \
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count_if(F.col("lo") < F.col("before")).alias("disordered"))


@query("text_output", """
SELECT word, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents) t
WHERE word <> '' GROUP BY word""", ids="SNK-1, SL-2")
def text_output(spark, sf):
    from ..operators import text as T
    from ..sources.tables import documents
    counts = T.word_count(documents(spark, sf).select("text"), "text")
    path = work_dir(spark, "wordcount-text")
    T.write_key_value_text(counts, path)
    parts = F.split(F.col("value"), "\t")
    return spark.read.text(path).select(parts[0].alias("word"), parts[1].cast("bigint").alias("n"))


def _csv_with_bad_lines(spark, sf):
    """``customer`` as CSV files, and files whose lines do not fit (one in eleven)."""
    c = table(spark, sf, "customer")
    path = work_dir(spark, "csv")
    c.write.option("header", True).csv(path)          # one file per task, as produced
    c.filter("c_custkey % 10 = 0").withColumn("c_nationkey", F.lit("many")) \
        .write.mode("append").option("header", True).csv(path)
    return path


# No schema is given: the types come from all rows; lines that do not fit
# are split off (csv_rejects).
@query("csv_scan", """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""", ids="SRC-4")
def csv_scan(spark, sf):
    return read_csv_split(spark, _csv_with_bad_lines(spark, sf), reject_share=0.2).typed


@query("csv_rejects", """
SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',many,' || CAST(c_acctbal AS VARCHAR) || ',' || c_mktsegment AS record,
       c_custkey, CAST(NULL AS BIGINT) AS c_nationkey
FROM customer WHERE c_custkey % 10 = 0""", ids="SRC-4")
def csv_rejects(spark, sf):
    rejected = read_csv_split(spark, _csv_with_bad_lines(spark, sf), reject_share=0.2).rejected
    return rejected.select(F.col("_record").alias("record"), "c_custkey", "c_nationkey")


@query("gzip_text_scan", """
SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) t""", ids="SRC-2, SRC-1")
def gzip_text_scan(spark, sf):
    from ..sources.files import read_text
    from ..sources.tables import lines
    path = work_dir(spark, "gz")
    lines(spark, sf).select("line").write.option("compression", "gzip").text(path)
    back = read_text(spark, f"{path}/*.txt.gz")
    return back.agg(F.count(F.lit(1)).alias("n_lines"),
                    F.sum(F.length("value")).cast("bigint").alias("n_chars"))


# Ids missing between the smallest and the largest event id of one type.
@query("sequence_gaps", """
WITH e AS (SELECT event_id FROM events WHERE event_type = 'error')
SELECT unnest(range(min(event_id), max(event_id) + 1)) AS event_id FROM e EXCEPT SELECT event_id FROM e""", ids="SRC-5")
def sequence_gaps(spark, sf):
    e = table(spark, sf, "events").filter("event_type = 'error'").select("event_id")
    every = integer_range(spark, e.agg(F.min("event_id"), F.max("event_id") + 1), "event_id")
    return every.join(e, "event_id", "left_anti")


@query("count_per_folder", """
SELECT CAST(c_custkey % 3 AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS n_rows FROM customer GROUP BY 1""", ids="AG-8, SRC-11")
def count_per_folder(spark, sf):
    """Several text files counted one by one, addressed by their full URI, and summed per folder."""
    from ..operators import text as T
    path = work_dir(spark, "parts")
    table(spark, sf, "customer").select((F.col("c_custkey") % 3).cast("int").alias("part"), F.col("c_name").alias("value")) \
        .write.partitionBy("part").text(path)
    per_file = T.count_per_file(T.read_lines(spark, f"{path}/part=*/*.txt"))
    folder = F.regexp_extract("file", "part=([0-9]+)/", 1).cast("int")
    return per_file.groupBy(folder.alias("part")).agg(F.sum("n_rows").alias("n_rows"))
