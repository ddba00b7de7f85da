"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop lines over a threshold, reassemble.

Built from DataFrame functions only. A line's key is the line stripped of `[\\x20\\x09-\\x0D]` at both ends with A-Z
lower-cased; keys are held as 64-bit hashes, so that no text is shuffled to be counted; rows are told by 128 bits.

Defined results: a null or empty text is one empty line; empty keys are never dropped; rows of one id are one document and
count once, rows of null id are documents of their own, and all rows lose the same lines; other columns pass through, but for
those named as the ones added; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import BROADCAST_ROWS, SPACES, ascii_lower, materialise, small

MIN_DOCS = 10


def _hashes(text):
    def of(line):
        key = F.btrim(line, F.lit(SPACES))
        return F.when(key != "", F.xxhash64(key))

    return F.transform(F.split(ascii_lower(text), "\n", -1), of)


ROW = ("_k1", "_k2")
#: Line places of a broadcast side at most.
BROADCAST_PLACES = 2_000_000


def _row_key(id_col: str, text: Column) -> list[Column]:
    return [F.xxhash64(F.col(id_col), text).alias(ROW[0]), F.xxhash64(F.lit(1), F.col(id_col), text).alias(ROW[1])]


def line_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_k1, _k2, id, hashes) for each row: one hash per line in order, null for lines with an empty key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*_row_key(id_col, text), F.col(id_col).alias("id"), _hashes(text).alias("hashes"))


def frequent_lines(hashes: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least min_docs documents.

    A row counts a line once, before the shuffle, so counts combine on the map side. Only rows whose id repeats have their
    lines made distinct by id first.
    """
    each = hashes.select("id", F.explode(F.array_distinct(F.array_compact("hashes"))).alias("h"))
    repeated = hashes.where("id IS NOT NULL").groupBy("id").count().where("count > 1").select("id")
    repeated = materialise(repeated, "lines-repeated-ids")
    n = repeated.count()
    if n:
        side = F.broadcast(repeated) if n <= BROADCAST_ROWS else repeated
        each = each.join(side, "id", "left_anti").select("h").unionByName(each.join(side, "id", "left_semi").distinct().select("h"))
    return each.groupBy("h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with `text_col` rebuilt from its kept lines, and the columns _n_lines and _n_dropped."""
    docs = docs.drop("_n_lines", "_n_dropped", "_lines", "_dropped", *ROW)
    hashes = materialise(line_hashes(docs, id_col, text_col), "lines")
    frequent = small(materialise(frequent_lines(hashes, min_docs).select("h"), "frequent-lines"))
    # repeated rows have equal lines, of which one row's places are enough
    dropped = hashes.select(*ROW, F.posexplode("hashes").alias("at", "h")).where(F.col("h").isNotNull()).join(frequent, "h")
    dropped = materialise(dropped.groupBy(*ROW).agg(F.collect_set("at").alias("_dropped")), "dropped-lines")
    n, places = dropped.agg(F.count("*"), F.coalesce(F.sum(F.size("_dropped")), F.lit(0))).first()
    if n <= BROADCAST_ROWS and places <= BROADCAST_PLACES:
        dropped = F.broadcast(dropped)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    joined = docs.select("*", *_row_key(id_col, text)).join(dropped, list(ROW), "left").drop(*ROW)
    counted = joined.withColumn("_lines", lines)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    rebuilt = F.when(F.col("_dropped").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    return counted.select(
        *[rebuilt.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("_n_dropped"),
    )


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


OP9_SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT k.doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.doc_id
"""
