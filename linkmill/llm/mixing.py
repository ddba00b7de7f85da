"""Mixing sources to target weights: Efraimidis-Spirakis sampling to token budgets.

Each source gets a target number of words from its weight, at most `max_epochs` times its size; the excess is shared again
by weight. A target of q whole epochs and a rest takes every document q times, then the documents with the smallest
exponential keys -ln(u) / quality until their sizes reach the rest. u comes from an MD5 of the document id, so reruns agree.

A source's prefix sum never passes through one task: the interval of keys in which the budget ends is cut into CUTS equal
parts, whose sizes are summed on the map side and scanned, again and again until it holds at most EDGE_ROWS rows, whatever the
weights do to the keys; only those rows are ordered. Where all keys of the interval are equal, rows' hashes are cut, and of
equal rows their numbers. Built from DataFrame functions only.

Defined results: a null text has size 0; null sources are one source, ordered last; documents of equal keys are ordered by
a hash of id, text and source; repeated rows are taken one by one in any order; a null quality or one below WEIGHT_FLOOR counts as
that; other columns pass through as `keep` names them, whatever their names; an empty table gives an empty one.
The document at which a budget ends is taken if that brings the source nearer to its target. Sources are few: tables of one
row per source pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.common import WORD, materialise, small

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2.0
#: Documents whose words are about this long on average get the full quality weight; other quality weights are at least the floor.
WORD_LENGTH, WEIGHT_FLOOR = 5.5, 1e-6
#: Parts of an interval, and rows of an interval that one task orders.
CUTS, EDGE_ROWS = 1024, 50_000
#: What orders the rows of a source, one after the other.
ORDER = ("key", "row_key", "number")


def _value(dim: int) -> Column:
    return F.col(ORDER[dim]).cast("double")


def word_length_quality(chars: Column, size: Column) -> Column:
    """The quality weight where none is given: 1 for words of about WORD_LENGTH characters on average, down to 0.25."""
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.abs(chars / F.greatest(size, F.lit(1)) - (WORD_LENGTH + 1)) / 10.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(_source, source_size, n_docs, target) from rows of (_source, source_size, n_docs): one row per source.

    Resharing the excess until no target is above its cap gives min(cap, level * weight) with one level for all, which is
    found by a scan over sources ordered by cap / weight.
    """
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", pick).withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("weight"))
    scan = Window.orderBy("ratio", F.col("_source").asc_nulls_last())
    before = scan.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    )
    # the level of the first source that stays under its cap holds for all
    rows = rows.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "_source", "level"))).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("_source", "source_size", "n_docs", target.alias("target"))


def _ends(rows: DataFrame, rests: DataFrame, edge_rows: int) -> DataFrame:
    """(_source, dim, low, high, before): the interval of each source in which its budget ends, and the size of what lies before.

    dim is the place in ORDER that the interval is of. It is closed at low, and at high too. Sources whose rest is 0 or is never reached have none.
    """
    spark = rows.sparkSession
    # the least and greatest key of a source bound its first interval
    ends = rows.groupBy("_source").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("held"))
    joined = ends.join(rests, ends["_source"].eqNullSafe(rests["_source"])).drop(rests["_source"]).where((F.col("rest") > 0) & (F.col("held") >= F.col("rest")))
    blank = F.lit(None).cast("double")
    now = joined.select("_source", "rest", F.lit(0).alias("dim"), "n", "low", "high", F.lit(0).cast("long").alias("before"), blank.alias("at_key"), blank.alias("at_row_key"))
    now, done = materialise(now, "mix-open"), None
    while True:
        settled = F.col("n") <= edge_rows
        ready = now.where(settled)
        done = ready if done is None else done.unionByName(ready)
        todo = now.where(~settled)
        if not todo.count():
            return done
        # an interval of one value gives way to the next thing in the order
        whole = F.col("low") == F.col("high")
        next_dim = F.when(whole, F.col("dim") + 1).otherwise(F.col("dim"))
        todo = todo.select(
            "_source", "rest", next_dim.alias("dim"), "before", F.when(whole, F.lit(float("-inf"))).otherwise(F.col("low")).alias("low"), F.when(whole, F.lit(float("inf"))).otherwise(F.col("high")).alias("high"),
            F.when(whole & (F.col("dim") == 0), F.col("low")).otherwise(F.col("at_key")).alias("at_key"), F.when(whole & (F.col("dim") == 1), F.col("low")).otherwise(F.col("at_row_key")).alias("at_row_key"),
        )
        todo = small(materialise(todo, "mix-todo"))
        inside = rows.join(todo, rows["_source"].eqNullSafe(todo["_source"])).drop(todo["_source"])
        inside = inside.where((F.col("at_key").isNull() | (F.col("key") == F.col("at_key"))) & (F.col("at_row_key").isNull() | (_value(1) == F.col("at_row_key"))))
        value = F.when(F.col("dim") == 0, _value(0)).when(F.col("dim") == 1, _value(1)).otherwise(_value(2))
        inside = inside.withColumn("value", value).where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        # the first cut of a dimension has no bounds yet: its values are folded into 0..1
        first = F.when(F.col("dim") == 1, (F.col("value") / float(1 << 63) + 1.0) / 2.0).otherwise(F.col("value") / float(1 << 43))
        folded = F.when(F.col("low") == F.lit(float("-inf")), first).otherwise((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")))
        cut = F.least(F.floor(folded * CUTS), F.lit(CUTS - 1).cast("long"))
        group = ["_source", "rest", "dim", "before", "at_key", "at_row_key"]
        parts = inside.groupBy(*group, cut.alias("cut")).agg(F.sum("size").alias("held"), F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        scan = Window.partitionBy("_source").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("held").over(scan), F.lit(0)))
        last = parts.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") >= F.col("rest")))
        now = materialise(last.select("_source", "rest", "dim", "n", "low", "high", "before", "at_key", "at_row_key"), "mix-open")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, keep: tuple[str, ...] = (), quality: Column | str | None = None, edge_rows: int = EDGE_ROWS) -> DataFrame:
    """(row_key, id, _source, size, source_size, target, copies, _row): how often the mix takes each row of docs.

    _row is a struct of the columns `keep`; without any there is no such column. quality is a column of docs, or an expression
    over them, that says each document's weight; word_length_quality stands in.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = [F.struct(*keep).alias("_row")] if keep else []
    held_columns = ["_row"] if keep else []
    given = F.lit(None).cast("double") if quality is None else (F.col(quality) if isinstance(quality, str) else quality).cast("double")
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        F.xxhash64(F.col(id_col), text, F.col(source_col)).alias("row_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.length(text).alias("_chars"),
        given.alias("_quality"),
        *carried,
    )
    digits = F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    known = F.when(F.col("_quality") >= WEIGHT_FLOOR, F.col("_quality")).otherwise(F.lit(WEIGHT_FLOOR))
    w = word_length_quality(F.col("_chars"), F.col("size")) if quality is None else known
    number = F.monotonically_increasing_id().alias("number")
    rows = materialise(rows.select("_id", "_source", "row_key", "size", (-F.log(u) / w).alias("key"), number, *held_columns), "mix-rows")
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", whole).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = materialise(targets.select("_source", "source_size", "target", "epochs", "rest"), "mix-targets")
    ends = _ends(rows, targets.select("_source", "rest"), edge_rows).drop("rest", "n")
    per_source = targets.join(ends, targets["_source"].eqNullSafe(ends["_source"]), "left").drop(ends["_source"])
    per_source = small(materialise(per_source, "mix-sources"))
    ranged = rows.join(per_source, rows["_source"].eqNullSafe(per_source["_source"])).drop(per_source["_source"])
    # -1 before the interval, 0 in it, 1 after it

    def where(value: Column, low: Column, high: Column) -> Column:
        return F.when(value < low, -1).when(value > high, 1).otherwise(0)

    by_key, by_row = where(_value(0), F.col("at_key"), F.col("at_key")), where(_value(1), F.col("at_row_key"), F.col("at_row_key"))
    value = F.when(F.col("dim") == 0, _value(0)).when(F.col("dim") == 1, _value(1)).otherwise(_value(2))
    side = F.when(by_key != 0, by_key).when(by_row != 0, by_row).otherwise(where(value, F.col("low"), F.col("high")))
    ranged = ranged.withColumn("side", F.when(F.col("dim").isNull(), F.when(F.col("rest") > 0, -1).otherwise(1)).otherwise(side))
    inside = Window.partitionBy("_source").orderBy(*[_value(i) for i in range(len(ORDER))]).rowsBetween(Window.unboundedPreceding, -1)
    edge = ranged.where("side = 0").withColumn("prior", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    nearer = (F.col("prior") < F.col("rest")) & (F.col("prior") + F.col("size") - F.col("rest") <= F.col("rest") - F.col("prior"))
    edge = edge.withColumn("picked", F.when(nearer, 1).otherwise(0)).drop("prior")
    others = ranged.where("side <> 0").withColumn("picked", F.when(F.col("side") < 0, 1).otherwise(0))
    return edge.unionByName(others).select("row_key", F.col("_id"), "_source", "size", "source_size", "target", (F.col("epochs") + F.col("picked")).alias("copies"), *held_columns)


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = mix(docs)
    return out.select(F.col("_id").alias("doc_id"), "size", "source_size", F.round("target", 4).alias("target"), (F.col("copies") * F.col("size")).alias("taken"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, length(coalesce(text, '')) AS chars FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source
), r AS (
  SELECT 0 AS step, source, size, w, 1.5 * sum(size) OVER () * w / sum(w) OVER () AS t FROM s
  UNION ALL
  SELECT step + 1, source, size, w, CASE WHEN t >= 2 * size THEN 2 * size ELSE t
    + sum(greatest(t - 2 * size, 0)) OVER () * w / sum(CASE WHEN t < 2 * size THEN w ELSE 0 END) OVER () END FROM r WHERE step < 64
), t AS (
  SELECT source, size, t, CASE WHEN size > 0 THEN floor(round(t / size, 9)) ELSE 0 END AS epochs FROM r WHERE step = 64
), k AS (
  SELECT d.*, t.size AS source_size, t.t AS target, t.epochs, t.t - t.epochs * t.size AS rest,
    -ln((('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
      / greatest(0.25, 1.0 - abs(chars / greatest(d.size, 1) - 6.5) / 10.0) AS key
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM k
)
SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 4) AS target,
  ((epochs + CASE WHEN prior < rest AND prior + size - rest <= rest - prior THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM p
"""
