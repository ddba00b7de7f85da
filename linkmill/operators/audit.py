"""Data audit: contract, missingness, duplicates, scripts, and what the ground truth says of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions import text as X


def missingness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: nulls, empty and blank texts, and the fraction of rows that they are."""
    blank = lambda c: (F.col(c) != "") & (X.trim_spaces(F.col(c)) == "")
    aggs = [F.count("*").alias("n_rows")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}|n"), F.count_if(F.col(c) == "").alias(f"{c}|e"), F.count_if(blank(c)).alias(f"{c}|b")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}|n").alias("n_null"), F.col(f"{c}|e").alias("n_empty"), F.col(f"{c}|b").alias("n_blank")) for c in columns])
    out = df.agg(*aggs).select("n_rows", F.inline(rows))
    return out.withColumn("missing_fraction", F.round(X.ratio(F.col("n_null") + F.col("n_empty") + F.col("n_blank"), F.col("n_rows"), 0.0), 6))


def text_profile(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Lengths and token counts of texts that aren't blank: exact discrete quantiles and maxima."""
    t = X.trim_spaces(F.col(column))
    rows = df.where(t != "").select(*by, F.length(column).alias("len"), F.size(F.split(t, r"\s+")).alias("tok"))
    disc = lambda c, p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})").cast("long")
    names = {"50": 0.5, "90": 0.9, "95": 0.95, "99": 0.99}
    aggs = [disc(c, p).alias(f"{c}_p{k}") for c in ("len", "tok") for k, p in names.items()] + [F.max(c).cast("long").alias(f"{c}_max") for c in ("len", "tok")]
    return rows.groupBy(*by).agg(F.count("*").alias("n_texts"), F.round(F.avg("len"), 6).alias("avg_len"), *aggs)


def label_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(X.label(F.col(column)).alias("label")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def script_profile(df: DataFrame, column: str, *by: str) -> DataFrame:
    return df.groupBy(*by, X.script(F.col(column)).alias("script")).agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """How many key values repeat, by how many extra rows, and how many there are."""
    n = df.groupBy(*key).agg(F.count("*").alias("n"))
    return n.agg(F.count_if(F.col("n") > 1).alias("duplicate_values"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("extra_rows"), F.count("*").alias("distinct_values"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1, target, source) of comma lists; an empty list has no pair."""
    rows = truth.select(F.col("source1_entity_id").alias("s1"), F.explode(F.split(F.coalesce("matched_entity_ids", F.lit("")), r"\Q,\E")).alias("target"))
    return rows.select("s1", X.trim_spaces(F.col("target")).alias("target")).where("target <> ''").withColumn("source", X.target_source(F.col("target")))


def truth_counts(truth: DataFrame) -> DataFrame:
    p = truth_pairs(truth).agg(
        F.count("*").alias("pair_rows"), F.count_distinct(F.struct("s1", "target")).alias("unique_pairs"),
        *[F.count_if(F.col("source") == s).alias(f"pairs_{s.lower()}") for s in ("S2", "S3", "INVALID")],
    )
    t = truth.agg(F.count("*").alias("truth_rows"), F.count_distinct("source1_entity_id").alias("unique_s1"), F.count_if(F.coalesce("matched_entity_ids", F.lit("")) == "").alias("empty_rows"))
    return p.crossJoin(t)  # a row each


def orphans(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs whose S1, S2 or S3 record is absent. targets: (entity_id, source, country)."""
    a = pairs.join(s1, pairs["s1"] == s1["entity_id"], "left_anti").agg(F.count("*").alias("orphan_s1"))
    b = pairs.join(targets, (pairs["target"] == targets["entity_id"]) & (pairs["source"] == targets["source"]), "left_anti")
    return a.crossJoin(b.agg(*[F.count_if(F.col("source") == s).alias(f"orphan_{s.lower()}") for s in ("S2", "S3")]))  # a row each


def country_mismatches(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    a = s1.select(F.col("entity_id").alias("s1"), F.col("country").alias("own"))
    b = targets.select(F.col("entity_id").alias("target"), "source", "country")
    both = pairs.join(a, "s1").join(b, ["target", "source"])
    return both.groupBy("source").agg(F.count("*").alias("pairs"), F.count_if(~F.col("own").eqNullSafe(F.col("country"))).alias("mismatches"))


def ownership(pairs: DataFrame) -> DataFrame:
    owners = pairs.where("source <> 'INVALID'").groupBy("source", "target").agg(F.count_distinct("s1").alias("n"))
    return owners.groupBy("source").agg(
        F.count("*").alias("targets"), F.max("n").alias("max_owners"), F.count_if(F.col("n") == 1).alias("owners_1"), F.count_if(F.col("n") == 2).alias("owners_2"),
        F.count_if(F.col("n") >= 3).alias("owners_3_up"), (F.max("n") <= 1).alias("exclusive"),
    )


def cardinality(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """Matches of each S1 record, overall (null country) and by country; records without one count as 0."""
    n = pairs.where("source <> 'INVALID'").groupBy(F.col("s1").alias("entity_id")).agg(F.count_distinct("target").alias("n"))
    rows = s1.select("entity_id", "country").join(n, "entity_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    bins = [F.count_if(F.col("n") == k).alias(f"bin_{k}") for k in range(5)] + [F.count_if(F.col("n") >= 5).alias("bin_5_up")]
    disc = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)").cast("long").alias(f"p{k}") for k, p in (("90", 0.9), ("95", 0.95), ("99", 0.99))]
    return rows.groupingSets([[], ["country"]], "country").agg(
        F.count("*").alias("entities"), *bins, F.round(F.avg("n"), 6).alias("mean"), F.round(F.median("n"), 6).alias("median"), *disc, F.max("n").alias("most"), F.round(F.avg((F.col("n") == 0).cast("int")), 6).alias("zero_fraction")
    )


def distractors(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    rows = matched_flags(pairs, targets).withColumnRenamed("matched", "hit")
    return rows.groupingSets([["source"], ["source", "country"]], "source", "country").agg(
        F.count_if("hit").alias("matched"), F.count_if(~F.col("hit")).alias("unmatched"), F.count("*").alias("total"), F.round(X.ratio(F.count_if(~F.col("hit")), F.count("*"), 0.0), 6).alias("unmatched_fraction")
    )


def coverage(pairs: DataFrame) -> DataFrame:
    has = pairs.groupBy("s1").agg(F.bool_or(F.col("source") == "S2").alias("s2"), F.bool_or(F.col("source") == "S3").alias("s3"))
    a, b = F.col("s2"), F.col("s3")
    return has.agg(F.count_if(a & b).alias("both_sources"), F.count_if(a & ~b).alias("only_s2"), F.count_if(~a & b).alias("only_s3"))


def id_overlap(a: DataFrame, b: DataFrame, column: str = "entity_id") -> DataFrame:
    return a.select(column).intersect(b.select(column)).agg(F.count("*").alias("n_overlap"))


def id_differences(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Identities that only one side has."""
    missing = a.select(*key).exceptAll(b.select(*key)).withColumn("side", F.lit("missing"))
    return missing.unionByName(b.select(*key).exceptAll(a.select(*key)).withColumn("side", F.lit("extra")))


def invariants(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    o = ownership(pairs).agg(F.coalesce(F.bool_and("exclusive"), F.lit(True)).alias("targets_exclusive"))
    m = country_mismatches(pairs, s1, targets).agg((F.coalesce(F.sum("mismatches"), F.lit(0)) == 0).alias("country_blocking_safe"))
    return o.crossJoin(m)  # a row each


def group_counts(df: DataFrame, by: str, distinct: str) -> DataFrame:
    """Rows and distinct values of each group, the largest first."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_distinct(distinct).alias("n_distinct")).orderBy(F.desc("n"), by)


def shares(df: DataFrame, by: str) -> DataFrame:
    """Rows of each group and their share of all."""
    whole = df.agg(F.count("*").alias("whole"))  # one row
    return df.groupBy(by).agg(F.count("*").alias("n")).crossJoin(F.broadcast(whole)).select(by, "n", F.round(X.ratio(F.col("n"), F.col("whole")), 6).alias("share"))


def distinct_tuples(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct tuples, those with nulls included."""
    return df.agg(F.count_distinct(F.struct(*columns)).alias("n_tuples"))


def differing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows whose columns differ with null as a value, and rows where both are known and differ."""
    return df.agg(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias("differs"), F.count_if(F.col(a) != F.col(b)).alias("differs_known"))


def text_counts(df: DataFrame, text: str, by: str, long: int = 500) -> DataFrame:
    """Per group: null, long and blank texts, whether any is null and whether all have characters."""
    t = F.col(text)
    return df.groupBy(by).agg(
        F.count_if(t.isNull()).alias("null_texts"), F.count_if(F.length(t) > long).alias("long_texts"), F.bool_or(t.isNull()).alias("any_null"), F.bool_and(F.coalesce(F.length(t), F.lit(0)) > 0).alias("all_filled")
    )


def matched_flags(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    """(entity_id, source, country, matched) of each target."""
    hit = pairs.select("source", F.col("target").alias("entity_id")).distinct().withColumn("matched", F.lit(True))
    return targets.join(hit, ["source", "entity_id"], "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def unique_pairs(pairs: DataFrame) -> DataFrame:
    """One row of each (s1, target)."""
    return pairs.dropDuplicates(["s1", "target"])


def target_lists(pairs: DataFrame) -> DataFrame:
    """(s1, targets): distinct targets in order, joined by commas; an S1 record's own matches are few."""
    return pairs.groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set("target")), ",").alias("targets"))


def matches_by_country(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    own = s1.select(F.col("entity_id").alias("s1"), "country")
    return pairs.join(own, "s1").groupBy("country").agg(F.count("*").alias("pairs"), F.count_distinct("s1").alias("entities"))


def only_in(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct values that a has and b hasn't."""
    return a.select(column).subtract(b.select(column))
