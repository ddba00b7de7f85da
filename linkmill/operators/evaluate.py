"""Evaluation of candidates against ground truth: recall, recall@K, volume, oracle and entity F-beta."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.functions import text as X

KS = (1, 3, 5, 10, 20, 50)


def fbeta(tp: Column, predicted: Column, truth: Column, beta: float = 0.5) -> Column:
    """1 if there is neither truth nor prediction, 0 without a true positive."""
    p, r = tp / predicted, tp / truth
    return F.when((truth == 0) & (predicted == 0), 1.0).when(tp == 0, 0.0).otherwise((1 + beta * beta) * p * r / (beta * beta * p + r))


def macro_fbeta(universe: DataFrame, truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row: mean over universe (entity_id) of each entity's F-beta; truth and predicted are pairs (s1, target).

    `problems` counts what makes the mean void: repeated ids of the universe, and S1 ids of the pairs that it lacks; an empty
    universe has a null mean.
    """
    ids = universe.select(F.col("entity_id").alias("s1"))
    unknown = truth.select("s1").unionByName(predicted.select("s1")).distinct().join(ids, "s1", "left_anti").agg(F.count("*").alias("unknown"))
    repeated = ids.agg((F.count("*") - F.count_distinct("s1")).alias("repeated"))
    t, p = truth.select("s1", "target").distinct(), predicted.select("s1", "target").distinct()
    rows = t.withColumn("t", F.lit(1)).join(p.withColumn("p", F.lit(1)), ["s1", "target"], "full").groupBy("s1").agg(F.count("t").alias("nt"), F.count("p").alias("np"), F.count(F.expr("t + p")).alias("tp"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = universe.select(F.col("entity_id").alias("s1")).join(rows, "s1", "left").select(fbeta(zero(F.col("tp")), zero(F.col("np")), zero(F.col("nt")), beta).alias("f"))
    mean = out.agg(F.count("*").alias("entities"), F.round(F.avg("f"), 6).alias("macro_f"))
    return mean.crossJoin(unknown.crossJoin(repeated).select((F.col("unknown") + F.col("repeated")).alias("problems")))  # a row each


def exact_recall(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Recall of true pairs (target, s1, source, country) overall and by (country, source)."""
    c = candidates.select(F.col("target_entity_id").alias("target"), F.col("candidate_s1_entity_id").alias("s1"), F.col("target_source").alias("source"), "country", "exact_hit", "structured_hit")
    hit = lambda x: F.coalesce(F.col(x), F.lit(False))
    rows = pairs.dropDuplicates(["s1", "target"]).join(c, ["target", "s1", "source", "country"], "left")
    counts = rows.groupingSets([[], ["country", "source"]], "country", "source").agg(
        F.count("*").alias("pairs"), F.count_if(hit("exact_hit")).alias("exact"), F.count_if(hit("structured_hit")).alias("structured"), F.count_if(hit("exact_hit") | hit("structured_hit")).alias("any_hit"),
        F.count_if(hit("exact_hit") & ~hit("structured_hit")).alias("only_exact"), F.count_if(hit("structured_hit") & ~hit("exact_hit")).alias("only_structured"),
    )
    return counts.withColumn("recall", F.round(X.ratio(F.col("any_hit"), F.col("pairs"), 0.0), 6))


def volume(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates per target, those without one included."""
    rows = target_volumes(targets, candidates)
    cont = [F.round(F.expr(f"percentile(n, {p})"), 6).alias(f"p{k}") for k, p in (("50", 0.5), ("90", 0.9), ("95", 0.95), ("99", 0.99))]
    bins = {"bin_0": F.col("n") == 0, "bin_1": F.col("n") == 1, "bin_2_5": F.col("n").between(2, 5), "bin_6_10": F.col("n").between(6, 10), "bin_over_10": F.col("n") > 10}
    return rows.agg(F.count("*").alias("targets"), F.round(F.avg("n"), 6).alias("mean"), *cont, F.max("n").alias("most"), *[F.count_if(v).alias(k) for k, v in bins.items()])


def truth_hits(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Each true pair with a_hit and b_rank (null if absent)."""
    key = lambda df: df.select(F.col("target_entity_id").alias("target"), F.col("candidate_s1_entity_id").alias("s1"), F.col("target_source").alias("source"), "country", *[c for c in ("blocker_rank",) if c in df.columns])
    ka = key(a).drop("blocker_rank").distinct().withColumn("a_hit", F.lit(True))
    kb = key(b).groupBy("target", "s1", "source", "country").agg(F.min("blocker_rank").alias("b_rank"))
    on = ["target", "s1", "source", "country"]
    return pairs.select(*on).distinct().join(ka, on, "left").join(kb, on, "left").withColumn("a_hit", F.coalesce("a_hit", F.lit(False)))


def union_metrics(hits: DataFrame, k: int = 50) -> DataFrame:
    a, b = F.col("a_hit"), F.coalesce(F.col("b_rank") <= k, F.lit(False))
    return hits.groupingSets([[], ["country", "source"]], "country", "source").agg(
        F.count("*").alias("pairs"), F.count_if(a).alias("a"), F.count_if(b).alias("b"), F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("a_only"), F.count_if(b & ~a).alias("b_only"), F.count_if(a | b).alias("either")
    )


def recall_at(hits: DataFrame, ks=KS) -> DataFrame:
    ranks = F.explode(F.array(*[F.lit(k).cast("long") for k in ks]))
    rows = hits.withColumn("k", ranks).withColumn("b", F.coalesce(F.col("b_rank") <= F.col("k"), F.lit(False)))
    return rows.groupBy("k").agg(F.count("*").alias("pairs"), F.count_if("b").alias("b_hits"), F.count_if(F.col("b") | F.col("a_hit")).alias("union_hits")).withColumn("union_recall", F.round(F.col("union_hits") / F.col("pairs"), 6))


def oracle_macro(universe: DataFrame, hits: DataFrame, k: int = 50) -> DataFrame:
    """Macro F0.5 of a decision that keeps exactly the true pairs among the candidates."""
    n = hits.groupBy("s1").agg(F.count("*").alias("g"), F.count_if(F.col("a_hit") | F.coalesce(F.col("b_rank") <= k, F.lit(False))).alias("r"))
    rows = universe.select(F.col("entity_id").alias("s1")).join(n, "s1", "left")
    g, r = F.coalesce("g", F.lit(0)), F.coalesce("r", F.lit(0))
    score = F.when(g == 0, 1.0).when(r == 0, 0.0).otherwise(1.25 * r / (0.25 * g + r))
    return rows.agg(F.count("*").alias("entities"), F.round(F.avg(score), 6).alias("oracle_f05"))


def union_volume(targets: DataFrame, a: DataFrame, b: DataFrame, ks=(5, 10, 20, 50)) -> DataFrame:
    """Per k: candidates per target that A holds or B ranks up to k."""
    ka = a.select("target_entity_id", "candidate_s1_entity_id", F.lit(True).alias("is_a"), F.lit(None).cast("long").alias("rank"))
    kb = b.select("target_entity_id", "candidate_s1_entity_id", F.lit(False).alias("is_a"), F.col("blocker_rank").alias("rank"))
    pair = ka.unionByName(kb).groupBy("target_entity_id", "candidate_s1_entity_id").agg(F.max("is_a").alias("is_a"), F.min("rank").alias("rank"))
    per = pair.groupBy(F.col("target_entity_id").alias("entity_id")).agg(*[F.count_if(F.col("is_a") | F.coalesce(F.col("rank") <= k, F.lit(False))).alias(f"n{k}") for k in ks])
    rows = targets.select("entity_id").join(per, "entity_id", "left")
    each = rows.select(F.inline(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.coalesce(f"n{k}", F.lit(0)).alias("n")) for k in ks])))
    disc = [F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n)").cast("long").alias(f"p{x}") for x, p in (("50", 0.5), ("95", 0.95))]
    return each.groupBy("k").agg(F.count("*").alias("targets"), F.sum("n").alias("candidates"), *disc, F.max("n").alias("most"))


def histogram_quantile(df: DataFrame, column: str, p: float, *by: str) -> DataFrame:
    """The value at place int((n - 1) p) + 1 of a column in ascending order, from its histogram."""
    h = df.groupBy(*by, column).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*by)
    run = h.withColumn("upto", F.sum("c").over(w.orderBy(column).rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(w))
    return run.where(F.col("upto") >= F.floor((F.col("n") - 1) * p) + 1).groupBy(*by).agg(F.min(column).alias("value"))


def approx_quantile(df: DataFrame, column: str, p: float, *by: str, accuracy: int = 10_000) -> DataFrame:
    """A value whose rank is off by at most 1 / accuracy of the rows from that of the quantile."""
    return df.groupBy(*by).agg(F.percentile_approx(column, p, accuracy).alias("value"))


def quantiles(df: DataFrame, column: str, p: float, *by: str) -> DataFrame:
    """Interpolated quantile and median."""
    return df.groupBy(*by).agg(F.round(F.percentile(column, F.lit(p)), 6).alias("quantile"), F.round(F.median(column), 6).alias("middle"))


def match_histogram(pairs: DataFrame) -> DataFrame:
    """(n, entities): how many S1 records have so many distinct targets."""
    return pairs.groupBy("s1").agg(F.count_distinct("target").alias("n")).groupBy("n").agg(F.count("*").alias("entities"))


def in_truth(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(target_entity_id, candidate_s1_entity_id, is_true)"""
    key = ["target_entity_id", "candidate_s1_entity_id"]
    t = truth.select(F.col("target").alias(key[0]), F.col("s1").alias(key[1])).distinct().withColumn("hit", F.lit(True))
    return candidates.select(*key).join(t, key, "left").select(*key, F.col("hit").isNotNull().alias("is_true"))


def target_volumes(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """(entity_id, n): candidates of each target, 0 included."""
    n = candidates.groupBy(F.col("target_entity_id").alias("entity_id")).agg(F.count("*").alias("n"))
    return targets.select("entity_id").join(n, "entity_id", "left").fillna(0, ["n"])


def evidence(candidates: DataFrame) -> DataFrame:
    """Per pair of a target and a candidate: the retrievers' evidence folded, from rare-token hits."""
    return candidates.groupBy("target_entity_id").agg(
        F.count("*").alias("candidates"), F.sum("blocker_signal_count").alias("keys"), F.min("blocker_min_key_df").alias("least_df"), F.round(F.sum("sum_idf"), 5).alias("sum_idf")
    )
