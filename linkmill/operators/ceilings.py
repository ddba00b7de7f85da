"""Diagnostics of rare-token blocking on true pairs: the family waterfall, what token rules could reach, transliteration.

Truth is pairs (s1, target, source, country). A pair meets its own two records only, by equality joins on their keys; flags
of a pair are one bool_or pivot rather than a join for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.config import DEFAULTS
from linkmill.functions import text as X
from linkmill.operators import blocking
from linkmill.tables import materialise

PAIR = ("s1", "target", "source", "country")
WATERFALL = ("rare_name", "name_number", "number_address", "name_address", "address_pair", "transliterated")
KINDS = ("name", "address", "number", "address_pair", "translit")
#: Document-frequency limits of the rules besides the current one; each of them takes 4 tokens of a record.
RULE_DFS, RULE_TOKENS = (100, 300, 1000), 4


def waterfall(reference: DataFrame, targets: DataFrame, truth: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """One row: true pairs that share a key, that share one under its cap, that lost all to caps; by family, those it
    recovers and those no family before it does. No truth gives a row of zeros."""
    frequencies = blocking.token_frequencies(blocking.record_tokens(reference, config))
    index = blocking.postings(blocking.multikeys(reference, frequencies, config), config).withColumnRenamed("entity_id", "s1")
    probes = blocking.multikeys(targets, frequencies, config).withColumnRenamed("entity_id", "target")
    pairs = truth.select(*PAIR).distinct()
    shared = pairs.join(probes, ["country", "target"]).join(index, ["country", "s1", "family", "key"])
    family = F.when(F.col("family").startswith("translit"), "transliterated").otherwise(F.col("family"))
    under = F.col("key_df") <= F.col("cap")
    flags = shared.groupBy(*PAIR).agg(F.lit(True).alias("raw"), F.bool_or(under).alias("pruned"), *[F.bool_or(under & (family == f)).alias(f) for f in WATERFALL])
    rows = pairs.join(flags, list(PAIR), "left").fillna(False, ["raw", "pruned", *WATERFALL])
    before: Column = F.lit(False)
    counts = [F.count("*").alias("pairs"), F.count_if("raw").alias("raw_covered"), F.count_if("pruned").alias("pruned_recovered"), F.count_if(F.col("raw") & ~F.col("pruned")).alias("lost_all_suppressed")]
    for f in WATERFALL:
        counts += [F.count_if(f).alias(f"{f}_recovered"), F.count_if(F.col(f) & ~before).alias(f"{f}_new")]
        before = before | F.col(f)
    return rows.agg(*counts)


def _rules(config: dict) -> Column:
    rows = [("current", config["name_max_df"], config["address_max_df"], config["max_tokens"]), *[(f"df{n}", n, n, RULE_TOKENS) for n in RULE_DFS]]
    return F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(n).alias("name_df"), F.lit(a).alias("address_df"), F.lit(m).alias("most")) for r, n, a, m in rows])


def view_tokens(records: DataFrame, config: dict) -> DataFrame:
    return blocking.view_tokens(blocking.record_tokens(records, config), "entity_id", "eligible")


def rule_tokens(records: DataFrame, frequencies: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """(country, entity_id, rule, kind, token): what each rule lets a record match by, its address pair and numbers included."""
    held = view_tokens(records, config).where("view <> 'translit' OR eligible").join(frequencies, ["country", "view", "token"])
    by_rule = held.select("country", "entity_id", "view", "token", "df", F.inline(_rules(config))).where(F.expr("df <= if(view = 'address', address_df, name_df)"))
    place = F.row_number().over(Window.partitionBy("country", "entity_id", "view", "rule").orderBy("df", "token"))
    chosen = by_rule.withColumn("place", place).where("place <= most")
    single = chosen.select("country", "entity_id", "rule", F.col("view").alias("kind"), "token")
    two = chosen.where("view = 'address' AND place <= 2").groupBy("country", "entity_id", "rule").agg(F.array_sort(F.collect_list("token")).alias("t")).where(F.size("t") >= 2)
    two = two.select("country", "entity_id", "rule", F.lit("address_pair").alias("kind"), F.array_join("t", blocking.US).alias("token"))
    first = F.array_distinct(F.filter(F.slice(F.split(F.coalesce("numeric_tokens", F.lit("")), r"\|"), 1, 2), lambda t: t != ""))
    numbers = records.select("country", "entity_id", F.explode(first).alias("token"), _rules(config).alias("r")).select("country", "entity_id", F.explode("r.rule").alias("rule"), F.lit("number").alias("kind"), "token")
    return single.unionByName(two).unionByName(numbers)


def _frequencies(reference: DataFrame, config: dict) -> DataFrame:
    return blocking.token_frequencies(blocking.record_tokens(reference, config))


def key_ceiling_pairs(reference: DataFrame, targets: DataFrame, truth: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """Each true pair under each rule, with a flag for each kind of token that both records hold."""
    frequencies = _frequencies(reference, config)
    pairs = truth.select(*PAIR).distinct()
    ours = rule_tokens(reference, frequencies, config).withColumnRenamed("entity_id", "s1")
    theirs = rule_tokens(targets, frequencies, config).withColumnRenamed("entity_id", "target")
    both = pairs.join(ours, ["country", "s1"]).join(theirs, ["country", "target", "rule", "kind", "token"])
    flags = both.groupBy(*PAIR, "rule").agg(*[F.bool_or(F.col("kind") == k).alias(f"{k}_hit") for k in KINDS])
    every = pairs.withColumn("r", _rules(config)).select(*PAIR, F.explode("r.rule").alias("rule"))
    return every.join(flags, [*PAIR, "rule"], "left").fillna(False, [f"{k}_hit" for k in KINDS])


_BY_NAME = "(name_hit OR (number_hit AND address_hit) OR address_pair_hit)"


def ceiling_coverage(pairs: DataFrame) -> DataFrame:
    """Covered true pairs by rule, and by rule, country and source."""
    out = pairs.groupingSets([["rule"], ["rule", "country", "source"]], "rule", "country", "source").agg(F.count("*").alias("gt_pairs"), F.count_if(F.expr(f"{_BY_NAME} OR translit_hit")).alias("covered"))
    return out.withColumn("coverage", F.round(X.ratio(F.col("covered"), F.col("gt_pairs"), 0.0), 6))


def translit_diagnostics(reference: DataFrame, targets: DataFrame, truth: DataFrame, candidates: DataFrame, config: dict = DEFAULTS["multikey"], key_pairs: DataFrame | None = None) -> DataFrame:
    """One row of eight counters, and whether a target's transliteration meets a reference name that no shared key recovers."""
    frequencies = _frequencies(reference, config)
    pairs = key_pairs if key_pairs is not None else key_ceiling_pairs(reference, targets, truth, config)
    current = materialise(pairs.where("rule = 'current'"), "ceiling-pairs")
    keyed = view_tokens(targets, config).where("view = 'translit' AND eligible").join(frequencies.where(F.col("df") <= config["name_max_df"]), ["country", "view", "token"], "left_semi")
    names = rule_tokens(reference, frequencies, config).where("rule = 'current' AND kind = 'name'").select("country", F.col("entity_id").alias("s1"), "token")
    spelt = rule_tokens(targets, frequencies, config).where("rule = 'current' AND kind = 'translit'").select("country", F.col("entity_id").alias("target"), "token")
    crossed = current.join(names, ["country", "s1"]).join(spelt, ["country", "target", "token"]).select(*PAIR, "translit_hit").distinct()
    stored = candidates.where("block_translit_name_hit OR block_translit_name_number_hit").select("country", F.col("target_entity_id").alias("entity_id"))
    rows = [
        targets.where(blocking.eligible()).agg(F.count("*").alias("targets_eligible")),
        keyed.agg(F.count_distinct(F.struct("country", "entity_id")).alias("targets_with_translit_keys")),
        stored.join(targets, ["country", "entity_id"], "left_semi").agg(F.count_distinct(F.struct("country", "entity_id")).alias("stored_targets")),
        current.agg(F.count_if("translit_hit").alias("pairs_sharing"), F.count_if(F.expr(f"translit_hit AND NOT {_BY_NAME}")).alias("pairs_unique"), F.count_if(F.expr("translit_hit AND name_hit")).alias("pairs_sharing_name")),
        crossed.agg(F.count("*").alias("cross_namespace"), F.count_if(F.expr("NOT translit_hit")).alias("cross_namespace_lost"), (F.count_if(F.expr("NOT translit_hit")) > 0).alias("issue")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), rows)  # a row each
