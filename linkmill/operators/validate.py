"""Validators as aggregations: each gives one row of counts that must be zero, or a row per broken rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.operators import blocking, normalize

IDS = ("target_entity_id", "candidate_s1_entity_id", "target_source", "country")
#: Retrievers whose evidence a candidate row may carry as NAME_present, NAME_score and NAME_rank.
RETRIEVERS = ("char_name", "char_sorted", "word_name", "address", "reverse", "dense")
BLOCKER_FLAGS = ("blocker_hit", *[f"block_{f}_hit" for f in blocking.FAMILIES])
FLAGS = ("exact_hit", "structured_hit", *BLOCKER_FLAGS, *blocking.SIGNALS)


def _kinds(names: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in names.items()])


NORMALIZED = _kinds({c: T.BooleanType() if c.endswith("_missing") else T.StringType() for c in normalize.COLUMNS})
EXACT = _kinds({c: T.StringType() for c in IDS} | {c: T.BooleanType() for c in ("exact_hit", "structured_hit", *blocking.SIGNALS)} | {"retriever_mask": T.IntegerType(), "retriever_count": T.ShortType()})
MULTIKEY = _kinds(
    {c: T.StringType() for c in IDS} | {c: T.BooleanType() for c in BLOCKER_FLAGS}
    | {"blocker_signal_count": T.ShortType(), "blocker_best_key_df": T.LongType(), "blocker_min_key_df": T.LongType(), "blocker_sum_idf": T.FloatType(), "blocker_rank": T.ShortType()}
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def same_schema(df: DataFrame, schema: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def normalized_violations(df: DataFrame, country: str | None = None) -> DataFrame:
    """One row: bad ids and countries, rows of another country than the one given, null raws written as words, repeated ids."""
    null_word = F.lit(False)
    for c in normalize.COLUMNS[3:11] + normalize.COLUMNS[12:18]:
        raw = "name_raw" if c.startswith("name") else "address_raw"
        null_word = null_word | (F.col(raw).isNull() & F.lower(c).isin("nan", "none", "null"))
    other = ~F.col("country").eqNullSafe(F.lit(country)) if country is not None else F.lit(False)
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(F.coalesce("entity_id", F.lit("")) == "").alias("bad_id"), F.count_if(F.coalesce("country", F.lit("")) == "").alias("bad_country"),
        F.count_if(other).alias("wrong_country"), F.count_if(null_word).alias("null_words"), (F.count("*") - F.count_distinct("entity_id")).alias("repeated_ids"), F.lit(same_schema(df, NORMALIZED)).alias("schema_ok"),
    )


def _row_rules(df: DataFrame, require_known_source: bool) -> dict[str, Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    whole = lambda c: isinstance(kinds[c], T.IntegralType)
    null = lambda c: F.col(c).isNull()
    out = {"country_empty": F.trim("country") == ""}
    if require_known_source:
        out["unknown_source"] = ~F.col("target_source").isin("S2", "S3")
    out |= {f"{c}_type": F.lit(True) for c in IDS[:2] if not (whole(c) or isinstance(kinds[c], T.StringType))}
    out |= {f"{c}_type": ~null(c) for c in FLAGS if c in kinds and not (whole(c) or isinstance(kinds[c], T.BooleanType))}
    for c, low, high in (("retriever_mask", 0, 65_535), ("retriever_count", 0, None), ("blocker_rank", 1, None)):
        if c in kinds:
            right = (F.col(c) >= low) & ((F.col(c) <= high) if high is not None else F.lit(True)) if whole(c) else F.lit(False)
            out[f"{c}_range"] = ~F.coalesce(right, F.lit(False))
    if "blocker_sum_idf" in kinds:
        out["blocker_sum_idf_numeric"] = null("blocker_sum_idf") if isinstance(kinds["blocker_sum_idf"], T.NumericType) else F.lit(True)
    for r in RETRIEVERS:
        present, score, rank = (F.col(f"{r}_{x}") if f"{r}_{x}" in kinds else F.lit(None) for x in ("present", "score", "rank"))
        if not any(f"{r}_{x}" in kinds for x in ("score", "rank")):
            continue
        evidence = score.isNotNull() | rank.isNotNull()
        shown = present.cast("boolean")
        out[f"{r}_absent_evidence"] = F.coalesce(~shown, F.lit(False)) & evidence
        out[f"{r}_evidence_not_present"] = ~F.coalesce(shown, F.lit(False)) & evidence
        if f"{r}_score" in kinds and not isinstance(kinds[f"{r}_score"], T.NumericType):
            out[f"{r}_score_numeric"] = score.isNotNull()
        if f"{r}_rank" in kinds:
            out[f"{r}_rank_range"] = F.coalesce(rank < 1, F.lit(False)) if whole(f"{r}_rank") else rank.isNotNull()
    return out


def candidate_violations(df: DataFrame, require_known_source: bool = True) -> DataFrame:
    """(target_entity_id, candidate_s1_entity_id, rule, n_rows) for each broken rule of candidate rows.

    A row without one of the four ids breaks `missing_fields` and is judged no further. Of the rows of one pair and source,
    one of the first country by code point is the pair's own; further ones of that country are duplicates, those of other
    countries conflict with it. Rows are counted before the shuffle, so a pair held by many rows is no hot spot.
    """
    null = F.lit(False)
    for c in IDS:
        null = null | F.col(c).isNull()
    pair = ("target_entity_id", "candidate_s1_entity_id")
    rules = {"missing_fields": null} | {k: ~null & F.coalesce(v, F.lit(True)) for k, v in _row_rules(df, require_known_source).items()}
    held = F.filter(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("broken")) for k, v in rules.items()]), lambda x: x["broken"])
    single = df.select(*pair, F.inline(held)).groupBy(*pair, "rule").agg(F.count("*").alias("n_rows"))
    counted = df.where(~null).groupBy(*pair, "target_source", "country").agg(F.count("*").alias("n"))
    by_pair = counted.groupBy(*pair, "target_source").agg(F.min_by("n", "country").alias("own"), F.sum("n").alias("all"))
    twice = F.array(F.struct(F.lit("duplicate_pair").alias("rule"), (F.col("own") - 1).alias("n_rows")), F.struct(F.lit("conflicting_country").alias("rule"), (F.col("all") - F.col("own")).alias("n_rows")))
    repeated = by_pair.select(*pair, F.inline(twice)).where("n_rows > 0").groupBy(*pair, "rule").agg(F.sum("n_rows").alias("n_rows"))
    return single.unionByName(repeated)


def partition_violations(df: DataFrame, country: str | None = None, source: str | None = None) -> DataFrame:
    return df.agg(
        F.count_if(~F.col("country").eqNullSafe(F.lit(country)) if country is not None else F.lit(False)).alias("wrong_country"),
        F.count_if(~F.col("target_source").eqNullSafe(F.lit(source)) if source is not None else F.lit(False)).alias("wrong_source"),
        (F.count("*") - F.count_distinct(F.struct("target_entity_id", "candidate_s1_entity_id"))).alias("repeated_pairs"),
    )


def artifact_violations(df: DataFrame, schema: T.StructType, country: str | None = None, source: str | None = None) -> DataFrame:
    """One row: rows, columns that aren't in their place or of their type, and partition_violations."""
    there = [(f.name, f.dataType) for f in df.schema.fields]
    wanted = [(f.name, f.dataType) for f in schema.fields]
    misplaced = sum(1 for i, (n, _) in enumerate(wanted) if i >= len(there) or there[i][0] != n)
    mistyped = sum(1 for n, t in wanted if dict(there).get(n) != t)
    rows = df.agg(F.count("*").alias("n_rows")).withColumn("misplaced_columns", F.lit(misplaced).cast("long")).withColumn("mistyped_columns", F.lit(mistyped).cast("long"))
    return rows.crossJoin(partition_violations(df, country, source))  # a row each


def unresolved_targets(pairs: DataFrame, targets: DataFrame) -> DataFrame:
    return pairs.join(targets, pairs["target"] == targets["entity_id"], "left_anti").select("s1", "target")


def inventory(normalized: DataFrame, expected: dict | None = None) -> DataFrame:
    """(split, source, country, n_rows, repeated_ids, expected_rows, ok): rows of each partition against those expected.

    expected maps split, source and country to rows; without it every partition is taken as it is. Partitions that are only
    expected count 0 rows. Ids that repeat within a split and source are shown at each of their countries.
    """
    ids = normalized.groupBy("split", "source", "country", "entity_id").agg(F.count("*").alias("n"))
    spread = ids.groupBy("split", "source", "entity_id").agg(F.sum("n").alias("all"), F.collect_list(F.struct("country", "n")).alias("held"))
    found = spread.select("split", "source", "all", F.inline("held")).groupBy("split", "source", "country").agg(F.sum("n").alias("n_rows"), F.count_if(F.col("all") > 1).alias("repeated_ids"))
    if expected is None:
        return found.withColumn("expected_rows", F.col("n_rows")).withColumn("ok", F.col("repeated_ids") == 0)
    rows = [(s, o, c, n) for s, sources in expected.items() for o, countries in sources.items() for c, n in countries.items()]
    wanted = normalized.sparkSession.createDataFrame(rows, "split string, source string, country string, expected_rows long")
    out = found.join(wanted, ["split", "source", "country"], "full").fillna(0, ["n_rows", "repeated_ids", "expected_rows"])
    return out.withColumn("ok", (F.col("n_rows") == F.col("expected_rows")) & (F.col("repeated_ids") == 0))


def shard_differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """(split, source, country, side): partitions that only one of two inventories holds."""
    key = ["split", "source", "country"]
    a, b = one.select(*key).distinct(), other.select(*key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("missing")).unionByName(b.exceptAll(a).withColumn("side", F.lit("extra")))
