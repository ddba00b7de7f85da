"""Candidate generation: nine equality signals with bucket caps, and rare-token keys with IDF ranking.

Split and country are join keys, never loops. A bucket cap bounds the reference side of each key, so a frequent key can't
multiply; adaptive execution splits what skew is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.config import DEFAULTS

US = "\x1f"
SIGNALS = (
    "exact_name_compact", "exact_name_token_sorted", "exact_name_core", "exact_address_compact", "structured_name_core_number",
    "structured_name_compact_number", "structured_name_core_postal", "structured_name_compact_postal", "structured_name_numeric_signature",
)
FAMILIES = ("rare_name", "name_number", "number_address", "name_address", "address_pair", "translit_name", "translit_name_number")


def _both(a: str, b: str) -> Column:
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((x != "") & (y != ""), F.concat(x, F.lit(US), y))


def signal_keys(records: DataFrame, config: dict = DEFAULTS["exact"]) -> DataFrame:
    """(country, entity_id, signal, key, cap): one pass over the records, no key where a part is empty."""
    one = [F.when(F.col(c) != "", F.col(c)) for c in ("name_compact", "name_token_sorted", "name_core", "address_compact")]
    two = [("name_core", "primary_number"), ("name_compact", "primary_number"), ("name_core", "postal_like_tokens"), ("name_compact", "postal_like_tokens"), ("name_core", "numeric_tokens")]
    keys = one + [_both(a, b) for a, b in two]
    rows = F.array(*[F.struct(F.lit(i + 1).alias("signal"), k.alias("key"), F.lit(config["cap_exact" if i < 4 else "cap_structured"]).alias("cap")) for i, k in enumerate(keys)])
    return records.select("country", "entity_id", F.inline(rows)).where(F.col("key").isNotNull())


def bucket_sizes(keys: DataFrame) -> DataFrame:
    """(country, signal, key, cap, bucket_size): counted before the shuffle, so that no task meets all rows of a hot key."""
    return keys.groupBy("country", "signal", "key").agg(F.max("cap").alias("cap"), F.count("*").alias("bucket_size"))


def within_caps(keys: DataFrame) -> DataFrame:
    """Keys whose buckets are within their cap."""
    kept = bucket_sizes(keys).where("bucket_size <= cap")
    return keys.join(kept.select("country", "signal", "key"), ["country", "signal", "key"], "left_semi")


def exact_candidates(reference: DataFrame, targets: DataFrame, config: dict = DEFAULTS["exact"]) -> DataFrame:
    """One row per pair with a flag for each signal, the family mask and the number of families."""
    s1 = within_caps(signal_keys(reference, config)).withColumnRenamed("entity_id", "candidate_s1_entity_id").drop("cap")
    t = signal_keys(targets, config).withColumnRenamed("entity_id", "target_entity_id").drop("cap")
    pairs = t.join(s1, ["country", "signal", "key"]).groupBy("target_entity_id", "candidate_s1_entity_id", "country")
    flags = [F.bool_or(F.col("signal") == i + 1).alias(s) for i, s in enumerate(SIGNALS)]
    out = pairs.agg(F.bool_or(F.col("signal") <= 4).alias("exact_hit"), F.bool_or(F.col("signal") >= 5).alias("structured_hit"), *flags)
    return with_mask(out).withColumn("target_source", F.substring("target_entity_id", 1, 2))


def with_mask(candidates: DataFrame) -> DataFrame:
    """candidates with the mask of the families that hit and their number."""
    mask = F.when(F.col("exact_hit"), 1).otherwise(0).bitwiseOR(F.when(F.col("structured_hit"), 2).otherwise(0))
    return candidates.withColumn("retriever_mask", mask.cast("long")).withColumn("retriever_count", F.bit_count(F.col("retriever_mask")).cast("long"))


def suppression(reference: DataFrame, targets: DataFrame, config: dict = DEFAULTS["exact"]) -> DataFrame:
    """Per signal: index keys, target probes that hit one, those suppressed by the cap, the largest bucket and its 95th percentile."""
    index = bucket_sizes(signal_keys(reference, config))
    probes = signal_keys(targets, config).groupBy("country", "signal", "key").agg(F.count("*").alias("probes"))
    both = index.join(probes, ["country", "signal", "key"], "left")
    return both.groupBy("signal").agg(
        F.count("*").alias("index_keys"), F.coalesce(F.sum("probes"), F.lit(0)).alias("queries_hitting_key"),
        F.coalesce(F.sum(F.when(F.col("bucket_size") > F.col("cap"), F.col("probes"))), F.lit(0)).alias("suppressed"),
        F.max("bucket_size").alias("largest_bucket"), F.round(F.expr("percentile(bucket_size, 0.95)"), 6).alias("p95_bucket"),
    )


# ---- rare-token keys


def _tokens(x: Column, least: int) -> Column:
    return F.array_distinct(F.filter(F.split(x, r"\s+"), lambda t: F.length(t) >= least))


def _tagged(tag: str, value: str, arrays: dict[str, Column]) -> Column:
    """One array of structs: each element of the arrays with the name of its own."""

    def named(name: str, array: Column) -> Column:
        return F.transform(array, lambda x: F.struct(F.lit(name).alias(tag), x.alias(value)))

    return F.flatten(F.array(*[named(k, v) for k, v in arrays.items()]))


def eligible() -> Column:
    """Whether a record's transliteration says more than its name."""
    return F.coalesce(F.col("name_raw"), F.lit("")).rlike(r"[^\x00-\x7F]") | (F.coalesce("name_transliterated", F.lit("")) != F.coalesce("name_tokens", F.lit("")))


VIEWS = ("name", "address", "translit")


def record_tokens(records: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """(country, entity_id, eligible, name, address, translit, numbers): distinct tokens and first distinct numbers of each record."""
    name = F.when(F.col("name_core") != "", F.col("name_core")).otherwise(F.col("name_tokens"))
    numbers = F.slice(F.array_distinct(F.filter(F.split(F.coalesce("numeric_tokens", F.lit("")), r"\|"), lambda t: t != "")), 1, config["max_numbers"])
    return records.select(
        "country", "entity_id", eligible().alias("eligible"), _tokens(name, config["min_name_token"]).alias("name"), _tokens(F.col("address_normalized"), config["min_address_token"]).alias("address"),
        _tokens(F.col("name_transliterated"), config["min_name_token"]).alias("translit"), numbers.alias("numbers"),
    )


def view_tokens(tokens: DataFrame, *keep: str) -> DataFrame:
    """(country, *keep, view, token): a row per token of each view, transliterated ones of all records."""
    return tokens.select("country", *keep, F.inline(_tagged("view", "token", {v: F.coalesce(F.col(v), F.array().cast("array<string>")) for v in VIEWS})))


def token_frequencies(tokens: DataFrame) -> DataFrame:
    """(country, view, token, df): reference records that hold a token."""
    return view_tokens(tokens).groupBy("country", "view", "token").agg(F.count("*").alias("df"))


def rare_tokens(tokens: DataFrame, frequencies: DataFrame, config: dict = DEFAULTS["multikey"], *keep: str) -> DataFrame:
    """(country, entity_id, *keep, view, token, df, place): each record's rarest tokens that the reference holds and that are rare there.

    Transliterated tokens count only where eligible. Rows are dealt by record once, which the window and what follows it share.
    """
    most = F.when(F.col("view") == "address", config["address_max_df"]).otherwise(config["name_max_df"])
    rows = view_tokens(tokens, "entity_id", "eligible", *keep).where("view <> 'translit' OR eligible").drop("eligible")
    held = rows.join(frequencies, ["country", "view", "token"]).where(F.col("df") <= most).repartition("country", "entity_id")
    place = F.row_number().over(Window.partitionBy("country", "entity_id", "view").orderBy("df", "token"))
    return held.withColumn("place", place).where(F.col("place") <= config["max_tokens"])


def multikeys(records: DataFrame, frequencies: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """(country, entity_id, family, key) of records, by the reference's token frequencies."""
    rows = rare_tokens(record_tokens(records, config), frequencies, config, "numbers").groupBy("country", "entity_id").agg(
        F.first("numbers").alias("numbers"), *[F.array_sort(F.collect_list(F.when(F.col("view") == v, F.col("token")))).alias(v) for v in VIEWS]
    )

    def cross(a: str, b: str) -> Column:
        return F.flatten(F.transform(F.col(a), lambda x: F.transform(F.col(b), lambda y: F.concat(x, F.lit(US), y))))

    pair = F.when(F.size("address") >= 2, F.array(F.array_join(F.slice("address", 1, 2), US))).otherwise(F.array().cast("array<string>"))
    made = (F.col("name"), cross("name", "numbers"), cross("numbers", "address"), cross("name", "address"), pair, F.col("translit"), cross("translit", "numbers"))
    keys = _tagged("family", "key", dict(zip(FAMILIES, made, strict=True)))
    return rows.select("country", "entity_id", F.inline(F.array_distinct(keys)))


def key_frequencies(keys: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """(country, family, key, key_df, cap): reference records that selected a key; counted before the shuffle."""
    caps = F.create_map(*[F.lit(x) for f in FAMILIES for x in (f, config["caps"][f])])
    return keys.groupBy("country", "family", "key").agg(F.count("*").alias("key_df")).withColumn("cap", F.try_element_at(caps, F.col("family")))


def postings(keys: DataFrame, config: dict = DEFAULTS["multikey"], capped: bool = False) -> DataFrame:
    """keys with key_df and cap; if capped, only those whose lists are within their cap."""
    sizes = key_frequencies(keys, config)
    return keys.join(sizes.where("key_df <= cap") if capped else sizes, ["country", "family", "key"])


def multikey_candidates(reference: DataFrame, targets: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """The top_k candidates of each target by summed IDF of shared keys under their caps, then by keys shared, then by id."""
    frequencies = token_frequencies(record_tokens(reference, config))
    index = postings(multikeys(reference, frequencies, config), config, capped=True).withColumnRenamed("entity_id", "candidate_s1_entity_id")
    n = reference.groupBy("country").agg(F.count("*").alias("n"))
    probes = multikeys(targets, frequencies, config).withColumnRenamed("entity_id", "target_entity_id")
    hits = probes.join(index, ["country", "family", "key"]).join(n, "country").withColumn("idf", F.log((F.col("n") + 1) / (F.col("key_df") + 1)))
    # summed in a fixed order, so that reruns agree to the last bit
    total = F.aggregate(F.array_sort(F.collect_list("idf")), F.lit(0.0), lambda a, x: a + x)
    pairs = hits.groupBy("country", "target_entity_id", "candidate_s1_entity_id").agg(
        total.alias("sum_idf"), F.count("*").alias("blocker_signal_count"), F.min("key_df").alias("blocker_min_key_df"),
        *[F.bool_or(F.col("family") == f).alias(f"block_{f}_hit") for f in FAMILIES],
    )
    # rounded, as equal products of other frequencies have sums that differ in the last bit
    order = Window.partitionBy("country", "target_entity_id").orderBy(F.desc(F.round("sum_idf", 9)), F.desc("blocker_signal_count"), "candidate_s1_entity_id")
    out = pairs.withColumn("blocker_rank", F.row_number().over(order)).where(F.col("blocker_rank") <= config["top_k"])
    out = out.withColumn("blocker_hit", F.lit(True)).withColumn("blocker_best_key_df", F.col("blocker_min_key_df"))
    return out.withColumn("blocker_rank", F.col("blocker_rank").cast("long")).withColumn("target_source", F.substring("target_entity_id", 1, 2))


def top_candidates(candidates: DataFrame, k: int) -> DataFrame:
    """Those ranked up to k: a limit that is the feature."""
    return candidates.where(F.col("blocker_rank") <= k)


def multikey_suppression(reference: DataFrame, targets: DataFrame, config: dict = DEFAULTS["multikey"]) -> DataFrame:
    """Per family: keys of the reference, target probes that hit one, those suppressed by the cap, and the largest list and suppressed list."""
    frequencies = token_frequencies(record_tokens(reference, config))
    index = key_frequencies(multikeys(reference, frequencies, config), config)
    probes = multikeys(targets, frequencies, config).groupBy("country", "family", "key").agg(F.count("*").alias("probes"))
    over = F.col("key_df") > F.col("cap")
    return index.join(probes, ["country", "family", "key"], "left").groupBy("family").agg(
        F.count("*").alias("index_keys"), F.coalesce(F.sum("probes"), F.lit(0)).alias("probes_hitting_key"), F.coalesce(F.sum(F.when(over, F.col("probes"))), F.lit(0)).alias("suppressed"),
        F.max("key_df").alias("largest_list"), F.coalesce(F.max(F.when(over & F.col("probes").isNotNull(), F.col("key_df"))), F.lit(0)).alias("largest_suppressed"),
    )
