"""Queries of the single functions, predicates, joins and aggregates that the larger operators are built of, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkmill.functions import text as X
from linkmill.operators import audit, blocking, evaluate, shards, validate
from linkmill.queries import _EXACT, _LIMIT, _MULTI, _NORM, _PT, _SIGNAL_CAP, _TRUTH, _UNDER, EXACT, MULTI, audit_s1, audit_targets, normalized, pairs, part_truth, query, records, sides, table

N, M, T = "WITH " + _NORM, "WITH " + _MULTI, "WITH " + _TRUTH
BOTH = "WITH " + _EXACT + ", " + _PT.strip()


# ---- scalar functions


@query("f9_f11_numbers", N + " SELECT entity_id, array_to_string(nums, '|') AS numbers, nums[1] AS primary_number, array_to_string(list_filter(nums, lambda x: length(x) BETWEEN 4 AND 8), '|') AS postal FROM norm")
def _(spark, d):
    n = X.numbers(F.col("business_address"))
    return records(spark, d).select("entity_id", F.array_join(n, "|").alias("numbers"), F.get(n, 0).alias("primary_number"), F.array_join(X.postal_like(n), "|").alias("postal"))


@query("f4_tokens", N + " SELECT entity_id, array_to_string(nt, '|') AS tokens, len(nt)::BIGINT AS n FROM norm WHERE len(nt) > 0")
def _(spark, d):
    v = X.with_views(records(spark, d), "business_name", "_", need=("tokens",))
    return v.select("entity_id", F.array_join("_tokens", "|").alias("tokens"), F.size("_tokens").cast("long").alias("n")).where("n > 0")


@query("f13_f16_lengths", r"SELECT doc_id, trim(text) AS trimmed, length(text)::BIGINT AS chars, octet_length(encode(text)) <> length(text) AS not_ascii, len(regexp_split_to_array(trim(text), '\s+'))::BIGINT AS n_tokens FROM documents")
def _(spark, d):
    t = X.trim_spaces(F.col("text"))
    return table(spark, d, "documents").select("doc_id", t.alias("trimmed"), F.length("text").cast("long").alias("chars"), (F.octet_length("text") != F.length("text")).alias("not_ascii"), F.when(t.isNotNull(), F.size(F.split(t, r"\s+"))).cast("long").alias("n_tokens"))


@query("f17_split", T + " SELECT s1, len(l)::BIGINT AS n, l[1] AS first_target FROM (SELECT s1, list_sort(list_distinct(l)) AS l FROM tr WHERE l IS NOT NULL)")
def _(spark, d):
    parts = X.split_list(F.col("targets"))
    return audit.target_lists(pairs(spark, d)).select("s1", F.size(parts).cast("long").alias("n"), F.get(parts, 0).alias("first_target"))


@query("f18_p5_prefix_class", N + " SELECT CASE WHEN starts_with(entity_id, 'S2-') THEN 'S2' WHEN starts_with(entity_id, 'S3-') THEN 'S3' ELSE 'INVALID' END AS source, count(*) AS n FROM norm GROUP BY 1")
def _(spark, d):
    return records(spark, d).groupBy(X.target_source(F.col("entity_id")).alias("source")).agg(F.count("*").alias("n"))


@query("f19_p3_regex_predicates", r"SELECT doc_id, regexp_matches(text, '[A-Za-z]') AS latin, regexp_matches(text, '[\x{0900}-\x{097F}]') AS devanagari, regexp_matches(text, '[^\x00-\x7F\x{0900}-\x{0DFF}\x{0F00}-\x{109F}]') AS other FROM documents")
def _(spark, d):
    f = X.script_flags(F.col("text"))
    return table(spark, d, "documents").select("doc_id", *[f[k].alias(k) for k in ("latin", "devanagari", "other")])


@query("f20_f21_labels", "SELECT entity_id, coalesce(nullif(coalesce(name, '<NULL>'), ''), '<EMPTY>') || chr(31) || country AS key FROM (" + N + " SELECT entity_id, name, country FROM norm)")
def _(spark, d):
    return records(spark, d).select("entity_id", X.joint_key(F.col("business_name"), F.col("country")).alias("key"))


@query("p15_safe_ratio", "SELECT p_type, CASE WHEN count(*) FILTER (p_size > 45) > 0 THEN round(count(*) FILTER (p_size > 48) / count(*) FILTER (p_size > 45), 6) END AS part_large FROM part GROUP BY 1")
def _(spark, d):
    large = X.ratio(F.count_if(F.col("p_size") > 48), F.count_if(F.col("p_size") > 45))
    return table(spark, d, "part").groupBy("p_type").agg(F.round(large, 6).alias("part_large"))


# ---- predicates


@query("p6_null_safe_inequality", N + " SELECT count(*) FILTER (name IS DISTINCT FROM country) AS differs, count(*) FILTER (name <> country) AS differs_known FROM norm")
def _(spark, d):
    return audit.differing(records(spark, d), "business_name", "country")


@query("p8_bucket_cap", "WITH " + _EXACT + " SELECT signal::BIGINT AS signal, count(*) AS entries, count(*) FILTER (n <= " + _SIGNAL_CAP.replace('i.', '') + ") AS kept FROM (SELECT DISTINCT country, signal, key, n FROM idx) GROUP BY 1")
def _(spark, d):
    k = blocking.bucket_sizes(blocking.signal_keys(sides(spark, d)[0], EXACT))
    return k.groupBy(F.col("signal").cast("long").alias("signal")).agg(F.count("*").alias("entries"), F.count_if(F.col("bucket_size") <= F.col("cap")).alias("kept"))


@query("p9_df_eligibility", M + " SELECT view, count(*) AS tokens, count(*) FILTER (df <= " + _LIMIT.format('') + ") AS eligible FROM df GROUP BY 1")
def _(spark, d):
    df = blocking.token_frequencies(blocking.record_tokens(sides(spark, d)[0], MULTI))
    most = F.when(F.col("view") == "address", MULTI["address_max_df"]).otherwise(MULTI["name_max_df"])
    return df.groupBy("view").agg(F.count("*").alias("tokens"), F.count_if(F.col("df") <= most).alias("eligible"))


@query("p10_translit_eligibility", N + " SELECT count(*) AS records, count(*) FILTER (eligible) AS eligible FROM norm")
def _(spark, d):
    return normalized(spark, d).agg(F.count("*").alias("records"), F.count_if(blocking.eligible()).alias("eligible"))


@query("p11_p12_masks", "WITH " + _EXACT + " SELECT (exact_hit::INT + 2 * structured_hit::INT)::BIGINT AS retriever_mask, (exact_hit::INT + structured_hit::INT)::BIGINT AS retriever_count, count(*) AS n FROM a GROUP BY ALL")
def _(spark, d):
    return blocking.exact_candidates(*sides(spark, d), EXACT).groupBy("retriever_mask", "retriever_count").agg(F.count("*").alias("n"))


#: Candidate rows with planted faults: ids and countries that are missing, pairs that repeat or conflict, numbers out of range, evidence without its flag.
_FAULTY = """c AS (SELECT CASE WHEN p_partkey % 89 <> 3 THEN 'S2-' || (p_partkey // 2) END AS t, 'S1-' || (p_partkey // 4) AS s1, CASE WHEN p_partkey % 31 = 7 THEN 'S9' ELSE 'S2' END AS src,
  CASE WHEN p_partkey % 83 = 2 THEN ' ' WHEN p_size < 10 THEN 'x' ELSE 'y' END AS country, p_partkey * 40 AS mask, p_size - 3 AS cnt, CASE WHEN p_partkey % 5 <> 2 THEN p_retailprice END AS idf, p_size - 2 AS rank,
  p_partkey % 3 = 0 AS present, CASE WHEN p_partkey % 7 > 3 THEN p_retailprice END AS score FROM part),
g AS (SELECT t, s1, src, min(country) AS own, count(*) AS n FROM c WHERE t IS NOT NULL GROUP BY ALL),
e AS (SELECT c.t, c.s1, c.src, count(*) AS n FROM c JOIN g ON c.t = g.t AND c.s1 = g.s1 AND c.src = g.src AND c.country = g.own GROUP BY ALL),
v0 AS (SELECT t, s1, rule, count(*) AS n FROM (SELECT t, s1, unnest([CASE WHEN t IS NULL THEN 'missing_fields' END, CASE WHEN t IS NOT NULL AND trim(country) = '' THEN 'country_empty' END, CASE WHEN t IS NOT NULL AND src = 'S9' THEN 'unknown_source' END{}]) AS rule FROM c) WHERE rule IS NOT NULL GROUP BY ALL
  UNION ALL SELECT t, s1, 'duplicate_pair', n - 1 FROM e WHERE n > 1 UNION ALL SELECT g.t, g.s1, 'conflicting_country', g.n - e.n FROM g JOIN e USING (t, s1, src) WHERE g.n > e.n)
SELECT t AS target_entity_id, s1 AS candidate_s1_entity_id, rule, sum(n)::BIGINT AS n_rows FROM v0 GROUP BY ALL"""


def faulty(spark, d, **columns):
    key = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.when(key % 89 != 3, F.concat(F.lit("S2-"), F.floor(key / 2))).alias("target_entity_id"), F.concat(F.lit("S1-"), F.floor(key / 4)).alias("candidate_s1_entity_id"), F.when(key % 31 == 7, "S9").otherwise("S2").alias("target_source"),
        F.when(key % 83 == 2, " ").when(F.col("p_size") < 10, "x").otherwise("y").alias("country"), *[F.expr(v).alias(k) for k, v in columns.items()],
    )


@query("p13_v2_artifact_violations", "WITH " + _EXACT + " SELECT count(*) AS n_rows, 0::BIGINT AS misplaced_columns, 2::BIGINT AS mistyped_columns, count(*) FILTER (country <> 'ECONOMY') AS wrong_country, count(*) FILTER (left(target_entity_id, 2) <> 'S2') AS wrong_source, 0::BIGINT AS repeated_pairs FROM a")
def _(spark, d):
    c = blocking.exact_candidates(*sides(spark, d), EXACT)
    # mask and count as they are computed, wider than the artifact's types
    return validate.artifact_violations(c.select(*[f.name for f in validate.EXACT.fields]), validate.EXACT, "ECONOMY", "S2")


@query("v4_candidate_violations", "WITH " + _FAULTY.format(", CASE WHEN t IS NOT NULL AND (mask < 0 OR mask > 65535) THEN 'retriever_mask_range' END, CASE WHEN t IS NOT NULL AND cnt < 0 THEN 'retriever_count_range' END"
  ", CASE WHEN t IS NOT NULL AND present = false AND score IS NOT NULL THEN 'dense_absent_evidence' END, CASE WHEN t IS NOT NULL AND present = false AND score IS NOT NULL THEN 'dense_evidence_not_present' END"))
def _(spark, d):
    return validate.candidate_violations(faulty(spark, d, retriever_mask="p_partkey * 40", retriever_count="p_size - 3", dense_present="p_partkey % 3 = 0", dense_score="IF(p_partkey % 7 > 3, p_retailprice, NULL)"))


@query("v3_multikey_violations", "WITH " + _FAULTY.format(", CASE WHEN t IS NOT NULL AND idf IS NULL THEN 'blocker_sum_idf_numeric' END, CASE WHEN t IS NOT NULL AND rank < 1 THEN 'blocker_rank_range' END"))
def _(spark, d):
    return validate.candidate_violations(faulty(spark, d, blocker_sum_idf="IF(p_partkey % 5 <> 2, p_retailprice, NULL)", blocker_rank="p_size - 2", blocker_hit="true"))


# ---- joins


@query("j2_index_probe", M + " SELECT t.country, t.family, count(*) AS hits FROM mk t JOIN post p ON t.country = p.country AND t.family = p.family AND t.key = p.key WHERE t.src <> 'S1' AND " + _UNDER + " GROUP BY ALL")
def _(spark, d):
    s1, t = sides(spark, d)
    df = blocking.token_frequencies(blocking.record_tokens(s1, MULTI))
    index = blocking.postings(blocking.multikeys(s1, df, MULTI), MULTI, capped=True).select("country", "family", "key")
    return blocking.multikeys(t, df, MULTI).join(index, ["country", "family", "key"]).groupBy("country", "family").agg(F.count("*").alias("hits"))


@query("j3_token_frequency_join", M + " SELECT t.entity_id, t.view, t.token, df FROM tok t JOIN df ON t.country = df.country AND t.view = df.view AND t.token = df.token WHERE t.src <> 'S1' AND (t.view <> 'translit' OR eligible)")
def _(spark, d):
    s1, t = sides(spark, d)
    df = blocking.token_frequencies(blocking.record_tokens(s1, MULTI))
    every = MULTI | {"name_max_df": 1 << 30, "address_max_df": 1 << 30, "max_tokens": 1 << 30}
    return blocking.rare_tokens(blocking.record_tokens(t, MULTI), df, every).select("entity_id", "view", "token", "df")


@query("j6_j7_matched_flags", T + " SELECT entity_id, source, country, entity_id IN (SELECT target FROM p) AS matched FROM t")
def _(spark, d):
    return audit.matched_flags(pairs(spark, d), audit_targets(spark, d))


@query("j8_j16_candidates_in_truth", BOTH + " SELECT a.target_entity_id, a.candidate_s1_entity_id, pt.s1 IS NOT NULL AS is_true FROM a LEFT JOIN pt ON pt.target = a.target_entity_id AND pt.s1 = a.candidate_s1_entity_id")
def _(spark, d):
    return evaluate.in_truth(blocking.exact_candidates(*sides(spark, d), EXACT), part_truth(spark, d))


@query("j15_volume_join", BOTH + " SELECT entity_id, count(a.target_entity_id) AS n FROM norm LEFT JOIN a ON a.target_entity_id = entity_id WHERE src <> 'S1' GROUP BY 1")
def _(spark, d):
    s1, t = sides(spark, d)
    return evaluate.target_volumes(t, blocking.exact_candidates(s1, t, EXACT))


# ---- aggregates, windows, sets


@query("a1_a6_filtered_counts", N + " SELECT country, count(*) FILTER (name IS NULL) AS null_texts, count(*) FILTER (length(name) > 16) AS long_texts, bool_or(name IS NULL) AS any_null, bool_and(coalesce(length(name), 0) > 0) AS all_filled FROM norm GROUP BY country")
def _(spark, d):
    return audit.text_counts(records(spark, d), "business_name", "country", long=16)


@query("a2_a5_group_counts", "SELECT p_type, count(*) AS n, count(DISTINCT p_name) AS n_distinct FROM part GROUP BY p_type ORDER BY n DESC, p_type")
def _(spark, d):
    return audit.group_counts(table(spark, d, "part"), "p_type", "p_name")


@query("a8_a9_quantiles", "SELECT p_type, round(quantile_cont(p_size, 0.95), 6) AS quantile, round(median(p_size), 6) AS middle FROM part GROUP BY 1")
def _(spark, d):
    return evaluate.quantiles(table(spark, d, "part"), "p_size", 0.95, "p_type")


@query("a12_histogram", T + " SELECT n, count(*) AS entities FROM (SELECT s1, count(DISTINCT target) AS n FROM p GROUP BY 1) GROUP BY 1")
def _(spark, d):
    return evaluate.match_histogram(pairs(spark, d))


@query("a16_ordered_list", T + " SELECT s1, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM p GROUP BY 1")
def _(spark, d):
    return audit.target_lists(pairs(spark, d))


@query("a34_a35_share_of_all", "SELECT p_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 6) AS share FROM part GROUP BY ALL")
def _(spark, d):
    return audit.shares(table(spark, d, "part"), "p_type")


@query("w2_truth_dedup", T + " SELECT DISTINCT s1, target, source FROM p")
def _(spark, d):
    return audit.unique_pairs(pairs(spark, d))


@query("w5_shard_ids", N + " SELECT entity_id, country, (row_number() OVER (PARTITION BY country ORDER BY entity_id) - 1) // 100 AS shard FROM norm")
def _(spark, d):
    return shards.shard_ids(records(spark, d).select("entity_id", "country"), "country", "entity_id", 100)


@query("o3_top_candidates", M + " SELECT target_entity_id, candidate_s1_entity_id, blocker_rank FROM b WHERE blocker_rank <= 2")
def _(spark, d):
    c = blocking.top_candidates(blocking.multikey_candidates(*sides(spark, d), MULTI), 2)
    return c.select("target_entity_id", "candidate_s1_entity_id", "blocker_rank")


@query("o5_first_numbers", N + " SELECT entity_id, array_to_string(first_nums, '|') AS numbers FROM norm")
def _(spark, d):
    return blocking.record_tokens(normalized(spark, d), MULTI).select("entity_id", F.array_join("numbers", "|").alias("numbers"))


@query("u1_u2_key_union", "WITH " + _EXACT + " SELECT src, signal::BIGINT AS signal, count(*) AS n FROM keys GROUP BY ALL")
def _(spark, d):
    n = normalized(spark, d)
    k = blocking.signal_keys(n, EXACT)
    return k.groupBy(F.substring("entity_id", 1, 2).alias("src"), F.col("signal").cast("long").alias("signal")).agg(F.count("*").alias("n"))


@query("u4_u6_distinct_minus", "SELECT DISTINCT p_size::BIGINT AS k FROM part EXCEPT SELECT s_nationkey::BIGINT FROM supplier")
def _(spark, d):
    return audit.only_in(table(spark, d, "part").select(F.col("p_size").cast("long").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("k")), "k")


@query("s7_pruned_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 49")
def _(spark, d):
    return table(spark, d, "lineitem").where("l_quantity > 49").select("l_orderkey", "l_quantity")


@query("a25_merged_counts", T + " SELECT s.country, count(*) AS pairs, count(DISTINCT p.s1) AS entities FROM p JOIN s ON s.entity_id = p.s1 GROUP BY 1")
def _(spark, d):
    return audit.matches_by_country(pairs(spark, d), audit_s1(spark, d))


@query("a15_evidence_fold", M + " SELECT target_entity_id, count(*) AS candidates, sum(c)::BIGINT AS keys, min(min_df) AS least_df, round(sum(sum_idf), 5) AS sum_idf FROM b GROUP BY 1")
def _(spark, d):
    return evaluate.evidence(blocking.multikey_candidates(*sides(spark, d), MULTI))