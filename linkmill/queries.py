"""

Stand-ins, all over whole tables: records are `part`, dealt to S1, S2 and S3 by key, with names that have legal words, accents or
Cyrillic letters, or are missing; their truth is which agree on type, name and size. The audit's S1 is `customer`, its targets are
the orders of `lineitem`, and its ground truth lists what customers ordered and did in `orders` and `events`, which names some
records that the sources don't have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.config import DEFAULTS
from linkmill.functions import text as X
from linkmill.operators import audit, blocking, ceilings, evaluate, normalize, validate
from linkmill.sources import readers
from linkmill.tables import materialise

QUERIES: dict = {}
SQL: dict[str, str] = {}
EXACT, MULTI = DEFAULTS["exact"], DEFAULTS["multikey"]


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return readers.parquet(spark, f"{d}/{name}.parquet")


# ---- stand-ins


LATIN, CYRILLIC = "abvgdeziklmnoprstuf", "абвгдезиклмнопрстуф"


def part_names() -> Column:
    k, n = F.col("p_partkey"), F.col("p_name")
    kinds = (F.concat(n, F.lit(" Company")), F.translate(n, LATIN, CYRILLIC), n, F.concat(n, F.lit(" S.A.")), F.translate(n, "oei", "öéî"), F.concat(n, F.lit(" Pvt. Ltd")))
    spelt = F.element_at(F.array(*kinds), (F.floor(k / 3) % 6 + 1).cast("int"))
    return F.when(k % 97 == 6, "  ").when(k % 97 != 5, spelt)


def records(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    key = F.col("p_partkey")
    src = F.concat(F.lit("S"), (key % 3 + 1).cast("string"))
    address = F.format_string("%s %s, Dock%s Gate%s %s", "p_brand", F.col("p_size").cast("string"), (key % 211).cast("string"), F.col("p_size").cast("string"), (key % 1009 + 10_000).cast("string"))
    return p.select(F.concat(src, F.lit("-"), key).alias("entity_id"), part_names().alias("business_name"), address.alias("business_address"), F.col("p_type").alias("country"), src.alias("src"))


def normalized(spark, d) -> DataFrame:
    return normalize.normalize(records(spark, d))


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """S1 and the targets, normalized once."""
    n = materialise(normalized(spark, d), "normalized")
    return n.where("src = 'S1'"), n.where("src <> 'S1'")


def part_truth(spark, d) -> DataFrame:
    """Pairs of part records that agree on country, name and size."""
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_name", "p_size")
    a = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("S1-"), "p_partkey").alias("s1"), "p_type", "p_name", "p_size")
    k = F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"))
    b = p.where("p_partkey % 3 > 0").select(F.concat(k, F.lit("-"), "p_partkey").alias("target"), k.alias("source"), "p_type", "p_name", "p_size")
    return a.join(b, ["p_type", "p_name", "p_size"]).select("s1", "target", "source", F.col("p_type").alias("country"))


def truth(spark, d) -> DataFrame:
    kind = F.when(F.col("o_orderkey") % 97 == 0, "X-").otherwise("S2-")
    o = table(spark, d, "orders").select((F.col("o_custkey") + 10).alias("k"), F.concat(kind, "o_orderkey").alias("t"))
    e = table(spark, d, "events").select(F.col("user_id").alias("k"), F.concat(F.lit("S3-"), F.floor(F.col("event_id") / 3)).alias("t"))
    lists = o.unionByName(e).groupBy("k").agg(F.array_join(F.array_sort(F.collect_list("t")), ",").alias("matched"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return c.join(lists, "k", "full").select(F.concat(F.lit("S1-"), "k").alias("source1_entity_id"), F.coalesce("matched", F.lit("")).alias("matched_entity_ids"))


def audit_s1(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(F.concat(F.lit("S1-"), "c_custkey").alias("entity_id"), F.col("c_nationkey").cast("string").alias("country"))


def audit_targets(spark, d) -> DataFrame:
    held = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    o = held.join(table(spark, d, "orders"), "o_orderkey").join(table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    country = F.when(F.col("o_orderkey") % 11 == 0, "x").otherwise(F.col("c_nationkey").cast("string"))
    one = lambda s: o.select(F.concat(F.lit(f"{s}-"), "o_orderkey").alias("entity_id"), F.lit(s).alias("source"), country.alias("country"))
    return one("S2").unionByName(one("S3"))


def _cap(column: str, caps: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{f}' THEN {n}" for f, n in caps.items()) + " END"


_SIGNAL_CAP = f"CASE WHEN i.signal <= 4 THEN {EXACT['cap_exact']} ELSE {EXACT['cap_structured']} END"
_NORM = f"""
n0 AS (SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, 'S' || (p_partkey % 3 + 1) AS src, p_type AS country,
  CASE WHEN p_partkey % 97 = 5 THEN NULL WHEN p_partkey % 97 = 6 THEN '  ' ELSE CASE (p_partkey // 3) % 6 WHEN 0 THEN p_name || ' Company' WHEN 1 THEN translate(p_name, '{LATIN}', '{CYRILLIC}')
    WHEN 2 THEN p_name WHEN 3 THEN p_name || ' S.A.' WHEN 4 THEN translate(p_name, 'oei', 'öéî') ELSE p_name || ' Pvt. Ltd' END END AS name,
  p_brand || ' ' || p_size || ', Dock' || (p_partkey % 211) || ' Gate' || p_size || ' ' || (p_partkey % 1009 + 10000) AS addr FROM part),
n1 AS (SELECT *, regexp_extract_all(strip_accents(lower(coalesce(name, ''))), '[\\p{{L}}\\p{{N}}]+') AS nt, regexp_extract_all(lower(addr), '[a-z0-9]+') AS adt FROM n0),
n2 AS (SELECT *, coalesce(array_to_string(nt, ''), '') AS compact, coalesce(array_to_string(nt, ' '), '') AS tokens, coalesce(array_to_string(list_sort(nt), ' '), '') AS sorted, array_to_string(adt, '') AS ac, array_to_string(adt, ' ') AS an,
  regexp_extract_all(array_to_string(adt, ' '), '[0-9]+') AS nums FROM n1),
norm AS (SELECT *, regexp_replace(tokens, '( (company|s a|pvt|ltd))+$', '') AS core, translate(tokens, '{CYRILLIC}', '{LATIN}') AS translit, array_to_string(list_filter(nums, lambda x: length(x) BETWEEN 4 AND 8), '|') AS postal,
  regexp_matches(coalesce(name, ''), '[^\\x00-\\x7F]') AS eligible, list_concat(nums[1:1], list_filter(nums, lambda x: x <> nums[1])[1:1]) AS first_nums FROM n2)"""
_KEYS = _NORM + """,
k0 AS (
  SELECT src, country, entity_id, 1 AS signal, compact AS key FROM norm UNION ALL SELECT src, country, entity_id, 2, sorted FROM norm UNION ALL SELECT src, country, entity_id, 3, core FROM norm
  UNION ALL SELECT src, country, entity_id, 4, ac FROM norm UNION ALL SELECT src, country, entity_id, 5, nullif(core, '') || chr(31) || nums[1] FROM norm UNION ALL SELECT src, country, entity_id, 6, nullif(compact, '') || chr(31) || nums[1] FROM norm
  UNION ALL SELECT src, country, entity_id, 7, nullif(core, '') || chr(31) || nullif(postal, '') FROM norm UNION ALL SELECT src, country, entity_id, 8, nullif(compact, '') || chr(31) || nullif(postal, '') FROM norm
  UNION ALL SELECT src, country, entity_id, 9, nullif(core, '') || chr(31) || array_to_string(nums, '|') FROM norm WHERE len(nums) > 0),
keys AS (SELECT * FROM k0 WHERE key IS NOT NULL AND key <> ''),
idx AS (SELECT *, count(*) OVER (PARTITION BY country, signal, key) AS n FROM keys WHERE src = 'S1')"""
_EXACT = _KEYS + """,
a AS (SELECT t.entity_id AS target_entity_id, i.entity_id AS candidate_s1_entity_id, t.country, bool_or(t.signal <= 4) AS exact_hit, bool_or(t.signal >= 5) AS structured_hit, """ + ", ".join(
    f"bool_or(t.signal = {i + 1}) AS {s}" for i, s in enumerate(blocking.SIGNALS)
) + f""" FROM keys t JOIN idx i ON t.country = i.country AND t.signal = i.signal AND t.key = i.key WHERE t.src <> 'S1' AND i.n <= {_SIGNAL_CAP} GROUP BY ALL)"""
_LIMIT = f"CASE WHEN {{}}view = 'address' THEN {MULTI['address_max_df']} ELSE {MULTI['name_max_df']} END"
_UNDER = "p.n <= " + _cap("p.family", MULTI["caps"])
_MULTI = _NORM + f""",
tok AS (SELECT src, country, entity_id, eligible, 'name' AS view, unnest(list_distinct(list_filter(string_split(CASE WHEN core <> '' THEN core ELSE tokens END, ' '), lambda x: length(x) >= {MULTI['min_name_token']}))) AS token FROM norm
  UNION ALL SELECT src, country, entity_id, eligible, 'address', unnest(list_distinct(list_filter(adt, lambda x: length(x) >= {MULTI['min_address_token']}))) FROM norm
  UNION ALL SELECT src, country, entity_id, eligible, 'translit', unnest(list_distinct(list_filter(string_split(translit, ' '), lambda x: length(x) >= {MULTI['min_name_token']}))) FROM norm),
df AS (SELECT country, view, token, count(*) AS df FROM tok WHERE src = 'S1' GROUP BY ALL),
sel AS (SELECT * FROM (SELECT t.*, df, row_number() OVER (PARTITION BY t.country, entity_id, t.view ORDER BY df, t.token) AS rn FROM tok t JOIN df ON t.country = df.country AND t.view = df.view AND t.token = df.token
  WHERE df <= {_LIMIT.format('t.')} AND (t.view <> 'translit' OR eligible)) WHERE rn <= {MULTI['max_tokens']}),
num AS (SELECT entity_id, unnest(first_nums) AS num FROM norm),
mk AS (
  SELECT src, country, entity_id, 'rare_name' AS family, token AS key FROM sel WHERE view = 'name'
  UNION SELECT s.src, s.country, s.entity_id, 'name_number', token || chr(31) || num FROM sel s JOIN num ON s.entity_id = num.entity_id WHERE view = 'name'
  UNION SELECT s.src, s.country, s.entity_id, 'number_address', num || chr(31) || token FROM sel s JOIN num ON s.entity_id = num.entity_id WHERE view = 'address'
  UNION SELECT a.src, a.country, a.entity_id, 'name_address', a.token || chr(31) || b.token FROM sel a JOIN sel b ON a.entity_id = b.entity_id WHERE a.view = 'name' AND b.view = 'address'
  UNION SELECT src, country, entity_id, 'address_pair', string_agg(token, chr(31) ORDER BY token) FROM sel WHERE view = 'address' GROUP BY src, country, entity_id HAVING count(*) >= 2
  UNION SELECT src, country, entity_id, 'translit_name', token FROM sel WHERE view = 'translit'
  UNION SELECT s.src, s.country, s.entity_id, 'translit_name_number', token || chr(31) || num FROM sel s JOIN num ON s.entity_id = num.entity_id WHERE view = 'translit'),
post AS (SELECT *, count(*) OVER (PARTITION BY country, family, key) AS n FROM mk WHERE src = 'S1'),
cnt AS (SELECT country, count(*) AS total FROM norm WHERE src = 'S1' GROUP BY country),
b0 AS (SELECT t.country, t.entity_id AS target_entity_id, p.entity_id AS candidate_s1_entity_id, sum(ln((total + 1) / (n + 1)) ORDER BY n DESC) AS sum_idf, count(*) AS c, min(n) AS min_df, """ + ", ".join(
    f"bool_or(t.family = '{f}') AS block_{f}_hit" for f in blocking.FAMILIES
) + f"""
  FROM mk t JOIN post p ON t.country = p.country AND t.family = p.family AND t.key = p.key JOIN cnt ON cnt.country = t.country WHERE t.src <> 'S1' AND {_UNDER} GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY country, target_entity_id ORDER BY round(sum_idf, 9) DESC, c DESC, candidate_s1_entity_id) AS blocker_rank FROM b0 QUALIFY blocker_rank <= {MULTI['top_k']})"""
_PT = """
pt AS (SELECT 'S1-' || a.p_partkey AS s1, 'S' || (b.p_partkey % 3 + 1) || '-' || b.p_partkey AS target, 'S' || (b.p_partkey % 3 + 1) AS source, a.p_type AS country
  FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_name = b.p_name AND a.p_size = b.p_size WHERE a.p_partkey % 3 = 0 AND b.p_partkey % 3 > 0)"""
_HITS = _EXACT + ", " + _MULTI.replace(_NORM + ",", "").strip() + ", " + _PT.strip() + """,
h AS (SELECT pt.*, a.target_entity_id IS NOT NULL AS a_hit, b.blocker_rank AS b_rank FROM pt LEFT JOIN a ON a.target_entity_id = pt.target AND a.candidate_s1_entity_id = pt.s1 LEFT JOIN b ON b.target_entity_id = pt.target AND b.candidate_s1_entity_id = pt.s1)"""
_TRUTH = """
tp AS (SELECT o_custkey + 10 AS k, CASE WHEN o_orderkey % 97 = 0 THEN 'X-' ELSE 'S2-' END || o_orderkey AS t FROM orders UNION ALL SELECT user_id, 'S3-' || (event_id // 3) FROM events),
tr AS (SELECT 'S1-' || coalesce(c_custkey, k) AS s1, l FROM customer FULL JOIN (SELECT k, list(t) AS l FROM tp GROUP BY 1) ON k = c_custkey),
p AS (SELECT s1, target, CASE WHEN left(target, 2) IN ('S2', 'S3') THEN left(target, 2) ELSE 'INVALID' END AS source FROM (SELECT s1, unnest(l) AS target FROM tr)),
s AS (SELECT 'S1-' || c_custkey AS entity_id, c_nationkey::VARCHAR AS country FROM customer),
oc AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE c_nationkey::VARCHAR END AS country FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
t AS (SELECT 'S2-' || k AS entity_id, 'S2' AS source, country FROM oc UNION ALL SELECT 'S3-' || k, 'S3', country FROM oc)"""


def pairs(spark, d) -> DataFrame:
    return audit.truth_pairs(truth(spark, d))


# ---- scans and selections


@query("s12_source_union", "WITH " + _TRUTH + " SELECT source, count(*) AS n FROM t GROUP BY source")
def _(spark, d):
    return audit_targets(spark, d).withColumn("source", X.target_source(F.col("entity_id"))).groupBy("source").agg(F.count("*").alias("n"))


@query("s13_input_selection", "SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, p_type AS country FROM part WHERE p_partkey % 3 = 1 AND p_type IN ('ECONOMY', 'PROMO')")
def _(spark, d):
    return readers.select_inputs(records(spark, d), src=["S2"], country=["ECONOMY", "PROMO"]).select("entity_id", "country")


# ---- audit


@query("p1_missingness", """SELECT 'text' AS column_name, count(*) AS n_rows, count(*) FILTER (text IS NULL) AS n_null, count(*) FILTER (text = '') AS n_empty, count(*) FILTER (text <> '' AND trim(text) = '') AS n_blank,
  round((count(*) FILTER (text IS NULL) + count(*) FILTER (text = '') + count(*) FILTER (text <> '' AND trim(text) = '')) / count(*), 6) AS missing_fraction FROM documents""")
def _(spark, d):
    return audit.missingness(table(spark, d, "documents"), ["text"])


@query("p2_label_counts", "SELECT CASE WHEN lang IS NULL THEN '<NULL>' WHEN lang = '' THEN '<EMPTY>' WHEN trim(lang) = '' THEN '<WHITESPACE>' ELSE lang END AS label, count(*) AS n FROM documents GROUP BY 1")
def _(spark, d):
    return audit.label_counts(table(spark, d, "documents"), "lang")


@query("p4_script_classes", r"""WITH f AS (SELECT lang, text, regexp_matches(text, '[A-Za-z]')::INT AS l, regexp_matches(text, '[\x{0900}-\x{097F}]')::INT AS dv, regexp_matches(text, '[\x{0980}-\x{0DFF}\x{0F00}-\x{109F}]')::INT AS oi,
  regexp_matches(text, '[^\x00-\x7F\x{0900}-\x{0DFF}\x{0F00}-\x{109F}]')::INT AS ot FROM documents)
SELECT lang, CASE WHEN text IS NULL OR trim(text) = '' THEN 'empty' WHEN l + dv + oi + ot > 1 THEN 'mixed' WHEN dv = 1 THEN 'devanagari' WHEN oi = 1 THEN 'other_indic' WHEN l = 1 THEN 'latin' ELSE 'other' END AS script, count(*) AS n FROM f GROUP BY ALL""")
def _(spark, d):
    return audit.script_profile(table(spark, d, "documents"), "text", "lang")


@query("a7_text_quantiles", r"""WITH x AS (SELECT lang, length(text) AS len, len(regexp_split_to_array(trim(text), '\s+')) AS tok FROM documents WHERE trim(text) <> '')
SELECT lang, count(*) AS n_texts, round(avg(len), 6) AS avg_len, """ + ", ".join(f"quantile_disc({c}, {p})::BIGINT AS {c}_p{k}" for c in ("len", "tok") for k, p in (("50", .5), ("90", .9), ("95", .95), ("99", .99))) + ", max(len)::BIGINT AS len_max, max(tok)::BIGINT AS tok_max FROM x GROUP BY lang")
def _(spark, d):
    return audit.text_profile(table(spark, d, "documents"), "text", "lang")


@query("a4_duplicates", "SELECT (count(*) FILTER (n > 1))::BIGINT AS duplicate_values, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS extra_rows, count(*) AS distinct_values FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)")
def _(spark, d):
    return audit.duplicates(table(spark, d, "part"), "p_name")


@query("a3_distinct_tuples", "WITH " + _NORM + " SELECT count(DISTINCT (country, name)) AS n_tuples FROM norm")
def _(spark, d):
    return audit.distinct_tuples(records(spark, d), "country", "business_name")


@query("j12_truth_pairs", "WITH " + _TRUTH + " SELECT * FROM p")
def _(spark, d):
    return pairs(spark, d)


@query("a36_truth_counts", "WITH " + _TRUTH + """, u AS (SELECT count(*) AS pair_rows, count(DISTINCT (s1, target)) AS unique_pairs, (count(*) FILTER (source = 'S2')) AS pairs_s2, (count(*) FILTER (source = 'S3')) AS pairs_s3, (count(*) FILTER (source = 'INVALID')) AS pairs_invalid FROM p)
SELECT u.*, (SELECT count(*) FROM tr) AS truth_rows, (SELECT count(DISTINCT s1) FROM tr) AS unique_s1, (SELECT count(*) FROM tr WHERE l IS NULL) AS empty_rows FROM u""")
def _(spark, d):
    return audit.truth_counts(truth(spark, d))


@query("j4_orphans", "WITH " + _TRUTH + " SELECT (SELECT count(*) FROM p WHERE s1 NOT IN (SELECT entity_id FROM s)) AS orphan_s1, (SELECT count(*) FROM p WHERE source = 'S2' AND target NOT IN (SELECT entity_id FROM t)) AS orphan_s2, (SELECT count(*) FROM p WHERE source = 'S3' AND target NOT IN (SELECT entity_id FROM t)) AS orphan_s3")
def _(spark, d):
    return audit.orphans(pairs(spark, d), audit_s1(spark, d), audit_targets(spark, d))


@query("j5_country_mismatches", "WITH " + _TRUTH + " SELECT p.source, count(*) AS pairs, count(*) FILTER (s.country IS DISTINCT FROM t.country) AS mismatches FROM p JOIN s ON p.s1 = s.entity_id JOIN t ON t.entity_id = p.target GROUP BY 1")
def _(spark, d):
    return audit.country_mismatches(pairs(spark, d), audit_s1(spark, d), audit_targets(spark, d))


@query("a17_ownership", "WITH " + _TRUTH + " SELECT source, count(*) AS targets, max(n) AS max_owners, count(*) FILTER (n = 1) AS owners_1, count(*) FILTER (n = 2) AS owners_2, count(*) FILTER (n >= 3) AS owners_3_up, max(n) <= 1 AS exclusive FROM (SELECT source, target, count(DISTINCT s1) AS n FROM p WHERE source <> 'INVALID' GROUP BY ALL) GROUP BY 1")
def _(spark, d):
    return audit.ownership(pairs(spark, d))


@query("a18_cardinality", "WITH " + _TRUTH + """, x AS (SELECT s.entity_id, s.country, count(DISTINCT p.target) AS n FROM s LEFT JOIN p ON p.s1 = s.entity_id AND p.source <> 'INVALID' GROUP BY ALL)
SELECT country, count(*) AS entities, """ + ", ".join(f"count(*) FILTER (n = {k}) AS bin_{k}" for k in range(5)) + """, count(*) FILTER (n >= 5) AS bin_5_up, round(avg(n), 6) AS mean, round(median(n), 6) AS median,
  quantile_disc(n, 0.9) AS p90, quantile_disc(n, 0.95) AS p95, quantile_disc(n, 0.99) AS p99, max(n) AS most, round(avg((n = 0)::INT), 6) AS zero_fraction FROM x GROUP BY GROUPING SETS ((), (country))""")
def _(spark, d):
    return audit.cardinality(pairs(spark, d), audit_s1(spark, d))


@query("a19_distractors", "WITH " + _TRUTH + """, x AS (SELECT t.*, entity_id IN (SELECT target FROM p) AS hit FROM t)
SELECT source, country, count(*) FILTER (hit) AS matched, count(*) FILTER (NOT hit) AS unmatched, count(*) AS total, round(count(*) FILTER (NOT hit) / count(*), 6) AS unmatched_fraction FROM x GROUP BY GROUPING SETS ((source), (source, country))""")
def _(spark, d):
    return audit.distractors(pairs(spark, d), audit_targets(spark, d))


@query("a20_coverage", "WITH " + _TRUTH + ", x AS (SELECT s1, bool_or(source = 'S2') AS a, bool_or(source = 'S3') AS b FROM p GROUP BY 1) SELECT count(*) FILTER (a AND b) AS both_sources, count(*) FILTER (a AND NOT b) AS only_s2, count(*) FILTER (NOT a AND b) AS only_s3 FROM x")
def _(spark, d):
    return audit.coverage(pairs(spark, d))


@query("u3_id_overlap", "SELECT count(*) AS n_overlap FROM (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey FROM supplier)")
def _(spark, d):
    return audit.id_overlap(table(spark, d, "customer").select(F.col("c_custkey").alias("entity_id")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("entity_id")))


@query("u5_id_differences", "SELECT 'missing' AS side, k FROM (SELECT c_custkey AS k FROM customer EXCEPT ALL SELECT p_partkey FROM part) UNION ALL SELECT 'extra', k FROM (SELECT p_partkey AS k FROM part EXCEPT ALL SELECT c_custkey FROM customer)")
def _(spark, d):
    return audit.id_differences(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "part").select(F.col("p_partkey").alias("k")), "k")


@query("p14_invariants", "WITH " + _TRUTH + " SELECT (SELECT max(n) <= 1 FROM (SELECT count(DISTINCT s1) AS n FROM p WHERE source <> 'INVALID' GROUP BY source, target)) AS targets_exclusive, (SELECT count(*) = 0 FROM p JOIN s ON p.s1 = s.entity_id JOIN t ON t.entity_id = p.target WHERE s.country IS DISTINCT FROM t.country) AS country_blocking_safe")
def _(spark, d):
    return audit.invariants(pairs(spark, d), audit_s1(spark, d), audit_targets(spark, d))


# ---- normalization


_FOLD = "strip_accents(lower(replace(text, 'ß', 'ss')))"


@query("f1_f6_views", f"SELECT doc_id, nfc_normalize(text) AS nfkc, lower(replace(text, 'ß', 'ss')) AS casefold, {_FOLD} AS accent FROM documents")
def _(spark, d):
    v = X.with_views(table(spark, d, "documents").select("doc_id", "text"), "text", "", need=("nfkc", "casefold", "accent"))
    return v.select("doc_id", "nfkc", "casefold", "accent")


_NAMES = "entity_id, coalesce(name, '') AS name_nfkc, compact AS name_compact, tokens AS name_tokens, sorted AS name_token_sorted, core AS name_core, translit AS name_transliterated, ac AS address_compact, an AS address_normalized"


@query("f5_f12_name_views", "WITH " + _NORM + f" SELECT {_NAMES}, array_to_string(nums, '|') AS numeric_tokens, nums[1] AS primary_number, postal AS postal_like_tokens, coalesce(trim(name) = '', true) AS name_missing FROM norm")
def _(spark, d):
    return normalized(spark, d).select(
        "entity_id", "name_nfkc", "name_compact", "name_tokens", "name_token_sorted", "name_core", "name_transliterated", "address_compact", "address_normalized",
        "numeric_tokens", "primary_number", "postal_like_tokens", "name_missing",
    )


# the names' Cyrillic letters have one Latin letter each, so that their romanization can be told in SQL
@query("f7_romanize", "WITH " + _NORM + " SELECT entity_id, translit FROM norm")
def _(spark, d):
    v = X.with_views(records(spark, d), "business_name", "_", need=("translit",))
    return v.select("entity_id", X.joined(F.col("_translit")).alias("translit"))


@query("f8_suffix_strip", """SELECT c_custkey, c_mktsegment || ' ' || list_extract(['Pvt Ltd', 'Inc', 'S A', 'SASU', 'e.u.r.l.', 'Sci Co', 'GmbH', ''], (c_custkey % 8 + 1)::INT) AS name, lower(c_mktsegment) || CASE WHEN c_custkey % 8 = 6 THEN ' gmbh' ELSE '' END AS core FROM customer""")
def _(spark, d):
    ends = F.element_at(F.array(*map(F.lit, ("Pvt Ltd", "Inc", "S A", "SASU", "e.u.r.l.", "Sci Co", "GmbH", ""))), (F.col("c_custkey") % 8 + 1).cast("int"))
    named = table(spark, d, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit(" "), ends).alias("name"))
    return X.with_views(named, "name", "_", need=("tokens",), suffixes=DEFAULTS["normalization"]["legal_suffixes"]).select("c_custkey", "name", X.joined(F.col("_core")).alias("core"))


@query("a32_normalization_profile", "WITH " + _NORM + """ SELECT src, count(*) AS n_rows, count(DISTINCT entity_id) AS unique_ids, count(*) FILTER (coalesce(trim(name) = '', true)) AS names_missing, count(*) FILTER (addr IS NULL) AS addresses_missing,
  count(*) FILTER (strip_accents(lower(name)) <> lower(name)) AS accents_changed, count(*) FILTER (translit <> tokens) AS transliterated, count(*) FILTER (core <> tokens) AS cores_changed,
  round(avg(length(tokens)), 6) AS avg_name_length, max(length(tokens)) AS max_name_length, round(avg(length(an)), 6) AS avg_address_length, max(length(an)) AS max_address_length FROM norm GROUP BY src""")
def _(spark, d):
    return normalize.profile(normalized(spark, d), "src")


@query("o6_stratified_sample", "WITH " + _NORM + """, c AS (SELECT entity_id, unnest([CASE WHEN eligible = false AND name IS NOT NULL THEN 'ascii' END, CASE WHEN regexp_matches(name, '[\\x{00C0}-\\x{024F}]') THEN 'latin_extended' END, CASE WHEN regexp_matches(name, '[[:punct:]]') THEN 'punctuation' END, 'numbers',
  CASE WHEN core <> tokens THEN 'suffix' END, CASE WHEN coalesce(trim(name) = '', true) THEN 'missing' END]) AS category FROM norm)
SELECT category, row_number() OVER (PARTITION BY category ORDER BY entity_id) AS place, entity_id FROM c WHERE category IS NOT NULL QUALIFY place <= 4""")
def _(spark, d):
    return normalize.sample_by_category(normalized(spark, d))


def broken_records(spark, d) -> DataFrame:
    """Normalized records with planted faults: empty and null ids and countries, ids held twice, null names written as words."""
    n, key = normalized(spark, d), F.substring_index("entity_id", "-", -1).cast("long")
    faults = {
        "entity_id": F.when(key % 101 == 3, "").when(key % 101 != 4, F.concat(F.lit("R"), F.floor(key / 2))), "country": F.when(key % 103 == 3, "").when(key % 103 != 4, F.col("country")),
        "name_nfkc": F.when(F.col("name_raw").isNull(), F.when(key % 2 == 0, "None").otherwise("nan")).otherwise(F.col("name_nfkc")),
    }
    return n.select(*[faults[c].alias(c) if c in faults else F.col(c) for c in n.columns])


@query("v1_normalized_violations", """WITH r AS (SELECT CASE WHEN p_partkey % 101 = 3 THEN '' WHEN p_partkey % 101 <> 4 THEN 'R' || (p_partkey // 2) END AS id, CASE WHEN p_partkey % 103 = 3 THEN '' WHEN p_partkey % 103 <> 4 THEN p_type END AS country, p_partkey % 97 = 5 AS unnamed FROM part)
SELECT count(*) AS n_rows, count(*) FILTER (coalesce(id, '') = '') AS bad_id, count(*) FILTER (coalesce(country, '') = '') AS bad_country, count(*) FILTER (country IS DISTINCT FROM 'ECONOMY') AS wrong_country, count(*) FILTER (unnamed) AS null_words, count(*) - count(DISTINCT id) AS repeated_ids, true AS schema_ok FROM r""")
def _(spark, d):
    return validate.normalized_violations(broken_records(spark, d).drop("src"), country="ECONOMY")


# ---- exact blocking


@query("p7_signal_keys", "WITH " + _KEYS + " SELECT country, entity_id, signal::BIGINT AS signal, key FROM keys")
def _(spark, d):
    return blocking.signal_keys(normalized(spark, d), EXACT).select("country", "entity_id", F.col("signal").cast("long").alias("signal"), "key")


@query("w1_bucket_sizes", "WITH " + _KEYS + " SELECT country, signal::BIGINT AS signal, key, count(*) AS bucket_size FROM idx GROUP BY ALL")
def _(spark, d):
    return blocking.bucket_sizes(blocking.signal_keys(sides(spark, d)[0], EXACT)).select("country", F.col("signal").cast("long").alias("signal"), "key", "bucket_size")


@query("j1_exact_candidates", "WITH " + _EXACT + " SELECT *, (exact_hit::INT + 2 * structured_hit::INT)::BIGINT AS retriever_mask, (exact_hit::INT + structured_hit::INT)::BIGINT AS retriever_count, left(target_entity_id, 2) AS target_source FROM a")
def _(spark, d):
    return blocking.exact_candidates(*sides(spark, d), EXACT)


@query("a21_suppression", "WITH " + _KEYS + """, i AS (SELECT country, signal, key, count(*) AS n FROM keys WHERE src = 'S1' GROUP BY ALL), q AS (SELECT country, signal, key, count(*) AS c FROM keys WHERE src <> 'S1' GROUP BY ALL)
SELECT i.signal::BIGINT AS signal, count(*) AS index_keys, coalesce(sum(c), 0)::BIGINT AS queries_hitting_key, coalesce(sum(c) FILTER (n > """ + _SIGNAL_CAP + """), 0)::BIGINT AS suppressed, max(n) AS largest_bucket, round(quantile_cont(n, 0.95), 6) AS p95_bucket
FROM i LEFT JOIN q ON i.country = q.country AND i.signal = q.signal AND i.key = q.key GROUP BY 1""")
def _(spark, d):
    return blocking.suppression(*sides(spark, d), EXACT).withColumn("signal", F.col("signal").cast("long"))


@query("a22_exact_recall", "WITH " + _EXACT + "," + _PT + """, x AS (SELECT pt.*, coalesce(exact_hit, false) AS e, coalesce(structured_hit, false) AS s FROM pt LEFT JOIN a ON a.target_entity_id = pt.target AND a.candidate_s1_entity_id = pt.s1)
SELECT country, source, count(*) AS pairs, count(*) FILTER (e) AS exact, count(*) FILTER (s) AS structured, count(*) FILTER (e OR s) AS any_hit, count(*) FILTER (e AND NOT s) AS only_exact, count(*) FILTER (s AND NOT e) AS only_structured, round(count(*) FILTER (e OR s) / count(*), 6) AS recall FROM x GROUP BY GROUPING SETS ((), (country, source))""")
def _(spark, d):
    return evaluate.exact_recall(part_truth(spark, d), blocking.exact_candidates(*sides(spark, d), EXACT))


@query("a23_candidate_volume", "WITH " + _EXACT + """, v AS (SELECT entity_id, count(a.target_entity_id) AS n FROM norm LEFT JOIN a ON a.target_entity_id = entity_id WHERE src <> 'S1' GROUP BY 1)
SELECT count(*) AS targets, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS most,
  count(*) FILTER (n = 0) AS bin_0, count(*) FILTER (n = 1) AS bin_1, count(*) FILTER (n BETWEEN 2 AND 5) AS bin_2_5, count(*) FILTER (n BETWEEN 6 AND 10) AS bin_6_10, count(*) FILTER (n > 10) AS bin_over_10 FROM v""")
def _(spark, d):
    s1, t = sides(spark, d)
    return evaluate.volume(t, blocking.exact_candidates(s1, t, EXACT))


# ---- multikey blocking


@query("a13_token_frequencies", "WITH " + _MULTI + " SELECT country, view, token, df FROM df")
def _(spark, d):
    return blocking.token_frequencies(blocking.record_tokens(sides(spark, d)[0], MULTI))


@query("w3_rare_tokens", "WITH " + _MULTI + " SELECT entity_id, view, token, df, rn AS place FROM sel")
def _(spark, d):
    n = normalized(spark, d)
    df = blocking.token_frequencies(blocking.record_tokens(n.where("src = 'S1'"), MULTI))
    return blocking.rare_tokens(blocking.record_tokens(n, MULTI), df, MULTI).select("entity_id", "view", "token", "df", F.col("place").cast("long").alias("place"))


@query("a14_key_frequencies", "WITH " + _MULTI + " SELECT country, family, key, count(*) AS df FROM mk WHERE src = 'S1' GROUP BY ALL")
def _(spark, d):
    s1 = sides(spark, d)[0]
    df = blocking.token_frequencies(blocking.record_tokens(s1, MULTI))
    return blocking.multikeys(s1, df, MULTI).groupBy("country", "family", "key").agg(F.count("*").alias("df"))


@query("w4_multikey_candidates", "WITH " + _MULTI + " SELECT country, target_entity_id, candidate_s1_entity_id, round(sum_idf, 6) AS sum_idf, c AS blocker_signal_count, min_df AS blocker_min_key_df, min_df AS blocker_best_key_df, true AS blocker_hit, " + ", ".join(f"block_{f}_hit" for f in blocking.FAMILIES) + ", blocker_rank FROM b")
def _(spark, d):
    return blocking.multikey_candidates(*sides(spark, d), MULTI).select("country", "target_entity_id", "candidate_s1_entity_id", F.round("sum_idf", 6).alias("sum_idf"), "blocker_signal_count", "blocker_min_key_df", "blocker_best_key_df", "blocker_hit", *[f"block_{f}_hit" for f in blocking.FAMILIES], "blocker_rank")


# ---- union evaluation


def hits(spark, d) -> DataFrame:
    s1, t = sides(spark, d)
    return evaluate.truth_hits(part_truth(spark, d), blocking.exact_candidates(s1, t, EXACT), blocking.multikey_candidates(s1, t, MULTI))


@query("j9_truth_hits", "WITH " + _HITS + " SELECT * FROM h")
def _(spark, d):
    return hits(spark, d).select("s1", "target", "source", "country", "a_hit", "b_rank")


@query("a26_union_metrics", "WITH " + _HITS + ", x AS (SELECT *, coalesce(b_rank <= 50, false) AS bh FROM h) SELECT country, source, count(*) AS pairs, count(*) FILTER (a_hit) AS a, count(*) FILTER (bh) AS b, count(*) FILTER (a_hit AND bh) AS both, count(*) FILTER (a_hit AND NOT bh) AS a_only, count(*) FILTER (bh AND NOT a_hit) AS b_only, count(*) FILTER (a_hit OR bh) AS either FROM x GROUP BY GROUPING SETS ((), (country, source))")
def _(spark, d):
    return evaluate.union_metrics(hits(spark, d))


@query("a27_recall_at_k", "WITH " + _HITS + ", k AS (SELECT unnest([1, 3, 5, 10, 20, 50])::BIGINT AS k) SELECT k, count(*) AS pairs, count(*) FILTER (coalesce(b_rank <= k, false)) AS b_hits, count(*) FILTER (coalesce(b_rank <= k, false) OR a_hit) AS union_hits, round(count(*) FILTER (coalesce(b_rank <= k, false) OR a_hit) / count(*), 6) AS union_recall FROM h, k GROUP BY k")
def _(spark, d):
    return evaluate.recall_at(hits(spark, d))


@query("a28_oracle_macro_f05", "WITH " + _HITS + ", g AS (SELECT s1, count(*) AS g, count(*) FILTER (a_hit OR coalesce(b_rank <= 50, false)) AS r FROM h GROUP BY 1) SELECT count(*) AS entities, round(avg(CASE WHEN g IS NULL THEN 1 WHEN r = 0 THEN 0 ELSE 1.25 * r / (0.25 * g + r) END), 6) AS oracle_f05 FROM norm LEFT JOIN g ON g.s1 = entity_id WHERE src = 'S1'")
def _(spark, d):
    return evaluate.oracle_macro(sides(spark, d)[0], hits(spark, d))


@query("a29_union_volume", "WITH " + _HITS + """, u AS (SELECT target_entity_id AS t, candidate_s1_entity_id AS c, max(ia) AS ia, min(r) AS r FROM (SELECT target_entity_id, candidate_s1_entity_id, 1 AS ia, NULL AS r FROM a UNION ALL SELECT target_entity_id, candidate_s1_entity_id, 0, blocker_rank FROM b) GROUP BY ALL),
k AS (SELECT unnest([5, 10, 20, 50])::BIGINT AS k), v AS (SELECT k, entity_id, count(*) FILTER (ia = 1 OR coalesce(r <= k, false)) FILTER (true) AS n FROM norm CROSS JOIN k LEFT JOIN u ON u.t = entity_id WHERE src <> 'S1' GROUP BY ALL)
SELECT k, count(*) AS targets, sum(n)::BIGINT AS candidates, quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.95) AS p95, max(n) AS most FROM v GROUP BY k""".replace(" FILTER (true)", ""))
def _(spark, d):
    s1, t = sides(spark, d)
    return evaluate.union_volume(t, blocking.exact_candidates(s1, t, EXACT), blocking.multikey_candidates(s1, t, MULTI))


@query("a33_entity_fbeta", "WITH " + _EXACT + "," + _PT + """, x AS (SELECT coalesce(pt.s1, a.candidate_s1_entity_id) AS s1, count(pt.s1) AS nt, count(a.target_entity_id) AS np, count(*) FILTER (pt.s1 IS NOT NULL AND a.target_entity_id IS NOT NULL) AS tp FROM pt FULL JOIN a ON a.target_entity_id = pt.target AND a.candidate_s1_entity_id = pt.s1 GROUP BY 1)
SELECT count(*) AS entities, 0::BIGINT AS problems, round(avg(CASE WHEN coalesce(x.nt, 0) = 0 AND coalesce(x.np, 0) = 0 THEN 1 WHEN coalesce(tp, 0) = 0 THEN 0 ELSE 1.25 * (tp / x.np) * (tp / x.nt) / (0.25 * (tp / x.np) + tp / x.nt) END), 6) AS macro_f FROM norm LEFT JOIN x ON x.s1 = entity_id WHERE src = 'S1'""")
def _(spark, d):
    s1, t = sides(spark, d)
    c = blocking.exact_candidates(s1, t, EXACT).select(F.col("candidate_s1_entity_id").alias("s1"), F.col("target_entity_id").alias("target"))
    return evaluate.macro_fbeta(s1, part_truth(spark, d), c)


# ---- diagnostics of rare-token blocking

_WATERFALL = "WITH " + _MULTI + ", " + _PT.strip() + """, f AS (SELECT pt.s1, pt.target, true AS raw, bool_or(""" + _UNDER + """) AS pruned, """ + ", ".join(f"bool_or({_UNDER} AND CASE WHEN p.family LIKE 'translit%' THEN 'transliterated' ELSE p.family END = '{f}') AS {f}" for f in ceilings.WATERFALL) + """
  FROM pt JOIN mk t ON t.entity_id = pt.target AND t.country = pt.country JOIN post p ON p.entity_id = pt.s1 AND p.country = t.country AND p.family = t.family AND p.key = t.key GROUP BY ALL)
SELECT count(*) AS pairs, count(*) FILTER (raw) AS raw_covered, count(*) FILTER (pruned) AS pruned_recovered, count(*) FILTER (raw AND NOT pruned) AS lost_all_suppressed""" + "".join(
    f", count(*) FILTER ({f}) AS {f}_recovered, count(*) FILTER ({' AND '.join([f, *['NOT ' + e for e in ceilings.WATERFALL[:i]]])}) AS {f}_new" for i, f in enumerate(ceilings.WATERFALL)
) + " FROM pt LEFT JOIN f USING (s1, target)"
_CEILING = _MULTI + ", " + _PT.strip() + """, r AS (SELECT * FROM (VALUES ('current', """ + f"{MULTI['name_max_df']}, {MULTI['address_max_df']}, {MULTI['max_tokens']}" + """), ('df100', 100, 100, 4), ('df300', 300, 300, 4), ('df1000', 1000, 1000, 4)) v(rule, name_lim, address_lim, most)),
cs AS (SELECT * FROM (SELECT t.country, t.entity_id, t.view, rule, t.token, most, row_number() OVER (PARTITION BY t.country, t.entity_id, t.view, rule ORDER BY df, t.token) AS rn
  FROM tok t JOIN df ON t.country = df.country AND t.view = df.view AND t.token = df.token CROSS JOIN r WHERE df <= CASE WHEN t.view = 'address' THEN address_lim ELSE name_lim END AND (t.view <> 'translit' OR eligible)) WHERE rn <= most),
ck AS (SELECT country, entity_id, rule, view AS kind, token FROM cs
  UNION ALL SELECT country, entity_id, rule, 'address_pair', string_agg(token, chr(31) ORDER BY token) FROM cs WHERE view = 'address' AND rn <= 2 GROUP BY 1, 2, 3 HAVING count(*) >= 2
  UNION ALL SELECT DISTINCT country, entity_id, rule, 'number', num FROM (SELECT country, entity_id, unnest(nums[1:2]) AS num FROM norm) CROSS JOIN r),
ch AS (SELECT pt.s1, pt.target, a.rule, """ + ", ".join(f"bool_or(a.kind = '{k}') AS {k}_hit" for k in ceilings.KINDS) + """
  FROM pt JOIN ck a ON a.entity_id = pt.s1 AND a.country = pt.country JOIN ck b ON b.entity_id = pt.target AND b.country = pt.country AND b.rule = a.rule AND b.kind = a.kind AND b.token = a.token GROUP BY ALL),
cp AS (SELECT pt.*, r.rule, """ + ", ".join(f"coalesce({k}_hit, false) AS {k}_hit" for k in ceilings.KINDS) + """ FROM pt CROSS JOIN r LEFT JOIN ch ON ch.s1 = pt.s1 AND ch.target = pt.target AND ch.rule = r.rule)"""


@query("a24_multikey_waterfall", _WATERFALL)
def _(spark, d):
    return ceilings.waterfall(*sides(spark, d), part_truth(spark, d), MULTI)


@query("j13_key_ceiling_pairs", "WITH " + _CEILING + " SELECT * FROM cp")
def _(spark, d):
    return ceilings.key_ceiling_pairs(*sides(spark, d), part_truth(spark, d), MULTI)


@query("a30_key_ceiling_coverage", "WITH " + _CEILING + """ SELECT rule, country, source, count(*) AS gt_pairs, count(*) FILTER (c) AS covered, round(count(*) FILTER (c) / count(*), 6) AS coverage
FROM (SELECT *, name_hit OR (number_hit AND address_hit) OR address_pair_hit OR translit_hit AS c FROM cp) GROUP BY GROUPING SETS ((rule), (rule, country, source))""")
def _(spark, d):
    return ceilings.ceiling_coverage(ceilings.key_ceiling_pairs(*sides(spark, d), part_truth(spark, d), MULTI))


@query("a31_translit_diagnostics", "WITH " + _CEILING + f""", tk AS (SELECT DISTINCT t.country, t.entity_id FROM tok t JOIN df ON t.country = df.country AND t.view = df.view AND t.token = df.token WHERE t.view = 'translit' AND eligible AND t.src <> 'S1' AND df <= {MULTI['name_max_df']}),
cr AS (SELECT DISTINCT cp.s1, cp.target, cp.translit_hit FROM cp JOIN cs a ON a.entity_id = cp.s1 AND a.rule = cp.rule AND a.view = 'name' JOIN cs b ON b.entity_id = cp.target AND b.rule = cp.rule AND b.view = 'translit' AND b.token = a.token WHERE cp.rule = 'current')
SELECT (SELECT count(*) FROM norm WHERE src <> 'S1' AND eligible) AS targets_eligible, (SELECT count(*) FROM tk) AS targets_with_translit_keys,
  (SELECT count(DISTINCT target_entity_id) FROM b WHERE block_translit_name_hit OR block_translit_name_number_hit) AS stored_targets,
  count(*) FILTER (translit_hit) AS pairs_sharing, count(*) FILTER (translit_hit AND NOT (name_hit OR (number_hit AND address_hit) OR address_pair_hit)) AS pairs_unique, count(*) FILTER (translit_hit AND name_hit) AS pairs_sharing_name,
  (SELECT count(*) FROM cr) AS cross_namespace, (SELECT count(*) FILTER (NOT translit_hit) FROM cr) AS cross_namespace_lost, (SELECT count(*) FILTER (NOT translit_hit) > 0 FROM cr) AS issue FROM cp WHERE rule = 'current'""")
def _(spark, d):
    s1, t = sides(spark, d)
    return ceilings.translit_diagnostics(s1, t, part_truth(spark, d), blocking.multikey_candidates(s1, t, MULTI), MULTI)


@query("a11_histogram_quantile", "SELECT p_type, min(p_size)::BIGINT AS value FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_size) AS rn, count(*) OVER (PARTITION BY p_type) AS n FROM part) WHERE rn >= floor((n - 1) * 0.95) + 1 GROUP BY 1")
def _(spark, d):
    return evaluate.histogram_quantile(table(spark, d, "part").withColumn("p_size", F.col("p_size").cast("long")), "p_size", 0.95, "p_type")


@query("v8_unresolved_targets", "WITH " + _TRUTH + " SELECT s1, target FROM p WHERE target NOT IN (SELECT entity_id FROM t)")
def _(spark, d):
    return validate.unresolved_targets(pairs(spark, d), audit_targets(spark, d))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
