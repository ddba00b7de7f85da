"""Queries that go through files: what is written and read back, manifests, resumption, whole stages; with their SQL.

Each writes to a folder of its own in the run's shared folder, from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.operators import audit, blocking, evaluate, normalize, validate
from linkmill.plans import stages
from linkmill.queries import _EXACT, _MULTI, _NORM, _TRUTH, EXACT, MULTI, normalized, part_truth, query, records, sides, table, truth
from linkmill.sources import artifacts, files, readers, sinks
from linkmill.tables import work_path

_UNDER_M = "WITH " + _MULTI
_TRAIN = "'train' AS split, 'source' || right(src, 1) AS source, country"


def write_tsv(df: DataFrame, path: str) -> str:
    df.write.options(sep="\t", header="true", quote="", emptyValue="", nullValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


def linkage_files(spark: SparkSession, d: str) -> str:
    """A folder with the seven input files: the stand-in records as training and as test sources, and their truth."""
    root, r = work_path(spark, "inputs"), records(spark, d)
    for k in (1, 2, 3):
        mine = r.where(F.col("src") == f"S{k}").select(*readers.SOURCE_COLUMNS)
        for split in ("train", "test"):
            write_tsv(mine, f"{root}/{split}/{split}_source{k}.tsv")
    lists = audit.target_lists(part_truth(spark, d))
    s1 = r.where("src = 'S1'").select(F.col("entity_id").alias("s1"))
    write_tsv(s1.join(lists, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce("targets", F.lit("")).alias("matched_entity_ids")), f"{root}/train_ground_truth.tsv")
    return root


def written(spark: SparkSession, d: str) -> str:
    """The stand-in records, normalized and written as a training table."""
    root = work_path(spark, "normalized-table")
    n = normalized(spark, d)
    sinks.write_normalized(n.select(*normalize.COLUMNS, F.lit("train").alias("split"), F.concat(F.lit("source"), F.substring("src", 2, 1)).alias("source")), root, 500)
    return root


@query("s2_s3_s10_tsv_scan", "WITH " + _NORM + " SELECT entity_id, coalesce(name, '') AS business_name, addr AS business_address, country FROM norm")
def _(spark, d):
    path = write_tsv(records(spark, d).select(*readers.SOURCE_COLUMNS), work_path(spark, "records.tsv"))
    return readers.tsv(spark, path)


@query("s1_s4_truth_scan", "WITH " + _TRUTH + " SELECT * FROM p")
def _(spark, d):
    root = work_path(spark, "truth")
    write_tsv(truth(spark, d).select(*readers.TRUTH_COLUMNS), f"{root}/deep/train_ground_truth.tsv")
    paths = readers.discover(spark, root, names={"truth": "train_ground_truth.tsv"})
    return audit.truth_pairs(readers.tsv(spark, paths["truth"], readers.TRUTH_COLUMNS))


@query("s5_union_by_name", "SELECT c_custkey AS k, c_name AS name, NULL::BIGINT AS size FROM customer UNION ALL SELECT p_partkey, p_name, p_size::BIGINT FROM part")
def _(spark, d):
    root = work_path(spark, "by-name")
    table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).write.parquet(f"{root}/a")
    table(spark, d, "part").select(F.col("p_size").cast("long").alias("size"), F.col("p_name").alias("name"), F.col("p_partkey").alias("k")).write.parquet(f"{root}/b")
    return readers.parquet(spark, f"{root}/a", f"{root}/b", merge=True).select("k", "name", "size")


@query("s6_k4_partition_scan", "WITH " + _NORM + " SELECT entity_id, compact AS name_compact, country FROM norm WHERE src = 'S2' AND country IN ('ECONOMY', 'PROMO')")
def _(spark, d):
    return readers.partition_shards(spark, written(spark, d), source=["source2"], country=["ECONOMY", "PROMO"]).select("entity_id", "name_compact", "country")


@query("s8_v7_inventory", "WITH " + _NORM + f" SELECT {_TRAIN}, count(*) AS n_rows, 0::BIGINT AS repeated_ids, count(*) AS expected_rows, true AS ok FROM norm GROUP BY ALL")
def _(spark, d):
    return validate.inventory(spark.read.parquet(written(spark, d)))


@query("s9_k9_manifests", "WITH " + _NORM + f" SELECT {_TRAIN}, count(*) AS output_rows, 'complete' AS status, '' AS wrong FROM norm GROUP BY ALL")
def _(spark, d):
    root = written(spark, d)
    found = artifacts.describe(spark, root)
    made = [artifacts.Manifest("normalization", "v1", s["split"], s["source"], s["country"], "all", s["n_rows"], s["n_rows"], "c", "r", "i", root, s["artifact_size_bytes"], s["artifact_hash"]) for s in found]
    artifacts.save_manifests(spark, root, made)
    loaded = artifacts.require(spark, root, "normalization", normalize.COLUMNS[:1])
    told = artifacts.check(loaded, artifacts.describe(spark, root), "normalization", "v1", "c", {m.identity: "i" for m in loaded})
    return spark.createDataFrame([(*m.identity, m.output_rows, m.status, told[m.identity]) for m in loaded], "split string, source string, country string, output_rows long, status string, wrong string")


@query("s11_file_contract", "WITH " + _NORM + " SELECT 'records' AS logical_name, 'entity_id business_name business_address country' AS columns, 'string string string string' AS dtypes, count(*) AS row_count FROM norm")
def _(spark, d):
    path = write_tsv(records(spark, d).select(*readers.SOURCE_COLUMNS), work_path(spark, "records.tsv"))
    rows = [(r["logical_name"], " ".join(r["columns"]), " ".join(r["inferred_dtypes"]), r["row_count"]) for r in readers.file_contract(spark, {"records": path}, {"records": readers.SOURCE_COLUMNS})]
    return spark.createDataFrame(rows, "logical_name string, columns string, dtypes string, row_count long")


@query("s14_organizer_files", "SELECT unnest(['metric.py', 'official_scorer.txt', 'Validate_Submission.md']) AS name")
def _(spark, d):
    root = work_path(spark, "organizer")
    for name in ("metric.py", "deep/official_scorer.txt", "Validate_Submission.md", "readme.txt"):
        files.write_text(spark, f"{root}/{name}", name)
    return spark.createDataFrame([(p.rsplit("/", 1)[-1],) for p in readers.organizer_files(spark, root)], "name string")


@query("k1_normalized_sink", "WITH " + _NORM + f" SELECT {_TRAIN}, count(*) AS n, sum(length(tokens))::BIGINT AS chars, 0::BIGINT AS null_ids FROM norm GROUP BY ALL")
def _(spark, d):
    back = spark.read.parquet(written(spark, d))
    return back.groupBy("split", "source", "country").agg(F.count("*").alias("n"), F.sum(F.length("name_tokens")).alias("chars"), F.count_if(F.col("entity_id").isNull()).alias("null_ids"))


@query("k2_o1_candidate_sink", "WITH " + _EXACT + " SELECT target_entity_id, candidate_s1_entity_id, left(target_entity_id, 2) AS target_source, country, exact_hit, structured_hit, (exact_hit::INT + 2 * structured_hit::INT)::INT AS retriever_mask, 'train' AS split FROM a")
def _(spark, d):
    root = work_path(spark, "exact-table")
    sinks.write_candidates(blocking.exact_candidates(*sides(spark, d), EXACT), root, validate.EXACT, "train")
    back = stages.read_candidates(spark, root, validate.EXACT)
    return back.select("target_entity_id", "candidate_s1_entity_id", "target_source", "country", "exact_hit", "structured_hit", "retriever_mask", "split")


@query("k3_multikey_sink", _UNDER_M + " SELECT target_entity_id, candidate_s1_entity_id, left(target_entity_id, 2) AS target_source, country, true AS blocker_hit, c::INT AS blocker_signal_count, min_df AS blocker_min_key_df, blocker_rank::INT AS blocker_rank FROM b")
def _(spark, d):
    root = work_path(spark, "multikey-table")
    made = blocking.multikey_candidates(*sides(spark, d), MULTI).withColumnRenamed("sum_idf", "blocker_sum_idf")
    sinks.write_candidates(made, root, validate.MULTIKEY, "train")
    back = stages.read_candidates(spark, root, validate.MULTIKEY)
    return back.select("target_entity_id", "candidate_s1_entity_id", "target_source", "country", "blocker_hit", F.col("blocker_signal_count").cast("int").alias("blocker_signal_count"), "blocker_min_key_df", F.col("blocker_rank").cast("int").alias("blocker_rank"))


@query("k10_multikey_suppression", _UNDER_M + """, i AS (SELECT DISTINCT country, family, key, n FROM post), q AS (SELECT country, family, key, count(*) AS c FROM mk WHERE src <> 'S1' GROUP BY ALL),
x AS (SELECT i.*, c, i.n > CASE i.family """ + " ".join(f"WHEN '{f}' THEN {n}" for f, n in MULTI["caps"].items()) + """ END AS over_cap FROM i LEFT JOIN q ON i.country = q.country AND i.family = q.family AND i.key = q.key)
SELECT family, count(*) AS index_keys, coalesce(sum(c), 0)::BIGINT AS probes_hitting_key, coalesce(sum(c) FILTER (over_cap), 0)::BIGINT AS suppressed, max(n) AS largest_list, coalesce(max(n) FILTER (over_cap AND c IS NOT NULL), 0) AS largest_suppressed FROM x GROUP BY 1""")
def _(spark, d):
    return blocking.multikey_suppression(*sides(spark, d), MULTI)


# of fewer rows than the accuracy, the approximate quantile is the discrete one
@query("a10_approx_quantile", "SELECT p_type, quantile_disc(p_size, 0.95)::INT AS value FROM part GROUP BY 1")
def _(spark, d):
    return evaluate.approx_quantile(table(spark, d, "part"), "p_size", 0.95, "p_type", accuracy=1_000_000)


@query("t2_v5_resumption", "WITH " + _NORM + ", s AS (SELECT DISTINCT src, country FROM norm) SELECT 2 * count(*) AS first_written, 0::BIGINT AS again_written, 1::BIGINT AS after_damage_written, 2 * count(*) AS shards FROM s")
def _(spark, d):
    root, out = linkage_files(spark, d), work_path(spark, "run")
    first, again = (stages.run_normalize(spark, root, out) for _ in range(2))
    files.delete(spark, files.list_files(spark, f"{out}/normalized/split=test/source=source2", "*.parquet")[0].path)
    after = stages.run_normalize(spark, root, out)
    return spark.createDataFrame([(first["written"], again["written"], after["written"], after["written"] + after["skipped"])], "first_written long, again_written long, after_damage_written long, shards long")


@query("t1_k7_stage_recall", "WITH " + _EXACT + """, pt AS (SELECT 'S1-' || a.p_partkey AS s1, 'S' || (b.p_partkey % 3 + 1) || '-' || b.p_partkey AS target, a.p_type AS country FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_name = b.p_name AND a.p_size = b.p_size WHERE a.p_partkey % 3 = 0 AND b.p_partkey % 3 > 0)
SELECT count(*) AS pairs, count(*) FILTER (exact_hit) AS exact, count(*) FILTER (structured_hit) AS structured, count(a.country) AS any_hit FROM pt LEFT JOIN a ON a.target_entity_id = pt.target AND a.candidate_s1_entity_id = pt.s1""")
def _(spark, d):
    root, out = linkage_files(spark, d), work_path(spark, "run")
    stages.run_normalize(spark, root, out)
    told = stages.retrieve_exact(spark, root, out, split="train")["by_split"]["train"]["recall"]
    whole = next(r for r in told if r["country"] is None)
    return spark.createDataFrame([tuple(whole[k] for k in ("pairs", "exact", "structured", "any_hit"))], "pairs long, exact long, structured long, any_hit long")
