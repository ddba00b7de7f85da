"""Quality rules: a ledger that evaluates every rule once per document and keeps failure bits beside the measurements.

Policies are versioned bit masks applied to the ledger later, and ablations are bitwise aggregations of it: neither reads
a text again. Built from DataFrame functions only; each document is measured within its own row, without a shuffle.

Defined results: a null or blank text has no words, so every count is 0 and it fails `few_words`; repeated rows are
measured alike; other columns pass through `ledger`; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import words

WINDOW = 5
#: Failure bit of each rule; bits are never reused, so that old ledgers stay readable.
RULES = {"few_words": 0, "repeated_windows": 1, "symbol_share": 2, "duplicate_lines": 3, "word_length": 4}
#: Columns of the ledger and of its making; input columns of these names are left out.
OUTPUTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits", "_n_lines", "_lines", "_words", "_hashes", "_windows", "_sorted")
#: A document fails a policy if it fails any rule in its mask.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbol_share", "duplicate_lines", "word_length"),
}


def mask(policy: str | tuple[str, ...]) -> int:
    return sum(1 << RULES[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _measured(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumn("_words", words(F.col(text_col)))
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("n_words", F.size("_words").cast("long"))
    window = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
    )
    step = step.withColumn("_windows", F.when(F.col("n_words") > WINDOW, window))
    # most texts repeat no window; only those that do are sorted
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter(
        "_sorted",
        lambda x, i: ((i > 0) & (F.get("_sorted", i - 1)["h"] == x["h"])) | ((i < F.size("_sorted") - 1) & (F.get("_sorted", i + 1)["h"] == x["h"])),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + WINDOW - 1)))))
    step = step.withColumn("n_repeat_words", F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(covered).cast("long"))
    step = step.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    return step.select(
        *docs.columns,
        "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("_n_lines"),
        "n_repeat_words",
    )


def _failures() -> dict[str, Column]:
    n, c = F.col("n_words"), F.col
    return {
        "few_words": n < 10,
        "repeated_windows": 100 * c("n_repeat_words") > 20 * n,
        "symbol_share": 10 * c("n_symbols") > n,
        "duplicate_lines": 100 * c("n_dup_lines") > 30 * c("_n_lines"),
        "word_length": (c("word_chars") < 2 * n) | (c("word_chars") > 20 * n),
    }


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the measurements and fail_bits (long): bit RULES[r] is set if the document fails rule r."""
    measured = _measured(docs.drop(*OUTPUTS), text_col)
    bits = sum((F.when(failed, F.lit(1 << RULES[r])).otherwise(F.lit(0)) for r, failed in _failures().items()), F.lit(0))
    return measured.withColumn("fail_bits", bits.cast("long")).drop("_n_lines")


def passes(policy: str | tuple[str, ...]) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(ledger_df: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that pass without it. One aggregation of the ledger."""
    whole = mask(policy)
    held = F.col("fail_bits").bitwiseAND(F.lit(whole))
    aggs = [F.count("*").alias("n_docs"), F.count_if(held == 0).alias("n_pass")]
    for r in POLICIES[policy]:
        aggs += [F.count_if(held.bitwiseAND(F.lit(1 << RULES[r])) != 0).alias(f"fail_{r}"), F.count_if(held == (1 << RULES[r])).alias(f"only_{r}")]
    row = ledger_df.agg(*aggs)
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"fail_{r}").alias("n_fail"), F.col(f"only_{r}").alias("n_only"), (F.col("n_pass") + F.col(f"only_{r}")).alias("n_pass_without")) for r in POLICIES[policy]])
    return row.select("n_docs", "n_pass", F.inline(each))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = ledger(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), "fail_bits")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n >= 2
), cov AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*)::BIGINT AS lines, (count(*) - count(DISTINCT l))::BIGINT AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(ln.dup, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(ln.lines, 0) AS n_lines
  FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN ln ON ln.doc_id = d.doc_id
), b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)::BIGINT AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""
