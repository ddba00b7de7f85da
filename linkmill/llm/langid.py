"""Language identification by prediction by partial matching.

Each language has a context tree of order ORDER over the bytes of lower-cased words, held as sorted arrays of the contexts
and of the context-symbol pairs that were seen. A symbol is coded in the longest context that was seen with it; every
longer one that was seen without it costs its escape (method C: D / (N + D)), and below the empty context all 256 bytes are
alike. The statistics are frozen after training, contexts don't reach past white space, and so the exact code length of a
text is the sum of its words' code lengths; words repeat, and each is coded once per block of texts.

The language with the shortest code wins; score is its share of 2^-bits over all languages. The trees are fitted on a
bounded sample: for each of the TRAIN_LANGS labels with the most documents, whole documents in order of a hash of id and text,
whatever their size, until TRAIN_DOCS of them or TRAIN_BYTES of text are reached; the first always counts. Only documents
whose hash is below a threshold, set by the label's number of documents, are ranked.

Defined results: `und` with score 0 for a null text, a text without a letter (Unicode category L), and every text where no
language was learned; ties go to the first language by code point; repeated rows are judged alike, and learned from once;
an empty table gives an empty one; columns of docs named as those added are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import materialise, small, tidy
from linkmill.llm.pieces import BLOCK_CHARS, MOST_PIECES, runs

ORDER = 4
#: Bounds of the sample: labels learned, documents of a label, and bytes of a label's texts after which no more are taken.
TRAIN_LANGS, TRAIN_DOCS, TRAIN_BYTES = 500, 400, 500_000
UND = "und"
#: Rows whose texts are held as Python strings at a time.
SLICE_ROWS = 1000
_LETTER = regex.compile(r"\p{L}")


def _layout(words: list[bytes]):
    """Symbols of words, each with a space before and after; for each symbol, the context bytes it has and its word."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    flat = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - starts[word]
    coded = np.flatnonzero(place > 0)
    return flat, coded, place[coded], word[coded]


def _codes(flat: np.ndarray, coded: np.ndarray, k: int) -> np.ndarray:
    """The k bytes before each place, as one integer."""
    out = np.zeros(len(coded), np.int64)
    for j in range(k, 0, -1):
        out = out << 8 | flat[coded - j]
    return out


class ContextTree:
    def __init__(self, words: list[bytes], counts: list[int]):
        flat, coded, place, word = _layout(words)
        weight = np.array(counts, np.float64)[word]
        self.levels = []
        for k in range(ORDER + 1):
            has = place >= k
            context = _codes(flat, coded[has], k)
            pairs, at = np.unique(context << 8 | flat[coded[has]], return_inverse=True)
            n = np.bincount(at, weight[has], len(pairs))
            contexts, of = np.unique(pairs >> 8, return_inverse=True)
            total, distinct = np.bincount(of, n), np.bincount(of)
            self.levels.append((pairs, -np.log2(n / (total + distinct)[of]), contexts, -np.log2(distinct / (total + distinct))))

    def bits(self, flat, coded, place, word, n_words: int) -> np.ndarray:
        """Code length of each word."""
        cost = np.zeros(len(coded))
        open_ = np.arange(len(coded))
        for k in range(ORDER, -1, -1):
            pairs, costs, contexts, escapes = self.levels[k]
            able = place[open_] >= k
            these = open_[able]
            if not len(these) or not len(pairs):
                continue
            context = _codes(flat, coded[these], k)
            pair = context << 8 | flat[coded[these]]
            at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            seen = pairs[at] == pair
            cost[these[seen]] += costs[at[seen]]
            missed = context[~seen]
            at = np.minimum(np.searchsorted(contexts, missed), len(contexts) - 1)
            cost[these[~seen]] += np.where(contexts[at] == missed, escapes[at], 0.0)
            open_ = np.concatenate([open_[~able], these[~seen]])
        cost[open_] += 8.0
        return np.bincount(word, cost, n_words)


class Model:
    """Context trees by language."""

    def __init__(self, texts_by_lang: dict[str, list[str]]):
        self.langs = sorted(texts_by_lang)
        self.trees = []
        self.words = None  # learned words, their code lengths and sizes
        for lang in self.langs:
            counts: dict[str, int] = {}
            for t in texts_by_lang[lang]:
                for w in t.lower().split():
                    counts[w] = counts.get(w, 0) + 1
            self.trees.append(ContextTree([w.encode() for w in counts] or [b""], list(counts.values()) or [1]))

    def word_bits(self, words: list[bytes]) -> np.ndarray:
        """(words, languages)"""
        laid = _layout(words)
        return np.stack([t.bits(*laid, len(words)) for t in self.trees], 1)

    def predict(self, texts: list[str | None]):
        """Yields (language, score, bits per byte) of each text, whole."""
        known, table, sizes = self.words or ({}, np.zeros((0, len(self.langs))), np.zeros(0))
        clean = [t or "" for t in texts]
        for a, b in runs(clean, BLOCK_CHARS):
            if len(known) > MOST_PIECES:
                known, table, sizes = {}, table[:0], sizes[:0]
            new = set()
            for t in clean[a:b]:
                new.update(t.lower().split())
            new = list(new.difference(known.keys())) if self.langs else []
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            raw = [w.encode() for w in new]
            for i in range(0, len(raw), 10_000):
                table = np.concatenate([table, self.word_bits(raw[i : i + 10_000])])
            sizes = np.concatenate([sizes, [len(w) + 1 for w in raw]])
            self.words = known, table, sizes
            for t in clean[a:b]:
                if not self.langs or not _LETTER.search(t):
                    yield UND, 0.0, None
                    continue
                at = np.fromiter(map(known.__getitem__, t.lower().split()), np.int64)
                bits = table[at].sum(0)
                best = int(bits.argmin())
                yield self.langs[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()), float(bits[best] / sizes[at].sum())


def held_out(id_col: str):
    """Whether a document is kept from training: CRC-32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_langs: int = TRAIN_LANGS, per_lang: int = TRAIN_DOCS, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(lang, text): the bounded sample of the labelled rows with a text that aren't held out."""
    able = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col) & (F.octet_length(text_col) > 0))
    keyed = able.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)).alias("h2"))
    # distinct documents, so that copies of one don't crowd out the rest
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs)
    # of so many documents about four times as many as are wanted have a hash below the threshold
    counts = small(materialise(counts.select("lang", F.least(F.lit(1.0), 4.0 * per_lang / F.col("n")).alias("part")), "langid-labels"))
    low = (F.col("h") / float(1 << 63) + 1.0) / 2.0 <= F.col("part")
    ranked = keyed.withColumn("size", F.octet_length("text").cast("long")).select("lang", "h", "h2", "size").join(counts, "lang").where(low).drop("part").distinct()
    order = Window.partitionBy("lang").orderBy("h", "h2")
    chosen = ranked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_lang)
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = small(materialise(chosen.withColumn("before", before).where(F.col("before") < most_bytes).select("lang", "h", "h2"), "langid-sample"))
    return keyed.join(chosen, ["lang", "h", "h2"], "left_semi").dropDuplicates(["lang", "h", "h2"]).select("lang", "text")


def fit(docs: DataFrame, **bounds) -> Model:
    """The model of training_sample(docs, **bounds), which is what the driver gathers."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in training_sample(docs, **bounds).collect():
        by_lang.setdefault(lang, []).append(text)
    return Model(by_lang)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with _lang_pred, _score and _bits_per_byte; only the text decides."""
    extra = [T.StructField("_lang_pred", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_bits_per_byte", T.DoubleType())]
    carried = [f for f in docs.schema.fields if f.name not in {e.name for e in extra}]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            got = list(zip(*shared.value.predict(batch.column(text_col).to_pylist()), strict=True)) or [(), (), ()]
            cols = [pa.array(v, k) for v, k in zip(got, (pa.string(), pa.float64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in carried] + cols, [f.name for f in carried + extra])
        shared.value.words = None
        tidy()

    return docs.select(*[f.name for f in carried]).mapInArrow(run, T.StructType(carried + extra))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_bits_per_byte").alias("bits_per_byte"))
