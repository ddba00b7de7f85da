"""The corpus pipeline as a whole against a brute-force version on small tables, and its stages on odd rows."""

import hashlib
import random
import re
from math import log, log2

import pytest

import corpus_pipeline
from linkmill.llm import bpe, langid

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, _key string"
EN = "the quick brown fox jumps over a lazy dog while old rivers carry bright stones under stone bridges toward quiet northern harbours".split()
FR = "le renard brun saute par dessus un chien paresseux pendant que les vieilles rivières portent des pierres claires vers la mer".split()


def rows():
    rnd = random.Random(8)
    made = []
    for i in range(120):
        lang, words = ("en", EN) if i % 3 else ("fr", FR)
        text = " ".join(rnd.choice(words) + str(rnd.randrange(9)) * (k % 7 == 0) for k in range(rnd.choice((4, 12, 40))))
        made.append((text, lang if i % 5 else None, ("a", "b", None, "c")[i % 4 if i % 2 else 0]))
    for i in range(12):
        made.append((f"Copyright Notice of all\nown line {rnd.random()} {rnd.choice(EN)}\n copyright notice OF all\t", "en", "a"))
        made.append((made[i][0] + " tail", made[i][1], "b"))
        made.append((made[i][0].upper(), None, "c"))
    made += [("copyright notice of all", "en", "a"), (None, "en", "a"), ("", None, "b"), ("12 .. 34", "fr", "b"), (" \n\t", None, None), ("x" * 30_000 + " dog", None, "c")]
    out = [(i, *r, 0, "clash", "clash") for i, r in enumerate(made)]
    out += [out[5], out[5], (None, made[7][0], None, "b", 0, "", ""), (None, "an own null text of the old fox", None, "b", 0, "", ""), (None, "another null river under the bright bridges", None, "b", 0, "", "")]
    return out + [(9, "one id with another text about quiet harbours", "en", "c", 0, "", "")]


def crc_held(i):
    import zlib

    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def languages(docs):
    """Brute prediction by partial matching: counts of every context of every learned word."""
    trees = {}
    for i, text, lang, *_ in dict.fromkeys(docs):
        if lang is None or i is None or crc_held(i) or not text:
            continue
        seen = trees.setdefault(lang, {})
        for w in text.lower().split():
            s = b" " + w.encode() + b" "
            for k in range(1, len(s)):
                for n in range(min(langid.ORDER, k) + 1):
                    c = seen.setdefault(s[k - n : k], {})
                    c[s[k]] = c.get(s[k], 0) + 1

    def bits(seen, w):
        s, total = b" " + w.encode() + b" ", 0.0
        for k in range(1, len(s)):
            for n in range(min(langid.ORDER, k), -1, -1):
                c = seen.get(s[k - n : k])
                if c is None:
                    continue
                whole = sum(c.values()) + len(c)
                if s[k] in c:
                    total -= log2(c[s[k]] / whole)
                    break
                total -= log2(len(c) / whole)
            else:
                total += 8
        return total

    def of(text):
        if not re.search(r"[^\W\d_]", text or ""):
            return "und"
        return min(sorted(trees), key=lambda x: sum(bits(trees[x], w) for w in text.lower().split()))

    return of


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def brute_near(docs):
    """Rows (id, text, ...): one of each connected group, smallest id first and null last; of repeated rows one."""
    docs = list({(d[0], d[1]): d for d in docs}.values())
    sets = [shingles(d[1]) for d in docs]
    group = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and group[i] != group[j] and 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for i, g in enumerate(group):
        best[g] = min([best[g], i] if g in best else [i], key=lambda k: (docs[k][0] is None, docs[k][0] or 0))
    return [docs[i] for i in best.values()]


def brute_mix(docs):
    """(document, copies)"""
    size = lambda d: len(WORD.findall(d[1] or ""))
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sources)}
    whole = {s: sum(size(d) for d in docs if d[3] == s) for s in sources}
    target, open_, left = {}, set(sources), 1.5 * sum(whole.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * whole[s]}
        for s in full or open_:
            target[s] = min(share[s], 2 * whole[s])
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    out = []
    for s in sources:
        mine = []
        for d in (d for d in docs if d[3] == s):
            u = (int(hashlib.md5(str("" if d[0] is None else d[0]).encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52
            quality = max(0.25, 1 - abs(len(d[1] or "") / max(size(d), 1) - 6.5) / 10)
            mine.append((-log(u) / quality, d[0] is None, d[0] or 0, size(d), d))
        epochs = int(target[s] / whole[s] + 1e-12) if whole[s] else 0
        rest, prior = target[s] - epochs * whole[s], 0
        for *_, n, d in sorted(mine, key=lambda m: m[:4]):
            out.append((d, epochs + (prior < rest and prior + n - rest <= rest - prior)))
            prior += n
    return out


def brute_run(docs):
    import tiktoken

    of = languages(docs)
    docs = [(d[0], d[1], of(d[1]), d[3]) for d in docs]
    docs = [d for d in docs if d[2] != "und"]
    keys = lambda t: [x.strip(SPACES).translate(LOWER) for x in t.split("\n")]
    holders = {}
    for n, d in enumerate(docs):
        for k in set(keys(d[1])):
            holders.setdefault(k, set()).add(("null", n) if d[0] is None else d[0])
    count = {k: len(v) for k, v in holders.items()}
    cut = [(d[0], "\n".join(x for x, k in zip(d[1].split("\n"), keys(d[1]), strict=True) if not (k and count[k] >= 10)), *d[2:]) for d in docs]
    docs = [c for c, d in zip(cut, docs, strict=True) if c[1] == d[1] or WORD.search(c[1])]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for d, n in brute_mix(brute_near(docs)):
        ids = enc.encode_ordinary(d[1])
        told = (d[0], d[3], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(d[1].encode()).hexdigest())
        out += [told] * n
    return out


def told(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"file://{path}/documents.parquet")
    return f"file://{path}"


def test_run(spark, folder):
    want = brute_run(rows())
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = told(tuple(r) for r in got.collect())
    assert len(want) > 100 and got == told(want)
    assert sum(r.startswith("(None,") for r in got) >= 2


def test_near_duplicates_keep_what_is_alone(spark, folder):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = told((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, folder).collect())
    want = told((d[0], d[1]) for d in brute_near(rows()))
    assert len(got) == len(want)
    # of a null id and ids that repeat any text of the group may stay
    assert [g for g in got if not g.startswith(("(None", "(9,"))] == [w for w in want if not w.startswith(("(None", "(9,"))]
    assert sum(g.startswith("(9,") for g in got) == 2


def test_mixing_repeats_rows_by_their_own_copies(spark, folder):
    docs = [r[:5] for r in rows()] + [(None, "", None, "a", 0)] * 3 + [(3, "same text in rows that repeat", None, "z", 0)] * 4
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mixing_sources(spark, df, folder).collect()
    want = [(d[0], d[1], d[3]) for d, n in brute_mix(docs) for _ in range(n)]
    assert told((r.doc_id, r.text, r.source) for r in got if r.text) == told(w for w in want if w[1])


def test_stages_on_an_empty_table(spark, folder):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and out.columns == list(corpus_pipeline.COLUMNS)
    assert corpus_pipeline.STAGES[-1][1](spark, empty, folder).count() == 0
