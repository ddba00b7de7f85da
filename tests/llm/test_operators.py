"""Edge cases and brute-force comparisons of the training-data operators on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linkmill.llm import bpe, chat, langid, lines, mixing, near_vectors, ngram_join, quality, simple8b, warc
from linkmill.llm.common import text_batches, work_path
from linkmill.llm import components as components_module
from linkmill.llm.components import components

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _n_lines string"


def texts():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice((3, 30, 90)))) for _ in range(40)]
    near = [t + " tail" for t in base[:10]] + [t.upper() for t in base[10:14]]
    lined = ["\n".join(["Shared Line", f"own {i}", " shared line\t"]) for i in range(12)]
    return [None, "", "  \n\t", "a", "x" * 70_000, "same words here", "same words here", *base, *near, *lined, " ".join(words * 60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 0, "clash") for i, t in enumerate(texts())]
    rows += [rows[8], (None, "null id text", None, None, 0, "clash")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_lines(spark, docs):
    rows = docs.collect()
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").lower() for x in (t or "").split("\n")]
    holders = {}
    for n, r in enumerate(rows):
        for k in set(keys(r.text)):
            holders.setdefault(k, set()).add(("null", n) if r.doc_id is None else r.doc_id)
    count = {k: len(v) for k, v in holders.items()}
    want = sorted("\n".join(x for x, k in zip((r.text or "").split("\n"), keys(r.text), strict=True) if not (k and count[k] >= 10)) for r in rows)
    out = lines.dedup_lines(docs).collect()
    assert sorted(r.text for r in out) == want
    assert sum(r._n_dropped for r in out) == 24
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_lines_of_one_document_in_many_rows(spark):
    rows = [(5, f"one id\nrow {i}") for i in range(12)] + [(None, f"null id\nrow {i}") for i in range(12)] + [(100 + i, "ten ids") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r._n_dropped, r.text) for r in lines.dedup_lines(df).collect())
    kept = {5: "one id", None: None}
    want = sorted([(5, 0, t) for i, t in rows[:12]] + [(0, 1, f"row {i}") for i in range(12)] + [(100 + i, 1, "") for i in range(10)])
    # "row i" is in one document of id 5 and one without id; "one id" is in one document; "null id" in twelve
    assert got == want and kept


def test_quality(docs):
    got = quality.ledger(docs).select("text", "n_words", "word_chars", "n_repeat_words", "n_dup_lines").collect()
    for r in got:
        w = WORD.findall(r.text or "")
        wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        times = Counter(wins)
        covered = {p for i, x in enumerate(wins) if times[x] > 1 for p in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
    rows = {r.rule: r for r in quality.ablations(quality.ledger(docs)).collect()}
    assert rows["few_words"].n_fail > 0 and rows["few_words"].n_docs == len(got)
    assert quality.ledger(docs.limit(0)).count() == 0


def test_mixing(docs):
    out = mixing.mix(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault((r._source, r.source_size, r.target), []).append(r)
    assert abs(sum(t for _, _, t in by) - 1.5 * sum(s for _, s, _ in by)) < 1e-6
    for (_, size, target), rows in by.items():
        assert target <= 2 * size + 1e-9
        assert abs(sum(r.copies * r.size for r in rows) - target) <= max(r.size for r in rows) / 2 + 1
    assert sorted((r.row_key, r.copies) for r in mixing.mix(docs.repartition(5)).collect()) == sorted((r.row_key, r.copies) for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_in_small_intervals(spark, docs):
    """Intervals are cut until they hold few rows, also where many rows have one key or are equal."""
    rows = [(i % 40, "ab cd" if i % 3 else f"w{i} cd ef", "s") for i in range(300)] + [(None, "same row again", "t")] * 200 + [(7, "hot words here", "s")] * 150
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for df in (df.repartition(6), docs):
        whole = mixing.mix(df).collect()
        for edge_rows in (1, 20):
            cut = mixing.mix(df, edge_rows=edge_rows).collect()
            assert sorted((r.row_key, r.copies) for r in cut) == sorted((r.row_key, r.copies) for r in whole)
    flat = mixing.mix(docs.withColumn("q", docs.doc_id * 0 + 0.001), quality="q", edge_rows=3).collect()
    named = {}
    for r in flat:
        named.setdefault(r._source, []).append(r)
    assert all(abs(sum(r.copies * r.size for r in v) - v[0].target) <= max(r.size for r in v) for v in named.values())
    # a document of a thousand times the weight is among the first to be taken
    heavy = spark.createDataFrame([(i, "one two three", "s", 1000.0 if i < 20 else 0.5 if i % 2 else None) for i in range(400)], "doc_id long, text string, source string, q double")
    taken = {r._id for r in mixing.mix(heavy, quality="q", share=0.1).where("copies > 0").collect()}
    assert set(range(20)) <= taken and len(taken) == 40


def test_bpe(docs):
    import tiktoken

    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(out) == docs.count()
    for r in out:
        assert np.frombuffer(r._ids, "<u4").tolist() == enc.encode_ordinary(r.text or "")
        assert r._decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    codec, rnd = bpe.Codec(ranks, P.PATTERN), random.Random(5)
    odd = ["".join(rnd.choice(" \n\t\r\xa0 aAé漢😀0'.s<|>") for _ in range(40)) for _ in range(500)] + ["aaaa" * 400, "<|endoftext|>"]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(odd)] == [enc.encode_ordinary(t) for t in odd]


def test_simple8b(spark, docs):
    rnd = random.Random(2)
    for k in range(60):
        ids = np.array([rnd.getrandbits(rnd.choice((0, 1, 16, 20, 64))) for _ in range(rnd.randint(0, 400))], np.uint64)
        assert (simple8b.unpack(simple8b.pack(ids), len(ids)) == ids).all()
    uri = work_path(spark, "tokens")
    manifest = simple8b.write_token_files(docs, P.path("byte_bpe_50k.json"), uri, parts=3)
    out = sorted(simple8b.read_token_files(manifest, uri).collect(), key=lambda r: r.start)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = []
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id or -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in out) == sorted(want)
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:i]) for i in range(len(out))]
    assert [(r.doc_id is not None, r.doc_id or 0) for r in out] == sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.collect())
    empty = simple8b.write_token_files(docs.limit(0), P.path("byte_bpe_50k.json"), uri + "-empty")
    assert simple8b.read_token_files(empty, uri + "-empty").count() == 0
    # rows of one id, and of none, are dealt to several files
    hot = spark.createDataFrame([(None if i % 2 else 5, f"text number {i}") for i in range(400)], "doc_id long, text string")
    files = simple8b.write_token_files(hot, P.path("byte_bpe_50k.json"), uri + "-hot", parts=4).collect()
    assert len(files) == 4 and max(f.n_docs for f in files) < 200


def test_added_tokens():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    plain, encoder = Tokenizer.from_file(path), simple8b.BlockEncoder(path)
    odd = ["def <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>b\n\n", "cut <|endof", "text|> cut", "plain words", "", "x\ty <|endoftext|>\r\n"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in odd]
    assert any(len(w) == 1 for w in want)
    assert [x.tolist() for x in encoder.texts(odd)] == want


def test_language(spark):
    en, fr = "the quick brown fox jumps over the lazy dog and runs", "le renard brun saute par dessus le chien paresseux et court"
    rows = [(i, (en if i % 2 else fr) + f" {i}", "en" if i % 2 else "fr", "s", 0) for i in range(60)] + [(60, None, None, None, 0), (61, "123 .", "en", None, 0), (None, en, None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.fit(docs)
    out = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert all(out[i]._lang_pred == ("en" if i % 2 else "fr") and 0.5 < out[i]._score <= 1 for i in range(60))
    assert out[60]._lang_pred == out[61]._lang_pred == "und" and out[None]._lang_pred == "en"
    assert langid.identify(docs, langid.fit(docs.limit(0))).where("_lang_pred <> 'und'").count() == 0
    # one text decides nothing about its size: long texts are learned from, whole
    rows = [(i, en, "en") for i in range(40)] + [(100 + i, (fr + " ") * 700 + str(i), "fr") for i in range(40)]
    long = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(long, most_bytes=50_000)
    assert model.langs == ["en", "fr"] and set(langid.identify(long, model).select("_lang_pred", "lang").distinct().collect()) == {("en", "en"), ("fr", "fr")}
    sample = langid.training_sample(long, most_bytes=50_000).collect()
    assert 1 <= sum(r.lang == "fr" for r in sample) <= 3
    # copies count once, labels and documents are bounded, and what isn't a letter isn't a language
    rows = [(1, "one document again", "en")] * 500 + [(i, f"words of {i}", "en") for i in range(2, 300)] + [(1000 + i, f"junk {i}", f"x{i}") for i in range(20)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = langid.training_sample(odd, per_lang=50, most_langs=3).collect()
    assert len(langid.training_sample(odd, most_langs=3).select("lang").distinct().collect()) == 3
    assert sum(r.lang == "en" for r in taken) == 50 and sum(r.text == "one document again" for r in taken) <= 1
    signs = spark.createDataFrame([(0, "½ ² ①"), (1, "Ⅷ"), (2, "12 _"), (3, "é")], "doc_id long, text string")
    assert [r._lang_pred == "und" for r in langid.identify(signs, model).orderBy("doc_id").collect()] == [True, True, True, False]
    # equal code lengths go to the first language by code point
    same = langid.Model({"b": ["ab ab"], "a": ["ab ab"]})
    assert [x[0] for x in same.predict(["ab", "zz"])] == ["a", "a"]
    # code lengths of all bytes after a context sum to probability 1 at most, and brute force agrees
    tree = langid.ContextTree([b"abab", b"abc"], [2, 1])
    bits = tree.bits(*langid._layout([b"ab", b"zz"]), 2)

    def brute(word):
        seen, total = {}, 0.0
        for w, n in ((b"abab", 2), (b"abc", 1)):
            s = b" " + w + b" "
            for i in range(1, len(s)):
                for k in range(min(langid.ORDER, i) + 1):
                    seen.setdefault(s[i - k : i], {}).setdefault(s[i], 0)
                    seen[s[i - k : i]][s[i]] += n
        s = b" " + word + b" "
        for i in range(1, len(s)):
            for k in range(min(langid.ORDER, i), -1, -1):
                c = seen.get(s[i - k : i])
                if c is None:
                    continue
                whole = sum(c.values()) + len(c)
                if s[i] in c:
                    total -= np.log2(c[s[i]] / whole)
                    break
                total -= np.log2(len(c) / whole)
            else:
                total += 8
        return total

    assert np.allclose(bits, [brute(b"ab"), brute(b"zz")])


def test_chat(spark):
    said = "</s>[INST] ok [/INST] <\\s> <<SYS>> \\n"
    rows = [(1, i, ("system", "user", "assistant", None)[min(i, 3) if i < 4 else 1 + i % 2], said * (1 + i % 40)) for i in range(60)]
    rows += [(2, 0, "user", None), (2, 0, "user", None), (None, 0, "assistant", "x"), (3, 0, "role\nwith break", "y" * 9000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    out = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (1, 2, None, 3):
        mine = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert out[conv].n_turns == len(mine)
        assert out[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert (out[conv].loss_chars, out[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    windows = sorted(formatted.where("conv_id = 1").collect(), key=lambda w: w.window)
    # the system turn is left out only where it doesn't fit together with the window's first turn
    system = budget_of(f"<s>system\n{chat.escape(chat.parse(windows[0].text)[0][1])}</s>")
    first = lambda w: budget_of("<s>{}\n{}</s>".format(*map(chat.escape, chat.parse(w.text)[0])))
    assert len(windows) > 3 and all(w.text.startswith("<s>system\n") or w.n_repeated == 0 and system + first(w) > chat.BUDGET for w in windows)
    assert not any(c in chat.escape(said) for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>"))
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def budget_of(text):
    return sum(len(re.findall(chat.TOKEN, said)) + chat.TURN_TOKENS for _, said in chat.parse(text))


def test_chat_budget(spark):
    """Every window is within the budget, but those of one turn that is larger; what is repeated is known, and each turn is new once."""
    rnd = random.Random(1)
    rows = []
    for conv in range(60):
        if conv % 3:
            rows.append((conv, 0, "system", "rule " * (5, 100, 245, 300, 700)[conv % 5]))
        for t in range(1, rnd.randrange(2, 40)):
            rows.append((conv, t, "user" if t % 2 else "assistant", "word " * rnd.choice((0, 3, 30, 60, 120, 240, 505, 900))))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df).collect()
    assert sum(r.n_repeated for r in formatted) > 50
    by = {}
    for w in sorted(formatted, key=lambda w: (w.conv_id, w.window)):
        turns = chat.parse(w.text)
        assert budget_of(w.text) <= chat.BUDGET or len(turns) == 1 and w.n_repeated == 0
        before = by.setdefault(w.conv_id, [])
        again, new = turns[: w.n_repeated], turns[w.n_repeated :]
        if again and again[0][0] == "system":
            assert again[0] == next(t for t in before if t[0] == "system")
            again = again[1:]
        assert len(again) <= chat.HISTORY and (not again or before[-len(again) :] == again)
        system = next((t for t in before if t[0] == "system"), None)
        if system and budget_of(f"<s>system\n{system[1]}</s>") <= chat.BUDGET / 2 and budget_of(w.text) <= chat.BUDGET and w.n_repeated == 0:
            assert budget_of(w.text) + budget_of(f"<s>system\n{system[1]}</s>") > chat.BUDGET or len(new) > 0 and budget_of(f"<s>x\n{new[0][1]}</s>") + budget_of(f"<s>system\n{system[1]}</s>") > chat.BUDGET
        before += new
    want = {}
    for conv, t, role, text in sorted(rows):
        want.setdefault(conv, []).append((role, text))
    assert by == want
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert {c: r.formatted_chars for c, r in back.items()} == {c: sum(len(w.text) for w in formatted if w.conv_id == c) for c in by}


def test_queries_against_their_sql(spark, tmp_path):
    """The queries whose result SQL can tell, over odd rows."""
    duckdb = pytest.importorskip("duckdb")
    from linkmill.llm import queries as Q

    said = "</s>[INST] ok [/INST] <\\s> <<SYS>> \\n é ½"
    rnd = random.Random(7)
    turns = [(c, t, ("system" if t == 0 and c % 2 else "user" if t % 2 else "assistant"), said * rnd.choice((0, 1, 4, 9, 40))) for c in range(30) for t in range(c)] + [(40, 0, None, None), (40, 0, "user", None), (41, 0, "a\nb", "x")]
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 4, 5, 9, 30, 60, 200)] + [None, "", " \n", "A b\nshared line\n\n", "#a $b % & |"]
    texts += [f"{texts[5]} {x}" for x in "abcdef"] + [f"own {i}\nshared line" for i in range(12)]
    docs = [(i, t, "en", ("a", None, "b", "")[i % 4], 0) for i, t in enumerate(texts)]
    big = "é" * 600
    pages = [(1, "u", big), (2, "u", big), (3, "v", None), (4, "w", "tiny"), (5, "w", "tiny"), (6, None, "x" * 70_000)]
    near = [[1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [2.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 0.0], None, [1.0, float("nan"), 0.0], [0.0, 1.0, 0.3], [-1.0, 0.0, 0.0]]
    frames = {
        "conversations": (turns, "conv_id long, turn long, role string, text string"), "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "pages": (pages, "page_id long, url string, html string"), "embeddings": ([(i, v, 0) for i, v in enumerate(near)], "vec_id long, embedding array<float>, label int"),
    }
    c = duckdb.connect()
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"file://{tmp_path}/{name}.parquet")
        c.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    shown = lambda v: f"{v:.4f}" if isinstance(v, float) else str(v)
    for name, sql in Q.oracle_sql().items():
        df, r = Q.queries()[name](spark, f"file://{tmp_path}"), c.execute(sql)
        names = [x[0] for x in r.description]
        assert sorted(df.columns) == sorted(names), name
        cols = sorted(names)
        assert sorted(tuple(shown(x[k]) for k in cols) for x in df.collect()) == sorted(tuple(shown(x[names.index(k)]) for k in cols) for x in r.fetchall()), name


def test_warc(spark):
    big = "é" * 40_000 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a", big), (2, "http://b", big), (3, "u\nv", None), (4, None, "tiny"), (5, None, "tiny"), (2, "http://b", big), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    uri = work_path(spark, "warc")
    back = warc.read_archives(warc.write_archives(pages, uri), uri)
    chunks = back.collect()
    whole = {}
    for r in sorted(chunks, key=lambda r: r.chunk_no):
        if r.record_type == "response":
            whole[r.page_id] = whole.get(r.page_id, b"") + r.data
    assert whole == {2: big.encode(), 3: b"", 4: b"tiny", 5: b"tiny"}
    last = [r for r in chunks if r.last]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in last) == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "revisit", 2), (3, "response", None), (4, "response", None), (5, "response", None)]
    assert all(r.digest_so_far == r.payload_digest for r in last if r.record_type == "response")
    assert warc.read_archives(warc.write_archives(pages.limit(0), uri + "-empty"), uri + "-empty").count() == 0
    # a payload that packs well comes out in small steps, and a page without id whose row repeats
    packed = spark.createDataFrame([(None, "z", "0" * 5_000_000), (None, "z", "0" * 5_000_000), (9, "z", "0123456789abcdef" * 8 + "\r\n" * 70_000)], "page_id long, url string, html string")
    back = warc.read_archives(warc.write_archives(packed, uri + "-packed"), uri + "-packed").collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in back if r.last) == [(0, "response", None, 5_000_000), (0, "revisit", None, 5_000_000), (9, "response", None, 140_128)]
    assert max(len(r.data) for r in back) <= warc.CHUNK and sum(len(r.data) for r in back) == 5_140_128
    assert all(r.digest_so_far == r.payload_digest for r in back if r.last and r.record_type == "response")


def test_ngram_join(docs, monkeypatch):
    lower = {i: i + 32 for i in range(65, 91)}
    rows = docs.collect()
    sets = []
    for r in rows:
        w = WORD.findall((r.text or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((rows[i].doc_id for i in range(len(rows)) if group[i] == g and rows[i].doc_id is not None), default=None) for g in set(group)}
    want = sorted(((r.doc_id or -1), len(s), least[g] if least[g] is not None else -1) for r, s, g in zip(rows, sets, group, strict=True))
    told = lambda out: sorted(((r.id or -1) if r.id != 0 else -1, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in out.collect())
    want = [((a if a != 0 else -1), n, c) for a, n, c in want]
    # also with groups searched in blocks, without a first search, with every list a long one, and with ranges cut in the partition
    for settings in ({}, {"GROUP_SHINGLES": 150}, {"SHORT": 1, "GROUP_SHINGLES": 150}, {"SHORT": 1, "ROUNDS": 0}, {"RANGE_BYTES": 2_000, "REGROUP": 900, "ANSWERS": 50, "BLOCK_SHINGLES": 700, "ROUNDS": 0}):
        with monkeypatch.context() as m:
            for k, v in settings.items():
                m.setattr(ngram_join, k, v)
            assert told(ngram_join.near_groups(docs)) == want, settings
    assert ngram_join.near_groups(docs.limit(0)).count() == 0


def test_ngram_join_counts_in_one_worker_a_task(spark, docs):
    sets = [((i, 0, 0), np.arange(i, i + 9, dtype=np.uint64) << np.uint64(60)) for i in range(5)]
    packed = spark.range(0, 1, 1, 1).mapInArrow(lambda _: ngram_join._pack(sets, list(range(4))), ngram_join._PACKED)
    told = ngram_join._counted(packed, list(range(4)), 3, ngram_join._told, ngram_join._TOLD, False)
    plan = told._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 3  # to pack, to count, to tell: more of a stage's steps hold a worker each
    assert max(part.count("MapInArrow") for part in plan.split("Exchange")) == 1
    # 4-bit hashes: those of 9 values in turn, of which 5 documents share what the neighbours have
    values = [{k % 16 for k in range(i, i + 9)} for i in range(5)]
    want = {i: sum(any(x in w for j, w in enumerate(values) if j != i) for x in v) for i, v in enumerate(values)}
    assert {r.id: r.shared for r in told.collect()} == want


def test_ranges_lie_in_a_file(tmp_path):
    rnd = np.random.default_rng(1)
    parts, subs = 3, 4
    with open(tmp_path / "ranges", "w+b") as file:
        ranges, want = ngram_join._Ranges(file, parts, subs, 50), []
        for block in range(9):
            every = np.sort(rnd.integers(0, 1 << 48, 40).astype(np.uint64))
            places = np.arange(40, dtype="<u2")
            for part in range(parts):
                own = ngram_join._range_of(every, parts) == part
                ranges.add(part, block, *ngram_join._split(every[own]), places[own].tobytes())
            want += zip(every.tolist(), (places.astype(int) + (block << 16)).tolist(), strict=True)
        assert file.tell() > 0 and ranges.n < 50  # most were written before they were read
        got, seen = [], []
        for every, codes in ranges.read():
            seen.append(set(ngram_join._range_of(every, parts * subs).tolist()))
            got += zip(every.tolist(), codes.tolist(), strict=True)
    assert sorted(got) == sorted(want)
    assert [len(s) for s in seen] == [1] * (parts * subs) and [min(s) for s in seen] == list(range(parts * subs))


def test_text_batches_are_cut_by_bytes(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        text_batches(spark)
        sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"]) for b in batches)
        long = spark.range(0, 100, 1, 1).selectExpr("repeat('x', if(id = 50, 9000000, 100000)) AS text")
        got = long.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 100 and sum(r.size for r in got) >= 18_900_000  # the longest row, too, is whole
        assert sorted(r.size for r in got)[-2] < 4_300_000
        spark.conf.set(keys[1], "9m")
        text_batches(spark)
        assert spark.conf.get(keys[1]) == "9m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_search_with_known_components():
    rnd = random.Random(2)
    base = [rnd.getrandbits(60) for _ in range(400)]
    sets = [np.unique(np.array(rnd.sample(base[k * 40 : k * 40 + 60], 52), np.uint64)) for k in range(6) for _ in range(12)]
    linked = [[100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)) for b in sets] for a in sets]
    ids = np.arange(len(sets)) * 7
    for known in (None, [0] * 10 + list(range(1, len(sets) - 9)), list(range(len(sets)))):
        group = list(range(len(sets)))
        same = lambda i, j: known is not None and known[i] == known[j]
        for i in range(len(sets)):
            for j in range(i):
                if (linked[i][j] or same(i, j)) and group[i] != group[j]:
                    old, new = max(group[i], group[j]), min(group[i], group[j])
                    group = [new if g == old else g for g in group]
        node, centre = ngram_join.search(ids, sets, 75, known)
        assert dict(zip(node.tolist(), centre.tolist(), strict=True)) == {7 * i: 7 * g for i, g in enumerate(group) if i != g}


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24))
    x = np.concatenate([centres, np.repeat(centres[:4], 25, 0) + rng.normal(size=(100, 24)) * 0.1, centres[:3]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None] * 24), (904, [1.0, 2.0]), (905, [2.0, 4.0]), (906, [0.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    for block in (2048, 16):
        monkeypatch.setattr(near_vectors, "BLOCK", block)
        out = {r.id: r for r in near_vectors.near_vectors(df).collect()}
        assert len(out) == len(rows)
        got = sum(out[i].n_links for i in range(len(x)))
        assert 0.9 * linked.sum() <= got <= linked.sum() and all(out[i].n_links <= linked[i].sum() for i in range(len(x)))
        assert out[130].component_id == 0 and out[905].component_id == 904 and out[904].n_links == 1
        assert all(out[i].n_links == 0 and out[i].component_id == i for i in (900, 901, 902, 903, 906))
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_meet_by_probes():
    # two equal directions whose own buckets differ and that both probe bucket 5: once in it, nowhere else
    sig = np.array([[[1, 5], [8, 9]], [[2, 5], [8, 9]]], np.int64)
    ids, copies, unit = np.array([10, 20]), np.array([1, 3]), np.array([[1.0, 0.0], [1.0, 0.0]])
    counted = {b: near_vectors.links_in(b, ids, copies, unit, sig, None, 0.95)[0].tolist() for b in (5, 8, 9)}
    assert counted == {5: [3, 1], 8: [0, 0], 9: [0, 0]}
    # each pair with a common bucket is counted in one of them
    rng = np.random.default_rng(6)
    n, tables = 60, 3
    sig = np.stack([rng.permuted(np.tile(np.arange(12), (n, 1)), axis=1)[:, :3] * tables + t for t in range(tables)], 1)
    total = np.zeros(n, np.int64)
    for b in np.unique(sig):
        some = np.flatnonzero((sig == b).any((1, 2)))
        total[some] += near_vectors.links_in(b, some, np.ones(len(some), np.int64), np.tile([[1.0, 0.0]], (len(some), 1)), sig[some], None, 0.95)[0]
    meet = (sig[:, None, :, :, None] == sig[None, :, :, None, :]).any((2, 3, 4))
    assert total.tolist() == (meet.sum(1) - 1).tolist()


@pytest.mark.parametrize("width,places", [(64, 1), (64, 2), (64, 3), (64, 4), (256, 2), (256, 4), (24, 3)])
def test_recall_of_the_plan(width, places):
    """Pairs at the threshold meet in a bucket and are within the sketch limit, whatever the number of places."""
    _, tables, limit = near_vectors.plan(0, width, places=places)
    rng = np.random.default_rng(width + places)
    x, z = rng.normal(size=(2, 600, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * z
    a, b = (near_vectors.signatures(v, tables, places, near_vectors.PROBES) for v in (x, y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3))
    close = near_vectors.apart(near_vectors.sketches(x), near_vectors.sketches(y)) <= limit
    assert (met & close).mean() >= 0.99


def test_vectors_of_floats_and_wide_ones(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 1536))
    rows = [(i, [float(v) for v in np.float32(r)], "c") for i, r in enumerate(np.concatenate([x, x[:10] * 2 + rng.normal(size=(10, 1536)) * 0.01]))]
    df = spark.createDataFrame(rows + [(90, [0.5, 0.5], "c"), (91, [1.0, 1.0], "c"), (91, [1.0, 1.0], "c")], "vec_id long, embedding array<float>, codes string")
    out = {r.id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(df).collect()}
    assert all(out[40 + i] == (1, i) and out[i] == (1, i) for i in range(10)) and all(out[i] == (0, i) for i in range(10, 40))
    assert out[90] == (2, 90) and out[91] == (2, 90)


CLASHES = ("_ids", "_lang_pred", "_score", "n_words", "fail_bits", "size", "copies", "key", "side", "_row", "id", "h", "lang2", "k1", "text2", "component_id", "token", "part", "number", "_k1", "tokens", "vector", "sketch0")


def test_clashing_names(spark):
    """Columns of the names that operators use themselves don't disturb them."""
    rows = [(i, f"some words of document {i % 4} and more of them here", "en", "s", 1) for i in range(8)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, turn long")
    odd = plain.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES])
    ranks = P.path("byte_bpe_50k.tiktoken")
    told = {
        "bpe": lambda d: bpe.encode_decode(d, ranks, P.PATTERN).select("doc_id", "_ids_sha256"), "langid": lambda d: langid.identify(d, langid.fit(d)).select("doc_id", "_lang_pred"),
        "quality": lambda d: quality.ledger(d).select("doc_id", "n_words", "fail_bits"), "mixing": lambda d: mixing.mix(d).select("_id", "size", "copies"), "lines": lambda d: lines.dedup_lines(d, min_docs=2).select("doc_id", "text"),
        "ngram": ngram_join.near_groups, "tokens": lambda d: simple8b.read_token_files(simple8b.write_token_files(d, P.path("byte_bpe_50k.json"), u := work_path(spark, "clash")), u),
        "chat": lambda d: chat.read_back(chat.format_conversations(d.withColumnRenamed("doc_id", "conv_id").withColumnRenamed("lang", "role"))),
        "warc": lambda d: warc.read_archives(warc.write_archives(d.withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html").withColumnRenamed("source", "url"), u := work_path(spark, "clash")), u).select("page_id", "payload_digest"),
    }
    for name, f in told.items():
        assert sorted(map(repr, f(odd).collect())) == sorted(map(repr, f(plain).collect())), name


def test_components(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(50)] + [(100, 90), (90, 95), (200, 200), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    for few in (400_000, 0):
        monkeypatch.setattr(components_module, "ONE_TASK", few)
        got = {r.node: r.centre for r in components(df, "a", "b").collect()}
        assert got == {i: 0 for i in range(1, 51)} | {95: 90, 100: 90}
        assert components(df.limit(0), "a", "b").count() == 0
