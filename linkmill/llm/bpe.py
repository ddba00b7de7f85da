"""Byte-level BPE by corpus-level merge replay.

The distinct words of a block of texts are laid out as one sequence of symbols with links to their neighbours. An inverted
index holds, for each mergeable pair (by the rank of its joined bytes), the positions at which it stands. Ranks are taken
in ascending order; all positions of a rank are merged at once, and only the pairs with the touched neighbours are indexed
anew. Words in which a merge makes a pair of a lower rank are merged by themselves, so ids equal those of merging each
word alone. The block is a task's slice of the corpus, so memory is bounded and nothing is shuffled.

Defined results: a null text is an empty one, with no ids; repeated rows are encoded alike; other columns pass through;
an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from linkmill.llm.common import tidy
from linkmill.llm.pieces import PieceEncoder

#: Bytes of ids in an output batch.
OUT_BYTES = 8_000_000
#: Rows whose texts are held as Python strings at a time.
SLICE_ROWS = 1000
#: Distinct words remembered at most by a worker, ids decoded at a time, and the rank of what can't be merged.
MOST_WORDS, DECODED, NONE = 250_000, 200_000, 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeReplay:
    """Ids of words by rank order, all words of a block together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for whole, rank in ranks.items():
            for k in range(1, len(whole)):
                if (a := ranks.get(whole[:k])) is not None and (b := ranks.get(whole[k:])) is not None:
                    pairs[a << 32 | b] = rank
        self.pair_codes = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[c] for c in self.pair_codes.tolist()], np.int64)
        self.words: dict[str, bytes] = {}

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the joined bytes of two tokens; NONE if there is no such token."""
        codes = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_codes, codes), len(self.pair_codes) - 1)
        return np.where(self.pair_codes[at] == codes, self.pair_ranks[at], NONE)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        ends = np.cumsum([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        n = len(flat)
        token = np.append(self.of_byte[flat], -1)
        # place n stands for "no neighbour"
        right, left = np.arange(1, n + 2), np.arange(-1, n)
        right[ends - 1] = n
        right[n] = n
        left[np.concatenate([[0], ends[:-1]])] = n
        left[n] = n
        # pair[i]: rank of the pair of i and its right neighbour
        pair = np.full(n + 1, NONE)
        whole = np.flatnonzero(right[:n] < n)
        pair[whole] = self.pair_rank(token[whole], token[whole + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            heads = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
            for a, b, r in zip(heads.tolist(), [*heads[1:].tolist(), len(ranks)], ranks[heads].tolist(), strict=True):
                if r in index:
                    index[r].append(places[a:b])
                else:
                    index[r] = [places[a:b]]
                    heappush(heap, r)

        some = np.flatnonzero(pair < NONE)
        if len(some):
            add(some, pair[some])
        alone: list[np.ndarray] = []
        while heap:
            rank = heappop(heap)
            at = index.pop(rank)
            at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
            at = at[pair[at] == rank]
            if len(at) > 1:
                # pairs that overlap in a chain: the first, third, ... are merged
                chained = np.concatenate([[False], right[at[:-1]] == at[1:]])
                if chained.any():
                    heads = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - heads) % 2 == 0]
            if not len(at):
                continue
            gone = right[at]
            after, before = right[gone], left[at]
            token[at] = rank
            token[gone] = -1
            pair[gone] = NONE
            right[at] = after
            left[after] = at
            right[n], left[n] = n, n
            touched = np.concatenate([at, before[before < n]])
            beside = right[touched]
            # a left neighbour may itself be merged away in this step's chain only if it is `gone`, which has no pair
            ranks = np.where((beside < n) & (token[touched] >= 0), self.pair_rank(token[touched], token[beside]), NONE)
            pair[touched] = ranks
            live = ranks < NONE
            if live.any():
                touched, ranks = touched[live], ranks[live]
                if (ranks < rank).any():
                    alone.append(touched[ranks < rank])
                add(touched, ranks)
        alive = token[:n] >= 0
        upto = np.concatenate([[0], np.cumsum(alive)])
        out = token[:n][alive].astype("<u4").tobytes()
        cuts = (upto[np.concatenate([[0], ends])] * 4).tolist()
        got = [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        # a merge that makes a pair of a lower rank goes back in the order; such words are merged by themselves
        for w in np.unique(np.searchsorted(ends, np.concatenate(alone), side="right")).tolist() if alone else ():
            got[w] = self.word(words[w])
        return got

    def word(self, word: bytes) -> bytes:
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
            if (least := min(ranks)) == NONE:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return b"".join(self.ranks[p].to_bytes(4, "little") for p in parts)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        split = [self.pattern.findall(p) for p in pieces]
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        words, ranks = self.words, self.ranks
        new = set()
        for s in split:
            new.update(s)
        new.difference_update(words.keys())
        learn, raw = [], []
        for w in new:
            b = w.encode()
            if b in ranks:
                words[w] = ranks[b].to_bytes(4, "little")
            else:
                learn.append(w)
                raw.append(b)
        words.update(zip(learn, self.replay(raw), strict=True))
        return [words[s[0]] if len(s) == 1 else b"".join(map(words.__getitem__, s)) for s in split]


class Codec:
    """Encodes texts to ids and decodes ids to bytes, by a rank file and a pre-tokenizer's pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = MergeReplay(ranks, pattern)
        self.encoder = PieceEncoder(self.merges.pieces)
        by_id = {v: k for k, v in ranks.items()}
        vocab = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sizes = np.array([len(v) for v in vocab], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.vocab = np.frombuffer(b"".join(vocab), np.uint8)

    def encode(self, texts: list[str]):
        """Yields the ids of each text, as little-endian unsigned 32-bit integers in bytes."""
        return self.encoder.texts(texts)

    def forget(self) -> None:
        self.encoder.known.clear()
        self.merges.words.clear()

    def decode(self, ids: bytes) -> bytes:
        out = []
        for k in range(0, len(ids), 4 * DECODED):
            tokens = np.frombuffer(ids[k : k + 4 * DECODED], "<u4")
            sizes = self.sizes[tokens]
            before = np.cumsum(sizes) - sizes
            out.append(self.vocab[np.repeat(self.starts[tokens] - before, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One for each rank file and worker process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """docs with _n_tokens, _ids_sha256, _decoded_sha256 and, if keep_ids, _ids (little-endian unsigned 32-bit, binary).

    The columns of docs other than those pass through; the ids are decoded again in the same pass.
    """
    extra = [T.StructField("_n_tokens", T.LongType()), T.StructField("_ids_sha256", T.StringType()), T.StructField("_decoded_sha256", T.StringType())]
    extra += [T.StructField("_ids", T.BinaryType())] * keep_ids
    names = [f.name for f in extra]
    carried = [f for f in docs.schema.fields if f.name not in names]

    def run(batches):
        c = codec(ranks_path, pattern)
        for batch in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            held, start, size = [], 0, 0
            for i, x in enumerate(c.encode(texts)):
                held.append((len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(c.decode(x)).hexdigest(), *[x] * keep_ids))
                size += len(x)
                if size > OUT_BYTES or i + 1 == len(texts):
                    cols = [pa.array(v, k) for v, k in zip(zip(*held, strict=True), (pa.int64(), pa.string(), pa.string(), pa.binary()), strict=False)]
                    yield pa.RecordBatch.from_arrays([batch.column(f.name).slice(start, len(held)) for f in carried] + cols, [f.name for f in carried] + names)
                    held, start, size = [], i + 1, 0
        c.forget()
        tidy()

    return docs.select(*[f.name for f in carried]).mapInArrow(run, T.StructType(carried + extra))


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)
    return out.selectExpr("doc_id", "_n_tokens AS n_tokens", "_ids_sha256 AS ids_sha256", "_decoded_sha256 AS decoded_sha256")
