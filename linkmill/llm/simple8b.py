"""Token-id files in Simple-8b: a 4-bit selector in each 64-bit word says how many ids of how many bits follow.

File: b"S8BTOK01"; blocks of BLOCK ids (the last may be shorter), each a run of little-endian words; then the footer: per
block its byte offset and its number of ids, per document its id, whether that is null, and its number of ids; then the
footer's length and b"S8BEND01". Blocks decode by themselves, each selector in one vectorised step. Selector 0 is the
escape: the word after it is one id of more than 60 bits.

Documents stand in ascending id order, nulls first: texts are dealt by ranges of (document id, hash of text), a file per range, so
that rows of one id or of none can be split, too; a file is written to a name of its own attempt and then renamed, so that a
repeated task leaves the same file. Texts are encoded by the task that writes them: ids would be less to shuffle, but had to be
written first, as ranges are found by a pass of their own, and cost more than that saves.

Defined results: a null text is an empty one and has the end id only; repeated rows are written one by one, rows of one id in
order of their texts' hashes; other columns are left out, whatever their names; an empty table gives no file and no row.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.common import materialise, parts_for, tidy, work_path
from linkmill.llm.pieces import SLICE_CHARS, irregular, mark, runs

#: Fixed values of the format: (ids in a word, bits of each) by selector; 0 is the escape.
SELECTORS = ((1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
HEAD, TAIL = b"S8BTOK01", b"S8BEND01"
BLOCK = 65_536
#: Rows whose texts are held as Python strings at a time.
SLICE_ROWS = 10_000
#: Pieces encoded by one call, and characters of texts whose pieces are told apart together.
JOINED, JOINED_CHARS = 400, 16_000_000
END_ID = 2


def pack(ids: np.ndarray) -> np.ndarray:
    """The words (uint64) of ids (uint64). Each takes as many ids as fit, zeros standing in past the end."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64)
    need = np.zeros(n + 120, np.uint8)
    need[:n] = np.ceil(np.log2(ids.astype(np.float64) + 1)) if ids.max() < 1 << 50 else [int(x).bit_length() for x in ids.tolist()]
    most = {1: need}  # the bits of the widest of the next k ids
    for k in (2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120):
        half = max(m for m in most if m <= k and m >= k - m)
        top = most[half]
        most[k] = np.maximum(top[: n + 120 - k], top[k - half : n + 120 - half])
    selector = np.zeros(n, np.uint8)
    for s in range(15, 0, -1):
        k, bits = SELECTORS[s]
        fits = most[k][:n] <= bits if k < 120 else most[k][:n] == 0
        selector[fits] = s
    step = np.array([k for k, _ in SELECTORS])[selector].tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at)
    chosen = selector[at]
    padded = np.zeros(n + 120, np.uint64)
    padded[:n] = ids
    words = np.zeros((len(at), 1 + int((chosen == 0).any())), np.uint64)
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        k, bits = SELECTORS[s]
        if s == 0:
            words[rows, 1] = padded[at[rows]]
            continue
        word = np.full(len(rows), s << 60, np.uint64)
        for j in range(k if bits else 0):
            word |= padded[at[rows] + j] << np.uint64(j * bits)
        words[rows, 0] = word
    if words.shape[1] == 1:
        return words[:, 0]
    used = np.ones(words.shape, bool)
    used[:, 1] = chosen == 0
    return words[used]


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of words."""
    kind = (words >> np.uint64(60)).astype(np.uint8)
    if (kind == 0).any():  # a word after an escape is an id whatever its bits
        raw = np.zeros(len(words), bool)
        i = 0
        for i in np.flatnonzero(kind == 0).tolist():
            if not raw[i]:
                raw[i + 1] = True
        heads = np.flatnonzero(~raw)
    else:
        heads = np.arange(len(words))
    kind = kind[heads]
    count = np.array([k for k, _ in SELECTORS])[kind]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(kind).tolist():
        rows = np.flatnonzero(kind == s)
        k, bits = SELECTORS[s]
        if s == 0:
            out[start[rows]] = words[heads[rows] + 1]
            continue
        low = np.uint64((1 << bits) - 1)
        for j in range(k if bits else 0):
            out[start[rows] + j] = (words[heads[rows]] >> np.uint64(j * bits)) & low
    return out[:n]


class Writer:
    """Writes ids document by document; holds one block and the footer."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.offsets, self.counts, self.docs, self.nulls, self.sizes = [], [], [], [], []
        self._put(HEAD)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        done = 0
        while len(ids) - done >= BLOCK or last and done < len(ids):
            block = ids[done : done + BLOCK]
            self.offsets.append(self.at)
            self.counts.append(len(block))
            self._put(pack(block.astype(np.uint64)).astype("<u8").tobytes())
            done += len(block)
        self.held, self.n_held = [ids[done:]], len(ids) - done

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 4 * BLOCK:
            self._flush(False)

    def close(self) -> None:
        self._flush(True)
        foot = struct.pack("<QQ", len(self.offsets), len(self.docs))
        for values in (self.offsets, self.counts, self.docs, self.nulls, self.sizes):
            foot += np.array(values, "<i8").tobytes()
        self._put(foot + struct.pack("<Q", len(foot)) + TAIL)


def read_file(f):
    """(doc_id, ids) of each document of an open file in order, block by block."""
    f.seek(0, os.SEEK_END)
    size = f.tell()
    f.seek(size - 16)
    length, tail = struct.unpack("<Q8s", f.read(16))
    assert tail == TAIL, "not a token-id file"
    f.seek(size - 16 - length)
    foot = f.read(length)
    blocks, docs = struct.unpack_from("<QQ", foot)
    values = np.frombuffer(foot, "<i8", offset=16)
    offsets, counts, ids, nulls, sizes = np.split(values, np.cumsum([blocks, blocks, docs, docs]))
    ends = np.append(offsets[1:], size - 16 - length)
    held, n_held, b = [], 0, 0
    for doc, null, n in zip(ids.tolist(), nulls.tolist(), sizes.tolist(), strict=True):
        while n_held < n:
            f.seek(int(offsets[b]))
            got = unpack(np.frombuffer(f.read(int(ends[b] - offsets[b])), "<u8"), int(counts[b])).astype("<u4")
            held.append(got)
            n_held += len(got)
            b += 1
        every = np.concatenate(held) if len(held) != 1 else held[0]
        yield None if null else doc, every[:n]
        held, n_held = [every[n:]], n_held - n


class BlockEncoder:
    """Ids of texts by the tokenizers library, each distinct piece of a block of texts once and many pieces to a call.

    Texts are cut as in pieces.py and their pieces told apart by Arrow. Those that begin with a space are joined as they are,
    those with no white space by line feeds; the pre-tokenizer splits at each of these joints. Tokens are dealt to pieces
    where the bytes of a piece end; the library gives a byte one character. A run whose tokens don't end there is encoded
    piece by piece, and texts with other white space or an added token such as <|endoftext|> text by text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def texts(self, texts: list[str]):
        """Yields the ids of each text, whole, in order."""
        for a, b in runs(texts, JOINED_CHARS):
            odd = [irregular(t) or any(x in t for x in self.added) for t in texts[a:b]]
            regular = self._regular([t for t, o in zip(texts[a:b], odd, strict=True) if not o])
            for t, o in zip(texts[a:b], odd, strict=True):
                yield self._ids(t) if o else next(regular)

    def _regular(self, texts: list[str]):
        if not texts:
            return
        marked = pa.array([mark(t) for t in texts], pa.large_string())
        lists = pc.split_pattern(marked, "\0")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        del marked, lists
        ids, start, count = self._distinct(coded.dictionary)
        code = coded.indices.to_numpy()
        for first, last in runs(texts, SLICE_CHARS):
            here = code[bounds[first] : bounds[last]]
            n = count[here]
            ends = np.cumsum(n)
            got = ids[np.repeat(start[here] - ends + n, n) + np.arange(int(ends[-1]))]
            cuts = np.concatenate([[0], ends])[bounds[first : last + 1] - bounds[first]].tolist()
            for x, y in zip(cuts, cuts[1:], strict=False):
                yield got[x:y]

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after another, and where each piece's start and how many they are."""
        sizes = pc.binary_length(pieces).to_numpy().astype(np.int64)
        spaced = pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False)
        feed = pc.equal(pieces, "\n").to_numpy(zero_copy_only=False)
        start, count = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        ids, held = [], 0
        for places, gap in ((np.flatnonzero(spaced), ""), (np.flatnonzero(~spaced & ~feed & (sizes > 0)), "\n"), (np.flatnonzero(feed), "")):
            for k in range(0, len(places), JOINED):
                some = places[k : k + JOINED]
                names = pieces.take(pa.array(some)).to_pylist()
                got = self._ids(gap.join(names))
                ends = np.cumsum(sizes[some] + len(gap)) - len(gap)
                upto = np.concatenate([[0], np.cumsum(self.sizes[got])])
                first, last = np.searchsorted(upto, ends - sizes[some]), np.searchsorted(upto, ends)
                if upto[-1] != ends[-1] or (upto[first] != ends - sizes[some]).any() or (upto[last] != ends).any():
                    each = [self._ids(p) for p in names]
                    got, last = np.concatenate(each), np.cumsum([len(e) for e in each])
                    first = np.concatenate([[0], last[:-1]])
                start[some], count[some] = held + first, last - first
                ids.append(got)
                held += len(got)
        return np.concatenate(ids) if ids else np.zeros(0, "<u4"), start, count


_ENCODERS: dict[str, BlockEncoder] = {}


def _encoder(path: str) -> BlockEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = BlockEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, tokenizer_path: str, out_uri: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Writes docs (an integer id, a text) under out_uri; the written manifest: shard, path, n_docs, n_tokens."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    order = (F.col("id").asc_nulls_first(), F.col("h"))
    dealt = rows.repartitionByRange(parts or parts_for(docs.sparkSession), *order).sortWithinPartitions(*order).select("id", "text")
    end = np.array([end_id], "<u4")

    def run(batches):
        encoder, shard, writer, n_docs, n_tokens = _encoder(tokenizer_path), TaskContext.get().partitionId(), None, 0, 0
        fs, base = pafs.FileSystem.from_uri(out_uri)
        attempt, path = f"{base}/.attempt-{uuid.uuid4().hex}", f"{base}/shard-{shard:06d}.s8b"
        for batch in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            ids, texts = batch.column("id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for doc, got in zip(ids, encoder.texts(texts), strict=True):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(attempt, compression=None)
                    writer = Writer(stream)
                writer.add(doc, np.concatenate([got, end]))
                n_docs, n_tokens = n_docs + 1, n_tokens + len(got) + 1
        tidy()
        if writer is not None:
            writer.close()
            stream.close()
            fs.move(attempt, path)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "path": [path], "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())})

    return materialise(dealt.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, out_uri: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32."""
    scan = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(scan), F.lit(0)))
    files = files.repartition(parts_for(manifest.sparkSession), "shard")

    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(out_uri)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with fs.open_input_file(path) as f:
                    out: list[list] = [[], [], [], []]
                    for doc, ids in read_file(f):
                        for column, value in zip(out, (doc, base, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            column.append(value)
                        base += len(ids)
                        if len(out[0]) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "n_tokens", "ids_crc32"])
                            out = [[], [], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out_uri = work_path(spark, "token-files")
    return read_token_files(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), out_uri), out_uri)
