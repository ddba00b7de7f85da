"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

Equal vectors are one class first, so copies cost nothing further. Each table rotates a class's unit vector by three rounds
of random signs and a fast Hadamard transform, and its bucket is the nearest signed axis of each of `places` such
rotations; the number of places follows the logarithm of the number of classes, so buckets stay small. A class also visits the
`probes` buckets that come next. The number of tables follows from the places and the vectors' length: it is the least by which
pairs at the threshold meet with a chance of RECALL, as found by a simulation of such pairs at planning.

Signatures are computed once and written beside the vectors. Through the buckets go ids and sketches alone, the signs of 128
rotated coordinates: a class that has no other within `sketch_limit` signs in its bucket leaves it (the limit lies eight standard
deviations above the mean of pairs at the threshold). Those that remain fetch their vectors and are verified in double
precision, in blocks of at most BLOCK classes: a larger bucket is cut into blocks that meet two by two, so none is capped. A pair
meets in each bucket that both visit, be it by a probe of both, and counts in the first one only, which its two signatures tell.
A task puts out, per class, its number of links and the centre of the group that they connect, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, copies
included; vectors of different length don't link; repeated rows are copies of each other; a null id names no component
unless all ids in it are null; other columns are left out, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.common import materialise, parts_for, small, tidy
from linkmill.llm.components import components, stars

LEAST, PROBES, RECALL, SEED = 0.95, 2, 0.999, 11
#: Classes of a block, linked pairs looked at together, pairs of sketches compared together.
BLOCK, PAIRS, SKETCHED = 2048, 400_000, 2_000_000
#: Simulated pairs at the threshold, and tables that they are looked up in.
SIMULATED, SIMULATED_TABLES = 2000, 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix of their length (a power of 2), in n log n steps."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def signatures(unit: np.ndarray, tables: int, places: int, probes: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket codes: the own bucket, then those that lose least by one other axis."""
    n, width = unit.shape
    d = 1 << max(1, (width - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :width] = unit
    rng = np.random.default_rng([seed, d])
    out = np.zeros((n, tables, 1 + probes), np.int64)
    for t in range(tables):
        axes, losses = [], []
        for _ in range(places):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, : 1 + probes]
            value = np.take_along_axis(y, top, 1)
            axes.append(2 * top + (value < 0))
            losses.append(np.abs(value[:, :1]) ** 2 - np.abs(value) ** 2)
        base = (2 * d) ** np.arange(places)
        own = sum(a[:, 0] * b for a, b in zip(axes, base, strict=True))
        out[:, t, 0] = own
        other = np.stack([own + (a[:, k] - a[:, 0]) * b for a, b in zip(axes, base, strict=True) for k in range(1, axes[0].shape[1])], 1)
        loss = np.stack([x[:, k] for x in losses for k in range(1, axes[0].shape[1])], 1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out[:, t, 1 : 1 + best.shape[1]] = np.take_along_axis(other, best, 1)
        out[:, t, 1 + best.shape[1] :] = own[:, None]
    return out


def sketches(unit: np.ndarray, seed: int = SEED) -> np.ndarray:
    """(rows, 2) unsigned 64-bit words of the signs of 128 rotated coordinates."""
    n, width = unit.shape
    d = 1 << max(1, (width - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :width] = unit
    rng = np.random.default_rng([seed, d, 128])
    bits = []
    while sum(b.shape[1] for b in bits) < 128:
        y = padded
        for _ in range(3):
            y = hadamard(y * rng.choice([-1.0, 1.0], d))
        bits.append(y > 0)
    return np.packbits(np.concatenate(bits, 1)[:, :128], axis=1).view("<u8")


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many signs sketches differ."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def simulate(width: int, places: int, least: float, probes: int) -> tuple[float, int]:
    """The chance that a pair at the threshold meets in a table, and the sketch limit."""
    rng = np.random.default_rng([SEED, width, places])
    met, differ = [], []
    step = max(1, min(SIMULATED, 2_000_000 // max(width, 1)))
    for _ in range(-(-SIMULATED // step)):
        x, z = rng.normal(size=(2, step, max(width, 2)))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        z /= np.linalg.norm(z, axis=1, keepdims=True)
        y = least * x + math.sqrt(1 - least * least) * z
        a, b = signatures(x, SIMULATED_TABLES, places, probes), signatures(y, SIMULATED_TABLES, places, probes)
        met.append((a[:, :, :, None] == b[:, :, None, :]).any((2, 3)))
        differ.append(apart(sketches(x), sketches(y)))
    differ = np.concatenate(differ)
    return float(np.concatenate(met).mean()), min(128, math.ceil(differ.mean() + 8 * differ.std()))


def plan(n: int, width: int, least: float = LEAST, probes: int = PROBES, places: int | None = None, recall: float = RECALL) -> tuple[int, int, int]:
    """(places, tables, sketch limit) for n classes of vectors of at most so many components."""
    axes = 2 * (1 << max(1, (width - 1).bit_length()))
    places = places or max(1, round(math.log(max(n, 1) / 8 + 1) / math.log(axes)))
    met, limit = simulate(width, places, least, probes)
    return places, 1 if met >= recall else max(1, math.ceil(math.log(1 - recall) / math.log(1 - max(met, 0.01)))), limit


def _mixed(codes: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """Names of buckets: their code, table and vector length, mixed to 64 bits."""
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + table.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(width)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(33))).astype(np.int64)


def _unit(raw: list[bytes], kind: str = "<f8") -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


_SIGNED = "id long, copies long, k1 long, k2 long, least_id long, vector binary, sketch0 long, sketch1 long, codes array<long>"


def _sign(places: int, tables: int, probes: int, kind: str):
    def run(batches):
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            lists = batch.column("vector")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i, size in enumerate(np.diff(at).tolist()):
                by_size.setdefault(size, []).append(i)
            for width, rows in by_size.items():
                for k in range(0, len(rows), 1000):
                    some = rows[k : k + 1000]
                    raw = [values[at[i] : at[i] + width].astype(kind).tobytes() for i in some]
                    unit = _unit(raw, kind)
                    s = signatures(unit, tables, places, probes)
                    codes = _mixed(s, np.broadcast_to(np.arange(tables)[None, :, None], s.shape), width).reshape(len(some), -1)
                    sketch = sketches(unit).astype(np.int64)
                    told = batch.take(pa.array(some, pa.int64()))
                    columns = [told.column(c) for c in ("id", "copies", "k1", "k2", "least_id")] + [pa.array(raw, pa.binary()), pa.array(sketch[:, 0]), pa.array(sketch[:, 1])]
                    lists_out = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * codes.shape[1]), pa.array(codes.ravel()))
                    yield pa.RecordBatch.from_arrays([*columns, lists_out], [c.split()[0] for c in _SIGNED.split(", ")])
        tidy()

    return run


_MEMBER = "bucket long, i long, j long, b long, id long"


def _meeting(limit: int):
    """Of rows sorted by (bucket, i, j), the members that have another within the sketch limit in their block or pair of blocks."""
    names = [c.split()[0] for c in _MEMBER.split(", ")]

    def groups(rows: dict) -> np.ndarray:
        """Row numbers of the members that stay."""
        n = len(rows["id"])
        new = np.concatenate([[True], (np.diff(rows["bucket"]) != 0) | (np.diff(rows["i"]) != 0) | (np.diff(rows["j"]) != 0)])
        heads = np.flatnonzero(new)
        ends = np.append(heads[1:], n)[np.cumsum(new) - 1]
        later = ends - np.arange(n) - 1  # rows of the group after each row
        stays = np.zeros(n, bool)
        upto = np.concatenate([[0], np.cumsum(later)])
        sketch = np.stack([rows["sketch0"], rows["sketch1"]], 1).view(np.uint64)
        a = 0
        while a < n:
            z = max(a + 1, int(np.searchsorted(upto, upto[a] + SKETCHED, side="right")) - 1)
            left = np.repeat(np.arange(a, z), later[a:z])
            right = left + 1 + np.arange(len(left)) - (upto[left] - upto[a])
            near = (apart(sketch[left], sketch[right]) <= limit) & ((rows["i"][left] == rows["j"][left]) | (rows["b"][left] != rows["b"][right]))
            stays[left[near]] = True
            stays[right[near]] = True
            a = z
        return np.flatnonzero(stays)

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            came = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*names, "sketch0", "sketch1")}
            held = {c: np.concatenate([held[c], v]) for c, v in came.items()} if held else came
            n = len(held["id"])
            if not n:
                continue
            # the last group may go on in the next batch
            same = (held["bucket"] == held["bucket"][-1]) & (held["i"] == held["i"][-1]) & (held["j"] == held["j"][-1])
            whole = n - int(same.sum())
            if whole:
                done = {c: v[:whole] for c, v in held.items()}
                kept = groups(done)
                yield pa.RecordBatch.from_arrays([pa.array(done[c][kept]) for c in names], names)
                held = {c: v[whole:] for c, v in held.items()}
        if held and len(held["id"]):
            kept = groups(held)
            yield pa.RecordBatch.from_arrays([pa.array(held[c][kept]) for c in names], names)
        tidy()

    return run


def links_in(bucket: int, ids: np.ndarray, copies: np.ndarray, unit: np.ndarray, sig: np.ndarray, side: np.ndarray | None, least: float):
    """Links of the classes of a bucket that meet in no earlier one: (links of each class, node, centre).

    sig is (rows, tables, 1 + probes) of bucket names; side, if given, tells two blocks apart, pairs of one of which don't count here.
    """
    n = len(ids)
    links = np.zeros(n, np.int64)
    src, dst = [], []
    step = max(1, PAIRS // max(1, n))
    for a in range(0, n, step):
        cosine = unit[a : a + step] @ unit.T
        i, j = np.nonzero(cosine >= least)
        i += a
        keep = i < j
        if side is not None:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        for k in range(0, len(i), PAIRS // 8):
            x, y = i[k : k + PAIRS // 8], j[k : k + PAIRS // 8]
            mine, theirs = sig[x], sig[y]
            common = (mine[:, :, :, None] == theirs[:, :, None, :]).any(3)  # visited by both, own or probed
            first = common.any(2).argmax(1)
            rows = np.arange(len(x))
            least_code = np.where(common[rows, first], mine[rows, first], np.iinfo(np.int64).max).min(1)
            here = common[rows, first].any(1) & (least_code == bucket)
            x, y = x[here], y[here]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            if len(x):
                node, centre = stars(ids[x], ids[y])
                src.append(node)
                dst.append(centre)
    if src:
        node, centre = stars(np.concatenate(src), np.concatenate(dst))
    else:
        node = centre = np.zeros(0, np.int64)
    return links, node, centre


def _verify(tables: int, least: float, kind: str):
    def run(batches):
        key, held = None, []

        def done():
            (bucket, i, j), by_size = key, {}
            for r in held:
                by_size.setdefault(len(r[2]), []).append(r)
            for rows in by_size.values():
                ids, copies = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
                sig = np.array([r[3] for r in rows], np.int64).reshape(len(rows), tables, -1)
                side = np.array([r[4] for r in rows]) if i != j else None
                links, node, centre = links_in(bucket, ids, copies, _unit([r[2] for r in rows], kind), sig, side, least)
                some = np.flatnonzero(links)
                cols = (np.concatenate([ids[some], node]), np.concatenate([links[some], np.zeros(len(node), np.int64)]), np.concatenate([ids[some], centre]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["node", "links", "centre"])

        for batch in batches:
            for bucket, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j", "id", "copies", "vector", "codes", "b")), strict=True):
                if (bucket, i, j) != key:
                    if len(held) > 1:
                        yield from done()
                    key, held = (bucket, i, j), []
                held.append(row)
        if len(held) > 1:
            yield from done()
        tidy()

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST, probes: int = PROBES, places: int | None = None, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component_id) for each row of vectors."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    real, kind = ("float", "<f4") if single else ("double", "<f8")
    # -0.0 and 0.0 are one value
    same = F.transform(v, lambda x: x.cast(real) + F.lit(0.0).cast(real))
    good = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("row_id"), same.alias("vector"), good.alias("good"))
    rows = rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(1), "vector"))
    n, width = rows.where("good").agg(F.approx_count_distinct("k1"), F.max(F.size("vector"))).first()
    places, tables, limit = plan(n, width or 1, least, probes, places, recall)
    parts = parts_for(spark)
    classes = rows.where("good").groupBy("k1", "k2").agg(F.min("row_id").alias("least_id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    signed = classes.withColumn("id", F.monotonically_increasing_id()).mapInArrow(_sign(places, tables, probes, kind), _SIGNED)
    signed = materialise(signed, "vector-classes")  # ids and signatures are made once
    member = signed.select("id", "sketch0", "sketch1", F.explode(F.array_distinct("codes")).alias("bucket"))
    full = member.groupBy("bucket").count().where(F.col("count") > BLOCK)
    full = small(materialise(full.select("bucket", F.ceil(F.col("count") / (BLOCK // 2)).alias("blocks")), "full-buckets"))
    marked = member.join(full, "bucket", "left")
    b = F.when(F.col("blocks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))))
    marked = marked.withColumn("b", b.cast("long")).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
    marked = marked.select("bucket", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "b", "id", "sketch0", "sketch1")
    dealt = marked.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    meeting = materialise(dealt.mapInArrow(_meeting(limit), _MEMBER), "meeting")
    fetched = meeting.join(signed.select("id", "copies", "vector", "codes"), "id")
    fetched = fetched.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found = materialise(fetched.mapInArrow(_verify(tables, least, kind), "node long, links long, centre long"), "links")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("links = 0"), "node", "centre")
    named = signed.select("k1", "k2", "id", "least_id", "copies").join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("centre", F.coalesce("centre", "id"))
    named = named.join(counts.withColumnRenamed("node", "id"), "id", "left")
    least_of = named.groupBy("centre").agg(F.min("least_id").alias("component_id"))
    named = materialise(named.join(least_of, "centre").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    keys = rows.select("row_id", "good", "k1", "k2")
    linked = keys.where("good").join(named, ["k1", "k2"]).select(F.col("row_id").alias("id"), "n_links", "component_id")
    return linked.unionByName(keys.where("not good").select(F.col("row_id").alias("id"), F.lit(0).cast("long").alias("n_links"), F.col("row_id").alias("component_id")))


def op6_near_vectors(spark, sf_dir: str) -> DataFrame:
    out = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


#: All pairs in double precision; holds where the hashing finds every link, as it does on the given tables.
OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a, count(*) AS n_links FROM l GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
