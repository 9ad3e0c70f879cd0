"""SimHash near-dedup by multi-index hashing.

Fingerprints are 64 bits. Two that differ in at most 4 bits agree, in one of
their 32-bit halves, up to 2 bits in the first or 1 bit in the second. Each
distinct fingerprint is entered under its halves and under every value one bit
away (a ball of radius 1 around the half): entries of two fingerprints meet if
their halves are at most 2 bits apart. What meets under a key is verified by
the complete distance, and only a spanning forest of the links is emitted, so
the output of a key is linear in its members.

A key with more than ``MEET_LIMIT`` members leaves that path: there, each
member is entered under all fingerprints within half the allowed distance, and
the smallest member found at such a meeting point links to all others. Two
fingerprints are within 4 bits exactly if they have a common one within 2 of
both, so this is exact too, and linear.

Rows of a fingerprint that many rows share, and fingerprints of a component that
many fingerprints share (fewer than ``HOT_SHARE`` of either exist), get their
component by a broadcast and stay where they are.

Components come from rounds of neighbour minima and pointer jumps over stored
tables; nothing is collected but the count that ends the rounds.

Results: one row per input row. Null and empty texts have fingerprint zero and
link like any other. Long texts are read whole, one at a time in a batch. Equal
fingerprints (exact copies, repeated rows) link at distance 0. A null ``doc_id``
is linked too; its component is the smallest non-null id reachable, null if
there is none. An empty table gives an empty one. Only ``doc_id`` and ``text``
are read, so other columns of any name do not matter; the stages keep them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, free_name, keyed, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Members of one key that a task compares with each other.
MEET_LIMIT = 16_384
#: A key that holds more than one row in so many is hot; there are fewer than this.
HOT_SHARE = 1000

_LANES = np.uint64(0x0101010101010101)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set (bit 0 first)."""
    counts = np.empty((8, 8), np.int64)  # [byte, bit in byte]
    runs = np.arange(0, len(h), 255)  # sums of 255 flags fit in a byte
    for b in range(8):
        lanes = np.add.reduceat((h >> np.uint64(b)) & _LANES, runs)
        counts[:, b] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0)
    return counts.ravel()


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    words = body.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        h = np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(flat[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)],
                     np.uint64)
    bits = 2 * bit_counts(h) > len(h)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, th, fp)``; the fingerprint is a signed long, ``th`` tells texts apart."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(b, shingle) for b in columns(batch, "body")[0]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "th", "fp"])

    return keyed(docs).mapInArrow(run, f"doc_id {id_type}, th long, fp long")


def ball(bits: int, radius: int) -> list[int]:
    """All ``bits``-bit masks with at most ``radius`` bits set."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m | 1 << b for m in masks for b in range(bits)} | set(masks))
    return masks


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints."""
    n = len(fps)
    fps = fps.view(np.uint64)  # bitwise_count takes the absolute value of signed numbers
    root = np.arange(n)
    out = []
    for i in range(n - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= most) + i + 1
        for j in near[root[near] != root[i]].tolist():
            if root[j] != root[i]:
                out.append((i, j))
                a, b = sorted((root[i], root[j]))
                root[root == b] = a
    return out


def links(fps: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Links ``(x, y)`` between distinct fingerprints ``fps(fp)`` that connect
    what is within ``most`` bits. ``most`` is 2 or 4: half of it is the radius at
    which the members of a large key meet."""
    if most not in (2, 4):
        raise ValueError("distances of 2 or 4 bits only")
    flips = F.array(*[F.lit(m) for m in ball(32, 1)])
    halves = F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF))
    entries = (fps.select("fp", F.posexplode(halves).alias("half", "value"))
               .select("fp", "half", "value", F.explode(flips).alias("flip"))
               .select("fp", (F.col("value").bitwiseXOR(F.col("flip")) + F.col("half") * F.lit(1 << 32)).alias("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys come sorted; a group may go on in the next batch."""
        held_key, held, over = None, [], False

        def close() -> list[tuple]:
            fs = np.concatenate(held)
            if over or len(fs) < 2:
                return []
            return [(int(fs[i]), int(fs[j])) for i, j in spanning_links(fs, most)]

        for batch in batches:
            key = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy()
            if not len(key):
                continue
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            pairs, heavy = [], []
            sizes = np.diff(cuts)
            last = len(sizes) - 1
            for k in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == last)).tolist():
                part = fp[cuts[k]:cuts[k + 1]]
                if held_key is not None and key[cuts[k]] == held_key:
                    held.append(part)
                else:
                    if held_key is not None:
                        pairs += close()
                    held_key, held, over = int(key[cuts[k]]), [part], False
                if over or sum(map(len, held)) > MEET_LIMIT:
                    heavy += np.concatenate(held).tolist()  # pass them on, keep none
                    held, over = [part[:0]], True
            out = [(x, y) for x, y in pairs] + [(x, None) for x in heavy]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["x", "y"])
        if held_key is not None:
            out = close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["x", "y"])

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = stored(entries.select("key", "fp").repartition(parts, "key").sortWithinPartitions("key")
                 .mapInArrow(run, "x long, y long"), "met")
    around = F.array(*[F.lit(signed(m)) for m in ball(64, most // 2)])
    heavy = (met.where(F.col("y").isNull()).select("x").distinct()
             .select("x", F.explode(around).alias("m")).select("x", F.col("x").bitwiseXOR(F.col("m")).alias("p")))
    centre = heavy.groupBy("p").agg(F.min("x").alias("y"), F.count("*").alias("n")).where("n > 1").select("p", "y")
    far = heavy.join(centre, "p").where("x <> y").select("x", "y").distinct()
    return met.where(F.col("y").isNotNull()).distinct().unionByName(far)


def _jump_to_roots(hook: DataFrame) -> DataFrame:
    """Pointer jumping over ``hook(node, to)`` (``to`` is smaller) until every
    node points to the end of its path: ``log2`` of the longest path rounds."""
    while True:
        nxt = hook.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
        hook = stored(hook.join(nxt, hook["to"] == nxt["_n"], "left")
                      .select("node", F.coalesce("_t", "to").alias("to"), F.col("_t").isNotNull().alias("moved")), "jumps")
        if hook.where("moved").isEmpty():
            return hook.select("node", "to")
        hook = hook.select("node", "to")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(x, y)``, the root being the
    smallest node reachable. Each round hooks every root that has a smaller
    neighbour to the smallest one and contracts the trees that arise; the roots
    left in a component at least halve, so the rounds are logarithmic."""
    down = (F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    live = stored(edges.select(*down).where("x <> y").distinct(), "edges")
    both = live.select("x").union(live.select(F.col("y").alias("x"))).distinct()
    label = both.select(F.col("x").alias("node"), F.col("x").alias("root"))
    while not live.isEmpty():
        hook = _jump_to_roots(live.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("to")))
        a = hook.select(F.col("node").alias("_a"), F.col("to").alias("_ta"))
        b = hook.select(F.col("node").alias("_b"), F.col("to").alias("_tb"))
        label = stored(label.join(a, label["root"] == a["_a"], "left")
                       .select("node", F.coalesce("_ta", "root").alias("root")), "labels")
        live = stored(live.join(a, live["x"] == a["_a"], "left").join(b, live["y"] == b["_b"], "left")
                      .select(F.coalesce("_ta", "x").alias("x"), F.coalesce("_tb", "y").alias("y"))
                      .select(*down).where("x <> y").distinct(), "live")
    return label


def joined(rows: DataFrame, key: str, table: DataFrame, on: str) -> DataFrame:
    """``rows`` joined with the stored ``table``, which has each value of ``on``
    once: its few rows marked ``hot`` are broadcast, so rows of a hot key do not
    meet in one task; the others are joined by shuffle."""
    few, rest = F.broadcast(table.where("hot")), table.where("not hot")
    others = rows.join(few.select(on), rows[key] == few[on], "left_anti")
    return rows.join(few, rows[key] == few[on]).unionByName(others.join(rest, others[key] == rest[on]))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """``(doc_id, th, fp, root, component_id)`` for every row; ``root`` is the
    component's smallest fingerprint."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("n")), "nodes")
    n_rows, n_nodes = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    root = components(links(nodes.select("fp"), most))
    member = stored(nodes.join(root, nodes["fp"] == root["node"], "left").select(
        F.col("fp").alias("_fp"), "lowest", (F.col("n") * HOT_SHARE > n_rows).alias("many"),
        F.coalesce("root", "fp").alias("root")), "members")
    lowest = stored(member.groupBy(F.col("root").alias("_root")).agg(
        F.min("lowest").alias("component_id"), (F.count("*") * HOT_SHARE > n_nodes).alias("hot")), "lowest")
    named = stored(joined(member, "root", lowest, "_root")
                   .select("_fp", F.col("many").alias("hot"), "root", "component_id"), "named")
    return joined(fps, "fp", named, "_fp").select("doc_id", "th", "fp", "root", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """What :func:`one_of_each_component` keeps, with every id once: of components
    that the same id heads, one row stays."""
    kept = one_of_each_component(docs, shingle, most)
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def one_of_each_component(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """Stage: of each component the row with the smallest id stays (of rows
    that repeat that id in it, the one with the smallest hash of the text), with
    all its columns. Of a component without any id, one row stays."""
    found = near_duplicates(docs, shingle, most)
    keep = (found.where("doc_id = component_id").groupBy("root")
            .agg(F.first("doc_id").alias("_keep"), F.min("th").alias("_th")))
    own = free_name(docs, "_row_th")
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    named = (rows.join(keep, (rows["doc_id"] == keep["_keep"]) & (rows[own] == keep["_th"]), "left_semi")
             .dropDuplicates(["doc_id", own]).select(*docs.columns))
    alone = found.where("component_id is null").groupBy("root").agg(F.min("th").alias("_th")).select("_th")
    th = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    nameless = docs.where("doc_id is null").join(alone, th == alone["_th"], "left_semi").dropDuplicates(["text"])
    return named.unionByName(nameless)
