"""SimHash near-dedup over a byte-position inverted index with count filtering.

Fingerprints are 64 bits: eight positional bytes. Two that differ in at most
``max_bits`` bits share at least ``8 - max_bits`` positional bytes (the
guaranteed minimum). The index keys postings by bytes together with their
positions. A posting list of one byte would hold 1/256 of the corpus, so keys
join up to three positional bytes; the position sets are a covering: whichever
positions two linked fingerprints share, one of the sets lies inside them. Thus
every link meets in some posting list, of about n / 2^24 fingerprints each. In
a list the shared positional bytes of two fingerprints are tallied, pairs below
the guaranteed minimum are dropped and the others verified bit by bit.

No pairs are emitted: a list yields a star of at most (members - 1) links that
connects the same members, found by a search that compares a fingerprint only
with members not reached yet; near copies of one text cost one pass. Lists over
``BLOCK`` distinct fingerprints are cut into blocks and each two blocks meet in
a task of their own. Links are joined to components by alternating large-star /
small-star steps, each written to the shared folder.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and links like any other; equal fingerprints are linked; repeated rows each
give a row; null ids are kept and never become a component id unless all ids of
the component are null; an empty table gives an empty result; other columns are
ignored by ``simhash_components`` and carried unchanged by ``drop_near_duplicates``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import col, free_name, keep_rows, stable, with_uid, work_table

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 50_000


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    digest = xxhash.xxh64_intdigest
    h = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        block = np.array(h[i:i + 65_536], ">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = with_uid(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), "uid")

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(fps.view(np.int64))], ["doc_id", "uid", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, uid long, fp long")


def covering(minimum: int) -> list[tuple[int, ...]]:
    """Position sets such that any ``minimum`` of the eight positions contain one."""
    if minimum <= 2:
        return list(combinations(range(8), max(1, minimum)))
    if minimum == 3:
        return list(combinations(range(8), 3))
    if minimum == 4:  # three classes: inside one, or two of one and one of the next
        classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
        sets = [c for c in classes if len(c) == 3]
        for k, c in enumerate(classes):
            sets += [(*two, x) for two in combinations(c, 2) for x in classes[(k + 1) % 3]]
        return sets
    return [s for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for s in combinations(half, 3)]


def _masks(minimum: int) -> list[int]:
    """Signed 64-bit masks of the position sets."""
    out = []
    for s in covering(minimum):
        m = sum(0xFF << (8 * p) for p in s)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def stars(fps: np.ndarray, minimum: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) links that connect a posting list's linked fingerprints."""
    left, members, roots = fps, [], []
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            x = left ^ queue.pop()
            shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            near = shared >= minimum
            near[near] = np.bitwise_count(x[near]) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                queue.extend(found)
                members.append(found)
                roots.append(np.full(len(found), root, np.uint64))
    if not members:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(members), np.concatenate(roots)


def _links(minimum: int, max_bits: int):
    """Reads postings sorted by list; yields links. Holds one list at a time."""

    def of_lists(key: np.ndarray, part: np.ndarray, fp: np.ndarray):
        cut = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]).any(1)) + 1
        start, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)]))
        two = np.flatnonzero(end - start == 2)
        a, b = fp[start[two]], fp[start[two] + 1]
        x = a ^ b
        near = ((x.view(np.uint8).reshape(-1, 8) == 0).sum(1) >= minimum) & (np.bitwise_count(x) <= max_bits)
        out = [(b[near], a[near])]
        for k in np.flatnonzero(end - start > 2):
            out.append(stars(fp[start[k]:end[k]], minimum, max_bits))
        return np.concatenate([m for m, _ in out]), np.concatenate([r for _, r in out])

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def flush(rows):
            m, r = of_lists(*rows)
            return pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(r.view(np.int64))], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [np.asarray(b.column(i)) for i in range(4)]
            now = (cols[1], np.stack([cols[0].astype(np.int64), cols[2]], 1), cols[3].astype(np.int64).view(np.uint64))
            same = held and (held[-1][0][-1] == now[0][0]) and (held[-1][1][-1] == now[1][0]).all()
            if held and not same:
                yield flush(tuple(np.concatenate(c) for c in zip(*held)))
                held = []
            # rows of the last list wait for the next batch
            change = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]).any(1))
            if len(change):
                at = change[-1] + 1
                held.append(tuple(c[:at] for c in now))
                yield flush(tuple(np.concatenate(c) for c in zip(*held)))
                held = [tuple(c[at:] for c in now)]
            else:
                held.append(now)
        if held:
            yield flush(tuple(np.concatenate(c) for c in zip(*held)))

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` as all pairs
    within ``max_bits`` bits would."""
    minimum = 8 - max_bits
    if max_bits == 0:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    masks = F.array(*[F.lit(m) for m in _masks(minimum)])
    post = (fps.select("fp", F.posexplode(masks).alias("kind", "mask"))
            .select("kind", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    hot = work_table(post.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("size"))
                     .where(F.col("size") > block), "hot_lists")
    if hot.isEmpty():
        dealt = post.select("kind", "key", F.lit(0).cast("long").alias("part"), "fp")
    else:  # each two blocks of a long list meet in a task of their own
        n = F.ceil(F.col("size") / F.lit(block))
        own = F.pmod(F.xxhash64("fp"), n)
        parts = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                            lambda x: F.least(own, x) * n + F.greatest(own, x))
        dealt = (post.join(hot, ["kind", "key"], "left")
                 .select("kind", "key", "fp", F.explode(
                     F.when(F.col("size").isNull(), F.array(F.lit(0).cast("long"))).otherwise(parts)).alias("part"))
                 .select("kind", "key", "part", "fp"))
    return (dealt.repartition("kind", "key", "part").sortWithinPartitions("kind", "key", "part", "fp")
            .mapInArrow(_links(minimum, max_bits), "a long, b long").where("a <> b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node of the component, for every node
    that has a link. Alternates large-star and small-star until nothing moves."""
    now = work_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .where("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = work_table(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id, uid, root."""
    rows = work_table(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = work_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    root = components(links(nodes.select("fp"), max_bits, block))
    placed = (nodes.join(root, nodes.fp == root.node, "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fp = placed.join(named, "root").select("fp", "component_id", "root")
    return rows.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "uid", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each component the row with the smallest id (then the first) stays."""
    docs = stable(docs)
    comp = simhash_components(docs, id_col, text_col, shingle, max_bits)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    keep = comp.groupBy("root").agg(best.alias("best")).select("best.uid")
    return keep_rows(docs, free_name("_uid", docs), keep).select(*[col(c) for c in docs.columns])
