"""Near-duplicate detection by a chosen-path set similarity join on minwise hashes.

Sets: the distinct 2-word shingles of a text (words lower-cased in A-Z; 64-bit hashes of them).  Documents with
equal sets form a class and its smallest doc_id stands for it, so copies are joined once and never paired.

Join: each representative has WIDTH minwise values.  A tree maps it to paths: at a node, a hash of the path
selects one coordinate, or with probability 1/4 two, and the minwise value there names the child; the mean of
1.25 branches is 1 / THRESHOLD, so a pair at the threshold keeps about one common path at any depth.  Nodes are
first counted at a depth that grows with the logarithm of the input; those above NODE members branch on, the
others are compared exhaustively.  The number of trees follows from the recall sought and the chance that a pair at
the threshold still shares a node at that depth, averaged over the minwise values, which all trees read alike.  Members
of nodes that branched on get further trees, as many as the depth really reached needs.

Confirmed links are gathered in three passes, each on 8-bit sketches first and on the full sets in the end.  A few
trees link every document to the best of its nodes' smallest members, so that groups of near copies, however
large, become components at once.  Then all trees: nodes inside one component have nothing left to find and are
dropped, the others send a spanning forest of their pairs above an estimate 4.5 standard deviations below the
threshold, best first.  The last pass sends every other such pair whose ends are still in different components.  So no
candidate link is given up, and pairs inside a component are never listed.  For the last pass the few documents that
are left have a sketch of WIDE bytes, whose bound of 4.5 deviations lies close below the threshold, as a group of
copies may hold many that are just too far from all others.

A large node with few components is compared in blocks: a block inside one component meets only blocks that
are not, so the work is linear in a large group of near copies.  One with many components branches on, at most
MORE_LEVELS tokens more, and is then compared in blocks as well.

Defined results: a text without words (or null) has 0 shingles and is linked with nothing; a one-word text is one
shingle; rows with a null doc_id are linked with nothing and have no component; rows that repeat doc_id and text get
the same answer (a doc_id stands for one text); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsight.llm.common import free_name, releasing, written
from runsight.llm.components import components
from runsight.llm.groups import with_groups

THRESHOLD = 80  # per cent
WIDTH = 128
NODE = 2048
MORE_LEVELS = 8
RECALL = 0.9999
FIRST_TREES = 3
ESTIMATE = 0.64
WIDE, WIDE_ESTIMATE = 1024, 0.743

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(0, 2**63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, WIDE, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) over an array."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 64), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-cased words, in order."""
    data = np.frombuffer((text or "").encode().translate(_LOWER), np.uint8)
    at = np.flatnonzero(_IS_WORD[data])
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, size)
    return mixed(np.add.reduceat(_BYTE[data[at]] * powers(int(size.max()))[place], first))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's 2-word shingles."""
    h = word_hashes(text)
    if len(h) < 2:
        return mixed(h * np.uint64(3))
    return np.unique(mixed(h[:-1] * np.uint64(0xD1342543DE82EF95) + (h[1:] ^ (h[1:] >> np.uint64(23)))))


def minwise(s: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The first ``width`` minwise values of a set, 32 bits each."""
    out = np.full(width, 2**64 - 1, np.uint64)
    step_ = 2**19 // width
    for i in range(0, len(s), step_):
        part = s[i:i + step_, None] * _MUL[:width] + _ADD[:width]
        out = np.minimum(out, part.min(0))
    return (out >> np.uint64(32)).astype("<u4")


def sketches(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """(doc_id, n_shingles, digest, sig, sketch); the last three are null for texts without words.  Written.

    ``sig`` holds the minwise values, ``sketch`` their lowest bytes.
    """
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                size, digest, sig, sketch = [], [], [], []
                for t in part.column(1).to_pylist():
                    s = shingles(t)
                    size.append(len(s))
                    digest.append(hashlib.md5(s.tobytes()).hexdigest() if len(s) else None)
                    values = minwise(s) if len(s) else None
                    sig.append(None if values is None else values.tobytes())
                    sketch.append(None if values is None else values.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.string()),
                     pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "sig", "sketch"])

    return written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string"))
                   .mapInArrow(releasing(run), "doc_id long, n_shingles long, digest string, sig binary, sketch binary"), "sketches")


def first_depth(n: int) -> int:
    """Tokens chosen before nodes are counted: unlike texts share few, so 24 stands for the split of one."""
    return max(2, math.ceil(math.log(max(n, 2), 24)))


def tree_count(depth: int, recall: float = RECALL) -> int:
    """Trees needed so that a pair at the threshold shares a node of this depth in one of them.

    The trees are independent only given the signatures, so the chance is averaged over how many of the WIDTH
    minwise values agree.
    """
    p = THRESHOLD / 100
    agree = np.arange(WIDTH + 1)
    chance = np.array([math.comb(WIDTH, k) * p**k * (1 - p)**(WIDTH - k) for k in agree.tolist()])
    lost = np.zeros(WIDTH + 1)
    for _ in range(depth):
        miss = 1 - agree / WIDTH + agree / WIDTH * lost
        lost = 0.75 * miss + 0.25 * miss * miss
    trees = 1
    while chance @ lost**trees > 1 - recall:
        trees += 1
    return trees


def step(rows: np.ndarray, path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more token: (row, path) of the children; every row at a path selects the same coordinates."""
    pick = mixed(path ^ np.uint64(0x5851F42D4C957F2D))
    fork = np.flatnonzero(pick >> np.uint64(62) == 0)
    every = np.concatenate([np.arange(len(rows)), fork])
    turn = np.concatenate([np.zeros(len(rows), np.uint64), np.ones(len(fork), np.uint64)])
    p, r = path[every], rows[every]
    column = (mixed(pick[every] + turn * _BASE) % np.uint64(WIDTH)).astype(np.int64)
    value = sig[r, column].astype(np.uint64)
    return r, mixed(p * np.uint64(0xD1342543DE82EF95) + mixed(value + (column.astype(np.uint64) << np.uint64(40))))


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, WIDTH)


def _bytes(column, width: int = WIDTH) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _nodes(path, ids, part):
    return pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(ids), pa.array(part)],
                                      ["node", "id", "component"])


def paths(reps: DataFrame, depth: int, trees: int, first: int = 0) -> DataFrame:
    """(node, id, component): the nodes at ``depth`` of the trees from ``first`` that each representative reaches."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                some = batch.slice(at, 4000)
                ids, part = (some.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                sig = _signatures(some.column(2))
                rows = np.tile(np.arange(len(ids)), trees - first)
                path = mixed(np.repeat(np.arange(first + 1, trees + 1, dtype=np.uint64) * _BASE, len(ids)))
                for _ in range(depth):
                    rows, path = step(rows, path, sig)
                yield _nodes(path, ids[rows], part[rows])

    return reps.select("id", "component", "sig").mapInArrow(run, "node long, id long, component long")


def deeper(big: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, id, component) one token below the nodes of ``big``."""
    def run(batches):
        for batch in batches:
            ids, part, path = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            rows, path = step(np.arange(len(ids)), path.view(np.uint64), _signatures(batch.column(3)))
            yield _nodes(path, ids[rows], part[rows])

    return big.join(reps.select("id", "sig"), "id").select("id", "component", "node", "sig").mapInArrow(
        run, "node long, id long, component long")


def unsettled(nodes: DataFrame) -> DataFrame:
    """``nodes`` that hold more than one component, with their size n; written."""
    size = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"),
                                     F.max("component").alias("hi")).filter("lo != hi").select("node", "n")
    return written(nodes.join(size, "node"), "nodes")


def blocks(big: DataFrame, node: int) -> DataFrame:
    """Large nodes as pairs of blocks, each pair a node of its own: (node, id, component).

    A component with over half a block of rows fills blocks of its own, which need not meet each other.
    """
    own = big.groupBy("node", "component").agg(F.count(F.lit(1)).alias("c"))
    alone = F.col("c") * 2 > node
    rest = own.groupBy("node").agg(F.coalesce(F.sum(F.when(~alone, F.col("c"))), F.lit(0)).alias("rest"))
    big = big.select("node", "id", "component").join(own, ["node", "component"]).join(rest, "node")
    spread = F.when(alone, F.pmod(F.xxhash64("id", "node"), F.ceil(F.col("c") * 2 / node))).otherwise(
        F.pmod(F.xxhash64("component", "node"), F.ceil(F.greatest("rest", F.lit(1)) * 2 / node)))
    big = written(big.select("node", "id", "component", F.when(alone, F.col("component")).alias("pure"),
                             F.xxhash64("node", alone, F.when(alone, F.col("component")), spread).alias("block")),
                  "blocks")
    kinds = big.select("node", "block", "pure").distinct()
    x = kinds.select("node", F.col("block").alias("x"), F.col("pure").alias("px"))
    y = kinds.select("node", F.col("block").alias("y"), F.col("pure").alias("py"))
    meet = x.filter("px is null").join(y, "node").unionByName(
        x.filter("px is not null").join(y.filter("py is not null"), "node").filter("px != py"))
    pair = meet.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    named = pair.select(F.xxhash64("x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    return big.join(named, "block").select(F.col("pair").alias("node"), "id", "component")


def leaves(reps: DataFrame, depth: int, trees: int, node: int = NODE) -> DataFrame:
    """(node, id, component) of all nodes to be compared exhaustively.

    Every further token loses pairs, so members of the nodes that branched on get more trees, until there are as many
    as ``tree_count`` asks for at the depth reached.  Both ends of a pair that is lost there are such members.
    """
    out, members, first, reached = [], reps, 0, 0
    while first < trees:
        level = unsettled(paths(members, depth, trees, first))
        out.append(level.filter(F.col("n") <= node))
        for more in range(1, MORE_LEVELS + 1):
            big = level.filter(F.col("n") > node)
            if big.isEmpty():
                break
            many = (big.select("node", "component").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("k"))
                    .filter(F.col("k") > node).select("node"))
            out.append(blocks(big.join(many, "node", "left_anti"), node))
            on = written(big.join(many, "node", "left_semi"), "branched")
            if on.isEmpty():
                break
            reached = max(reached, more)
            if first == 0 and more == 1:  # whatever branches later is a member of these nodes
                members = written(reps.join(on.select("id").distinct(), "id", "left_semi"), "members")
            level = unsettled(deeper(on, reps))
            out.append(level.filter(F.col("n") <= node))
        else:
            out.append(blocks(level.filter(F.col("n") > node), node))
        first, trees = trees, max(trees, tree_count(depth + reached)) if reached else trees
    every = out[0].select("node", "id", "component")
    for some in out[1:]:
        every = every.unionByName(some.select("node", "id", "component"))
    return every


def stars(reps: DataFrame, depth: int, trees: int) -> DataFrame:
    """(a, b): each representative with the most similar of the smallest members of its nodes, by estimate."""
    level = written(paths(reps, depth, trees), "paths")
    least = level.groupBy("node").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pair = level.join(least, "node").filter("id != b").select(F.col("id").alias("a"), "b").distinct()
    sketch = [reps.select(F.col("id").alias(k), F.col("sketch").alias(f"sketch_{k}")) for k in "ab"]

    def run(batches):
        for batch in batches:
            est = estimate(_bytes(batch.column(2)), _bytes(batch.column(3)))
            hit = pa.array(est >= ESTIMATE)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(hit), batch.column(1).filter(hit),
                                              pa.array(est[est >= ESTIMATE])], ["a", "b", "est"])

    close = pair.join(sketch[0], "a").join(sketch[1], "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(
        run, "a long, b long, est double")
    return close.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b"))


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity by the share of equal sketch bytes, freed of chance hits."""
    return ((x == y).mean(1) - 1 / 256) / (1 - 1 / 256)


def crossing(s: np.ndarray, part: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimates and ends i < j of a node's pairs from ``least`` that lie in different components."""
    est, first, second = [np.zeros(0, np.float32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for i in range(len(part) - 1):
        other = np.flatnonzero(part[i + 1:] != part[i]) + i + 1
        if len(other):
            e = estimate(s[other], s[i])
            hit = np.flatnonzero(e >= least)
            if len(hit):
                est.append(e[hit].astype(np.float32))
                first.append(np.full(len(hit), i, np.int32))
                second.append(other[hit].astype(np.int32))
    return np.concatenate(est), np.concatenate(first), np.concatenate(second)


def forest(est: np.ndarray, i: np.ndarray, j: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """The best-first pairs that join components, until no pair joins two more."""
    root = np.unique(part, return_inverse=True)[1]
    order, out = np.argsort(-est, kind="stable"), []
    for a in range(0, len(order), 4096):
        some = order[a:a + 4096]
        for x, y in zip(i[some].tolist(), j[some].tolist(), strict=True):
            if root[x] != root[y]:
                root[root == root[y]] = root[x]
                out.append((x, y))
    return out


def pairs(members: DataFrame, every: bool) -> DataFrame:
    """Distinct (a, b) from the nodes of ``members`` (node, id, component, sketch), each compared in one run of rows.

    ``every``: all crossing pairs, by wide sketches; else a spanning forest of them, and (a, a) for each id that has
    any.  A node sends one row for each a, with its list of b, so a pair that is in many nodes costs an entry, not a row.
    """
    width, least = (WIDE, WIDE_ESTIMATE) if every else (WIDTH, ESTIMATE)

    def edges(ids, part, s):
        _, keep = np.unique(ids, return_index=True)
        ids, part, s = ids[keep], part[keep], s[keep]
        est, i, j = crossing(s, part, least)
        if not every:
            chosen = np.array(forest(est, i, j, part), np.int64).reshape(-1, 2)
            touched = np.unique(np.concatenate([i, j]))
            i, j = np.concatenate([chosen[:, 0], touched]), np.concatenate([chosen[:, 1], touched])
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        return list(zip(ids[i[first]].tolist(), np.split(ids[j], first[1:]) if len(first) else [], strict=True))

    def run(batches):
        held = None
        for batch in batches:
            cols = [*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)), _bytes(batch.column(3), width)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            cut = [0, *(np.flatnonzero(np.diff(cols[0])) + 1).tolist()]
            out = []
            for a, b in zip(cut, cut[1:], strict=False):
                out += edges(*(c[a:b] for c in cols[1:]))
            held = [c[cut[-1]:] for c in cols]
            yield table(out)
        if held is not None and len(held[0]):
            yield table(edges(*held[1:]))

    def table(out):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()),
                                           pa.array([b for _, b in out], pa.list_(pa.int64()))], ["a", "b"])

    lists = (members.select("node", "id", "component", "sketch").repartition("node").sortWithinPartitions("node")
             .mapInArrow(run, "a long, b array<long>"))
    return lists.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("b"))).alias("b")).select(
        "a", F.explode("b").alias("b"))


def full_sets(docs: DataFrame, wanted: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, items): the sorted shingle hashes of the documents whose id is in ``wanted``, written."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shingles(t).view(np.int64) for t in part.column(1).to_pylist()],
                                              pa.list_(pa.int64()))], ["id", "items"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return written(rows.join(wanted, "id", "left_semi").mapInArrow(run, "id long, items array<long>")
                   .dropDuplicates(["id"]), "sets")


def wide_sketches(sets: DataFrame) -> DataFrame:
    """(id, sketch) of WIDE bytes."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([minwise(np.asarray(x.as_py(), np.int64).view(np.uint64), WIDE).astype(np.uint8)
                                            .tobytes() for x in batch.column(1)], pa.binary())], ["id", "sketch"])

    return sets.select("id", "items").mapInArrow(run, "id long, sketch binary")


def confirmed(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of all candidate edges, decided on the full sets.  Written."""
    one, two = (sets.select(F.col("id").alias(k), F.col("items").alias(f"items_{k}")) for k in "ab")
    both = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - both
    return written(edges.join(one, "a").join(two, "b").select("a", "b", (both * 100 >= union * THRESHOLD).alias("linked")),
                   "confirmed")


def ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def in_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` (id) with their component, the id itself for those without a link."""
    return rows.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))


def classify(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    known = sketches(docs, text, id_col)
    grouped = written(with_groups(known.filter(F.col("doc_id").isNotNull())
                                  .select("doc_id", "n_shingles", "digest"), "digest", "doc_id", F.min), "classes")
    reps = written(known.join(grouped.filter(F.col("digest").isNotNull() & (F.col("doc_id") == F.col("keep_id")))
                              .select("doc_id").distinct(), "doc_id", "left_semi")
                   .select(F.col("doc_id").alias("id"), "sig", "sketch").dropDuplicates(["id"]), "reps")
    depth = first_depth(reps.count())
    alone = reps.withColumn("component", F.col("id"))
    star = written(stars(alone, depth, FIRST_TREES), "stars")
    tried = confirmed(star, full_sets(docs, ends(star), text, id_col))
    tagged = written(in_parts(reps, components(tried.filter("linked"))), "tagged")
    leaf = written(leaves(tagged, depth, tree_count(depth)), "leaves")
    found = written(pairs(leaf.join(reps.select("id", "sketch"), "id"), every=False), "pairs")
    wanted = written(ends(found), "wanted")
    sets = full_sets(docs, wanted, text, id_col)
    tried = tried.unionByName(confirmed(found.filter("a != b").join(tried, ["a", "b"], "left_anti"), sets))
    parts = written(components(tried.filter("linked")), "components")
    left = unsettled(in_parts(leaf.drop("component").join(wanted, "id", "left_semi"), parts))
    pair = written(pairs(left.join(wide_sketches(sets), "id"), every=True).join(tried, ["a", "b"], "left_anti"), "pairs")
    rest = confirmed(pair, sets)
    if not rest.filter("linked").isEmpty():
        parts = written(components(tried.unionByName(rest).filter("linked")), "components")
    out = grouped.join(parts.withColumnRenamed("id", "keep_id"), "keep_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "keep_id").alias("component_id"))
    nowhere = known.filter(F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nowhere).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose document stays (the smallest doc_id of its component), all columns kept."""
    gone = written(classify(docs, text, id_col).filter(~F.col("kept")).select("doc_id").distinct(), "near_copies")
    name = free_name(docs, "near_copy")[0]
    return docs.join(gone.withColumnRenamed("doc_id", name), F.col(id_col) == F.col(name), "left_anti")
