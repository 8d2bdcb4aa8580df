"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

Every text becomes its set of word n-grams. Texts with equal sets are one representative from there on. In each tree of
the forest a representative is a path of labels, one byte of a minhash each, kept as one 64-bit number: in the order of
these numbers, what shares a prefix lies side by side, so they are a sorted prefix trie, and a shift shortens a prefix.

All paths begin at their full length. A pair at the threshold shares a prefix of d labels with probability threshold^d, so
the lengths in all trees tell the expected recall. Prefixes are shortened for each text by itself: wherever that leads to
a node that is not crowded, and then, the least crowded node first, until the recall reaches the target. A crowded node, as
common passages make, is thus left at its full length where other trees will do; how many texts are in a node hardly
depends on whether a given one is, so the choice doesn't spoil the recall. Texts that meet in a node in use are
a coarse group. Groups are then verified whole: all intersections inside a group are counted exactly, in blocks of a
bounded number of n-grams, so that a large group is many tasks and no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import arrow_type, cut, id_of, keyed, prepare
from tidemark.llm.words import U, WordHasher, mix, per_chunk, rolling, window_rows

#: N-grams in a block of a group; a text counts as LEAST_SHINGLES at least, so that a block has 2,000 texts at most.
BLOCK_SHINGLES, LEAST_SHINGLES = 200_000, 100


#: Bits of a label, and texts in a node from which on it is crowded.
BITS, CROWDED = 8, 64


def short_trees(threshold: float, trees: int, depth: int, shortest: int, recall: float) -> int:
    """In how many trees the prefix must be shortened for the expected recall at the threshold; all of them at most."""
    miss = lambda k: (1 - threshold**shortest) ** k * (1 - threshold**depth) ** (trees - k)
    return next((k for k in range(trees) if 1 - miss(k) >= recall), trees)


def intersections(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence blocks over the n-grams that both sides have."""
    if len(sets_a) * len(sets_b) <= 4:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets_b] for a in sets_a], np.int64)
    na, nb = [len(x) for x in sets_a], [len(x) for x in sets_b]
    fa, fb = np.concatenate(sets_a), np.concatenate(sets_b)
    shared = np.intersect1d(fa, fb)
    out = np.zeros((len(na), len(nb)), np.float64)

    def cells(flat, n):
        col = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        on = shared[col] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(col[on], kind="stable")
        return np.repeat(np.arange(len(n)), n)[on][order], col[on][order]

    (ra, ca), (rb, cb) = cells(fa, na), cells(fb, nb)
    for c in range(0, len(shared), 2048):
        x, y = np.zeros((len(na), 2048), np.float32), np.zeros((len(nb), 2048), np.float32)
        for m, r, k in ((x, ra, ca), (y, rb, cb)):
            lo, hi = np.searchsorted(k, [c, c + 2048])
            m[r[lo:hi], k[lo:hi] - c] = 1
        out += x @ y.T
    return np.rint(out).astype(np.int64)


def verified(ids: list, i: int, j: int, block: np.ndarray, weight: np.ndarray, sets: list[np.ndarray], threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(links of each member, a member that it is connected to) for blocks i and j; of two blocks only the pairs across count."""
    left = np.flatnonzero(block == i)
    right = left if i == j else np.flatnonzero(block == j)
    if not len(left) or not len(right):  # a block may be empty: the other one's pairs are counted on their own
        return np.zeros(len(ids), np.int64), np.arange(len(ids))
    n = np.array([len(x) for x in sets])
    both = intersections([sets[i] for i in left], [sets[i] for i in right])
    p, q = threshold.numerator, threshold.denominator
    hit = both * (p + q) >= p * (n[left][:, None] + n[right][None, :])
    if right is left:
        np.fill_diagonal(hit, False)
    links = np.zeros(len(ids), np.int64)
    links[left] += hit @ weight[right]
    if right is not left:
        links[right] += hit.T @ weight[left]
    root, top = np.arange(len(ids), dtype=np.int32), np.int32(len(ids))
    while True:  # each takes the least of its neighbours', until nothing changes
        before = root.copy()
        root[left] = np.minimum(root[left], np.where(hit, root[right][None, :], top).min(axis=1))
        root[right] = np.minimum(root[right], np.where(hit, root[left][:, None], top).min(axis=0))
        root = root[root]
        if (root == before).all():
            return links, root


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, threshold: float = 0.8, trees: int = 32, depth: int = 8, shortest: int = 5, recall: float = 0.9999, seed: int = 7) -> DataFrame:
    """Links texts whose sets of word n-grams have a Jaccard similarity of threshold or more.

    Returns id, class_id (the least id connected by links), n_links (other rows at the threshold or above, each equal
    text counted) and n_shingles for each row of docs. Rows with the same id are rows like others, each with its own links;
    so are rows with a null id, which counts as the least. Texts that are null, empty or have fewer words than an n-gram have
    no shingles, hence no links, and are each a class of their own. Ids may be of any type that can be ordered. The forest
    finds a pair at the threshold with the given recall at least and closer ones with more; within a group found so, every
    pair is verified, so none is lost there. Equal texts are told by 128 bits of their n-grams' hashes.
    """
    if depth * BITS > 64 or not 0 < shortest <= depth:
        raise ValueError("a path has 64 bits; shortest must not be over depth")
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_kind = base.schema["id"].dataType.simpleString()
    base = keyed(base, "id", "key").select(F.col("key").alias("id"), "text")
    kind, id_type = arrow_type(base, "id")
    share, hasher = Fraction(str(threshold)), WordHasher()

    def grams(buf, offsets):
        h, first = hasher(buf, offsets)
        w, rows = window_rows(first, ngram)
        return (rolling(h, ngram)[w] if len(w) else np.empty(0, U)), rows

    def sign(part, buf, offsets):
        """Names of all sets; paths of those that no earlier row of the slice has."""
        g, rows = grams(buf, offsets)
        n = np.bincount(rows, minlength=part.num_rows)
        begin = np.cumsum(n) - n
        distinct, name = np.zeros(len(n), np.int64), np.zeros((len(n), 2), U)
        for r in np.flatnonzero(n):
            u = np.unique(g[begin[r] : begin[r] + n[r]])
            distinct[r] = len(u)
            name[r] = u.sum(dtype=U), mix(u ^ U(seed)).sum(dtype=U)
        _, one = np.unique(np.column_stack((name, distinct.astype(U))), axis=0, return_index=True)
        new = np.zeros(len(n), bool)
        new[one] = True
        new &= n > 0
        g, size = g[new[rows]], n[new]
        path = np.zeros((len(size), trees), U)
        if len(size):
            begin = np.cumsum(size) - size
            x, m = np.random.default_rng(seed).integers(0, 1 << 63, (2, trees * depth), dtype=U) * U(2) + U(1)
            for k in range(trees * depth):
                label = mix(np.minimum.reduceat((g ^ x[k]) * m[k], begin)) >> U(64 - BITS)
                path[:, k // depth] |= label << U(64 - BITS * (k % depth + 1))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(new * trees))).astype(np.int32)), pa.array(path.reshape(-1).view(np.int64)))
        return {"id": part.column(0), "n": distinct, "x": name[:, 0].copy().view(np.int64), "y": name[:, 1].copy().view(np.int64), "paths": lists}

    def shingles(part, buf, offsets):
        g, rows = grams(buf, offsets)
        n = np.bincount(rows, minlength=part.num_rows)
        cuts = np.concatenate(([0], np.cumsum(n)))
        out = [np.unique(g[cuts[r] : cuts[r + 1]]).tobytes() for r in range(len(n))]
        return {"id": part.column(0), "set": pa.array(out, pa.binary())}

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush():
            ids = [x[0] for x in held]
            links, root = verified(ids, *now[1:], np.array([x[1] for x in held]), np.array([x[2] for x in held]), [np.frombuffer(x[3], U) for x in held], share)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(links), pa.array([ids[r] for r in root], kind)], ["id", "links", "other"])

        for batch in batches:
            for group, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (group, i, j) != now and held:
                    yield flush()
                    held = []
                now = (group, i, j)
                held.append(row)
        if held:
            yield flush()

    schema = pa.schema([("id", kind), ("n", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("paths", pa.list_(pa.int64()))])
    signed = cut(base.mapInArrow(per_chunk(sign, schema), f"id {id_type}, n long, x long, y long, paths array<long>"))
    named = signed.select("id", "n", "x", "y")
    # Written, as other tables below: the join then has a plain exchange on either side, and a set with very many copies is split.
    equal = cut(named.where("n > 0").groupBy("n", "x", "y").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")).where("weight > 1"))
    joined = named.where("n > 0").join(equal, ["n", "x", "y"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep"), F.coalesce("weight", F.lit(1)).alias("weight"))
    member = cut(joined.unionByName(named.where("n = 0").select("id", "n", F.col("id").alias("rep"), F.lit(1).cast("long").alias("weight"))))
    reps = member.where("id = rep and n > 0").select("id", "n", "weight")
    # Of equal sets any row's paths will do: they are the same, and the least id stands for all.
    paths = signed.where("size(paths) > 0").join(equal, ["n", "x", "y"], "left").select(F.coalesce("rep", "id").alias("id"), "paths").dropDuplicates(["id"])
    leaves = paths.select("id", F.posexplode("paths").alias("tree", "path"))

    def nodes(length: int) -> tuple[DataFrame, DataFrame]:
        """(leaves with their node, nodes of several leaves) at prefixes of that many labels."""
        at = leaves.withColumn("node", F.xxhash64("tree", F.shiftrightunsigned("path", 64 - BITS * length)))
        return at.select("id", "node"), at.groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("many")).where("many > 1")

    full, full_nodes = nodes(depth)
    links = full.join(full_nodes, "node").where("id > least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    need = short_trees(threshold, trees, depth, shortest, recall)
    if need:
        short, short_nodes = nodes(shortest)
        shared = cut(short.join(short_nodes, "node"))  # a prefix that no other text has costs nothing to shorten
        chosen = shared.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("many", "node"))).alias("open"))  # one for each tree at most
        size = F.greatest(F.lit(need - trees) + F.size("open"), F.size(F.filter("open", lambda n: n.many < CROWDED)))
        chosen = chosen.select(F.explode(F.slice("open", 1, size)).alias("n"))
        used = cut(chosen.select("n.node").distinct())
        links = links.union(shared.join(used, "node").where("id > least").select("id", "least"))
    groups = cut(components(links))
    sized = groups.join(reps, "id")
    blocks = cut(sized.groupBy("root").agg(F.ceil(F.sum(F.greatest("n", F.lit(LEAST_SHINGLES))) / BLOCK_SHINGLES).alias("blocks")))
    placed = sized.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    sets = base.join(placed.select("id"), "id", "left_semi").mapInArrow(per_chunk(shingles, pa.schema([("id", kind), ("set", pa.binary())])), f"id {id_type}, set binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = placed.select("root", "id", "weight", "block", "blocks").join(sets, "id").select("root", "id", "block", "weight", "set", other.alias("o"))
    dealt = dealt.select("root", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "id", "block", "weight", "set")
    found = cut(dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(check, f"id {id_type}, links long, other {id_type}"))
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    result = cut(counted.join(roots, "id", "left").select(F.col("id").alias("rep"), "links", "root"))
    out = member.join(result, "rep", "left").select("id", F.coalesce("root", "rep").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.col("n").alias("n_shingles"))
    return out.select(id_of(out, "id", id_col, id_kind), id_of(out, "class", "class_id", id_kind), "n_links", "n_shingles")
