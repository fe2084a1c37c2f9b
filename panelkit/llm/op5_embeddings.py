"""Embedding near-dedup on robust-pruned flat graphs.

Vectors of one label (and dimension) are compared by cosine in double
precision; equal vectors are one node with a count. For labels of more than
SHARD nodes, centroids (k-means on a hash-picked sample of at most
SAMPLE_PER_LABEL nodes) cut the label into cells.

Overlapping shards: a cell's shard holds its own nodes and every node so
close to the bisector that a partner of an own node could be there (its
distance from the bisecting plane is at most that of a linked pair), so a
pair is never parted. A shard of more than SHARD points is cut by hash into
sub-shards that are searched one after the other by all own nodes, in blocks.

Graph: in each shard a node's nearest DEGREE_POOL points go through robust
pruning (keep the nearest, drop what lies ALPHA times nearer to it, repeat, up
to DEGREE). Edges are kept in both directions, and the adjacency lists of a
node from all its shards are united into one flat graph.

Search: for each own node a greedy beam search runs over that graph from the
shard's medoid, and from the node itself where it is one of the points; then the range is expanded: every node found within the
wider EXPAND cosine opens its neighbours, until none is new. All found pairs
are verified by their exact cosine. ``audit_recall`` compares the links of
every vector whose id is divisible by 100 with brute force over all rows.

Only links' numbers and, for each task, a star over what it linked leave the
tasks: a group of near copies is never written out as pairs.

Defined cases: vectors that are null, empty, zero, or hold a null or
non-finite component, and those without a label, have no links and are their
own component; repeated rows are vectors of their own (their component_id is
the smallest vec_id reached, null if there is none); an empty table gives no
rows; columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import saved
from panelkit.llm.components import connected_components
from panelkit.llm.fitting import _picked

THRESHOLD = 0.98
SHARD, SAMPLE_PER_LABEL, MOST_CELLS, LLOYD = 2048, 2000, 256, 8
DEGREE, DEGREE_POOL, ALPHA = 24, 64, 1.2
BEAM, BLOCK = 32, 256
#: Cosine of twice the distance of a pair at the threshold.
EXPAND = 1 - 4 * (1 - THRESHOLD)


def nodes_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows (rid, vec_id, rep), rep null for vectors without
    links; nodes (rep, label, dim, vec, copies) of unit length."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("rid", F.monotonically_increasing_id())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # scaled by the largest component, so that no square overflows or vanishes
    top = F.array_max(F.transform("v", F.abs))
    fine = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & (top > 0)
    rows = saved(rows.withColumn("v", F.when(F.coalesce(fine, F.lit(False)), F.col("v"))), "op5-rows")
    nodes = rows.where(F.col("v").isNotNull()).groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("rid").alias("rep"))
    scaled = F.transform("v", lambda x: x / top)
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    nodes = saved(nodes.withColumn("s", scaled).withColumn("n", norm)
                  .select("rep", "label", F.size("v").alias("dim"), "v", F.transform("s", lambda x: x / F.col("n")).alias("vec"), "copies"),
                  "op5-nodes")
    of = nodes.select("label", "v", "rep")
    got = rows.join(of, (rows["label"] == of["label"]) & (rows["v"] == of["v"]), "left").select("rid", "vec_id", "rep")
    return got, nodes.drop("v")


def _kmeans(x: np.ndarray, k: int) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(LLOYD):
        own = (x @ c.T - (c * c).sum(1) / 2).argmax(1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def centroids(nodes: DataFrame) -> dict:
    """{(label, dim): centroids} for the labels of more than SHARD nodes."""
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD)
    sample = (nodes.join(sizes.select(F.col("label").alias("l"), F.col("dim").alias("d"), "n"),
                         (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")))
              .where(_picked(F.col("rep"), SAMPLE_PER_LABEL / F.col("n"))).select("label", "dim", "n", "rep", "vec").toPandas())
    out = {}
    for (label, dim), part in sample.groupby(["label", "dim"]):
        part = part.sort_values("rep")
        k = int(min(MOST_CELLS, len(part), -(-part["n"].iloc[0] // SHARD)))
        if k > 1:
            out[label, dim] = np.unique(_kmeans(np.stack(part["vec"].to_numpy()), k), axis=0)
    return out


def shard_points(nodes: DataFrame, cells: dict) -> DataFrame:
    """Rows (label, dim, cell, own, rep, vec, copies): each node in its cell and in those it may have partners in."""
    kept = nodes.sparkSession.sparkContext.broadcast(cells)
    reach = float(np.sqrt(2 - 2 * THRESHOLD)) + 1e-9
    label = nodes.schema["label"].dataType.simpleString()

    def place(batches):
        for b in batches:
            for (lab, dim), part in b.groupby(["label", "dim"], sort=False):
                c = kept.value.get((lab, dim))
                if c is None:
                    yield part.assign(cell=np.int32(0), own=True)
                    continue
                x = np.stack(part["vec"].to_numpy())
                d2 = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
                own = d2.argmin(1)
                apart = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(-1), 1e-300))
                beyond = (d2 - d2[np.arange(len(x)), own][:, None]) / (2 * apart[own])
                near = beyond <= reach
                near[np.arange(len(x)), own] = True
                r, k = np.nonzero(near)
                yield part.iloc[r].assign(cell=k.astype(np.int32), own=own[r] == k)
    return nodes.select("label", "dim", "rep", "vec", "copies").mapInPandas(
        place, f"label {label}, dim int, rep long, vec array<double>, copies long, cell int, own boolean")


def pruned_graph(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to), both directions, of the robust-pruned graph of unit vectors."""
    n = len(x)
    if n < 2:
        return np.zeros(0, int), np.zeros(0, int)
    pool = min(DEGREE_POOL, n - 1)
    g = x @ x.T
    np.fill_diagonal(g, -np.inf)
    cand = np.argpartition(-g, pool - 1, axis=1)[:, :pool]
    dist = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(g, cand, 1), 0))
    live = np.ones_like(cand, bool)
    src, dst = [], []
    rows = np.arange(n)
    for _ in range(min(DEGREE, pool)):
        at = np.where(live, dist, np.inf).argmin(1)
        some = live[rows, at]
        if not some.any():
            break
        best = cand[rows, at]
        src.append(rows[some])
        dst.append(best[some])
        between = np.sqrt(np.maximum(2 - 2 * g[best[:, None], cand], 0))
        live &= ~(ALPHA * between <= dist)
        live[rows, at] = False
    a, b = np.concatenate(src), np.concatenate(dst)
    return np.concatenate([a, b]), np.concatenate([b, a])


def _build(key, part):
    part = part.sort_values("rep")
    rep = part["rep"].to_numpy()
    a, b = pruned_graph(np.stack(part["vec"].to_numpy()))
    code = np.unique(a.astype(np.int64) * len(rep) + b)
    a, b = code // len(rep), code % len(rep)
    cuts = np.searchsorted(a, np.arange(1, len(rep)))
    return pd.DataFrame({"rep": rep, "near": [rep[x].tolist() for x in np.split(b, cuts)]})


def range_search(x: np.ndarray, starts: np.ndarray, nexts: np.ndarray, queries: np.ndarray, medoid: int,
                 selves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) for the pairs of cosine THRESHOLD or more that a greedy
    search from the medoid, and from a query's own point (selves, -1 for none),
    with an expanding range finds. The graph is given by starts and nexts
    (neighbours of i: nexts[starts[i]:starts[i + 1]])."""
    n = len(x)
    degree = np.diff(starts)
    width = max(1, min(int(degree.max(initial=1)), 2 * DEGREE))
    table = np.full((n, width), -1)
    for k in range(width):  # the first neighbours of each; the range expansion follows all
        has = degree > k
        table[has, k] = nexts[starts[:-1][has] + k]
    out_q, out_p = [], []
    for q0 in range(0, len(queries), BLOCK):
        q = queries[q0:q0 + BLOCK]
        m = len(q)
        rows = np.arange(m)
        seen = np.zeros((m, n), bool)
        sim = np.full((m, n), -2.0)
        seen[:, medoid] = True
        sim[:, medoid] = q @ x[medoid]
        beam = np.full((m, BEAM), -1)
        score = np.full((m, BEAM), -np.inf)
        open_ = np.zeros((m, BEAM), bool)
        beam[:, 0], score[:, 0], open_[:, 0] = medoid, sim[:, medoid], True
        own = selves[q0:q0 + BLOCK]
        has = np.flatnonzero((own >= 0) & (own != medoid))
        seen[has, own[has]] = True
        sim[has, own[has]] = score[has, 1] = np.einsum("ij,ij->i", q[has], x[own[has]])
        beam[has, 1], open_[has, 1] = own[has], True
        while True:
            at = np.where(open_, score, -np.inf).argmax(1)
            act = np.flatnonzero(open_[rows, at])
            if not len(act):
                break
            node = beam[act, at[act]]
            open_[act, at[act]] = False
            nb = table[node]
            fresh = (nb >= 0) & ~seen[act[:, None], nb]
            r, k = np.nonzero(fresh)
            qi, pi = act[r], nb[r, k]
            s = np.einsum("ij,ij->i", q[qi], x[pi])
            seen[qi, pi] = True
            sim[qi, pi] = s
            new = np.full(nb.shape, -np.inf)
            new[r, k] = s
            all_s = np.concatenate([score[act], new], 1)
            top = np.argpartition(-all_s, BEAM - 1, axis=1)[:, :BEAM]
            score[act] = np.take_along_axis(all_s, top, 1)
            beam[act] = np.take_along_axis(np.concatenate([beam[act], nb], 1), top, 1)
            open_[act] = np.take_along_axis(np.concatenate([open_[act], fresh], 1), top, 1) & np.isfinite(score[act])
        fq, fp = np.nonzero(sim >= EXPAND)
        while len(fq):
            count = degree[fp]
            qi = np.repeat(fq, count)
            pi = nexts[np.repeat(starts[fp] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())]
            ok = ~seen[qi, pi]
            code = np.unique(qi[ok].astype(np.int64) * n + pi[ok])
            qi, pi = code // n, code % n
            s = np.einsum("ij,ij->i", q[qi], x[pi])
            seen[qi, pi] = True
            sim[qi, pi] = s
            wide = s >= EXPAND
            fq, fp = qi[wide], pi[wide]
        a, b = np.nonzero(sim >= THRESHOLD)
        out_q.append(a + q0)
        out_p.append(b)
    return np.concatenate(out_q), np.concatenate(out_p)


def _search(key, part):
    """Per own node its number of links here (links of copies counted), and the
    least node it is connected with by this task's links."""
    empty = pd.DataFrame({"rep": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
    part = part.sort_values(["asks", "rep"])
    points, asks = part[~part["asks"]], part[part["asks"]]
    if not len(points) or not len(asks):
        return empty
    rep, copies = points["rep"].to_numpy(), points["copies"].to_numpy()
    x, q = np.stack(points["vec"].to_numpy()), np.stack(asks["vec"].to_numpy())
    lists = [np.asarray(v, np.int64) for v in points["near"]]
    size = np.array([len(v) for v in lists])
    flat = np.concatenate(lists) if size.sum() else np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(rep, flat), len(rep) - 1)
    here = rep[at] == flat  # the flat graph also links to points of other shards
    owner = np.repeat(np.arange(len(rep)), size)[here]
    at = at[here]
    if len(at):
        # the nearest first, as a greedy search follows the first neighbours only
        order = np.lexsort((-np.einsum("ij,ij->i", x[owner], x[at]), owner))
        owner, at = owner[order], at[order]
    starts = np.searchsorted(owner, np.arange(len(rep) + 1))
    medoid = int((x @ x.mean(0)).argmax())
    me = asks["rep"].to_numpy()
    place = np.minimum(np.searchsorted(rep, me), len(rep) - 1)
    qi, pi = range_search(x, starts, at, q, medoid, np.where(rep[place] == me, place, -1))
    ok = me[qi] != rep[pi]
    qi, pi = qi[ok], pi[ok]
    n = np.bincount(qi, copies[pi], len(me)).astype(np.int64)
    # least label over the links, spread until nothing changes
    ids, inv = np.unique(np.concatenate([me[qi], rep[pi]]), return_inverse=True)
    a, b = inv[:len(qi)], inv[len(qi):]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    star = pd.DataFrame({"rep": ids, "n": 0, "root": ids[root]})
    return pd.concat([pd.DataFrame({"rep": me, "n": n, "root": me}), star[star["rep"] != star["root"]]]).astype(np.int64)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, n_links, component_id), one for each row."""
    rows, nodes = nodes_of(embeddings)
    points = shard_points(nodes, centroids(nodes))
    cell = ["label", "dim", "cell"]
    points = saved(points, "op5-points")
    sizes = points.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("subs"),
                                      F.greatest(F.lit(1), F.ceil(F.sum(F.col("own").cast("int")) / SHARD)).alias("blocks"))
    points = points.join(sizes, cell).withColumn("sub", F.pmod(F.xxhash64("rep"), F.col("subs")))
    key = [*cell, "sub"]
    lists = points.groupBy(*key).applyInPandas(_build, "rep long, near array<long>")
    # a node has at most one list for each cell
    graph = saved(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "op5-graph")
    index = points.join(graph, "rep")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    index = index.select(*key, blocks, F.lit(False).alias("asks"), "rep", "vec", "copies", "near")
    subs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("sub")
    asks = (points.where("own").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks"))).drop("sub")
            .select(*cell, subs, "block", F.lit(True).alias("asks"), "rep", "vec", "copies", F.lit(None).cast("array<long>").alias("near")))
    found = saved(index.unionByName(asks).groupBy(*key, "block").applyInPandas(_search, "rep long, n long, root long"), "op5-links")
    n = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = (nodes.select("rep", "copies").join(n, "rep", "left").join(roots, nodes["rep"] == roots["node"], "left")
             .select("rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")))
    named = saved(rows.join(named, "rep", "left"), "op5-named")
    ids = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return (named.join(ids, "root", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")))


def audit_recall(embeddings: DataFrame, result: DataFrame, every: int = 100) -> DataFrame:
    """One row (queries, true_links, found_links, recall): the links of every
    vector whose id is divisible by ``every``, against all rows of its label by brute force."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("q"), F.col("label").alias("l"), F.col("v").alias("w"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("v", "w") / F.sqrt(dot("v", "v") * dot("w", "w"))
    true = (asked.join(rows, (F.col("l") == F.col("label")) & (F.size("v") == F.size("w")) & (F.col("vec_id") != F.col("q")))
            .where(cosine >= THRESHOLD).groupBy("q").agg(F.count(F.lit(1)).alias("n")))
    both = asked.select("q").join(true, "q", "left").join(result.select(F.col("vec_id").alias("q"), "n_links"), "q")
    n = F.coalesce("n", F.lit(0))
    total = F.sum(n)
    hit = F.sum(F.least(n, F.col("n_links")))
    return both.agg(F.count(F.lit(1)).alias("queries"), total.alias("true_links"), hit.alias("found_links"),
                    F.when(total > 0, hit / total).otherwise(F.lit(1.0)).alias("recall"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
