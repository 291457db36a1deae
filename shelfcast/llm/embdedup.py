"""Embedding near-duplicates on a robust-pruned flat graph (operator 9).

1. Equal vectors of a label are one class with a multiplicity.
2. A label's classes are split into overlapping cluster shards: each goes to
   its ``OVERLAP`` nearest of some sampled centroids, again and again until a
   shard has at most ``MAX_SHARD`` members. The assignment is salted, so a
   label with a third of all rows is many tasks.
3. In every shard each member's nearest neighbours are robust-pruned (a
   neighbour is dropped if a kept one is ``ALPHA`` times closer to it); the
   adjacency lists of a class in its shards are united.
4. In every shard a greedy beam search runs for each member from the shard's
   medoid over the united graph; while the beam is half full of results its
   range doubles, and the results' own neighbours are followed until no new
   one lies within the threshold. Cosine is computed in double precision, and
   a pair links only at or above the threshold.
5. Sampled centroids that link are one group, so a split does not cut through
   near copies. A shard whose centroids are mostly one group (a large group of
   near copies) is dealt to blocks by the angle to the group's mean, the leader.
   Two members whose angles to it add up to less than the threshold's angle link
   for certain, two whose angles differ by more do not: pairs of blocks decided
   so are counted as a whole, the others are compared: exact, in bounded tasks.

A pair that meets in several shards counts in the first one alone; shards
return one row per member (links and local component), never pairs.
`audit_recall` compares a sample of classes with all rows of their labels; a
run that misses ``MIN_RECALL`` is repeated with more effort.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import connected_components, hash_fraction, materialize

THRESHOLD = 0.98
MAX_SHARD = 2048
OVERLAP = 2
DEGREE = 24
CANDIDATES = 64
ALPHA = 1.2
BEAM = 16
SALT_ROWS = 20_000
MAX_LEVELS = 12
AUDIT_CLASSES = 512
MIN_RECALL = 0.9
EFFORTS = (1, 2, 4)          # times OVERLAP and BEAM, until the audit is content
ANGLE = float(np.arccos(THRESHOLD))
SLACK = 1e-6                 # far above the rounding of an angle
RINGS = 128                  # quantiles of the angle to the leader


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    scale = np.abs(x).max(axis=1, keepdims=True)              # so that squares neither vanish nor overflow
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (vec_id, cid), classes (cid, label, dim, vec, n, least)); cid is null where nothing can link."""
    v = F.col("embedding")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
              & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    label = F.col("label").cast("string")
    cid = F.concat(F.hex(F.xxhash64(label, v)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), label, v)))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), v.alias("vec"),
                             F.when(usable, cid).alias("cid"))
    classes = (rows.filter("cid IS NOT NULL").groupBy("cid")
               .agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("n"),
                    F.min("vec_id").alias("least")))
    return (rows.select("vec_id", "cid"),
            materialize(classes.select("cid", "label", F.size("vec").alias("dim"), "vec", "n", "least"), "classes"))


def _groups(c: np.ndarray) -> np.ndarray:
    """Group of each sampled centroid: centroids that link, directly or not, are not taken apart."""
    a, b = np.nonzero(c @ c.T >= THRESHOLD)
    return _local_components(len(c), a, b)


def _assign(members: pd.DataFrame, centroids: pd.DataFrame, overlap: int) -> pd.DataFrame:
    """Each member under its ``overlap`` nearest groups of centroids."""
    c = _unit(centroids.sort_values("cid")["vec"])
    groups, of = np.unique(_groups(c), return_inverse=True)
    near = min(overlap, len(groups))
    sims = _unit(members["vec"]) @ c.T
    per_group = np.stack([sims[:, of == g].max(axis=1) for g in range(len(groups))], axis=1)
    best = np.argsort(-per_group, axis=1, kind="stable")[:, :near]
    out = members.loc[members.index.repeat(near), ["cid", "vec", "n"]].reset_index(drop=True)
    out["path"] = np.repeat(members["path"].to_numpy(), near) + "/" + best.ravel().astype(str).astype(object)
    return out[["path", "cid", "vec", "n"]]


def _is_dense(centroids: pd.DataFrame) -> pd.DataFrame:
    """A shard is dense if half of its sampled centroids are one group: splitting would cut links. The leader is that group's mean."""
    x = _unit(centroids.sort_values("cid")["vec"])
    groups = _groups(x)
    sizes = np.bincount(groups)
    leader = x[groups == sizes.argmax()].mean(axis=0)
    norm = np.linalg.norm(leader)                              # near zero for a group all around: no leader
    return pd.DataFrame({"path": centroids["path"].iloc[:1], "dense": [bool(sizes.max() * 2 >= len(x))],
                         "leader": [(leader / norm).tolist() if norm > SLACK else None]})


def cluster_shards(classes: DataFrame, max_shard: int = MAX_SHARD, overlap: int = OVERLAP) -> tuple[DataFrame, DataFrame]:
    """(path, cid, vec, n): members of the shards to search; and of the dense ones, with their leader."""
    members = classes.select(F.concat_ws("|", "label", "dim").alias("path"), "cid", "vec", "n")
    done: list[DataFrame] = []
    dense: list[DataFrame] = []
    for level in range(MAX_LEVELS):
        sizes = materialize(members.groupBy("path").agg(F.count("*").alias("size")), "shard-sizes")
        large = sizes.filter(F.col("size") > max_shard)
        if not large.head(1):
            done.append(members)
            break
        done.append(members.join(large, "path", "left_anti"))
        split = members.join(large, "path")
        # about 2 overlap size / max_shard centroids a shard, at most 64
        wanted = F.greatest(F.lit(3.0 * overlap), 2.0 * overlap * F.col("size") / max_shard)
        share = F.least(F.lit(64.0), wanted) / F.col("size")
        centroids = materialize(split.filter(hash_fraction("path", "cid", seed=90 + level) < share)
                                .select("path", "cid", "vec", "size"), "centroids")
        state = centroids.groupBy("path").applyInPandas(lambda c: _is_dense(c), "path string, dense boolean, leader array<double>")
        # a path without a sampled centroid cannot be split either
        state = materialize(large.join(state, "path", "left").select(
            "path", "size", "leader", F.coalesce("dense", F.lit(True)).alias("dense")), "shard-state")
        solid = state.filter("dense" if level < MAX_LEVELS - 1 else "true").select("path", "leader")
        dense.append(members.join(solid, "path"))
        loose = state.join(solid, "path", "left_anti").select("path", "size")
        salts = F.ceil(F.col("size") / F.lit(SALT_ROWS)).cast("int")
        salted = (members.join(loose, "path")
                  .withColumn("salt", F.pmod(F.xxhash64("cid"), salts.cast("bigint")).cast("int")).drop("size"))
        spread = (centroids.join(loose.select("path"), "path")
                  .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select("path", "salt", "cid", "vec"))
        members = materialize(
            salted.groupBy("path", "salt").cogroup(spread.groupBy("path", "salt"))
            .applyInPandas(lambda m, c: _assign(m, c, overlap), members.select("path", "cid", "vec", "n").schema), "members")
    empty = members.limit(0)
    shards, solid = empty, empty.withColumn("leader", F.lit(None).cast("array<double>"))
    for d in done:
        shards = shards.unionByName(d)
    for d in dense:
        solid = solid.unionByName(d)
    # '!' sorts first: a pair that meets in a dense shard, where the comparison is exact, counts there
    solid = solid.withColumn("path", F.concat(F.lit("!"), "path"))
    return materialize(shards, "shards"), materialize(solid, "dense")


def prune(x: np.ndarray, order: np.ndarray, sims: np.ndarray, degree: int = DEGREE) -> list[int]:
    """Robust pruning of the neighbours ``order``, nearest first: each kept one drops what it is ``ALPHA`` times closer to."""
    near = x[order]
    # chord distances, squared: those to the node itself, and of every pair of neighbours
    dropped = ALPHA * ALPHA * (2 - 2 * (near @ near.T)) <= np.maximum(2 - 2 * sims, 0)
    kept: list[int] = []
    alive = np.ones(len(order), dtype=bool)
    for k in range(len(order)):
        if alive[k]:
            kept.append(int(order[k]))
            if len(kept) == degree:
                break
            alive &= ~dropped[k]
    return kept


def _adjacency(shard: pd.DataFrame) -> pd.DataFrame:
    """Pruned neighbour lists of one shard, by class id."""
    x, ids = _unit(shard["vec"]), shard["cid"].to_numpy()
    near = min(CANDIDATES, len(x) - 1)
    rows: list[list[str]] = []
    for start in range(0, len(x), 512):
        sims = x[start:start + 512] @ x.T
        for r in range(len(sims)):
            sims[r, start + r] = -2.0
            order = np.argpartition(-sims[r], near - 1)[:near] if near > 0 else np.array([], dtype=int)
            order = order[np.argsort(-sims[r, order], kind="stable")]
            rows.append(ids[prune(x, order, sims[r, order])].tolist())
    return pd.DataFrame({"cid": ids, "neighbours": rows})


def _search(x: np.ndarray, adjacent: list[np.ndarray], q: int, medoid: int, width: int) -> np.ndarray:
    """All members found within the threshold of q by range-expanding greedy search."""
    seen = np.zeros(len(x), dtype=bool)
    seen[[q, medoid]] = True
    pool = np.array([medoid, q]) if q != medoid else np.array([q])       # q itself is in range from the start
    sims = x[pool] @ x[q]
    opened = np.zeros(len(x), dtype=bool)
    beam = width
    while True:
        results = int((sims >= THRESHOLD).sum())
        if results * 2 > beam:
            beam = 2 * results + width                                     # grows before anything found is cut off
        top = np.argsort(-sims, kind="stable")[:beam]
        pool, sims = pool[top], sims[top]
        waiting = ~opened[pool]
        inside = waiting & (sims >= THRESHOLD)
        if inside.any():
            expand = pool[inside]                                         # follow every result at once
        elif waiting.any():
            expand = pool[waiting][:4]
        else:
            return pool[(sims >= THRESHOLD) & (pool != q)]
        opened[expand] = True
        reached = np.zeros(len(x), dtype=bool)
        reached[np.concatenate([adjacent[u] for u in expand])] = True
        new = np.flatnonzero(reached & ~seen)
        seen |= reached
        pool, sims = np.concatenate([pool, new]), np.concatenate([sims, x[new] @ x[q]])


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index reachable over the links (a, b) and (b, a)."""
    least = np.arange(n)
    while len(a):
        before = least.copy()
        np.minimum.at(least, a, least[b])
        least = least[least]
        if (least == before).all():
            break
    return least


def _first_here(paths: list, here: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True for the pairs (a, b) whose members share no earlier shard than ``here``."""
    codes: dict[str, int] = {}
    earlier = [[codes.setdefault(p, len(codes)) for p in own if p < here] for own in paths]
    other = np.full((len(earlier), max(map(len, earlier), default=0)), -1)
    for i, e in enumerate(earlier):
        other[i, :len(e)] = e
    shared = np.zeros(len(a), dtype=bool)
    for u in range(other.shape[1]):
        for v in range(other.shape[1]):
            shared |= (other[a, u] == other[b, v]) & (other[a, u] >= 0)
    return ~shared


def _link_rows(shard: pd.DataFrame, a: np.ndarray, b: np.ndarray, new: np.ndarray | slice = slice(None)) -> pd.DataFrame:
    """(cid, links, root) of a shard whose links, both ways, are (a, b); those in ``new`` count."""
    ids, n = shard["cid"].to_numpy(), shard["n"].to_numpy()
    links = np.bincount(a[new], weights=n[b[new]], minlength=len(ids)).astype(np.int64)
    return pd.DataFrame({"cid": ids, "links": links, "root": ids[_local_components(len(ids), a, b)]})


def _searched(shard: pd.DataFrame, width: int) -> pd.DataFrame:
    """Links of one shard's members found by graph search, and local components."""
    shard = shard.sort_values("cid").reset_index(drop=True)
    x, place = _unit(shard["vec"]), {c: i for i, c in enumerate(shard["cid"])}
    lists = [[place[c] for c in near if c in place] for near in shard["neighbours"]]
    back: list[list[int]] = [[] for _ in lists]                          # reverse edges: whoever is near can be reached
    for u, near in enumerate(lists):
        for v in near:
            back[v].append(u)
    adjacent = [np.unique(np.array(near + more, dtype=np.int64)) for near, more in zip(lists, back)]
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    found = [_search(x, adjacent, q, medoid, width) for q in range(len(x))]
    a = np.concatenate([np.full(len(f), q) for q, f in enumerate(found)]).astype(np.int64)
    b = np.concatenate(found).astype(np.int64)
    both = np.unique(np.concatenate([a * len(x) + b, b * len(x) + a]))   # either side may have found it
    a, b = both // len(x), both % len(x)
    return _link_rows(shard, a, b, _first_here(shard["paths"].tolist(), shard["path"].iat[0], a, b))


def _compared(blocks: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a dense shard, or within one, and local components."""
    within = blocks["i"].iat[0] == blocks["j"].iat[0]
    blocks = blocks.sort_values("cid").reset_index(drop=True)
    x, block = _unit(blocks["vec"]), blocks["block"].to_numpy()
    a, b = [np.array([], dtype=np.int64)], [np.array([], dtype=np.int64)]
    for start in range(0, len(x), 256):
        hit = x[start:start + 256] @ x.T >= THRESHOLD
        hit[np.arange(len(hit)), start + np.arange(len(hit))] = False
        if not within:
            hit &= block[start:start + 256, None] != block[None, :]
        r, c = np.nonzero(hit)
        a.append(r + start)
        b.append(c)
    return _link_rows(blocks, np.concatenate(a), np.concatenate(b))


_LINKS = "cid string, links bigint, root string"


def _graph_links(shards: DataFrame, width: int) -> DataFrame:
    """Steps 3 and 4: links per member of every shard."""
    adjacency = materialize(
        shards.groupBy("path").applyInPandas(lambda s: _adjacency(s), "cid string, neighbours array<string>")
        .groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "graph")
    return (shards.join(adjacency, "cid").groupBy("path").applyInPandas(lambda s: _searched(s, width), _LINKS))


def _angles(batches):
    """Adds each member's angle to its shard's leader; null without a leader."""
    for batch in batches:
        for _, part in batch.groupby("path"):
            leader = part["leader"].iat[0]
            part = part.drop(columns="leader")
            part["angle"] = None if leader is None else np.arccos(np.clip(_unit(part["vec"]) @ np.asarray(leader), -1.0, 1.0))
            yield part


def dense_blocks(solid: DataFrame, max_shard: int = MAX_SHARD) -> tuple[DataFrame, DataFrame]:
    """Members (path, block, cid, vec, n, angle) and pairs of blocks (path, i, j, sure, ...) that may hold links.

    A block's members have similar angles to the leader and lie in the same
    earlier dense shards, so a pair of blocks counts here as a whole or, if
    those shards overlap, there. ``sure`` pairs link member by member. A block
    that is too large, for equal angles too, is dealt by hash.
    """
    fields = ", ".join(f"{name} {kind}" for name, kind in solid.dtypes if name != "leader")
    placed = materialize(solid.mapInPandas(_angles, f"{fields}, angle double"), "dense-angles")
    cuts = placed.groupBy("path").agg(F.count("*").alias("size"), F.percentile_approx(
        "angle", [k / RINGS for k in range(1, RINGS)], 10_000).alias("cuts"))
    steps = F.least(F.lit(RINGS), F.ceil(F.col("size") * 2 / F.lit(max_shard)))
    place = F.greatest(F.size(F.filter("cuts", lambda c: c < F.col("angle"))), F.lit(0))
    ringed = (placed.join(cuts, "path").withColumn("ring", F.floor(place * steps / RINGS))
              .withColumn("earlier", F.filter("paths", lambda p: p < F.col("path")))
              .select("path", F.concat_ws("#", "ring", F.to_json("earlier")).alias("ring"), "earlier", "cid", "vec", "n", "angle"))
    parts = ringed.groupBy("path", "ring").agg(F.ceil(F.count("*") * 2 / F.lit(max_shard)).alias("parts"))
    members = materialize(
        ringed.join(parts, ["path", "ring"]).withColumn("block", F.concat_ws("#", "ring", F.pmod(F.xxhash64("cid"), "parts")))
        .drop("ring", "parts"), "dense-blocks")
    blocks = materialize(members.groupBy("path", "block").agg(
        F.first("earlier").alias("earlier"), F.min("angle").alias("low"), F.max("angle").alias("high"),
        F.sum("n").alias("weight"), F.min("cid").alias("least")), "dense-summary")
    side = lambda s: blocks.select("path", *[F.col(c).alias(f"{c}_{s}") for c in blocks.columns if c != "path"])
    gap = F.greatest(F.col("low_i") - F.col("high_j"), F.col("low_j") - F.col("high_i"))
    pairs = (side("i").join(side("j"), "path").filter("block_i <= block_j")
             .filter(~F.arrays_overlap("earlier_i", "earlier_j") & F.coalesce(gap <= ANGLE + SLACK, F.lit(True)))
             .withColumn("sure", F.coalesce(F.col("high_i") + F.col("high_j") <= ANGLE - SLACK, F.lit(False)))
             .select("path", F.col("block_i").alias("i"), F.col("block_j").alias("j"), "sure",
                     "weight_i", "weight_j", "least_i", "least_j"))
    return members.drop("earlier"), materialize(pairs, "dense-pairs")


def _dense_links(solid: DataFrame, max_shard: int) -> DataFrame:
    """Step 5: links of dense shards, from pairs of blocks that link as a whole and from compared ones."""
    members, pairs = dense_blocks(solid, max_shard)
    sure, open_ = pairs.filter("sure"), pairs.filter("NOT sure")
    partners = (sure.select("path", F.col("i").alias("block"), F.col("j").alias("other"), F.col("weight_j").alias("weight"),
                            F.col("least_j").alias("least"))
                .unionByName(sure.filter("i <> j").select(
                    "path", F.col("j").alias("block"), F.col("i").alias("other"), F.col("weight_i").alias("weight"),
                    F.col("least_i").alias("least")))
                .groupBy("path", "block").agg(F.sum("weight").alias("weight"), F.min("least").alias("root"),
                                              F.max(F.col("other") == F.col("block")).alias("itself")))
    whole = members.join(partners, ["path", "block"]).select(
        "cid", (F.col("weight") - F.when(F.col("itself"), F.col("n")).otherwise(0)).alias("links"), "root")
    between = sure.filter("i <> j").select(F.col("least_i").alias("cid"), F.lit(0).cast("bigint").alias("links"),
                                           F.col("least_j").alias("root"))
    sides = open_.select("path", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    compared = (members.join(sides, ["path", "block"]).select("path", "i", "j", "block", "cid", "vec", "n")
                .groupBy("path", "i", "j").applyInPandas(lambda p: _compared(p), _LINKS))
    return whole.unionByName(between).unionByName(compared)


def class_links(classes: DataFrame, max_shard: int = MAX_SHARD, effort: int = 1) -> tuple[DataFrame, DataFrame]:
    """(cid, links, root) from every shard: other vectors linked there and nowhere earlier; and (cid) of the dense shards."""
    shards, solid = cluster_shards(classes, max_shard, OVERLAP * effort)
    every = shards.select("cid", "path").unionByName(solid.select("cid", "path"))
    held = materialize(every.groupBy("cid").agg(F.array_sort(F.collect_set("path")).alias("paths")), "class-shards")
    links = materialize(_graph_links(shards.join(held, "cid"), BEAM * effort).unionByName(
        _dense_links(solid.join(held, "cid"), max_shard)), "links")
    return links, solid.select("cid").distinct()


def exact_links(classes: DataFrame, max_shard: int = MAX_SHARD) -> DataFrame:
    """`class_links` by comparing all classes of a label in pairs of blocks: exact, with the square of the label's size as work."""
    whole = classes.select(F.concat_ws("|", "label", "dim").alias("path"), "cid", "vec", "n")
    alike = whole.withColumn("leader", F.lit(None).cast("array<double>")).withColumn("paths", F.array("path"))
    return materialize(_dense_links(alike, max_shard), "exact-links")


def audit_recall(classes: DataFrame, links: DataFrame, sample: int = AUDIT_CLASSES,
                 compared: DataFrame | None = None) -> dict[tuple, list[float]]:
    """Recall of each of about ``sample`` classes that have true links, by (label, dim): found links over true ones.

    The classes are chosen by hash among those not in ``compared (cid)``, whose
    links are exact already; each is compared with all classes of its label, in
    blocks. Links are verified as they are found, so counts compare.
    """
    asked_of = classes if compared is None else classes.join(compared, "cid", "left_anti")
    share = sample / max(asked_of.count(), 1)
    chosen = asked_of.filter(hash_fraction("cid", seed=99) < share).select("cid", "label", "dim", "vec")
    queries = chosen.collect()                                  # about `sample` vectors
    if not queries:
        return {}
    by_label: dict[tuple, list] = {}
    for q in queries:
        by_label.setdefault((q["label"], q["dim"]), []).append((q["cid"], q["vec"]))

    def compare(batches):
        for batch in batches:
            for (label, dim), rows in batch.groupby(["label", "dim"]):
                asked = by_label.get((label, dim))
                if asked:
                    hit = _unit([v for _, v in asked]) @ _unit(rows["vec"]).T >= THRESHOLD
                    hit &= np.array([c for c, _ in asked])[:, None] != rows["cid"].to_numpy()[None, :]
                    yield pd.DataFrame({"cid": [c for c, _ in asked], "label": label, "dim": dim, "n": hit @ rows["n"].to_numpy()})

    true = classes.select("cid", "label", "dim", "vec", "n").mapInPandas(compare, "cid string, label string, dim int, n bigint")
    totals = true.groupBy("cid", "label", "dim").agg(F.sum("n").alias("true")).filter(F.col("true") > 0)
    found = links.groupBy("cid").agg(F.sum("links").alias("found"))
    out: dict[tuple, list[float]] = {}
    for r in totals.join(found, "cid", "left").collect():       # one row an asked class
        out.setdefault((r["label"], r["dim"]), []).append((r["found"] or 0) / r["true"])
    return out


def mean_recall(audit: dict[tuple, list[float]]) -> float:
    """Mean recall over the audited classes that have links, each class alike; 1.0 without any."""
    every = [r for found in audit.values() for r in found]
    return float(np.mean(every)) if every else 1.0


def near_duplicates(embeddings: DataFrame, max_shard: int = MAX_SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) per row of ``embeddings (vec_id, embedding, label)``.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and those without a label, link with nothing, as do vectors of different
    lengths. Equal vectors of a label link with each other. A row with a null
    vec_id takes part but names no component. ``recall`` is the audited figure
    of this run; below ``MIN_RECALL`` the shards are built again with more
    overlap and searched with a wider beam (``EFFORTS``), and labels that stay
    below it after that are compared in blocks, exactly. Extra columns are
    ignored; an empty table gives an empty result.
    """
    rows, classes = classes_of(embeddings)
    for effort in EFFORTS:
        links, compared = class_links(classes, max_shard, effort)
        audit = audit_recall(classes, links, compared=compared)
        recall = mean_recall(audit)
        if recall >= MIN_RECALL:
            break
    else:
        poor = [k for k, found in audit.items() if np.mean(found) < MIN_RECALL]
        again = classes.filter(F.concat_ws("|", "label", "dim").isin([f"{label}|{dim}" for label, dim in poor]))   # at most one an asked class
        links = materialize(links.join(again, "cid", "left_anti").unionByName(exact_links(again, max_shard)), "links")
        recall = mean_recall({k: [1.0] * len(found) if k in poor else found for k, found in audit.items()})
    totals = links.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(links.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    labelled = materialize(classes.select("cid", "n", "least").join(totals, "cid", "left")
                           .join(parts.withColumnRenamed("node", "cid"), "cid", "left")
                           .withColumn("component", F.coalesce("component", "cid")), "labelled")
    # a table of its own: Spark can then split the join on a component that holds many classes
    least = materialize(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    per_class = labelled.join(least, "component").select(
        "cid", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    alone = rows.filter("cid IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.filter("cid IS NOT NULL").join(per_class, "cid").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))) \
              .withColumn("recall", F.lit(recall))
