"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors are one vector with a count and a number of its own, numbered by id. Vectors are dealt to the shards of their
   ``overlap`` nearest pivots, pivots being vectors drawn by hash; shards above ``LIMIT``
   members are split again the same way, and by hash what no pivots part. One shard of a
   vector is its home.
2. In each shard every member is given edges by robust pruning: the nearest other member
   is linked, all those are dropped to which it is a short cut, and so on.
3. The lists of a vector from all its shards are united, in both directions.
4. In each shard, every member searches the united graph: a greedy search with a beam
   from the shard's medoid, then the range is expanded from everything found in it, over
   edges, until nothing new is within it. Cosines are of doubles, so a link found is exact.
   A link counts in the home of its far end, so each counts once.
5. Edges that leave the shard are followed by visits: a vector is compared with all that
   are at home where the vectors found have edges to, and so on from what is found there,
   until no vector has a shard left to ask. A group near each other spread over many shards
   is thus compared block by block.
6. Every build is audited. ``PROBES`` drawn vectors at most get a copy beside them, turned to a
   cosine of ``least`` or more; the copies are searched for in the same graph, count for nobody
   and join nothing. Beside them about ``audited`` vectors are asked, those divisible by
   ``EVERY`` first. What both should find is counted against all vectors. Below ``RECALL``, of
   all links or of a vector's in the mean, of either, the graph is built again with more
   overlap, and at last it is an error. The recall measured is logged.

Links are never shuffled as pairs: a shard gives counts, and of what it joined a star.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, written

logger = logging.getLogger(__name__)

SIMILARITY = 0.95
OVERLAP = 2
MEMBERS = 2048
LIMIT = 4096
PIVOTS = 8192
DEGREE = 32
ALPHA = 1.2
BEAM = 16
AUDITED = 4096
PROBES = 1024
EVERY = 50
LINKED = 100
RECALL = 0.9
MOST_OVERLAP = 16
STEPS = 1 << 30
BLOCK = 256
PAIRS = 1 << 14


def vectors_of(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def prune(points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust-pruned out-edges of every point: (points, degree) of row numbers, -1 where there are fewer."""
    count = len(points)
    distance = points.astype(np.float32) @ points.astype(np.float32).T
    distance *= -2
    distance += 2
    np.sqrt(np.maximum(distance, 0, out=distance), out=distance)
    np.fill_diagonal(distance, np.inf)
    out = np.full((count, degree), -1)
    for at in range(0, count, BLOCK):
        own = distance[at : at + BLOCK]
        left, rows = own.copy(), np.arange(len(own))
        for k in range(min(degree, count - 1)):
            nearest = left.argmin(axis=1)
            more = np.isfinite(left[rows, nearest])
            if not more.any():
                break
            out[at + rows[more], k] = nearest[more]
            # What lies nearer to the new neighbour, by the factor, is reached through it.
            left[np.float32(alpha) * distance[nearest] <= own] = np.inf
            left[rows, nearest] = np.inf
    return out


def medoid(points: np.ndarray) -> int:
    return int((points @ points.mean(axis=0)).argmax())


def search(points: np.ndarray, edges: np.ndarray, start: int, least: float, beam: int = BEAM) -> np.ndarray:
    """Which points each point finds within the range: a boolean matrix, its diagonal false.

    ``edges`` holds the neighbours of each point in a row, -1 beyond its last.
    """
    blocks = [_search(points, edges, start, least, beam, at) for at in range(0, len(points), BLOCK)]
    found = np.concatenate(blocks)
    np.fill_diagonal(found, False)
    return found


def _search(points: np.ndarray, edges: np.ndarray, start: int, least: float, beam: int, first: int) -> np.ndarray:
    """``search`` for a block of points from ``first``."""
    asked = points[first : first + BLOCK]
    count = len(asked)
    rows = np.arange(count)
    seen = np.zeros((count, len(points)), bool)
    seen[:, start] = True
    pool = np.full((count, beam), -1)
    value = np.full((count, beam), -np.inf)
    done = np.ones((count, beam), bool)
    pool[:, 0], value[:, 0], done[:, 0] = start, asked @ points[start], False
    found = np.zeros((count, len(points)), bool)
    found[value[:, 0] >= least, start] = True
    while True:
        best = np.where(done, -np.inf, value).argmax(axis=1)
        active = np.flatnonzero(~done[rows, best])
        if not len(active):
            break
        done[active, best[active]] = True
        near = edges[pool[active, best[active]]]
        which = np.repeat(active, near.shape[1])
        near = near.ravel()
        fresh = near >= 0
        which, near = which[fresh], near[fresh]
        fresh = ~seen[which, near]
        which, near = which[fresh], near[fresh]
        if not len(which):
            continue
        seen[which, near] = True
        cosine = np.einsum("ij,ij->i", asked[which], points[near])
        found[which[cosine >= least], near[cosine >= least]] = True
        sizes = np.bincount(which, minlength=count)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        width = int(sizes.max())
        who = np.flatnonzero(sizes)
        number = np.full(count, -1)
        number[who] = np.arange(len(who))
        new_pool, new_value = np.full((len(who), width), -1), np.full((len(who), width), -np.inf)
        new_pool[number[which], place], new_value[number[which], place] = near, cosine
        all_pool = np.concatenate((pool[who], new_pool), axis=1)
        all_value = np.concatenate((value[who], new_value), axis=1)
        all_done = np.concatenate((done[who], np.isinf(new_value)), axis=1)
        top = np.argpartition(-all_value, beam - 1, axis=1)[:, :beam]
        pool[who] = np.take_along_axis(all_pool, top, 1)
        value[who] = np.take_along_axis(all_value, top, 1)
        done[who] = np.take_along_axis(all_done, top, 1)
    frontier = found.copy()
    while frontier.any():
        reached = np.zeros_like(found)
        which, node = np.nonzero(frontier)
        for at in range(0, len(which), PAIRS):
            near = edges[node[at : at + PAIRS]]
            who = np.repeat(which[at : at + PAIRS], near.shape[1])
            reached[who[near.ravel() >= 0], near.ravel()[near.ravel() >= 0]] = True
        reached &= ~seen
        seen |= reached
        frontier = np.zeros_like(found)
        which, node = np.nonzero(reached)
        for at in range(0, len(which), PAIRS):
            a, b = which[at : at + PAIRS], node[at : at + PAIRS]
            near = np.einsum("ij,ij->i", asked[a], points[b]) >= least
            frontier[a[near], b[near]] = True
        found |= frontier
    return found


def roots(links: np.ndarray) -> np.ndarray:
    """Of each row of a link matrix the smallest row number it is joined with."""
    root = np.arange(len(links))
    joined = np.flatnonzero(links.any(axis=1))
    while True:
        before = root.copy()
        for i in joined:
            root[i] = min(root[i], root[links[i]].min())
        root = root[root]
        if (root == before).all():
            return root


def deal(reps: DataFrame, overlap: int, members: int = MEMBERS, limit: int = LIMIT, pivots: int = PIVOTS) -> DataFrame:
    """(shard, id, n, vec, home): each vector in the shards of its nearest pivots, one of them its home.

    At most about ``pivots`` vectors are drawn in a round, collected and broadcast; what is still above ``limit``
    waits for the next round.
    """
    spark = reps.sparkSession
    rows = reps.select(F.lit(0).cast("long").alias("shard"), "id", "n", "vec", F.lit(True).alias("home"))
    level = 0
    while True:
        sizes = rows.groupBy("shard").count().where(F.col("count") > limit).orderBy(F.desc("count")).limit(pivots)
        plan, drawn = {}, 0
        for row in sizes.collect():
            want = max(4, -(-row["count"] * overlap // members))
            take = min(want, pivots - drawn)
            if take < 4:
                break
            plan[row.shard] = take / row["count"]
            drawn += take
        if not plan:
            return rows
        if level == 12:
            return _dealt_by_hash(rows, overlap, members, limit)
        level += 1
        shares = spark.createDataFrame([(k, int(v * STEPS) + 1) for k, v in plan.items()], "shard long, share long")
        chosen = (
            rows.join(F.broadcast(shares), "shard")
            .where(F.pmod(F.xxhash64(F.lit(level), "id"), F.lit(STEPS)) < F.col("share"))
            .select("shard", "id", "vec")
            .dropDuplicates(["shard", "id"])
            .orderBy("shard", "id")
            .collect()
        )
        centres: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for shard in plan:
            mine = [(r.id, r.vec) for r in chosen if r.shard == shard]
            if len(mine) >= 2:
                centres[shard] = np.array([m[0] for m in mine]), np.array([m[1] for m in mine], np.float64)
        if not centres:
            return _dealt_by_hash(rows, overlap, members, limit)
        shared = spark.sparkContext.broadcast(centres)

        def split(batches: Iterable[pa.RecordBatch], shared=shared, level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                shards = batch.column(0).to_numpy(zero_copy_only=False)
                points, home = vectors_of(batch.column(3)), batch.column(4).to_numpy(zero_copy_only=False)
                take, to, main = [], [], []
                for shard in np.unique(shards):
                    at = np.flatnonzero(shards == shard)
                    if shard not in shared.value:
                        take.append(at)
                        to.append(np.full(len(at), shard))
                        main.append(home[at])
                        continue
                    names, centre = shared.value[shard]
                    nearest = np.argsort(-(points[at] @ centre.T), axis=1, kind="stable")[:, :overlap]
                    for k in range(nearest.shape[1]):
                        take.append(at)
                        # A shard is known by its pivot and its level.
                        to.append((names[nearest[:, k]] * 16 + level) ^ (shard << 20))
                        main.append(home[at] & (k == 0))
                index = pa.array(np.concatenate(take))
                out = batch.take(index)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(to).astype(np.int64)), *out.columns[1:4], pa.array(np.concatenate(main))],
                    names=batch.schema.names,
                )

        dealt = rows.mapInArrow(split, "shard long, id long, n long, vec array<double>, home boolean")
        # Two pivots may be one vector's way into one shard: it is a member once.
        rows = written(
            dealt.groupBy("shard", "id").agg(F.first("n").alias("n"), F.first("vec").alias("vec"), F.max("home").alias("home")),
            "graph-members",
        )


def _dealt_by_hash(rows: DataFrame, overlap: int, members: int, limit: int) -> DataFrame:
    """``rows`` of ``deal``, with the members of each shard above ``limit`` in ``overlap`` parts of it or fewer.

    No pivots part vectors of one direction. Dealt so, parts share members, and visits compare them block by block.
    """
    over = rows.groupBy("shard").count().where(F.col("count") > limit)
    over = written(over.select("shard", F.expr(f"ceil(count * {overlap} / {members})").alias("parts")), "graph-over")
    dealt = rows.join(over, "shard", "left").withColumn("k", F.explode(F.expr(f"sequence(0, if(parts IS NULL, 0, {overlap - 1}))")))
    dealt = dealt.select(
        F.expr("if(parts IS NULL, shard, xxhash64(shard, pmod(xxhash64(id, k), parts)))").alias("shard"),
        "id", "n", "vec", F.expr("home AND k = 0").alias("home"),
    )
    return dealt.groupBy("shard", "id").agg(F.first("n").alias("n"), F.first("vec").alias("vec"), F.max("home").alias("home"))


def probes_of(reps: DataFrame, least: float, most: int = PROBES) -> DataFrame:
    """(id, n, vec): about ``most`` vectors or all, each turned towards a random one, under its id's negative and with n of 0.

    Cosines to the vector they come from are between ``least`` and 1, evenly.
    """
    share = min(STEPS, int(most / max(1, reps.count()) * STEPS) + 1)
    drawn = reps.where(F.pmod(F.xxhash64(F.lit("probe"), "id"), F.lit(STEPS)) < share)

    def turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, points = batch.column(0).to_numpy(zero_copy_only=False), vectors_of(batch.column(2))
            out = []
            for number, point in zip(ids, points, strict=True):
                rng = np.random.default_rng(number)  # the same when the task runs again
                away = rng.normal(size=len(point))
                away -= (away @ point) * point
                length = np.linalg.norm(away)
                cosine = least + (1 - least) * (0.02 + 0.96 * rng.random())
                out.append(cosine * point + np.sqrt(1 - cosine * cosine) * away / length if length > 1e-9 else point)
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(-1 - ids), pa.array(np.zeros(len(ids), np.int64)), pa.array(out, kind)], names=["id", "n", "vec"]
            )

    return drawn.select("id", "n", "vec").mapInArrow(turn, "id long, n long, vec array<double>")


def _linked(reps: DataFrame, least: float, overlap: int, limit: int) -> DataFrame:
    """(id, links, root): per vector and shard, links whose far end is at home there, and a vector it is joined with.

    A vector with n of 0 is a probe: it has links, but is nobody's and joins nothing.
    """
    members = written(deal(reps, overlap, limit=limit), "graph-shards")
    homes = members.where("home").select("id", F.col("shard").alias("at"))
    # Of two vectors within the range of a third, neither is further from the other than this.
    reach = 2 * least * least - 1

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        ids, points = shard["id"].to_numpy(), np.stack(shard["vec"].to_numpy())
        near = prune(points)
        a, k = np.nonzero(near >= 0)
        b = near[a, k]
        close = np.einsum("ij,ij->i", points[a], points[b]) >= reach - 1e-9
        both = np.concatenate((ids[a], ids[b])), np.concatenate((ids[b], ids[a])), np.concatenate((close, close))
        return pd.DataFrame(dict(zip(("id", "to", "close"), both, strict=True)))

    lists = members.select("shard", "id", "vec").groupBy("shard").applyInPandas(build, "id long, to long, close boolean")
    lists = written(lists.distinct(), "graph-edges")
    united = written(lists.groupBy("id").agg(F.collect_set("to").alias("near")), "graph-lists")
    away = lists.where("close").join(homes.withColumnRenamed("id", "to"), "to").select("id", "at").union(homes)
    far = written(away.groupBy("id").agg(F.collect_set("at").alias("far")), "graph-far")
    ready = members.join(united, "id", "left").join(far, "id")

    def look(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("id")
        ids, points = shard["id"].to_numpy(), np.stack(shard["vec"].to_numpy())
        lists = []
        for near in shard["near"]:
            near = np.array([] if near is None else near, np.int64)
            at = np.searchsorted(ids, near)
            at[at == len(ids)] = 0
            lists.append(at[ids[at] == near])  # edges that leave the shard are followed by visits
        width = max(1, max(map(len, lists)))
        edges = np.full((len(ids), width), -1)
        for row, near in zip(edges, lists, strict=True):
            row[: len(near)] = near
        found = search(points, edges, medoid(points), least)
        found |= found.T
        home = shard["home"].to_numpy()
        links = (found @ (shard["n"].to_numpy() * home)) * home
        real = shard["n"].to_numpy() > 0
        root = ids[roots(found & real & real[:, None])]
        np.fill_diagonal(found, True)
        asks = _asks(found, shard["far"])
        return pd.DataFrame({"id": ids, "shard": shard["shard"], "home": home, "links": links, "root": root, "asks": asks})

    kinds = "id long, shard long, home boolean, links long, root long, asks array<long>"
    looked = written(ready.groupBy("shard").applyInPandas(look, kinds), "graph-looked")
    done = looked.select("id", "links", "root")
    # What is joined at one home goes on visits together: (at, group).
    groups = written(looked.where("home").select("id", F.col("shard").alias("at"), F.col("root").alias("group")), "graph-groups")
    block = written(groups.join(members.where("home").select("id", "n", "vec"), "id").join(far, "id"), "graph-homes")
    sizes = written(groups.groupBy("at", "group").count(), "graph-sizes")
    asked = looked.select("id", F.explode("asks").alias("shard")).join(groups, "id")
    asked = written(asked.where("shard <> at").select("at", "group", "shard").distinct(), "graph-asked")
    seen = asked
    while not asked.isEmpty():
        visited = written(_visited(asked, block, sizes, least, limit), "graph-visited")
        done = done.union(visited.where("asks IS NULL").select("id", "links", "root"))
        asked = visited.where("asks IS NOT NULL").select("at", "group", F.explode("asks").alias("shard")).distinct()
        asked = asked.where("shard <> at").join(seen, ["at", "group", "shard"], "left_anti")
        asked = written(asked, "graph-asked")
        seen = written(seen.union(asked), "graph-seen")
    return done


def _asks(found: np.ndarray, far: pd.Series) -> list[list[int]]:
    """Per row of ``found`` the shards that the lists ``far`` of its columns hold."""
    sizes = far.map(len).to_numpy()
    names, place = np.unique(np.concatenate(far.to_list()), return_inverse=True)
    holds = np.zeros((len(far), len(names)), np.float32)
    holds[np.repeat(np.arange(len(far)), sizes), place] = 1
    wanted = np.concatenate([found[at : at + BLOCK].astype(np.float32) @ holds > 0 for at in range(0, len(found), BLOCK)])
    return [names[row].tolist() for row in wanted]


def _visited(asked: DataFrame, block: DataFrame, sizes: DataFrame, least: float, limit: int) -> DataFrame:
    """What the groups ``asked`` (at, group, shard) find among the vectors at home in a shard, compared with each of them.

    Gives links and joined vectors per vector, and what groups are to ask next: a visitor's
    the shards that the vectors found have edges to, a found vector's the visitor's home, so
    that it counts the link too. The visitors of a shard are dealt to tasks of about
    ``limit``; each has the shard's vectors.
    """
    parts = asked.join(sizes, ["at", "group"]).groupBy("shard").agg(F.sum("count").alias("count"))
    parts = written(parts.select("shard", F.expr(f"cast(ceil(count / {limit}) AS int) AS parts")), "graph-parts")
    visitors = (
        asked.join(parts, "shard")
        .join(block.select("at", "group", F.col("id").alias("visitor"), F.col("n").alias("size"), F.col("vec").alias("point")), ["at", "group"])
        .select("shard", F.expr("cast(pmod(xxhash64(visitor), parts) AS int) AS part"), "at", "group", "visitor", "size", "point")
    )
    hosts = (
        block.select(F.col("at").alias("host"), F.col("group").alias("own"), "id", "n", "vec", "far")
        .join(parts.select(F.col("shard").alias("host"), F.col("parts").alias("k")), "host")
        .select("host", F.explode(F.expr("sequence(0, k - 1)")).alias("slice"), "own", "id", "n", "vec", "far")
    )

    def visit(here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        names = ["id", "links", "root", "at", "group", "asks"]
        if not len(here) or not len(there):
            return pd.DataFrame({x: [] for x in names}).astype(dict.fromkeys(names[:5], np.int64))
        here, there = here.sort_values(["at", "group"]), there.sort_values("own")
        a, b = np.stack(here["point"].to_numpy()), np.stack(there["vec"].to_numpy())
        found = np.concatenate([a[at : at + BLOCK] @ b.T >= least for at in range(0, len(a), BLOCK)])
        ids = here["visitor"].to_numpy(), there["id"].to_numpy()
        root = _stars(found & (here["size"].to_numpy() > 0)[:, None] & (there["n"].to_numpy() > 0), *ids)
        met = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
        # A link counts for the visitor; for the vector found it does so when that one's group visits.
        links = np.concatenate((found[met[0]] @ there["n"].to_numpy(), np.zeros(len(met[1]), np.int64)))
        told = pd.DataFrame({"id": np.concatenate((ids[0][met[0]], ids[1][met[1]])), "links": links})
        told["root"] = np.concatenate((root[0][met[0]], root[1][met[1]]))
        told["at"], told["group"], told["asks"] = 0, 0, None
        first = np.flatnonzero(~here.duplicated(["at", "group"]).to_numpy())
        hit = np.logical_or.reduceat(found, first, axis=0)
        ask = here[["at", "group"]].iloc[first].reset_index(drop=True)
        ask["asks"] = _asks(hit, there["far"])
        first = np.flatnonzero(~there.duplicated("own").to_numpy())
        back = np.logical_or.reduceat(hit, first, axis=1).T
        answer = pd.DataFrame({"at": there["host"].iloc[0], "group": there["own"].to_numpy()[first]})
        answer["asks"] = _asks(back, ask["at"].map(lambda x: [x]))
        more = pd.concat((ask, answer), ignore_index=True)
        more = more[more["asks"].map(len) > 0].assign(id=0, links=0, root=0)
        return pd.concat((told, more), ignore_index=True)[names]

    kinds = "id long, links long, root long, at long, group long, asks array<long>"
    by = visitors.groupBy("shard", "part"), hosts.groupBy("host", "slice")
    return by[0].cogroup(by[1]).applyInPandas(visit, kinds)


def _stars(found: np.ndarray, names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row and each column of ``found`` the smallest name it is joined with; rows bear ``names``, columns ``ids``."""
    root, own = names.copy(), ids.copy()
    rows, columns = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
    while True:
        before = root.copy(), own.copy()
        for i in rows:
            root[i] = min(root[i], own[found[i]].min())
        for j in columns:
            own[j] = min(own[j], root[found[:, j]].min())
        if (root == before[0]).all() and (own == before[1]).all():
            return root, own


def _truth(reps: DataFrame, least: float, audited: int, linked: int) -> DataFrame:
    """(id, n): links of asked vectors with all vectors, of those that have any.

    Asked are, ``audited`` about at a time, the ids divisible by ``EVERY``, then others, until
    ``audited`` are asked and ``linked`` of them have links, or all are asked.
    """
    spark = reps.sparkSession
    first = F.expr(f"{'name' if 'name' in reps.columns else 'id'} % {EVERY} = 0")
    rest, count = reps.select(F.count_if(~first), F.count_if(first)).first()
    rounds = [(first, part, -(-count // audited)) for part in range(-(-count // audited))]
    rounds += [(~first, part, -(-rest // audited)) for part in range(-(-rest // audited))]
    told, have, asked = [], 0, 0
    for which, part, parts in rounds:
        if asked >= audited and have >= linked:
            break
        of_part = F.pmod(F.xxhash64(F.lit("audit"), "id"), F.lit(parts)) == part
        sample = reps.where(which).where(of_part).select("id", "vec").collect()
        if not sample:
            continue
        asked += len(sample)
        counted = written(_counted(reps, sample, least), "graph-truth")
        if number := counted.count():
            told.append(counted)
            have += number
    if not told:
        return spark.createDataFrame([], "id long, n long")
    out = told[0]
    for more in told[1:]:
        out = out.union(more)
    return out


def _counted(reps: DataFrame, sample: list, least: float) -> DataFrame:
    """(id, n): links of each of ``sample`` (id, vec) with all vectors, where it has any."""
    shared = reps.sparkSession.sparkContext.broadcast((np.array([r.id for r in sample]), np.array([r.vec for r in sample])))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = shared.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                own, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                vecs = vectors_of(batch.column(2))
                for k in range(0, len(ids), BLOCK):
                    part = slice(k, k + BLOCK)
                    total[part] += n @ ((vecs @ points[part].T >= least) & (own[:, None] != ids[None, part]))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], names=["id", "n"])

    return reps.select("id", "n", "vec").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _audit(truth: DataFrame, found: DataFrame) -> tuple[int, float, float]:
    """Asked vectors with true links, and the share that ``found`` (id, links) has: of all links, and of a vector's in the mean."""
    have = F.least("n", F.coalesce("links", F.lit(0)))
    asked, true, got, each = (
        truth.join(found, "id", "left").agg(F.count("*"), F.sum("n"), F.sum(have), F.avg(have / F.col("n"))).first()
    )
    return (asked, got / true, each) if asked else (0, 1.0, 1.0)


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    least: float = SIMILARITY,
    overlap: int = OVERLAP,
    limit: int = LIMIT,
    audited: int = AUDITED,
    most_overlap: int = MOST_OVERLAP,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``.

    Rows link at a cosine of ``least`` or more, whatever their other columns. A vector that
    is null, empty, zero, or holds a null or non-finite component links with nothing and is
    its own component; so does one whose id is null, which is not kept. Vectors of different
    lengths do not link. Rows that repeat an id are rows of their own that share the id's
    name: each has the links and the component of its vector. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("raw")
    )
    sound = F.expr(
        "id IS NOT NULL AND raw IS NOT NULL AND size(raw) > 0 AND exists(raw, x -> x <> 0)"
        " AND forall(raw, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    rows = written(rows.select("id", F.when(sound, F.col("raw")).alias("raw")), "graph-rows")
    # Numbers ascend with ids, so that the smallest number of a component is that of its smallest id.
    equal = rows.where("raw IS NOT NULL").groupBy("raw").agg(F.min("id").alias("name"), F.count("*").alias("n"))
    equal = written(equal.orderBy("name", "raw").withColumn("id", F.monotonically_increasing_id()), "graph-equal")

    def scale(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vecs = unit(vectors_of(batch.column(3)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(list(vecs), pa.list_(pa.float64()))], names=["id", "name", "n", "vec"]
                )

    summed, joined = [], []
    for (size,) in equal.select(F.size("raw")).distinct().orderBy(F.size("raw")).collect():  # lengths of vectors
        reps = equal.where(F.size("raw") == size).select("id", "name", "n", "raw")
        reps, tried = written(reps.mapInArrow(scale, "id long, name long, n long, vec array<double>"), "graph-units"), overlap
        probes = written(probes_of(reps, least), "graph-probes")
        drawn = probes.select("id", "vec").collect()
        truth = written(_truth(reps, least, audited, LINKED - len(drawn)), "graph-audit")
        expected = written(_counted(reps, drawn, least), "graph-expected") if drawn else probes.select("id", "n")
        every = reps.select("id", "n", "vec").union(probes.select("id", "n", "vec"))
        while True:
            linked = written(_linked(every, least, tried, limit), "graph-links")
            links = written(linked.groupBy("id").agg(F.sum("links").alias("links")), "graph-counts")
            (asked, whole, each), (planted, whole_of, each_of) = _audit(truth, links), _audit(expected, links)
            said = f"{size} components, overlap {tried}: recall {whole:.4f} of links, {each:.4f} of a vector's, by {asked} vectors with links"
            said += f"; {whole_of:.4f} and {each_of:.4f} by {planted} probes"
            logger.info(said)
            if min(whole, each, whole_of, each_of) >= RECALL:
                break
            if tried >= most_overlap:
                raise RuntimeError(f"too many near vectors were missed; {said}")
            tried *= 2
        summed.append(links.where("id >= 0"))
        joined.append(linked.where("id >= 0").select(F.col("id").alias("a"), F.col("root").alias("b")))
    if not summed:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept")
        )
    links, pairs = summed[0], joined[0]
    for more, others in zip(summed[1:], joined[1:], strict=True):
        links, pairs = links.union(more), pairs.union(others)
    named = components(pairs, "graph-components")
    classes = written(
        equal.join(links, "id", "left")
        .join(named.withColumnRenamed("node", "id"), "id", "left")
        .join(equal.select(F.col("id").alias("root"), F.col("name").alias("least")), "root", "left")
        .select("raw", F.expr("coalesce(links, 0) + n - 1 AS links"), F.coalesce("least", "name").alias("root")),
        "graph-classes",
    )
    return rows.join(classes, "raw", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("root", "id"), F.lit(False)).alias("kept"),
    )
