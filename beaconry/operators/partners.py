"""All users that share an item with a user, ranked: the entries of the user-user matrix above 0, none left out.

The entries are about the square of the users, so over a narrow catalogue they are neither sorted nor shuffled. Others are cut into chunks by
ranges of their ids. A first pass tallies, for a profile and a chunk, the users at each closeness; the tallies say how many users come before
those of a closeness in a chunk, so a second pass ranks each chunk on its own and sends its rows out piece by piece. Over a wide catalogue
few profiles share an item: their pairs come from inverted lists and are ranked by a sort.

A profile's order of users holds its own members too, first of all since no other set is as close; a user's ranks skip the user itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.operators import dense, inverted, tiles
from beaconry.operators.tiles import chunk_of, fresh, list_parts
from beaconry.session import cut

ASKING = 4096  # askers of one tile
FEW = 256  # or less, down to this, while cores would idle
ROWS = 1 << 16  # rows of one batch that leaves a task
TALLIES = 1024  # profiles whose tallies are summed up at once
PROBES = 1 << 16  # profiles under one item that a task asks for at once
MEMBERS = 4096  # members of a profile that one task ranks for


class _Tile:
    """Asking profiles and the users of a chunk, by their distinct profiles; closeness as numbers, closest first."""

    def __init__(self, askers: pa.Table, others: pa.Table):
        (codes,) = inverted.numbered(others.column("lowest"))
        _, first, self.profile, self.weight = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
        self.sets = dense.Sets(askers, others.take(pa.array(first)), "lowest")
        self._columns = np.ascontiguousarray(self.sets.others.T)
        sizes, self._size = np.unique(self.sets.other_n, return_inverse=True)
        shared = np.arange(1 + min(self.sets.n.max(), sizes.max()))[:, None]
        close = (shared * shared) / sizes
        self.closeness = -np.unique(-close[1:])
        #: number of the closeness by shared items and size; who shares nothing comes last
        kind = np.uint16 if len(self.closeness) < 1 << 16 else np.int64
        self._number = np.searchsorted(-self.closeness, -close).astype(kind)
        self._number[0] = len(self.closeness)

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first asker, shared items, number of the closeness) of some askers with all profiles of the chunk."""
        step = max(1, dense.CELLS // len(self.weight))
        for s in range(0, len(self.sets.n), step):
            shared = np.rint(self.sets.mine[s:s + step] @ self._columns).astype(np.int64)
            yield s, shared, self._number[shared, self._size]


def _tally(id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: for each profile the closeness of a chunk's users, closest first, and how many users are at each."""

    def run(probes: pa.Table, others: pa.Table) -> pa.Table:
        lows, lists = [], {"close": [], "users": []}
        if probes.num_rows and others.num_rows:
            tile = _Tile(probes, others)
            wide = len(tile.closeness) + 1
            for s, _, number in tile.blocks():
                cell = np.arange(len(number))[:, None] * wide + number
                users = np.bincount(cell.ravel(), weights=np.tile(tile.weight, len(number)), minlength=len(number) * wide).reshape(-1, wide)[:, :-1]
                row, at = np.nonzero(users)
                ends = pa.array(np.searchsorted(row, np.arange(len(number) + 1)).astype(np.int32))
                lists["close"].append(pa.ListArray.from_arrays(ends, pa.array(tile.closeness[at])))
                lists["users"].append(pa.ListArray.from_arrays(ends, pa.array(users[row, at].astype(np.int64))))
                lows.append(probes.column("lowest").slice(s, len(number)).combine_chunks())
        chunk = others.column("_r").slice(0, 1).to_pylist() * sum(map(len, lows)) if lows else []
        return pa.table({"lowest": pa.chunked_array(lows, id_type), "_r": pa.array(chunk, pa.int32()),
                         "close": pa.chunked_array(lists["close"], pa.list_(pa.float64())), "users": pa.chunked_array(lists["users"], pa.list_(pa.int64()))})

    return run


def _before(table: pa.Table) -> pa.Table:
    """Kernel: from the tallies of some profiles over all chunks, the users that come before those of each closeness in each chunk."""
    (offsets, close), (_, users) = (list_parts(table.column(c)) for c in ("close", "users"))
    close, users, offsets = close[offsets[0]:offsets[-1]], users[offsets[0]:offsets[-1]], offsets - offsets[0]
    row = np.repeat(np.arange(table.num_rows), np.diff(offsets))
    (who,) = inverted.numbered(table.column("lowest"))
    order = np.lexsort((table.column("_r").to_numpy()[row], -close, who[row]))
    ahead = np.cumsum(users[order]) - users[order]
    mine = who[row][order]
    before = np.empty_like(users)
    before[order] = ahead - ahead[np.searchsorted(mine, mine)]
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(before))
    return pa.table({"lowest": table.column("lowest"), "_r": table.column("_r"), "before": lists})


def _sent(asks: pa.Table, others: pa.Table, parts: list[tuple]) -> pa.RecordBatch:
    who = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
    whom, shared, similarity, rank = (np.concatenate(x) for x in list(zip(*parts, strict=True))[1:])
    named = (t.column("user_id").take(pa.array(at)).combine_chunks() for t, at in ((asks, who), (others, whom)))
    return pa.record_batch([*named, pa.array(shared), pa.array(similarity), pa.array(rank)], ["user_id", "neighbour", "shared", "similarity", "rank"])


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel: the rows of a tile's askers with the users of its chunk."""
    table = pa.Table.from_batches(list(batches))
    kind = table.column("_kind").to_numpy()
    asks, others, tallies = (table.filter(pa.array(kind == i)) for i in range(3))
    if not asks.num_rows or not others.num_rows:
        return
    mine, theirs = inverted.numbered(asks.column("user_id"), others.column("user_id"))
    by_id = np.argsort(theirs, kind="stable")
    others, theirs = others.take(pa.array(by_id)), theirs[by_id]
    profile, tallied = inverted.numbered(asks.column("lowest"), tallies.column("lowest"))
    profiles, first = np.unique(profile, return_index=True)
    members = np.argsort(profile, kind="stable")
    ends = np.searchsorted(profile[members], profiles, side="right")
    tile = _Tile(asks.take(pa.array(first)), others)
    known = np.argsort(tallied)
    offsets, before = list_parts(tallies.column("before"))
    parts, waiting = [], 0
    for s, shared, number in tile.blocks():
        for p in range(s, s + len(shared)):
            of_user = number[p - s][tile.profile]
            whom = np.argsort(of_user, kind="stable")[:np.count_nonzero(of_user < len(tile.closeness))]  # closest first, then by id
            if not len(whom):
                continue
            new = np.diff(of_user[whom], prepend=of_user[whom[0]]) != 0
            start = np.flatnonzero(np.concatenate([[True], new[1:]]))
            at = np.cumsum(new)
            tally = known[np.searchsorted(tallied[known], profiles[p])]
            place = before[offsets[tally]:offsets[tally + 1]][at] + np.arange(len(whom)) - start[at] + 1
            common, column = shared[p - s][tile.profile[whom]], tile.profile[whom]
            similarity = common / np.sqrt((tile.sets.n[p] * tile.sets.other_n[column]).astype(float))
            other = column != tile.sets.own[p]
            for u in members[ends[p - 1] if p else 0:ends[p]]:
                self_less = place - (other | (theirs[whom] > mine[u]))
                keep = slice(None)
                if tile.sets.own[p] >= 0:
                    keep = theirs[whom] != mine[u]
                parts.append((u, whom[keep], common[keep], similarity[keep], self_less[keep]))
                waiting += len(parts[-1][1])
                if waiting >= ROWS:
                    yield _sent(asks, others, parts)
                    parts, waiting = [], 0
    if waiting:
        yield _sent(asks, others, parts)


def _chunks(rows: int, cores: int) -> int:
    return max(1, math.ceil(rows / ASKING), min(math.ceil(rows / FEW), 2 * cores))


def by_matrix(members: DataFrame, prof: DataFrame, items: int) -> DataFrame:
    """Columns user_id, neighbour, shared, similarity, rank over a catalogue of ``items``."""
    id_type, arrow_type = inverted.type_of(prof, "lowest")
    plain = prof.select("profile", "lowest", F.transform("items", lambda e: e["item"]).alias("items"))
    rows, n_profiles = members.count(), prof.count()
    across = max(1, tiles.chunk_count(rows, max(1, min(dense.LISTS_PER_CHUNK, dense.ENTRIES // items))))
    ranges = members.repartitionByRange(across, "user_id").withColumn("_r", F.spark_partition_id())
    # stored, so that a lost task cannot shift the ranges
    users = cut(ranges.join(plain, "profile").select("user_id", "lowest", "items", "_r"))
    across = 1 + users.agg(F.max("_r")).first()[0]  # as many ranges as were made
    down = _chunks(n_profiles, tiles.cores_of(members))
    probes = (plain.select("lowest", "items", chunk_of("lowest", down).alias("_l"))
              .withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))))
    met = tiles.co_run(probes, users.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))), ["_l", "_r"], down * across,
                       _tally(arrow_type), f"lowest {id_type}, _r int, close array<double>, users array<bigint>")
    before = cut(met.withColumn("_t", chunk_of("lowest", tiles.chunk_count(n_profiles, TALLIES))).groupBy("_t").applyInArrow(
        _before, f"lowest {id_type}, _r int, before array<bigint>"))

    down = _chunks(rows, tiles.cores_of(members))
    asks = users.withColumn("_l", chunk_of("user_id", down))
    tallies = fresh(asks.select("lowest", "_l").distinct()).join(fresh(before), "lowest")
    kinds = [asks.drop("_r").withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))),
             users.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))), tallies]
    first, *rest = (fresh(df.withColumn("_kind", F.lit(i))) for i, df in enumerate(kinds))
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    tiled = first.repartition(min(down * across, tiles.MAX_TASKS), "_l", "_r")
    return tiled.groupBy("_l", "_r").applyInArrow(_ranked, f"user_id {id_type}, neighbour {id_type}, shared bigint, similarity double, rank bigint")


def _sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel: the pairs of profiles of a bucket, each with its shared items."""
    table = pa.Table.from_batches(list(batches))
    postings, probes = (table.filter(pa.array(table.column("_asks").to_numpy() == asks)) for asks in (False, True))
    if not postings.num_rows or not probes.num_rows:
        return
    post, ask = inverted.both_sides(postings, probes, "lowest")
    for a, b, c in inverted.common(post, ask, lambda probe, posting: np.ones(len(probe), dtype=bool)):
        names = (t.column("lowest").take(pa.array(at)).combine_chunks() for t, at in ((probes, a), (postings, b)))
        low, other = names
        yield pa.record_batch([low, pa.array(ask.n[a]), other, pa.array(post.n[b]), pa.array(c)], ["lowest", "n", "other", "other_n", "shared"])


def by_lists(members: DataFrame, prof: DataFrame, load: int, holders: int) -> DataFrame:
    """As ``by_matrix``, for any catalogue: what is shuffled grows with the profiles times the users that share an item."""
    id_type, _ = inverted.type_of(prof, "lowest")
    parts = F.greatest(F.ceil(F.col("holders") / PROBES), F.lit(1)).cast("int")
    rows = inverted.places(prof.select("lowest", "items")).withColumn("_parts", parts)
    posted, asked = inverted.deal(rows, rows, "lowest", load, holders)
    # the profiles under a popular item meet it in parts: without bars all of them ask
    posted = posted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).withColumn("_asks", F.lit(False))
    asked = asked.withColumn("_part", F.pmod(F.xxhash64("lowest"), F.col("_parts")).cast("int")).withColumn("_asks", F.lit(True))
    others = fresh(posted).unionByName(fresh(asked)).groupBy("_g", "_part").applyInArrow(_sharing, f"lowest {id_type}, n bigint, other {id_type}, other_n bigint, shared bigint")
    own = prof.select("lowest", "n", F.col("lowest").alias("other"), F.col("n").alias("other_n"), F.col("n").alias("shared"))
    far = -(F.col("shared") * F.col("shared")).cast("double") / F.col("other_n")
    names = members.join(fresh(prof.select("profile", "lowest", "members")), "profile")
    ordered = W.partitionBy("lowest").orderBy("far", "neighbour")
    lists = (others.unionByName(fresh(own)).join(fresh(names).select(F.col("lowest").alias("other"), F.col("user_id").alias("neighbour")), "other")
             .select("lowest", "neighbour", "shared", (F.col("other") != F.col("lowest")).alias("_other"), far.alias("far"),
                     (F.col("shared") / F.sqrt((F.col("n") * F.col("other_n")).cast("double"))).alias("similarity"))
             .withColumn("_place", F.row_number().over(ordered).cast("bigint")))
    # the members of a large profile are dealt to several tasks, each with the whole list
    groups = F.ceil(F.col("members") / MEMBERS).cast("int")
    asks = fresh(names).select("user_id", "lowest", F.pmod(F.xxhash64("user_id"), groups).cast("int").alias("_m"))
    dealt = lists.join(fresh(prof.select("lowest", "members")), "lowest").withColumn("_m", F.explode(F.sequence(F.lit(0), groups - 1)))
    after = (F.col("_other") | (F.col("neighbour") > F.col("user_id"))).cast("bigint")
    return dealt.join(asks, ["lowest", "_m"]).where(F.col("neighbour") != F.col("user_id")).select(
        "user_id", "neighbour", "shared", "similarity", (F.col("_place") - after).alias("rank"))
