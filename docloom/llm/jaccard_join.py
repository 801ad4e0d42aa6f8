"""Exact n-gram Jaccard self-join in metric space: pivots, regions, triangle-inequality windows, recursion.

With ``d = 1 - Jaccard`` most documents of a corpus lie at distance 1 from any other, so whole documents as
first pivots would leave nearly all of them in one region. The join therefore has two levels of pivots:

1. *Shingle pivots.* Every shingle is a pivot with a region; all agree on one order of pivots, rare ones first
   (by a fixed-size count sketch over all documents, then by hash). A set's home is the region of its first
   pivot. Window: if x and y share none of the first k pivots of either, their symmetric difference through
   those pivots is ``k_x + k_y`` (equality in the triangle inequality through the empty set), and no linked
   pair is that far apart once ``k > n - ceil(t n)``. So each set is replicated to its first
   ``n - ceil(t n) + 1`` regions and no further, and every linked pair meets in at least one region.
2. *Document pivots.* A region of more than ``LEAF_PAIRS`` pairs picks a few members as pivots and measures
   all members against them. Members within ``eps`` of a pivot are linked to it, hence to each other as far as
   components go. By the triangle inequality a member of the ball (d <= eps) can only meet outsiders in the
   ring (eps < d <= 2 eps), and only if ``d(ball) >= min ring d - eps``: these boundary members go into a
   ball-and-ring region; members outside all balls go into a rest region. Both are joined recursively, until
   regions are small enough to compare their pairs directly.

Distances are exact, from the whole shingle sets. Links are chosen so that components are exact: pairs that
are already joined through a pivot are not measured again. Groups of equal sets are one node.

Small regions are lists: their members travel once with 16 bits of each first pivot, a task compares all pairs of a
list, and only pairs that may still be linked leave it. Members are taken in order of size, in blocks of ``BLOCK``, and
two blocks that are too far apart in size are not compared. A task holds one list at a time, which is bounded by
``LIST`` members and ``LIST_SHINGLES`` shingles. The nearest pairs come first: a list gives the few best of every
component at a time, and what is still of several components after them is listed again, at last with all pairs (and
all pairs of blocks).

Large groups of near copies share many shingles and would meet in each of their regions. So a first round comes before,
in which every set picks a few of its regions by hash and is measured against one pivot of each, the member of least
hash, which is the same for regions of much the same members. After it and after every round of the recursion the links
so far are joined to components: a region whose members are all of one component is closed, and a region with few members
outside its largest component compares just those.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.graphs import bit_filter, connected_components, may_contain
from docloom.llm.registry import query
from docloom.llm.wordhash import mix, shingle_sets
from docloom.staging import stage, temporary

SHINGLE, PERCENT = 5, 75
SKETCH_CELLS, SKETCH_ROWS, SKETCH_CHUNK, SKETCH_FAN = 1 << 21, 2, 1 << 17, 512
REGION_BITS = 1 << 25
# By depth of the recursion: deep regions are few, so they may compare more pairs and take more pivots at once.
LEAF_PAIRS, PIVOTS, BEST = (1 << 28,), (4, 16, 64, 128), (4, 16, None)  # BEST: pairs of a component in a list, at last all
LIST, BLOCK, CELLS = 1 << 14, 256, 1 << 22  # members of a list and of a block at most, entries of a matrix
PAIRS_OUT = 1 << 18  # a task hands on the pairs of a list when it holds so many (8 MB), not all at its end
LIST_SHINGLES = 1 << 26  # of all members of a list: 32 MB of pivots in a task
RARE = 16  # a number that so many members share at most is counted pair by pair, not in a matrix
FIRST_PICKS = 3
EDGES_AT_ONCE = 1 << 20  # so many links (16 MB) are joined to components in one task, more of them by star steps
FEW = (8, 16, 64, 256)  # a region with so many members at most outside its largest component is compared directly, by depth
ROWS_OUT = 2000


def _key(shingles: np.ndarray) -> int:
    """One number per set: equal sets and only equal sets share it, up to 64-bit collisions."""
    total = np.bitwise_xor.reduce(mix(shingles)) ^ shingles.sum(dtype=np.uint64)
    return int(mix(np.array([total]) + np.uint64(len(shingles)))[0].view(np.int64))


def _cells(shingles: np.ndarray) -> list[np.ndarray]:
    """One cell of every sketch row per shingle."""
    last = np.uint64(SKETCH_CELLS - 1)
    return [((shingles >> np.uint64(shift)) & last) + np.uint64(row * SKETCH_CELLS) for row, shift in enumerate((10, 40))]


def _sketch_tasks(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, task = np.zeros(SKETCH_ROWS * SKETCH_CELLS, dtype=np.int64), 0
        for batch in batches:
            for _, found in shingle_sets(batch.column(0), size):
                if len(found):
                    task = task or int(found[0] & np.uint64(SKETCH_FAN - 1))
                    for at in _cells(found):
                        np.add.at(cells, at, 1)
        for chunk in range(SKETCH_ROWS * SKETCH_CELLS // SKETCH_CHUNK):
            part = cells[chunk * SKETCH_CHUNK:(chunk + 1) * SKETCH_CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int32()), pa.array([task], pa.int32()),
                     pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["chunk", "task", "counts"])

    return count


def _add_chunks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), dtype=np.int64) for x in table["counts"].to_pylist())
    return pa.table({"chunk": table["chunk"][:1], "task": table["task"][:1],
                     "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def pivot_classes(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Frequency class of every sketch cell, from all shingles of all documents; 4 MB whatever the input.

    Tasks count into a fixed number of cells; chunks of cells are added in two steps of bounded groups. Class 0
    holds cells no fuller than chance explains; of two cells the emptier counts. Only the order of pivots depends
    on it, never the result.
    """
    schema = "chunk int, task int, counts binary"
    parts = docs.select("text").mapInArrow(_sketch_tasks(size), schema)
    for keys in (["chunk", "task"], ["chunk"]):
        parts = parts.groupBy(*keys).applyInArrow(_add_chunks, schema)
    cells = np.zeros(SKETCH_ROWS * SKETCH_CELLS, dtype=np.float32)
    for row in parts.toArrow().to_pylist():
        cells[row["chunk"] * SKETCH_CHUNK:][:SKETCH_CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
    mean = float(cells.mean())
    usual = mean + 3 * mean ** 0.5 + 3
    return np.where(cells > usual, np.minimum(31, 1 + 2 * np.log2(np.maximum(cells, 1) / usual)), 0).astype(np.uint8)


def _home_tasks(classes: np.ndarray, size: int, percent: int):
    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, firsts = [], [], []

            def flush(a: int, b: int) -> pa.RecordBatch:
                lengths = np.concatenate([[0], np.cumsum([len(x) for x in firsts])]).astype(np.int32)
                values = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.int64)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b], pa.array(n, pa.int64()), pa.array(keys, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(lengths), pa.array(values, pa.int64()))],
                    ["doc_id", "text_key", "n", "key", "pivots"])

            done = 0
            for row, found in shingle_sets(batch.column(1), size):
                n.append(len(found))
                keys.append(_key(found) if len(found) else None)
                take = len(found) - (percent * len(found) + 99) // 100 + 1 if len(found) else 0
                common = np.minimum(*[classes[at] for at in _cells(found)]).astype(np.uint64)
                order = (mix(found) >> np.uint64(6)) | common << np.uint64(58)
                firsts.append(np.sort(np.partition(order, take - 1)[:take]).view(np.int64) if take else np.zeros(0, np.int64))
                if len(n) == ROWS_OUT:
                    yield flush(done, row + 1)
                    done, n, keys, firsts = row + 1, [], [], []
            if n:
                yield flush(done, batch.num_rows)

    return home


def _set_tasks(wanted: np.ndarray, size: int):
    """Shingle sets of the texts whose hash passes the filter, each once per task."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(0, dtype=np.int64)
        for batch in batches:
            hashes = batch.column(1).to_numpy()
            _, first = np.unique(hashes, return_index=True)
            first = np.sort(first[may_contain(wanted, hashes[first].view(np.uint64)) & ~np.isin(hashes[first], done)])
            done = np.concatenate([done, hashes[first]])
            keys, found = [], []
            for _, shingles in shingle_sets(batch.column(0).take(pa.array(first)), size):
                if len(shingles):
                    keys.append(_key(shingles))
                    found.append(shingles.tobytes())
                if len(keys) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], ["key", "shingles"])
                    keys, found = [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], ["key", "shingles"])

    return sets


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_common(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
               for x, y in zip(batch.column(4), batch.column(5), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], ["x", "y", "nx", "ny", "most"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text_key, ends); ends: the last of a set's first pivots (8 bytes), then 16 bits of each of them, sorted.

    Equal pivots have equal bits, so what is counted from them is an upper bound; only few strangers agree by chance.
    """
    for batch in batches:
        lists, out = batch.column(2), []
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            out.append(values[b - 1:b].tobytes() + np.sort(values[a:b].astype(np.uint16)).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], ["key", "text_key", "ends"])


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most two sets can share: of their pivots up to the nearer end those with equal bits, behind it the rest of that set."""
    for batch in batches:
        out = []
        for nx, ny, x, y in zip(*[batch.column(i).to_pylist() for i in range(2, 6)], strict=True):
            near, far, n = (x, y, nx) if int.from_bytes(x[:8], "little") <= int.from_bytes(y[:8], "little") else (y, x, ny)
            near, far = np.frombuffer(near, np.uint16, offset=8), np.frombuffer(far, np.uint16, offset=8)
            out.append(_common(near, far) + n - len(near))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.int64())], ["x", "y", "nx", "ny", "most"])


def _shared_bits(bits: np.ndarray, owner: np.ndarray, members: int) -> np.ndarray:
    """For all pairs of different members how many of their numbers agree, at least (equal numbers of one member count each)."""
    order = np.argsort(bits, kind="stable")
    owner, heads = owner[order], np.flatnonzero(np.diff(bits[order], prepend=-1))
    times = np.diff(np.append(heads, len(order)))
    left = np.repeat(times, times) - np.arange(len(order)) + np.repeat(heads, times) - 1  # so many follow with the same number
    left[np.repeat(times > RARE, times)] = 0
    pairs = [np.zeros(0, dtype=np.int64)]
    for step in range(1, int(left.max(initial=0)) + 1):
        at = np.flatnonzero(left >= step)
        pairs.append(owner[at] * members + owner[at + step])
    out = np.bincount(np.concatenate(pairs), minlength=members * members).reshape(members, members)
    out += out.T
    often = np.repeat(times > RARE, times)
    owner, at = owner[often], np.repeat(np.arange((times > RARE).sum()), times[times > RARE])
    width, step = int((times > RARE).sum()), max(1, CELLS // members)
    total = np.zeros((members, members), dtype=np.float32)
    for a in range(0, width, step):
        part, here = slice(*np.searchsorted(at, [a, a + step])), min(step, width - a)
        held = np.bincount(owner[part] * here + at[part] - a, minlength=members * here).reshape(members, here).astype(np.float32)
        total += held @ held.T
    return out + total.astype(np.int64)


def _best(comp: np.ndarray, i: np.ndarray, j: np.ndarray, near: np.ndarray, best: int) -> np.ndarray:
    """True for the pairs (i, j) that are among the ``best`` nearest of the component of either member."""
    kept = np.zeros(len(i), dtype=bool)
    owner, pair = np.concatenate([comp[i], comp[j]]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort((-near[pair], owner))
    heads = np.flatnonzero(np.diff(owner[order], prepend=owner[order][0] - 1))
    place = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
    kept[pair[order[place < best]]] = True
    return kept


def _list_tasks(percent: int, best: int | None, across: bool):
    """Pairs of a list that may be linked, from rows in order of (region, n): region, key, n, side, comp, ends.

    Without ``across``, only pairs inside blocks are compared. A list that has more pairs than those, or than the
    ``best`` of every component, adds a row with its region alone.
    """
    names = ["x", "y", "nx", "ny", "region"]

    def compare(part: list[np.ndarray], bits: list[np.ndarray], blocks: tuple[slice, ...]) -> tuple[np.ndarray | None, bool]:
        """Pairs inside a block, or between two, and whether there are more."""
        key, n, side, comp, last, size = (np.concatenate([x[block] for block in blocks]) for x in part)
        if (comp == comp[0]).all():
            return None, False
        own = [b for block in blocks for b in bits[block]]
        most = _shared_bits(np.concatenate(own).astype(np.int64), np.repeat(np.arange(len(n)), size), len(n))
        behind, both = n - size, n[:, None] + n[None, :]
        most += np.where(last[:, None] <= last[None, :], behind[:, None], behind[None, :])
        ok = ((100 + percent) * most >= percent * both) & (comp[:, None] != comp[None, :])
        ok &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
        ok &= (side[:, None] + side[None, :]) % 3 == 0  # 0 and 0, 1 and 2
        if len(blocks) > 1:
            first = blocks[0].stop - blocks[0].start
            ok[:first, :first] = ok[first:, first:] = False
        i, j = np.nonzero(ok & (key[:, None] < key[None, :]))
        more = False
        if best is not None and len(i) > best:
            kept = _best(comp, i, j, most[i, j] / both[i, j], best)
            more = not kept.all()
            i, j = i[kept], j[kept]
        return np.stack([key[i], key[j], n[i], n[j]]) if len(i) else None, more

    def compared(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        region, key, n, side, comp = (rows.column(i).to_numpy() for i in range(5))
        ends = rows.column(5).to_pylist()
        last = np.array([int.from_bytes(e[:8], "little") for e in ends], dtype=np.int64)
        bits = [np.frombuffer(e, np.uint16, offset=8) for e in ends]
        part = [key, n, side, comp, last, np.array([len(b) for b in bits])]
        found, held, again = [], 0, []

        def pairs_of() -> pa.RecordBatch:
            pairs = np.ascontiguousarray(np.concatenate(found, axis=1))
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in pairs), pa.nulls(pairs.shape[1], pa.int64())], names)

        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2 or (comp[a:b] == comp[a]).all():
                continue
            blocks = [slice(k, min(k + BLOCK, b)) for k in range(a, b, BLOCK)]
            chosen = [(x,) for x in blocks]
            if across:
                chosen += [(x, y) for i, x in enumerate(blocks) for y in blocks[i + 1:] if 100 * n[x.stop - 1] >= percent * n[y.start]]
            more = not across and len(blocks) > 1
            for pair in chosen:
                pairs, left = compare(part, bits, pair)
                more |= left
                if pairs is not None:
                    found.append(pairs)
                    held += pairs.shape[1]
                if held >= PAIRS_OUT:
                    yield pairs_of()
                    found, held = [], 0
            if more:
                again.append(region[a])
        if found:
            yield pairs_of()
        if again:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(again), pa.int64()) for _ in names[1:]), pa.array(again, pa.int64())], names)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the list that may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            region = rows.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
            yield from compared(rows.slice(0, starts[-1]), starts)
            kept = rows.slice(starts[-1])
        if kept is not None:
            yield from compared(kept, np.array([0, kept.num_rows]))

    return lists


def _alive_tasks(alive: np.ndarray):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            pivots = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.flatnonzero(may_contain(alive, pivots.view(np.uint64)))
            for a in range(0, len(at), 100_000):
                rows = pa.array(owner[at[a:a + 100_000]])
                yield pa.RecordBatch.from_arrays([pa.array(pivots[at[a:a + 100_000]]), batch.column(0).take(rows), batch.column(1).take(rows)], ["region", "key", "n"])

    return keep


def _regions(homes: DataFrame) -> DataFrame:
    """(region, key, n, side) of every region with two sets or more; of regions with the same members one stays.

    A filter of fixed size keeps most entries of lone regions out of the second shuffle; the join decides.
    """
    entries = homes.select(F.explode("pivots").alias("region"), "key")
    alive = stage(entries.groupBy("region").agg(F.min("key").alias("low"), F.max("key").alias("high"))
                  .filter("low <> high").select(F.col("region").alias("alive")), "jj-alive")
    maybe = homes.select("key", "n", "pivots").mapInArrow(_alive_tasks(bit_filter(alive, "alive", REGION_BITS)), "region long, key long, n long")
    members = stage(maybe.join(alive, F.col("region") == F.col("alive"), "left_semi").distinct(), "jj-members")
    digest = members.groupBy("region").agg(F.count("*").alias("g"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("f"))
    chosen = stage(digest.groupBy("g", "f").agg(F.min("region").alias("chosen")).select("chosen"), "jj-chosen")
    kept = members.join(chosen, F.col("region") == F.col("chosen"), "left_semi")
    return stage(kept.select("region", "key", "n", F.lit(0).alias("side")), "jj-regions")


class _Sets:
    """Whole shingle sets by key, read from the texts when first needed and staged; a round adds what is new.

    ``texts``: (key, text_key), one text per set. Only texts whose hash passes a filter are cut into words again.
    """

    def __init__(self, docs: DataFrame, texts: DataFrame, size: int):
        self.docs, self.texts, self.size, self.parts = docs, texts, size, []

    def of(self, keys: DataFrame) -> DataFrame:
        keys_of = keys
        for part in self.parts:
            keys = keys.join(part.select("key"), "key", "left_anti")
        keys = stage(keys, "jj-wanted")
        if not keys.isEmpty() or not self.parts:
            wanted = bit_filter(self.texts.join(keys, "key", "left_semi"), "text_key", REGION_BITS)
            found = self.docs.select("text", "text_key").mapInArrow(_set_tasks(wanted, self.size), "key long, shingles binary")
            self.parts.append(stage(found.join(keys, "key", "left_semi").dropDuplicates(["key"]), "jj-sets"))
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.union(part)
        return _only(out, keys_of)


def _only(table: DataFrame, keys: DataFrame, then=None, schema: str | None = None) -> DataFrame:
    """Rows of ``table`` (key first) whose key passes a filter of ``keys``, so that a join with few keys shuffles few rows.

    ``then``: further work on their batches, which gives ``schema``; in the same Python worker, not in a second one behind it.
    """
    wanted, names = bit_filter(keys, "key", REGION_BITS), table.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.flatnonzero(may_contain(wanted, batch.column(0).to_numpy().view(np.uint64)))
            for a in range(0, len(rows), ROWS_OUT):
                yield pa.RecordBatch.from_arrays([c.take(pa.array(rows[a:a + ROWS_OUT])) for c in batch.columns], names)

    return table.mapInArrow(lambda batches: then(keep(batches)) if then else keep(batches), schema or table.schema)


def _paired(pairs: DataFrame, table: DataFrame, column: str, apart: bool = False) -> DataFrame:
    """``apart``: a shuffle parts Python work in ``table`` from what follows, so a task needs one worker even if pairs would be broadcast."""
    left = pairs.join(table.select(F.col("key").alias("x"), F.col(column).alias("vx")), "x")
    right = table.select(F.col("key").alias("y"), F.col(column).alias("vy"))
    both = left.join(right.hint("merge") if apart else right, "y")
    return both.select("x", "y", "nx", "ny", "vx", "vy")


def _list_pairs(members: DataFrame, firsts: DataFrame, percent: int, best: int | None, across: bool) -> tuple[DataFrame, DataFrame]:
    """(x, y, nx, ny) of pairs that may be linked, and (region) of lists that are not done with them.

    ``members``: region, key, n, side, comp. Without ``across``, only pairs inside blocks are compared.
    """
    if across:  # few are left
        firsts = _only(firsts, members.select("key"))
    rows = members.join(firsts, "key").select("region", "key", "n", "side", "comp", "ends")
    tasks = rows.repartition("region").sortWithinPartitions("region", "n").mapInArrow(_list_tasks(percent, best, across), "x long, y long, nx long, ny long, region long")
    found = stage(tasks.distinct(), "jj-listed")
    return found.filter("x IS NOT NULL").select("x", "y", "nx", "ny"), found.filter("x IS NULL").select("region")


def _exact(likely: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """(x, y, nx, ny, most, linked) from the whole sets."""
    keys = likely.select(F.col("x").alias("key")).union(likely.select("y")).distinct()
    measured = _paired(likely, sets.of(keys), "shingles", apart=True).mapInArrow(_shared, "x long, y long, nx long, ny long, most long")
    return measured.withColumn("linked", _fits(percent))


def _fits(percent: int) -> Column:
    return F.expr(f"{100 + percent} * most >= {percent} * (nx + ny)")


def _distances(pairs: DataFrame, firsts: DataFrame, sets: _Sets, percent: int, listed: DataFrame) -> DataFrame:
    """(x, y, linked, d) per pair: exact where a link is possible, else a lower bound from sizes or first pivots.

    ``listed``: pairs that may be linked, measured along.
    """
    pairs, bounds, likely = _likely(pairs, firsts, percent)
    likely = stage(likely.union(listed).distinct(), "jj-likely")
    d = (1 - F.col("most") / (F.col("nx") + F.col("ny") - F.col("most"))).alias("d")
    return (_exact(likely, sets, percent).select("x", "y", "linked", d)
            .union(bounds.filter("NOT fits").select("x", "y", F.lit(False), d))
            .union(pairs.filter("NOT near").select("x", "y", F.lit(False), 1 - F.least("nx", "ny") / F.greatest("nx", "ny"))))


def _likely(pairs: DataFrame, firsts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct pairs, the bounds of those near in size, and (x, y, nx, ny) of those that may be linked."""
    pairs = stage(pairs.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"))
                  .withColumn("near", F.expr(f"100 * least(nx, ny) >= {percent} * greatest(nx, ny)")), "jj-pairs")
    near = pairs.filter("near")
    bounds = stage(_paired(near, firsts, "ends").mapInArrow(_bounds, "x long, y long, nx long, ny long, most long").withColumn("fits", _fits(percent)), "jj-bounds")
    return pairs, bounds, bounds.filter("fits").select("x", "y", "nx", "ny")


def _ordered(pairs: DataFrame) -> DataFrame:
    """(x, y, nx, ny) with x below y, from (key, n, other, on)."""
    first = F.col("key") < F.col("other")
    return pairs.select(F.least("key", "other").alias("x"), F.greatest("key", "other").alias("y"),
                        F.when(first, F.col("n")).otherwise(F.col("on")).alias("nx"), F.when(first, F.col("on")).otherwise(F.col("n")).alias("ny"))


def _open_regions(regions: DataFrame, roots: DataFrame) -> DataFrame:
    """Regions whose members are of several components, with the component of every member; staged."""
    known = regions.join(roots, F.col("key") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "key")).drop("node", "root")
    mixed = stage(known.groupBy(F.col("region").alias("r")).agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("r"), "jj-mixed")
    return stage(known.join(mixed, F.col("region") == F.col("r"), "left_semi").select("region", "key", "n", "side", "comp"), "jj-regions")


def _all(links: list[DataFrame]) -> DataFrame | None:
    out = None
    for part in links:
        out = part if out is None else out.union(part)
    return out


def _links(measured: DataFrame) -> DataFrame:
    return stage(measured.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b")), "jj-links")


def _first_links(regions: DataFrame, firsts: DataFrame, sets: _Sets, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, regions that are still open with the component of every member) after a round of a few pairs per set."""
    with temporary(regions.sparkSession) as keep:
        turn = F.explode(F.sequence(F.lit(0), F.lit(FIRST_PICKS - 1))).alias("turn")
        picked = regions.select("region", "key", "n", turn).groupBy("key", "turn").agg(F.min(F.struct(F.xxhash64("region", "turn").alias("h"), "region", "n")).alias("p"))
        pivots = regions.groupBy(F.col("region").alias("pr")).agg(F.min(F.struct(F.xxhash64("key").alias("h"), "key", "n")).alias("p"))
        pivots = stage(pivots.select("pr", F.col("p.key").alias("other"), F.col("p.n").alias("on")), "jj-pivots")
        pairs = picked.join(pivots, (F.col("p.region") == F.col("pr")) & (F.col("key") != F.col("other"))).select("key", F.col("p.n").alias("n"), "other", "on")
        found = _links(_exact(_likely(_ordered(pairs), firsts, percent)[2], sets, percent))
        regions = _open_regions(regions, connected_components(found, EDGES_AT_ONCE))
        keep(found, regions, *sets.parts)
    return found, regions


def _join_regions(regions: DataFrame, firsts: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """(node, root) of the components that all links make; sets without a link may be left out."""
    spark, eps, depth = regions.sparkSession, 1 - percent / 100, -1
    found, regions = _first_links(regions, firsts, sets, percent)
    links = [found]
    while not regions.isEmpty():
        depth += 1
        pairs, some, few, best = (steps[min(depth, len(steps) - 1)] for steps in (LEAF_PAIRS, PIVOTS, FEW, BEST))
        with temporary(spark) as keep:
            parts = regions.groupBy("region", "comp").agg(*(F.count_if(F.col("side") == k).alias(f"m{k}") for k in range(3)), F.sum("n").alias("held"))
            listed = f"n0 + n1 + n2 <= {LIST} AND held <= {LIST_SHINGLES} AND IF(n0 > 0, (n0 - top.m0) * n0, n1 * n2) <= {pairs}"
            size = stage(parts.groupBy(F.col("region").alias("r")).agg(
                *(F.sum(f"m{k}").alias(f"n{k}") for k in range(3)), F.max(F.struct("m0", "comp")).alias("top"), F.sum("held").alias("held"))
                .select("r", "n0", "n1", "n2", F.col("top.comp").alias("main"),
                        F.expr(f"CASE WHEN {listed} THEN 'list' WHEN n0 > 0 AND n0 - top.m0 <= {few} THEN 'few' ELSE 'big' END").alias("kind")), "jj-size")
            kinds = {r.kind for r in size.select("kind").distinct().collect()}
            sized = regions.join(size, F.col("region") == F.col("r"))
            lists = sized.filter("kind = 'list'").select("region", "key", "n", "side", "comp")
            likely, again = _list_pairs(lists, firsts, percent, best, depth > 0)
            again = lists.join(again.select(F.col("region").alias("r")), F.col("region") == F.col("r"), "left_semi").select("region", "key", "n", "side")
            if kinds == {"list"}:
                found = _links(_exact(likely, sets, percent))
                links.append(found)
                if best is None:
                    keep(found)
                    break
                regions = _open_regions(again, connected_components(_all(links), EDGES_AT_ONCE))
                keep(found, regions, *sets.parts)
                continue
            leaf = sized.filter("kind = 'few'")
            outside = leaf.filter("comp <> main")
            met = leaf.select(F.col("region").alias("r2"), F.col("key").alias("other"), F.col("n").alias("on"), F.col("comp").alias("comp2"))
            small = outside.join(met, (F.col("region") == F.col("r2")) & F.expr("comp <> comp2 AND (comp2 = main OR key < other)"))
            # Pivots: the least hash of each of a few slots, of the side that shrinks; min() is combined before the shuffle.
            # A ring that fits is measured whole; else ball members are pivots, and a ring member needs one link to be done.
            by = F.when(F.col("n0") > 0, 0).when(F.col("n2") <= some, 2).otherwise(1)
            big = stage(sized.filter("kind = 'big'").select("region", "key", "n", "side", by.alias("by")), "jj-big")
            # The hash is of the set alone, so regions with much the same members pick the same pivots.
            mixed = F.xxhash64("key", F.lit(depth))
            slot = F.when(F.col("by") == 2, F.pmod(mixed, F.lit(16 * some))).otherwise(F.pmod(mixed, F.lit(some)))
            pivots = stage(big.filter("side = by").groupBy(F.col("region").alias("pr"), slot.alias("slot"))
                           .agg(F.min(F.struct(mixed.alias("h"), "key", "n")).alias("p"))
                           .select("pr", F.col("p.key").alias("pivot"), F.col("p.n").alias("pn")), "jj-pivots")
            against = big.filter("side <> by OR by = 0").join(pivots, (F.col("region") == F.col("pr")) & (F.col("key") != F.col("pivot")))
            measured = stage(against.select("region", "key", "n", "side", "pivot", "pn"), "jj-measured")
            wide = measured.select("key", "n", F.col("pivot").alias("other"), F.col("pn").alias("on"))
            asked = _ordered(small.select("key", "n", "other", "on").union(wide))
            dist = stage(_distances(asked, firsts, sets, percent, likely), "jj-dist")
            found = _links(dist)
            links.append(found)
            seen = measured.join(dist, (F.least("key", "pivot") == F.col("x")) & (F.greatest("key", "pivot") == F.col("y"))) \
                .select("region", "key", "n", "side", "pivot", "linked", "d")
            after = stage(_next_regions(big, pivots, stage(seen, "jj-seen"), eps, depth).union(again), "jj-next")
            regions = _open_regions(after, connected_components(_all(links), EDGES_AT_ONCE))
            keep(found, regions, *sets.parts)
    return connected_components(_all(links), EDGES_AT_ONCE)


def _next_regions(big: DataFrame, pivots: DataFrame, seen: DataFrame, eps: float, depth: int) -> DataFrame:
    tick = 1e-9  # distances are rounded floats; the window is widened, never narrowed
    whole = seen.filter("side = 0")
    # Pivots that share a linked member with the busiest pivot of the region are one component with it, and so are
    # all members linked to them; between such a pivot and such a member no pair is open.
    linked = whole.filter("linked").select("region", "key", "pivot")
    busiest = stage(linked.groupBy("region", "pivot").count().groupBy(F.col("region").alias("r"))
                    .agg(F.max(F.struct("count", "pivot")).alias("b")).select("r", F.col("b.pivot").alias("hub")), "jj-hubs")
    around = linked.join(busiest, (F.col("region") == F.col("r")) & (F.col("pivot") == F.col("hub")), "left_semi").select(F.col("region").alias("r"), F.col("key").alias("k"))
    touching = linked.join(stage(around, "jj-around"), (F.col("region") == F.col("r")) & (F.col("key") == F.col("k")), "left_semi").select("region", "pivot")
    joined = stage(touching.union(busiest.select("r", "hub")).distinct().toDF("jr", "jp"), "jj-joined")
    of_hub = linked.join(joined, (F.col("region") == F.col("jr")) & (F.col("pivot") == F.col("jp")), "left_semi").select("region", "key")
    covered = stage(of_hub.union(joined.select("jr", "jp")).distinct().toDF("cr", "ck"), "jj-covered")
    flagged = whole.join(joined, (F.col("region") == F.col("jr")) & (F.col("pivot") == F.col("jp")), "left") \
        .join(covered, (F.col("region") == F.col("cr")) & (F.col("key") == F.col("ck")), "left")
    # A pivot's cell is one for all regions that picked it.
    cell = flagged.groupBy("pivot", "key").agg(F.any_value("n").alias("n"), F.bool_or("linked").alias("linked"), F.min("d").alias("d"),
                                               F.bool_or(F.col("jp").isNotNull() & F.col("ck").isNotNull()).alias("covered"))
    cell = stage(cell.filter("linked OR NOT covered"), "jj-cells")
    ring_edge = stage(cell.filter(f"NOT linked AND d <= {2 * eps + tick}").groupBy(F.col("pivot").alias("p")).agg(F.min("d").alias("edge")), "jj-edge")
    cells = cell.join(ring_edge, F.col("pivot") == F.col("p"))
    cells = cells.filter(f"(linked AND d >= edge - {eps + tick}) OR (NOT linked AND d <= {2 * eps + tick})").select(
        F.xxhash64("pivot", F.lit(depth)).alias("region"), "key", "n", F.when(F.col("linked"), 1).otherwise(2).alias("side"))
    near = stage(whole.filter("linked").select(F.col("region").alias("r"), F.col("key").alias("k")).union(pivots.select("pr", "pivot")).distinct(), "jj-near")
    rest = big.filter("side = 0").join(near, (F.col("region") == F.col("r")) & (F.col("key") == F.col("k")), "left_anti").select(
        F.xxhash64("region", F.lit(2)).alias("region"), "key", "n", F.lit(0).alias("side"))
    # Ball-and-ring regions: pivots have met the whole other side, and linked ring members belong to the ball's component.
    done = pivots.select("pr", "pivot").union(seen.filter("side = 2 AND linked").select("region", "key")).distinct()
    open_ones = stage(big.filter("side <> 0").join(done, (F.col("region") == F.col("pr")) & (F.col("key") == F.col("pivot")), "left_anti"), "jj-open")
    both = open_ones.groupBy(F.col("region").alias("r")).agg(F.count_distinct("side").alias("sides")).filter("sides = 2")
    rings = open_ones.join(both, F.col("region") == F.col("r"), "left_semi").select("region", "key", "n", "side")
    return cells.union(rest).union(rings)


def _rooted(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, root) per row; root is NULL for texts without words."""
    docs = docs.select("doc_id", "text", _text_key().alias("text_key"))
    spark = docs.sparkSession
    with temporary(spark) as keep:
        with temporary(spark) as keep_small:  # the pivots of all sets, the largest table, go before regions are joined
            classes = pivot_classes(docs, size)
            homes = stage(docs.mapInArrow(_home_tasks(classes, size, percent), "doc_id long, text_key long, n long, key long, pivots array<long>"), "jj-homes")
            regions = _regions(homes.filter("key IS NOT NULL"))
            active = stage(regions.select(F.col("key").alias("k")).distinct(), "jj-active")
            ends = _only(homes.filter("key IS NOT NULL").select("key", "text_key", "pivots"), active.select(F.col("k").alias("key")), _ends, "key long, text_key long, ends binary")
            firsts = ends.join(active, F.col("key") == F.col("k"), "left_semi").groupBy("key").agg(F.min("text_key").alias("text_key"), F.first("ends").alias("ends"))
            texts = stage(firsts, "jj-firsts")
            rows = stage(homes.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "key"), "jj-rows")
            keep_small(regions, texts, rows)
        firsts = texts.select("key", "ends")
        roots = _join_regions(regions, firsts, _Sets(docs, texts, size), percent)
        out = stage(rows.join(roots, F.col("key") == F.col("node"), "left")
                    .select("doc_id", "text_key", "n_shingles", F.coalesce("root", "key").alias("root")), "jj-rooted")
        keep(out)
    return out


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_shingles and component_id, the least doc_id its links reach.

    Sets are distinct runs of ``size`` words (A-Z lower-cased); a text with fewer words is one run. Two rows
    link when ``100 * |x & y| >= percent * |x | y|``. NULL, empty and blank texts have size 0, link with
    nothing and keep their own doc_id. Repeated rows are kept, each with the same result. A NULL doc_id is
    allowed and never becomes the least unless nothing else is in the component. Further columns of ``docs``
    are ignored whatever their names. An empty table gives an empty one.
    """
    rooted = _rooted(docs, size, percent)
    least = stage(rooted.groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("least")).filter("r IS NOT NULL"), "jj-least")
    return rooted.join(least, F.col("root") == F.col("r"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every component: the least doc_id (NULL last), then the least text hash.

    Texts without words stay, all of them. All columns are kept. Of rows that agree in doc_id and text one stays.
    """
    rooted = _rooted(docs, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    best = rooted.filter("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("b")).select(F.col("b.doc_id").alias("_d"), F.col("b.text_key").alias("_k"))
    copies = rooted.filter("root IS NOT NULL").groupBy("doc_id", "text_key").count()
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k"))
    chosen = stage(copies.join(best.distinct(), same, "inner").select("_d", "_k", "count"), "jj-kept")
    wordless = rooted.filter("root IS NULL").select("doc_id", "text_key", F.lit(1).alias("count")).distinct()
    chosen = chosen.union(wordless)
    names = docs.columns
    match = docs["doc_id"].eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_k"))
    single = docs.join(chosen.filter("count = 1"), match, "left_semi").select(*names)
    several = docs.join(chosen.filter("count > 1"), match, "left_semi").select(*names).dropDuplicates(["doc_id", "text"])
    return single.union(several)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(reached) AS component_id FROM r GROUP BY 1) c ON c.node = d.doc_id"""


@query(ORACLE_SQL)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
