"""Near-duplicate documents from bottom-k sketches made with one hash function.

1. Each text's distinct word shingles are hashed once; the smallest KEPT hashes are its sketch.
   Texts with equal shingle sets form a class, which is numbered, and one sketch of it goes on.
2. Inverted lists of the LISTED smallest values. Two sets of similarity t share at least ``need`` of these (but for one pair in ten million at exactly t), so by the prefix principle
   they share one of the first ``LISTED - need + 1`` values in any order common to all. The order
   is by how often a value occurs, from a table of fixed size, then by value: lists of values that
   many documents share are left out wherever enough rarer values exist. The order affects cost
   only, so no value and no partner is capped.
3. Entries of lists that more than one document is in carry the set's size and 16 bits of each LISTED
   value. The members of a list whose sizes and LISTED values allow the threshold are linked, and what these links join is
   a cluster. A value shared by chance doesn't join documents: with enough of them it would join most of a large table
   into one. Bits can only make an overlap look larger, so no link is lost. A list of more than LONG members, and a cluster
   of more than BLOCK, is dealt into blocks twice, by set size and id and by id alone, and each block is compared in one task.
   Of two members that are joined by then nothing is asked. So those that aren't with most of their cluster, and no others,
   visit all its blocks whose sizes allow a link, in rounds that move about as many rows as there are classes.
4. Sketches of KEPT values are sent to their clusters, and each pair is estimated by the sketch of
   its union; pairs that may reach the threshold give finer clusters.
5. Texts are sent to the finer clusters, and what may reach the threshold by a sketch of UNION values
   is confirmed on full sets, with integers. A pair already joined by confirmed links needs no link
   of its own, so what comes out of 4 and 5 is a forest, never all pairs. Links give components.

Only texts of the finer clusters are moved: a sieve of their ids keeps the others where they are.

Defined cases: null text, empty text and text of white space have no shingle and link with nothing;
a text with fewer words than a shingle is one shingle, its whole sequence; a null id links with
nothing and is kept; rows that repeat an id are judged each by its own text, so of two rows of an
id one may be kept; an empty table gives no rows; a long text is one row of the arrays, never cut;
other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from math import comb, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import chunks, mix, sets
from .common import components, forgotten, near, parquet, ship, swept, written

LISTED, KEPT, UNION, BLOCK = 32, 64, 256, 512
#: Members up to which a list is compared in one task, and up to which its pairs are compared along with those of other lists.
LONG, SHORT = 2048, 8
#: Rows of visitors to blocks that are moved at once, or as many as there are classes.
AT_ONCE = 1 << 16
TILE = 64
TABLE_BITS = 20
SALTS = 0x5BD1E995, 0x27D4EB2F


@cache
def needed(k: int, t: float, miss: float = 1e-7) -> int:
    """The most values of a union's k smallest that a pair of similarity t shares, but for ``miss``."""
    total, x = 0.0, 0
    while x < k:
        total += comb(k, x) * t**x * (1 - t) ** (k - x)
        if total > miss:
            break
        x += 1
    return max(1, x)


def _digests(width: int):
    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1)):
                values, at = sets(data, offsets, width)
                n = np.diff(at)
                k1, k2 = (_totals(mix(values ^ np.uint64(salt)), at) for salt in SALTS)
                low = [values[a : min(b, a + KEPT)].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), batch.column(2).slice(first, len(n)), pa.array(n), pa.array(k1), pa.array(k2), pa.array(low, pa.binary())],
                    names=["id", "mark", "n", "k1", "k2", "sketch"])
    return run


def _totals(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of each text's values, as signed numbers."""
    run = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=run[1:])
    return (run[at[1:]] - run[at[:-1]]).view(np.int64)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The LISTED first values of all sketches, one after another, and the row of each."""
    cells = [c[: 8 * LISTED] for c in column.to_pylist()]
    return np.frombuffer(b"".join(cells), dtype=np.uint64), np.repeat(np.arange(len(cells)), [len(c) // 8 for c in cells])


def _slot(values: np.ndarray) -> np.ndarray:
    return (mix(values) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _counts(batches):
    for batch in batches:
        slots, n = np.unique(_slot(_flat(batch.column(0))[0]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(n.astype(np.int64))], names=["slot", "n"])


def _postings(table, t: float, entries: bool):
    """(value) of every list that a row (id, n, sketch) is in; with ``entries`` (value, id, n, low), where low has 16 bits of each LISTED value."""
    need = needed(LISTED, t)

    def run(batches):
        often = table.value
        for batch in batches:
            values, row = _flat(batch.column(2))
            n = batch.column(1).to_numpy()
            order = np.lexsort((values, often[_slot(values)], row))
            size = np.bincount(row, minlength=len(n))
            place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            # where every possible partner's whole set is its sketch, the overlap needed is exact
            whole = n < LISTED * t - 1e-9
            least = np.where(whole, np.ceil(n * t - 1e-9), np.minimum(need, size)).astype(np.int64)
            keep = place < (size - least + 1)[row]
            found, names = [pa.array(values[order][keep].view(np.int64))], ["value"]
            if entries:
                ends = np.concatenate([[0], 2 * np.cumsum(size)]).astype(np.int32)
                low = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<u2"))])
                at = pa.array(row[keep])
                found, names = [*found, batch.column(0).take(at), batch.column(1).take(at), low.take(at)], ["value", "id", "n", "low"]
            yield pa.RecordBatch.from_arrays(found, names=names)
    return run


def overlaps(parts: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every two ascending arrays, exact below 2**24."""
    m = len(parts)
    owner = np.repeat(np.arange(m), [len(p) for p in parts])
    values = np.concatenate(parts) if m else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    group, owner = group[many], owner[many]
    if len(group):
        group = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
    out = np.zeros((m, m), dtype=np.float32)
    for c in range(0, int(group[-1]) + 1 if len(group) else 0, columns):
        a, b = np.searchsorted(group, [c, c + columns])
        grid = np.zeros((m, min(columns, int(group[-1]) + 1 - c)), dtype=np.float32)
        grid[owner[a:b], group[a:b] - c] = 1
        out += grid @ grid.T
    return out


def forest(ids: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a matrix of links joins, breadth first: one for each merge."""
    found: list[tuple[int, int]] = []
    left = linked.any(axis=1)
    while left.any():
        s = int(np.flatnonzero(left)[0])
        left[s], queue = False, [s]
        while queue:
            x = queue.pop()
            got = np.flatnonzero(linked[x] & left)
            left[got] = False
            found += [(int(ids[x]), int(ids[y])) for y in got]
            queue += got.tolist()
    return found


def alike(ids: np.ndarray, size: np.ndarray, low: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that join the documents of these sketches whose similarity may reach the threshold."""
    return forest(ids, _enough(overlaps(low), size[:, None], size, percent, KEPT) & ~np.eye(len(ids), dtype=bool))


def _enough(shared: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, k: int) -> np.ndarray:
    """Whether sets of sizes x and y may reach the threshold when ``shared`` of their k smallest values are in both."""
    small, large = np.minimum(x, y), np.maximum(x, y)
    return np.where(large <= k, 100 * shared >= percent * (x + y - shared), shared >= needed(k, percent / 100)) & (100 * small >= percent * large)


def _grid(low: pa.Array) -> np.ndarray:
    """The values of each row, filled up to LISTED with -1."""
    size = np.diff(np.frombuffer(low.buffers()[1], dtype=np.int32)[low.offset : low.offset + len(low) + 1]) // 2
    out = np.full((len(low), LISTED), -1, dtype=np.int32)
    out[np.arange(LISTED) < size[:, None]] = np.frombuffer(b"".join(low.to_pylist()), dtype="<u2")
    return out


def _meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many equal values each row of one grid has with each of another; never less than their sets share."""
    held, owner = b[b >= 0], np.nonzero(b >= 0)[0]
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    value, row = a[a >= 0], np.nonzero(a >= 0)[0]
    first = np.searchsorted(held, value)
    n = np.searchsorted(held, value, side="right") - first
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.bincount(np.repeat(row, n) * len(b) + owner[at], minlength=len(a) * len(b)).reshape(len(a), len(b))


def gathered(ids: np.ndarray, size: np.ndarray, grid: np.ndarray, percent: int, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that join the members of a list that may reach the threshold: one for each merge. Members of one value in ``joined`` are joined already.

    Of two members that are already joined nothing is asked, so a large group of near copies costs about one tile.
    """
    label = np.arange(len(ids)) if joined is None else np.unique(joined, return_inverse=True)[1]
    found: list[tuple[int, int]] = []
    for first in range(0, len(ids), TILE):
        rows = np.arange(first, min(len(ids), first + TILE))
        most = label[rows] == np.bincount(label[rows]).argmax()
        for mine in (rows[~most], rows[most]):
            others = np.arange(first, len(ids))
            if len(mine) and (label[mine] == label[mine[0]]).all():
                others = others[label[others] != label[mine[0]]]
            if not len(mine) or not len(others):
                continue
            enough = _enough(_meeting(grid[mine], grid[others]), size[mine][:, None], size[others], percent, LISTED)
            for x, fits in zip(mine.tolist(), enough, strict=True):
                hit = others[fits]
                of, at = np.unique(label[hit], return_index=True)
                new = of != label[x]
                if new.any():
                    found += [(int(ids[x]), int(ids[y])) for y in hit[at[new]]]
                    of = np.append(of[new], label[x])
                    label[np.isin(label, of)] = of.min()
    return found


def _paired(ids: np.ndarray, size: np.ndarray, grid: np.ndarray, list_of: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """The pairs of short lists that may reach the threshold, all lists at once."""
    found: list[tuple[int, int]] = []
    for step in range(1, SHORT):
        a = np.flatnonzero(list_of[step:] == list_of[:-step])
        a = a[100 * np.minimum(size[a], size[a + step]) >= percent * np.maximum(size[a], size[a + step])]
        for i in range(0, len(a), 2048):
            x, y = a[i : i + 2048], a[i : i + 2048] + step
            other = np.where(grid[y] < 0, -2, grid[y])
            shared = (grid[x][:, :, None] == other[:, None, :]).sum((1, 2))
            enough = _enough(shared, size[x], size[y], percent, LISTED)
            found += zip(ids[x[enough]].tolist(), ids[y[enough]].tolist(), strict=True)
    return found


def links(ids: np.ndarray, full: list[np.ndarray], percent: int, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Confirmed links that join what is linked among these sets; one for each merge. Sets of one value in ``joined`` are joined already."""
    m = len(ids)
    size = np.array([len(x) for x in full])
    low = [x[:UNION] for x in full]
    shared = overlaps(low)
    small, large = np.minimum.outer(size, size), np.maximum.outer(size, size)
    possible = (100 * small.astype(np.int64) >= percent * large) & ~np.eye(m, dtype=bool)
    whole = size <= UNION
    both = np.logical_and.outer(whole, whole)
    parent = list(range(m))
    if joined is not None:
        _, first, at = np.unique(joined, return_index=True, return_inverse=True)
        parent = first[at].tolist()
        possible &= at[:, None] != at
    sure = possible & both & (100 * shared >= percent * (np.add.outer(size, size) - shared))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    found: list[tuple[int, int]] = []

    def join(x: int, y: int) -> None:
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)

    for x, y in forest(np.arange(m), sure):
        join(x, y)
        found.append((int(ids[x]), int(ids[y])))
    # others: the values that both sketches hold bound what the sketch of the union holds of the intersection
    t = percent / 100
    spread = 6 * (t * (1 - t) / UNION) ** 0.5
    kept = np.minimum(UNION, large)
    a, b = np.nonzero(np.triu(possible & ~both & (shared >= (t - spread) * kept - 1)))
    for i in np.argsort(-shared[a, b], kind="stable").tolist():
        x, y = int(a[i]), int(b[i])
        if root(x) != root(y):
            common = len(np.intersect1d(full[x], full[y], assume_unique=True))
            if 100 * common >= percent * (len(full[x]) + len(full[y]) - common):
                join(x, y)
                found.append((int(ids[x]), int(ids[y])))
    return found


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], names=["a", "b"])


def _gathered(percent: int):
    """Over rows (key, id, n, low) and maybe (joined), sorted by key."""
    def run(batches):
        left = []

        def done(rows):
            rows = rows.combine_chunks().to_batches()[0]
            key = rows.column(0)
            new = np.ones(len(key), dtype=bool)
            new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            list_of, start = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(key))
            ids, size, grid = rows.column(1).to_numpy(), rows.column(2).to_numpy(), _grid(rows.column(3))
            short = np.flatnonzero((np.diff(start) <= SHORT)[list_of])
            out = _paired(ids[short], size[short], grid[short], list_of[short], percent)
            for i in np.flatnonzero(np.diff(start) > SHORT).tolist():
                of = slice(start[i], start[i + 1])
                out += gathered(ids[of], size[of], grid[of], percent, rows.column(4).to_numpy()[of] if rows.num_columns > 4 else None)
            return _edges(out)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, last = batch.column(0), batch.column(0)[batch.num_rows - 1]
            at = pc.index(key, last).as_py()  # from here on it is one list, which the next batch may go on with
            if at == 0 and left and left[-1].column(0)[0] == last:
                left.append(batch)
                continue
            if left or at:
                yield done(pa.Table.from_batches([*left, batch.slice(0, at)]))
            left = [batch.slice(at)]
        if left:
            yield done(pa.Table.from_batches(left))
    return run


def _alike(percent: int):
    """Over rows (key, id, n, sketch), sorted by key."""
    def run(batches):
        key, held, out = None, [], []
        for batch in batches:
            for k, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if k != key:
                    if len(held) > 1:
                        ids, n, low = zip(*held, strict=True)
                        out += alike(np.array(ids), np.array(n), [np.frombuffer(x, np.uint64) for x in low], percent)
                    key, held = k, []
                held.append(row)
            yield _edges(out)
            out = []
        if len(held) > 1:
            ids, n, low = zip(*held, strict=True)
            yield _edges(alike(np.array(ids), np.array(n), [np.frombuffer(x, np.uint64) for x in low], percent))
    return run


def _linked(width: int, percent: int):
    """Over rows (key, class, k1, text) and maybe (joined), sorted by key and class: of rows that repeat an id, those whose text isn't of the class are passed over, and so are repeats."""
    def run(batches):
        key, ids, full, joined = None, [], [], []

        def done():
            return _edges(links(np.array(ids), full, percent, np.array(joined) if joined else None))

        for batch in batches:
            keys, own, sums = (batch.column(i).to_pylist() for i in range(3))
            labels = batch.column(4).to_pylist() if batch.num_columns > 4 else None
            for first, data, offsets in chunks(batch.column(3)):
                values, at = sets(data, offsets, width)
                found = _totals(mix(values ^ np.uint64(SALTS[0])), at).tolist()
                for i in range(len(offsets) - 1):
                    if keys[first + i] != key:
                        if len(ids) > 1:
                            yield done()
                        key, ids, full, joined = keys[first + i], [], [], []
                    if found[i] != sums[first + i] or ids and ids[-1] == own[first + i]:
                        continue
                    ids.append(own[first + i])
                    if labels:
                        joined.append(labels[first + i])
                    full.append(values[at[i] : at[i + 1]].copy())
        if len(ids) > 1:
            yield done()
    return run


def _met(members: DataFrame, t: float, block: int, rows: int, meet: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (a, b) that join what ``meet`` links among the members of each cluster.

    members: (cluster, id, n, total) and other columns, where total is how many the cluster has. meet gets these but for
    cluster and total, with a key, and after the first round with the component that joins a member by then. One call of it gets
    some ``rows`` at a time of those that visit blocks, or one set of visitors to one cluster, so disk doesn't grow with the square of a cluster.
    """
    also = [c for c in members.columns if c not in ("cluster", "total")]
    few = members.where(F.col("total") <= block).select(F.col("cluster").cast("string").alias("key"), *also)
    many = members.where(F.col("total") > block).withColumn("band", F.floor(F.log("n") / log(1 / t)).cast("bigint"))
    if many.isEmpty():
        return written(meet(few))

    def dealt(df: DataFrame, parts: str, part: str, salt: int) -> DataFrame:
        """df with the part of its cluster and band that a row is in, of some ``block`` rows each."""
        per = df.groupBy("cluster", "band").agg(F.ceil(F.count(F.lit(1)) / block).alias(parts))
        return df.join(per.hint("merge"), ["cluster", "band"]).withColumn(part, F.pmod(F.xxhash64("id", F.lit(salt)), F.col(parts)))

    many = written(dealt(many, "parts", "part", 1))
    any_part = F.pmod(F.xxhash64("id", F.lit(2)), F.ceil(F.col("total") / block))
    first = [many.select(F.concat_ws(":", *key).alias("key"), *also) for key in (("cluster", "band", "part"), ("cluster", any_part))]
    edges = written(meet(few.unionByName(first[0]).unionByName(first[1])))
    swept(members)
    label = components(edges).select(F.col("node").alias("id"), "component")
    many = many.join(label.hint("merge"), "id", "left").withColumn("joined", F.coalesce("component", "id")).drop("component")
    most = many.groupBy("cluster", "joined").agg(F.count(F.lit(1)).alias("here")).groupBy("cluster").agg(F.max(F.struct("here", "joined"))["joined"].alias("most"))
    apart = many.join(most.hint("merge"), "cluster").where("joined <> most").drop("parts", "most")
    apart = written(dealt(apart, "sets", "set", 3))
    homes = many.groupBy("cluster", F.col("band").alias("home"), "parts").agg(F.count(F.lit(1)).alias("there"))
    visits = apart.groupBy("cluster", "band", "sets").agg(F.count(F.lit(1)).alias("here"))
    visits = written(visits.join(homes.hint("merge"), "cluster").where("abs(band - home) <= 1"))
    moved = visits.agg(F.sum(F.col("here") * F.col("parts") + F.col("there") * F.col("sets"))).first()[0]
    if not moved:
        return edges
    rounds = -(-moved // rows)
    many, found = written(many), edges
    keys, of_round = ["cluster", "band", "set", "home", "place"], F.pmod(F.xxhash64("cluster", "band", "set"), F.lit(rounds))

    def upto(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    asked = visits.select("cluster", "band", "home", "parts", "sets")
    for i in range(rounds):
        # a visitor is at home in one of the blocks, where it stays
        guests = apart.where(of_round == i).withColumn("own", F.col("band")).drop("sets").join(asked.hint("merge"), ["cluster", "band"]).withColumn("place", upto("parts"))
        guests = guests.where("own <> home or place <> part")
        hosts = many.withColumnsRenamed({"band": "home", "part": "place"}).drop("parts").join(asked.hint("merge"), ["cluster", "home"]).withColumn("set", upto("sets")).where(of_round == i)
        here = [df.select(F.concat_ws(":", *keys).alias("key"), *also, "joined") for df in (guests, hosts)]
        found = found.unionByName(written(meet(here[0].unionByName(here[1]))))
        swept(members)
    return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept, and ``mark`` if one is given, which tells rows of one id apart."""
    spark = docs.sparkSession
    ship(spark)
    t = percent / 100
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), (F.lit(None) if mark is None else mark).cast("bigint").alias("mark"))
    digests = written(texts.select("id", "text", "mark").mapInArrow(_digests(width), "id bigint, mark bigint, n bigint, k1 bigint, k2 bigint, sketch binary"))
    set_key = ["k1", "k2", "n"]
    sound = digests.where("n > 0 and id is not null")
    classes = written(sound.groupBy(*set_key).agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")).withColumn("class", F.monotonically_increasing_id()))
    swept(docs)
    reps = classes.select(F.col("class").alias("id"), "n", "sketch")

    table = np.zeros(1 << TABLE_BITS, dtype=np.int64)  # fixed size: 8 MB
    got = reps.select("sketch").mapInArrow(_counts, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table[got["slot"].to_numpy()] = got["n"].to_numpy()
    often = spark.sparkContext.broadcast(table)
    lists = written(reps.mapInArrow(_postings(often, t, False), "value bigint").groupBy("value").agg(F.count(F.lit(1)).alias("total")).where("total > 1"))
    # of the entries only those of a list with others are moved
    entries = near(reps.mapInArrow(_postings(often, t, True), "value bigint, id bigint, n bigint, low binary"), [F.col("value")], lists, ["value"])
    entries = written(entries.join(lists.hint("merge"), "value").withColumnRenamed("value", "cluster"))
    swept(docs)
    least_rows = max(AT_ONCE, reps.count())

    def sorted_by_key(df: DataFrame, *then: str) -> DataFrame:
        return df.repartition("key").sortWithinPartitions("key", *then)

    candidates = _met(entries, t, LONG, least_rows, lambda df: sorted_by_key(df, "id").mapInArrow(_gathered(percent), "a bigint, b bigint"))

    def placed(edges: DataFrame) -> DataFrame:
        clusters = components(edges).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
        total = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("total"))
        return written(reps.select("id", "n").join(clusters.join(total.hint("merge"), "cluster").hint("merge"), "id"))

    # what is placed grows with the documents, so joins are merge joins at every size; only rows that may be met are moved
    def by_sketch(df: DataFrame) -> DataFrame:
        df = written(df.select("key", "id"))
        met = near(reps, [F.col("id")], df, ["id"]).join(df.hint("merge"), "id").select("key", "id", "n", "sketch")
        return sorted_by_key(met, "id").mapInArrow(_alike(percent), "a bigint, b bigint")

    def by_text(df: DataFrame) -> DataFrame:
        joined = ["joined"] if "joined" in df.columns else []
        wanted = written(classes.select(F.col("class").alias("id"), "rep", "k1").join(df.hint("merge"), "id").select("key", F.col("id").alias("class"), "rep", "k1", *joined))
        pairs = near(texts.select("id", "text"), [F.col("id")], wanted, ["rep"]).join(wanted.hint("merge"), F.col("id") == F.col("rep"))
        return sorted_by_key(pairs.select("key", "class", "k1", "text", *joined), "class").mapInArrow(_linked(width, percent), "a bigint, b bigint")

    rough = placed(candidates)
    forgotten(entries)
    swept(docs)
    finer = placed(_met(rough, t, BLOCK, least_rows, by_sketch))
    swept(docs)
    found = components(_met(finer, t, BLOCK, least_rows, by_text))
    swept(docs)
    joined = written(classes.select("class", *set_key, "rep").join(found.hint("merge"), F.col("class") == F.col("node"), "left"))
    linked = joined.where("component is not null")
    least = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    alone = joined.where("component is null").select(*set_key, F.col("rep").alias("component_id"))  # not joined on a null
    of_class = linked.join(least.hint("merge"), "component").select(*set_key, "component_id").unionByName(alone)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return digests.join(of_class.hint("merge"), set_key, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), *([] if mark is None else ["mark"]))


def op5_bottom_k_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(parquet(spark, sf_dir, "documents"), width=3, percent=85)


OP5_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) >= 3 then list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                                      when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh from w
), n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r as (select a as doc_id, a as reached from e union select r.doc_id, e.b from r join e on e.a = r.reached),
c as (select doc_id, min(reached) as component_id from r group by doc_id)
select doc_id, coalesce(n.n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id, doc_id = coalesce(component_id, doc_id) as kept
from w left join n using (doc_id) left join c using (doc_id)
"""
