"""MinHash near-duplicates with an LSH forest: sorted signature orders, and neighbours by longest common prefix in them.

1. Every whole text becomes its set of word shingles, hashed to 64 bits. Texts with equal sets form a
   class, of which one member goes on, so copies cost nothing further.
2. Each class has a signature of ``TREES * DEPTH`` minimum hashes. A tree's classes with a common prefix of
   ``MIN_DEPTH`` values form a region; classes alone in theirs are dropped before any signature moves. A region
   is sorted by its tree's values, and its rows meet by longest common prefix: first each row its
   neighbours in the order, then the intervals with ``DEPTH`` values in common, then shorter prefixes, as far
   up as rows are not connected yet. So a region's depth adapts to how much its deeper prefixes connect.
   Pairs whose whole signatures agree too little are dropped.
3. The classes that these links connect form a cluster, which holds all candidate pairs of its members.
4. Clusters are confirmed on whole sets. A pair is left out only where confirmed links connect it already, so
   the components are those of all confirmed pairs.

A region or cluster too large for a task is met in rounds (``met``): within blocks, then the rows outside of its largest
component with that component, then what is still outside with the rest.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestar.llm.batches import map_rows, without_ids
from tidestar.llm.components import components, least_members
from tidestar.session import stored

TREES, DEPTH, MIN_DEPTH = 14, 5, 3
HASHES = TREES * DEPTH
#: Rows of a region or cluster in a block, and shingles of a cluster in a block; larger ones have more blocks and rounds.
REGION_ROWS, SET_VALUES = 2048, 1_000_000
RANDOM = np.random.default_rng(20240229)
FACTORS = RANDOM.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64)
CACHE_WORDS = 200_000
CHUNK = 2048


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: lowers A-Z only
        if not words:
            return np.empty(0, np.uint64)
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - width + 1 + i])
        return np.unique(out)


def signature(shingles: np.ndarray) -> bytes:
    """The minimum hashes of a set, 16 bits each, big-endian so that bytes sort as values."""
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        np.minimum(least, (FACTORS[:, None] * part[None, :] + OFFSETS[:, None]).min(axis=1), out=least)
    return mixed(least).astype(np.uint16).astype(">u2").tobytes()


SIGNED = "doc_id bigint, n_shingles bigint, id bigint, sig binary"


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Set size, class and signature of each document; no class without words."""

    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        shingler = Shingler(width)

        def signatures(rows: dict[str, list]) -> dict[str, list]:
            sets = [shingler(t) for t in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                "n_shingles": [len(s) for s in sets],
                "id": [digest_class(s) for s in sets],
                "sig": [signature(s) if len(s) else None for s in sets],
            }

        return signatures

    return map_rows(docs.select("doc_id", "text"), SIGNED, make)


def digest_class(shingles: np.ndarray) -> int | None:
    """The class of a set: a 64-bit digest of all of it; none for the empty set."""
    return int.from_bytes(xxhash.xxh3_64_digest(shingles.tobytes()), "big", signed=True) if len(shingles) else None


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """The whole sets: ``doc_id``, ``id`` (class), ``shingles`` (hashes as signed 64-bit integers)."""

    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        shingler = Shingler(width)

        def sets(rows: dict[str, list]) -> dict[str, list]:
            found = [shingler(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "id": [digest_class(s) for s in found], "shingles": [s.view(np.int64) for s in found]}

        return sets

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, id bigint, shingles array<bigint>", make)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and the starts of the groups with the end, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []  # rows of the last group, which may go on

    def cut(rows: pa.Table) -> np.ndarray:
        new = np.append(True, np.zeros(rows.num_rows - 1, bool))
        for k in keys:
            values = rows.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(new), rows.num_rows)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held and all(batch.column(k)[batch.num_rows - 1] == held[0].column(k)[0] for k in map(batch.schema.get_field_index, keys)):
            held.append(batch)
            continue
        rows = pa.Table.from_batches([*held, batch])
        starts = cut(rows)
        if len(starts) > 2:
            yield rows.slice(0, starts[-2]), starts[:-1]
        held = rows.slice(starts[-2]).to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        yield rows, cut(rows)


def spanning(
    count: int, side: np.ndarray | None, linked: Callable[[int, np.ndarray], np.ndarray], known: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect rows as all links between them do.

    ``linked(i, others)`` tells which rows link with row ``i``. A row is asked only about rows that no link
    has reached yet, and with ``side`` only about rows of the other side. Rows of one ``known`` label are
    connected from the start; labels are changed in place as rows are linked.
    """
    links: list[tuple[int, int]] = []
    known = np.arange(count) if known is None else known
    rest = np.arange(count)
    while len(rest):
        label = known[rest[0]]
        mine = known[rest] == label
        queue, rest = deque(map(int, rest[mine])), rest[~mine]
        while queue and len(rest):
            i = queue.popleft()
            others = rest if side is None else rest[side[rest] != side[i]]
            found = others[linked(i, others)] if len(others) else others
            if len(found):
                links += [(i, int(j)) for j in found]
                reached = np.isin(known[rest], known[found])
                queue.extend(map(int, rest[reached]))
                known[rest[reached]] = label
                rest = rest[~reached]
    return links


def intervals(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """The intervals of sorted rows with a common prefix of ``DEPTH`` values, then of fewer, down to ``MIN_DEPTH``."""
    common = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)  # longest common prefixes of neighbours
    seen: set[tuple[int, int]] = set()
    for depth in range(DEPTH, MIN_DEPTH - 1, -1):
        bounds = [0, *(np.flatnonzero(common < depth) + 1).tolist(), len(values)]
        for at in zip(bounds, bounds[1:], strict=False):
            if at[1] - at[0] > 1 and at not in seen:
                seen.add(at)
                yield at


class Likeness:
    """Tells which sets may be near-duplicates, from sizes and signatures."""

    def __init__(self, rows: pa.Table, percent: int) -> None:
        share = percent / 100
        self.percent = percent
        self.least = int(HASHES * share - 4 * (HASHES * share * (1 - share)) ** 0.5)
        self.n = rows.column("n").to_numpy()
        self.sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), ">u2").reshape(-1, HASHES)

    def __call__(self, i: int | np.ndarray, others: np.ndarray) -> np.ndarray:
        n, m = self.n[i], self.n[others]
        fit = 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        at = np.flatnonzero(fit)
        one = self.sig[i] if np.ndim(i) == 0 else self.sig[i[at]]
        fit[at] = (self.sig[others[at]] == one).sum(axis=1) >= self.least
        return fit


LINKS = "family bigint, a bigint, b bigint"


def met(
    rows: DataFrame, payload: Callable[[DataFrame], DataFrame], links_of: Callable[[DataFrame, bool], DataFrame], label: str
) -> DataFrame:
    """Links (``a``, ``b``) that connect the rows of each group as all links between them do.

    ``rows`` is a stored table of ``family`` (the group), ``id`` and ``parts`` (blocks of the group). ``payload`` adds what a
    comparison needs, and ``links_of`` compares within each (``family``, ``one``, ``two``): it links all rows to the smallest id of
    their component there, or, with its second argument, finds links between two sides. A group of one block meets
    at once. Of a larger one each block meets first. Then the rows outside the largest component met so far (its ``core``) meet
    that component, and what stays outside meets all rows outside the core. Two rows never meet only where links connect
    them, so nothing is lost, and a row is sent once for each block of rows outside, not once for each block of the group.
    """
    home = rows.withColumn("one", F.pmod(F.xxhash64("id"), "parts")).withColumn("two", F.lit(0).cast("bigint"))
    home = home.withColumn("side", F.lit(0)).withColumn("label", F.col("id"))
    links = stored(links_of(payload(home), False), label)
    big = rows.where("parts > 1")
    if big.isEmpty():
        return links.select("a", "b")
    held = big.join(links.select("family", F.col("b").alias("id"), F.col("a").alias("label")), ["family", "id"], "left")
    held = stored(held.withColumn("label", F.coalesce("label", "id")), label)
    counts = held.groupBy("family", "label").count()
    held = held.join(counts.groupBy("family").agg(F.max_by("label", F.struct("count", "label")).alias("core")), "family")
    held = stored(held.withColumn("outside", F.col("label") != F.col("core")), label)
    first = between(held, "not outside", payload, links_of, label)
    hits = held.join(first.select("family", F.col("a").alias("id")).distinct(), ["family", "id"], "left_semi")
    held = held.join(hits.select("family", "label").distinct().withColumn("hit", F.lit(True)), ["family", "label"], "left")
    held = held.where("outside").withColumn("outside", F.col("hit").isNull())
    held = stored(held.withColumn("label", F.when(F.col("hit"), F.col("core")).otherwise(F.col("label"))).drop("hit"), label)
    rest = between(held, "true", payload, links_of, label)
    return links.unionByName(first).unionByName(rest).select("a", "b")


def between(
    held: DataFrame, inner: str, payload: Callable[[DataFrame], DataFrame], links_of: Callable[[DataFrame, bool], DataFrame], label: str
) -> DataFrame:
    """Links of the rows ``outside`` (``a``) with those of the condition ``inner`` (``b``), in pairs of blocks of both."""
    share = F.first("parts") / F.count(F.lit(1))
    ones, twos = (F.ceil(F.count_if(F.expr(c)) * share) for c in ("outside", inner))
    sizes = stored(held.groupBy("family").agg(ones.alias("ones"), twos.alias("twos")).where("ones > 0 and twos > 0"), label)
    if sizes.isEmpty():
        return held.sparkSession.createDataFrame([], LINKS)
    dealt = held.join(sizes, "family")

    def side(rows: DataFrame, number: int, own: str, other: str) -> DataFrame:
        rows = rows.withColumn("side", F.lit(number)).withColumn(own, F.pmod(F.xxhash64("id"), own + "s"))
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other + "s") - 1)))

    sides = side(dealt.where("outside"), 0, "one", "two").unionByName(side(dealt.where(inner), 1, "two", "one"))
    return stored(links_of(payload(sides.drop("ones", "twos", "outside", "core")), True), label)


def stars(rows: pa.Table, label: np.ndarray) -> pa.RecordBatch:
    """Links of all rows to the smallest id of their label."""
    ids, family = rows.column("id").to_numpy(), rows.column("family").to_numpy()
    order = np.lexsort((ids, label))
    new = np.append(True, label[order][1:] != label[order][:-1])
    least = ids[order[new]][np.cumsum(new) - 1]
    return link_batch(family[order[~new]], least[~new], ids[order[~new]])


def sided(rows: pa.Table, links: list[tuple[int, int]]) -> pa.RecordBatch:
    """The links, each from the row of side 0."""
    ids, family, side = (rows.column(c).to_numpy() for c in ("id", "family", "side"))
    pairs = np.array(links, np.int64).reshape(-1, 2)
    pairs = np.where(side[pairs[:, :1]] == 0, pairs, pairs[:, ::-1])
    return link_batch(family[pairs[:, 0]], ids[pairs[:, 0]], ids[pairs[:, 1]])


def link_batch(family: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (family, left, right)], ["family", "a", "b"])


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) that connect classes as all pairs do that share a region and are alike by their signatures.

    ``classes`` has ``id``, ``n``, ``sig``. A region is a tree and a prefix of ``MIN_DEPTH`` values.
    """
    start = F.col("tree") * (2 * DEPTH) + 1
    trees = classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    rows = trees.select(F.xxhash64("tree", F.substring("sig", start, F.lit(2 * MIN_DEPTH))).alias("family"), "tree", "id")
    sizes = rows.groupBy("family").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")  # most rows are alone in their region
    sizes = stored(sizes.select("family", F.ceil(F.col("rows") / REGION_ROWS).alias("parts")), "regions")
    rows = stored(rows.join(sizes, "family"), "regions")

    def links_of(held: DataFrame, crossed: bool) -> DataFrame:
        held = held.repartition("family", "one", "two").sortWithinPartitions("family", "one", "two", F.substring("sig", start, F.lit(2 * DEPTH)), "id")

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, starts in whole_groups(batches, ["family", "one", "two"]):
                yield from (crossed_links if crossed else tree_links)(rows, starts, percent)

        return held.mapInArrow(within, LINKS).where("a != b")

    return met(rows, lambda held: held.join(classes.select("id", "n", "sig"), "id"), links_of, "candidates")


def tree_links(rows: pa.Table, starts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Components of whole regions, or blocks of them, whose rows come in the order of their tree."""
    alike, tree = Likeness(rows, percent), rows.column("tree").to_numpy()
    near = np.ones(rows.num_rows, bool)  # the row before is a neighbour in the region, and like this one
    near[starts[:-1]] = False
    at = np.flatnonzero(near)
    near[at] = alike(at - 1, at)
    label = np.cumsum(~near)
    for low, high in zip(starts, starts[1:], strict=False):
        if high - low < 3 or label[low] == label[high - 1]:
            continue  # neighbours are all there is, or connect all
        values = alike.sig[low:high, tree[low] * DEPTH : (tree[low] + 1) * DEPTH]
        for first, last in intervals(values):
            at = low + first
            spanning(last - first, None, lambda i, others, at=at: alike(at + i, at + others), label[at : low + last])
    yield stars(rows, label)


def crossed_links(rows: pa.Table, starts: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between the two sides of each group; rows of one label are connected already."""
    alike, side = Likeness(rows, percent), rows.column("side").to_numpy()
    label = np.unique(rows.column("label").to_numpy(), return_inverse=True)[1]
    for low, high in zip(starts, starts[1:], strict=False):
        links = spanning(high - low, side[low:high], lambda i, others, at=low: alike(at + i, at + others), label[low:high])
        yield sided(rows.slice(low, high - low), links)


#: Cells of the bitmap of wanted documents: 8 MB, whatever the data.
CELLS = 2**26


def only_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is in ``wanted``, and a few others of the same cell of a bitmap of fixed size.

    The bitmap is broadcast, so texts that are not wanted are neither shuffled nor given to Python. Beyond some ten million wanted
    documents it fills, and more others come along.
    """
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)) + 1
    cells = wanted.select(F.bitmap_bucket_number(cell).alias("bucket"), F.bitmap_bit_position(cell).alias("bit")).repartition("bucket")
    bits = stored(cells.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "wanted")
    place = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1
    held = docs.select("doc_id", "text").withColumn("bucket", F.bitmap_bucket_number(cell))
    return held.join(F.broadcast(bits), "bucket").where(hit).select("doc_id", "text")


def confirmed(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that connect the members of each cluster as all pairs do whose whole sets have a Jaccard similarity of ``percent`` % or more.

    ``members`` has ``id``, ``doc_id``, ``n``, ``sig`` and ``cluster``; ``docs`` has the texts.
    """
    sizes = members.groupBy("cluster").agg(F.ceil(F.greatest(F.sum("n") / SET_VALUES, F.count(F.lit(1)) / REGION_ROWS)).alias("parts"))
    rows = stored(members.join(sizes, "cluster").select(F.col("cluster").alias("family"), "id", "parts"), "clusters")

    def payload(held: DataFrame) -> DataFrame:
        sets = shingle_sets(only_wanted(docs, members.join(held.select("id").distinct(), "id", "left_semi")), width)
        sets = sets.select(F.col("id").alias("set_id"), F.col("doc_id").alias("set_doc"), "shingles").where("set_id is not null")
        held = held.join(members.select("id", "doc_id", "n", "sig"), "id")
        own = (F.col("set_id") == F.col("id")) & F.col("set_doc").eqNullSafe(F.col("doc_id"))
        return held.join(sets, own).drop("set_id", "set_doc", "doc_id")

    def links_of(held: DataFrame, crossed: bool) -> DataFrame:
        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, starts in whole_groups(batches, ["family", "one", "two"]):
                for low, high in zip(starts, starts[1:], strict=False):
                    if high - low > 1:
                        part = rows.slice(low, high - low)
                        ids, side = part.column("id").to_numpy(), part.column("side").to_numpy()
                        new = (ids[1:] != ids[:-1]) | (side[1:] != side[:-1])
                        part = part.filter(pa.array(np.append(True, new)))  # rows that repeat an id repeat its set
                        yield confirmed_links(part, percent, crossed)

        held = held.repartition("family", "one", "two").sortWithinPartitions("family", "one", "two", "id", "side")
        return held.mapInArrow(within, LINKS).where("a != b")

    return met(rows, payload, links_of, "confirmed")


def confirmed_links(rows: pa.Table, percent: int, crossed: bool) -> pa.RecordBatch:
    """Confirmed components of one cluster or block of it, or links between the two sides of a pair of blocks."""
    label = np.unique(rows.column("label").to_numpy(), return_inverse=True)[1]
    alike = Likeness(rows, percent)
    sets = [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for chunk in rows.column("shingles").chunks for s in chunk]

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        fit = alike(i, others)
        for k in np.flatnonzero(fit):
            a, b = sorted((sets[i], sets[others[k]]), key=len)
            both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            fit[k] = 100 * both >= percent * (len(a) + len(b) - both)
        return fit

    if crossed:
        return sided(rows, spanning(rows.num_rows, rows.column("side").to_numpy(), linked, label))
    spanning(rows.num_rows, None, linked, label)
    return stars(rows, label)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The near-duplicate component of every document of ``docs`` (``doc_id``, ``text``).

    Documents are linked when their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` % or more. Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id
    reachable by links) and ``kept`` (the document is that one). One row per input row; rows that
    repeat an id are documents of their own, each with the component of its text. Null, empty and
    wordless texts have no shingles and no links; a text shorter than ``width`` words is one
    shingle. A row without an id takes part like others, but never names a component, which is
    null where no member has an id. An empty table gives no rows; other columns are ignored.
    """
    table = stored(signed(docs, width), "signatures")
    worded = table.where("id is not null")
    classes = worded.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = stored(classes, "classes")
    clusters = components(candidates(classes, percent)).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    members = stored(classes.join(clusters, "id"), "clusters")
    named = least_members(classes.select("id", "doc_id"), confirmed(members, docs, width, percent))
    out = table.join(named, "id", "left").withColumn("component_id", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def kept_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group, with all their columns.

    The document of the smallest id stays, and with it all rows that have its id. Null, empty and wordless texts link with
    nothing and stay, long ones are compared whole. Rows without an id share one fate: they go if one of them goes. An empty
    table gives no rows, and other columns may have any names.
    """
    return without_ids(docs, near_duplicates(docs, width, percent).where(~F.col("kept")))
