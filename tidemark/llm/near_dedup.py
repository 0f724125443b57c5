"""Near-duplicate groups by SuperMinHash signatures, banding, verification on full sets and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept, slices, small_batches, text_bytes

BANDS, ROWS = 32, 5
SLOTS = 240  # the first BANDS * ROWS also make up the bands
TEXT_AT_ONCE = 1 << 20
ELEMENTS_AT_ONCE = 1 << 15
BLOCK = 1024
MARGIN = 14  # percentage points by which a link's signatures may agree less than its sets
MARK_BITS = 26  # marks are 2 ** 20 words of 64 bits at most, however many ids there are
FILLED = np.uint64(1 << 32)
SPACES = [0x20, *range(0x09, 0x0E)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray, add: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (add + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(256, dtype=np.uint64), 1)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each text's begin.

    Words are runs without white space, A-Z in lower case; a text of fewer than `size` words has
    its whole sequence as one shingle, a text without words has none.
    """
    data, offsets = text_bytes(column)
    texts = len(offsets) - 1
    inside = np.ones(256, bool)
    inside[SPACES] = False
    data = LOWER[data]
    inside = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    word = np.cumsum(starts) - 1
    place = np.arange(len(data)) - begin[np.maximum(word, 0)]
    powers = np.cumprod(np.full(int(place[inside].max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    values = np.where(inside, BYTE_VALUES[data] * powers[np.where(inside, place, 0)], np.uint64(0))
    words = mixed(np.add.reduceat(values, begin))
    first = np.searchsorted(begin, offsets)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(texts), n_words)
    left = first[1:][owner] - np.arange(len(words))  # words from here to the text's end
    shingles = words.copy()
    for k in range(1, size):
        further = np.zeros(len(words), np.uint64)
        further[: max(len(words) - k, 0)] = words[k:]
        shingles = np.where(left > k, mixed(shingles * np.uint64(3) + further, k), shingles)
    whole = (left >= size) | ((left == n_words[owner]) & (n_words[owner] < size))
    shingles, owner = shingles[whole], owner[whole]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[new], owner[new]
    return shingles, np.searchsorted(owner, np.arange(texts + 1))


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SuperMinHash of every set: an element gives value rank + fraction to the slot of that rank in its own permutation.

    All elements go rank by rank. A set stops as soon as every slot holds a value below the next
    rank, since no further rank could lower one. Permutations are made as far as they are needed.
    """
    sets = len(first) - 1
    best = np.full((sets, SLOTS), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < sets:
        upto = max(at + 1, int(np.searchsorted(first, first[at] + ELEMENTS_AT_ONCE, side="right")) - 1)
        elements = shingles[first[at] : first[upto]]
        owner = np.repeat(np.arange(at, upto), np.diff(first[at : upto + 1]))
        table = None
        for rank in range(SLOTS):
            if not len(elements):
                break
            drawn = mixed(elements, 7 + rank)
            pick = rank + (((drawn >> np.uint64(32)) * np.uint64(SLOTS - rank)) >> np.uint64(32)).astype(np.int64)
            if table is None:
                slot = pick
            else:
                rows = np.arange(len(elements))
                slot = table[rows, pick].astype(np.int64)
                table[rows, pick] = table[rows, rank]
            np.minimum.at(best.reshape(-1), owner * SLOTS + slot, np.uint64(rank << 32) | (drawn & np.uint64(0xFFFFFFFF)))
            open_sets = best[at:upto].max(axis=1) >= np.uint64(rank + 1) * FILLED
            live = np.flatnonzero(open_sets[owner - at])
            if table is None:
                table = np.empty((len(live), SLOTS), np.uint8)
                table[:] = np.arange(SLOTS, dtype=np.uint8)
                rows = np.arange(len(live))
                table[rows, pick[live]] = 0
            elif len(live) < len(elements):
                table = table[live]
            elements, owner = elements[live], owner[live]
        at = upto
    return best


def _described(column: pa.Array, size: int) -> list[pa.Array]:
    shingles, first = shingle_sets(column, size)
    n = np.diff(first)
    best = signatures(shingles, first)
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles, 100 + k))]) for k in (0, 1)]
    keys = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
    short = (mixed(best) & np.uint64(0xFF)).astype(np.uint8)
    has = n > 0
    return [
        pa.array(n),
        pa.array(keys[0]),
        pa.array(keys[1]),
        pa.array([s.tobytes() if h else None for s, h in zip(short, has)], pa.binary()),
    ]


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def described(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, t1 and t2 (the text's key), n (size of the set), k1 and k2 (its 128-bit key), short (a byte for each slot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *_described(batch.column(3), size)], ["doc_id", "t1", "t2", "n", "k1", "k2", "short"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")), F.col("text").alias("text"))
    return read.mapInArrow(run, "doc_id long, t1 long, t2 long, n long, k1 long, k2 long, short binary")


def _alike(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least `least` slots."""
    for batch in batches:
        if batch.num_rows:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, SLOTS) for k in (2, 3))
            good = np.count_nonzero(left == right, axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))


def _alike_sets(left: bytes, right: bytes, percent: int) -> bool:
    left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    both = int(np.isin(left, right, assume_unique=True).sum())
    return 100 * both >= percent * (len(left) + len(right) - both)


def possibly_in(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of df (id, ...) whose id may be in ids (id): all that are, and a share of the others.

    A word has a bit for each of 64 hashes of ids. At most 2 ** 20 words of two numbers are broadcast,
    whatever the input; more ids than bits only let more rows through.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(1 << MARK_BITS))
    word = F.shiftright(place, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    marks = ids.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    met = df.join(F.broadcast(marks), word == F.col("__word"))
    return met.where(F.col("__bits").bitwiseAND(bit) != 0).select(*df.columns)


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id, elements (the sorted shingle hashes of the whole text) of the documents in ids (id).

    Texts are sifted where they are read, so that only those asked for are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            shingles, first = shingle_sets(batch.column(1), size)
            data = [shingles[i:j].tobytes() for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "elements"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    ids = kept(ids.distinct(), "ids")
    texts = possibly_in(texts, ids).join(ids, "id", "left_semi").dropDuplicates(["id", "text"])
    return kept(texts.mapInArrow(run, "id long, elements binary"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = [_alike_sets(left[k].as_py(), right[k].as_py(), percent) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    sets = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), size)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("left")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id that occurs in edges (a, b).

    Each round hooks every node to its smallest neighbour and contracts the edges; rounds grow
    with the logarithm of the longest path of falling ids, and each is kept in the shared folder.
    """
    both = kept(edges.union(edges.select("b", "a").toDF("a", "b")).distinct(), "edges")
    labels = both.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    while not both.isEmpty():
        parent = kept(both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("p")), "parents")
        labels = kept(
            labels.join(parent, F.col("component") == F.col("v"), "left").select("id", F.coalesce("p", "component").alias("component")), "labels"
        )
        ahead = both.join(parent, F.col("a") == F.col("v")).select(F.col("p").alias("a"), "b")
        moved = ahead.join(parent, F.col("b") == F.col("v")).select("a", F.col("p").alias("b"))
        both = kept(moved.where(F.col("a") != F.col("b")).distinct(), "edges")
    return labels


def _by_group(work) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work applied to tables of whole groups; rows come sorted by group g, a group has at most a few BLOCKs of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([waiting, table]) if waiting is not None else table
            if not table.num_rows:
                continue
            group = table.column("g").to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield from work(table.slice(0, cut))
            waiting = table.slice(cut)
        if waiting is not None and waiting.num_rows:
            yield from work(waiting)

    return run


class _Groups:
    """Rows of some groups, and for a row the later rows of its group that it has to be compared with there."""

    def __init__(self, table: pa.Table, least: int, percent: int):
        group = table.column("g").to_numpy()
        self.ids, self.own, self.n, self.band = (table.column(c).to_numpy() for c in ("id", "own", "n", "band"))
        self.short = np.frombuffer(b"".join(table.column("short").to_pylist()), np.uint8).reshape(-1, SLOTS)
        self.least, self.percent = least, percent
        edges = np.flatnonzero(np.diff(group)) + 1
        self.spans = list(zip([0, *edges], [*edges, len(group)]))

    def partners(self, i: int, high: int, root: np.ndarray, two_blocks: bool) -> np.ndarray:
        """Rows of another component and, where blocks meet, of the other block; likely by their signatures.

        Each pair is taken in the first band that it shares, where it meets exactly once.
        """
        rest = slice(i + 1, high)
        n = self.n[rest]
        good = (root[rest] != root[i]) & (100 * np.minimum(n, self.n[i]) >= self.percent * np.maximum(n, self.n[i]))
        if two_blocks:
            good &= self.own[rest] != self.own[i]
        where = i + 1 + np.flatnonzero(good)
        if not len(where):
            return where
        same = self.short[where] == self.short[i]
        near = np.count_nonzero(same, axis=1) >= self.least
        where, same = where[near], same[near]
        return where[same[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == self.band[i]]


def _likely_rows(least: int, percent: int):
    """Rows that have a likely partner in their group, all columns as they are."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        groups = _Groups(table, least, percent)
        component = table.column("component").to_numpy()
        found = np.zeros(table.num_rows, bool)
        for low, high in groups.spans:
            two_blocks = bool((groups.own[low:high] != groups.own[low]).any())
            for i in range(low, high - 1):
                where = groups.partners(i, high, component, two_blocks)
                found[where] = True
                found[i] |= len(where) > 0
        yield from table.filter(pa.array(found)).combine_chunks().to_batches()

    return _by_group(work)


def _joining_links(least: int, percent: int):
    """Links confirmed on full sets that join components of a group: at most one for each row."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        groups = _Groups(table, least, percent)
        root = table.column("component").to_numpy().copy()
        elements = table.column("elements")
        links = []
        for low, high in groups.spans:
            two_blocks = bool((groups.own[low:high] != groups.own[low]).any())
            for i in range(low, high - 1):
                for j in groups.partners(i, high, root, two_blocks):
                    if root[i] != root[j] and _alike_sets(elements[i].as_py(), elements[j].as_py(), percent):
                        links.append((int(groups.ids[i]), int(groups.ids[j])))
                        part = root[low:high]
                        part[part == root[j]] = root[i]
        a, b = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _by_group(work)


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, t1, t2, n, k1, k2, component (null where no row of the same set has an id), for every row of docs.

    Documents are linked if 100 * intersection >= percent * union of their sets of `size`-word
    shingles. Equal sets form a class, and only one document of a class goes further. Classes that
    share a band are first compared with the smallest of their bucket; then all that are still in
    different components of one bucket, in blocks, by signature, and those that are likely pairs on
    full sets. A block gives only links that join components, so a group of n copies never makes
    more than about n rows. A pair above the threshold shares no band with a probability under 1e-5
    at 80, 1e-8 at 85 percent.

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat an id belong
    together. A row of null id is kept and has no component. An empty table gives no rows.
    """
    told = kept(described(docs, size), "signatures")
    classes = told.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("k1", "k2").agg(F.min("doc_id").alias("id"))
    classes = kept(classes, "classes")
    reps = told.join(classes.withColumnRenamed("id", "doc_id"), ["k1", "k2", "doc_id"]).dropDuplicates(["k1", "k2", "doc_id"])
    reps = kept(reps.select(F.col("doc_id").alias("id"), "n", "short"), "representatives")
    least = -(-(percent - MARGIN) * SLOTS // 100)

    # the low six bits of a key say which band it is of
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.shiftleft(F.xxhash64(b, F.substring("short", b * ROWS + 1, F.lit(ROWS))), 6).bitwiseOR(b.cast("long")),
    )
    rows = reps.select("id", F.explode(band).alias("key"))
    buckets = rows.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    shared = kept(rows.join(kept(buckets.select("key", "first"), "buckets"), "key"), "shared")
    stars = shared.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()

    left = stars.join(reps.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col("short").alias("left")), "a")
    both = left.join(reps.select(F.col("id").alias("b"), "n", F.col("short").alias("right")), "b")
    both = both.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select("a", "b", "left", "right")
    candidates = kept(both.mapInArrow(lambda batches: _alike(batches, least), "a long, b long").distinct(), "candidates")
    links = kept(verified(candidates, docs, size, percent), "links")
    found = components(links)

    labelled = shared.select("key", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    spread = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    # a bucket of one component is done; a bucket of many members is compared block by block
    blocks = F.ceil(F.col("members") / BLOCK)
    open_rows = labelled.join(spread.where("low < high").select("key", "members"), "key")
    open_rows = open_rows.withColumn("own", F.pmod(F.xxhash64("id"), blocks))
    open_rows = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("g")
    open_rows = open_rows.select(group, F.col("key").bitwiseAND(F.lit(63)).alias("band"), "own", "id", "component")
    open_rows = open_rows.join(reps, "id").select("g", "band", "own", "id", "component", "n", "short")

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("g").sortWithinPartitions("g")

    likely = kept(dealt(open_rows).mapInArrow(_likely_rows(least, percent), open_rows.schema), "likely")
    if not likely.isEmpty():
        with_sets = likely.join(full_sets(docs, likely.select("id"), size), "id")
        with_sets = dealt(with_sets.select(*likely.columns, "elements"))
        more = with_sets.mapInArrow(_joining_links(least, percent), "a long, b long").distinct()
        found = components(kept(links.union(more), "links"))

    named = classes.join(found, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("component"))
    return told.drop("short").join(named, ["k1", "k2"], "left")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept, for every row of docs.

    Documents are linked if 100 * intersection >= percent * union of their sets of `size`-word
    shingles. Ids are numbers. Null and empty texts have no shingles and are linked with nothing. Rows
    that repeat an id belong together only if their sets are linked. A row of null id is kept and has
    the component of its set, if that has one. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        out = _grouped(docs, size, percent)
    component = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns as they are, of one document of each group: the smallest id's, of its texts the one of the smallest key.

    Rows without words stay. A row of null id stays only if no row with an id is in its group, and then only
    one such row does. Of rows equal in id and text the one of the smallest hash of all columns stays.
    """
    with small_batches(docs.sparkSession):
        rows = _grouped(docs, size, percent).where("n > 0")
    alone = F.col("component").isNull()
    group = ["component", "g1", "g2"]
    texts = rows.withColumns({"g1": F.when(alone, F.col("k1")), "g2": F.when(alone, F.col("k2"))})
    texts = kept(texts.groupBy(*group, "doc_id", "t1", "t2").agg(F.count("*").alias("copies")), "texts")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    chosen = texts.groupBy(*group).agg(F.min(first).alias("one"), F.count("*").alias("texts")).where("texts > 1")
    same_group = [texts[c].eqNullSafe(chosen[c]) for c in group]
    gone = texts.join(chosen, on=same_group).where(first != F.col("one"))
    gone = kept(gone.select(F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2")).distinct(), "gone")
    t1, t2 = text_key(docs["text"])

    def of(other: DataFrame) -> list[Column]:
        return [docs["doc_id"].cast("long").eqNullSafe(other["__id"]), t1 == other["__t1"], t2 == other["__t2"]]

    stay = docs.join(gone, of(gone), "left_anti")
    twins = texts.where("copies > 1").select(F.col("doc_id").alias("__id"), F.col("t1").alias("__t1"), F.col("t2").alias("__t2"))
    twins = kept(twins.join(gone, [twins[c].eqNullSafe(gone[c]) for c in gone.columns], "left_anti"), "twins")
    if twins.isEmpty():
        return stay
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = docs.join(twins, of(twins), "left_semi").groupBy(F.col("doc_id").alias("__id"), *text_key(F.col("text")))
    once = once.agg(F.min_by(whole, F.xxhash64(whole)).alias("__row")).select("__row.*")
    return stay.join(twins, of(twins), "left_anti").unionByName(once)
