"""A prefix trie of conversations rebuilt from a base's head and their own suffix, by composable fingerprints.

A turn's fingerprint is a number made from its content key; the fingerprint of a run of turns is the
hash product of its turns: runs x, y with (power, value) compose to (power_x * power_y,
value_x * power_y + value_y). The composition is associative, so prefix products are made in parts and
joined, and an own suffix is its whole prefix with the head taken out again:

    rebuilt(d) = own(pos) + (base(head) - own(head)) * power(pos - head)

No rebuilt text is ever made. A turn is referred to by its content key (128 bits), and each key is checked
to stand for one content; nodes are groups of equal fingerprints, checked to hold one last turn and one parent.
If a check ever fails, everything is done again with the next seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept

# Primes just below 2 ** 31, one for each lane of a fingerprint, and the lanes' powers of one turn.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525, 214013, 69069)
LANES = range(len(PRIMES))
GROUP, HEADS = 5, 9
SEEDS = 4
CHUNK = 1 << 16

KEY = ("key0", "key1")
NODE = ("depth", "node0", "node1")
PREFIX = tuple(f"value{k}" for k in LANES) + tuple(f"power{k}" for k in LANES)


class FingerprintClash(RuntimeError):
    """Different contents under one key, or different runs of turns under one fingerprint."""


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def keyed_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """conv_id, turn, role, key0, key1, size: rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(F.lit(seed), role, text).alias("key0"),
        F.xxhash64(F.lit(~seed), text, F.lit("\n"), role).alias("key1"),
        F.octet_length(text).cast("long").alias("size"),
    )


def _check_keys(turns: DataFrame) -> None:
    """Every key must stand for one role and text; copies meet before the shuffle, so a hot content is no burden."""
    contents = turns.select(*KEY, "role", "text").distinct().groupBy(*KEY).agg(F.count("*").alias("contents"))
    if not contents.where("contents > 1").isEmpty():
        raise FingerprintClash


def _scan(values: np.ndarray, powers: np.ndarray, starts: np.ndarray, prime: int) -> tuple[np.ndarray, np.ndarray]:
    """Running hash products within runs that begin where starts is set, by doubling."""
    prime = np.uint64(prime)
    run = np.cumsum(starts)
    step = 1
    while step < len(values):
        same = run[step:] == run[:-step]
        if not same.any():
            break
        value = np.where(same, (values[:-step] * powers[step:] + values[step:]) % prime, values[step:])
        power = np.where(same, powers[:-step] * powers[step:] % prime, powers[step:])
        values, powers = np.concatenate([values[:step], value]), np.concatenate([powers[:step], power])
        step *= 2
    return values, powers


def _compose(x: dict, y: dict) -> dict:
    """The product of two runs: turns and sizes add up, fingerprints compose."""
    out = {"pos": x["pos"] + y["pos"], "cum": x["cum"] + y["cum"]}
    for k, prime in enumerate(PRIMES):
        out[f"value{k}"] = (x[f"value{k}"] * y[f"power{k}"] + y[f"value{k}"]) % prime
        out[f"power{k}"] = x[f"power{k}"] * y[f"power{k}"] % prime
    return out


EMPTY_RUN = {"pos": 0, "cum": 0} | {f"value{k}": 0 for k in LANES} | {f"power{k}": 1 for k in LANES}


def _products_of_a_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running products of a sorted part; a conversation goes on from batch to batch."""
    part, last, first_conv, carry = TaskContext.get().partitionId(), None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, key0, key1, size = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("conv_id", *KEY, "size"))
        starts = np.append(True, conv[1:] != conv[:-1])
        at = np.flatnonzero(starts)
        goes_on = last is not None and conv[0] == last
        first_conv = int(conv[0]) if first_conv is None else first_conv
        length = int(at[1]) if len(at) > 1 else len(conv)  # of the run that goes on
        run_start = np.repeat(at, np.diff(np.append(at, len(conv))))
        pos = np.arange(len(conv)) - run_start + 1
        sums = np.cumsum(size)
        cum = sums - (sums - size)[run_start]
        columns = {}
        halves = [h.view(np.uint64) >> np.uint64(s) & np.uint64(0x7FFFFFFF) for h in (key0, key1) for s in (0, 32)]
        for k, prime in enumerate(PRIMES):
            own = halves[k] % np.uint64(prime - 1) + np.uint64(1)
            values, powers = _scan(own, np.full(len(own), BASES[k], np.uint64), starts, prime)
            if goes_on:
                v, p = np.uint64(carry[f"value{k}"]), np.uint64(carry[f"power{k}"])
                values[:length] = (v * powers[:length] + values[:length]) % np.uint64(prime)
                powers[:length] = p * powers[:length] % np.uint64(prime)
            columns[f"value{k}"], columns[f"power{k}"] = values.astype(np.int64), powers.astype(np.int64)
        if goes_on:
            pos[:length] += carry["pos"]
            cum[:length] += carry["cum"]
        columns |= {"pos": pos, "cum": cum}
        last, carry = int(conv[-1]), {c: int(v[-1]) for c, v in columns.items()}
        given = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", *KEY, "size")]
        made = [pa.array(columns[c], pa.int64()) for c in ("pos", "cum", *PREFIX)]
        marks = [pa.array(np.full(len(conv), part), pa.int32()), pa.array(conv == first_conv)]
        yield pa.RecordBatch.from_arrays([*given, *made, *marks], ["conv_id", *KEY, "size", "pos", "cum", *PREFIX, "part", "in_first"])


def prefix_products(turns: DataFrame) -> DataFrame:
    """conv_id, key0, key1, size, pos (from 1), cum (bytes so far) and the product of all turns so far.

    All turns are sorted into parts by range, so a conversation of any length may spread over many tasks. Turns
    of one number are ordered by role, then by content key. A part's products start anew; the last run
    of each part (a row for each part) is composed on the driver to what the next part's first run carries on.
    """
    spark = turns.sparkSession
    columns = ", ".join(f"{c} long" for c in ("conv_id", *KEY, "size", "pos", "cum", *PREFIX))
    order = ("conv_id", "turn", "role", *KEY)
    dealt = turns.select(*order, "size").repartitionByRange(*order).sortWithinPartitions(*order)
    parts = kept(dealt.mapInArrow(_products_of_a_part, f"{columns}, part int, in_first boolean"), "products")
    place = F.struct("conv_id", "pos")
    ends = parts.groupBy("part").agg(F.min("conv_id").alias("first"), F.max_by(F.struct("conv_id", "pos", "cum", *PREFIX), place).alias("run"))
    carried, before, carries = EMPTY_RUN, None, []
    for row in sorted(ends.collect(), key=lambda r: r.part):
        run = row.run.asDict()
        carried = carried if row.first == before else EMPTY_RUN
        carries.append((row.part, *carried.values()))
        carried = _compose(carried, run) if row.first == run["conv_id"] else run
        before, carried = run["conv_id"], {c: carried[c] for c in EMPTY_RUN}
    names = ", ".join(f"{c}_ long" for c in EMPTY_RUN)
    carry = spark.createDataFrame(carries, f"part int, {names}")
    composed = {"pos": F.col("pos_") + F.col("pos"), "cum": F.col("cum_") + F.col("cum")}
    for k, prime in enumerate(PRIMES):
        composed[f"value{k}"] = (F.col(f"value{k}_") * F.col(f"power{k}") + F.col(f"value{k}")) % prime
        composed[f"power{k}"] = F.col(f"power{k}_") * F.col(f"power{k}") % prime
    whole = [F.when(F.col("in_first"), e).otherwise(F.col(c)).alias(c) for c, e in composed.items()]
    return parts.join(F.broadcast(carry), "part").select("conv_id", *KEY, "size", *whole)


def _node_ids(values: list[Column]) -> list[Column]:
    """The four lanes as two numbers."""
    return [(F.shiftleft(values[2 * k], 31) + values[2 * k + 1]).alias(f"node{k}") for k in range(2)]


def rebuilt(products: DataFrame) -> DataFrame:
    """One row for each conversation: length, total size, and the products of its base's and its own head.

    heads holds the base's first turns (below HEADS of them) as they are taken over.
    """
    early = F.when(F.col("pos") < HEADS, F.struct("pos", "cum", "size", *KEY, *PREFIX))
    convs = products.groupBy("conv_id").agg(F.max("pos").alias("n"), F.max("cum").alias("bytes"), F.sort_array(F.collect_list(early)).alias("early"))
    own = convs.withColumns({"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % GROUP})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("early").alias("theirs"))
    heads = F.slice(F.coalesce("theirs", F.slice("early", 1, 0)), F.lit(1), F.col("h").cast("int"))
    both = own.join(bases, "base", "left").withColumn("heads", heads).withColumn("l", F.size("heads").cast("long"))
    base_head, own_head = F.get("heads", F.col("l").cast("int") - 1), F.get("early", F.least("h", "n").cast("int") - 1)

    def of(head: Column, name: str) -> Column:
        return F.coalesce(head[name], F.lit(0).cast("long"))

    # what a prefix product of the own turns is changed by, before it is multiplied by the power of the turns after the head
    jumps = [((of(base_head, f"value{k}") - of(own_head, f"value{k}") + PRIMES[k]) % PRIMES[k]).alias(f"jump{k}") for k in LANES]
    taken = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return both.select(
        "conv_id",
        "h",
        "l",
        "heads",
        (F.col("l") + taken).alias("n"),
        (of(base_head, "cum") - of(own_head, "cum")).alias("more"),
        (of(base_head, "cum") + F.col("bytes") - of(own_head, "cum")).alias("total"),
        *jumps,
    )


def members(products: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each conversation and node on its path: the node, its parent, its last turn's key and size.

    before: bytes of the turns before the last one; n and total: turns and bytes of the whole conversation.
    """
    zero = F.lit(0).cast("long")
    whole = ("conv_id", "n", "total")
    keys = [F.col(k) for k in KEY]

    def row(depth, node, parent, last, size, before) -> list[Column]:
        parents = [p.alias(f"parent{k}") for k, p in enumerate(parent)]
        return [*map(F.col, whole), depth.alias("depth"), *node, *parents, *(v.alias(k) for k, v in zip(KEY, last)), size.alias("size"), before.alias("before")]

    roots = convs.select(row(zero, _node_ids([zero] * 4), [zero, zero], [zero, zero], zero, zero))
    head = convs.select(*whole, F.posexplode("heads").alias("k", "t"), F.col("heads"))
    value = [F.col(f"t.value{k}") for k in LANES]
    at = F.get("heads", F.col("k") - 1)
    previous = [F.coalesce(at[f"value{k}"], zero) for k in LANES]
    taken = head.select(row(F.col("t.pos"), _node_ids(value), _node_ids(previous), [F.col(f"t.{k}") for k in KEY], F.col("t.size"), F.col("t.cum") - F.col("t.size")))
    inverse = [[pow(pow(BASES[k], h, PRIMES[k]), -1, PRIMES[k]) for h in range(HEADS)] for k in LANES]
    own = products.join(convs.drop("heads"), "conv_id").where("pos > h")
    values, parents = [], []
    for k in LANES:
        prime = PRIMES[k]
        # the power of the turns after the head: the whole power with that of the head taken out
        back = F.element_at(F.array(*[F.lit(v).cast("long") for v in inverse[k]]), (F.col("h") + 1).cast("int"))
        power = F.col(f"power{k}") * back % prime
        now = (F.col(f"value{k}") + F.col(f"jump{k}") * power) % prime
        # the node before: value = parent * base + turn, so the turn is taken off and the base divided out
        half = F.shiftrightunsigned(F.col(KEY[k // 2]), 32 * (k % 2)).bitwiseAND(0x7FFFFFFF)
        turn = half % (prime - 1) + 1
        values.append(now)
        parents.append((now - turn + prime) % prime * pow(BASES[k], -1, prime) % prime)
    depth = F.col("l") + F.col("pos") - F.col("h")
    suffix = own.select(row(depth, _node_ids(values), _node_ids(parents), keys, F.col("size"), F.col("more") + F.col("cum") - F.col("size")))
    return roots.unionByName(taken).unionByName(suffix)


def _end_digests(ends: DataFrame) -> DataFrame:
    """The digest of the ids of conversations that end at each node, ascending and joined by commas.

    Sorting by range spreads a node with many ends over tasks, which join ids to chunks of CHUNK bytes;
    only chunks meet in one task, where the digest runs over them without holding them.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "first", "ids"]
        for batch in batches:
            if not batch.num_rows:
                continue
            node = np.stack([batch.column(k).to_numpy() for k in range(3)])
            ids = pc.cast(batch.column(3), pa.string())
            size = np.cumsum(pc.binary_length(ids).to_numpy() + 1) // CHUNK
            cut = np.append(True, (node[:, 1:] != node[:, :-1]).any(axis=0) | (size[1:] != size[:-1]))
            first = np.flatnonzero(cut)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(ids)), pa.int32()), ids)
            at = pa.array(first)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(4)), pc.binary_join(lists, ",")], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "ends_sha256"]
        now, state = None, None

        def done(nodes: list) -> pa.RecordBatch:
            columns = [pa.array([n[k] for n, _ in nodes], pa.int64()) for k in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([d for _, d in nodes], pa.string())], names)

        for batch in batches:
            finished = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 4)]
            for *node, ids in zip(*columns):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        finished.append((now, state.hexdigest()))
                    now, state = node, sha256()
                state.update(ids.encode("ascii"))
            yield done(finished)
        if now is not None:
            yield done([(now, state.hexdigest())])

    schema = ", ".join(f"{c} long" for c in NODE)
    dealt = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = dealt.select(*NODE, "conv_id").mapInArrow(chunks, f"{schema}, first long, ids string")
    met = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return met.mapInArrow(digests, f"{schema}, ends_sha256 string")


def _trie(conversations: DataFrame, seed: int) -> DataFrame:
    turns = keyed_turns(conversations, seed)
    _check_keys(turns)
    products = kept(prefix_products(turns.drop("text")), "prefixes")
    convs = kept(rebuilt(products), "rebuilt")
    paths = kept(members(products, convs), "paths")
    checked = ("parent0", "parent1", *KEY, "before")
    groups = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("owner"),
        F.max("n").alias("deepest"),
        *(f(c).alias(f"{c}_{f.__name__}") for c in checked for f in (F.min, F.max)),
    )
    groups = kept(groups, "nodes")
    if not groups.where(" OR ".join(f"{c}_min <> {c}_max" for c in checked)).isEmpty():
        raise FingerprintClash
    # A conversation owns the nodes whose smallest member it is: its path from some depth on, so sums over a
    # subtree are sums over the members of its top.
    owned = groups.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("from_depth"), F.min("before_min").alias("own_before"), F.max((F.col("deepest") == F.col("depth")).cast("long")).alias("leaf")
    )
    own_bytes = F.when(F.col("from_depth").isNotNull(), F.col("total") - F.col("own_before")).otherwise(0)
    nodes = (
        paths.join(owned, "conv_id", "left")
        .groupBy(*NODE)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.min_by("n", "conv_id").alias("owner_n"),
            F.min_by("own_before", "conv_id").alias("owner_before"),
            F.min_by("from_depth", "conv_id").alias("owner_from"),
            F.count_if(F.col("from_depth") == F.col("depth") + 1).alias("other_children"),
            F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
            F.sum("total").alias("totals"),
            F.sum(own_bytes).alias("owned_bytes"),
            F.min("before").alias("before"),
            F.min("parent0").alias("parent0"),
            F.min("parent1").alias("parent1"),
        )
    )
    # Only the first node that a conversation owns has a parent of another owner.
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("node0").alias("parent0"), F.col("node1").alias("parent1"), F.col("owner").alias("parent_owner"))
    tops = owned.where("from_depth > 0").join(groups.withColumnsRenamed({"owner": "conv_id", "depth": "from_depth"}), ["conv_id", "from_depth"])
    tops = tops.select(F.col("from_depth").alias("depth"), F.col("parent0_min").alias("parent0"), F.col("parent1_min").alias("parent1"), "node0", "node1")
    tops = tops.join(parents, ["depth", "parent0", "parent1"]).select(*NODE, "parent_owner")
    ends = _end_digests(paths.where("depth = n").select(*NODE, "conv_id"))
    n, before = F.col("n_convs"), F.col("before")
    saved = F.col("totals") - n * before - F.col("owned_bytes") - F.col("owner_before") + before
    return (
        nodes.join(tops, list(NODE), "left")
        .join(ends, list(NODE), "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent_owner", "conv_id")).alias("parent_conv_id"),
            "n_convs",
            (F.col("other_children") + (F.col("owner_n") > F.col("depth")).cast("long")).alias("n_children"),
            "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
            "node0",
            "node1",
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the fingerprint in node0 and node1.

    Null roles and texts count as empty, null turns come first; turns of one number are ordered by role,
    then by content key, so repeated rows stay repeated turns. Rows without conv_id are left out. A
    negative conv_id's base is found by the remainder's sign, as in SQL. An empty table has no nodes.
    Further columns are not read.
    """
    for seed in range(SEEDS):
        try:
            return _trie(conversations, seed)
        except FingerprintClash:
            continue
    raise FingerprintClash(f"fingerprints of {SEEDS} seeds clash")
