"""The trie of conversation prefixes: shared turns, leaves below, and what sharing saves.

A node is a distinct sequence of first turns (role, text); the root is the empty one. It is named by
its depth and a 124-bit sum of the turns' digests at their positions, modulo four primes, so a
conversation of any length is hashed by ranges of turns that are put together afterwards.

1. Turns are sorted by range of (conversation, turn); each range sums up its own rows, and
   conversations that go over a cut carry their sums on. The driver holds one row per cut.
2. Nodes are counted by partial aggregation: members, least member, children.
3. The least member of each leaf brings its path; paths are dealt by range of their first nodes,
   cut every ``SEGMENT`` levels, and each task codes its paths as shards of about ``SHARD_ROWS`` rows:
   balanced parentheses with cumulative arrays. In a shard, findclose delimits a subtree, rank counts
   its leaf pairs, and a difference of two cumulative sums gives its savings. What lies below a cut hangs
   at the last node above it.
4. Nodes that several shards hold (shared spines) are merged by adding up. Every leaf is in one
   shard, and a node's own saving is in one path's shard, so the sums are exact.

No conversation, node or list of members gathers in a task: hot keys are salted, and members that
end at one node are joined to text by ranges; only the digest of this text, which is sequential by
definition, is streamed through one task per node.

Defined results: no turn sorts first; turns of one number stand in the order of the digest of role
and text; a repeated row is a turn each. Null role or text is empty. Rows without a conversation id belong
to no conversation and are left out. Without rows there are no nodes. Other columns have no effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import attach, stored
from orderloom.llm.parentheses import Parentheses

SHARD_ROWS = 250_000
SEGMENT = 65_536
# The most ids in a piece of an id list.
IDS = 50_000
# The most turns that another conversation may lend.
HEAD = 8

# The greatest primes below 2^31, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1597334677, 1204680517, 1852689663, 1046527637)

_SUMS = [f"s{k}" for k in range(4)]
_BACK = [f"r{k}" for k in range(4)]
_KEY = ["depth", "k1", "k2"]


def _powers(k: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base, by doubling."""
    out = np.ones(1, np.uint64)
    p = np.uint64(PRIMES[k])
    while len(out) < n:
        step = np.uint64(pow(BASES[k], len(out), PRIMES[k]))
        out = np.concatenate([out, out * step % p])
    return out[:n]


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns in order, stored: conv, pos (from 1), sums of the turns up to each (s) and before it (r), size."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.unhex(F.md5(body)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    # The last key lets even equal rows be cut into several ranges.
    ranged = rows.repartitionByRange(*keys, F.monotonically_increasing_id()).sortWithinPartitions(*keys)
    numbers = [*_SUMS, *_BACK]
    schema = "part int, conv long, i long, size long, " + ", ".join(f"{c} long" for c in numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, carry = None, 0, [0] * 4
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column(0).to_numpy()
            first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            lengths = np.diff(np.r_[first, n])
            i = np.arange(1, n + 1) - np.repeat(first, lengths)
            on = int(lengths[0]) if conv[0] == last else 0
            i[:on] += count
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").reshape(n, 4)
            out = [pa.array(np.full(n, part, np.int32)), batch.column(0), pa.array(i), batch.column(3)]
            sums, back, ends = [], [], []
            for k in range(4):
                p = np.uint64(PRIMES[k])
                low = int(i.min())
                power = _powers(k, int(i.max()) - low + 1) * np.uint64(pow(BASES[k], low, PRIMES[k])) % p
                term = (x[:, k] % p) * power[i - low] % p
                total = np.cumsum(term)
                start = np.repeat((total - term)[first], lengths)
                s = (total - start) % p
                if on:
                    s[:on] = (s[:on] + np.uint64(carry[k])) % p
                ends.append(int(s[-1]))
                sums.append(pa.array(s.astype(np.int64)))
                back.append(pa.array(((s + p - term) % p).astype(np.int64)))
            last, count, carry = conv[-1], int(i[-1]), ends
            yield pa.RecordBatch.from_arrays([*out, *sums, *back], names=["part", "conv", "i", "size", *numbers])

    local = stored(ranged.mapInArrow(run, schema), "turns")
    return _carried(local)


def _carried(local: DataFrame) -> DataFrame:
    """Positions and sums over the cuts: only conversations in several ranges change."""
    spark = local.sparkSession
    ends = local.groupBy("part", "conv").agg(F.max_by(F.struct("i", *_SUMS), "i").alias("e"))
    cut = ends.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = ends.join(F.broadcast(cut.select("conv")), "conv", "left_semi")
    # One row for each range that a conversation goes on through: bounded by the ranges.
    carried, sums = [], {}
    for part, conv, e in sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[1], r[0])):
        n, at = sums.get(conv, (0, [0] * 4))
        shift = [pow(BASES[k], n, PRIMES[k]) for k in range(4)]
        carried.append((part, conv, n, *at, *shift))
        sums[conv] = (n + e["i"], [(at[k] + shift[k] * e[f"s{k}"]) % PRIMES[k] for k in range(4)])
    names = [*(f"a{k}" for k in range(4)), *(f"m{k}" for k in range(4))]
    schema = "part int, conv long, n long, " + ", ".join(f"{c} long" for c in names)
    both = local.join(F.broadcast(spark.createDataFrame(carried, schema)), ["part", "conv"], "left")

    def whole(c: str, k: int) -> Column:
        moved = (F.col(f"a{k}") + F.col(f"m{k}") * F.col(c)) % PRIMES[k]
        return F.coalesce(moved, F.col(c)).alias(c)

    return both.select(
        "conv", (F.col("i") + F.coalesce("n", F.lit(0))).alias("pos"), "size",
        *[whole(f"s{k}", k) for k in range(4)], *[whole(f"r{k}", k) for k in range(4)],
    )


def _key_of(sums: list) -> list[Column]:
    one = F.shiftleft(sums[0], 31).bitwiseOR(sums[1])
    two = F.shiftleft(sums[2], 31).bitwiseOR(sums[3])
    return [one, two]


def prefixes(turns: DataFrame, lends: Column | None = None, base: Column | None = None) -> DataFrame:
    """A row for each prefix of each conversation, the empty one too, stored.

    Columns: conv, depth, k1, k2 (the node), p1, p2 (its parent), size (bytes of the last text), is_end.
    With ``lends`` and ``base`` (of ``conv``), a conversation is rebuilt: the first ``lends`` turns (at
    most HEAD) are those of conversation ``base``, if there are any; its own first ones go.
    """
    seq = stored(_ordered(turns), "sequence")
    turn = F.struct("pos", *_SUMS, *_BACK, "size")
    convs = seq.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("pos") <= HEAD, turn))).alias("head"),
    )
    if lends is None:
        lends, base = F.lit(0), F.col("conv")
    convs = stored(convs.withColumn("h", lends.cast("int")).withColumn("base", base), "conversations")
    lent = convs.select(F.col("conv").alias("base"), F.col("head").alias("spine"))
    took = F.slice(F.coalesce("spine", F.array().cast(convs.schema["head"].dataType)), 1, F.col("h"))
    both = convs.join(lent, "base", "left").withColumn("spine", took).withColumn("taken", F.size("spine"))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    both = stored(both.withColumn("length", length), "rebuilt")

    zero = F.lit(0).cast("long")
    root = both.select(
        "conv", F.lit(0).alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "size")],
        (F.col("length") == 0).alias("is_end"),
    )
    t = F.col("t")
    here, back = _key_of([t[c] for c in _SUMS]), _key_of([t[c] for c in _BACK])
    spine = both.select("conv", "length", F.explode("spine").alias("t")).select(
        "conv", t["pos"].cast("int").alias("depth"), here[0].alias("k1"), here[1].alias("k2"),
        back[0].alias("p1"), back[1].alias("p2"), t["size"].alias("size"), (t["pos"] == F.col("length")).alias("is_end"),
    )
    # Own turns move down by the turns that are missing in the base: h - taken places.
    own, last = F.get("head", F.col("h") - 1), F.get("spine", F.col("taken") - 1)
    moves = []
    for k in range(4):
        back_by = [pow(BASES[k], -m, PRIMES[k]) for m in range(HEAD + 1)]
        factor = F.element_at(F.array(*[F.lit(b).cast("long") for b in back_by]), F.col("h") - F.col("taken") + 1)
        moves += [
            F.when(F.col("taken") > 0, last[f"s{k}"]).otherwise(zero).alias(f"a{k}"),
            F.when(F.col("h") > 0, own[f"s{k}"]).otherwise(zero).alias(f"o{k}"),
            factor.alias(f"f{k}"),
        ]
    shift = stored(both.filter("n > h").select("conv", "n", "h", "taken", "length", *moves), "shift")
    rows = attach(seq, shift, "conv", "n", seq.count()).filter(F.col("pos") > F.col("h"))

    def moved(c: str, k: int) -> Column:
        p = PRIMES[k]
        return (F.col(f"a{k}") + (F.col(f"{c}{k}") - F.col(f"o{k}") + p) % p * F.col(f"f{k}")) % p

    here, back = _key_of([moved("s", k) for k in range(4)]), _key_of([moved("r", k) for k in range(4)])
    depth = F.col("pos") - F.col("h") + F.col("taken")
    tail = rows.select(
        "conv", depth.cast("int").alias("depth"), here[0].alias("k1"), here[1].alias("k2"),
        back[0].alias("p1"), back[1].alias("p2"), "size", (depth == F.col("length")).alias("is_end"),
    )
    return stored(root.unionByName(spine).unionByName(tail), "prefixes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``prefixes`` of conversations that begin with turns of the one whose id is a multiple of five."""
    lends = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefixes(turns, lends, F.col("conv") - F.col("conv") % 5)


class Shard:
    """Paths of one segment as a forest: parentheses, node names, cumulative weights and ends."""

    COLUMNS = "top int, bits binary, size long, depth binary, k1 binary, k2 binary, weight binary, more binary"

    def __init__(self, row: dict) -> None:
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=row["size"], bitorder="little")
        self.tree = Parentheses(bits)
        self.depth = np.frombuffer(row["depth"], "<i4")
        self.k1, self.k2 = np.frombuffer(row["k1"], "<i8"), np.frombuffer(row["k2"], "<i8")
        self.weight, self.more = np.frombuffer(row["weight"], "<i8"), np.frombuffer(row["more"], "<i8")

    def below(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and weights in the subtree of each node, in preorder."""
        at = self.tree.nodes()
        close = self.tree.findclose(at)
        first = self.tree.preorder(at)
        after = first + (close - at + 1) // 2
        leaves = self.tree.leaf_pairs(at, close) + self.more[after] - self.more[first]
        return leaves, self.weight[after] - self.weight[first]


def pack(top: int, paths: np.ndarray, depth: np.ndarray, k1: np.ndarray, k2: np.ndarray, weight: np.ndarray) -> dict:
    """A shard's row. ``paths`` holds the bounds of the paths; each begins at the segment's top."""
    raw = np.stack([k1, k2], axis=1).astype(">i8").tobytes()
    bounds = list(zip(paths[:-1].tolist(), paths[1:].tolist()))
    bounds.sort(key=lambda b: raw[16 * b[0] : 16 * b[1]])
    bits, opened, number = [], [], np.empty(0, np.int64)
    ids = np.empty(len(depth), np.int64)
    made, before = 0, None
    for a, b in bounds:
        common = 0
        if before is not None:
            n = min(b - a, before[1] - before[0])
            c = before[0]
            differs = (k1[a : a + n] != k1[c : c + n]) | (k2[a : a + n] != k2[c : c + n])
            common = int(differs.argmax()) if differs.any() else n
            bits.append(np.zeros(before[1] - c - common, bool))
        bits.append(np.ones(b - a - common, bool))
        opened.append(np.arange(a + common, b))
        number = np.concatenate([number[:common], np.arange(made, made + b - a - common)])
        ids[a:b] = number
        made += b - a - common
        before = (a, b)
    bits.append(np.zeros(before[1] - before[0], bool))
    rows = np.concatenate(opened)
    total, ends = np.zeros(made + 1, np.int64), np.zeros(made + 1, np.int64)
    np.add.at(total, ids + 1, weight)
    np.add.at(ends, ids[[b - 1 for _, b in bounds]] + 1, 1)
    flat = np.concatenate(bits)
    return {
        "top": top, "bits": np.packbits(flat, bitorder="little").tobytes(), "size": len(flat),
        "depth": depth[rows].astype("<i4").tobytes(), "k1": k1[rows].astype("<i8").tobytes(),
        "k2": k2[rows].astype("<i8").tobytes(), "weight": np.cumsum(total).astype("<i8").tobytes(),
        # Paths that end at one node beyond its first: they go on below a cut.
        "more": np.cumsum(np.maximum(ends - 1, 0)).astype("<i8").tobytes(),
    }


def _shards(paths: DataFrame, shard_rows: int) -> DataFrame:
    """The shards of ``paths`` (conv, seg, depth, k1, k2, weight, top, a, b, c), stored."""
    keys = ["seg", "a", "b", "c", "conv"]
    rows = paths.repartitionByRange(*keys).sortWithinPartitions(*keys, "depth")
    rows = rows.select("seg", "conv", "depth", "k1", "k2", "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def whole(final: bool) -> Iterator[pa.RecordBatch]:
            """Shards of the complete paths that are held; the last one may go on."""
            nonlocal held, size
            if not held:
                return
            table = np.concatenate(held)
            new = np.flatnonzero(np.r_[True, (table[1:, :2] != table[:-1, :2]).any(axis=1)])
            bounds = np.append(new, len(table))
            stop = len(bounds) - 1 if final else len(bounds) - 2
            first = 0
            for i in range(1, stop + 1):
                if i == stop or bounds[i] - bounds[first] >= shard_rows or table[bounds[i], 0] != table[bounds[first], 0]:
                    part = table[bounds[first] : bounds[i]]
                    row = pack(int(part[0, 0]), bounds[first : i + 1] - bounds[first], *(part[:, c] for c in range(2, 6)))
                    yield pa.RecordBatch.from_pylist([row], schema=arrow)
                    first = i
            held = [table[bounds[stop] :]] if stop < len(bounds) - 1 else []
            size = sum(map(len, held))

        for batch in batches:
            held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1))
            size += batch.num_rows
            if size >= shard_rows:
                yield from whole(final=False)
        yield from whole(final=True)

    arrow = pa.schema(
        [("top", pa.int32()), ("bits", pa.binary()), ("size", pa.int64())]
        + [(c, pa.binary()) for c in ("depth", "k1", "k2", "weight", "more")]
    )
    return stored(rows.mapInArrow(run, Shard.COLUMNS), "trie_shards")


def _below(shards: DataFrame) -> DataFrame:
    """Per node, its leaves and savings: what the shards hold of it, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                leaves, saved = shard.below()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (shard.depth, shard.k1, shard.k2, leaves, saved)],
                    names=[*_KEY, "n_leaves", "saved_tokens"],
                )

    rows = shards.mapInArrow(run, "depth int, k1 long, k2 long, n_leaves long, saved_tokens long")
    return rows.groupBy(*_KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _ends(rows: DataFrame) -> DataFrame:
    """Per node at which members end: the SHA-256 of their ids, ascending, joined by commas."""
    ended = rows.filter("is_end").select(*_KEY, "conv")
    keys = [*_KEY, "conv"]
    ranged = ended.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            new = np.r_[True, (table[1:, :3] != table[:-1, :3]).any(axis=1)]
            starts = np.flatnonzero(new)
            starts = np.unique(np.concatenate([starts, np.arange(0, len(table), IDS)]))
            ends = np.append(starts[1:], len(table))
            text = [",".join(map(str, table[a:b, 3].tolist())) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(table[starts, 0].astype(np.int32)), *(pa.array(table[starts, c]) for c in (1, 2, 3)),
                 pa.array(text, pa.string())],
                names=[*keys, "ids"],
            )

    listed = ranged.mapInArrow(pieces, "depth int, k1 long, k2 long, conv long, ids string")
    dealt = listed.repartition(*_KEY).sortWithinPartitions(*keys)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def made(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int32(), pa.int64(), pa.int64(), pa.string()])],
                names=[*_KEY, "ends"],
            )

        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append([*node, state.hexdigest()])
                node, state = key, hashlib.sha256(ids.encode())
            yield made(done)
        if node is not None:
            yield made([[*node, state.hexdigest()]])

    return dealt.mapInArrow(digests, "depth int, k1 long, k2 long, ends string")


def statistics(rows: DataFrame, shard_rows: int = SHARD_ROWS, segment: int = SEGMENT) -> DataFrame:
    """Per node of the trie of ``prefixes``: members, children, leaves, savings and ends.

    Columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes of last texts that sharing saves in the subtree), ends_sha256.
    """
    nodes = rows.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("size").alias("size"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    nodes = stored(nodes, "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.filter("depth > 0").select(*above).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, _KEY, "left").na.fill(0, ["n_children"]), "nodes")

    # Every node lies on the path of the least member of some leaf.
    reps = nodes.filter("n_children = 0").select(F.col("conv_id").alias("conv"), (F.col("depth") + 1).alias("n"))
    reps = stored(reps, "leaves")
    paths = stored(
        attach(rows.select("conv", *_KEY), reps, "conv", "n", rows.count())
        .withColumn("seg", (F.col("depth") / segment).cast("int")),
        "paths",
    )
    saving = nodes.select(*_KEY, ((F.col("n_convs") - 1) * F.col("size")).alias("weight")).filter("weight > 0")
    owner = paths.groupBy(*_KEY).agg(F.min("conv").alias("conv"))
    own = stored(owner.join(saving, _KEY).select("conv", "depth", "weight"), "savings")
    # What is saved below a cut hangs at the path's last node above it.
    low = paths.filter("seg > 0").join(own, ["conv", "depth"], "left").groupBy("conv", "seg")
    from_here = Window.partitionBy("conv").orderBy(F.col("seg").desc())
    low = low.agg(F.sum("weight").alias("w")).withColumn("weight", F.sum("w").over(from_here))
    hung = low.select("conv", (F.col("seg") * segment - 1).alias("depth"), "weight").filter("weight > 0")
    weights = own.unionByName(hung).groupBy("conv", "depth").agg(F.sum("weight").alias("weight"))

    place = F.col("depth") - F.col("seg") * segment
    first = paths.groupBy("conv", "seg").agg(
        *[F.max(F.when(place == at, F.col("k1"))).alias(c) for c, at in (("a", 1), ("b", 2), ("c", 4))]
    )
    weighted = paths.join(weights, ["conv", "depth"], "left").na.fill(0, ["weight"])
    below = _below(_shards(weighted.join(first, ["conv", "seg"]), shard_rows))

    # The parent's least member; a node may have a large share of all nodes as its children.
    node = F.struct(*_KEY)
    above = nodes.filter("n_children > 0").select(node.alias("up"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    up = F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    named = nodes.withColumn("up", F.when(F.col("depth") > 0, up))
    parents = stored(above, "parents")
    found = attach(named.filter("depth > 0"), parents.withColumnRenamed("n_children", "fan"), "up", "fan", nodes.count())
    top = named.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    found = found.unionByName(top.select(found.columns))
    empty = hashlib.sha256(b"").hexdigest()
    return found.join(below, _KEY).join(_ends(rows), _KEY, "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(empty)).alias("ends_sha256"),
    )
