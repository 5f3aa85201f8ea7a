"""Prefix trie of conversations in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns. Its digest is the exclusive or of the
128-bit hashes of its turns, each hashed with its depth, so that the digests of all
prefixes are a running aggregate and a parent's digest is the child's without its
last turn.

1. Turns are hashed and numbered by conversation. Rows are dealt by ranges of
   (conversation, turn), so that a conversation of any length is spread over tasks.
2. Paths are cut into pieces of at most BAND depths; equal pieces are one.
3. Node tables: a task takes sorted pieces until they hold SHARD_ENTRIES entries (a
   shard), enumerates the distinct digests, gives each a slot by a minimal perfect
   hash (``Slots``; a digest must equal the one stored at its slot), scatters what
   the pieces bring to their last nodes into flat arrays, and adds the arrays up
   through the array of parent slots, the deepest first. A node's rows from several
   shards are summed by Spark.
4. Everything is a sum over the conversations of a node, so that no shard has to hold
   a whole subtree. With T the characters of a conversation, O those of the nodes it
   owns (it is their smallest member) and C those above a node, a subtree's
   characters by conversation are sum(T) - n C, and once per node they are
   sum(O) - O(owner) + T(owner) - C. The difference is what sharing saves. Leaves are
   counted by their owners. Step 3 runs once for counts and T, once for O and leaves.

A node may have any number of children and of conversations that end in it: parents
with very many children are broadcast (at most HOT_SHARE of them), and lists of ids
are hashed from pieces of text in order, never collected.

Defined cases: turns without a conversation id belong to none and are left out; a
missing turn number comes first; turns with one number are ordered by their hashes; a
NULL role or text is empty; equal rows are turns of their own; conversations without
turns end in the root; without conversations there is no root; extra columns do not
matter.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.sources.tables import materialize

#: Depths per piece of a path, entries per shard, bytes per piece of an id list.
BAND = 512
SHARD_ENTRIES = 200_000
LIST_BYTES = 1_000_000
ENTRY = ("depth", "d1", "d2", "n_chars", "upto")


# --- minimal perfect hash ----------------------------------------------------


def _mixed(one, two, level):
    """Another 64-bit hash of 128-bit digests for each level."""
    with np.errstate(over="ignore"):
        x = one ^ (two * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(level * 0xD1B54A32D192ED03 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Slots:
    """Slots 0 to n - 1 for n distinct digests (two uint64 arrays).

    On each level the digests that are alone in their position keep it; the others go
    on to the next. A slot is the number of positions kept before.
    """

    def __init__(self, one, two):
        self.levels, left, kept = [], np.arange(len(one)), 0
        while len(left):
            size = np.uint64(2 * len(left))
            at = (_mixed(one[left], two[left], len(self.levels)) % size).astype(np.int64)
            alone = np.bincount(at, minlength=int(size)) == 1
            self.levels.append((size, alone, kept + np.cumsum(alone) - 1))
            kept += int(alone.sum())
            left = left[~alone[at]]
        self.one, self.two = np.empty_like(one), np.empty_like(two)
        slots = self._found(one, two)
        self.one[slots], self.two[slots] = one, two

    def _found(self, one, two):
        slots, left = np.full(len(one), -1, dtype=np.int64), np.arange(len(one))
        for level, (size, alone, slot) in enumerate(self.levels):
            at = (_mixed(one[left], two[left], level) % size).astype(np.int64)
            hit = alone[at]
            slots[left[hit]] = slot[at[hit]]
            left = left[~hit]
        return slots

    def of(self, one, two):
        """Slots of digests that must be in the table."""
        slots = self._found(one, two)
        if (slots < 0).any() or (self.one[slots] != one).any() or (self.two[slots] != two).any():
            raise ValueError("a digest is not the one stored at its slot")
        return slots


def _distinct(one, two):
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.ones(len(one), dtype=bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return one[new], two[new]


# --- one shard -----------------------------------------------------------------


def _shard(pieces):
    """Partial sums of all nodes on the pieces (an Arrow table)."""

    def column(array):
        return array.to_numpy(zero_copy_only=False)

    paths = pieces["path"].combine_chunks()
    entries, ends = paths.flatten(), paths.value_lengths().to_numpy().cumsum() - 1
    depth, one, two, chars, upto = (column(entries.field(k)) for k in range(len(ENTRY)))
    first = np.concatenate([[0], ends[:-1] + 1])
    slots = Slots(*_distinct(one.view(np.uint64), two.view(np.uint64)))
    at = slots.of(one.view(np.uint64), two.view(np.uint64))
    n = len(slots.one)
    # The parent of an entry is the one before it; a piece's first one has its parent
    # in another band.
    before = np.arange(len(at)) - 1
    outside = np.zeros(len(at), dtype=bool)
    outside[first] = True
    parent = np.full(n, -1, dtype=np.int64)
    parent[at] = np.where(outside, -1, at[before])
    above_one, above_two = one[before], two[before]
    above_one[first], above_two[first] = column(pieces["p1"]), column(pieces["p2"])
    # The first entry of each node in slot order describes it.
    shown = np.empty(n, dtype=np.int64)
    shown[at[::-1]] = np.arange(len(at))[::-1]
    sums = [np.zeros(n, dtype=np.int64) for _ in range(2)]
    for total, name in zip(sums, ("s1", "s2"), strict=True):
        np.add.at(total, at[ends], column(pieces[name]))
    # Leads are compared by their rank among the pieces' leads.
    ids, values = column(pieces["lead_id"]), column(pieces["lead_value"])
    ranked = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[ranked] = np.arange(len(ids))
    lead = np.full(n, len(ids), dtype=np.int64)
    np.minimum.at(lead, at[ends], rank)
    level = depth[shown]
    deepest = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[deepest])) + 1
    for nodes in np.split(deepest, cuts):
        nodes = nodes[parent[nodes] >= 0]
        for total in sums:
            np.add.at(total, parent[nodes], total[nodes])
        np.minimum.at(lead, parent[nodes], lead[nodes])
    lead = ranked[lead]
    return {
        "d1": one[shown], "d2": two[shown], "p1": above_one[shown], "p2": above_two[shown],
        "depth": level, "n_chars": chars[shown], "upto": upto[shown],
        "s1": sums[0], "s2": sums[1], "lead_id": ids[lead], "lead_value": values[lead],
    }


def _node_tables(batches):
    import pyarrow

    held, entries = [], 0

    def table():
        sums = _shard(pyarrow.Table.from_batches(held))
        return pyarrow.RecordBatch.from_arrays([pyarrow.array(v) for v in sums.values()], list(sums))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        entries += len(batch.column("path").flatten())
        if entries >= SHARD_ENTRIES:
            yield table()
            held, entries = [], 0
    if held:
        yield table()


NODE = ("d1", "d2", "p1", "p2", "depth", "n_chars", "upto")


def _accumulated(paths, weights, label):
    """Per node: sums s1 and s2 over its conversations, and the value of the one with
    the smallest id. ``weights`` has these by the last digest of a piece."""
    by = ["band", F.get("path", F.lit(0))["d1"], F.get("path", F.lit(1))["d1"], "e1", "e2"]
    dealt = paths.join(weights, ["e1", "e2"]).repartitionByRange(*by).sortWithinPartitions(*by)
    partial = dealt.select("path", "p1", "p2", "s1", "s2", "lead_id", "lead_value").mapInArrow(
        _node_tables,
        ", ".join(f"{c} bigint" for c in (*NODE, "s1", "s2", "lead_id", "lead_value")),
    )
    same = F.struct("p1", "p2", "depth", "n_chars", "upto")
    merged = partial.groupBy("d1", "d2").agg(
        F.min(same).alias("same"), F.max(same).alias("other"), F.sum("s1").alias("s1"),
        F.sum("s2").alias("s2"), F.min(F.struct("lead_id", "lead_value")).alias("lead"),
    )
    checked = F.when(F.col("same") == F.col("other"), F.col("same")).otherwise(
        F.raise_error(F.lit("two nodes share a digest"))
    )
    return materialize(
        merged.withColumn("same", checked).select("d1", "d2", "same.*", "s1", "s2", "lead.*"), label
    )


# --- turns to digests ----------------------------------------------------------


def digested(turns):
    """conv_id, turn, hash (t1, t2) and n_chars of every turn of a conversation."""
    turns = common.with_columns(
        turns, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    )
    said = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), "turn", F.xxhash64(*said).alias("t1"),
        F.xxhash64(F.lit(29), *said).alias("t2"), F.length(said[1]).cast("long").alias("n_chars"),
    )


def numbered(turns):
    """Written turns with their number (from 1) in the conversation, and _range: the
    range of (conversation, turn) that they were dealt to."""
    order = ["turn", "t1", "t2"]
    ranged = turns.repartitionByRange("conv_id", *order, F.rand(7))
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "trie-turns")
    counts = ranged.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_size"))
    inside = Window.partitionBy("conv_id", "_range").orderBy(*order)
    out = ranged.withColumn("number", F.row_number().over(inside).cast("long"))
    # A range has at most two conversations that go on in another one.
    starts = _earlier(counts.join(_spread(ranged), "conv_id"), {"_before": F.sum("_size")})
    out = out.join(F.broadcast(starts), ["conv_id", "_range"], "left")
    out = out.withColumn("number", F.col("number") + F.coalesce("_before", F.lit(0))).drop("_before")
    return materialize(out, "trie-numbered")


def _spread(ranged):
    """Conversations in more than one range: fewer than there are ranges."""
    ends = ranged.groupBy("conv_id").agg(F.min("_range").alias("_low"), F.max("_range").alias("_high"))
    return F.broadcast(ends.filter("_low < _high").select("conv_id"))


def _earlier(parts, totals):
    """What the ranges before add up to, per conversation and range."""
    window = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("conv_id", "_range", *[t.over(window).alias(name) for name, t in totals.items()])


def prefixes(turns):
    """conv_id, depth, digest, parent's digest, n_chars and upto (characters so far) of
    every prefix of one turn or more."""
    rows = numbered(turns)
    tagged = rows.select(
        "conv_id", "_range", F.col("number").alias("depth"), "n_chars",
        F.xxhash64("number", "t1").alias("x1"), F.xxhash64(F.lit(31), "number", "t2").alias("x2"),
    )
    running = (
        Window.partitionBy("conv_id", "_range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    )
    parts = tagged.join(_spread(rows), "conv_id").groupBy("conv_id", "_range").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("n_chars").alias("n_chars")
    )
    starts = _earlier(
        parts, {"_b1": F.bit_xor("x1"), "_b2": F.bit_xor("x2"), "_bn": F.sum("n_chars")}
    )
    out = tagged.withColumns(
        {
            "d1": F.bit_xor("x1").over(running), "d2": F.bit_xor("x2").over(running),
            "upto": F.sum("n_chars").over(running),
        }
    ).join(F.broadcast(starts), ["conv_id", "_range"], "left")
    zero = F.lit(0).cast("long")
    out = out.withColumns(
        {
            "d1": F.col("d1").bitwiseXOR(F.coalesce("_b1", zero)),
            "d2": F.col("d2").bitwiseXOR(F.coalesce("_b2", zero)),
            "upto": F.col("upto") + F.coalesce("_bn", zero),
        }
    )
    return out.select(
        "conv_id", "depth", "d1", "d2", "n_chars", "upto",
        F.col("d1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("x2")).alias("p2"),
    )


# --- lists of ids --------------------------------------------------------------


def _lists(batches):
    """Sorted (e1, e2, conv_id) as pieces of the comma-joined lists, in order."""
    held, owner, size, first = [], None, 0, None

    def piece():
        text = ",".join(map(str, held))
        return pa.RecordBatch.from_pydict(
            {"e1": [owner[0]], "e2": [owner[1]], "first": [first], "ids": [text]},
            pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]),
        )

    for batch in batches:
        for e1, e2, conv in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if held and ((e1, e2) != owner or size >= LIST_BYTES):
                yield piece()
                held, size = [], 0
            if not held:
                owner, first = (e1, e2), conv
            held.append(conv)
            size += 8
    if held:
        yield piece()


def _hashed(batches):
    """Sorted (e1, e2, first, ids) as the SHA-256 of each list."""
    owner, digest = None, None
    kind = pa.schema([("e1", pa.int64()), ("e2", pa.int64()), ("ends_sha256", pa.string())])

    def row():
        return pa.RecordBatch.from_pydict(
            {"e1": [owner[0]], "e2": [owner[1]], "ends_sha256": [digest.hexdigest()]}, kind
        )

    for batch in batches:
        for e1, e2, ids in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "ids")), strict=True):
            if (e1, e2) == owner:
                digest.update(b",")
            else:
                if owner:
                    yield row()
                owner, digest = (e1, e2), hashlib.sha256()
            digest.update(ids.encode())
    if owner:
        yield row()


def ends_digest(ends):
    """SHA-256 of the ascending, comma-joined conversation ids of each node of ``ends``
    (e1, e2, conv_id). The lists are put together in pieces where the ids are dealt by
    ranges; one task reads the pieces of a list one after the other."""
    order = ["e1", "e2", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _lists, "e1 bigint, e2 bigint, first bigint, ids string"
    )
    return pieces.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first").mapInArrow(
        _hashed, "e1 bigint, e2 bigint, ends_sha256 string"
    )


# --- the trie --------------------------------------------------------------------


def nodes(turns, ids):
    """The nodes of hashed turns (``digested``): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. ``ids`` has every conversation
    (conv_id), also those without turns."""
    rows = materialize(prefixes(turns), "trie-prefixes")
    ids = ids.filter("conv_id is not null").select(F.col("conv_id").cast("bigint")).distinct()
    last = F.max_by(F.struct("d1", "d2"), "depth")
    convs = ids.join(
        rows.groupBy("conv_id").agg(last.alias("end"), F.sum("n_chars").alias("total")), "conv_id", "left"
    )
    zero = F.lit(0).cast("long")
    convs = materialize(
        convs.select(
            "conv_id", F.coalesce("end.d1", zero).alias("e1"), F.coalesce("end.d2", zero).alias("e2"),
            F.coalesce("total", zero).alias("total"),
        ),
        "trie-conversations",
    )
    band = F.call_function("div", F.col("depth") - 1, F.lit(BAND)).alias("band")
    pieces = rows.groupBy("conv_id", band).agg(
        F.array_sort(F.collect_list(F.struct(*ENTRY))).alias("path"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("entry"),
    )
    tip = F.element_at("path", -1)
    pieces = materialize(
        pieces.select(
            "conv_id", "band", "entry.p1", "entry.p2", tip["d1"].alias("e1"), tip["d2"].alias("e2"), "path"
        ),
        "trie-pieces",
    )
    members = pieces.select("conv_id", "e1", "e2")
    paths = materialize(
        pieces.groupBy("e1", "e2").agg(*[F.first(c).alias(c) for c in ("band", "p1", "p2", "path")]),
        "trie-paths",
    )

    def weights(values, s1, s2):
        """What the conversations (conv_id and value columns) bring to their pieces."""
        return members.join(values, "conv_id").groupBy("e1", "e2").agg(
            F.sum(s1).alias("s1"), F.sum(s2).alias("s2"),
            F.min(F.struct(F.col("conv_id"), F.col(s2))).alias("lead"),
        ).select("e1", "e2", "s1", "s2", F.col("lead.conv_id").alias("lead_id"), F.col(f"lead.{s2}").alias("lead_value"))

    counted = convs.select("conv_id", F.lit(1).cast("long").alias("one"), "total")
    found = _accumulated(paths, weights(counted, "one", "total"), "trie-counts").toDF(
        *NODE, "n_convs", "totals", "conv_id", "own_total"
    )
    children = found.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    found = materialize(
        found.join(children, ["d1", "d2"], "left").withColumn("n_children", F.coalesce("n_children", zero)),
        "trie-nodes",
    )
    owned = found.groupBy("conv_id").agg(
        F.sum("n_chars").alias("owned"), F.count_if(F.col("n_children") == 0).alias("leaf")
    )
    owned = convs.select("conv_id").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("owned", zero).alias("owned")
    )
    shared = _accumulated(paths, weights(owned, "leaf", "owned"), "trie-owned").select(
        "d1", "d2", F.col("s1").alias("n_leaves"), F.col("s2").alias("owned"), F.col("lead_value").alias("own_owned")
    )
    above = F.col("upto") - F.col("n_chars")
    spoken = F.col("totals") - F.col("n_convs") * above
    kept = F.col("owned") - F.col("own_owned") + F.col("own_total") - above
    full = found.join(shared, ["d1", "d2"]).withColumn("saved_tokens", spoken - kept)
    columns = ["d1", "d2", "p1", "p2", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    full = full.select(*columns).unionByName(_root(convs, found))
    # Parents by their digest; how many rows ask for one is its number of children.
    parents = found.select("d1", "d2", "conv_id", "n_children").unionByName(
        _root(convs, found).select("d1", "d2", "conv_id", "n_children")
    )
    parents = parents.filter("n_children > 0").toDF("p1", "p2", "parent_conv_id", "_children")
    full = materialize(full, "trie-full")
    placed = common.lookup(full, parents, ["p1", "p2"], "_children", found.count())
    ends = ends_digest(convs.select("e1", "e2", "conv_id")).toDF("d1", "d2", "ends_sha256")
    return placed.join(ends, ["d1", "d2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _root(convs, found):
    """The root's row, if there are conversations; it has no parent."""
    below = found.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"),
        F.count_if(F.col("n_children") == 0).alias("n_leaves"),
        F.sum((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    members = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    # One row each.
    return members.filter("n_convs > 0").join(F.broadcast(below), F.lit(True)).select(
        zero.alias("d1"), zero.alias("d2"), none.alias("p1"), none.alias("p2"), "conv_id",
        zero.alias("depth"), "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
    )


def trie(turns):
    """The nodes of a table of turns (conv_id, turn, role, text)."""
    return nodes(digested(turns), common.with_columns(turns, {"conv_id": "bigint"}).select("conv_id"))
