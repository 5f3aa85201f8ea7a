"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

Texts are lower-cased (A-Z), cut into words and taken as sets of five-word
shingles; a text of fewer words is one shingle. Two texts are linked when the
Jaccard similarity of their sets is at least the threshold.

1. Signatures, one pass over the texts: TREES labels of DEPTH MinHash values each. The
   labels of a tree, as bytes, are a prefix trie: texts that agree in their first k
   values meet in a node of depth k.
2. Texts meet at their deepest common prefix first. Level by level the prefix is
   shortened, until the recall at the threshold, 1 - (1 - threshold ** k) ** TREES,
   reaches the target (at the defaults from eight values to five). On each level only
   nodes are opened whose members are not in one group yet; nodes with the same members
   in several trees are one.
3. In an open node, members whose signatures agree clearly less often than the
   threshold asks for are told apart (the slack makes a loss less likely than 1e-8),
   and the rest joined to loose groups by connected components of the groups so far.
4. Each text of a loose group is sent to it once. All pairs are verified exactly
   inside the task, from shingle sets; rows leave it per text, never per pair. A
   group over BLOCK texts is verified block against block.

Equal texts are one text throughout and count by their number. No step keeps a
group in one task or on the driver; every table that is read twice is written.

Defined cases: texts without words (NULL, empty, punctuation) are alike only when
they are equal and not NULL; a NULL text is a class of its own; equal rows count
as copies; an empty table gives no rows; extra columns are kept by
``one_per_group``; class ids are the smallest doc_id, NULL if all are NULL.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from gridledger.llm import common
from gridledger.llm.common import joined_sets, slices, sorted_groups
from gridledger.sources.tables import materialize

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
TARGET_RECALL = 0.9999
#: Least share of agreeing MinHash values for a candidate pair, below the
#: threshold by more than five standard deviations of the estimate.
SLACK = 0.2
#: Members of a node or loose group that are compared in one unit.
NODE_BLOCK = 4096
BLOCK = 512

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Shingles hashed at a time.
_CHUNK_BYTES = 1_000_000


def recall(length, threshold=THRESHOLD, trees=TREES):
    """Chance that texts of that similarity share a prefix of so many values in a tree."""
    return 1 - (1 - threshold**length) ** trees


def levels(threshold=THRESHOLD, trees=TREES, depth=DEPTH, target=TARGET_RECALL):
    """Prefix lengths from the deepest to the first that reaches the target recall."""
    found = []
    for length in range(depth, 0, -1):
        found.append(length)
        if recall(length, threshold, trees) >= target:
            return found
    raise ValueError("too few trees for the target recall")


# --- shingles ---------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _mixed(x):
    """Final mixing of 64-bit values, so that all bits depend on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data):
    """Start offsets and 64-bit hashes of the words in UTF-8 bytes."""
    word = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    letters = _LOWER[data].astype(np.uint64) + np.uint64(1)
    letters[~word] = 0
    # Horner's scheme over all words at once, letter by letter of the longest word
    # for short words; the rest of longer words goes on with those words alone.
    hashes = np.zeros(len(starts), np.uint64)
    at, active = starts.copy(), np.arange(len(starts))
    while len(active):
        hashes[active] = hashes[active] * _BASE + letters[at[active]]
        at[active] += 1
        active = active[at[active] < ends[active]]
    return starts, _mixed(hashes + (ends - starts).astype(np.uint64))


def _chunks(texts):
    """(first, last) of consecutive texts of about _CHUNK_BYTES."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= _CHUNK_BYTES:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def shingles(texts, size=SHINGLE):
    """For a list of UTF-8 texts: owner index and hash of every shingle (with
    repeats), owners ascending."""
    joined = b"\x00".join(texts) + b"\x00"
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts, words = _word_hashes(data)
    owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    n = len(words)
    # Shingles that start at each word, where the text has so many words left.
    left = (first + count)[owner] - np.arange(n) if n else np.empty(0, np.int64)
    whole = left >= size
    out = np.zeros(n, np.uint64)
    for k in range(size):
        ahead = np.minimum(np.arange(n) + k, n - 1)
        out = out * _BASE + words[ahead]
    short = np.flatnonzero((count > 0) & (count < size))
    owners, hashes = owner[whole], _mixed(out[whole])
    if len(short):
        extra = count[short].astype(np.uint64)
        for k in range(size - 1):
            has = count[short] > k
            extra[has] = _mixed(extra[has] * _BASE + words[first[short[has]] + k])
        owners = np.concatenate([owners, short])
        hashes = np.concatenate([hashes, extra])
        order = np.argsort(owners, kind="stable")
        owners, hashes = owners[order], hashes[order]
    return owners, hashes


def shingle_sets(texts, size=SHINGLE):
    """Sorted arrays of distinct shingle hashes."""
    out = []
    for first, last in _chunks(texts):
        part = texts[first:last]
        owners, hashes = shingles(part, size)
        bounds = np.searchsorted(owners, np.arange(len(part) + 1))
        out += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


# --- signatures -------------------------------------------------------------


def _seeds(count):
    rng = np.random.Generator(np.random.PCG64(20))
    odd = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 2**32, count, dtype=np.uint32)


def signatures(texts, values, size=SHINGLE):
    """(has words, MinHash values): one row of 32-bit values per text."""
    odd, add = _seeds(values)
    out = np.zeros((len(texts), values), np.uint32)
    worded = np.zeros(len(texts), bool)
    for first, last in _chunks(texts):
        owners, hashes = shingles(texts[first:last], size)
        if not len(owners):
            continue
        have, at = np.unique(owners, return_index=True)
        low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32), (
            hashes >> np.uint64(32)
        ).astype(np.uint32)
        worded[first + have] = True
        for k in range(values):
            # Two 32-bit halves, so that each function sees all 64 bits.
            scrambled = (low * odd[k] + add[k]) ^ (high * odd[values - 1 - k])
            scrambled *= np.uint32(0x85EBCA6B)
            out[first + have, k] = np.minimum.reduceat(scrambled, at)
    return worded, out


#: Bytes that a label keeps of a value.
_VALUE_BYTES = 2


def _sign_batches(trees, depth):
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("signature", pa.binary())])

    def sign(batches):
        for batch in slices(batches):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            worded, values = signatures(texts, trees * depth)
            labels = (values & np.uint32(0xFFFF)).astype(">u2")
            keep = np.flatnonzero(worded)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)),
                    pa.array([labels[i].tobytes() for i in keep], pa.binary()),
                ],
                schema=kinds,
            )

    return sign


def _node(tree, depth, length):
    """64-bit id of a tree's node at the prefix length."""
    prefix = F.substring("signature", tree * depth * _VALUE_BYTES + 1, length * _VALUE_BYTES)
    return F.xxhash64(F.lit(tree), prefix)


# --- candidates -------------------------------------------------------------


def _loose_links(least):
    """Per node: links between the groups of members that are joined over pairs whose
    signatures agree in at least ``least`` values."""

    def link(batches):
        for _, group in sorted_groups(batches, "_unit"):
            keys, roots = group["text_key"].to_numpy(), group["root"].to_numpy()
            labels = np.frombuffer(b"".join(group["signature"]), np.uint8).reshape(len(keys), -1)
            marks = labels[:, 1::_VALUE_BYTES]
            lead_of = np.full(len(keys), -1)
            rest = np.argsort(keys, kind="stable")
            while len(rest):
                # The next member's whole component, by breadth-first search.
                lead, front, rest = rest[0], [rest[0]], rest[1:]
                lead_of[lead] = lead
                while front and len(rest):
                    agree = (marks[rest] == marks[front.pop()]).sum(axis=1) >= least
                    found = rest[agree]
                    lead_of[found] = lead
                    front.extend(found.tolist())
                    rest = rest[~agree]
            linked = np.flatnonzero(roots != roots[lead_of])
            if len(linked):
                pairs = pd.DataFrame({"a": roots[linked], "b": roots[lead_of[linked]]})
                yield pairs.drop_duplicates()

    return link


def _opened(signed, groups, trees, depth, length):
    """Members (node, text_key, root, signature) of the nodes at a prefix length whose
    members are in different groups."""
    nodes = F.array(*[_node(tree, depth, length) for tree in range(trees)])
    placed = signed if groups is None else signed.join(groups, "text_key", "left")
    root = F.col("text_key") if groups is None else F.coalesce("root", "text_key")
    placed = materialize(placed.select("text_key", root.alias("root"), nodes.alias("nodes")), "near-placed")
    visits = placed.select("text_key", "root", F.explode("nodes").alias("node"))
    # Nodes with the same members are kept once: members are compared by their number
    # and two independent 64-bit sums.
    counted = visits.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64(F.lit(1), "text_key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(2), "text_key")).alias("y"),
    )
    different = counted.filter("low < high").groupBy("n", "x", "y").agg(F.min("node").alias("node"))
    different = materialize(different.select("node", "n", F.lit(True).alias("open")), "near-nodes")
    # A node may hold a third of all texts.
    total = different.agg(F.sum("n")).first()[0] or 0
    met = common.lookup(visits, different, ["node"], "n", total).filter("open")
    return met.select("node", "text_key", "root"), total


def loose_groups(signed, trees=TREES, depth=DEPTH, threshold=THRESHOLD, slack=SLACK, target=TARGET_RECALL):
    """text_key -> root of its group, for texts that may have a link."""
    least = int(np.ceil((threshold - slack) * trees * depth))
    groups = None
    for length in levels(threshold, trees, depth, target):
        met, total = _opened(signed, groups, trees, depth, length)
        if not total:
            continue
        members = materialize(met.join(signed, "text_key"), "near-members")
        units = common.blocked(members, "node", "text_key", NODE_BLOCK)
        links = (
            units.select("_unit", "text_key", "root", "signature")
            .repartition("_unit")
            .sortWithinPartitions("_unit")
            .mapInPandas(_loose_links(least), "a bigint, b bigint")
        )
        joined = materialize(common.components(links, "near-loose"), "near-joined").toDF("old", "new")
        rows = joined.count()
        if not rows:
            continue
        # Groups that were joined to others, and texts that were alone before.
        texts = joined.select(F.col("old").alias("text_key"), F.col("new").alias("root"))
        texts = texts.unionByName(joined.select(F.col("new").alias("text_key"), F.col("new").alias("root")).distinct())
        if groups is not None:
            moved = groups.join(common.by_size(joined, rows), groups["root"] == joined["old"], "left").select(
                "text_key", F.coalesce("new", "root").alias("root")
            )
            texts = moved.unionByName(texts.join(groups.select("text_key"), "text_key", "left_anti"))
        groups = materialize(texts, "near-groups")
    if groups is None:
        return signed.select("text_key", F.col("text_key").alias("root")).filter(F.lit(False))
    return groups


# --- verification -----------------------------------------------------------


def _similar_pairs(sets, threshold):
    """Index pairs i < j with Jaccard similarity of at least the threshold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        common_part = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        union = sizes.sum() - common_part
        near = common_part >= threshold * union - 1e-9
        return (np.array([0]), np.array([1])) if near else (np.empty(0, int),) * 2
    owner = np.repeat(np.arange(n), sizes)
    values, number, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = count > 1
    column = np.cumsum(shared) - 1
    keep = shared[number]
    owner, number = owner[keep], column[number[keep]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    width = max(256, 4_000_000 // n)
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(number, (start, start + width))
        hits = np.zeros((n, width), np.float32)
        hits[owner[a:b], number[a:b] - start] = 1
        both += hits @ hits.T
    union = sizes[:, None] + sizes[None, :] - both
    near = both >= threshold * union - 1e-6
    return np.nonzero(np.triu(near, 1))


def _verify(threshold):
    """Per unit: each text's links inside it (to texts and, by their copies, to
    documents) and the smallest text it is joined with."""

    def verify(batches):
        out = []
        for _, group in sorted_groups(batches, "_unit"):
            keys, copies = group["text_key"].to_numpy(), group["copies"].to_numpy()
            one, two = group["_left"].to_numpy(), group["_right"].to_numpy()
            a, b = _similar_pairs(shingle_sets([t.encode() for t in group["text"]]), threshold)
            if not one.all() or not two.all():  # two blocks: links inside one are its own unit's
                across = (one[a] & two[b]) | (two[a] & one[b])
                a, b = a[across], b[across]
            n = len(keys)
            order = np.argsort(keys, kind="stable")
            place = np.empty(n, int)
            place[order] = np.arange(n)
            root = order[joined_sets(n, place[a], place[b])][place]
            links = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            docs = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
            out.append(
                pd.DataFrame(
                    {"text_key": keys, "root": keys[root], "texts": links, "docs": docs.astype(np.int64)}
                )[links > 0]
            )
            if len(out) >= 500:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    return verify


def _numbered(docs):
    """(keyed, rows, texts): docs with their row_key and text_hash; the rows with the
    number of their text (text_key); per text its number, hash and copies. Numbers are
    exact: two texts only share one if 128 bits agree."""
    keyed = docs.select(
        common.row_key(docs).alias("row_key"), common.text_key().alias("text_hash"), "doc_id", "text"
    ).filter("text is not null")
    hashed = materialize(keyed.drop("text"), "near-hashed")
    texts = hashed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies"))
    texts = materialize(
        texts.select(F.monotonically_increasing_id().alias("text_key"), "text_hash", "copies"), "near-texts"
    )
    asked = texts.select("text_hash", "text_key", F.col("copies").alias("_copies"))
    rows = common.lookup(hashed, asked, ["text_hash"], "_copies", hashed.count())
    return keyed, materialize(rows.drop("text_hash"), "near-rows"), texts


def verified(docs, threshold=THRESHOLD, trees=TREES, depth=DEPTH):
    """(rows, links): row_key, text_key, doc_id of every row with a text, and per
    linked text its class root and its numbers of linked texts and documents."""
    common.bound_batches(docs.sparkSession)
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    keyed, rows, named = _numbered(docs)
    signed = keyed.select("text_hash.a", "text_hash.b", "text").mapInArrow(
        _sign_batches(trees, depth), "a bigint, b bigint, signature binary"
    )
    signed = signed.dropDuplicates(["a", "b"]).withColumn("text_hash", F.struct("a", "b"))
    signed = materialize(signed.join(named, "text_hash").select("text_key", "signature"), "near-signed")
    groups = loose_groups(signed, trees, depth, threshold)
    members = materialize(groups.join(named, "text_key"), "near-counted")
    texts = (
        keyed.select("text_hash", "text")
        .join(common.by_size(members, members.count()), "text_hash")
        .dropDuplicates(["text_key"])
    )
    units = common.blocked(members, "root", "text_key", BLOCK)
    pairs = units.select("text_key", "_unit", "_left", "_right").join(
        texts.select("text_key", "text", "copies"), "text_key"
    )
    found = materialize(
        pairs.repartition("_unit")
        .sortWithinPartitions("_unit")
        .mapInPandas(_verify(threshold), "text_key bigint, root bigint, texts bigint, docs bigint"),
        "near-found",
    )
    # Units of one group only meet where it was cut into blocks.
    roots = common.components(
        found.select(F.col("text_key").alias("a"), F.col("root").alias("b")), "near-classes"
    )
    links = found.groupBy("text_key").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    links = links.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left").select(
        "text_key", F.coalesce("root", "text_key").alias("root"), "texts", "docs"
    )
    return rows, materialize(links, "near-links")


def classes(docs, threshold=THRESHOLD, trees=TREES):
    """Per document: class_id (smallest doc_id of the documents it is joined with,
    over links), text_id (smallest doc_id with an equal text), n_links (other
    documents it is linked with) and n_text_links (other texts)."""
    rows, links = verified(docs, threshold, trees)
    per_text = rows.groupBy("text_key").agg(
        F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies")
    )
    per_text = per_text.join(links, "text_key", "left").withColumn(
        "root", F.coalesce("root", "text_key")
    )
    per_class = per_text.groupBy("root").agg(F.min("text_id").alias("class_id"))
    per_text = per_text.join(per_class, "root").select(
        "text_key", "class_id", "text_id",
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"),
    )
    with_text = rows.join(per_text, "text_key").select(
        "doc_id", "class_id", "text_id", "n_links", "n_text_links"
    )
    docs = common.with_columns(docs, {"doc_id": "bigint", "text": "string"})
    none = F.lit(0).cast("bigint")
    without = docs.filter("text is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"),
        none.alias("n_links"), none.alias("n_text_links"),
    )
    return with_text.unionByName(without)


def one_per_group(docs, threshold=THRESHOLD, trees=TREES):
    """The rows of docs with the smallest doc_id of their class (one where several
    have it), and rows without a text; columns as in docs."""
    rows, links = verified(docs, threshold, trees)
    grouped = rows.join(links.select("text_key", "root"), "text_key", "left").withColumn(
        "root", F.coalesce("root", "text_key")
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    first = grouped.groupBy("root").agg(F.min(order).alias("first"))
    stays = materialize(first.select("first.row_key"), "near-stays")
    copies = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    dropped = copies.join(stays, "row_key", "left_anti").select("row_key")
    again = copies.filter("n > 1").join(stays, "row_key", "left_semi").select("row_key")
    again = materialize(again, "near-again")
    out = common.keep_rows(docs, materialize(dropped, "near-dropped"), "left_anti")
    if again.isEmpty():
        return out
    # Equal rows of which one stays.
    key = common.fresh(docs, "row_key")
    copies = common.keep_rows(docs, again, "left_semi").withColumn(key, common.row_key(docs))
    return common.keep_rows(out, again, "left_anti").unionByName(
        copies.dropDuplicates([key]).drop(key)
    )
