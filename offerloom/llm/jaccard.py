"""Exact n-gram Jaccard join by parity sketches, as connected groups of near-duplicate documents.

A document is its set of distinct word shingles. Documents with equal sets are one node. The sketch of a set has
m parts of 2**32 bits each; every shingle flips one bit of one part, and a part is kept as the XOR of its set
bits' codes. The sets differ in at least as many shingles as their sketches differ in bits, hence in at least as
many as there are differing parts. Sets of sizes a and b with Jaccard similarity 0.8 or more differ in at most
(a + b) / 9 shingles, so by the pigeonhole principle two such sketches agree in all but that many parts, and
any order of the parts that holds for all documents alike makes them share one of their first floor((a + b) / 9) + 1.
Sketches are compared per size band: m follows the band's power of two, and a document near its band's lower end
also enters the band below. Parts found often while counting over all documents come last in the order (it changes the
work, never the result), so that common passages don't make large groups of unlike documents.

Candidates: trees of linked nodes grow in rounds. In each, every tree tries one pair: the nodes that share most parts among those
that pair it with the least tree it shares a part with. So a large group of near copies is joined at a cost linear in its
size. Then pairs of nodes that share a part and are still in different trees are tried: where a part has few nodes, at once. The
nodes of larger parts are a family of texts that are nearly, but not quite, alike; what they have in common says nothing, so
their shingles are counted over all these nodes and put in order, rare ones first. Sets of a and b shingles that link have
4 (a + b) / 9 or more in common, so they share one of the first that lie before the last 4 (a + b) / 9 - 1 of each; a text has
its own edits there, not the family's common stock. Within one shingle's nodes, only those outside its most frequent tree look for
partners. Sizes and the Hamming distance of dense sketches rule out most pairs first; verification compares whole shingle
sets. No link between different sets is lost, so the components are exact.

Defined results: a null or empty text has no shingles and links with nothing, not even with another empty
one; fewer words than a shingle make one shingle of all; repeated rows and ids each count as a row, and the component is
the least id among all linked rows; an empty table gives no rows; columns other than id and text are ignored. Shingles are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.components import connected_components
from .common import bitmap_bits, bitmap_filter, bounded, carried, collect_bitmap, materialize, mix64, restored, table

WORDS = 5
#: Parts counted this often within one task are reported as frequent; at most so many of them are broadcast.
OFTEN, FREQUENT = 4, 1 << 18
#: Rounds in which trees of linked nodes grow by one pair each, before all pairs between different trees are tried.
ROUNDS = 3
#: Members that one task compares with a leader, about.
MEMBERS = 2000
#: Nodes of a part that are compared pair by pair; larger parts go by their nodes' rare shingles.
SMALL = 8
#: Nodes of a tree that others try before pairs are made.
LEADERS = 3
#: Groups that hold more than this share of the rows get their result by a broadcast: there are at most as many.
HEAVY = 1024
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FLUSH = 1 << 21


#: Bytes hashed at once; a longer text is read in parts cut between words.
PART = 1 << 17
#: A-Z become small, white space a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of folded texts, and the number of words of each text."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    inside = data != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.zeros(len(data), np.int32)
    first[starts] = starts
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(first)
    place[~inside] = 0
    weights = mix64(np.arange(1, int(place.max()) + 2, dtype=np.uint64) * _FACTOR) | np.uint64(1)
    values = (data.astype(np.uint64) + np.uint64(1)) * weights[place]
    values[~inside] = 0
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64) + 1)
    return mix64(np.add.reduceat(values, starts)), np.diff(np.searchsorted(starts, ends, side="right"), prepend=0)


def _sets(codes: np.ndarray, counts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    runs = codes[: max(0, len(codes) - size + 1)].copy()
    for k in range(1, size):
        runs = runs * _FACTOR + codes[k : k + len(runs)]
    runs = mix64(runs + np.uint64(size))
    at = 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(runs[at : at + n - size + 1])
        elif n:
            whole = np.uint64(0)
            for code in codes[at : at + n]:
                whole = np.uint64((int(whole) * int(_FACTOR) + int(code)) & 0xFFFFFFFFFFFFFFFF)
            yield mix64(np.array([whole], np.uint64) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
        at += n


def shingle_sets(raws: list[bytes | None], size: int = WORDS) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its runs of ``size`` words; of all its words, if they are fewer."""
    held, total = [], 0
    for raw in raws:
        raw = (raw or b"").translate(_FOLD)
        if held and total + len(raw) > PART:
            yield from _sets(*_codes(held), size)
            held, total = [], 0
        if len(raw) <= 2 * PART:
            held.append(raw)
            total += len(raw)
            continue
        parts, at = [], 0
        while at < len(raw):
            end = raw.find(b" ", at + PART)
            end = len(raw) if end < 0 else end
            parts.append(_codes([raw[at:end]])[0])
            at = end
        codes = np.concatenate(parts)
        yield from _sets(codes, np.array([len(codes)]), size)
    if held:
        yield from _sets(*_codes(held), size)


def text_key(raw: bytes | None) -> int:
    return _signed(xxhash.xxh3_64_intdigest(raw or b""))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(shingles: np.ndarray) -> int:
    """The node number of a set: 64 bits, the same for any order."""
    total = int(np.sum(mix64(shingles ^ np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64))
    return _signed(xxhash.xxh3_64_intdigest(total.to_bytes(8, "little") + len(shingles).to_bytes(8, "little")))


def dense_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits, as 64-bit words: a power of two of them, at least twice as many bits as shingles and 512. Sketches of sets whose
    sizes are near differ in length by a factor of two at most; XOR of its halves folds the longer one."""
    bits = max(512, 2 << (len(shingles) - 1).bit_length()) if len(shingles) else 512
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def allowed(a: int, b: int) -> int:
    """Most shingles by which sets of these sizes may differ at a similarity of 0.8: 9 |A & B| >= 4 (a + b)."""
    return (a + b) // 9


def bands(n: int) -> list[tuple[int, int]]:
    """(band, number of parts to index) for a set of ``n``: its own band, and the one below if partners can be there."""
    own = n.bit_length() - 1
    out = [(own, allowed(n, n * 5 // 4) + 1)]
    below = (1 << own) - 1
    if own and 5 * below >= 4 * n:
        out.append((own - 1, allowed(n, below) + 1))
    return [(band, count) for band, count in out if count > 1]  # 1: only equal sets, which are one node


def parts_of(shingles: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the parts that hold shingles, how many, and keys of the parts that hold none, of the sketch for ``band``."""
    m = max(16, 1 << band)
    place = (shingles >> np.uint64(65 - m.bit_length())).astype(np.int64)  # the top bits: sorted like the shingles
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    words = np.bitwise_xor.reduceat(mix64(shingles & np.uint64(0xFFFFFFFF)), starts)
    names = mix64(np.arange(m, dtype=np.uint64) + np.uint64(band << 40))
    held = place[starts]
    free = np.ones(m, bool)
    free[held] = False
    return mix64(words + names[held]), np.diff(np.append(starts, len(shingles))), mix64(names[free])


def frequent_parts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, their counts, and flags by the keys' low bits."""
    order = np.argsort(keys)
    flags = np.zeros(1 << 22, bool)
    flags[(keys & np.uint64(len(flags) - 1)).astype(np.int64)] = True
    return keys[order], counts[order], flags


def indexed_parts(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The first parts in the common order: rare ones first, of those the fullest (chance or a common passage seldom fills
    a part with the same few shingles), parts without shingles last."""
    keys, counts, flags = frequent
    out = []
    for band, take in bands(len(shingles)):
        held, sizes, free = parts_of(shingles, band)
        weight = np.zeros(len(held), np.int64)
        if len(keys):
            maybe = np.flatnonzero(flags[(held & np.uint64(len(flags) - 1)).astype(np.int64)])  # spares most searches
            at = np.minimum(np.searchsorted(keys, held[maybe]), len(keys) - 1)
            weight[maybe] = np.where(keys[at] == held[maybe], counts[at], 0)
        out.append(held[np.lexsort((held, -sizes, weight))[:take]])
        if len(held) < take:
            out.append(np.sort(free)[: take - len(held)])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


def _first_scan(size: int):
    """Per document (id, n, node, sketch, text key), the last two only where its set is new to the task; and (part, n) for
    parts that are frequent in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, total, kind = set(), [], 0, None
        names = ["id", "n", "node", "sketch", "key", "part"]

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            keys, counts = keys[counts >= OFTEN], counts[counts >= OFTEN]
            none = lambda t: pa.nulls(len(keys), t)
            return pa.RecordBatch.from_arrays([none(kind), pa.array(counts, pa.int64()), none(pa.int64()), none(pa.list_(pa.int64())), none(pa.int64()), pa.array(keys.view(np.int64))], names)

        for batch in batches:
            kind = batch.column(0).type
            counts, nodes, sketches, keys = [], [], [], []
            raws = _texts(batch)
            for raw, shingles in zip(raws, shingle_sets(raws, size)):
                node = fingerprint(shingles) if len(shingles) else None
                new = node is not None and node not in seen
                counts.append(len(shingles))
                nodes.append(node)
                sketches.append(dense_sketch(shingles) if new else None)
                keys.append(text_key(raw) if new else None)
                if new:
                    seen.add(node)
                    for band, _ in bands(len(shingles)):
                        held.append(parts_of(shingles, band)[0])
                        total += len(held[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(keys, pa.int64()), pa.nulls(len(counts), pa.int64())], names
            )
            if total > _FLUSH:
                yield flush()
                held, total = [], 0
        if held:
            yield flush()

    return run


def _part_scan(shared, size: int):
    """(part, node) for the indexed parts; copies within a task are sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, frequent, parts, nodes, total = set(), frequent_parts(*shared.value), [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.concatenate(nodes))], ["part", "node"])

        for batch in batches:
            for shingles in shingle_sets(_texts(batch), size):
                if len(shingles) and (node := fingerprint(shingles)) not in seen:
                    seen.add(node)
                    parts.append(indexed_parts(shingles, frequent))
                    nodes.append(np.full(len(parts[-1]), node, np.int64))
                    total += len(parts[-1])
                if total > _FLUSH >> 3:
                    yield flush()
                    parts, nodes, total = [], [], 0
        if parts:
            yield flush()

    return run


def _set_scan(shared, size: int):
    """(key, shingles) of the texts whose key is in a bitmap; copies within a task are sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        seen: set[int] = set()
        for batch in batches:
            wanted: dict[int, bytes] = {}
            for raw in _texts(batch):
                key = text_key(raw)
                at = key & (bits - 1)
                if bitmap[at >> 3] >> (at & 7) & 1 and key not in seen:
                    seen.add(key)
                    wanted[key] = raw
            sets = [found.view(np.int64) for found in shingle_sets(list(wanted.values()), size)]
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by leader and share, the leader's own set first: one set is held while the others pass."""
    key, first, last = None, None, None
    for batch in batches:
        leaders, members = [], []
        columns = [batch.column(k).to_pylist() for k in range(4)]
        sets = batch.column(4)
        for k, (leader, share, member, node) in enumerate(zip(*columns)):
            if (leader, share) != key:
                key, first, last = (leader, share), None, None
            if not member:
                first = sets[k].values.to_numpy() if first is None else first
            elif first is not None and node != last:
                last = node
                other = sets[k].values.to_numpy()
                common = len(np.intersect1d(first, other, assume_unique=True))
                if 9 * common >= 4 * (len(first) + len(other)):
                    leaders.append(leader)
                    members.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(leaders, pa.int64()), pa.array(members, pa.int64())], ["leader", "node"])


def _distance(a: str, b: str) -> Column:
    """Hamming distance of two dense sketches, of equal lengths once the longer one is folded."""
    fold = lambda x, y: f"CASE WHEN size({x}) > size({y}) THEN zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p ^ q) ELSE {x} END"
    return F.expr(f"aggregate(zip_with({fold(a, b)}, {fold(b, a)}, (p, q) -> cast(bit_count(p ^ q) AS long)), 0L, (s, x) -> s + x)")


def _possible(sizes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (leader, node) whose sizes and sketches don't rule out the similarity. Both are cheap and lose no pair."""
    side = lambda name: sizes.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))
    rows = pairs.join(side("leader"), "leader").join(side("node"), "node")
    rows = rows.filter("5 * leader_n >= 4 * node_n AND 5 * node_n >= 4 * leader_n")
    return rows.filter(9 * _distance("leader_sketch", "node_sketch") <= F.col("leader_n") + F.col("node_n")).select(*pairs.columns)


def _sets_of(texts: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, shingles) for the texts with these keys, and a few by chance; the texts are read again."""
    bits = bitmap_bits(keys.count())
    shared = texts.sparkSession.sparkContext.broadcast((collect_bitmap(keys.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("place")), bits), bits))
    return texts.mapInArrow(bounded(_set_scan(shared, size), 0), "key long, shingles array<long>")


def _verify(texts: DataFrame, sizes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs (leader, node) whose sets are similar enough. One text of each node is read again. A leader with many
    members is copied to several shares of them, so that no task gets all of a large group."""
    per = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("shares"))
    members = pairs.join(per, "leader").select("leader", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int").alias("share"), F.lit(True).alias("member"), "node")
    leaders = per.select("leader", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(False).alias("member"), F.col("leader").alias("node"))
    wanted = materialize(members.unionByName(leaders).join(sizes.select("node", "key"), "node"), "wanted")
    sets = _sets_of(texts, wanted.select("key").distinct(), size)
    rows = wanted.join(sets, "key").select("leader", "share", "member", "node", "shingles")
    rows = rows.repartition("leader", "share").sortWithinPartitions("leader", "share", "member", "node")
    return rows.mapInArrow(_compare, "leader long, node long")


def _few(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(leader, node, root_a, root_b) for the nodes that share one of ``parts`` and are in different trees."""
    rows = parts.join(sizes.select("node", "n", "sketch"), "node")
    a, b = (rows.select(F.col("part").alias(f"part_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "n", "sketch"))) for k in "ab")
    near = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & (5 * F.col("n_a") >= 4 * F.col("n_b")) & (5 * F.col("n_b") >= 4 * F.col("n_a"))
    near &= 9 * _distance("sketch_a", "sketch_b") <= F.col("n_a") + F.col("n_b")
    return a.join(b, (F.col("part_a") == F.col("part_b")) & near).select(F.col("node_a").alias("leader"), F.col("node_b").alias("node"), "root_a", "root_b").distinct()


def _trees(rows: DataFrame, tree: str) -> DataFrame:
    """``rows`` (of shingles) whose shingle is in several trees, with the ``main`` one: that with most of its nodes."""
    counts = rows.groupBy("shingle", tree).agg(F.count(F.lit(1)).alias("nodes"))
    counts = counts.groupBy("shingle").agg(F.max(F.struct("nodes", tree)).alias("most"), F.count(F.lit(1)).alias("trees"))
    return rows.join(counts.filter("trees > 1").select("shingle", F.col(f"most.{tree}").alias("main")), "shingle")


def _family(texts: DataFrame, nodes: DataFrame, sizes: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """For ``nodes`` (node, root): links found (root_a, root_b), and the pairs (leader, node, root_a, root_b) still to verify.

    First, nodes outside a shingle's main tree try that tree's leaders, its nodes with the fewest shingles of their own: the
    nearest to what the family has in common. That links most that can be linked, at a cost linear in the nodes. Pairs are made
    for the others, where they share a rare enough shingle."""
    wanted = materialize(nodes.join(sizes.select("node", "n", "key"), "node"), "family")
    sets = _sets_of(texts, wanted.select("key").distinct(), size).groupBy("key").agg(F.any_value("shingles").alias("shingles"))
    shingles = materialize(wanted.join(sets, "key").select("node", "root", "n", F.explode("shingles").alias("shingle")), "family_shingles")
    counts = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    ranked = shingles.join(counts, "shingle", "left")
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("nodes", F.lit(1)), "shingle")))
    ranked = ranked.withColumn("own", F.count(F.expr("CASE WHEN nodes IS NULL THEN 1 END")).over(Window.partitionBy("node")))
    first = ranked.filter("nodes > 1 AND place <= floor(n / 5) + 1").select("shingle", "node", "root", "n", "place", "own")  # the most for any partner's size
    first = materialize(first, "family_prefixes")

    order = Window.partitionBy("root").orderBy("own", "node")
    leaders = first.select("root", "node", "own").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= LEADERS)
    tries = _trees(first, "root").filter("root <> main").select("node", "root", "main").distinct()
    tries = tries.join(leaders.select(F.col("root").alias("main"), F.col("node").alias("leader")), "main")
    tries = materialize(_possible(sizes, tries.select("leader", "node", "root", "main")), "tries")
    links = materialize(_verify(texts, sizes, tries.select("leader", "node"), size).join(tries, ["leader", "node"]).select(F.col("root").alias("root_a"), F.col("main").alias("root_b")).distinct(), "links")

    trees = connected_components(links, "root_a", "root_b").select(F.col("node").alias("root"), F.col("component").alias("tree"))
    rows = _trees(first.join(trees, "root", "left").withColumn("tree", F.coalesce("tree", "root")), "tree")
    a, b = (rows.select(F.col("shingle").alias(f"shingle_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in ("node", "root", "tree", "n", "place", "main"))) for k in "ab")
    near = F.expr("tree_a <> tree_b AND (tree_b = main_b OR node_a < node_b) AND 5 * n_a >= 4 * n_b AND 5 * n_b >= 4 * n_a")
    near &= F.expr("4 * (n_a + n_b) <= 9 * (n_a - place_a + 1) AND 4 * (n_a + n_b) <= 9 * (n_b - place_b + 1)")
    pairs = a.filter("tree_a <> main_a").join(b, (F.col("shingle_a") == F.col("shingle_b")) & near).select(F.col("node_a").alias("leader"), F.col("node_b").alias("node"), "root_a", "root_b").distinct()
    pairs = _possible(sizes, pairs).select(
        F.least("leader", "node").alias("leader"), F.greatest("leader", "node").alias("node"),
        F.when(F.col("leader") < F.col("node"), F.col("root_a")).otherwise(F.col("root_b")).alias("root_a"), F.when(F.col("leader") < F.col("node"), F.col("root_b")).otherwise(F.col("root_a")).alias("root_b"),
    )
    return links, pairs


def _roots(parents: DataFrame) -> DataFrame:
    """Node and root for a forest of (node, leader) edges, by pointer jumping."""
    current = parents.select("node", F.col("leader").alias("root"))
    while True:
        up = current.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = materialize(current.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        current = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return current


def _told(rows: DataFrame, key: str, heads: DataFrame) -> DataFrame:
    """``rows`` with the ``head`` of their key (null without one). ``heads``: key, n (how many rows have it), head. The keys that have
    more than a HEAVY-th of the rows, so fewer than that many, are broadcast; a key's rows meet in a task only for the others."""
    heads = materialize(heads, "heads")
    most = (heads.agg(F.sum("n")).first()[0] or 0) // HEAVY + 1
    named = rows.join(F.broadcast(heads.filter(F.col("n") > most).select(key, F.col("head").alias("heavy"))), key, "left")
    found = named.filter("heavy IS NOT NULL").withColumn("head", F.col("heavy"))
    rest = named.filter(F.col("heavy").isNull() & F.col(key).isNotNull()).join(heads.filter(F.col("n") <= most).select(key, "head"), key, "left")
    none = named.filter(F.col(key).isNull()).withColumn("head", F.col("heavy"))
    return found.unionByName(rest).unionByName(none).drop("heavy")


def similar_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """Per document: id, n_shingles, component_id (least id of its group)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.select("text")
    schema = T.StructType([rows.schema["id"], *T.DataType.fromDDL("n long, node long, sketch array<long>, key long, part long").fields])
    scanned = materialize(rows.mapInArrow(bounded(_first_scan(size), 1), schema), "documents")
    about = scanned.filter(F.col("part").isNull())
    often = scanned.filter(F.col("part").isNotNull()).groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(FREQUENT).toPandas()
    shared = spark.sparkContext.broadcast((often["part"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)))

    parts = texts.mapInArrow(bounded(_part_scan(shared, size), 0), "part long, node long")
    group = Window.partitionBy("part")
    parts = parts.withColumns({"leader": F.min("node").over(group), "last": F.max("node").over(group)})
    parts = materialize(parts.filter("leader <> last").select("part", "node").distinct(), "shared_parts")
    paired = parts.select("node").distinct()
    sizes = about.filter(F.col("key").isNotNull()).join(paired, "node").groupBy("node").agg(F.min(F.struct("key", "n", "sketch")).alias("text")).select("node", "text.*")
    sizes = materialize(sizes, "sizes")

    label = tested = None
    rooted = lambda: (
        parts.withColumn("root", F.col("node")) if label is None else parts.join(label, "node", "left").select("part", "node", F.coalesce("component", "node").alias("root"))
    )
    for _ in range(ROUNDS):
        # each tree tries one pair with the least tree that it shares a part with: linear in the rows, whatever a group's size
        placed = rooted().withColumns({"head": F.min(F.struct("root", "node")).over(group), "most": F.max("root").over(group)}).filter("head.root <> root AND head.root <> most")
        votes = placed.groupBy(F.col("head.node").alias("leader"), "node").agg(F.count(F.lit(1)).alias("votes"), F.min("root").alias("root"), F.min("head.root").alias("top"))
        votes = votes if tested is None else votes.join(tested.select("leader", "node"), ["leader", "node"], "left_anti")
        best = _possible(sizes, votes).groupBy("root").agg(F.max(F.struct("votes", (-F.col("leader")).alias("leader"), "node", "top")).alias("best"))
        now = materialize(best.select("root", (-F.col("best.leader")).alias("leader"), "best.node", "best.top"), "stars")
        if now.isEmpty():
            break
        links = materialize(_verify(texts, sizes, now.select("leader", "node"), size).join(now, ["leader", "node"]).select("root", "top"), "links")
        if links.isEmpty():
            break
        tested = now if tested is None else tested.unionByName(now)
        up = _roots(links.select(F.col("root").alias("node"), F.col("top").alias("leader"))).withColumnRenamed("root", "component")
        if label is None:
            label = up
        else:
            moved = label.join(up.select(F.col("node").alias("component"), F.col("component").alias("joint")), "component", "left")
            grown = moved.select("node", F.coalesce("joint", "component").alias("component")).unionByName(up.join(label, "node", "left_anti"))
            label = materialize(grown, "labels")

    placed = rooted().withColumns({"least": F.min("root").over(group), "most": F.max("root").over(group), "nodes": F.count(F.lit(1)).over(group)})
    placed = materialize(placed.filter("least <> most").select("part", "node", "root", "nodes"), "open_parts")
    cross, found = _few(placed.filter(F.col("nodes") <= SMALL), sizes), None
    family = placed.filter(F.col("nodes") > SMALL).select("node", "root").distinct()
    if not family.isEmpty():
        found, pairs = _family(texts, family, sizes, size)
        cross = cross.unionByName(pairs).distinct()
    cross = cross if tested is None else cross.join(tested.select(F.least("leader", "node").alias("leader"), F.greatest("leader", "node").alias("node")), ["leader", "node"], "left_anti")
    cross = materialize(cross, "cross_pairs")
    if not cross.isEmpty():
        links = _verify(texts, sizes, cross.select("leader", "node"), size).join(cross, ["leader", "node"]).select("root_a", "root_b")
        found = links if found is None else found.unionByName(links)
    if found is not None:
        up = connected_components(found, "root_a", "root_b").select("node", F.col("component").alias("joint"))
        if label is None:
            label = up.withColumnRenamed("joint", "component")
        else:
            moved = label.join(up.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("joint", "component").alias("component"))
            label = moved.unionByName(up.withColumnRenamed("joint", "component").join(label, "node", "left_anti"))
        label = materialize(label, "labels")
    label = parts.select("node", F.col("node").alias("component")).limit(0) if label is None else label
    # copies count by node first, then by component; a tree's root is a member too
    label = label.unionByName(label.select(F.col("component").alias("node"), "component")).distinct()
    nodes = about.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(nodes.join(label, "node", "left").filter("component IS NOT NULL OR n > 1"), "nodes")
    groups = nodes.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n"))
    heads = _told(nodes.withColumnRenamed("n", "rows"), "component", groups).select("node", F.col("rows").alias("n"), F.coalesce("head", "id").alias("head"))
    out = _told(about.select("id", F.col("n").alias("n_shingles"), "node"), "node", heads)
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("head", "id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """One document of each group, that with the least id; all columns as they were. Ids are integers.

    Rows that share an id count as one document: of those in line to stay, one stays. Rows without an id can't
    be told apart and stay. Only rows whose id is marked in a bitmap of bounded size (those to go, and
    a few by chance) are shuffled to meet the exact list; all others pass in place."""
    spark = docs.sparkSession
    groups = materialize(similar_groups(docs, id_col=id_col, text_col=text_col, size=size).select(F.col(id_col).alias("id"), "component_id"), "groups")
    per_id = groups.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("head"))
    listed = materialize(per_id.filter("n > 1 OR id <> head").select("id", (F.col("id") == F.col("head")).alias("stays")), "listed")
    bits = bitmap_bits(listed.count(), most=1 << 27)
    shared = spark.sparkContext.broadcast((collect_bitmap(listed.select(F.col("id").cast("long").bitwiseAND(F.lit(bits - 1)).alias("place")), bits), bits))
    rows = carried(docs, text_col).withColumn("id", F.col(f"doc.`{id_col}`"))
    plain = rows.mapInArrow(bounded(bitmap_filter(shared, "id", False), 1), rows.schema).select("doc", "text")
    marked = rows.mapInArrow(bounded(bitmap_filter(shared, "id", True), 1), rows.schema).join(listed, "id", "left")
    chance = marked.filter(F.col("stays").isNull()).select("doc", "text")
    repeated = marked.filter("stays").groupBy("id").agg(F.min_by(F.struct("doc", "text"), F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))).alias("row"))
    return restored(plain.unionByName(chance).unionByName(repeated.select("row.*")), docs.columns, text_col)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return similar_groups(table(spark, sf_dir, "documents"))
