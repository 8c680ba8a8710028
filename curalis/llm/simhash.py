"""SimHash near-duplicates by anchor-point covering.

Fingerprints are SimHashes of word shingles (A-Z lower-cased; a text of fewer words is one shingle; a text
without words has fingerprint 0).  Documents link at ``threshold`` or fewer differing bits.  Equal
fingerprints are one class, whose representative is the least id; components of links are groups.

Covering: the fingerprint is cut into blocks (a few bits may be left over).  Anchors of a block are the words
whose first 2**order - 1 bits are a code word of that Hamming code and whose ``free`` other bits are
arbitrary; their covering radius is 1, and every value is within 1 of just one anchor with its own free
bits, its home.  Each fingerprint is replicated to all anchors within radius + 1 = 2 of each block, so it
meets whatever differs from it by at most 1 bit in that block at the other's home.  Compared per anchor,
home against visitors, on all bits; only links are emitted, and within an anchor no pair of members that
are known to be connected is compared again.

Two settings: ``CONTRACT``, 64 bits of 3-word shingles, threshold 2, two blocks of 31 bits: of at most 3
differing bits one block holds at most 1, so no link is lost.  ``SIMILAR``, for a Jaccard similarity of 0.8 of
5-word shingles: 128 bits in seven blocks of 18 bits.  Pairs within the expected distance of a similarity of
0.93 (``sure``) are links; those up to two standard deviations beyond the expected distance of 0.8 are links if the
Jaccard similarity of their sets of shingles is 0.8 or more.  What sure links connect is one group here: of the pairs between
two groups the closest is verified, in each
anchor those that a spanning forest by distance needs.  Where such a pair fails, all other candidates of the groups that stay apart
are verified too.  Distance and blocks find a pair with a probability that grows with its
similarity (the README has measured recall).  A block of w bits leaves about 2**(w - order) anchors; ``free`` should grow with the logarithm of the number of
documents, at the price of recall.

Null and empty texts have fingerprint 0 and are linked like any other.  Rows with a null id get a
fingerprint and no component.  Repeated rows share a class; rows with one id and different texts have
fingerprints and components of their own.  Ties: the least id, then the least hash of the text stands for a
component.  Texts of any length are read whole.  An empty table gives an empty result.  Added columns
replace their namesakes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curalis.llm import _arrow as A
from curalis.llm._store import materialise, partitions
from curalis.llm.components import components

SEED = 42


@dataclass(frozen=True)
class Setting:
    """Words of a shingle, bits of a fingerprint, most differing bits of a link, and the anchors' code."""

    shingle: int
    bits: int
    threshold: int
    order: int
    free: int
    #: Most differing bits of a link that needs no verification (None: all links), and the least similarity of the others.
    sure: int | None = None
    similarity: float = 0.8

    @property
    def width(self) -> int:
        return (1 << self.order) - 1 + self.free

    @property
    def blocks(self) -> int:
        return self.bits // self.width


def distance(similarity: float, bits: int, deviations: float = 0) -> int:
    """Differing bits of the SimHashes of two sets of one size with this Jaccard similarity: the expected number,
    and some standard deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


CONTRACT = Setting(shingle=3, bits=64, threshold=2, order=5, free=0)
SIMILAR = Setting(shingle=5, bits=128, threshold=distance(0.8, 128, 2), order=4, free=3, sure=distance(0.93, 128))
#: Members of an anchor compared at a time, and members from which on a large group in it is looked for first.
BLOCK, LARGE = 256, 1_024
#: Places of a sketch of a text's shingles.
SKETCH = 1_024


def shingle_hashes(data, offsets, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle of some texts, and where those of each text begin and end."""
    low = A.LOWER[data]
    starts, ends = A.spans_of(A.NOT_SPACE[low], offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # One space between words: bytes of words, and one byte before each word but the first of a document.
    first = np.searchsorted(starts, offsets)
    length = ends - starts
    to = np.cumsum(length + 1) - 1  # end of each word in the joined bytes
    at = to - length
    joined = np.full(int(to[-1]), 32, np.uint8)
    inside = np.repeat(at - starts, length) + np.flatnonzero(A.NOT_SPACE[low])
    joined[inside] = low[A.NOT_SPACE[low]]
    raw = joined.tobytes()
    counts = np.diff(first)
    last = np.minimum(np.arange(len(starts)) + size, np.repeat(first[1:], counts)) - 1
    keep = (np.arange(len(starts)) + size <= np.repeat(first[1:], counts)) | ((np.arange(len(starts)) == np.repeat(first[:-1], counts)) & (np.repeat(counts, counts) < size))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(at[keep].tolist(), to[last[keep]].tolist(), strict=True)], np.uint64)
    return h, np.r_[0, np.cumsum(np.maximum(counts - size + 1, np.minimum(counts, 1)))]


def fingerprints(data, offsets, setting: Setting = CONTRACT) -> np.ndarray:
    """Fingerprints as rows of 64-bit words, the lowest bits first."""
    words = setting.bits // 64
    out = np.zeros((len(offsets) - 1, words), np.uint64)
    h, bounds = shingle_hashes(data, offsets, setting.shingle)
    n = np.diff(bounds)
    for k in range(words):  # a word at a time: 64 bytes of memory for each shingle
        bits = np.unpackbits((A.mix(h + A.U64(k)) if k else h).view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
        for lo in range(0, len(out), 256):
            docs = np.arange(lo, min(lo + 256, len(out)))
            docs = docs[n[docs] > 0]
            if len(docs):
                ones = np.add.reduceat(bits[: bounds[docs[-1] + 1]], bounds[docs], axis=0, dtype=np.int32)
                out[docs, k] = np.packbits(2 * ones > n[docs][:, None], axis=1, bitorder="little").view(np.uint64).reshape(len(docs))
    return out


def _binary(fp: np.ndarray) -> pa.Array:
    """Fingerprints as bytes, the highest first."""
    size = fp.shape[1] * 8
    data = np.ascontiguousarray(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, size)[:, ::-1])
    return pa.Array.from_buffers(pa.binary(), len(fp), [None, pa.py_buffer(np.arange(len(fp) + 1, dtype=np.int32) * size), pa.py_buffer(data)])


def _matrix(column: pa.Array, words: int) -> np.ndarray:
    size = words * 8
    column = column.cast(pa.large_binary())
    offsets, data = column.buffers()[1:]
    first = int(np.frombuffer(offsets, np.int64)[column.offset]) if len(column) else 0
    raw = np.frombuffer(data, np.uint8)[first : first + len(column) * size] if data is not None else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, size)[:, ::-1]).view(np.uint64)


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None, setting: Setting = CONTRACT) -> DataFrame:
    """``keep`` columns (default: all) with ``fp``, the fingerprint's bytes."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "fp"]
    return A.arrow_map(docs, lambda d, o, v: [_binary(fingerprints(d, o, setting))], text, keep, [T.StructField("fp", T.BinaryType())])


def _syndrome(x: np.ndarray, order: int) -> np.ndarray:
    """Of words of 2**order - 1 bits: the exclusive or of the places (from 1) of the set bits."""
    out = np.zeros(len(x), np.int64)
    for k in range((1 << order) - 1):
        out ^= np.where(x >> k & 1 == 1, k + 1, 0)
    return out


def flips(order: int, free: int) -> list[np.ndarray]:
    """By syndrome, the masks of at most 2 bits that lead to anchors; the first leads to the home."""
    n = (1 << order) - 1
    spare = [1 << (n + j) for j in range(free)]
    out = []
    for s in range(n + 1):
        home = 1 << (s - 1) if s else 0
        found = [home, *(home | x for x in spare)]
        if s:
            found += [1 << (a - 1) | 1 << ((a ^ s) - 1) for a in range(1, n + 1) if a < a ^ s]
        else:
            found += [x | y for i, x in enumerate(spare) for y in spare[:i]]
        out.append(np.array(found, np.int64))
    return out


def anchors(fp: np.ndarray, setting: Setting = CONTRACT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each replica, its anchor (block << 32 | word) and whether it is at home there."""
    table = flips(setting.order, setting.free)
    bits = np.unpackbits(fp.view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
    place = np.int64(1) << np.arange(setting.width, dtype=np.int64)
    rows, keys, home = [], [], []
    for block in range(setting.blocks):
        x = bits[:, block * setting.width : (block + 1) * setting.width].astype(np.int64) @ place
        syndrome = _syndrome(x & ((1 << ((1 << setting.order) - 1)) - 1), setting.order)
        for s in np.unique(syndrome):
            own = np.flatnonzero(syndrome == s)
            to = x[own][:, None] ^ table[s][None, :]
            rows.append(np.repeat(own, len(table[s])))
            keys.append((block << 32 | to).ravel())
            at_home = np.zeros(to.shape, bool)
            at_home[:, 0] = True
            home.append(at_home.ravel())
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, keys, home))


def _distances(fp: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    differ = np.zeros((len(some), len(others)), np.uint16)
    for k in range(fp.shape[1]):
        differ += np.bitwise_count(fp[some, k][:, None] ^ fp[others, k][None, :])
    return differ


def _near(fp: np.ndarray, some: np.ndarray, others: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.nonzero(_distances(fp, some, others) <= threshold)
    return some[i], others[j]


def _links(fp: np.ndarray, home: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked members of one anchor (home against all), enough of them to connect them alike."""
    n = len(fp)
    hosts, everyone = np.flatnonzero(home), np.arange(n)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    group = everyone.copy()  # a member's group: members of one group are connected by links already
    if n > LARGE:
        # Copies of one document crowd an anchor: what links to a home member directly is its group.
        for _ in range(64):
            alone = hosts[group[hosts] == hosts]
            if not len(alone):
                break
            u, v = _near(fp, alone[:1], everyone[group == everyone], threshold)
            group[v] = alone[0]
            group[alone[0]] = -1 - alone[0]  # done: no longer alone
            us.append(u)
            vs.append(v)
        group = np.where(group < 0, -1 - group, group)
    sizes = np.bincount(group, minlength=n)
    large = np.flatnonzero(sizes > BLOCK)
    for g in large:  # members of a large group are compared with the rest only
        own, rest = hosts[group[hosts] == g], everyone[group != g]
        for lo in range(0, len(own), BLOCK):
            u, v = _near(fp, own[lo : lo + BLOCK], rest, threshold)
            us.append(u)
            vs.append(v)
    few = hosts[sizes[group[hosts]] <= BLOCK]
    for lo in range(0, len(few), BLOCK):
        u, v = _near(fp, few[lo : lo + BLOCK], everyone, threshold)
        us.append(u)
        vs.append(v)
    return np.concatenate(us), np.concatenate(vs)


def _undecided(fp: np.ndarray, home: np.ndarray, group: np.ndarray, setting: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of members of one anchor (home against all) in different groups whose distance makes them candidates, and
    the distance: of each two groups the closest pair, and of these the least ones that connect all groups that they connect
    (a spanning forest), so that a crowd has no more candidates than groups."""
    hosts, n = np.flatnonzero(home), len(fp)
    key, rank = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for lo in range(0, len(hosts), BLOCK):
        some = hosts[lo : lo + BLOCK]
        differ = _distances(fp, some, np.arange(n))
        i, v = np.nonzero((differ <= setting.threshold) & (group[some][:, None] != group[None, :]))
        if len(i):
            u, d = some[i], differ[i, v].astype(np.int64)
            key = np.concatenate([key, np.minimum(group[u], group[v]) * n + np.maximum(group[u], group[v])])
            rank = np.concatenate([rank, (d * n + np.minimum(u, v)) * n + np.maximum(u, v)])
            order = np.lexsort((rank, key))
            key, rank = key[order], rank[order]
            first = np.r_[True, key[1:] != key[:-1]]
            key, rank = key[first], rank[first]
    kept = _spanning(key // n, key % n, rank, n)
    return rank[kept] // n % n, rank[kept] % n, rank[kept] // n // n


def _spanning(a: np.ndarray, b: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Which edges make the minimum spanning forest, by Boruvka's rounds; no two ranks are equal."""
    part, chosen = np.arange(n), np.zeros(len(a), bool)
    while True:
        x, y = part[a], part[b]
        open_ = x != y
        if not open_.any():
            return chosen
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, x[open_], rank[open_])
        np.minimum.at(best, y[open_], rank[open_])
        now = open_ & ((rank == best[x]) | (rank == best[y]))
        chosen |= now
        nodes, roots = forest(x[now], y[now])
        to = np.arange(n)
        to[nodes] = roots
        part = to[part]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least node of each node's component for the nodes of some edges (``u``, ``v``)."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _replicas(classes: DataFrame, setting: Setting) -> DataFrame:
    """``anchor, fp, home`` and the other columns of ``classes`` (``fp`` first, then numbers) for each anchor a
    fingerprint is sent to, dealt and sorted by anchor."""
    words, numbers = setting.bits // 64, classes.columns[1:]
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("home", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in numbers)])

    def replicate(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2_000):
                part = batch.slice(lo, 2_000)
                fp = _matrix(part.column(0), words)
                row, key, home = anchors(fp, setting)
                rest = [pa.array(np.asarray(part.column(i + 1).to_numpy(), np.int64)[row]) for i in range(len(numbers))]
                yield pa.RecordBatch.from_arrays([pa.array(key), _binary(fp[row]), pa.array(home), *rest], names=schema.names)

    # Anchors without a home member, or with one member only, compare nothing; counting them first costs
    # as much as sending them.
    replicas = classes.mapInArrow(replicate, schema)
    return replicas.repartition(partitions(classes.sparkSession), "anchor").sortWithinPartitions("anchor")


def _by_anchor(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` over some whole anchors at a time: their bounds, with more than one member and one at home, and their columns."""

    def within(parts):
        columns = [pa.concat_arrays([p.column(i) for p in parts]) for i in range(parts[0].num_columns)]
        anchor, home = (np.asarray(columns[i].to_numpy(zero_copy_only=False)) for i in (0, 2))
        bounds = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
        hosted = np.add.reduceat(home, bounds[:-1], dtype=np.int64) > 0
        some = np.flatnonzero((np.diff(bounds) > 1) & hosted)
        yield from work(zip(bounds[some].tolist(), bounds[some + 1].tolist(), strict=True), columns[1], home, *(np.asarray(c.to_numpy()) for c in columns[3:]))

    def run(batches):
        held, key = [], None
        for batch in batches:
            anchor = np.asarray(batch.column(0).to_numpy())
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            if cut or (held and anchor[0] != key):
                yield from within([*held, *([batch.slice(0, cut)] if cut else [])])
                held = []
            held.append(batch.slice(cut))
            key = anchor[-1]
        if held:
            yield from within(held)
        A.release()

    return df.mapInArrow(run, schema)


def linked(classes: DataFrame, setting: Setting = CONTRACT) -> DataFrame:
    """From ``fp, node`` (distinct fingerprints): edges ``u, v`` that connect what needs no verification."""
    threshold, words = setting.threshold if setting.sure is None else setting.sure, setting.bits // 64

    def work(bounds, fps, home, node):
        fp, us, vs = _matrix(fps, words), [], []
        for lo, hi in bounds:
            a, b = _links(fp[lo:hi], home[lo:hi], threshold)
            us.append(node[lo:hi][a])
            vs.append(node[lo:hi][b])
        if us:
            nodes, roots = forest(np.concatenate(us), np.concatenate(vs))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[nodes != roots]), pa.array(roots[nodes != roots])], names=["u", "v"])

    return _by_anchor(_replicas(classes.select("fp", "node"), setting), work, "u long, v long")


def remaining(rooted: DataFrame, setting: Setting) -> DataFrame:
    """From ``fp, node, root``: ``u, v``, all pairs of nodes of different groups whose distance makes them candidates."""
    words = setting.bits // 64

    def work(bounds, fps, home, node, root):
        fp = _matrix(fps, words)
        for lo, hi in bounds:
            if (root[lo:hi] == root[lo]).all():
                continue
            hosts, members = lo + np.flatnonzero(home[lo:hi]), np.arange(lo, hi)
            for k in range(0, len(hosts), BLOCK):
                u, v = _near(fp, hosts[k : k + BLOCK], members, setting.threshold)
                u, v = node[u[root[u] != root[v]]], node[v[root[u] != root[v]]]
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    return _by_anchor(_replicas(rooted.select("fp", "node", "root"), setting), work, "u long, v long").distinct()


def undecided(rooted: DataFrame, setting: Setting) -> DataFrame:
    """From ``fp, node, root`` (the least node that a node is linked to): ``a, b, d, u, v``, for two groups that have candidates
    in one anchor the closest pair there, and its distance."""
    words = setting.bits // 64

    def work(bounds, fps, home, node, root):
        fp, found = _matrix(fps, words), []
        for lo, hi in bounds:
            if (root[lo:hi] == root[lo]).all():
                continue
            if hi - lo <= BLOCK:
                # Most anchors hold few members, of which no two are near: one look at all of them.
                hosts = np.flatnonzero(home[lo:hi])
                if (_distances(fp[lo:hi], hosts, np.arange(hi - lo)) <= setting.threshold).sum() == len(hosts):
                    continue
            u, v, d = _undecided(fp[lo:hi], home[lo:hi], np.unique(root[lo:hi], return_inverse=True)[1], setting)
            u, v = u + lo, v + lo
            found.append((np.minimum(root[u], root[v]), np.maximum(root[u], root[v]), d, node[u], node[v]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b", "d", "u", "v"])

    return _by_anchor(_replicas(rooted.select("fp", "node", "root"), setting), work, "a long, b long, d long, u long, v long")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, setting: Setting) -> DataFrame:
    """The ``pairs`` of nodes ``u, v`` whose texts have similar sets of shingles.  ``classes`` has ``node, class, h``
    and ``texts`` has ``class, h, text``.  Sets are sent only for pairs that their sketches (the places of SKETCH that some shingle
    falls on) do not rule out: each place of one text only is a shingle of that text only."""

    def sets(batches):
        for batch in batches:
            data, offsets, _ = A.utf8(batch.column(1))
            out, sketches = [], []
            for lo, hi in A.chunks(offsets):
                h, bounds = shingle_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], setting.shingle)
                out += [np.unique(h[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            for x in out:
                places = np.zeros(SKETCH, bool)
                places[x.view(np.uint64) % A.U64(SKETCH)] = True
                sketches.append(np.packbits(places).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], names=["node", "shingles", "sketch"])
        A.release()

    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = classes.join(nodes, "node").select("node", "class", "h")
    # Equal rows have one text.
    known = texts.join(wanted, ["class", "h"]).select("node", "text").mapInArrow(sets, "node long, shingles array<long>, sketch array<long>").dropDuplicates(["node"])
    known = materialise(known, "shingles")

    def only(x, y):
        return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))), F.lit(0), lambda total, n: total + n)

    sketched = [known.select(F.col("node").alias(x), F.size("shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in ("u", "v")]
    most = F.least(F.col("n_u") - only("s_u", "s_v"), F.col("n_v") - only("s_v", "s_u"))
    pairs = pairs.join(sketched[0], "u").join(sketched[1], "v").withColumn("most", most)
    pairs = pairs.where(F.col("most") >= setting.similarity * (F.col("n_u") + F.col("n_v") - F.col("most"))).select("u", "v")
    both = pairs.join(known.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(known.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    same = F.size(F.array_intersect("a", "b"))
    return both.withColumn("same", same).where(F.col("same") >= setting.similarity * (F.size("a") + F.size("b") - F.col("same"))).select("u", "v")


def _groups(classes: DataFrame, texts: DataFrame, setting: Setting) -> DataFrame:
    """``u, v``: each node that is linked to a lesser one, and the least node of its component."""
    near = components(linked(classes, setting))
    if setting.sure is None:
        return near
    # Only candidates of different groups are looked for: a crowd of copies is one group by now.
    def with_root(groups):
        return classes.join(groups, classes["node"] == groups["u"], "left").select("fp", "node", F.coalesce("v", "node").alias("root"))

    rooted = materialise(with_root(near), "rooted")
    closest = undecided(rooted, setting).groupBy("a", "b").agg(F.min(F.struct("d", "u", "v")).alias("x"))
    closest = materialise(closest.select("a", "b", "x.u", "x.v"), "pairs")
    similar = materialise(verified(closest.select("u", "v"), classes, texts, setting), "similar")
    more = closest.join(similar, ["u", "v"]).select(F.col("b").alias("u"), F.col("a").alias("v"))
    found = components(near.unionAll(more))
    # A forest leaves pairs out because others connect their groups.  Where one of these fails and its groups stay apart, the rest of their pairs decide.
    rooted, failed = materialise(with_root(found), "rooted"), closest.join(similar, ["u", "v"], "left_anti")
    root_of = [rooted.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in ("u", "v")]
    apart = failed.join(root_of[0], "u").join(root_of[1], "v").where("root_u <> root_v").select(F.explode(F.array("root_u", "root_v")).alias("root")).distinct()
    apart = materialise(rooted.join(apart, "root", "left_semi").select("fp", "node", "root"), "apart")
    tried = closest.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    rest = materialise(remaining(apart, setting).join(tried, ["u", "v"], "left_anti"), "rest")
    return components(found.unionAll(verified(rest, classes, texts, setting)))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: list[str] | None = None, setting: Setting = CONTRACT) -> DataFrame:
    """``keep`` columns (default: all) with ``fingerprint`` (hex digits, the highest first) and
    ``component_id``, the least id reachable over links.  The kept columns are written once beside the
    fingerprints."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("fingerprint", "component_id")]
    own = docs.select(*(F.col(f"`{c}`").alias(f"k_{c}") for c in keep), F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text}`").alias("__text"))
    own = own.withColumn("__hash", F.lit(0).cast("long") if setting.sure is None else F.xxhash64(F.coalesce("__text", F.lit(""))))
    rows = materialise(with_fingerprint(own, "__text", [*(f"k_{c}" for c in keep), "__id", "__hash"], setting), "fingerprints")
    classes = rows.where("__id is not null").groupBy("fp").agg(F.min(F.struct("__id", "__hash")).alias("x"))
    classes = materialise(classes.select("fp", F.col("x.__id").alias("class"), F.col("x.__hash").alias("h")).withColumn("node", F.monotonically_increasing_id()), "classes")
    texts = own.select(F.col("__id").alias("class"), F.col("__hash").alias("h"), F.coalesce("__text", F.lit("")).alias("text"))
    member = _groups(classes, texts, setting)
    # Nodes are numbers of classes: rows that share an id may be in different classes.
    of = classes.join(member, classes["node"] == member["u"], "left").select("fp", "class", F.coalesce("v", "node").alias("root"))
    least = of.groupBy("root").agg(F.min("class").alias("component_id"))
    of = of.join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp", "left").select(
        *(F.col(f"`k_{c}`").alias(c) for c in keep),
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.when(F.col("__id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", setting: Setting = SIMILAR) -> DataFrame:
    """One document of each component: the one with the least id (of rows that share it, the one with the
    least hash of the text; of equal rows, one).  Rows with a null id are kept.  The documents' own columns are returned,
    whatever their names."""
    own = docs.select(*(F.col(f"`{c}`").alias(f"k_{c}") for c in docs.columns), F.col(f"`{id_col}`").cast("long").alias("__i"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__h"))
    found = near_duplicates(own, f"k_{text}", "__i", ["__i", "__h"], setting).where("component_id is not null")
    each = found.groupBy("component_id", F.col("__i").alias("i"), F.col("__h").alias("h")).agg(F.count("*").alias("n"))
    stays = materialise(each.groupBy("component_id").agg(F.min_by("n", F.struct("i", "h")).alias("n"), F.min(F.struct("i", "h")).alias("x")).select(F.col("x.i").alias("__i"), F.col("x.h").alias("__h"), "n"), "stays")
    once = own.join(stays.where("n = 1"), ["__i", "__h"], "left_semi")
    parts = [once, own.where(F.col("__i").isNull())]
    if not stays.where("n > 1").isEmpty():
        # Equal rows; partial aggregation leaves one per task before anything is sent.
        parts.append(own.join(stays.where("n > 1"), ["__i", "__h"], "left_semi").dropDuplicates(["__i", "__h"]))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(*(F.col(f"`k_{c}`").alias(c) for c in docs.columns))


def op7(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])
