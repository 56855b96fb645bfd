"""N-gram Jaccard self-join by prefix trees, and the components of its links.

A document is the set of its 5-word shingles, each a 62-bit hash. Sets are in one global order: rare shingles by hash, then
the frequent ones by rising frequency. Two sets can only link if the shorter one's index prefix and the longer one's probe
prefix share a shingle, so documents meet in the lists of their prefix shingles.

1. Documents with equal sets are one class.
2. In every list all classes are paired with one leader. Verified links join most near copies.
3. Pairs whose parity sketches differ in too many bits are dropped, an exact bound that moves a few bytes for each set.
4. Lists with classes of more than one component give a forest of pairs that would join those components, which is verified.
   This is linear in a list's length and joins what the leaders left apart of a large group of near copies.
5. Lists that still have more than one component give all their pairs across components, which are verified too. Pairs within
   a component add nothing to it, so a large group of near copies never makes all its pairs, and no link between components
   is lost.

Verification is the trie: the sets to be compared with one probe are put in a prefix tree whose branches share partial
overlaps, and a branch is left when the lengths that remain cannot reach the overlap that is needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, hashed_words, mix, shuffle_width, slices, stored
from .components import components

SHINGLE = 5
#: Similarity 75/100: 7 * overlap >= 3 * (n + m).
OVERLAP, SIZES = 7, 3
#: Frequent shingles that are broadcast, at most; they only set the order.
FREQUENT = 1 << 17
LEAST_FREQUENT = 32
#: Members of one part of a list.
PART = 2048
#: Members that are compared with a whole part before their pairs are passed on: what bounds the memory of a comparison.
BLOCK = 128
#: Prefix entries that one task sorts.
PER_TASK = 600_000
TOP = np.int64(1 << 62)


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    flat, lengths = hashed_words(texts)
    flat = flat.astype(np.uint64)
    out: list[np.ndarray] = []
    rolled = np.zeros(max(len(flat) - SHINGLE + 1, 0), np.uint64)
    for j in range(SHINGLE):
        rolled = mix(rolled ^ (flat[j : j + len(rolled)] + np.uint64(j + 1)))
    rolled = (rolled >> np.uint64(2)).astype(np.int64)
    end = 0
    for n in lengths.tolist():
        start, end = end, end + n
        if n >= SHINGLE:
            out.append(np.unique(rolled[start : end - SHINGLE + 1]))
        elif n:
            short = np.uint64(n)
            for w in flat[start:end]:
                short = mix(np.array([short ^ w]))[0]
            out.append(np.array([short >> np.uint64(2)]).astype(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def class_of(codes: np.ndarray) -> int:
    """63-bit digest of a set."""
    return int.from_bytes(hashlib.blake2b(codes.tobytes(), digest_size=8).digest(), "big") >> 1


def sketch_of(codes: np.ndarray) -> bytes:
    """Parity of the codes in each of 2 to 4 buckets per code: two sets differ in no fewer codes than their sketches in bits."""
    bits = max(64, 1 << (2 * len(codes) - 1).bit_length())
    return np.packbits(np.bincount(codes & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_link(x: bytes, n: int, y: bytes, m: int) -> bool:
    """False only where the sketches show that the sets differ in more codes than 7 * difference <= n + m allows."""
    if len(x) < len(y):
        x, y = y, x
    a, b, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(x)
    while size > 8 * len(y):
        size //= 2
        a = (a >> size) ^ (a & ((1 << size) - 1))
    return OVERLAP * (a ^ b).bit_count() <= n + m


def probe_prefix(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def index_prefix(n: int) -> int:
    return n - (6 * n + 6) // 7 + 1


class Order:
    """The global order: a set's codes with frequent shingles moved behind all others, by frequency."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        rank = np.lexsort((keys, counts))
        by_key = np.argsort(keys)
        self.keys, self.place = keys[by_key], np.empty(len(keys), np.int64)
        self.place[rank] = np.arange(len(keys))
        self.place = self.place[by_key]
        self.dealt = -(-counts[rank] // PART)

    def ordered(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.keys) or not len(codes):
            return codes
        at = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
        hit = self.keys[at] == codes
        if not hit.any():
            return codes
        return np.sort(np.where(hit, TOP + self.place[at], codes))

    def parts(self, keys: np.ndarray) -> np.ndarray:
        """Parts that the list of a key is dealt over: 1, but for very frequent keys."""
        out = np.ones(len(keys), np.int64)
        heavy = keys >= TOP
        if heavy.any():
            out[heavy] = self.dealt[keys[heavy] - TOP]
        return out


class SetTrie:
    """A prefix tree over ordered sets, kept as the sorted sets and their common prefix lengths."""

    def __init__(self, sets: list[np.ndarray]):
        keys = [s.astype(">i8").tobytes() for s in sets]
        self.rank = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.rank]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.shared = np.zeros(len(sets), np.int64)
        for i in range(1, len(sets)):
            a, b = self.sets[i - 1], self.sets[i]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[i] = differ[0] if len(differ) else n

    def similar(self, probe: np.ndarray) -> list[int]:
        """Positions, in the list that the tree was made of, of the sets that link with the probe."""
        found, m = [], len(probe)
        stack = [(0, len(self.sets), 0, 0)]
        while stack:
            lo, hi, depth, overlap = stack.pop()
            last = int(self.sizes[lo]) if hi - lo == 1 else int(min(self.shared[lo + 1 : hi].min(), self.sizes[lo]))
            edge = self.sets[lo][depth:last]
            at = np.searchsorted(probe, edge)
            if m and len(edge):
                overlap += int((probe[np.minimum(at, m - 1)] == edge).sum())
            sizes = self.sizes[lo:hi]
            left = m - int(np.searchsorted(probe, self.sets[lo][last - 1], side="right")) if last else m
            if OVERLAP * (overlap + min(int(sizes.max()) - last, left)) < SIZES * (int(sizes.min()) + m):
                continue
            cut = lo
            while cut < hi and self.sizes[cut] == last:  # sets that end here come first
                if OVERLAP * overlap >= SIZES * (last + m):
                    found.append(self.rank[cut])
                cut += 1
            if cut < hi:
                breaks = cut + 1 + np.flatnonzero(self.shared[cut + 1 : hi] <= last)
                bounds = [cut, *breaks.tolist(), hi]
                stack += [(a, b, last, overlap) for a, b in zip(bounds, bounds[1:], strict=False)]
        return found


def profiles(docs: DataFrame) -> DataFrame:
    """For every row doc_id, n, node (its class, null without words); and rows with a task's frequent shingles."""
    schema = pa.schema([("frequent", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for rows, texts in slices(batches):
            sets = shingle_sets(texts)
            k = len(sets)
            yield pa.record_batch([pa.array([False] * k), rows.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([sketch_of(s) if len(s) else None for s in sets], pa.binary()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())], schema=schema)
            key, count = np.unique(np.concatenate(sets), return_counts=True) if k else (np.zeros(0, np.int64),) * 2
            often = count >= 3
            seen[0], back = np.unique(np.concatenate([seen[0], key[often]]), return_inverse=True)
            seen[1] = np.bincount(back, np.concatenate([seen[1], count[often]]), len(seen[0])).astype(np.int64)
            if len(seen[0]) > 4 * FREQUENT:
                top = np.sort(np.argpartition(-seen[1], 2 * FREQUENT)[: 2 * FREQUENT])
                seen = [seen[0][top], seen[1][top]]
        top = np.argsort(-seen[1], kind="stable")[:FREQUENT]
        if len(top):
            yield pa.record_batch([pa.array([True]), *(pa.nulls(1, pa.int64()) for _ in range(3)), pa.nulls(1, pa.binary()), pa.array([seen[0][top].tobytes()]), pa.array([seen[1][top].tobytes()])], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "frequent boolean, doc_id long, n long, node long, sketch binary, keys binary, counts binary")


def frequent_order(made: DataFrame) -> Order:
    """The order from the tasks' frequent shingles; at most FREQUENT of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.record_batch([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(counts, np.int64))], names=["key", "n"])

    sums = made.filter("frequent").select("keys", "counts").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = sums.filter(F.col("n") >= LEAST_FREQUENT).orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    return Order(top.column("key").to_numpy(), top.column("n").to_numpy())


def prefix_lists(docs: DataFrame, order, width: int) -> DataFrame:
    """Pairs with leaders, and lists: kind 0 (gid: a task, nodes: a and b, sizes: their lists), kind 1 (gid, part, nodes, sizes), kind 2 (gid, a: a part's leader, b: its size)."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for _, texts in slices(batches):
            keys, nodes, sizes = [], [], []
            for s in shingle_sets(texts):
                if not len(s) or (node := class_of(s)) in done:
                    continue
                done.add(node)
                n, p = len(s), probe_prefix(len(s))
                keys.append(order.value.ordered(s)[:p])
                nodes.append(np.full(p, node))
                sizes.append(2 * np.int64(n) + (np.arange(p) < index_prefix(n)))
            if not keys:
                continue
            key, node, size = map(np.concatenate, (keys, nodes, sizes))
            salt = mix(node.astype(np.uint64)).astype(np.int64) & (TOP - 1)
            salt %= order.value.parts(key)
            pid = (mix(key.astype(np.uint64) + mix(salt.astype(np.uint64))) % np.uint64(width)).astype(np.int64)
            by = np.argsort(pid, kind="stable")
            cuts = np.flatnonzero(np.diff(pid[by])) + 1
            column = lambda v, t: pa.array([x.astype(t).tobytes() for x in np.split(v[by], cuts)], pa.binary())  # noqa: B023, E731
            yield pa.record_batch([pa.array(pid[by][np.r_[0, cuts]]), column(key, np.int64), column(salt, np.int32), column(node, np.int64), column(size, np.int32)], names=["pid", "keys", "salts", "nodes", "sizes"])

    schema = pa.schema([("kind", pa.int32()), ("gid", pa.int64()), ("part", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("nodes", pa.binary()), ("sizes", pa.binary())])

    def rows(kind: int, n: int, **given) -> pa.RecordBatch:
        return pa.record_batch([pa.array(given[f.name], f.type) if f.name in given else pa.array([kind] * n, pa.int32()) if f.name == "kind" else pa.nulls(n, f.type) for f in schema], schema=schema)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups_of(batches, "pid"):
            read = lambda name, t: np.frombuffer(b"".join(group.column(name).to_pylist()), t)  # noqa: B023, E731
            key, salt, node, size = read("keys", np.int64), read("salts", np.int32), read("nodes", np.int64), read("sizes", np.int32)
            by = np.lexsort((node, salt, key))
            key, salt, node, size = key[by], salt[by], node[by], size[by]
            new = np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])] if len(key) else np.zeros(0, bool)
            single = new | np.r_[True, node[1:] != node[:-1]] if len(key) else new
            key, salt, node, size, new = key[single], salt[single], node[single], size[single], new[single]
            starts = np.flatnonzero(new)
            counts = np.diff(np.r_[starts, len(key)])
            salted = order.value.parts(key[starts]) > 1
            useful = salted | ((counts > 1) & (np.maximum.reduceat(size & 1, starts) > 0)) if len(starts) else salted
            first, group_no = np.repeat(starts, counts), np.repeat(np.arange(len(starts)), counts)
            n, lead = size >> 1, size[first] >> 1
            near = useful[group_no] & (np.arange(len(key)) != first) & (4 * np.minimum(n, lead) >= 3 * np.maximum(n, lead))
            if near.any():
                pairs, times = np.unique(np.column_stack([node[near], node[first[near]]]), axis=0, return_counts=True)
                home = (mix(pairs[:, 0].astype(np.uint64)) % np.uint64(width)).astype(np.int64)
                by = np.argsort(home, kind="stable")
                cuts = np.flatnonzero(np.diff(home[by])) + 1
                packed = lambda v, t: [x.astype(t).tobytes() for x in np.split(v[by], cuts)]  # noqa: B023, E731
                yield rows(0, len(cuts) + 1, gid=home[by][np.r_[0, cuts]], nodes=packed(pairs, np.int64), sizes=packed(times, np.int32))
            if salted.any():
                at = starts[salted]
                yield rows(2, len(at), gid=key[at], a=node[at], b=size[at].astype(np.int64))
            # lists with the same members and flags are kept once; one dealt over parts is always kept
            sign = np.add.reduceat(mix(node.astype(np.uint64) * np.uint64(2) + (size & 1).astype(np.uint64)), starts).astype(np.int64) if len(starts) else starts
            keep, whole = salted.copy(), np.flatnonzero(~salted)
            keep[whole[np.unique(sign[whole], return_index=True)[1]]] = True
            for i in np.flatnonzero(useful & keep).tolist():
                a, b = int(starts[i]), int(starts[i] + counts[i])
                gid = int(key[a]) if salted[i] else int(sign[i])
                for part, at in enumerate(range(a, b, PART)):
                    z = min(at + PART, b)
                    yield rows(1, 1, gid=[gid], part=[int(salt[a]) * 4096 + part], nodes=[node[at:z].tobytes()], sizes=[size[at:z].tobytes()])

    packed = docs.select("doc_id", "text").mapInArrow(entries, "pid long, keys binary, salts binary, nodes binary, sizes binary")
    made = packed.repartition(width, "pid").sortWithinPartitions("pid").mapInArrow(merged(lists, schema), "kind int, gid long, part long, a long, b long, nodes binary, sizes binary")
    return made


def best_leaders(found: DataFrame, width: int) -> DataFrame:
    """For each class a its leader b with which it shares the most lists, the least one of equals."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups_of(batches, "gid"):
            pairs = np.frombuffer(b"".join(group.column("nodes").to_pylist()), np.int64).reshape(-1, 2)
            times = np.frombuffer(b"".join(group.column("sizes").to_pylist()), np.int32)
            by = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs, times = pairs[by], times[by]
            starts = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)])
            pairs, times = pairs[starts], np.add.reduceat(times, starts)
            by = np.lexsort((pairs[:, 1], -times, pairs[:, 0]))
            best = pairs[by[np.flatnonzero(np.r_[True, np.diff(pairs[by, 0]) != 0])]]
            yield pa.record_batch([pa.array(best[:, 0]), pa.array(best[:, 1])], schema=schema)

    packed = found.filter("kind = 0").select("gid", "nodes", "sizes")
    return packed.repartition(width, "gid").sortWithinPartitions("gid").mapInArrow(run, "a long, b long")


def merged(run, schema: pa.Schema, least: int = 2000):
    """run with its small batches put together."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= least:
                yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()

    return inner


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sketches leave open. No pair that links is lost."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_sketch"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(i).to_pylist() for i in range(2, 6))
            yield batch.select(["a", "b"]).filter(pa.array([may_link(s, i, t, j) for s, i, t, j in zip(x, n, y, m, strict=True)], pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order, width: int) -> DataFrame:
    """The pairs (a, b) of classes that link. b probes a trie of the sets of its a's, PART at a time."""
    pairs = pairs.withColumn("part", F.floor(F.pmod(F.xxhash64("a"), F.lit(1 << 30)) / (1 << 24)))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = classes.join(wanted, "node", "left_semi").select(F.col("first_id").alias("_id"))
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    set_schema = pa.schema([("node", pa.int64()), ("codes", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw in slices(batches):
            made = [s for s in shingle_sets(raw) if len(s)]
            yield pa.record_batch([pa.array([class_of(s) for s in made], pa.int64()), pa.array([order.value.ordered(s).tobytes() for s in made], pa.binary())], schema=set_schema)

    held = stored(texts.mapInArrow(sets, "node long, codes binary"), "sets")
    members = pairs.join(held, F.col("a") == F.col("node")).select(F.col("b").alias("probe"), "part", F.lit(1).alias("role"), "a", "codes")
    probes = pairs.select("b", "part").distinct().join(held, F.col("b") == F.col("node")).select(F.col("b").alias("probe"), "part", F.lit(0).alias("role"), F.col("b").alias("a"), "codes")
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe, codes, waiting, names = None, None, [], []

        def answer() -> Iterator[pa.RecordBatch]:
            if waiting:
                found = [names[i] for i in SetTrie(waiting).similar(codes)]
                yield pa.record_batch([pa.array(found, pa.int64()), pa.array([probe[0]] * len(found), pa.int64())], schema=link_schema)
            waiting.clear()
            names.clear()

        for batch in batches:
            for key, part, role, a, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, part) != probe:
                    yield from answer()
                    probe = (key, part)
                if role == 0:
                    codes = np.frombuffer(raw, np.int64)
                elif not names or names[-1] != a:
                    names.append(a)
                    waiting.append(np.frombuffer(raw, np.int64))
                    if len(waiting) >= PART:
                        yield from answer()
        yield from answer()

    dealt = probes.unionByName(members).repartition(width, "probe", "part").sortWithinPartitions("probe", "part", "role", "a")
    return dealt.mapInArrow(merged(compare, link_schema), "a long, b long")


def members_of(lists: DataFrame) -> DataFrame:
    """gid, part, node, size for every member of the lists."""
    schema = pa.schema([("gid", pa.int64()), ("part", pa.int64()), ("node", pa.int64()), ("size", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, part, nodes, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                node = np.frombuffer(nodes, np.int64)
                yield pa.record_batch([pa.array(np.full(len(node), gid)), pa.array(np.full(len(node), part)), pa.array(node), pa.array(np.frombuffer(sizes, np.int32).astype(np.int64))], schema=schema)

    # lists with equal members and flags come from several tasks; those in parts belong together by gid
    once = lists.dropDuplicates(["gid", "part"])
    return once.select("gid", "part", "nodes", "sizes").mapInArrow(merged(spread, schema, 20000), "gid long, part long, node long, size long")


def mixed_members(member: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of lists with more than one component, with their component and the parts of their list."""
    named = stored(member.join(labels, "node", "left").select("gid", "part", "node", "size", F.coalesce("component", "node").alias("component")), "members")
    mixed = named.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.collect_set("part").alias("parts")).filter("lo < hi").select("gid", "parts")
    return stored(named.join(mixed, "gid"), "mixed")


def across(mixed: DataFrame, classes: DataFrame, width: int, forest: bool) -> DataFrame:
    """The pairs (a, b) of members of one list that are in different components and whose sizes, prefixes and sketches allow a link.

    With forest only those of them that would join components which the list's pairs before them leave apart.
    """
    blocks = F.transform("parts", lambda p: F.struct(F.least(p, F.col("part")).alias("p"), F.greatest(p, F.col("part")).alias("q")))
    dealt = mixed.select("gid", F.explode(blocks).alias("block"), "part", "node", "size", "component").select("gid", "block.p", "block.q", F.xxhash64("gid", "block.p", "block.q").alias("key"), "part", "node", "size", "component")
    dealt = dealt.join(classes.select("node", "sketch"), "node")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups_of(batches, "key"):
            get = lambda name: group.column(name).to_numpy()  # noqa: B023, E731
            node, size, component, part, p, q = map(get, ("node", "size", "component", "part", "p", "q"))
            left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
            m, own = size[right] >> 1, (size[right] & 1).astype(bool)[None, :]

            def allowed(some: np.ndarray) -> np.ndarray:
                """For some members of the left part whether a link with each of the right one is possible."""
                n = (size[some] >> 1)[:, None]
                out = (component[some][:, None] != component[right][None, :]) & (4 * np.minimum(n, m) >= 3 * np.maximum(n, m))
                return out & (np.where(n <= m, (size[some] & 1).astype(bool)[:, None], own) | ((n == m) & own))  # noqa: B023

            def named(i: list, j: list) -> pa.RecordBatch:
                a, b = node[np.array(i, np.int64)], node[np.array(j, np.int64)]  # noqa: B023
                pairs = np.unique(np.column_stack([np.maximum(a, b), np.minimum(a, b)]), axis=0) if len(a) else np.zeros((0, 2), np.int64)
                return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=out)

            raw = group.column("sketch").to_pylist()
            open_ = lambda x, y: may_link(raw[x], size[x] >> 1, raw[y], size[y] >> 1)  # noqa: B023, E731
            joined = component.copy()
            for at in range(0, len(left), BLOCK):
                some, i, j = left[at : at + BLOCK], [], []
                may = allowed(some) & ((p[0] != q[0]) | (right[None, :] > some[:, None]))  # within one part each pair once
                for r, x in enumerate(some.tolist()):
                    if not forest:
                        near = [y for y in right[may[r]].tolist() if open_(x, y)]
                        i += [x] * len(near)
                        j += near
                        continue
                    for y in right[may[r] & (joined[right] != joined[x])].tolist():
                        if joined[y] != joined[x] and open_(x, y):
                            joined[joined == joined[y]] = joined[x]
                            i.append(x)
                            j.append(y)
                if i:
                    yield named(i, j)

    found = dealt.repartition(width, "key").sortWithinPartitions("key").mapInArrow(merged(cross, out), "a long, b long")
    return found.distinct()


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text; other columns are left behind).

    Null or empty texts have no shingles and are their own component. A null doc_id gives no name to a component: one of
    null ids only has a null component_id. Repeated rows are equal sets. Whole texts are used, however long.
    """
    spark = docs.sparkSession
    made = stored(profiles(docs), "profiles")
    rows = made.filter("NOT frequent").select("doc_id", "n", "node", "sketch")
    total = rows.agg(F.sum("n")).first()[0] or 0
    width = shuffle_width(spark, total / 4, PER_TASK)
    order = spark.sparkContext.broadcast(frequent_order(made))
    classes = stored(rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    found = stored(prefix_lists(docs, order, width), "lists")
    leads = found.filter("kind = 2").select("gid", F.col("a").alias("node"))
    first = leads.groupBy("gid").agg(F.min("node").alias("b"))
    # one leader for each class is enough here: what this leaves apart is compared again across components
    stars = best_leaders(found, width).union(leads.join(first, "gid").filter("node <> b").select("node", "b").distinct())
    open_stars = stored(plausible(stars, classes).distinct(), "stars")
    near = stored(verified(open_stars, docs, classes, order, width), "links")
    labels = stored(components(near), "labels")
    member = members_of(found.filter("kind = 1"))
    for forest in (True, False):
        member = mixed_members(member.select("gid", "part", "node", "size"), labels)
        rest = stored(across(member, classes, width, forest), "across")
        more = verified(rest, docs, classes, order, width)
        labels = stored(components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "labels")
    named = classes.join(labels, "node", "left").select("node", "first_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_node = named.join(least, "component").select("node", "component_id")
    out = rows.drop("sketch").join(by_node, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs, all columns, with one row of each component: the one with the least doc_id.

    Rows without words stay, each a component of its own. Rows with a null doc_id stay, as nothing names them. Of rows that
    repeat the kept id, one stays.
    """
    found = join_documents(docs)
    free = "kept_id"
    while free in docs.columns:
        free += "_"
    kept = stored(found.filter("n_shingles > 0 AND doc_id = component_id").select(F.col("doc_id").alias(free)).distinct(), "kept")
    worded = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")) > 0
    named = docs.filter(F.col("doc_id").isNotNull() & worded).join(kept, F.col("doc_id") == F.col(free), "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(docs.filter(F.col("doc_id").isNull() | ~worded))
