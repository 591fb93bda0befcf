"""N-gram Jaccard join: prefix-tree join of word 5-gram sets, and the groups that its links form.

Sets are put in one global order, from rare to common members: a table of fixed size holds the members that
many texts share, by how often they were met (any order gives the same links; this one keeps common passages
out of the way). Members are compared as 64-bit hashes.

1. Equal sets become one class (an aggregate); the rest works on classes.
2. A set of n members that shares at least ceil(0.8 n) of them with another shares one of its first
   n - ceil(0.8 n) + 1. These are its keys; keys of one class alone are dropped by an aggregate (through a
   bit table, which may keep a few too many).
3. Classes that meet no class of a fitting size in a key leave it. Of the others, pairs are kept that the sizes,
   the key's places in the order (it must be able to be the first member they share) and a parity sketch
   allow: its bits are the parities of the members in each bin, so two sketches differ in no more bits than the
   sets in members. No linked pair is lost by any of these.
4. Pairs form clusters; each class ships its whole set to its cluster once. There a prefix tree holds the
   sets, ordered by hash: a set traverses it, overlap found so far is shared by all sets below a node, and a subtree
   is left when what remains cannot bring the overlap to the least needed. The tree lies in arrays and is gone
   through a level at a time, so a set that is near many and linked with none costs a pass over them, not a walk.
   Similarities are exact.
5. Links are turned into components by rounds of hooking on stored tables.

A key's group and a cluster of more than ``LIMIT`` classes are cut into blocks and each pair of blocks
is a task of its own, so no task is unbounded and no pair is left out.

Cases: null and wordless texts have an empty set and are linked with nothing; under 5 words the whole
sequence is the one member; rows of one id count as one document; rows without id are linked with
nothing and have no component; equal rows get equal results; empty tables give no rows; only the
named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm import common as C

SHINGLE, LIMIT, BITS = 5, 4000, 27
SMALL, NEAR = 6, 3  # clusters of so many are compared pair by pair; rows of a key with so many before them first
NEED, OF = 80, 100  # linked if OF * intersection >= NEED * union
#: Members in the table of common ones; bytes of text in a run that counts them; bits of the widest sketch.
COMMON, COUNTED, WIDEST = 1 << 20, 1 << 22, 1 << 14
#: Rows of key groups that are compared at once, whole groups.
RUN = 1 << 15


def _sets(b, text_col: str, shingle: int, max_bytes: int = 1 << 20):
    """(row, sorted distinct hashes) for each text of a batch."""
    for i, buf, off in C.doc_slices(b.column(text_col), max_bytes):
        w = C.Words(buf, off, C.ASCII_SPACE, C.LOWER)
        g = C.kgrams(w.hash, shingle)
        for k in range(len(off) - 1):
            a, z = w.first[k], w.first[k + 1]
            yield i + k, np.unique(g[a:z - shingle + 1]) if z - a >= shingle else C.kgrams(w.hash[a:z], z - a)[:z - a]


def common_members(docs: DataFrame, text: str, shingle: int, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` members met most often, sorted, and their order from the least to the most often met.

    A run of texts counts what it meets twice or more, so a member is counted about as far as it is common; the
    runs' counts are added by Spark."""
    def count(batches):
        for b in batches:
            held, size = [], 0

            def met(held):
                h, n = np.unique(np.concatenate(held), return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(h[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["g", "n"])

            for _, s in _sets(b, "text", shingle):
                held.append(s)
                size += len(s)
                if size * 8 > COUNTED:
                    yield met(held)
                    held, size = [], 0
            if held:
                yield met(held)

    met = docs.select(C.column(docs, text).alias("text")).mapInArrow(count, "g long, n long")
    met = C.stored(met.groupBy("g").agg(F.sum("n").alias("n")), "met-members")
    sizes = met.groupBy("n").agg(F.count(F.lit(1)).alias("members")).orderBy(F.desc("n")).toPandas()   # one row per count
    fit = sizes[sizes["members"].cumsum() <= most]
    top = met.where(F.col("n") >= int(fit["n"].min()) if len(fit) else F.lit(False)).toPandas()
    g, n = top["g"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    rank = np.zeros(len(g), np.uint32)
    rank[np.lexsort((g, n))] = np.arange(1, len(g) + 1, dtype=np.uint32)
    at = np.argsort(g)
    return g[at], rank[at]


def keys_of(n):
    """How many of the first members of a set of n are its keys."""
    return n - -(-NEED * n // OF) + 1 if n else 0


def width_of(n):
    """Bits of the sketch of a set of n members: a power of two, two thirds of n at least. Sets that differ in
    most members then differ in a third of n bits or more; linked ones differ in under a quarter."""
    return int(min(WIDEST, max(64, 1 << int((2 * n + 2) // 3 - 1).bit_length())))


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the members in each bin, as 64-bit words."""
    w = width_of(len(s))
    bins = (C.mix(s ^ np.uint64(0x9E3779B97F4A7C15)) & np.uint64(w - 1)).astype(np.int64)
    return np.packbits(np.bincount(bins, minlength=w) & 1 == 1, bitorder="little").view(np.uint64)


def fold(x: np.ndarray) -> np.ndarray:
    """Sketches of half the width."""
    half = x.shape[-1] // 2
    return x[..., :half] ^ x[..., half:]


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               common=None) -> DataFrame:
    """(doc_id, n, a, b, keys, sketch): set size, two sums over the set that name its class, its first members in
    the order from rare to common."""
    def run(batches):
        known, often = (x.value for x in common) if common is not None else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        for batch in (x for b in batches for x in C.row_slices(b, 1024)):
            n, a, b, keys, bits = [], [], [], [], []
            for _, s in _sets(batch, "text", shingle):
                n.append(len(s))
                a.append(int(np.add.reduce(C.mix(s ^ np.uint64(0x51ED270B)))) if len(s) else 0)
                b.append(int(np.add.reduce(C.mix(s ^ np.uint64(0xA3C59AC3)))) if len(s) else 0)
                keys.append(_first(s, known, often).view(np.int64))
                bits.append(sketch(s).tobytes() if len(s) else b"")
            wrap = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), wrap(a), wrap(b), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(bits, pa.binary())], names=["doc_id", "n", "a", "b", "keys", "sketch"])

    return docs.select(C.column(docs, doc_id, "long").alias("doc_id"), C.column(docs, text).alias("text")).mapInArrow(
        run, "doc_id long, n long, a long, b long, keys array<long>, sketch binary")


def _first(s, known, often):
    """The keys of a sorted set: its first members, those that are not known to be common first."""
    p = keys_of(len(s))
    if not len(known) or not p:
        return s[:p]
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    weight = np.where(known[at] == s, often[at], 0)
    rare = np.flatnonzero(weight == 0)
    if len(rare) >= p:
        return s[rare[:p]]
    return s[np.lexsort((s, weight))[:p]]


class Parts:
    """Union-find over the members of a group; the root of a part is its first member."""

    def __init__(self, n):
        self.up, self.left = list(range(n)), n

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.left -= 1

    def links(self):
        """Each member with the first of its part: stars, so that chains of links are short."""
        return [(self.root(i), i) for i in range(len(self.up)) if self.root(i) != i]


class Trie:
    """Prefix tree of sorted token sequences, as arrays; an edge holds the tokens up to the next branch or end.

    Edges lie by level, and with them their tokens, so a level of the tree is a slice. Of a node are kept the number
    of tokens on the way to it (``depth``), the longest way down and the sequences that end there; sequences that are
    equal end at one node. Its size is that of the sequences at most."""

    def __init__(self, seqs: list[np.ndarray]):
        """Of the sequences (distinct tokens each) in their order."""
        up, depth, rep, ends = [-1], [0], [0], [[]]   # node 0 is the top; rep is a sequence below the node
        held = [0]

        def node(d, i):
            up.append(-1)
            depth.append(d)
            rep.append(i)
            ends.append([])
            return len(up) - 1

        last = np.zeros(0, np.int64)
        for i, seq in enumerate(seqs):
            k = min(len(last), len(seq))
            unlike = np.flatnonzero(last[:k] != seq[:k])
            k = int(unlike[0]) if len(unlike) else k   # tokens in common with the one before
            while depth[held[-1]] > k:
                child = held.pop()
                if depth[held[-1]] < k:
                    held.append(node(k, rep[child]))
                up[child] = held[-1]
            if len(seq) > k:
                held.append(node(len(seq), i))
            ends[held[-1]].append(i)
            last = seq
        while len(held) > 1:
            child = held.pop()
            up[child] = held[-1]
        up, depth = np.array(up), np.array(depth)
        level, longest = np.zeros(len(up), np.int64), depth.copy()
        for x in np.argsort(depth, kind="stable")[1:].tolist():
            level[x] = level[up[x]] + 1
        for x in np.argsort(-depth, kind="stable").tolist():
            longest[up[x]] = max(longest[up[x]], longest[x])
        order = np.argsort(level, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        up[0] = 0
        self.up, self.depth, self.below = place[up[order]], depth[order], (longest - depth)[order]
        self.levels = np.searchsorted(level[order], np.arange(1, level.max() + 2))   # the first is the top's only
        cut = [seqs[rep[x]][depth[up[x]]:depth[x]] for x in order[1:].tolist()]
        self.start = np.concatenate([[0, 0], np.cumsum([len(x) for x in cut], dtype=np.int64)])   # the top has no tokens
        self.tokens = np.concatenate([*cut, np.zeros(0, np.int64)])
        self.ends = [np.array(ends[x], np.int64) for x in order.tolist()]
        self.ending = np.array([len(x) > 0 for x in self.ends])

    def near(self, seq: np.ndarray, has: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Members (sequences by their order) that share at least ``least`` tokens with ``seq`` and have at most
        ``most`` others, and how many they share; ``has`` tells of each token whether ``seq`` has it.

        The tree is gone through level by level. The overlap so far is that of all sequences below a node, which is
        left when it has too many others or too few tokens remain."""
        got = np.zeros(len(self.up), np.int64)
        live = np.zeros(len(self.up), bool)
        live[0] = min(self.below[0], len(seq)) >= least
        for lo, hi in zip(self.levels, self.levels[1:], strict=False):
            at = np.flatnonzero(live[self.up[lo:hi]]) + lo
            if not len(at):
                break
            first, size = self.start[at], self.start[at + 1] - self.start[at]
            if 8 * len(at) > hi - lo:
                alike = np.add.reduceat(has.take(self.tokens[self.start[lo]:self.start[hi]]), self.start[lo:hi] - self.start[lo], dtype=np.int64)[at - lo]
            else:
                end = np.cumsum(size)
                alike = np.add.reduceat(has.take(self.tokens[np.repeat(first - end + size, size) + np.arange(end[-1])]), end - size, dtype=np.int64)
            both = got[self.up[at]] + alike
            left = len(seq) - np.searchsorted(seq, self.tokens[first + size - 1], side="right")
            got[at] = both
            live[at] = (self.depth[at] - both <= most) & (both + np.minimum(self.below[at], left) >= least)
        found = np.flatnonzero(live & self.ending & (got >= least))
        members = [self.ends[x] for x in found]
        return (np.concatenate(members) if members else np.zeros(0, np.int64)), np.repeat(got[found], [len(x) for x in members])


def _connect(parts: Parts, seqs, able, linked, near) -> list[tuple[int, int]]:
    """Links that connect the able members that ``linked`` connects.

    Neighbours in the order of their sequences are tried first; then all members but those of the largest
    part ask the tree, since a link that is still missing has one of them at an end. Sequences are of local tokens,
    numbered in their order; ``linked`` takes members and, if known, how many tokens they share."""
    row = np.array(sorted(np.flatnonzero(able).tolist(), key=lambda j: seqs[j].tolist()), np.int64)
    root = np.arange(len(seqs))
    left = len(row)

    def join(i, j):
        nonlocal left
        a, b = sorted((int(root[i]), int(root[j])))
        if a != b:
            parts.join(int(i), int(j))
            root[root == b] = a
            left -= 1

    for i, j in zip(row, row[1:], strict=False):
        if linked(i, j):
            join(i, j)
    if left > 1:
        largest = np.bincount(root[row]).argmax()
        tree = Trie([seqs[j] for j in row])
        has = np.zeros(max(int(seqs[j].max(initial=-1)) for j in row) + 1, bool)
        for j in np.sort(row):
            if root[j] == root[largest]:
                continue
            has[seqs[j]] = True
            at, both = near(tree, seqs[j], has, j)
            has[seqs[j]] = False
            other = root[row[at]] != root[j]
            i = row[at[other]]
            for i in i[linked(i, j, both[other])]:
                join(i, j)
            if left == 1:
                break
    return parts.links()


def _shared(sets, sizes, least):
    """For each set its members that more than one set has, by their places among these members, and whether they are
    enough."""
    m = len(sets)
    owner, tokens = np.repeat(np.arange(m), [len(x) for x in sets]), np.concatenate(sets)
    _, which, times = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    which = (np.cumsum(times > 1) - 1)[which[shared]]
    return (np.split(which, np.searchsorted(owner[shared], np.arange(1, m))),
            np.bincount(owner[shared], minlength=m) >= least)


def may_meet(nx, ny, px, py):
    """Whether sets of sizes nx, ny may be linked and a key at the places px, py be the first member they share."""
    least = -(-NEED * (nx + ny) // (OF + NEED))
    return (OF * np.minimum(nx, ny) >= NEED * np.maximum(nx, ny)) & (np.minimum(nx - px, ny - py) >= least)


def alike(x: np.ndarray, y: np.ndarray, nx, ny):
    """Whether sets of sizes nx, ny with sketches x, y (rows of equal width) may be linked."""
    differ = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return (OF + NEED) * differ <= (OF - NEED) * (nx + ny)


def _sketch_rows(raw: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Widths (in words), and for each width used the sketches of that width; the place of each row among them."""
    words = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
    levels, place = {}, np.zeros(len(raw), np.int64)
    for w in np.unique(words):
        at = np.flatnonzero(words == w)
        place[at] = np.arange(len(at))
        levels[int(w)] = np.frombuffer(b"".join([raw[i] for i in at]), np.uint64).reshape(len(at), w)
    return words, levels, place


def candidate_links(group, n, pos, raw) -> list[tuple[int, int]]:
    """Links (rows) that connect in each group all rows that ``may_meet`` and ``alike`` connect; all groups at once.

    In the order of sizes, rows are first compared with the few before them. Then all rows but those of a group's
    largest part are compared with the rows of other parts that have a fitting size, since a link that is still
    missing has one of them at an end; a row that has come to the largest part is done. Of the links between two
    parts one is given."""
    if not len(group):
        return []
    order = np.lexsort((n, group))
    group, n, pos = group[order], n[order], pos[order]
    words, levels, place = _sketch_rows([raw[i] for i in order])
    folded = {w: fold(m) for w, m in levels.items() if w > 1}

    def check(i, j):
        """Which of the row pairs may be linked; of fitting sizes, widths differ by one step at most."""
        out = may_meet(n[i], n[j], pos[i], pos[j])
        some = np.flatnonzero(out)
        a, b = i[some], j[some]
        wide = words[a] < words[b]
        a, b = np.where(wide, b, a), np.where(wide, a, b)
        for w in np.unique(words[a]):
            for equal in (True, False):
                at = np.flatnonzero((words[a] == w) & ((words[b] == w) == equal))
                for k in np.array_split(at, -(-len(at) * w // (1 << 18)) or 1):   # some MB of sketches at once
                    if len(k):
                        x, y = (levels[w], levels[w]) if equal else (folded[w], levels[w // 2])
                        out[some[k]] = alike(x[place[a[k]]], y[place[b[k]]], n[a[k]], n[b[k]])
        return out

    rows = len(group)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    of = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    root = np.arange(rows)   # the first row of each row's part
    links = []

    def join(i, j):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            x, y = sorted((int(root[a]), int(root[b])))
            if x != y:
                own = root[edge[of[a]]:edge[of[a] + 1]]
                own[own == y] = x
                links.append((a, b))

    for k in range(1, NEAR + 1):
        j = np.flatnonzero(group[k:] == group[:-k]) + k if k < rows else np.zeros(0, np.int64)
        if k > 1:
            j = j[root[j] != root[j - k]]
        j = j[check(j - k, j)]
        join(j - k, j)
    size = np.bincount(root, minlength=rows)[root]   # of the row's part
    best = np.lexsort((size, of))[edge[1:] - 1]   # the last of each group is in its largest part
    main = lambda i: root[i] == root[best[of[i]]]
    asks = np.flatnonzero(~main(np.arange(rows)))
    for step in (-1, 1):   # before a row all others, after it those of the largest part (the others have asked themselves)
        j, d = asks, 1
        while len(j):
            j = j[~main(j)]   # what has come to the largest part since then is asked by the others
            i = j + step * d
            ok = (i >= 0) & (i < rows)
            ok[ok] = group[i[ok]] == group[j[ok]]
            ok[ok] = OF * np.minimum(n[i[ok]], n[j[ok]]) >= NEED * np.maximum(n[i[ok]], n[j[ok]])   # sizes only part from here on
            j, i = j[ok], i[ok]
            new = np.flatnonzero((root[i] != root[j]) & (main(i) | (step < 0)))
            hit = new[check(i[new], j[new])]
            join(i[hit], j[hit])
            d += 1
    return [(int(order[a]), int(order[b])) for a, b in links]


def exact_links(sets) -> list[tuple[int, int]]:
    """Links that connect all sets that links of the full similarity connect.

    A set of n members shares at least NEED / OF of them with a linked one, which then has at most
    (OF - NEED) / NEED of n others; the tree holds the hashes that more than one set has and gives the overlap."""
    m, sizes = len(sets), np.array([len(x) for x in sets])
    parts = Parts(m)

    def linked(i, j, both=None):
        """Whether the set j is linked with i; i and both may be arrays."""
        if both is None:
            if OF * min(sizes[i], sizes[j]) < NEED * max(sizes[i], sizes[j]):
                return False
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return OF * both >= NEED * (sizes[i] + sizes[j] - both)

    if m <= SMALL:
        for j in range(1, m):
            for i in range(j):
                if parts.left > 1 and parts.root(i) != parts.root(j) and linked(i, j):
                    parts.join(i, j)
        return parts.links()
    least = -(-NEED * sizes // OF)
    seqs, able = _shared(sets, sizes, least)
    return _connect(parts, seqs, able, linked,
                    lambda tree, seq, has, j: tree.near(seq, has, int(least[j]), (OF - NEED) * int(sizes[j]) // NEED))


def _blocks(df: DataFrame, group: str, member: str, limit: int) -> DataFrame:
    """``df`` (with the group's row count in ``rows``) with i and j: groups over ``limit`` as pairs of blocks."""
    s = F.ceil(F.col("rows") / limit).cast("int")
    own = F.pmod(F.xxhash64(member), s).cast("int")
    out = df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), s - 1)))
    return out.withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).drop(
        "_own", "_other", "rows")


def _by_group(work, names):
    """Runs ``work`` on each run of equal (group, i, j) of sorted batches; members and links are ids in column ``c``."""
    def run(batches):
        key, rows, out = None, [], []

        def done():
            if len(rows) > 1:
                ids = [r[0] for r in rows]
                for x, y in work(rows):
                    out.append((ids[x], ids[y]))

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("g", "i", "j", "c", *names)]
            for g, i, j, *row in zip(*cols, strict=True):
                if (g, i, j) != key:
                    done()
                    key, rows = (g, i, j), []
                rows.append(row)
            yield _links(out)
            out = []
        done()
        yield _links(out)

    return run


def _links(pairs):
    u, v = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, part): least node that links (u, v) reach, for each node of a link.

    Each round hooks every node that has a smaller neighbour onto the least one, follows the hooks to their ends
    and goes on with the ends; at most half of the nodes of a part are left."""
    pair = (F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = C.stored(links.where("u <> v").select(*pair).distinct(), f"{name}-links")
    label = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("part", F.col("node"))
    while not edges.isEmpty():
        hook = C.stored(edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("to")), f"{name}-hooks")
        while True:
            then = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
            step = hook.join(then, "to", "left").select("node", F.coalesce("next", "to").alias("to"),
                                                        F.col("next").isNotNull().alias("moved"))
            if step.where("moved").isEmpty():
                break
            hook = C.stored(step.drop("moved"), f"{name}-hooks")
        label = C.stored(label.join(hook.withColumnRenamed("node", "part"), "part", "left")
                         .select("node", F.coalesce("to", "part").alias("part")), name)
        ends = edges
        for end in ("u", "v"):
            ends = ends.join(hook.select(F.col("node").alias(end), F.col("to").alias("_to")), end, "left").withColumn(
                end, F.coalesce("_to", end)).drop("_to")
        edges = C.stored(ends.where("u <> v").select(*pair).distinct(), f"{name}-links")
    return label


def _candidates(batches):
    """Links between the classes of each key group, of batches sorted by group."""
    held, rows = [], 0

    def out(t):
        col = lambda c: t.column(c).to_numpy().astype(np.int64)
        c = col("c")
        pairs = candidate_links(col("at"), col("n"), col("pos"), t.column("sketch").to_pylist())
        return _links(sorted({(int(min(c[i], c[j])), int(max(c[i], c[j]))) for i, j in pairs}))

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < RUN:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        at = t.column("at").to_numpy()
        cut = int(np.flatnonzero(at == at[-1])[0])   # the last group may go on
        if cut:
            yield out(t.slice(0, cut))
        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if held:
        yield out(pa.Table.from_batches(held).combine_chunks())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    limit: int = LIMIT, bits: int = BITS, most: int = COMMON) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the least id that links reach."""
    sc = docs.sparkSession.sparkContext
    common = tuple(sc.broadcast(x) for x in common_members(docs, text, shingle, most))
    sig = C.stored(signatures(docs, doc_id, text, shingle, common), "signatures")
    named = sig.where("n > 0 and doc_id is not null")
    classes = C.stored(named.groupBy("a", "b").agg(F.min("doc_id").alias("c"), F.first("n").alias("n"),
                                                   F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "classes")
    shared = C.stored(classes.select(F.explode("keys").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
                      .where("rows > 1"), "shared-keys")
    met = sc.broadcast(C.set_bits(shared, "g", bits))

    def entries(batches):
        for b in (x for b in batches for x in C.row_slices(b, 256)):
            keys = b.column("keys")
            size = np.diff(keys.offsets.to_numpy())
            g = keys.flatten().to_numpy()
            row = np.repeat(np.arange(b.num_rows), size)
            pos = np.arange(len(g)) - np.repeat(np.cumsum(size) - size, size)
            k = np.flatnonzero(met.value.has(g.view(np.uint64)))
            part = b.take(pa.array(row[k]))
            yield pa.RecordBatch.from_arrays([pa.array(g[k]), pa.array(pos[k].astype(np.int32)), part.column("c"), part.column("n")],
                                             names=["g", "pos", "c", "n"])

    hits = classes.select("c", F.col("n").cast("int").alias("n"), "keys").mapInArrow(entries, "g long, pos int, c long, n int")
    # a class stays with a key if the next smaller or larger class of the key has a size that can be linked, and, of
    # two classes alone, if the key can be the first member they share
    sizes = Window.partitionBy("g").orderBy("n", "c")

    def fits(move):
        n, pos = (move(c).over(sizes) for c in ("n", "pos"))
        least = F.ceil(NEED * (F.col("n") + n) / (OF + NEED) - 1e-9)
        first = (F.col("n") - F.col("pos") >= least) & (n - pos >= least)
        alone = move("n", 2).over(sizes).isNull() & (F.lead if move is F.lag else F.lag)("n").over(sizes).isNull()
        return F.coalesce((OF * F.least("n", n) >= NEED * F.greatest("n", n)) & (first | ~alone), F.lit(False))

    hits = C.stored(hits.withColumn("fit", fits(F.lag) | fits(F.lead)).where("fit").drop("fit"), "fitting-keys")
    large = C.stored(hits.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > limit), "large-groups")
    hits = (hits.join(large, "g", "left").withColumn("rows", F.coalesce("rows", F.lit(1)))   # few: the planner sees their size
            .join(classes.select("c", "sketch"), "c"))
    grouped = (_blocks(hits, "g", "c", limit).withColumn("at", F.xxhash64("g", "i", "j"))
               .repartition("at").sortWithinPartitions("at", "c"))
    found = grouped.select("at", "pos", "c", "n", "sketch").mapInArrow(_candidates, "u long, v long")
    cluster = components(found, "clusters")  # node, part

    table = sc.broadcast(C.set_bits(cluster.select(F.xxhash64("node").alias("k")), "k", bits))

    def whole_sets(batches):
        for b in (x for b in batches for x in C.row_slices(b, 1024)):
            p = b.take(pa.array(np.flatnonzero(table.value.has(b.column("k").to_numpy().view(np.uint64)))))
            got = [s.astype("<u8").tobytes() for _, s in _sets(p, "text", shingle)]
            yield pa.RecordBatch.from_arrays([p.column("c"), pa.array(got, pa.binary())], names=["c", "members"])

    ids = C.column(docs, doc_id, "long")
    sets = (docs.where(ids.isNotNull()).select(ids.alias("c"), F.xxhash64(ids).alias("k"), C.column(docs, text).alias("text"))
            .mapInArrow(whole_sets, "c long, members binary"))
    size = cluster.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    placed = cluster.join(size, "part").select(F.col("part").alias("g"), F.col("node").alias("c"), "rows")
    blocks = (_blocks(placed.join(sets, "c"), "g", "c", limit).repartition("g", "i", "j")
              .sortWithinPartitions("g", "i", "j", "c"))

    def verified(rows):
        return exact_links([np.frombuffer(r[1], "<u8") for r in rows])

    links = blocks.select("g", "i", "j", "c", "members").mapInArrow(_by_group(verified, ["members"]), "u long, v long")
    part = components(links, "components")
    of_class = classes.select("a", "b", "c").join(part.withColumnRenamed("node", "c"), "c", "left")
    of_class = of_class.select("a", "b", F.coalesce("part", "c").alias("component_id"))
    linked = named.select("doc_id", "n", "a", "b").join(of_class, ["a", "b"])
    alone = sig.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n", "component_id").unionAll(alone).withColumnRenamed("n", "n_shingles")
