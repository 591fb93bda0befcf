"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``.

Edits are Keep, Rerole, Delete and Insert. The edits in order, as initials, are the conversation's audit; of
cheapest audits the least in ASCII order is taken. A dynamic program reads the rows in order and holds, for
each of four states of the role grammar, the cheapest beginning. Beginnings are not strings but nodes linked
to the node of all letters but the last, so states share what they have in common. Equal costs are decided by
the longest common prefix, found over binary-lifting ancestors; a node is looked up by its rolling hash, and
parent and letter are compared before it is taken for the same (else the next place is tried), so nodes are
equal exactly if their strings are.

Rows are dealt by conversation and sorted by Spark, which spills; duplicates are found by a window over the
same deal. A task streams them: letters that all states share are settled, their rows hashed and let go.
States whose cost is more than ``FAR`` above the cheapest cannot win any more (two insertions and a deletion
stand in for anything they may save), so what is held does not follow the conversation's length. The repaired
conversation is one SHA-256 stream and its audit one string, so one task has to pass over it.

Defined results: a null role or text is one blank, a null turn comes first and does not count for gaps, null
``conv_id`` is a conversation of its own. Rows of one turn go by role and text. A role without the initial s,
u or a cannot be kept. Repeated rows are duplicates. Empty tables give no rows. Texts are read whole. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm import common as C

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = 2 * INSERT + DELETE
#: Nodes after which settled letters are let go.
NODES = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role's initial, by state.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_BASE, _MOD = 1_000_003, (1 << 61) - 1
_INK = r"[^\x20\x09-\x0D]"


class Audits:
    """Strings as linked nodes: node 0 is empty, every other is its parent's string and a letter."""

    def __init__(self):
        self.up, self.letter, self.depth, self.hash, self.at = [[]], [""], [0], [0], {}

    def __len__(self):
        return len(self.letter)

    def add(self, node: int, letter: str) -> int:
        """The node of ``node``'s string and ``letter``."""
        h = (self.hash[node] * _BASE + ord(letter)) % _MOD
        place = h
        while (held := self.at.get(place)) is not None:
            if self.letter[held] == letter and self.up[held][0] == node:
                return held
            place += 1   # another string with this hash
        new = self.at[place] = len(self.letter)
        up, j = [node], 0
        while j < len(self.up[up[j]]):   # the ancestor 2**(j+1) letters up
            up.append(self.up[up[j]][j])
            j += 1
        self.up.append(up)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(h)
        return new

    def lift(self, node: int, depth: int) -> int:
        """The first ``depth`` letters of the node's string."""
        while self.depth[node] > depth:
            node = self.up[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def common(self, a: int, b: int) -> tuple[int, int, int]:
        """Longest common prefix of two nodes, and the nodes one letter on (-1 at a string's end)."""
        least = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, least), self.lift(b, least)
        if x == y:
            return x, *(self.lift(n, least + 1) if self.depth[n] > least else -1 for n in (a, b))
        for j in range(len(self.up[x]) - 1, -1, -1):
            if j < len(self.up[x]) and self.up[x][j] != self.up[y][j]:
                x, y = self.up[x][j], self.up[y][j]
        return self.up[x][0], x, y

    def less(self, a: int, b: int) -> bool:
        """Whether a's string comes before b's."""
        if a == b:
            return False
        _, x, y = self.common(a, b)
        return y >= 0 and (x < 0 or self.letter[x] < self.letter[y])

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.nodes, self.best = Audits(), {START: (0, 0)}
        self.rows, self.state, self.first = [], START, True
        self.audit, self.sha = [], hashlib.sha256()

    def _offer(self, to: dict, state: int, cost: int, node: int, letter: str):
        held = to.get(state)
        if held is not None and held[0] < cost:
            return
        new = self.nodes.add(node, letter)
        if held is None or cost < held[0] or self.nodes.less(new, held[1]):
            to[state] = (cost, new)

    def _insert(self, to: dict):
        """Empty user or assistant rows before the next row; never more than one of each pays."""
        for role in "ua":
            for state, after in _AFTER[role].items():
                if state in to:
                    cost, node = to[state]
                    self._offer(to, after, cost + INSERT, node, "I")

    def row(self, role: str, text: str, must_go: bool, truncated: bool):
        """The next row; ``must_go`` if blank or a duplicate."""
        self.rows.append((role, text))
        self._insert(self.best)
        to, more = {}, TRUNCATED if truncated else 0
        for state, (cost, node) in self.best.items():
            self._offer(to, state, cost + DELETE, node, "D")
            if must_go:
                continue
            for initial in "sua":
                after = _AFTER[initial].get(state)
                if after is None:
                    continue
                if role[:1] == initial:
                    self._offer(to, after, cost + KEEP + more, node, "K")
                elif initial != "s":
                    self._offer(to, after, cost + REROLE + more, node, "R")
        least = min(c for c, _ in to.values())
        self.best = {s: v for s, v in to.items() if v[0] <= least + FAR}
        if len(self.nodes) > NODES:
            self._settle()

    def _settle(self):
        """Let go of the letters that all states share, and of what no state uses."""
        ends = [n for _, n in self.best.values()]
        shared = ends[0]
        for n in ends[1:]:
            shared = self.nodes.common(shared, n)[0]
        done = self.nodes.text(shared)
        rest = {s: (c, self.nodes.text(n)[len(done):]) for s, (c, n) in self.best.items()}
        self._emit(done)
        self.nodes = Audits()
        for s, (c, text) in rest.items():
            node = 0
            for letter in text:
                node = self.nodes.add(node, letter)
            self.best[s] = (c, node)

    def _emit(self, letters: str):
        """Apply settled edits: what stays goes into the hash."""
        self.audit.append(letters)
        at = 0
        for x in letters:
            if x == "I":
                role = text = ""
            else:
                role, text = self.rows[at]
                at += 1
                if x == "D":
                    continue
            if x != "K":
                role = "assistant" if self.state == USER else "user"
            self.state = _AFTER[role[0]][self.state]
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False
        del self.rows[:at]

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and SHA-256 of the repaired rows."""
        self._insert(self.best)
        cost, node = min((self.best[s] for s in (START, ASSISTANT) if s in self.best), key=lambda v: v[0])
        for s in (START, ASSISTANT):
            held = self.best.get(s)
            if held is not None and held[0] == cost and self.nodes.less(held[1], node):
                node = held[1]
        self._emit(self.nodes.text(node))
        return cost, "".join(self.audit), self.sha.hexdigest()


_OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


class _Conversation:
    """Counts and repair of one conversation."""

    def __init__(self, conv):
        self.conv, self.repair, self.last = conv, Repair(), None
        self.least = self.most = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn, role, text, blank, again, cut):
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        again, cut = again and not blank, cut and not blank and not again
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + again, self.truncated + cut
        if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = role[:1]
        self.repair.row(role, text, blank or again, cut)

    def out(self):
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.end())


def _repaired(batches):
    now, begun, done = None, False, []

    def out():
        cols = zip(*done, strict=True)
        kinds = [pa.string() if c in ("audit", "repaired_sha256") else pa.int64() for c in _NAMES]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=_NAMES)

    for batch in batches:
        for b in C.row_slices(batch):
            for conv, there, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not begun or conv != now.conv:
                    if begun:
                        done.append(now.out())
                    now, begun = _Conversation(conv), True
                if there:
                    now.row(*row)
            if len(done) >= 512:
                yield out()
                done.clear()
    if begun:
        done.append(now.out())
    if done:
        yield out()


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults that depend on ``conv_id:turn`` alone; ``there`` is false for a row that was dropped.

    By CRC-32 modulo 20: 0 dropped, 1 without text, 2 without its ``[.!?]``, 3 twice, 4 said by the user."""
    col = lambda n, kind: C.column(conversations, n, kind)
    shown = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = conversations.select(col("conv_id", "long").alias("conv_id"), col("turn", "long").alias("turn"),
                                shown(col("role", "string")).alias("role"), shown(col("text", "string")).alias("text"))
    kind = F.crc32(F.encode(F.concat(shown(F.col("conv_id")), F.lit(":"), shown(F.col("turn"))), "UTF-8")) % 20
    rows = rows.withColumn("kind", kind)
    text = F.when(F.col("kind") < 2, "").when(F.col("kind") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("there"),
                       copies.alias("copy")).drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text; optional ``there``, false where only the
    conversation's id counts): faults, cost, audit, hash of the repaired rows.

    The window and the sort use the one exchange by ``conv_id``."""
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    r = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                    there.alias("there")).repartition("conv_id")
    same = Window.partitionBy("conv_id", "there", "role", "text").orderBy("turn")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    r = r.select("conv_id", "there", "turn", "role", "text", (~F.col("text").rlike(_INK)).alias("blank"),
                 (F.row_number().over(same) > 1).alias("again"), (~last.isin(".", "!", "?")).alias("cut"))
    return r.sortWithinPartitions("conv_id", "turn", "role", "text", "again").mapInArrow(_repaired, _OUT)
