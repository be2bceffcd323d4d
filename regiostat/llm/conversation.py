"""Operator 11: repair the structure of conversations, with an audit of the edits.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Rows may be
kept (0), given the role user or assistant (Rerole, 1) or deleted (2), and
empty rows of either role may be inserted anywhere (5); a truncated row that
stays costs 5 more, a blank or duplicate one must go.  The cheapest edits win,
and of these the ones whose initials in order come first in ASCII.

The rows of a conversation are read in order by one dynamic program over four
states: nothing yet, after ``s``, after ``u``, after ``a``.  The edits that
lead to a state are a node linked to the node of the edits before, so states
share their prefixes.  A node also has a rolling hash of its whole string and
a jump pointer (binary lifting in its skew form: one ancestor a node, any
ancestor in logarithmic time).  Of two equally cheap ways the less string is
found by searching their longest common prefix through hashes of ancestors;
the prefix is then compared letter by letter, up to the first node that both
share or that was compared before, so a collision of hashes changes nothing.

A state that costs more than another one plus the edits that lead from there
is dropped.  What all states have in common is written out and its nodes are
freed, so the memory of a conversation follows the stretch that is still
open, not its length.  Every state carries the digest of the repaired text so
far, which can be copied; texts are never held.

Spark sorts and streams the conversations: rows are dealt by conversation, so
one conversation is read by one task (its digest is one sequential hash), by
way of Spark's sort that spills.  Duplicates are found by a window of Spark.

Defined cases: rows of one turn go by role and text, null turns first; a null
role or text is one blank; null conv_id is a conversation of its own; repeated
rows are rows; a conversation without live rows has zeros, an empty audit and
the digest of an empty text; a role that begins with no letter of s, u, a can
be reroled or deleted only; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an initial leads, by state; a kept ``s`` only opens a conversation.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The one role that may follow a state.
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: ``ENOUGH[p][q]``: whatever comes after q can come after p at so much more at most.
ENOUGH = [[0, 0, 5, 0], [10, 0, 5, 10], [7, 5, 0, 5], [2, 0, 5, 0]]
#: Nodes beyond twice those in use before unused ones are freed.
SPARE = 4096
#: Rows turned into Python values at once.
ROWS = 512
_BASE, _PRIME = 1_000_003, (1 << 61) - 1

REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


class Audits:
    """Strings as linked nodes; node 0 is the string ``done``."""

    def __init__(self, base: int = _BASE, prime: int = _PRIME):
        self.base, self.prime = base, prime
        self.done = bytearray()
        self._reset()

    def _reset(self) -> None:
        self.parent, self.letter, self.depth = [0], bytearray(b"\0"), [0]
        self.hash, self.jump, self.same = [0], [0], [0]

    def add(self, p: int, letter: int) -> int:
        self.parent.append(p)
        self.letter.append(letter)
        self.depth.append(self.depth[p] + 1)
        self.hash.append((self.hash[p] * self.base + letter) % self.prime)
        j = self.jump[p]
        jj = self.jump[j]
        self.jump.append(jj if self.depth[p] - self.depth[j] == self.depth[j] - self.depth[jj] and p else p)
        node = len(self.parent) - 1
        self.same.append(node)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            j = self.jump[node]
            node = j if self.depth[j] >= depth else self.parent[node]
        return node

    def _one(self, node: int) -> int:
        """The node that stands for all nodes found to hold the same string."""
        same = self.same
        while same[node] != node:
            same[node] = same[same[node]]
            node = same[node]
        return node

    def _first_difference(self, x: int, y: int) -> tuple[int, int] | None:
        """The shallowest ancestors of two nodes of one depth that end in different letters."""
        at_x, at_y, found = x, y, None
        while self._one(x) != self._one(y):
            if self.letter[x] != self.letter[y]:
                found = x, y
            x, y = self.parent[x], self.parent[y]
        if found is None:
            self.same[self._one(at_y)] = self._one(at_x)
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        h, parent, jump = self.hash, self.parent, self.jump
        if h[x] == h[y]:
            found = self._first_difference(x, y)
            if found is None:  # one string begins with the other
                return self.depth[a] < self.depth[b]
        else:
            while True:  # strings differ at x, y: find the last place up from which they agree
                if h[jump[x]] != h[jump[y]]:
                    x, y = jump[x], jump[y]
                elif h[parent[x]] != h[parent[y]]:
                    x, y = parent[x], parent[y]
                else:
                    break
            found = self._first_difference(parent[x], parent[y]) or (x, y)
        return self.letter[found[0]] < self.letter[found[1]]

    def text(self, node: int) -> str:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return (self.done + out[::-1]).decode()

    def freed(self, live: list[int | None]) -> list[int | None]:
        """Write out what all live strings share, drop nodes that none of them needs, and renumber."""
        tips = [n for n in live if n is not None]
        needed = set()
        for n in tips:
            while n not in needed:
                needed.add(n)
                n = self.parent[n]
        order = sorted(needed)  # parents come before their children
        children = dict.fromkeys(order, 0)
        for n in order:
            if n:
                children[self.parent[n]] += 1
        root, stop, follow = 0, set(tips), {self.parent[n]: n for n in order if n}
        while children[root] == 1 and root not in stop:
            root = follow[root]
            self.done.append(self.letter[root])
        parent, letter = self.parent, self.letter
        self._reset()
        new = {root: 0}
        for n in order:
            if n > root:
                new[n] = self.add(new[parent[n]], letter[n])
        return [None if n is None else new[n] for n in live]


class Conversation:
    """The dynamic program over one conversation, row by row."""

    def __init__(self, audits: Audits | None = None):
        self.audits = audits or Audits()
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = self.last = None
        self.turns = 0
        self.spare = SPARE
        self.cost: list[int | None] = [0, None, None, None]
        self.node: list[int | None] = [0, None, None, None]
        self.digest = [hashlib.sha256(), None, None, None]
        self._insert()

    def _settle(self, ways: list[list]) -> None:
        """Take the best way (cost, state before, letter, emitted row) to each state; ties by their strings."""
        cost, node, digest = [None] * 4, [None] * 4, [None] * 4
        for q, found in enumerate(ways):
            if not found:
                continue
            least = min(w[0] for w in found)
            best = best_node = None
            for way in found:
                if way[0] == least:
                    n = self.audits.add(self.node[way[1]], way[2])
                    if best is None or self.audits.less(n, best_node):
                        best, best_node = way, n
            _, before, _, emitted = best
            cost[q], node[q] = least, best_node
            digest[q] = self._emit(before, emitted)
        self.cost, self.node, self.digest = cost, node, digest

    def _emit(self, before: int, emitted: bytes | None):
        if emitted is None:
            return self.digest[before]
        out = self.digest[before].copy()
        if before != START:
            out.update(b"\n")
        out.update(emitted)
        return out

    def _insert(self) -> None:
        for target, sources, emitted in ((USER, (START, SYSTEM, ASSISTANT), b"user:"), (ASSISTANT, (USER,), b"assistant:")):
            for q in sources:
                if self.cost[q] is None:
                    continue
                c, old = self.cost[q] + INSERT, self.cost[target]
                if old is not None and c > old:
                    continue
                n = self.audits.add(self.node[q], ord("I"))
                if old is None or c < old or self.audits.less(n, self.node[target]):
                    self.cost[target], self.node[target], self.digest[target] = c, n, self._emit(q, emitted)

    def _prune(self) -> None:
        cost = self.cost
        for q in range(4):
            if cost[q] is not None and any(c is not None and cost[q] > c + ENOUGH[p][q] for p, c in enumerate(cost)):
                self.cost[q] = self.node[q] = self.digest[q] = None
        if len(self.audits.parent) > self.spare:
            self.node = self.audits.freed(self.node)
            self.spare = 2 * len(self.audits.parent) + SPARE

    def row(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = self.high = turn
            self.turns += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        bare = text.strip(BLANKS)
        more = 0
        if not bare:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif bare[-1] not in ".!?":
            self.truncated += 1
            more = TRUNCATED
        ways: list[list] = [[], [], [], []]
        row = f":{text}".encode("utf-8", "surrogatepass")
        for q, c in enumerate(self.cost):
            if c is None:
                continue
            ways[q].append((c + DELETE, q, ord("D"), None))
            if not bare or again:
                continue
            kept = KEPT.get(initial, {}).get(q)
            if kept is not None:
                ways[kept].append((c + KEEP + more, q, ord("K"), role.encode("utf-8", "surrogatepass") + row))
            to, name = NEXT[q]
            if kept != to:
                ways[to].append((c + REROLE + more, q, ord("R"), name.encode() + row))
        self._settle(ways)
        self._insert()
        self._prune()

    def report(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = [q for q in (START, ASSISTANT) if self.cost[q] is not None]
        least = min(self.cost[q] for q in ends)
        ends = [q for q in ends if self.cost[q] == least]
        best = ends[0]
        if len(ends) > 1 and self.audits.less(self.node[ends[1]], self.node[best]):
            best = ends[1]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, least,
                self.audits.text(self.node[best]), self.digest[best].hexdigest())


def _repaired(batches):
    """Reports of the conversations of a partition that is sorted by conversation and place."""
    names = [c.split()[0] for c in REPORT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    out, held, conv, conv_id = [], 0, None, None

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            for key, turn, role, text, live, again in zip(*(c.to_pylist() for c in part.columns)):
                if conv is None or key != conv_id:
                    if conv is not None:
                        out.append((conv_id, *conv.report()))
                        held += len(out[-1][-2])
                        if len(out) >= ROWS or held > 1 << 22:
                            yield batch()
                            out, held = [], 0
                    conv, conv_id = Conversation(), key
                if live:
                    conv.row(turn, role, text, again)
    if conv is not None:
        out.append((conv_id, *conv.report()))
    if out:
        yield batch()


def _live(rows: DataFrame) -> DataFrame:
    live = F.coalesce("live", F.lit(True)) if "live" in rows.columns else F.lit(True)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       live.alias("live"))


PLACE = ["live", "turn", "role", "text", "again"]


def _again() -> Column:
    # conversations are dealt already, so this window and the sort after it move nothing
    return F.row_number().over(Window.partitionBy("conv_id", "role", "text", "live").orderBy("turn")) > 1


def repair(rows: DataFrame) -> DataFrame:
    """One report a conversation of ``rows`` (conv_id, turn, role, text, and ``live`` if some only name a conversation)."""
    dealt = _live(rows).repartition("conv_id").withColumn("again", _again())
    ordered = dealt.sortWithinPartitions("conv_id", *PLACE)
    return ordered.mapInArrow(_repaired, REPORT)


def repaired_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), role, text, edit (K, R or I).

    Letters of an audit meet the rows in order; roles follow from the end, as
    a repaired conversation ends with an assistant.
    """
    by_conv = Window.partitionBy("conv_id")
    live = _live(rows).where("live").withColumn("again", _again())
    live = live.withColumn("n", F.row_number().over(by_conv.orderBy(*PLACE)))
    letters = report.select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).where("edit <> ''")
    letters = letters.withColumn("n", F.sum((F.col("edit") != "I").cast("int")).over(by_conv.orderBy("at")))
    letters = letters.where("edit <> 'D'").withColumns({
        "place": F.row_number().over(by_conv.orderBy("at")), "from_end": F.row_number().over(by_conv.orderBy(F.desc("at")))})
    letters = letters.withColumnsRenamed({"conv_id": "c", "n": "m"})
    joined = letters.join(live, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("m") == F.col("n"))
                          & (F.col("edit") != "I"), "left")
    other = F.when(F.col("from_end") % 2 == 1, "assistant").otherwise("user")
    return joined.select(F.col("c").alias("conv_id"), F.col("place").cast("long").alias("place"),
                         F.when(F.col("edit") == "K", F.col("role")).otherwise(other).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"), "edit")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with reproducible faults; a dropped row stays with ``live`` false, to name its conversation.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?``, 3 repeats it, 4 gives it the role user.
    """
    text_of = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(text_of["conv_id"], F.lit(":"), text_of["turn"])) % 20
    text = (F.when(fault.isin(0, 1), F.lit("")).when(fault == 2, F.translate(text_of["text"], ".!?", ""))
             .otherwise(text_of["text"]))
    role = F.when(fault == 4, F.lit("user")).otherwise(text_of["role"])
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("live"),
                      F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"))
    return out.drop("copy")
