"""Repair of conversations: the cheapest edits that make roles alternate, with a record of them.

Every row is a symbol, its role and what is wrong with it. Blocks of a
conversation's symbols are compressed together, of all conversations that a task
sees, by one Re-Pair grammar. An edit takes a row from one of four states of the
wanted order to another, so a symbol is a min-plus matrix over the states; its
entries are a cost and a rope of edits. A rule's matrix is the product of those of
its two symbols, made once, bottom-up, for all places where the rule stands.

Ropes of equal cost compare by their letters. Over the same rows none of two such
ropes begins the other (each row has one letter besides insertions, which cost), so
the least of a product is the product of the leasts.

Blocks of a conversation meet as their matrices only: one pass from its end gives
what the rest costs from each state, one from its start picks the edits. Both
stream, as does the text, so no task holds a conversation. A digest of a whole
conversation reads it in order, which one task does; what it reads are blocks and
packed rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barline.llm.common import ranked
from barline.sources.tables import stage

#: Rows in a block, and bytes after which packed rows of a block are cut.
BLOCK = 256
PACK_BYTES = 1 << 14
#: Symbols that one grammar is made for.
GRAMMAR_SYMBOLS = 1 << 16
BLANKS = " \t\n\v\f\r"

# States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row; 0 and 3 may end.
START, ENDS = 0, {0: "", 1: "II", 2: "I", 3: ""}
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = 4
#: What Rerole and Insert make of a row in each state, and the state they lead to.
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
RETYPE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Symbols: roles that are whole, the same cut short, and rows that have to go.
SYMBOLS = "suaoSUAOx"


class Rope:
    """A text as the sum of two; joined when it is read, which a block's length bounds."""

    __slots__ = ("left", "right", "whole")

    def __init__(self, left: Rope | None, right: Rope | None, whole: str | None = None) -> None:
        self.left, self.right, self.whole = left, right, whole

    def __str__(self) -> str:
        if self.whole is None:
            self.whole = str(self.left) + str(self.right)
        return self.whole


#: [from][to]: (cost, rope), or None where no edits lead there.
Matrix = list[list[tuple[int, Rope] | None]]


def _better(a, b):
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if str(a[1]) <= str(b[1]) else b


def _terminal(symbol: str) -> Matrix:
    """Insertions before the row, then what becomes of the row."""
    cut = CUT if symbol in "SUAO" else 0
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        at, inserted = i, ""
        for _ in range(STATES):
            edits = [(at, DELETE, "D")]
            if symbol != "x":
                edits.append((WANTED[at][1], RETYPE + cut, "R"))
                if (to := NEXT.get((at, symbol.lower()))) is not None:
                    edits.append((to, cut, "K"))
            for to, cost, letter in edits:
                out[i][to] = _better(out[i][to], (cost + INSERT * len(inserted), Rope(None, None, inserted + letter)))
            at, inserted = WANTED[at][1], inserted + "I"
    return out


def _product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for j in range(STATES):
            for k in range(STATES):
                x, y = a[i][k], b[k][j]
                if x is not None and y is not None and (out[i][j] is None or x[0] + y[0] <= out[i][j][0]):
                    out[i][j] = _better(out[i][j], (x[0] + y[0], Rope(x[1], y[1])))
    return out


def re_pair(texts: list[list[int]], first: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Texts shortened by rules, and the rules: ``first`` + n stands for the n-th pair.

    The pair with most places (ties: the smallest) becomes a symbol until none has two
    places that do not overlap. Places are kept in linked lists, so all of it costs
    about as much as the texts are long.
    """
    symbols: list[int | None] = []
    for t in texts:
        symbols.extend([*t, None])
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], set[int]] = defaultdict(set)

    def pair(at: int) -> tuple[int, int] | None:
        if at < 0 or symbols[at] is None or after[at] >= n or symbols[after[at]] is None:
            return None
        return symbols[at], symbols[after[at]]

    for at in range(n):
        if (p := pair(at)) is not None:
            places[p].add(at)
    queue = [(-len(s), p) for p, s in places.items() if len(s) > 1]
    heapq.heapify(queue)
    rules: list[tuple[int, int]] = []
    while queue:
        number, p = heapq.heappop(queue)
        if len(places.get(p, ())) != -number:
            if len(places.get(p, ())) > 1:
                heapq.heappush(queue, (-len(places[p]), p))
            continue
        stand, taken, last = sorted(places[p]), [], -1
        for at in stand:
            if at != last:  # not the second symbol of the place before
                taken.append(at)
                last = after[at]
        if len(taken) < 2:
            places.pop(p)
            continue
        symbol, touched = first + len(rules), set()
        rules.append(p)
        for at in taken:
            right = after[at]
            for old in (before[at], at, right):
                if (q := pair(old)) is not None:
                    places[q].discard(old)
            symbols[at] = symbol
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            symbols[right] = None
            for new in (before[at], at):
                if (q := pair(new)) is not None:
                    places[q].add(new)
                    touched.add(q)
        for q in touched:
            if len(places[q]) > 1:
                heapq.heappush(queue, (-len(places[q]), q))
    out, at = [], 0
    for t in texts:
        end, short = at + len(t), []
        while at < end:
            short.append(symbols[at])
            at = after[at]
        out.append(short)
        at = end + 1
    return out, rules


def solved(sequences: list[str]) -> dict[str, Matrix]:
    """The matrix of each distinct sequence of symbols, by one grammar for all of them."""
    distinct = sorted(set(sequences))
    short, rules = re_pair([[SYMBOLS.index(c) for c in s] for s in distinct], len(SYMBOLS))
    matrices = [_terminal(c) for c in SYMBOLS]
    for a, b in rules:
        matrices.append(_product(matrices[a], matrices[b]))
    out = {}
    for text, row in zip(distinct, short):
        parts = [matrices[s] for s in row]
        while len(parts) > 1:  # in pairs, so that ropes stay flat
            parts = [_product(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        out[text] = parts[0]
    return out


BLOCK_FIELDS = (
    "block long, kind int, at long, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, "
    "illegal long, opens string, closes string, first_turn long, last_turn long, turns long, togo array<long>, "
    "roles array<string>, texts array<string>"
)


def _solve(batches) -> Iterator[list[dict]]:
    """Rows (conv, block, turn, symbol of the role, fault), in order, to one row per block."""
    held: list[tuple] = []
    here, roles, faults, turns = None, "", "", []

    def flush() -> list[dict]:
        found, out = solved([h[2] for h in held]), []
        for conv, block, sequence, roles, faults, turns in held:
            entries = [e for row in found[sequence] for e in row]
            known = [t for t in turns if t is not None]
            out.append(dict(
                conv=conv, block=block, kind=0, at=-1, costs=[None if e is None else e[0] for e in entries],
                audits=[None if e is None else str(e[1]) for e in entries], blank=faults.count("b"),
                duplicate=faults.count("d"), truncated=faults.count("t"),
                illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), opens=roles[0], closes=roles[-1],
                first_turn=known[0] if known else None, last_turn=known[-1] if known else None, turns=len(set(known)),
            ))
        held.clear()
        return out

    symbols = 0
    for b in batches:
        for conv, block, turn, role, fault in zip(*(b.column(c).to_pylist() for c in ("conv", "block", "turn", "role", "fault"))):
            if here != (conv, block):
                if here is not None:
                    held.append((*here, _sequence(roles, faults), roles, faults, turns))
                    symbols += len(roles)
                    if symbols >= GRAMMAR_SYMBOLS:
                        yield flush()
                        symbols = 0
                here, roles, faults, turns = (conv, block), "", "", []
            roles, faults = roles + role, faults + fault
            turns.append(turn)
    if here is not None:
        held.append((*here, _sequence(roles, faults), roles, faults, turns))
        yield flush()


def _sequence(roles: str, faults: str) -> str:
    return "".join("x" if f in "bd" else r.upper() if f == "t" else r for r, f in zip(roles, faults))


class Walk:
    """One conversation, block after block: the edits picked and the rows that they leave."""

    def __init__(self, conv) -> None:
        self.conv, self.state, self.cost, self.at, self.tail = conv, START, 0, START, 0
        self.counts = dict(blank=0, duplicate=0, truncated=0, illegal=0)
        self.audit: list[str] = []
        self.letters: Iterator[str] = iter("")
        self.closes = self.first = self.last = None
        self.turns = 0
        self.any = False

    def block(self, row: dict) -> None:
        """Of the ends from which the rest is cheapest, the one whose edits come first."""
        ways = []
        for j in range(STATES):
            cost = row["costs"][self.state * STATES + j]
            if cost is not None and row["togo"][j] is not None:
                ways.append((cost + row["togo"][j], row["audits"][self.state * STATES + j], j, cost))
        _, audit, self.state, cost = min(ways)
        self.cost += cost
        self.audit.append(audit)
        self.letters = iter(audit)
        for name in self.counts:
            self.counts[name] += row[name]
        if self.any and self.closes + row["opens"] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.any, self.closes = True, row["closes"]
        if row["turns"]:
            self.turns += row["turns"] - (self.last is not None and self.last == row["first_turn"])
            self.first = row["first_turn"] if self.first is None else self.first
            self.last = row["last_turn"]

    def rows(self, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
        """The rows (edit, role, text) that are left of some rows of the block, with those inserted before."""
        for role, text in zip(roles, texts):
            while (letter := next(self.letters)) == "I":
                yield self._insert()
            if letter == "K":
                self.at = NEXT[self.at, role[:1]]
                yield "K", role, text
            elif letter == "R":
                role, self.at = WANTED[self.at]
                yield "R", role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        self.audit.append(ENDS[self.at])
        self.cost += INSERT * len(ENDS[self.at])
        for _ in ENDS[self.at]:
            yield self._insert()

    def _insert(self) -> tuple[str, str, str]:
        role, self.at = WANTED[self.at]
        return "I", role, ""

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


class Repaired(NamedTuple):
    """``report``: a row per conversation; ``turns``: the rows of the repaired conversations."""

    report: DataFrame
    turns: DataFrame


def _walks(batches) -> Iterator[tuple[Walk, Iterator[tuple[str, str, str]], bool]]:
    """For each arriving row the conversation, the rows it adds, and whether that was its last."""
    walk = None
    for b in batches:
        for row in b.to_pylist():
            if walk is None or walk.conv != row["conv"]:
                if walk is not None:
                    yield walk, walk.end(), True
                walk = Walk(row["conv"])
            if row["block"] < 0:
                continue
            if row["kind"] == 0:
                walk.block(row)
            else:
                yield walk, walk.rows(row["roles"], row["texts"]), False
    if walk is not None:
        yield walk, walk.end(), True


def role_class(role: Column) -> Column:
    """s, u or a for roles that begin so, o for others."""
    return F.when(F.substring(role, 1, 1).isin("s", "u", "a"), F.substring(role, 1, 1)).otherwise(F.lit("o"))


def repair(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    all_ids: DataFrame | None = None,
) -> Repaired:
    """Conversations brought to ``(system? (user assistant)+)?`` at least cost.

    Keeping a row costs 0, another role (user or assistant) 2, deleting 3, an empty
    user or assistant row inserted anywhere 2; a row that stays but is cut short (its
    last character is no ``.!?``) 1 more. Blank rows and rows whose role and text stood
    earlier have to go. Of edits that cost the same, the letters (K, R, D, I) that sort
    first are taken.

    ``report`` has ``conv_id``, ``gaps`` (turn numbers missing between the first and the last), ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (neighbours whose roles do not follow one
    another), ``cost``, ``audit`` (the letters), ``repaired_sha256``; ``turns`` has ``conv_id``, ``place``, ``edit``,
    ``role``, ``text``.

    Rows are taken by turn, NULL first, ties by the digest of role and text. A NULL role or text
    counts as one blank; NULL turns are left out of ``gaps``; a NULL id is a
    conversation of its own. ``all_ids`` (one column) adds conversations that may have no
    rows: zeros, an empty audit, the digest of nothing. Rows that repeat each other are
    rows each, the later ones duplicates. An empty table gives no rows. Columns besides
    those named are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    same = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    read = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        same.alias("same"),
    )
    rows = ranked(read, "conv", ["turn", "same"], "turns-in-order")
    kind = read.schema["conv"].dataType.simpleString()

    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = rows.select(
        "conv", "rank", "turn", role_class(F.col("role")).alias("role"), "same",
        F.when(ended == "", "b").when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), "t").otherwise("-").alias("fault"),
    )
    seen = narrow.filter("fault <> 'b'").groupBy(F.col("conv").alias("_conv"), F.col("same").alias("_same"))
    seen = seen.agg(F.min("rank").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    told = narrow.join(seen, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    again = (F.col("rank") > F.col("_first")) & (F.col("fault") != "b")
    told = told.select(
        "conv", F.floor(F.col("rank") / BLOCK).alias("block"), "rank", "turn", "role", F.when(again, "d").otherwise(F.col("fault")).alias("fault"),
    )
    schema = T.StructType.fromDDL(f"conv {kind}, {BLOCK_FIELDS}")
    names, arrow = schema.names, to_arrow_schema(schema)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], f.type) for n, f in zip(names, arrow)], names)

    def solve(batches):
        for found in _solve(batches):
            yield batch_of(found)

    blocks = told.repartition("conv", "block").sortWithinPartitions("conv", "block", "rank").mapInArrow(solve, schema)

    def from_end(batches):
        last, togo = None, None
        for b in batches:
            out = b.to_pylist()
            for row in out:
                if last is None or last != (row["conv"],):
                    last, togo = (row["conv"],), [INSERT * len(ENDS[s]) for s in range(STATES)]
                row["togo"] = togo
                costs = row["costs"]
                ways = [[costs[i * STATES + j] + togo[j] for j in range(STATES) if costs[i * STATES + j] is not None] for i in range(STATES)]
                togo = [min(w) for w in ways]
            yield batch_of(out)

    blocks = blocks.repartition("conv").sortWithinPartitions("conv", F.desc("block")).mapInArrow(from_end, schema)

    def pack(batches):
        """Rows of a block that follow one another in a file, as one row."""
        for b in batches:
            out, here, size = [], None, 0
            for conv, at, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "rank", "role", "text"))):
                if here != (conv, at) or at % BLOCK == 0 or size > PACK_BYTES:
                    out.append(dict(conv=conv, block=at // BLOCK, kind=1, at=at, roles=[], texts=[]))
                    size = 0
                out[-1]["roles"].append(role)
                out[-1]["texts"].append(text)
                here, size = (conv, at + 1), size + len(text)
            yield batch_of(out)

    packs = rows.select("conv", "rank", "role", "text").mapInArrow(pack, schema)
    ids = turns.select(F.col(conv_col).alias("conv")) if all_ids is None else all_ids.toDF("conv")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[4:]]
    marks = ids.distinct().select("conv", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("at"), *missing)
    met = stage(marks.unionByName(blocks).unionByName(packs), "conversation-blocks")
    ordered = met.repartition("conv").sortWithinPartitions("conv", "block", "kind", "at")

    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    types = (arrow[0].type, *[pa.int64()] * 6, pa.string(), pa.string())

    def report(batches):
        sha, begun, out, held = hashlib.sha256(), False, [], 0
        for walk, left, last in _walks(batches):
            for _, role, text in left:
                sha.update((b"\n" if begun else b"") + f"{role}:{text}".encode())
                begun = True
            if last:
                out.append((walk.conv, walk.gaps, *walk.counts.values(), walk.cost, "".join(walk.audit), sha.hexdigest()))
                sha, begun, held = hashlib.sha256(), False, held + len(out[-1][7])
            if len(out) == 4096 or held > 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], columns)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], columns)

    turn_types = (arrow[0].type, pa.int64(), pa.string(), pa.string(), pa.string())

    def turned(batches):
        place, out, held = 0, [], 0
        for walk, left, last in _walks(batches):
            for row in left:
                out.append((walk.conv, place, *row))
                place, held = place + 1, held + len(row[2]) + 32
            place = 0 if last else place
            if held > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), turn_types)], ["conv_id", "place", "edit", "role", "text"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), turn_types)], ["conv_id", "place", "edit", "role", "text"])

    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return Repaired(
        ordered.mapInArrow(report, f"conv_id {kind}, {counts}"),
        ordered.mapInArrow(turned, f"conv_id {kind}, place long, edit string, role string, text string"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows spoiled by crc32 of ``conv_id:turn`` modulo 20: 0 drops, 1 empties, 2 takes the ends of sentences, 3 repeats, 4 makes it the user's.

    A NULL is one blank, in the hashed text as in role and text; ids and turns stay as they are.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")), F.lit(20)).alias("fate"))
    rows = rows.filter("fate <> 0").withColumn("nth", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
