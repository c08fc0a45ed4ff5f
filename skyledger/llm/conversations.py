"""Repair of conversations: the cheapest edits after which system, user and assistant alternate.

A conversation's rows are read in order by a machine of four states; deleting, keeping,
changing and inserting rows have costs. Of equally cheap lists of edits (audits) the one
first in ASCII order counts. Audits are not spelled out while they grow: they are nodes
that share their beginnings, and two of them are compared by searching the end of what
they have in common.

Rows are ordered over all tasks by conversation and turn, so a long conversation, or the
rows without conversation, are cut over tasks. Conversations within a task are finished
there. For the others a task gives, per stretch of rows and pair of states, the cheapest
way from one to the other; the same search over stretches then picks the ways.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

#: Rows and characters that are worked on together; longer conversations are cut there.
STRETCH_ROWS, STRETCH_CHARACTERS = 4096, 4 << 20
#: Costs of edits, role initials that may follow one another, blank signs.
RETYPE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
LEGAL = frozenset(("su", "ua", "au"))
BLANKS = " \t\n\x0b\x0c\r"
#: States by the role last left standing: none, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after the next user or assistant row, and what closes a conversation.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
CLOSING = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
#: Modulus and base of the rolling hashes.
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51

FACTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = ("conv_id", "gaps", *FACTS, "cost", "audit", "repaired_sha256")


class Audits:
    """Lists of edits as nodes: a parent and the piece added to it. Compared nodes are
    equally deep, as each level adds what is done up to the same row."""

    def __init__(self, base: int = BASE, prime: int = PRIME):
        self.base, self.prime = base, prime
        self.pieces, self.hashes, self.ancestors = [""], [0], [[]]
        self.known_equal = set()

    def add(self, parent: int, piece: str) -> int:
        """The node of ``parent`` and ``piece``, with the ancestors 1, 2, 4 ... levels up."""
        value = self.hashes[parent]
        for letter in piece:
            value = (value * self.base + ord(letter)) % self.prime
        up = [parent]
        while len(self.ancestors[up[-1]]) >= len(up):
            up.append(self.ancestors[up[-1]][len(up) - 1])
        self.pieces.append(piece)
        self.hashes.append(value)
        self.ancestors.append(up)
        return len(self.pieces) - 1

    def spelled(self, node: int) -> str:
        pieces = []
        while node:
            pieces.append(self.pieces[node])
            node = self.ancestors[node][0]
        return "".join(reversed(pieces))

    def equal(self, one: int, other: int) -> bool:
        """Whether two nodes of equal hash are equal, by their pieces back to where they meet."""
        met, a, b = [], one, other
        while a != b and (a, b) not in self.known_equal:
            if self.pieces[a] != self.pieces[b]:
                return False
            met.append((a, b))
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        self.known_equal.update(met)
        return True

    def before(self, one: int, piece: str, other: int, other_piece: str) -> bool:
        """Whether ``one`` and ``piece`` come before ``other`` and ``other_piece`` in ASCII order.

        Doubling steps lead to the last level at which hashes differ; above it lies what is
        common. That is verified, as are equal hashes; where a hash deceived, the lists are
        spelled out. The pieces that differ first decide, as neither begins the other: each
        ends with the edit of a row.
        """
        if one == other:
            return piece < other_piece
        if self.hashes[one] == self.hashes[other]:
            if self.equal(one, other):
                return piece < other_piece
            return self.spelled(one) < self.spelled(other)
        a, b = one, other
        for step in reversed(range(len(self.ancestors[a]))):
            if step < len(self.ancestors[a]):
                high, low = self.ancestors[a][step], self.ancestors[b][step]
                if self.hashes[high] != self.hashes[low]:
                    a, b = high, low
        if not self.equal(self.ancestors[a][0], self.ancestors[b][0]):
            return self.spelled(one) < self.spelled(other)
        return self.pieces[a] < self.pieces[b]


def row_steps(initial: str, unusable: bool, cut_off: bool) -> list[tuple[int, int, int, str]]:
    """``state, next state, cost, edits`` of the cheapest ways past one row, with insertions
    before it. More than two insertions, or back to the same state, are never cheapest."""
    best = {}
    for start in STATES:
        state = start
        for inserted in range(3):
            ways = [(state, DELETE, "D")]
            if not unusable:
                ways.append((NEXT[state], RETYPE + cut_off * CUT_OFF, "R"))
                kept = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
                if kept == SYSTEM and state == NOTHING or kept in (USER, ASSISTANT) and NEXT[state] == kept:
                    ways.append((kept, cut_off * CUT_OFF, "K"))
            for end, cost, letter in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                best[start, end] = min(best.get((start, end), way), way)
            state = NEXT[state]
    return [(start, end, *way) for (start, end), way in best.items()]


ROW_STEPS = {
    (initial, unusable, cut_off): row_steps(initial, unusable, cut_off)
    for initial in ("s", "u", "a", "")
    for unusable in (False, True)
    for cut_off in (False, True)
}


def cheapest(steps: Iterable[list], start: int, audits: Audits) -> dict[int, tuple[int, int]]:
    """Per reachable state the cost and node of the cheapest, then first, audit."""
    best = {start: (0, 0)}
    for ways in steps:
        reached = {}
        for state, end, cost, piece in ways:
            if state in best:
                total, node = best[state][0] + cost, best[state][1]
                old = reached.get(end)
                if old is None or total < old[0] or total == old[0] and audits.before(node, piece, old[1], old[2]):
                    reached[end] = (total, node, piece)
        best = {end: (total, audits.add(node, piece)) for end, (total, node, piece) in reached.items()}
    return best


def closed(best: dict[int, tuple[int, int]], audits: Audits) -> tuple[int, int, str]:
    """Cost, node and closing insertions of the best audit of a whole conversation."""
    found = None
    for state, (cost, node) in best.items():
        piece = CLOSING[state]
        way = (cost + INSERT * len(piece), node, piece)
        if found is None or way[0] < found[0] or way[0] == found[0] and audits.before(node, piece, found[1], found[2]):
            found = way
    return found


def row_facts(roles: list[str], texts: list[str], repeated: set[int]) -> tuple[dict[str, int], list[list]]:
    """The number of rows by first fault, and each row's steps."""
    counts, steps = dict.fromkeys(FACTS, 0), []
    for place, (role, text) in enumerate(zip(roles, texts)):
        words = text.strip(BLANKS)
        fault = None
        if not words:
            fault = "blank"
        elif place in repeated:
            fault = "duplicate"
        elif words[-1] not in ".!?":
            fault = "truncated"
        if fault:
            counts[fault] += 1
        if place:
            counts["illegal"] += roles[place - 1][:1] + role[:1] not in LEGAL
        initial = role[:1] if role[:1] in "sua" else ""
        steps.append(ROW_STEPS[initial, fault in ("blank", "duplicate"), fault == "truncated"])
    return counts, steps


def replayed(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each row that the audit leaves or adds."""
    place = 0
    for edit in audit:
        if edit == "D":
            place += 1
        elif edit == "K":
            role = roles[place]
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
            yield edit, role, texts[place]
            place += 1
        else:
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
            yield edit, role, texts[place] if edit == "R" else ""
            place += edit == "R"


def as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in schema.names} for row in rows], schema)


STRETCHES = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("whole", pa.bool_()),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("digests", pa.list_(pa.binary())), ("firsts", pa.list_(pa.int32())), ("repeats", pa.list_(pa.int32())),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("gaps", pa.int64()), *[(name, pa.int64()) for name in FACTS], ("cost", pa.int64()),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
WAYS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()),
    ("costs", pa.list_(pa.int64())), ("pieces", pa.list_(pa.string())), *[(name, pa.int64()) for name in FACTS],
    ("head", pa.string()), ("tail", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
])
CHOSEN = pa.schema([
    ("part", pa.int32()), ("seq", pa.int64()), ("enter", pa.int32()), ("piece", pa.string()), ("closes", pa.bool_()),
    ("gaps", pa.int64()), *[(name, pa.int64()) for name in FACTS], ("cost", pa.int64()),
])
FINISHED = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), *[(name, pa.int64()) for name in FACTS], ("cost", pa.int64()),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])


def ddl(schema: pa.Schema) -> str:
    kinds = {
        pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string",
        pa.list_(pa.string()): "array<string>", pa.list_(pa.int64()): "array<bigint>",
        pa.list_(pa.int32()): "array<int>", pa.list_(pa.binary()): "array<binary>",
    }
    return ", ".join(f"{field.name} {kinds[field.type]}" for field in schema)


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows in the order of conversation, turn (nulls first) and digest, over all tasks.

    The digest of role and text orders rows of the same turn. Equal rows, whose order does
    not matter, are told apart by a number, so that not even they must meet in one task.
    """
    role, text = F.col("role"), F.col("text")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    keyed = rows.withColumns({"digest": digest, "salt": F.monotonically_increasing_id()})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")


def stretches(rows: DataFrame, keep_rows: bool, stretch_rows: int) -> DataFrame:
    """Conversations that lie whole within a task, finished, and the stretches of others.

    The first and last conversation of a task may go on in the next, so they count as cut.
    """

    def stretch(part, seq, key, lines, whole):
        alive = [x for x in lines if x["alive"]]
        roles, texts = [x["role"] for x in alive], [x["text"] for x in alive]
        firsts, repeats = {}, []
        for place, x in enumerate(alive):
            if firsts.setdefault(x["digest"], place) != place:
                repeats.append(place)
        turns = [x["turn"] for x in alive if x["turn"] is not None]
        row = {"conv_id": key, "part": part, "seq": seq, "whole": whole}
        if not whole or keep_rows:
            row |= {"roles": roles, "texts": texts}
        if not whole:
            # In order, so the turns' first and last are the smallest and largest.
            return row | {
                "digests": list(firsts), "firsts": list(firsts.values()), "repeats": repeats,
                "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
            }
        counts, steps = row_facts(roles, texts, set(repeats))
        audits = Audits()
        cost, node, piece = closed(cheapest(steps, NOTHING, audits), audits)
        audit = audits.spelled(node) + piece
        left = "\n".join(f"{role}:{text}" for _, role, text in replayed(audit, NOTHING, roles, texts))
        return row | counts | {
            "gaps": turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(left.encode()).hexdigest(),
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, first = TaskContext.get().partitionId(), 0, True
        key, lines, characters, cut, out, out_size = None, [], 0, False, [], 0
        for batch in batches:
            for line in batch.to_pylist():
                ends = bool(lines) and line["conv_id"] != key
                full = len(lines) >= stretch_rows or characters >= STRETCH_CHARACTERS
                if lines and (ends or full):
                    whole = ends and not (cut or first)
                    out.append(stretch(part, seq, key, lines, whole))
                    out_size += 0 if whole and not keep_rows else characters
                    seq, lines, characters, cut, first = seq + 1, [], 0, not ends, first and not ends
                    if len(out) >= 1000 or out_size >= STRETCH_CHARACTERS:
                        yield as_batch(out, STRETCHES)
                        out, out_size = [], 0
                key = line["conv_id"]
                lines.append(line)
                characters += len(line["text"])
        if lines:
            out.append(stretch(part, seq, key, lines, False))
        if out:
            yield as_batch(out, STRETCHES)

    ordered = ordered_rows(rows).select("conv_id", "turn", "role", "text", "alive", "digest")
    return materialise(ordered.mapInArrow(work, ddl(STRETCHES)), "conversation-stretches")


def stretch_ways(cut: DataFrame) -> DataFrame:
    """Per cut stretch the cheapest audit from each state to each other one, and its facts.

    A row is a duplicate if its digest lies in an earlier row of the stretch, or in an earlier
    stretch of the conversation; to see the latter, each stretch names a digest once.
    """
    named = cut.select("conv_id", "part", "seq", F.explode(F.arrays_zip("digests", "firsts")).alias("d"))
    order = Window.partitionBy("conv_id", "digest").orderBy("part", "seq")
    later = named.select("conv_id", "part", "seq", F.col("d.digests").alias("digest"), F.col("d.firsts").alias("place"))
    later = later.withColumn("nth", F.row_number().over(order)).filter("nth > 1")
    later = later.groupBy("part", "seq").agg(F.collect_list("place").alias("later"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                roles = row["roles"]
                counts, steps = row_facts(roles, row["texts"], {*row["repeats"], *(row["later"] or ())})
                costs, pieces = [None] * 16, [None] * 16
                for start in STATES:
                    audits = Audits()
                    for end, (cost, node) in cheapest(steps, start, audits).items():
                        costs[4 * start + end], pieces[4 * start + end] = cost, audits.spelled(node)
                ends = {"head": roles[0][:1], "tail": roles[-1][:1]} if roles else {}
                yield as_batch([row | counts | ends | {"costs": costs, "pieces": pieces}], WAYS)

    wanted = cut.select("conv_id", "part", "seq", "roles", "texts", "repeats", "low", "high", "turns")
    joined = wanted.join(later, ["part", "seq"], "left")
    return materialise(joined.mapInArrow(work, ddl(WAYS)), "stretch-ways")


def chosen_ways(ways: DataFrame) -> DataFrame:
    """Which way each stretch takes in its conversation's best audit; the last stretch also
    tells the conversation's facts. A stretch is one step of the search, whatever its rows."""

    def choose(found: list[dict]) -> list[dict]:
        audits = Audits()
        steps = [
            [(s, e, x["costs"][4 * s + e], x["pieces"][4 * s + e]) for s in STATES for e in STATES if x["costs"][4 * s + e] is not None]
            for x in found
        ]
        cost, node, closing = closed(cheapest(steps, NOTHING, audits), audits)
        pieces = []
        while node:
            pieces.append(audits.pieces[node])
            node = audits.ancestors[node][0]
        pieces.reverse()
        facts = {name: sum(x[name] for x in found) for name in FACTS}
        state, tail, low, high, turns, rows = NOTHING, None, None, None, 0, []
        for x, piece in zip(found, pieces):
            rows.append({"part": x["part"], "seq": x["seq"], "enter": state, "piece": piece, "closes": False})
            state = next(e for s, e, _, p in steps[len(rows) - 1] if s == state and p == piece)
            if x["head"] is not None:
                facts["illegal"] += tail is not None and tail + x["head"] not in LEGAL
                tail = x["tail"]
            if x["low"] is not None:
                turns += x["turns"] - (x["low"] == high)
                low, high = x["low"] if low is None else low, x["high"]
        gaps = 0 if low is None else high - low + 1 - turns
        rows[-1] |= facts | {"piece": rows[-1]["piece"] + closing, "closes": True, "gaps": gaps, "cost": cost}
        return rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for row in batch.to_pylist():
                if found and row["conv_id"] != found[0]["conv_id"]:
                    yield as_batch(choose(found), CHOSEN)
                    found = []
                found.append(row)
        if found:
            yield as_batch(choose(found), CHOSEN)

    ordered = ways.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return materialise(ordered.mapInArrow(work, ddl(CHOSEN)), "chosen-ways")


def finished(cut: DataFrame, chosen: DataFrame) -> DataFrame:
    """Results of the cut conversations. Their digest is one running SHA-256 each, so a task
    reads a conversation's stretches in order, one at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, audit, lines = hashlib.sha256(), [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for _, role, text in replayed(row["piece"], row["enter"], row["roles"], row["texts"]):
                    running.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
                audit.append(row["piece"])
                if row["closes"]:
                    yield as_batch([row | {"audit": "".join(audit), "repaired_sha256": running.hexdigest()}], FINISHED)
                    running, audit, lines = hashlib.sha256(), [], 0

    joined = cut.select("conv_id", "part", "seq", "roles", "texts").join(chosen, ["part", "seq"])
    ordered = joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return ordered.mapInArrow(work, ddl(FINISHED))


def plain_rows(df: DataFrame, alive=None) -> DataFrame:
    """``conv_id, turn, role, text, alive`` with a space for a missing role or text."""
    return df.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.lit(True) if alive is None else alive).alias("alive"),
    )


def repair_conversations(df: DataFrame, alive=None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    for each conv_id of ``df`` (``conv_id, turn, role, text``).

    ``alive`` is a condition; rows where it is false only name their conversation. A missing
    role or text is one space; rows without conv_id are one conversation; rows without turn
    come first, and rows of the same turn are ordered by the SHA-256 of role and text. An
    empty text is blank; a text of any length is read whole. Repeated rows are duplicates.
    A conversation of any length is cut over tasks, except that its audit is one value and
    its digest one running hash. Other columns are not read; an empty table gives an empty
    table.
    """
    table = stretches(plain_rows(df, alive), False, stretch_rows)
    cut = table.filter("NOT whole")
    long = finished(cut, chosen_ways(stretch_ways(cut)))
    return table.filter("whole").select(*RESULT).unionByName(long.select(*RESULT))


def repaired_turns(df: DataFrame, alive=None, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """``conv_id, part, seq, place, edit, role, text``: the repaired rows, in the order of
    ``part``, ``seq`` and ``place``; ``edit`` is K (kept), R (role changed) or I (inserted).
    Nulls, ties and the rest are handled as in :func:`repair_conversations`."""
    table = stretches(plain_rows(df, alive), True, stretch_rows)
    cut = table.filter("NOT whole")
    whole = table.filter("whole").withColumns({"enter": F.lit(NOTHING), "piece": F.col("audit")})
    names = ["conv_id", "part", "seq", "roles", "texts", "enter", "piece"]
    long = cut.join(chosen_ways(stretch_ways(cut)).select("part", "seq", "enter", "piece"), ["part", "seq"])

    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("place", pa.int64()),
        ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left = replayed(row["piece"], row["enter"], row["roles"], row["texts"])
                rows = [row | {"place": i, "edit": e, "role": r, "text": t} for i, (e, r, t) in enumerate(left)]
                if rows:
                    yield as_batch(rows, schema)

    return whole.select(*names).unionByName(long.select(*names)).mapInArrow(work, ddl(schema))


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with known damage, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops
    a row (``alive`` is false), 1 empties its text, 2 removes its closing signs, 3 repeats
    it, 4 makes it the user's. Nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = plain_rows(df).withColumn("harm", F.crc32(key) % 20)
    harm, text = F.col("harm"), F.col("text")
    return rows.withColumns({
        "alive": harm != 0,
        "text": F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text),
        "role": F.when(harm == 4, "user").otherwise(F.col("role")),
        "copy": F.explode(F.array_repeat(F.lit(1), F.when(harm == 3, 2).otherwise(1))),
    }).drop("harm", "copy")
