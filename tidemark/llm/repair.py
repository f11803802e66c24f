"""Operator 11: repair of conversation structure by an automaton that conversations share from the end.

Each row of a conversation is a letter of its signature: the role's initial where it matters and the row's fault. Distinct
signatures, sorted from their ends, run through the automaton of their suffixes: a node is a suffix, entered once however
many signatures of the partition end in it, and has for each state of the role grammar the cost to go and the first edits of
the best audit. In a state each edit leads to one next state, so the least letter among the cheapest ones gives the least
audit, and a node points to its successor's audit instead of holding a copy. Audits go back to the conversations of a
signature, and from there to the rows.

Edits: keep (K, 0), rerole to user or assistant (R, 2), delete (D, 3; a must for blank and repeated rows), insert an empty
user or assistant row anywhere (I, 2); a truncated row that stays adds 1. The result has role initials `(s?(ua)+)?`.

Memory: a conversation's rows are read one by one in their order, repeated ones folded; its signature and audit are a byte a
row, like the audit in the result. A partition holds the path of one signature. The digest of a conversation is one stream of
its rows and so one task's; what leads to it is dealt out by rows and signatures.

Rows: null role and null text count as one space, as do null ids in the damage's key; rows go by turn (null first), then by
role and text; null conv_ids are one conversation; other columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import shared

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the grammar (nothing yet, after the system's row, after a user's, after an assistant's); what the next row must be.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of signatures: a row that must go; else the role's initial (o: another), a capital one if the row is truncated.
GONE = "x"


class Automaton:
    """Cost to go and first edits by state, for each node on the path of the signature read last, from its end."""

    def __init__(self) -> None:
        self.letters: list[str] = []
        ends = [0, 2 * INSERT, INSERT, 0]
        self.path: list[tuple[list[int], list[tuple[str, int]]]] = [(ends, [("", START), ("II", ASSISTANT), ("I", ASSISTANT), ("", ASSISTANT)])]
        self.steps: dict[tuple, tuple[list[int], list[tuple[str, int]]]] = {}
        self.nodes = 0

    def node(self, letter: str, after: list[int]) -> tuple[list[int], list[tuple[str, int]]]:
        """(cost to go, (edits up to the row's own, state after it)) by state, from the costs behind the row."""
        self.nodes += 1
        low = min(after)
        key = (letter, *(c - low for c in after))  # few: costs of two states differ by a few inserts at most
        if key not in self.steps:
            self.steps[key] = self._step(letter, list(key[1:]))
        costs, edits = self.steps[key]
        return [c + low for c in costs], edits

    @staticmethod
    def _step(letter: str, after: list[int]) -> tuple[list[int], list[tuple[str, int]]]:
        stays, role = letter != GONE, "-sua".find(letter.lower())
        more = TRUNCATED if letter.isupper() else 0
        own: list[list[tuple[int, str, int]]] = []  # (cost, edit, state after) of the row's own edits
        for state in range(4):
            ways = [(DELETE + after[state], "D", state)]
            if stays:
                ways.append((REROLE + more + after[NEXT[state]], "R", NEXT[state]))
                if role > 0 and (role == NEXT[state] or role == SYSTEM and state == START):
                    ways.append((KEEP + more + after[role], "K", role))
            own.append(ways)
        cost = [min(w[0] for w in ways) for ways in own]
        for _ in range(4):
            cost = [min(c, INSERT + cost[NEXT[s]]) for s, c in enumerate(cost)]
        edits = []
        for state in range(4):
            said, at = "", state
            while True:
                best = [w for w in own[at] if w[0] == cost[at]]
                if INSERT + cost[NEXT[at]] == cost[at] and not any(w[1] == "D" for w in best):
                    said, at = said + "I", NEXT[at]
                    continue
                _, edit, at = min(best, key=lambda w: w[1])
                edits.append((said + edit, at))
                break
        return cost, edits

    def read(self, signature: str) -> tuple[int, str]:
        """(cost, audit). The more of its end a signature has in common with the one before, the less there is to do."""
        n, have = len(signature), self.letters
        same = 0
        while same < min(n, len(have)) and have[same] == signature[n - 1 - same]:
            same += 1
        del have[same:], self.path[same + 1 :]
        for k in range(n - 1 - same, -1, -1):
            have.append(signature[k])
            self.path.append(self.node(signature[k], self.path[-1][0]))
        state, audit = START, []
        for k in range(n, -1, -1):
            said, state = self.path[k][1][state]
            audit.append(said)
        return self.path[n][0][START], "".join(audit)


def damage(turns: DataFrame) -> DataFrame:
    """The contract's damage by crc32(`conv_id:turn`) % 20: conv_id, turn, role, text, gone (a dropped row, which only says
    that there is such a conversation) and copies."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    kept = lambda c: F.when(~gone, c)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return own.select("conv_id", kept(F.col("turn")).alias("turn"), kept(role).alias("role"), kept(text).alias("text"), gone.alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def undamaged(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) in the form of damage()."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.lit(False).alias("gone"), F.lit(1).cast("long").alias("copies"))


def _fault(text: str) -> Column:
    """What the row's own text shows: blank, truncated or nothing."""
    solid = F.rtrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(solid == "", "blank").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated")


def _signed_rows(rows: DataFrame) -> DataFrame:
    """Rows with their number of copies, fault and letter, one for each distinct row of a conversation."""
    turn = F.struct(F.col("turn").isNotNull().alias("is_set"), F.col("turn"))
    folded = rows.groupBy("conv_id", "turn", "role", "text", "gone").agg(F.sum("copies").alias("copies"))
    digest = F.unhex(F.sha2("text", 256))
    # where a row of one role and text comes in several turns, the first of these; light, and few rows stay
    seen = rows.where("not gone").groupBy("conv_id", "role", digest.alias("digest")).agg(F.min(turn).alias("first"), F.max(turn).alias("last")).where("first <> last")
    firsts = seen.select(F.col("conv_id").alias("of"), F.col("role").alias("as"), "digest", "first")
    own = folded.withColumn("digest", digest).withColumn("fault", _fault("text"))
    keyed = own.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (own["role"] == F.col("as")) & (own["digest"] == firsts["digest"]), "left")
    again = F.coalesce(turn > F.col("first"), F.lit(False))
    fault = F.when(F.col("gone"), "").when(F.col("fault") == "blank", "blank").when(again, "duplicate").otherwise(F.coalesce("fault", F.lit("")))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    signed = keyed.select("conv_id", "turn", own["role"].alias("role"), "text", "gone", "copies", fault.alias("fault"), initial.alias("initial"), letter.alias("letter"))
    return signed.withColumn("letter", F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper("letter")).otherwise(F.col("letter")))


_SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation from its rows in order."""
    names = [x.split()[0] for x in _SIGNED.split(", ")]
    out: list[tuple] = []
    conv, begun = None, False
    low = high = last = None
    turns = illegal = 0
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    initial, letters = None, []

    def close() -> None:
        out.append((conv, 0 if low is None else high - low + 1 - turns, *counts.values(), illegal, "".join(letters)))

    def flush() -> pa.RecordBatch:
        rows = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "signature" else pa.int64()) for n, c in zip(names, rows, strict=True)], names)

    for b in batches:
        for c, turn, gone, copies, fault, first, letter in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "gone", "copies", "fault", "initial", "letter")), strict=True):
            if not begun or c != conv:
                if begun:
                    close()
                conv, begun, low, high, last, turns, illegal, initial, letters = c, True, None, None, None, 0, 0, None, []
                counts = dict.fromkeys(counts, 0)
            if gone:
                continue
            if turn is not None:
                low, high, turns, last = turn if low is None else low, turn, turns + (turn != last), turn
            illegal += copies - 1 + (initial is not None and initial + first not in ("su", "ua", "au"))
            initial = first
            if fault:
                counts[fault] += copies if fault != "truncated" else 1
            if fault in ("", "truncated"):
                counts["duplicate"] += copies - 1
            letters.append(letter + GONE * (copies - 1))
        if out:
            yield flush()
    if begun:
        close()
        yield flush()


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for b in batches:
        signatures = b.column("signature")
        found = [automaton.read(x) for x in signatures.to_pylist()]
        yield pa.RecordBatch.from_arrays([signatures, pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])


_REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of each conversation in order, from its audit and then its rows."""
    names = [x.split()[0] for x in _REPAIRED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    rows: list[tuple] = []
    size = place = at = 0
    state, audit, conv = START, "", None

    def flush() -> pa.RecordBatch:
        nonlocal size
        cols = list(zip(*rows, strict=True))
        rows.clear()
        size = 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    def put(edit: str, role: str, text: str) -> None:
        nonlocal size, place
        rows.append((conv, place, edit, role, text))
        size, place = size + len(text), place + 1

    def insert() -> None:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            at, state = at + 1, NEXT[state]
            put("I", NAMES[state], "")

    for b in batches:
        for c, said, gone, copies, role, text, letter in zip(*(b.column(n).to_pylist() for n in ("conv_id", "audit", "gone", "copies", "role", "text", "letter")), strict=True):
            if said is not None:
                conv, audit, at, state, place = c, said, 0, START, 0
                insert()
                continue
            if not gone:
                edit = audit[at]
                at += 1
                if edit == "R":
                    state = NEXT[state]
                    put("R", NAMES[state], text)
                elif edit == "K":
                    state = "-sua".find(letter.lower())
                    put("K", role, text)
                insert()
                for _ in range(copies - 1):  # repeats of the row, which go
                    at += 1
                    insert()
            if size > 1_000_000 or len(rows) > 5_000:
                yield flush()
    if rows:
        yield flush()


class Repair:
    """report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row for each conversation; rows: conv_id,
    place (from 0), edit (K, R or I), role and text of the repaired conversations, in order within a conversation."""

    def __init__(self, damaged: DataFrame):
        rows = shared.written(_signed_rows(damaged), "rows")
        order = ["conv_id", F.col("gone").desc(), F.col("turn").asc_nulls_first(), "role", "text"]
        light = rows.select("conv_id", "turn", "role", "text", "gone", "copies", "fault", "initial", "letter").repartition("conv_id").sortWithinPartitions(*order)
        signed = shared.written(light.mapInArrow(_sign, _SIGNED), "signed")
        distinct = signed.groupBy("signature").count().select("signature", F.reverse("signature").alias("end"))
        audits = shared.written(distinct.repartitionByRange("end").sortWithinPartitions("end").mapInArrow(_audit, "signature string, cost long, audit string"), "audits")
        self.report = shared.written(signed.join(audits, "signature").drop("signature"), "report")
        heads = self.report.select("conv_id", "audit").withColumn("head", F.lit(True))
        both = heads.unionByName(rows.select("conv_id", "turn", "role", "text", "gone", "copies", "letter"), allowMissingColumns=True)
        mended = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("head").desc_nulls_last(), *order[1:])
        self.rows = mended.mapInArrow(_mend, _REPAIRED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, h = None, None
    for b in batches:
        out = []
        for c, place, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if h:
                    out.append((conv, h.hexdigest()))
                conv, h = c, hashlib.sha256()
            h.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([x for _, x in out])], ["of", "sha256"])
    if h:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([h.hexdigest()])], ["of", "sha256"])


def digests(damaged: DataFrame) -> DataFrame:
    """The report with the digest of each repaired conversation's rows, as `role:text` by lines."""
    repair = Repair(damaged)
    own = repair.rows.mapInArrow(_digest, "of long, sha256 string")
    empty = hashlib.sha256().hexdigest()
    return repair.report.join(own, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(*repair.report.columns, F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256"))
