"""Repair of conversations whose turns are lost, repeated, cut short or said by the wrong side.

A conversation is a string of turns. Three machines are composed, state by state as they are
reached: the acceptor of its turns, a transducer of weighted edits, and the acceptor of role
orders ``(s?(ua)+)?``. The cheapest path through them is found in the order of the turns, over
weights (cost, label string) of which the lesser cost wins, then the string that is ASCII-least.

Label strings aren't carried. At any turn, those of the paths alive that end with an edit of that
turn are never one the beginning of another unless they are equal, so their rank among
each other is all that later comparisons need; a path's weight is its cost, its rank and the
inserts since. Less the least cost, such layers are few, and each is expanded once by a worker.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.llm.frames import map_columns, map_groups, map_stream
from lociq.plans.storage import materialise

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"
#: The grammar's states: nothing said yet, after the system, the user, the assistant. The role that user and assistant take turns to say next leads to NEXT.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
SAID = {USER: "user", ASSISTANT: "assistant"}
#: Turns of a piece, and characters after which a piece ends: what a task holds of a conversation at a time.
PIECE_TURNS, PIECE_CHARS = 512, 4_000_000

#: A path's end: what it cost above the cheapest, and the rank of its labels. None: no path ends in that state.
Layer = tuple[tuple[int, int] | None, ...]


def kept_state(state: int, initial: str) -> int | None:
    """Where keeping a turn of this role initial leads, or None where the grammar has no such arc."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def turn_class(initial: str, forced: bool, truncated: bool) -> str:
    """The letter by which a turn enters the composition: x if it has to go, else its role's initial (o: another), upper case if it is cut short."""
    letter = "x" if forced else initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if truncated and not forced else letter


_LABELS = {s: i for i, s in enumerate(sorted(INSERT * k + last for k in range(3) for last in (KEEP, REROLE, DELETE)))}


def inserted(layer: Layer) -> Iterator[tuple[int, int, int, int, int]]:
    """(state, cost, rank, from state, inserts) of the paths of a layer and up to two inserts: a third is never of use."""
    for state, weight in enumerate(layer):
        if weight:
            at = state
            for k in range(3):
                yield at, weight[0] + INSERT_COST * k, weight[1], state, k
                at = NEXT[at]


@functools.cache
def expand(layer: Layer, letter: str) -> tuple[Layer, int, tuple]:
    """The layer after a turn of this class, the least cost taken out of it, and for each state the arc by which it is reached: (state before, its inserts, label)."""
    best: list[tuple | None] = [None] * 4
    extra = TRUNCATED_COST if letter.isupper() else 0
    for at, cost, rank, before, k in inserted(layer):
        arcs = [(at, DELETE_COST, DELETE)]
        if letter != "x":
            arcs.append((NEXT[at], REROLE_COST + extra, REROLE))
            if (to := kept_state(at, letter.lower())) is not None:
                arcs.append((to, extra, KEEP))
        for to, add, label in arcs:
            found = (cost + add, rank, _LABELS[INSERT * k + label], before, k, label)
            if best[to] is None or found[:3] < best[to][:3]:
                best[to] = found
    least = min(b[0] for b in best if b)
    ranks = {r: i for i, r in enumerate(sorted({b[1:3] for b in best if b}))}
    return tuple(b and (b[0] - least, ranks[b[1:3]]) for b in best), least, tuple(b and b[3:] for b in best)


def cheapest(letters: str) -> tuple[int, list[str], list[int]]:
    """Cost of the cheapest edits of a conversation; the labels of each turn, its inserts before it, and at the end those after the last; the grammar's state before each."""
    layer: Layer = ((0, 0), None, None, None)
    cost, arcs = 0, []
    for letter in letters:
        layer, add, back = expand(layer, letter)
        cost += add
        arcs.append(back)
    left, _, k, state = min((c, r, k, before) for at, c, r, before, k in inserted(layer) if at in ENDS)
    labels, states = [INSERT * k], [state]
    for back in reversed(arcs):
        state, k, label = back[state]
        labels.append(INSERT * k + label)
        states.append(state)
    return cost + left, labels[::-1], states[::-1]


def render(state: int, audit: str, roles: list[str], texts: list[str], copies: list[int]) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired turns of a piece that is entered in ``state`` and edited by ``audit``."""
    said, told = [], []
    turns = ((r, t) for r, t, n in zip(roles, texts, copies, strict=True) for _ in range(n))
    for label in audit:
        if label == INSERT:
            role, text = SAID[NEXT[state]], ""
        else:
            role, text = next(turns)
            if label == DELETE:
                continue
            if label == KEEP:
                state = kept_state(state, role[:1])
                said.append(role)
                told.append(text)
                continue
            role = SAID[NEXT[state]]
        state = NEXT[state]
        said.append(role)
        told.append(text)
    return said, told


class _Piece:
    """Consecutive turns of a conversation, as they come from the sorted rows; equal rows are one with a count."""

    def __init__(self, key):
        self.key, self.chars = key, 0
        self.letters, self.initials, self.digests = [], [], []
        self.roles, self.texts, self.copies, self.turns = [], [], [], []

    def add(self, turn: int | None, digest: bytes, role: str, text: str, copies: int) -> None:
        bare, initial = text.strip(WHITE), role[:1]
        self.letters.append(turn_class(initial, not bare, bare[-1:] not in (".", "!", "?")))
        self.initials.append(initial if initial in ("s", "u", "a") else "o")
        self.digests.append(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        if not self.turns or self.turns[-1] != turn:
            self.turns.append(turn)
        self.chars += len(text)


def told_faults(letters: str, copies: list[int], later: set[int]) -> tuple[str, int, int, int]:
    """The letters of all turns, copies and those at ``later`` forced to go, and the numbers of blank, duplicate and truncated ones."""
    out, blank, duplicate, truncated = [], 0, 0, 0
    for i, (x, n) in enumerate(zip(letters, copies, strict=True)):
        if x == "x":
            blank += n
            out.append("x" * n)
        elif i in later:
            duplicate += n
            out.append("x" * n)
        else:
            duplicate += n - 1
            truncated += x.isupper()
            out.append(x + "x" * (n - 1))
    return "".join(out), blank, duplicate, truncated


def illegal_pairs(initials: str) -> int:
    legal = sum(initials.count(p) for p in ("su", "ua", "au"))
    return max(0, len(initials) - 1) - legal


_PIECES = (
    "conv_id long, part int, seq int, whole boolean, letters string, initials string, turns array<long>, digests array<binary>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " roles array<string>, texts array<string>, copies array<long>"
)
_PIECE_NAMES = [c.split()[0] for c in _PIECES.replace(",", ", ").split(", ")]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def gap_count(turns: list[int | None]) -> int:
    """Numbers missing between the least and greatest turn number; 0 where none is known. ``turns`` are distinct and sorted, null first."""
    known = [t for t in turns if t is not None]
    return known[-1] - known[0] + 1 - len(known) if known else 0


def _whole(p: _Piece) -> dict:
    """A conversation that lies in one piece, repaired."""
    at: dict[bytes, int] = {}
    later = {i for i, d in enumerate(p.digests) if at.setdefault(d, i) != i}
    letters, blank, duplicate, truncated = told_faults("".join(p.letters), p.copies, later)
    cost, labels, _ = cheapest(letters)
    audit = "".join(labels)
    roles, texts = render(START, audit, p.roles, p.texts, p.copies)
    illegal = illegal_pairs("".join(x * n for x, n in zip(p.initials, p.copies, strict=True)))
    told = {"gaps": gap_count(p.turns), "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal, "cost": cost, "audit": audit, "roles": roles, "texts": texts}
    return told | {"letters": "", "initials": "", "turns": [], "digests": [], "copies": []}


def _cut_pieces(batches: Iterator[dict]) -> Iterator[dict]:
    """Pieces of sorted rows. Conversations that lie whole in one piece, and not at an end of the task's rows, are repaired at once."""
    part, seq = TaskContext.get().partitionId(), 0
    out: dict[str, list] = {n: [] for n in _PIECE_NAMES}
    held: _Piece | None = None
    first, cut = True, False

    def put(p: _Piece, whole: bool) -> None:
        nonlocal seq
        row = dict.fromkeys(_PIECE_NAMES) | {"conv_id": p.key, "part": part, "seq": seq, "whole": whole}
        if whole:
            row |= _whole(p)
        else:
            row |= {"letters": "".join(p.letters), "initials": "".join(p.initials), "turns": p.turns, "digests": p.digests, "roles": p.roles, "texts": p.texts, "copies": p.copies}
        for n, v in row.items():
            out[n].append(v)
        seq += 1

    for cols in batches:
        for key, *row in zip(*(cols[n] for n in ("conv_id", "turn", "digest", "role", "text", "copies")), strict=True):
            if held is None:
                held = _Piece(key)
            elif held.key != key:
                put(held, not first and not cut)
                held, first, cut = _Piece(key), False, False
            elif len(held.roles) >= PIECE_TURNS or held.chars >= PIECE_CHARS:
                put(held, False)
                held, cut = _Piece(key), True
            held.add(*row)
        if len(out["seq"]) >= 256:
            yield out
            out = {n: [] for n in _PIECE_NAMES}
    if held is not None:
        put(held, False)
    yield out


def _solve(group: dict) -> dict:
    """A conversation of several pieces, from the letters of its turns alone."""
    told = [told_faults(x, c, set(later or ())) for x, c, later in zip(group["letters"], group["copies"], group["later"], strict=True)]
    letters = [x[0] for x in told]
    cost, labels, states = cheapest("".join(letters))
    turns = [t for ts in group["turns"] for t in ts]
    turns = [t for i, t in enumerate(turns) if not i or t != turns[i - 1]]  # a number may go on in the next piece
    n, at, audits, entered = len(letters), 0, [], []
    for i, x in enumerate(letters):
        audits.append("".join(labels[at : at + len(x)]) + (labels[-1] if i == n - 1 else ""))
        entered.append(states[at])
        at += len(x)
    only = lambda v: [v] + [0] * (n - 1)
    illegal = illegal_pairs("".join(x * k for i, c in zip(group["initials"], group["copies"], strict=True) for x, k in zip(i, c, strict=True)))
    return {
        "conv_id": group["conv_id"], "part": group["part"], "seq": group["seq"], "n": list(range(n)), "state": entered, "audit": audits,
        "gaps": only(gap_count(turns)), "blank": [x[1] for x in told], "duplicate": [x[2] for x in told], "truncated": [x[3] for x in told], "illegal": only(illegal), "cost": only(cost),
    }


def _render_rows(cols: dict) -> dict:
    done = [render(*row) for row in zip(*(cols[n] for n in ("state", "audit", "roles", "texts", "copies")), strict=True)]
    return {"conv_id": cols["conv_id"], "n": cols["n"], "roles": [d[0] for d in done], "texts": [d[1] for d in done]}


class Repaired(NamedTuple):
    """``summary``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row for each conversation. ``pieces``: conv_id, n, whole, roles, texts, the repaired turns
    in one row (``whole``), or for a long conversation in several by ``n``."""

    summary: DataFrame
    pieces: DataFrame


def turn_digest() -> Column:
    return F.unhex(F.sha2(F.concat_ws(":", "role", "text"), 256))


def repair(turns: DataFrame) -> Repaired:
    """Find each conversation's faults and its cheapest repair.

    ``turns`` has conv_id, turn, role and text; other columns are left out. A null role or text
    is one space, turns go by their number, null first, those of one number by a digest of role
    and text; rows of a null conv_id are one conversation. A role's first letter is its part in
    the grammar, another letter or none can't be kept.

    Equal rows are counted before they move. Then rows move to sorted ranges, so a long
    conversation lies in several tasks, which hold a piece of it at a time. A conversation within
    one piece is repaired there; of one that is cut only a letter and a number a turn go to a single
    task, which gives the audit, a value of that length as well (2 GB is Spark's bound).
    """
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).withColumn("digest", turn_digest())
    rows = t.groupBy("conv_id", "turn", "digest", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = ["conv_id", "turn", "digest"]
    pieces = materialise(map_stream(rows.repartitionByRange(*order).sortWithinPartitions(*order), _cut_pieces, _PIECES), "repair")
    cut, where = pieces.filter("not whole"), ["part", "seq"]
    # which turns of a cut conversation said what an earlier one had said: digests move, not texts
    said = cut.select("conv_id", *where, F.posexplode("digests").alias("spot", "digest"))
    spot = F.struct(*where, "spot")
    firsts = said.groupBy("conv_id", "digest").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).filter("first <> last").select(F.col("conv_id").alias("of"), F.col("digest").alias("seen"), "first")
    later = said.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("seen"))).filter(spot != F.col("first")).groupBy(*where).agg(F.collect_list("spot").alias("later"))
    letters = cut.select("conv_id", *where, "letters", "initials", "turns", "copies").join(later, where, "left")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    solved = materialise(map_groups(letters, ["conv_id"], _solve, f"conv_id long, part int, seq int, n int, state int, audit string, {counts}", where), "repair_cut")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "audit"))), lambda x: x["audit"]), "")
    summed = solved.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in COUNTS), audit.alias("audit"))
    redone = cut.select(*where, "roles", "texts", "copies").join(solved.select("conv_id", *where, "n", "state", "audit"), where)
    redone = map_columns(redone, _render_rows, "conv_id long, n int, roles array<string>, texts array<string>")
    whole = pieces.filter("whole")
    return Repaired(
        whole.select("conv_id", *COUNTS, "audit").unionByName(summed),
        whole.select("conv_id", F.lit(0).alias("n"), F.lit(True).alias("whole"), "roles", "texts").unionByName(redone.select("conv_id", "n", F.lit(False).alias("whole"), "roles", "texts")),
    )


def piece_lines() -> Column:
    """``role:text`` of a piece's turns, joined by line feeds."""
    return F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")


def _hash_lines(batches: Iterator[dict]) -> Iterator[dict]:
    """SHA-256 of each conversation's lines, a piece after another as the sorted rows bring them."""
    held = digest = None
    said, out = False, {"conv_id": [], "repaired_sha256": []}

    def done() -> None:
        out["conv_id"].append(held)
        out["repaired_sha256"].append(digest.hexdigest())

    for cols in batches:
        for key, lines, n in zip(cols["conv_id"], cols["lines"], cols["said"], strict=True):
            if digest is None or key != held:
                if digest is not None:
                    done()
                held, digest, said = key, hashlib.sha256(), False
            if n:
                digest.update((("\n" if said else "") + lines).encode("utf-8"))
                said = True
    if digest is not None:
        done()
    yield out


def repaired_hashes(pieces: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of the repaired turns' lines. Those of a long conversation go through one task in their order, piece by piece."""
    whole = pieces.filter("whole").select("conv_id", F.sha2(piece_lines(), 256).alias("repaired_sha256"))
    cut = pieces.filter("not whole").select("conv_id", piece_lines().alias("lines"), F.size("roles").alias("said"), "n")
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "n").select("conv_id", "lines", "said")
    return whole.unionByName(map_stream(cut, _hash_lines, "conv_id long, repaired_sha256 string"))


def damage(turns: DataFrame) -> DataFrame:
    """Faults for tests of a repair, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes out its full stops, exclamation and question marks, 3 repeats it, 4 makes the user its role.

    Nulls count as one space. Equal rows have equal fates.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    t = turns.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    t = t.filter("fate <> 0").select("conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), "fate")
    return t.withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")
