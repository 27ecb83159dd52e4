"""Packing of token ids into windows: minimum bin slack, and best fit decreasing.

Both cut documents losslessly: whole windows first, and what remains of a document is packed
with other remainders. Packing is local: a task streams its documents, and packs when the
remainders it holds reach a bounded number of tokens. So no ids are shuffled, memory is
bounded, and a lost task is redone from its own input. Sequence ids hold the task's number.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from lociq.llm import bpe
from lociq.llm.frames import SLICE_ROWS, schema_of, to_batch
from lociq.plans.storage import find_package, scratch_path

WINDOW = 2048
#: Tokens of remainders that a task holds before it packs them.
HELD_TOKENS = 8_000_000
#: Rows that a task hands on at a time: at most as many windows of ids.
OUT_ROWS = 256
#: Windows of which a larger share than one in so many would be padding are filled by cutting.
SLACK_SHARE = 64
#: Id that ends a document.
END_ID = 1


def subset_closest(lengths: Iterable[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` closest without passing it.

    Subset sums are the bits of one integer; a length that occurs c times enters as multiples
    1, 2, 4, ... of it. Sums from before each multiple are kept, and the counts are read off
    them backwards. ``lengths`` are tried in their order until the room can be filled exactly.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        left, k = counts[length], 1
        if length > room:
            continue
        left = min(left, room // length)
        while left > 0 and not sums >> room & 1:
            k_now = min(k, left)
            steps.append((length, k_now, sums))
            sums |= sums << (length * k_now) & mask
            left -= k_now
            k *= 2
        if sums >> room & 1:
            break
    best, used = sums.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> best & 1:
            best -= length * k
            used[length] = used.get(length, 0) + k
    return used


def minimum_bin_slack(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of indices into ``lengths`` (each 1 to window - 1).

    A window takes the longest remaining length and the multiset of others that leaves the
    least slack. Equal lengths are used in the order given.
    """
    by: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by.setdefault(lengths[i], []).append(i)
    order = sorted(by)
    counts = {n: len(v) for n, v in by.items()}
    windows = []

    def take(length: int, k: int) -> list[int]:
        counts[length] -= k
        if not counts[length]:
            del order[bisect_left(order, length)]
        return [by[length].pop() for _ in range(k)]

    while order:
        first = order[-1]
        taken, room = take(first, 1), window - first
        fitting = (order[i] for i in range(bisect_right(order, room) - 1, -1, -1))
        for length, k in subset_closest(fitting, counts, room).items():
            taken += take(length, k)
        windows.append(taken)
    return windows


class Capacities:
    """A segment tree over remaining capacities: the least one that is held and at least as large as asked."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.held = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.held[at] += n
            at >>= 1

    def least(self, need: int) -> int | None:
        held, at = self.held, need + self.size
        if held[at]:
            return need
        while at > 1:  # up to the first right neighbour that holds one, then down its left side
            if not at & 1 and held[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if held[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of indices: longest first, each into the window with the least room that has enough."""
    tree, open_at, windows = Capacities(window), [[] for _ in range(window + 1)], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.least(lengths[i])
        if room is None:
            bin_id, room = len(windows), window
            windows.append([])
        else:
            tree.add(room, -1)
            bin_id = open_at[room].pop()
        windows[bin_id].append(i)
        rest = room - lengths[i]
        if rest:
            tree.add(rest, 1)
            open_at[rest].append(bin_id)
    return windows


def in_powers(total: int) -> list[int]:
    """A total below the window as the powers of two it is the sum of, largest first: sequences that need no padding."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


#: A piece: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens
Piece = tuple[int | None, int, bytes, int]


def cut_off(pieces: list[Piece], room: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``room`` tokens of the pieces, and the rest; at most one piece is cut."""
    part: list[Piece] = []
    for k, (doc_id, start, ids, n) in enumerate(pieces):
        size = len(ids) // 4
        if size > room:
            if room:
                part.append((doc_id, start, ids[: 4 * room], n))
            return part, [(doc_id, start + room, ids[4 * room :], n), *pieces[k + 1 :]]
        part.append((doc_id, start, ids, n))
        room -= size
    return part, []


def total(pieces: list[Piece]) -> int:
    return sum(len(p[2]) // 4 for p in pieces)


def top_up(windows: list[list[Piece]], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """The windows, those with a slack over ``window`` / SLACK_SHARE filled by cutting the emptiest up; and what is left of the last.

    Where one remaining length is frequent and no others fit beside it, whole remainders leave
    every window with the same slack; then the emptiest windows' pieces fill the others.
    """
    open_ = sorted((w for w in windows if window - total(w) > window // SLACK_SHARE), key=total)
    full = [w for w in windows if window - total(w) <= window // SLACK_SHARE]
    rest: list[Piece] = []
    while open_ or rest:
        if not rest:
            rest = open_.pop(0)
        if not open_:
            return full, rest
        part, rest = cut_off(rest, window - total(open_[-1]))
        open_[-1] = open_[-1] + part
        if total(open_[-1]) == window:
            full.append(open_.pop())
    return full, []


def sequences(pieces: list[Piece], solve: Callable, window: int, cut_tail: bool) -> Iterator[list[Piece]]:
    """The windows of the pieces; with ``cut_tail`` slack is filled, and a last window is cut into powers of two."""
    found = [[pieces[k] for k in members] for members in solve([len(p[2]) // 4 for p in pieces], window)]
    if not cut_tail:
        yield from found
        return
    full, rest = top_up(found, window)
    if not rest and full:  # the emptiest still has the most padding to lose
        short = min(range(len(full)), key=lambda i: total(full[i]))
        rest = full.pop(short)
    yield from full
    for size in in_powers(total(rest)) if total(rest) < window else [total(rest)] * bool(rest):
        part, rest = cut_off(rest, size)
        yield part


def pack_stream(docs: DataFrame, tokenizer: str, emit: Callable, ddl: str, solve: Callable, *, window: int, end_id: int, cut_tail: bool) -> DataFrame:
    """Pack each task's documents; ``emit(out, sequence_id, pieces)`` adds a sequence's rows to the columns ``out``."""
    out_type = schema_of(ddl)
    ending = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, encode = to_arrow_schema(out_type), bpe.load(tokenizer).encode_many
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        out: dict[str, list] = {f.name: [] for f in out_type}
        first = out_type[0].name
        held: list[Piece] = []
        tokens = 0

        def flush():
            nonlocal number, out, held, tokens
            for pieces in sequences(held, solve, window, cut_tail):
                emit(out, number, pieces)
                number += 1
                if len(out[first]) >= OUT_ROWS:
                    yield to_batch(out, arrow)
                    out = {f.name: [] for f in out_type}
            held, tokens = [], 0

        for part in (b.slice(lo, SLICE_ROWS) for b in batches for lo in range(0, b.num_rows, SLICE_ROWS)):
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                ids += ending
                n, at = len(ids) // 4, 0
                while n - at >= window:
                    emit(out, number, [(doc_id, at, ids[4 * at : 4 * (at + window)], n)])
                    number += 1
                    at += window
                    if len(out[first]) >= OUT_ROWS:
                        yield to_batch(out, arrow)
                        out = {f.name: [] for f in out_type}
                if at < n:
                    held.append((doc_id, at, ids[4 * at :], n))
                    tokens += n - at
                if tokens >= HELD_TOKENS:
                    yield from flush()
        yield from flush()
        if out[first]:
            yield to_batch(out, arrow)

    find_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, out_type)


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _emit_pieces(out: dict, sequence_id: int, pieces: list[Piece]) -> None:
    offset = 0
    for doc_id, start, ids, n in pieces:
        for k, v in (("doc_id", doc_id), ("start", start), ("length", len(ids) // 4), ("doc_tokens", n), ("sequence_id", sequence_id), ("offset", offset), ("ids", ids)):
            out[k].append(v)
        offset += len(ids) // 4


def pack_pieces(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Minimum-bin-slack packing: a row for each piece, with its ids.

    A document has its ids and then ``end_id``; null and empty texts have that id alone. Rows
    with the same doc_id each count. Windows that minimum bin slack leaves with more than a
    64th of padding are filled from the emptiest of them, whose pieces are cut; what is left of
    the last is cut into sequences whose lengths are powers of two, which need no padding.
    """
    return pack_stream(docs, tokenizer, _emit_pieces, _PIECES, minimum_bin_slack, window=window, end_id=end_id, cut_tail=True)


_ROWS = "sequence_id long, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, starts array<long>, doc_tokens array<long>, ids binary, positions binary"


def _emit_rows(window: int, pad_id: int, kind: str):
    def emit(out: dict, sequence_id: int, pieces: list[Piece]) -> None:
        sizes = [len(p[2]) // 4 for p in pieces]
        ends = np.cumsum([0, *sizes])
        row = np.full(window, pad_id, dtype=kind)
        ids = np.frombuffer(b"".join(p[2] for p in pieces), dtype="<u4")
        if max(int(ids.max()), window - 1) > np.iinfo(kind).max:
            raise OverflowError("an id or position doesn't fit: ask for more bits")
        row[: ends[-1]] = ids
        positions = np.zeros(window, dtype=kind)
        positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        for k, v in (("sequence_id", sequence_id), ("n_tokens", int(ends[-1])), ("cu_seqlens", ends.tolist()), ("doc_ids", [p[0] for p in pieces]), ("starts", [p[1] for p in pieces]), ("doc_tokens", [p[3] for p in pieces]), ("ids", row.tobytes()), ("positions", positions.tobytes())):
            out[k].append(v)

    return emit


def pack_matrix(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, end_id: int = END_ID, pad_id: int = 0, bits: int = 16) -> DataFrame:
    """Best-fit-decreasing packing: a row of the packed id matrix for each sequence.

    ids and positions are rows of little-endian unsigned integers of ``bits``, 16 or 32 (ids that
    don't fit raise OverflowError), padded to the window with ``pad_id`` and 0; cu_seqlens are
    the segments' cumulative lengths from 0, and the positions restart at 0 in each segment.
    Documents over the window are split losslessly: doc_ids, starts and doc_tokens tell which
    ids of which document a segment holds. Null and empty texts have ``end_id`` alone; rows with
    the same doc_id, or a null one, each count; an empty table has no sequence.
    """
    return pack_stream(docs, tokenizer, _emit_rows(window, pad_id, f"<u{bits // 8}"), _ROWS, best_fit_decreasing, window=window, end_id=end_id, cut_tail=False)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet, each task's in the order in which it fills them."""
    packed.write.option("compression", "zstd").parquet(path)


def written_matrix(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Pack, write to ``path`` (by default a new folder in the shared one), and read the files back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "matrix")
    write_matrix(pack_matrix(docs, tokenizer, **options), path)
    return spark.read.schema(_ROWS).parquet(path)
