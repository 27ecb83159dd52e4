"""Prefix trie of conversations by radix partitioning from the first turn on.

Turns get numbers of a dictionary, conversations become strings of these, and equal strings
are counted once. From the root on, the strings of a node are dealt out by their next number
(one step of a most-significant-digit radix sort) as long as a node has more of them than a
task should hold; each step emits the nodes that it divides. What remains below is finished in
single tasks by multikey quicksort, whose recursion emits the other nodes and sums their subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.frames import map_groups, map_stream, schema_of
from lociq.plans.storage import materialise

#: Turns of distinct strings (and strings) below a node up to which one task finishes it. Results don't depend on it.
LOCAL_TURNS = 2_000
#: Most first turns that a rebuilt conversation takes of another one, and the distance of the ids that others take from.
MOST_TAKEN, EVERY = 6, 100

EMPTY_SHA256 = hashlib.sha256().hexdigest()
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, chars): each conversation's turns by number, null first, as dictionary numbers and code points.

    A null role or text is empty. Turns of one number go by their dictionary numbers, which
    follow a digest of role and text, so the order is the same in every run. Repeated rows
    stay. Rows of a null conv_id belong to no conversation. A conversation's numbers are one
    value of Spark's (a hundred million turns at most); its texts aren't gathered.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = turns.filter("conv_id is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"), F.length(text).alias("chars"))
    words = t.groupBy("digest").agg(F.first("chars").alias("chars")).repartitionByRange("digest").sortWithinPartitions("digest")
    words = materialise(words.select(F.col("digest").alias("word"), F.monotonically_increasing_id().alias("id")), "turn_words")
    said = t.join(words, t.digest == words.word).select("conv_id", "turn", "id", "chars")
    lists = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("said"))
    return lists.select("conv_id", F.col("said.id").alias("ids"), F.col("said.chars").alias("chars"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``turn_lists`` with conversations that share beginnings.

    Conversation c takes the first h turns of conversation c - c % EVERY (the remainder is never
    negative; all turns if it has fewer, none if it isn't there), h = crc32(c in decimal) %
    MOST_TAKEN, then its own turns after its first h.
    """
    lists = materialise(turn_lists(turns), "turn_lists")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(EVERY))
    first = lists.filter(F.col("conv_id") % EVERY == 0).select(F.col("conv_id").alias("of"), F.slice("ids", 1, MOST_TAKEN).alias("first_ids"), F.slice("chars", 1, MOST_TAKEN).alias("first_chars"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN).cast("int")
    own = lists.withColumn("of", base).withColumn("h", h).join(first, "of", "left")
    # a slice may be empty, so its length is kept above the number of turns
    taken = lambda c: F.coalesce(F.slice(f"first_{c}", F.lit(1), F.col("h")), F.array().cast(lists.schema[c].dataType))
    after = lambda c: F.slice(c, F.col("h") + 1, F.size(c) + 1)
    return own.select("conv_id", F.concat(taken("ids"), after("ids")).alias("ids"), F.concat(taken("chars"), after("chars")).alias("chars"))


def _hash_ends(batches: Iterator[dict]) -> Iterator[dict]:
    """SHA-256 of each string's conversation ids, as the sorted rows bring them; nothing is gathered."""
    out: dict[str, list] = {"string": [], "ends_sha256": []}
    held = digest = None

    def done() -> None:
        out["string"].append(held)
        out["ends_sha256"].append(digest.hexdigest())

    for cols in batches:
        for key, conv in zip(cols["string"], cols["conv_id"], strict=True):
            if key != held:
                if digest is not None:
                    done()
                held, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        if len(out["string"]) >= 4096:
            yield out
            out = {"string": [], "ends_sha256": []}
    if digest is not None:
        done()
    yield out


def distinct_strings(lists: DataFrame) -> DataFrame:
    """(rep, n, ids, chars, ends_sha256): each distinct string, its least conversation and the number of those that have it.

    Copies are counted before they move. Only ids of conversations go through one task a
    string, in their order, as their digest is of them all in order.
    """
    keyed = lists.withColumn("string", F.unhex(F.sha2(F.array_join("ids", ","), 256)))
    strings = keyed.groupBy("string").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("ids").alias("ids"), F.first("chars").alias("chars"))
    sorted_ids = keyed.select("string", "conv_id").repartition("string").sortWithinPartitions("string", "conv_id")
    ends = map_stream(sorted_ids, _hash_ends, "string binary, ends_sha256 string")
    return strings.join(ends, "string").drop("string")


def sorted_nodes(depth: int, parent: int | None, reps: list[int], ns: list[int], strings: list[list[int]], chars: list[list[int]], ends: list[str]) -> list[list]:
    """Nodes below depth ``depth`` of distinct strings that share their first ``depth`` numbers and are longer than that, parents before children.

    Multikey quicksort: strings are parted by the number at the depth into those of a lesser, the
    pivot's and a greater number; the middle ones share one more turn, which makes a node.
    """
    nodes: list[list] = []
    above: list[int] = []
    todo = [(list(range(len(reps))), depth, -1)]
    while todo:
        members, d, up = todo.pop()
        if len(members) > 1:
            at = sorted((strings[members[0]][d], strings[members[len(members) // 2]][d], strings[members[-1]][d]))[1]
            less, same, more = [], [], []
            for m in members:
                x = strings[m][d]
                (less if x < at else more if x > at else same).append(m)
            todo += [(part, d, up) for part in (less, more) if part]
            members = same
        while members:
            d += 1
            n, rep = sum(ns[m] for m in members), min(reps[m] for m in members)
            ended = [m for m in members if len(strings[m]) == d]
            nodes.append([rep, d, parent if up < 0 else nodes[up][0], n, 0, 0, (n - 1) * chars[members[0]][d - 1], ends[ended[0]] if ended else EMPTY_SHA256])
            above.append(up)
            up = len(nodes) - 1
            members = [m for m in members if len(strings[m]) > d]
            if len(members) > 1:
                todo.append((members, d, up))
                break
    for i in range(len(nodes) - 1, -1, -1):
        if not nodes[i][4]:
            nodes[i][5] = 1
        if (up := above[i]) >= 0:
            nodes[up][4] += 1
            nodes[up][5] += nodes[i][5]
            nodes[up][6] += nodes[i][6]
    return nodes


_NAMES = [c.split()[0] for c in NODES.split(", ")]


def _finish(group: dict) -> dict:
    got = sorted_nodes(group["at"][0], group["top"][0], group["rep"], group["n"], group["ids"], group["chars"], group["ends_sha256"])
    return dict(zip(_NAMES, map(list, zip(*got, strict=True)), strict=True)) | {"at": [group["at"][0]] * len(got)}


def trie_nodes(lists: DataFrame, *, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """A row for each node of the trie of (conv_id, ids, chars).

    Columns: conv_id, the least member's; depth; parent_conv_id (the root's is null); n_convs,
    members; n_children; n_leaves, childless nodes of the subtree with the node itself;
    saved_tokens, the sum over the subtree of (members - 1) times the characters of the last
    turn; ends_sha256, of the ids of members that end here, ascending, joined by commas. At a
    depth conv_id names a node. Empty conversations are the root's; an empty table has no nodes.

    A step of the recursion is a job over the strings of nodes above ``local_turns`` only, of
    which there are at most the table's turns by ``local_turns``, so the tables that name them
    and their paths are small. Equal conversations are one string, so a group of copies never
    makes a node large.
    """
    strings = materialise(distinct_strings(lists), "trie_strings")
    first = strings.agg(F.min("rep")).first()[0]
    if first is None:
        return strings.sparkSession.createDataFrame([], schema_of(NODES))
    zero = F.lit(0).cast("long")
    root = strings.agg(F.sum("n").alias("n_convs")).select(F.lit(first).alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", zero.alias("own"), F.array(F.lit(first)).alias("path"))
    large, active, depth = [materialise(root, "trie_large")], strings.withColumn("top", F.lit(first)), 0
    local, ended, fans = [], [], []
    while True:
        at = F.lit(depth).cast("long")
        ended.append(active.filter(F.size("ids") == depth).select(F.col("top").alias("conv_id"), at.alias("depth"), "ends_sha256"))
        longer = active.filter(F.size("ids") > depth).withColumn("next", F.element_at("ids", depth + 1))
        fan = longer.groupBy("top", "next").agg(
            F.sum("n").alias("n_convs"), F.min("rep").alias("conv_id"), F.count(F.lit(1)).alias("strings"), F.sum(F.size("ids") - depth).alias("turns"), F.first(F.element_at("chars", depth + 1)).alias("chars")
        )
        fan = materialise(fan, "trie_fan")
        fans.append(fan.groupBy(F.col("top").alias("conv_id")).agg(F.count(F.lit(1)).alias("n_children")).select("conv_id", at.alias("depth"), "n_children"))
        big = fan.filter(f"strings > 1 and turns > {local_turns}")
        marks = big.select(F.col("top").alias("t"), F.col("next").alias("x"), F.col("conv_id").alias("below"))
        in_big = (F.col("top") == F.col("t")) & (F.col("next") == F.col("x"))
        kept = ["rep", "n", "ids", "chars", "ends_sha256"]
        if big.isEmpty():
            local.append(longer.select(at.alias("at"), "top", "next", *kept))
            break
        local.append(longer.join(marks, in_big, "left_anti").select(at.alias("at"), "top", "next", *kept))
        active = materialise(longer.join(marks, in_big).select(*kept, F.col("below").alias("top")), "trie_split")
        depth += 1
        above = large[-1].select(F.col("conv_id").alias("t"), "path")
        made = big.join(above, F.col("top") == F.col("t"))
        made = made.select("conv_id", F.lit(depth).cast("long").alias("depth"), F.col("top").alias("parent_conv_id"), "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("own"), F.concat("path", F.array("conv_id")).alias("path"))
        large.append(materialise(made, "trie_large"))

    union = lambda frames: reduce(DataFrame.unionByName, frames)
    below = materialise(map_groups(union(local), ["at", "top", "next"], _finish, f"{NODES}, at long"), "trie_local")
    spine = union(large)
    # what each large node adds to the subtrees on its path: its own savings, and what the finished parts right below it hold
    tops = below.filter(F.col("depth") == F.col("at") + 1).groupBy(F.col("parent_conv_id").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    fan_out, key = union(fans), ["conv_id", "depth"]
    told = spine.join(tops, key, "left").join(fan_out, key, "left").na.fill(0, ["leaves", "saved", "n_children"])
    gives = told.select(F.posexplode("path").alias("d", "conv_id"), (F.col("own") + F.col("saved")).alias("saved"), F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("leaves")).alias("leaves"))
    sums = gives.groupBy("conv_id", F.col("d").cast("long").alias("depth")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    whole = told.select(*key, "parent_conv_id", "n_convs", "n_children").join(sums, key).join(union(ended), key, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))
    return whole.select(*_NAMES).unionByName(below.select(*_NAMES))
