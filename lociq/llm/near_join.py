"""Similarity join on word shingles: an LSH forest over MinHash signatures, then exact verification.

Texts with the same shingle set form a node. A node's signature is cut into the labels of
several prefix trees of depth ``DEEPEST``. A tree is kept as a sorted array: the nodes in the
order of their labels, in which those below a common prefix are neighbours, and the labels
that neighbours share are the depths at which they part. The tops of the trees, that is their
first ``prefix_length`` labels, deal them over the tasks.

A walk goes through a top from the longest prefixes that nodes share up to the top's own
length, a label at a time. Nodes whose whole run is one family by then are done, and their
prefix isn't shortened further; at the length of the top even a pair at the very threshold is
met with the recall asked for, so no prefix is shortened beyond. Where prefixes meet, the
signatures join nodes into families (one spanning link a node, never the pairs). A top of more
than BLOCK nodes is worked in pairs of bounded blocks. Every pair of a family is then verified
on its whole shingle sets, again in pairs of blocks that return one row a node: how many
documents it is linked to, and one spanning link.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.frames import map_columns, map_groups, shingle_hashes
from lociq.operators.graph import connected_components
from lociq.plans.storage import discard, materialise

WIDTH, THRESHOLD, TREES, DEEPEST, RECALL = 5, 0.8, 20, 6, 0.9999
#: Nodes in a block. Larger buckets and families are worked in pairs of blocks.
BLOCK = 256
#: Signature agreement from which two met nodes join a family: 5.5 standard errors below the threshold, a pair in 50 million of those at it.
FAMILY = 0.6
#: Bits of the filter for texts that stand for a node in a family.
FILTER_BITS = 26
#: Bytes of a label in a sorted tree. Labels that agree by chance only let nodes meet.
LABEL = 2


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, deepest: int = DEEPEST) -> int:
    """The longest prefix whose forest meets a pair at the threshold with the recall asked for."""
    length = deepest
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


@functools.cache
def _maps(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None], rng.integers(0, 1 << 32, size, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash values: the least of each of as many linear maps of 32-bit hashes."""
    a, b = _maps(size)
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    h = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(h), 8192):
        v = h[None, at : at + 8192] * a
        v += b
        np.minimum(low, v.min(axis=1), out=low)
    return low


def _signer(width: int, size: int):
    def sign(cols: dict) -> dict:
        sets = [shingle_hashes(text, width) for text in cols["text"]]
        return {"doc_id": cols["doc_id"], "digest": cols["digest"], "node": [node_key(s) for s in sets], **_sketches([signature(s, size) for s in sets])}

    return sign


def _sketches(signatures: list[np.ndarray]) -> dict:
    """Of each signature the labels, LABEL bytes a value, and the byte a value by which agreement is estimated."""
    return {"labels": [(v >> np.uint32(16)).astype(">u2").tobytes() for v in signatures], "sig": [v.astype(np.uint8).tobytes() for v in signatures]}


def node_key(shingles: np.ndarray) -> bytes:
    """The digest that stands for a shingle set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def roots(linked: np.ndarray) -> np.ndarray:
    """Least index reachable from each, for a symmetric boolean matrix."""
    n = len(linked)
    root = np.arange(n)
    while True:
        new = np.where(linked, root[None, :], n).min(axis=1)
        new = np.minimum(root, new)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def agreements(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values each signature of ``a`` shares with each of ``b``: at once for small groups, value by value for large ones."""
    if len(a) * len(b) * a.shape[1] <= 1 << 20:
        return (a[:, None, :] == b[None, :, :]).sum(axis=2)
    same = np.zeros((len(a), len(b)), dtype=np.uint16)
    for k in range(a.shape[1]):
        same += a[:, k, None] == b[None, :, k]
    return same


def shared_depths(labels: list[bytes]) -> np.ndarray:
    """Of a sorted tree: how many labels each node shares with the one before; 0 for the first."""
    if not labels:
        return np.empty(0, dtype=np.int64)
    m = np.frombuffer(b"".join(labels), dtype=np.uint8).reshape(len(labels), -1, LABEL)
    same = (m[1:] == m[:-1]).all(axis=2)
    return np.concatenate([[0], np.cumprod(same, axis=1).sum(axis=1)])


def runs(depths: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Spans of two nodes or more that share a prefix of ``depth`` labels."""
    begins = np.flatnonzero(depths < depth)
    ends = np.append(begins[1:], len(depths))
    return [(int(a), int(b)) for a, b in zip(begins, ends, strict=True) if b - a > 1]


def walk(labels: list[bytes], sig: np.ndarray, top: int, least: float) -> np.ndarray:
    """The family of each node of a sorted top: the least place in it.

    From the deepest prefixes to those of ``top`` labels; a run that is one family already
    isn't looked at again. Two nodes join if ``least`` of their values or more agree.
    """
    depths, deepest = shared_depths(labels), len(labels[0]) // LABEL if labels else 0
    family = np.arange(len(labels))
    for depth in range(deepest, top - 1, -1):
        for lo, hi in runs(depths, depth):
            mine = family[lo:hi]
            if (mine == mine[0]).all():
                continue
            met = agreements(sig[lo:hi], sig[lo:hi]) >= least
            met |= mine[:, None] == mine[None, :]
            family[lo:hi] = mine[roots(met)]
    return family


def _family_links(size: int, top: int):
    def links(group: dict) -> dict:
        nodes = group["node"]
        sig = np.frombuffer(b"".join(group["sig"]), dtype=np.uint8).reshape(len(nodes), size)
        family = walk(group["labels"], sig, top, FAMILY * size)
        # a family's links go to its least node, so that trees and blocks mostly agree on them
        least: dict[int, bytes] = {}
        for f, node in zip(family.tolist(), nodes, strict=True):
            least[f] = min(node, least.get(f, node))
        return {"a": [n for n, f in zip(nodes, family.tolist(), strict=True) if n != least[f]], "b": [least[f] for n, f in zip(nodes, family.tolist(), strict=True) if n != least[f]]}

    return links


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the shingles that two sets or more share."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.float32)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    order = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    keep = shared[inverse]
    col, row = order[inverse][keep], owner[keep]
    at = np.argsort(col, kind="stable")
    col, row = col[at], row[at]
    width = 4096
    for lo in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, width), dtype=np.float32)
        m[row[i:j], col[i:j] - lo] = 1
        out += m @ m.T
    return out


def _verified(width: int, threshold: float):
    def verify(group: dict) -> dict:
        sets, keep = [], []
        for i, (text, node) in enumerate(zip(group["text"], group["node"], strict=True)):
            s = shingle_hashes(text, width)
            if node_key(s) == node and (not keep or node != group["node"][keep[-1]]):
                sets.append(s)
                keep.append(i)
        n = len(keep)
        if n < 2:
            return {"node": [], "root": [], "links": [], "blocks": []}
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        both = intersections(sets).astype(np.float64)
        linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        block = np.array([group["block"][i] for i in keep])
        if group["i"][0] != group["j"][0]:  # pairs inside a block are another group's
            linked &= block[:, None] != block[None, :]
        copies = np.array([group["copies"][i] for i in keep])
        links = linked @ copies
        r = roots(linked)
        at = np.flatnonzero(links)
        return {"node": [group["node"][keep[i]] for i in at], "root": [group["node"][keep[r[i]]] for i in at], "links": [int(links[i]) for i in at], "blocks": [group["blocks"][0]] * len(at)}

    return verify


def in_blocks(df: DataFrame, size: str, node: str = "node") -> DataFrame:
    """Adds blocks, block, i and j: the pairs of blocks that a member takes part in.

    A group of ``size`` members has ceil(size / BLOCK) blocks, so a member is repeated as
    often as its group has blocks, and a pair of blocks holds about 2 * BLOCK members.
    """
    df = df.withColumn("blocks", F.ceil(F.col(size) / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def text_digest(text="text"):
    """A column: the MD5 digest of the text's bytes. A null text has a null one."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def only_digests(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose digest ``wanted`` has, and some others: a filter of FILTER_BITS bits, so few other rows are shuffled.

    The filter is a table of 64-bit words, 2^(FILTER_BITS - 6) at most, which bounds what is
    broadcast; a full one lets all rows pass. Null digests have a bit too.
    """
    def bit(df: DataFrame) -> DataFrame:
        head = F.coalesce(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(0))
        return df.withColumn("_bit", head.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))).withColumn("_word", F.shiftright("_bit", 6))

    one = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    words = bit(wanted).groupBy("_word").agg(F.bit_or(one).alias("_set"))
    kept = bit(rows).join(F.broadcast(words), "_word").filter(F.col("_set").bitwiseAND(one) != 0)
    return kept.select(*rows.columns)


def near_join(docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_links.

    n_links counts the other documents whose shingle sets have a Jaccard similarity of
    ``threshold`` or more; class_id is the least doc_id that links lead to, and copy_id the
    least doc_id with the very same shingle set. Texts are lower-cased and split at white
    space; a text of fewer than ``width`` words has one shingle of them all. Null, empty and
    blank texts have no shingle: they are copies of one another. Rows with the same doc_id
    each count; a null doc_id keeps its row, and is not a class id if a copy has an id.
    """
    return near_classes(docs, width=width, threshold=threshold, trees=trees, recall=recall).select("doc_id", "class_id", "copy_id", "n_links")


def near_classes(docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """The rows of ``near_join`` with the text's digest, and root, which names the class also where no member has an id."""
    size, top = trees * DEEPEST, prefix_length(threshold, trees, recall)
    hashed = map_columns(docs.select("doc_id", "text", text_digest().alias("digest")), _signer(width, size), "doc_id long, digest binary, node binary, labels binary, sig binary")
    signed = materialise(hashed, "signed")
    # the text that stands for a node: of the least id, nulls last
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest"))
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("rep"), rep.alias("from"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels"), F.first("sig").alias("sig"))
    nodes = materialise(nodes, "nodes")

    cut = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring("labels", t * (LABEL * DEEPEST) + 1, F.lit(LABEL * DEEPEST)))
    trie = nodes.select("node", F.posexplode(cut).alias("tree", "labels")).withColumn("top", F.xxhash64("tree", F.substring("labels", 1, LABEL * top)))
    met = trie.groupBy("top").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = in_blocks(trie.join(met, "top"), "size").select("top", "i", "j", "labels", "node").join(nodes.select("node", "sig"), "node")
    links = materialise(map_groups(members, ["top", "i", "j"], _family_links(size, top), "a binary, b binary", then=["labels", "node"]), "links")
    family = connected_components(links)
    discard(links)

    sized = family.join(family.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component").join(nodes.select("node", "from", "copies"), "node")
    sized = materialise(sized, "families")
    text = only_digests(docs.select("doc_id", "text", text_digest().alias("digest")), sized.select("from.digest"))
    text = text.select("text", F.struct("doc_id", "digest").alias("row"))
    same = text["row.digest"].eqNullSafe(sized["from.digest"]) & text["row.doc_id"].eqNullSafe(sized["from.doc_id"])
    # rows that repeat an id and its text have one text among them
    texts = text.join(sized, same).groupBy("node").agg(F.first("text").alias("text"))
    placed = in_blocks(sized, "size").join(texts, "node").select("component", "i", "j", "node", "block", "blocks", "copies", "text")
    found = materialise(map_groups(placed, ["component", "i", "j"], _verified(width, threshold), "node binary, root binary, links long, blocks int", then=["node"]), "links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    across = found.filter("blocks > 1")
    if not across.isEmpty():
        whole = connected_components(across.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("n"), "component")
        counted = counted.join(whole, counted.node == whole.n, "left").select("node", "links", F.coalesce("component", "root").alias("root"))
    linked = nodes.select("node", "rep", "copies").join(counted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.filter("links is not null").groupBy("root").agg(F.min("rep").alias("least"))
    classes = linked.join(least, "root", "left").select("node", "root", F.coalesce("least", "rep").alias("class_id"), F.col("rep").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "digest", "node").join(classes, "node").select("doc_id", "digest", "root", "class_id", "copy_id", "n_links")
