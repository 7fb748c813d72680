"""Exact similarity join of documents on word shingles with PartEnum signatures.

Two documents link when the Jaccard similarity of their shingle sets is at least
``NUMERATOR / 100``.  A set x differs from such a set in at most |x| / 4 elements, from one
that is not larger than m in at most (|x| + m) / 9.  Sets of more than ``SMALL`` elements lie in
bands by size, and give signatures in the bands in which a similar, not larger set may lie:

* First level: the feature domain is cut into parts, a few more than half as many as a similar
  set may have differences, so that some parts hold at most one difference.
* Second level: each part is cut into three; a signature covers two of the three, all ways.  The
  one difference of such a part lies outside one of them, which both sets therefore share.

A part without a difference shares three signatures, one with a single difference at least one.
Parts in which x fills fewer than two of the three could share an empty signature, which is none,
and do not count.  Of p parts that count and k differences, at least ``need`` = 2 p - k signatures
are shared: fewest when all parts have one or two differences.  A set with ``need`` below one, a
matter of chance, is *bare*.

Smaller sets, and bare ones, give the subsets of a fixed size (``level``) of their first elements
in the order of the fingerprints: similar sets share that many among the first
|x| / 5 + ``level``.  So no pair is lost.

A similar pair shares at least ``need`` signatures of a band, so each set may leave the
``need - 1`` largest groups it is in, groups being ordered by size and name: the smallest group
that a similar pair shares is among what both keep.  So groups around a very common line or a
long passage are left, and sets that share too few signatures with anyone leave all.  A signature that many sets of one task share
travels in rows of its own, so no group gathers more than its share.

Sets that share a group are compared in two steps (``link_classes``).  First each set is compared
with one other, the smallest of a group that it meets as such most often; this joins families of
copies.  Groups that then still hold sets of different components are cut into blocks of bounded
rows and bytes, and every block meets every block of its group inside a task: an exact bound on
256 cells of the sets (the cells' differences of two sets add up to at most the number of
elements in which they differ) leaves the pairs that may link; written are not the pairs but each
set with one that such pairs lead to.  These rows fall into families, and the whole sets of a
family are compared block with block inside tasks, which keep track of what is joined already and
send out only links that join two components.  No step makes a row per pair; rows grow with sets
and groups.

Defined results: a null or empty text, or one of white space alone, has ``n_shingles`` 0
and links with nothing; repeated rows are documents of their own and link as equal sets;
a null ``doc_id`` is a document that takes part, with the id null, and never becomes a
component's name; other columns of the input are ignored.  Equal sets are told by a
64-bit fingerprint of the set, elements by 64-bit fingerprints of the words, of which the
first 48 bits are compared in the end.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import (
    U, byte_values, components, fingerprint, from_planes, mix, mix_int, partitions, planes, powers, prefix_sums,
    signed, small_batches, unsigned, unused, utf8_blocks,
)
from tableloom.plans.scratch import discard, materialize, temporary

WORDS = 5
# 100 * |x and y| >= NUMERATOR * |x or y|
NUMERATOR = 80
# sets up to this size give subsets of their first elements, of LEVEL each; bare ones give pairs, beyond PAIRED elements
SMALL = 16
LEVEL = 4
PAIRED = 64
# ratio of the ends of a size band
RATIO = 1.5
# a group of more different sets counts as large
LARGE = 3
# signature entries that a task packs at a time, and how many sets of these make a signature hot
FLUSH = 1 << 20
HOT = 512
# elements of all sets for each bucket of signatures
BUCKET = 1 << 21
# sets, and bytes of their elements, of a block that is compared with others
BLOCK_SETS = 1 << 10
BLOCK_BYTES = 64 << 20
# pairs of cells that are compared at a time
PAIRS = 1 << 14
# bytes of texts that are worked on at a time
BLOCK = 1 << 19
# bytes per element of the sets that are compared
WIDTH = 6
# cells of the bound
CELLS = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUES = byte_values(lower=True)


def word_hashes(block: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words in order, and for each text the index of its first word."""
    plain = ~_SPACE[block]
    begins, ends = plain.copy(), plain.copy()
    begins[1:] &= ~plain[:-1]
    ends[:-1] &= ~plain[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(block))]
    begins[inner] = plain[inner]
    ends[inner - 1] = plain[inner - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = fingerprint(prefix_sums(block, _VALUES), start, end)
    return hashes, np.searchsorted(start, offsets)


def shingle_sets(block: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of all texts, and where each text's begin."""
    hashes, first = word_hashes(block, offsets)
    n_words = np.diff(first)
    n_docs = len(n_words)
    up, _ = powers(words + 1)
    factor = mix(up[: words + 1])
    n = np.where(n_words >= words, n_words - words + 1, (n_words > 0).astype(np.int64))
    bounds = np.zeros(n_docs + 1, dtype=np.int64)
    np.cumsum(n, out=bounds[1:])
    doc = np.repeat(np.arange(n_docs), n)
    at = np.arange(bounds[-1]) - bounds[doc] + first[doc]
    length = np.minimum(n_words[doc], words)
    total = length.astype(U) * factor[words]
    for k in range(words):
        live = np.flatnonzero(length > k)
        total[live] += mix(hashes[at[live] + k] ^ factor[k])
    total = mix(total)
    for d in np.flatnonzero(n > 1):
        total[bounds[d] : bounds[d + 1]].sort()
    keep = np.ones(len(total), dtype=bool)
    keep[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    sizes = np.bincount(doc[keep], minlength=n_docs)
    begin = np.zeros(n_docs + 1, dtype=np.int64)
    np.cumsum(sizes, out=begin[1:])
    return total[keep], begin


def set_keys(elements: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One fingerprint per set, from an order-free sum over its elements."""
    sums = np.zeros(len(elements) + 1, dtype=U)
    np.cumsum(mix(elements ^ U(0x5851F42D4C957F2D)), out=sums[1:])
    return mix((sums[begin[1:]] - sums[begin[:-1]]) + np.diff(begin).astype(U))


def _band_ends(largest: int) -> np.ndarray:
    ends = [SMALL]
    while ends[-1] < largest:
        ends.append(int(ends[-1] * RATIO))
    return np.array(ends, dtype=np.int64)


def parts_of(end: int) -> int:
    """First-level parts of the band of sets of up to ``end`` elements: half the differences and some to spare."""
    return end // 8 + 2 + math.isqrt(end) // 5


def _subsets(elements: np.ndarray, begin: np.ndarray, which: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of the subsets of ``level`` elements among the first of each set in ``which``."""
    size = np.diff(begin)[which]
    first = np.minimum(size, size - (size * NUMERATOR + 99) // 100 + level)
    out_sig, out_set = [], []
    for n in np.unique(first[first >= level]).tolist():
        chosen = which[first == n]
        ways = np.array(list(itertools.combinations(range(n), level)), dtype=np.int64)
        sums = np.zeros((len(chosen), len(ways)), dtype=U)
        for k in range(level):
            sums += mix(elements[begin[chosen][:, None] + ways[:, k]] ^ U(0x2545F4914F6CDD1D))
        out_sig.append(mix(sums + U(mix_int(level))).ravel())
        out_set.append(np.repeat(chosen, len(ways)))
    if not out_sig:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_sig), np.concatenate(out_set)


def signatures(elements: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node) and the nodes (set, band, need): each set with elements gives signatures in
    the bands of its node rows, and shares at least ``need`` of a band's with every set it links with."""
    size = np.diff(begin)
    out_sig, out_node, nodes, n_nodes = [], [], [], 0
    if len(elements) == 0:
        return np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64), np.zeros((0, 3), dtype=np.int64)
    ends = _band_ends(int(size.max()))
    own = np.searchsorted(ends, size)
    # the smallest set that can be similar to one of this size
    least = (size * NUMERATOR + 99) // 100
    low = np.searchsorted(ends, least)
    weights = mix(elements ^ U(0x2545F4914F6CDD1D))
    bare = np.zeros(len(size), dtype=bool)
    for step in range(int((own - low).max()) + 1):
        band = own - step
        which = np.flatnonzero((band >= np.maximum(low, 1)) & (size > SMALL))
        if not len(which):
            continue
        n, end = size[which], ends[band[which]]
        parts = np.array([parts_of(int(e)) for e in ends], dtype=np.int64)[band[which]]
        cells = 3 * parts
        base = np.cumsum(cells) - cells
        local = np.repeat(np.arange(len(which)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[which][local]
        slot = base[local] + ((elements[at] >> U(17)) % cells[local].astype(U)).astype(np.int64)
        sums = np.zeros(int(cells.sum()), dtype=U)
        np.add.at(sums, slot, weights[at])
        filled = np.zeros(len(sums), dtype=bool)
        filled[slot] = True
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        owner = np.repeat(np.arange(len(which)), parts)
        # differences from a set not larger than the band's end, or from any when the set lies in the band itself
        differences = np.where(step == 0, n // 4, (n + end) // 9)
        weak = np.bincount(owner[filled.sum(axis=1) < 2], minlength=len(which))
        need = 2 * (parts - weak) - differences
        number = (np.arange(len(sums)) - (base // 3)[owner]).astype(U) * U(3)
        seed = mix(band[which].astype(U) + U(7))[owner]
        for out, (i, j) in enumerate(((1, 2), (0, 2), (0, 1))):
            there = filled[:, i] | filled[:, j]
            out_sig.append(mix(sums[:, i] + sums[:, j] + mix(number + U(out) + seed))[there])
            out_node.append(owner[there] + n_nodes)
        nodes.append(np.stack([which, band[which], np.clip(need, 1, 255)], axis=1))
        n_nodes += len(which)
        bare[which[need < 1]] = True
    # band 0: subsets of first elements, which all have to be kept
    few = [
        (least <= SMALL, LEVEL),
        (bare & (least <= PAIRED), 2),
        (bare & (size > PAIRED), 1),
    ]
    for chosen, level in few:
        which = np.flatnonzero(chosen & (size >= level))
        sig, of = _subsets(elements, begin, which, level)
        out_sig.append(sig)
        out_node.append(np.searchsorted(which, of) + n_nodes)
        nodes.append(np.stack([which, np.zeros_like(which), np.ones_like(which)], axis=1))
        n_nodes += len(which)
    return np.concatenate(out_sig), np.concatenate(out_node), np.concatenate(nodes)


MEMBER = "doc_id long, text_key long, n_shingles long, set_key long, cells binary"


def member_table(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, cells): a row per document, the set's key null when it is empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, block, offsets in utf8_blocks(batch.column(2), BLOCK):
                elements, begin = shingle_sets(block, offsets, words)
                n = np.diff(begin)
                keys = pa.array(signed(set_keys(elements, begin)), mask=n == 0)
                cell = np.repeat(np.arange(len(n)) * CELLS, n) + ((elements >> U(33)) % U(CELLS)).astype(np.int64)
                cells = np.minimum(np.bincount(cell, minlength=len(n) * CELLS), 255).astype(np.uint8).reshape(-1, CELLS)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, end - first) for i in (0, 1)), pa.array(n), keys,
                        pa.array([c.tobytes() for c in cells], pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_shingles", "set_key", "cells"],
                )

    return _identified(docs).select("doc_id", "text_key", "text").mapInArrow(rows, MEMBER)


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, row, text); ``row`` names a row also when it has no id."""
    text_key = _text_key(F.col("text"))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text_key.alias("text_key"), F.coalesce(doc_id, text_key).alias("row"), F.col("text").cast("string").alias("text")
    )


ENTRY = "bucket int, part long, sigs binary, places binary, nodes binary, hot binary"
# bytes of a signature inside its bucket: buckets grow with the data, so few signatures fall together by chance
SIG = 4


def _bucket(sig: np.ndarray, buckets: int) -> np.ndarray:
    return ((sig >> U(40)) % U(buckets)).astype(np.int64)


def signature_entries(docs: DataFrame, buckets: int, words: int = WORDS) -> DataFrame:
    """Signatures of each different set of a run of rows, packed by the bucket of the signature.

    A task packs equal sets once, so of a hot set each task sends one copy.  ``part`` is 0 but for
    the sets of a signature that is hot in the task: those rows are groups of their own, and the
    bucket is told of the signature in ``hot``.
    """

    def pack(sig: np.ndarray, place: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        sig = sig & U((1 << (40 + 23)) - 1)
        bucket = _bucket(sig, buckets)
        sig = sig & U((1 << 8 * SIG) - 1)
        order = np.lexsort((sig, bucket))
        sig, place, bucket = sig[order], place[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (bucket[1:] != bucket[:-1])]))
        n = np.diff(first, append=len(sig))
        many = np.repeat(n > HOT, n)
        out: list[tuple] = []
        hot: dict[int, list[int]] = {}
        for a, size in zip(first[n > HOT].tolist(), n[n > HOT].tolist()):
            own = nodes[np.unique(place[a : a + size])]
            hot.setdefault(int(bucket[a]), []).append(int(sig[a]))
            # any number but 0 that tells this row from those of other tasks
            part = int(own["key"][0] >> U(1)) | 1
            out.append((int(bucket[a]), part, planes(sig[a : a + 1], SIG), b"", own.tobytes(), b""))
        sig, place, bucket = sig[~many], place[~many], bucket[~many]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else np.zeros(0, np.int64)
        for a, b in zip(edges[:-1], edges[1:]):
            used, index = np.unique(place[a:b], return_inverse=True)
            told = hot.pop(int(bucket[a]), [])
            out.append((int(bucket[a]), 0, planes(sig[a:b], SIG), planes(index.astype(U), 3), nodes[used].tobytes(), planes(np.array(told, dtype=U), SIG)))
        out += [(b, 0, b"", b"", b"", planes(np.array(told, dtype=U), SIG)) for b, told in hot.items()]
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[2:])],
            ["bucket", "part", "sigs", "places", "nodes", "hot"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, places, nodes, held, n_nodes = [], [], [], 0, 0
        seen: set[int] = set()
        for batch in batches:
            for _, _, block, offsets in utf8_blocks(batch.column(0), BLOCK):
                elements, begin = shingle_sets(block, offsets, words)
                own = set_keys(elements, begin)
                fresh = np.zeros(len(own), dtype=bool)
                for i, key in enumerate(own.tolist()):
                    if begin[i + 1] > begin[i] and key not in seen:
                        seen.add(key)
                        fresh[i] = True
                if len(seen) > 1 << 17:
                    seen.clear()
                sig, index, node = signatures(elements, begin)
                live = fresh[node[index, 0]] if len(index) else np.zeros(0, dtype=bool)
                table = np.empty(len(node), dtype=NODE)
                table["key"], table["band"], table["need"] = own[node[:, 0]], node[:, 1], node[:, 2]
                sigs.append(sig[live])
                places.append(index[live] + n_nodes)
                nodes.append(table)
                n_nodes += len(table)
                held += int(live.sum())
                if held >= FLUSH:
                    yield pack(np.concatenate(sigs), np.concatenate(places), np.concatenate(nodes))
                    sigs, places, nodes, held, n_nodes = [], [], [], 0, 0
        if held:
            yield pack(np.concatenate(sigs), np.concatenate(places), np.concatenate(nodes))

    return docs.select(F.col("text").cast("string")).mapInArrow(rows, ENTRY)


NODE = np.dtype([("key", "<u8"), ("need", "u1"), ("band", "u1")])
GROUP = "group_id long, set_key long, band int, need int, times int"


def shared_groups(entries: DataFrame) -> DataFrame:
    """The different sets that share a signature: (group_id, set_key, band, need, times).

    Equal small groups of a bucket come once, with their number.  Sets of a hot signature come
    without regard to others.
    """

    def named(sig: np.ndarray, bucket: int) -> np.ndarray:
        return mix(mix(sig) + U(bucket))

    def rows(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if key[1].as_py():
            # the sets of a hot signature
            parts = [(from_planes(s, SIG), np.frombuffer(k, dtype=NODE)) for s, k in zip(*(table.column(i).to_pylist() for i in (2, 4)))]
            ids = [np.repeat(named(s, bucket), len(node)) for s, node in parts]
            ids, node = np.concatenate(ids), np.concatenate([node for _, node in parts])
            return made(ids, node, np.ones(len(ids), dtype=np.int32))
        sigs, nodes, hot = [], [], []
        for i in range(table.num_rows):
            s, p, k, h = (table.column(c)[i].as_py() for c in ("sigs", "places", "nodes", "hot"))
            sigs.append(from_planes(s, SIG))
            nodes.append(np.frombuffer(k, dtype=NODE)[from_planes(p, 3).astype(np.int64)])
            hot.append(from_planes(h, SIG))
        sig, node, hot = np.concatenate(sigs), np.concatenate(nodes), np.unique(np.concatenate(hot))
        del sigs, nodes, table
        order = np.argsort(sig, kind="stable")
        again = np.zeros(len(sig), dtype=bool)
        same = sig[order[1:]] == sig[order[:-1]]
        again[1:] |= same
        again[:-1] |= same
        if len(hot):
            again |= np.isin(sig[order], hot)
        order = order[again]
        sig, node = sig[order], node[order]
        order = np.lexsort((node["key"], sig))
        sig, node = sig[order], node[order]
        fresh = np.ones(len(sig), dtype=bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (node["key"][1:] != node["key"][:-1])
        sig, node = sig[fresh], node[fresh]
        if not len(sig):
            return made(sig, node, np.zeros(0, dtype=np.int32))
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        n = np.diff(np.append(first, len(sig)))
        # a group is named by its members, so equal groups of other signatures fall together
        name = mix(np.add.reduceat(mix(node["key"] + mix(node["band"].astype(U))), first) + n.astype(U))
        _, one, times = np.unique(name, return_index=True, return_counts=True)
        chosen = np.zeros(len(first), dtype=np.int32)
        chosen[one] = times
        # small groups once, large and hot ones as often as they are, named by their signature
        wide = (n > LARGE) | np.isin(sig[first], hot)
        small, large = np.repeat((chosen > 0) & (n > 1) & ~wide, n), np.repeat(wide, n)
        ids = np.concatenate([np.repeat(name, n)[small], named(sig[large], bucket)])
        times = np.concatenate([np.repeat(chosen, n)[small], np.ones(int(large.sum()), dtype=np.int32)])
        return made(ids, np.concatenate([node[small], node[large]]), times)

    def made(ids: np.ndarray, node: np.ndarray, times: np.ndarray) -> pa.Table:
        return pa.table({
            "group_id": signed(ids), "set_key": signed(node["key"]), "band": node["band"].astype(np.int32),
            "need": node["need"].astype(np.int32), "times": times,
        })

    return entries.groupBy("bucket", "part").applyInArrow(rows, GROUP)


def needed_groups(shared: DataFrame) -> DataFrame:
    """(group_id, set_key) of stored :func:`shared_groups`, after each set left its largest groups."""
    # equal groups of several buckets, and sets that several tasks sent for a hot signature; counting these
    # more than once leaves fewer groups, never more
    shared = shared.groupBy("group_id", "set_key", "band").agg(F.max("need").alias("need"), F.sum("times").alias("times"))
    sizes = shared.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1")
    by_size = Window.partitionBy("set_key", "band").orderBy(F.desc("n"), "group_id")
    held = shared.join(sizes, "group_id").withColumn("at", F.sum("times").over(by_size))
    return held.where("at >= need").select("group_id", "set_key").distinct()


def candidate_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """(set_key, elements): the packed set of each wanted (row, set_key), read from the texts again."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, block, offsets in utf8_blocks(batch.column(1), BLOCK):
                elements, begin = shingle_sets(block, offsets, words)
                keys = signed(set_keys(elements, begin))
                asked = batch.column(0).slice(first, len(keys)).to_numpy()
                hit = np.flatnonzero((keys == asked) & (np.diff(begin) > 0))
                # the top bytes, in order, so that planes of sorted values compress
                packed = [planes(elements[begin[i] : begin[i + 1]] >> U(64 - 8 * WIDTH), WIDTH) for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[hit]), pa.array(packed, pa.binary())], ["set_key", "elements"]
                )

    asked = _identified(docs).join(wanted, "row")
    found = asked.select("set_key", "text").mapInArrow(rows, "set_key long, elements binary")
    # an id may be repeated with other texts: those rows have another key and are gone
    return found.groupBy("set_key").agg(F.first("elements").alias("elements"))


def possible(pairs: DataFrame, kinds: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and cells (of ``kinds``) allow a link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, CELLS).astype(np.int16)
                for i in (4, 5)
            )
            apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
            # common elements are at most (n + m - apart) / 2
            keep = pa.array(100 * (n + m - apart) >= NUMERATOR * (n + m + apart))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    left = kinds.select(F.col("set_key").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca"))
    right = kinds.select(F.col("set_key").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb"))
    held = pairs.join(left, "a").join(right, "b")
    held = held.where(f"100 * least(na, nb) >= {NUMERATOR} * greatest(na, nb)")
    return held.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(rows, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= NUMERATOR * (len(both) - common)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set keys whose sets link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, x = [], None, None
            for i, (a, left, right) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)))):
                if a != last:
                    last, x = a, from_planes(left, WIDTH)
                if linked(x, from_planes(right, WIDTH)):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])

    left = sets.withColumnsRenamed({"set_key": "a", "elements": "x"})
    right = sets.withColumnsRenamed({"set_key": "b", "elements": "y"})
    held = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return held.mapInArrow(rows, "a long, b long")


def first_pairs(groups: DataFrame) -> DataFrame:
    """(a, b): each set with the smallest set of its groups, the one it meets as such most often."""
    low = groups.groupBy("group_id").agg(F.min("set_key").alias("a"))
    met = groups.join(low, "group_id").where("set_key <> a").groupBy("set_key", "a").agg(F.count("*").alias("n"))
    best = met.groupBy("set_key").agg(F.min(F.struct((-F.col("n")).alias("n"), "a")).alias("r"))
    return best.select("r.a", F.col("set_key").alias("b"))


def open_groups(groups: DataFrame, classes: DataFrame | None) -> DataFrame:
    """(group_id, set_key, component) of the groups that hold sets of different components."""
    if classes is None:
        named = groups.withColumn("component", F.col("set_key"))
    else:
        named = groups.join(classes, F.col("set_key") == F.col("node"), "left")
        named = named.select("group_id", "set_key", F.coalesce("component", "set_key").alias("component"))
    differ = named.groupBy("group_id").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d")
    return named.join(differ.select("group_id"), "group_id", "left_semi")


def block_pairs(groups: DataFrame, kinds: DataFrame) -> DataFrame:
    """(unit, side, set_key, component, n, cells): each pair of blocks of a group as one unit.

    A group is cut by hash into blocks of about ``BLOCK_SETS`` sets and ``BLOCK_BYTES`` of elements;
    ``side`` tells the blocks of a unit apart, and is 2 where a block meets itself.
    """
    sized = groups.join(kinds.select("set_key", "n"), "set_key")
    cuts = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") * WIDTH / BLOCK_BYTES))
    wide = sized.groupBy("group_id").agg(cuts.cast("int").alias("blocks"))
    held = groups.join(wide, "group_id").withColumn("own", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.xxhash64("group_id", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return held.select(unit.alias("unit"), side.alias("side"), "set_key", "component").join(kinds.select("set_key", "n", "cells"), "set_key")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal values in the first column, of rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy(zero_copy_only=False)
        if held and held[-1].column(0)[-1].as_py() == unit[-1]:
            held.append(batch)
            continue
        # what lies before the last run of the batch is whole
        cut = len(unit) - int(np.argmax(unit[::-1] != unit[-1])) if (unit != unit[-1]).any() else 0
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _cell_table(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("cells").to_pylist()), dtype=np.uint8).reshape(-1, CELLS)


def possible_pairs(
    unit: np.ndarray, side: np.ndarray, component: np.ndarray, n: np.ndarray, cells: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of rows of one unit whose sizes and cells allow a link, and whose components differ.

    Rows come by unit and size; a row is compared with those one place on, two places on and so
    on, until none is left whose size is close enough.
    """
    at, lag = np.arange(len(unit)), 0
    total = cells.sum(axis=1, dtype=np.int64)
    while True:
        lag += 1
        at = at[at + lag < len(unit)]
        # sizes ascend inside a unit: what fails once fails further on
        at = at[(unit[at] == unit[at + lag]) & (100 * n[at] >= NUMERATOR * n[at + lag])]
        if not len(at):
            return
        asked = at[(component[at] != component[at + lag]) & ((side[at] == 2) | (side[at] != side[at + lag]))]
        for first in range(0, len(asked), PAIRS):
            i = asked[first : first + PAIRS]
            j = i + lag
            # differences of cells, counted to 255, are at most those of the sets
            apart = total[i] + total[j] - 2 * np.minimum(cells[i], cells[j]).sum(axis=1, dtype=np.int64)
            keep = 100 * (n[i] + n[j] - apart) >= NUMERATOR * (n[i] + n[j] + apart)
            if keep.any():
                yield i[keep], j[keep]


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if (above == parent).all():
            return parent
        parent = above


def families(units: DataFrame) -> DataFrame:
    """(a, b): each set of a unit that the cells leave with others, and one that pairs of them lead to."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            unit, side, key, component, n = (table.column(c).to_numpy() for c in ("unit", "side", "set_key", "component", "n"))
            parent = np.arange(len(unit))
            for i, j in possible_pairs(unit, side, component, n, _cell_table(table)):
                # the smallest place reachable becomes the name, a few rounds at a time
                while True:
                    parent = _roots(parent)
                    a, b = parent[i], parent[j]
                    if (a == b).all():
                        break
                    np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            parent = _roots(parent)
            led = np.flatnonzero(parent != np.arange(len(parent)))
            yield pa.RecordBatch.from_arrays([pa.array(key[parent[led]]), pa.array(key[led])], ["a", "b"])

    held = units.select("unit", "side", "set_key", "component", "n", "cells").repartition("unit").sortWithinPartitions("unit", "n", "set_key")
    return held.mapInArrow(rows, "a long, b long").distinct()


def joining_links(held: DataFrame) -> DataFrame:
    """(a, b) of verified links that join two components of a unit.

    ``held`` has the columns of :func:`block_pairs` and ``elements``.  A task goes through the pairs
    that may link and keeps track of what is joined, so a unit gives fewer links than it has sets.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            unit, side, key, component, n = (table.column(c).to_numpy() for c in ("unit", "side", "set_key", "component", "n"))
            packed, sets = table.column("elements"), {}
            parent: dict[tuple[int, int], tuple[int, int]] = {}

            def root(place: int) -> tuple[int, int]:
                x = int(unit[place]), int(component[place])
                while x in parent:
                    up = parent[x]
                    if up in parent:
                        parent[x] = parent[up]
                    x = up
                return x

            def elements(place: int) -> np.ndarray:
                if place not in sets:
                    sets[place] = from_planes(packed[place].as_py(), WIDTH)
                return sets[place]

            out = []
            for i, j in possible_pairs(unit, side, component, n, _cell_table(table)):
                for a, b in zip(i.tolist(), j.tolist()):
                    x, y = root(a), root(b)
                    if x != y and linked(elements(a), elements(b)):
                        parent[x] = y
                        out.append((min(int(key[a]), int(key[b])), max(int(key[a]), int(key[b]))))
            cols = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    rows_of = held.select("unit", "side", "set_key", "component", "n", "cells", "elements")
    return rows_of.repartition("unit").sortWithinPartitions("unit", "n", "set_key").mapInArrow(rows, "a long, b long")


def link_classes(groups: DataFrame, kinds: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame | None:
    """(node, component) over set keys that link with another set; None when no sets link.

    ``groups`` (group_id, set_key) and ``kinds`` are stored tables.
    """

    def whole_sets(keys: DataFrame) -> DataFrame:
        # written, so that Spark knows its size when it plans the join with the texts
        return materialize(candidate_sets(docs, materialize(keys.join(kinds, "set_key").select("set_key", "row")), words))

    links, classes = None, None
    close = materialize(possible(first_pairs(groups), kinds))
    if not close.isEmpty():
        keys = close.select(F.col("a").alias("set_key")).unionByName(close.select(F.col("b").alias("set_key"))).distinct()
        links = materialize(verified(close, whole_sets(keys)))
        if not links.isEmpty():
            classes = materialize(components(links))
    rest = materialize(open_groups(groups, classes))
    if rest.isEmpty():
        return classes
    leads = materialize(families(block_pairs(rest, kinds)))
    if leads.isEmpty():
        return classes
    named = materialize(components(leads)).select(F.col("component").alias("group_id"), F.col("node").alias("set_key"))
    sets = whole_sets(named.select("set_key"))
    held = materialize(open_groups(named, classes))
    more = materialize(joining_links(block_pairs(held, kinds).join(sets, "set_key")))
    if more.isEmpty():
        return classes
    return materialize(components(more if links is None else links.unionByName(more)))


def classes_of(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """A row per document (doc_id, text_key, n_shingles, set_key), and (set_key, component) of all sets.

    ``component`` is the smallest key of the sets that are reachable over links.
    """
    members = materialize(member_table(docs, words))
    kinds = members.where("set_key is not null").groupBy("set_key").agg(
        F.min(F.coalesce("doc_id", "text_key")).alias("row"), F.first("n_shingles").alias("n"), F.first("cells").alias("cells")
    )
    kinds = materialize(kinds)
    elements = kinds.agg(F.sum("n")).first()[0] or 0
    # about one signature per element
    buckets = max(partitions(docs.sparkSession), -(-elements // BUCKET))
    shared = materialize(shared_groups(signature_entries(docs, buckets, words)))
    groups = materialize(needed_groups(shared))
    discard(shared)
    classes = link_classes(groups, kinds, docs, words)
    named = kinds.select("set_key")
    if classes is None:
        named = named.withColumn("component", F.col("set_key"))
    else:
        named = named.join(classes, F.col("set_key") == F.col("node"), "left")
        named = named.select("set_key", F.coalesce("component", "set_key").alias("component"))
    return members.drop("cells"), named


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links, the row's own included;
    for a document without shingles it is its own id.
    """
    with temporary(docs.sparkSession) as kept, small_batches(docs.sparkSession):
        kept.append(materialize(_named_documents(docs, words)))
    return kept[0]


def _named_documents(docs: DataFrame, words: int) -> DataFrame:
    members, named = classes_of(docs, words)
    sets = members.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    named = sets.join(named, "set_key")
    best = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    best = named.join(best, "component").select("set_key", "component_id")
    joined = members.join(best, "set_key", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id, and all rows without shingles.

    Ids come before no id; among rows of one id the smallest text fingerprint decides, and of
    rows that agree in both any one stays.
    """
    spark = docs.sparkSession
    with temporary(spark) as kept, small_batches(spark):
        members, named = classes_of(docs, words)
        rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
        named = members.where("set_key is not null").join(named, "set_key")
        best = named.groupBy("component").agg(F.min(rank).alias("r")).select("r.doc_id", "r.text_key")
        kept.append(materialize(best))
        twice = members.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1")
        repeated = not twice.isEmpty()
    own_key, one_id, one_key = unused(docs, "own_key", "one_id", "one_key")
    best = kept[0].toDF(one_id, one_key)
    own = docs.withColumn(own_key, _text_key(F.col("text")))
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = (F.col(own_key) == F.col(one_key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(one_id))
    chosen = own.where(worded).join(best, same, "left_semi")
    if repeated:
        chosen = chosen.dropDuplicates(["doc_id", own_key])
    return chosen.drop(own_key).unionByName(docs.where(~worded))
