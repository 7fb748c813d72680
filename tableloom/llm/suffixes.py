"""Removal of byte strings that occur again anywhere, by a distributed suffix sort.

Every ``length``-byte string that starts at two places or more is removed at all of them.
The suffixes that have to be sorted are found first.  A window of ``length`` bytes belongs
to its anchor: the leftmost of the ``GRAM``-byte grams in it with the least hash, so equal
windows have equal anchors at equal offsets.  Neighbouring windows with one anchor form a
run.  Runs are compared by two fingerprints: with a gram of its own, all windows of a run
are unique; with the bytes from its first window's start to its last one's end found again,
all of them are repeated.  What is left, near the ends of repeated passages, goes on.

Suffixes of those windows are range-partitioned by their leading bytes with sampled
splitters.  Only ``length`` bytes of a suffix matter and only their equality, so a suffix
travels as six leading bytes and a fingerprint of its window.  Each bucket is sorted by the
leading word, equal stretches by the next one (multikey order), and neighbours are compared.
Splitters lie between different (leading bytes, fingerprint) keys, so equal windows never
lie on two sides of a bucket's boundary, however frequent their leading bytes are.

A task sends one entry for what it holds several times and settles the others itself; a
bucket gets at most an entry per task for any text, passage or window.

Defined results: a null text is empty; texts shorter than ``length`` stay whole; equal texts
in several rows, whole rows repeated included, remove each other; a null ``doc_id`` is a
document like others; other columns are ignored.  Texts, runs and windows are told apart by
64-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import (
    U, byte_values, fingerprint, from_planes, partitions, planes, powers, prefix_sums, signed, small_batches, unsigned, unused,
    utf8_blocks,
)
from tableloom.plans.scratch import discard, materialize, temporary

LENGTH = 200
GRAM = 96
# entries a task packs at a time, bytes of a block of texts
FLUSH = 1 << 18
BLOCK = 1 << 19
# sampled suffixes per bucket, for the splitters
SAMPLE = 64

REPEATED, OPEN, BOTH = 1, 2, 3
_VALUES = byte_values()


def runs_of(block: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, number in the text, anchor, first window, last window) of all runs, and the prefix sums."""
    n = len(block)
    sums = prefix_sums(block, _VALUES)
    empty = np.zeros(0, dtype=np.int64)
    if n < length:
        return empty, empty, empty, empty, empty, sums
    _, down = powers(n + 1)
    order = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    order ^= order >> U(31)
    order *= U(0x94D049BB133111EB)
    order &= U(0xFFFFFFFF00000000)
    order |= np.arange(len(order), dtype=U)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        order = np.minimum(order[:-width], order[width:])
        width *= 2
    if width < span:
        order = np.minimum(order[: len(order) - (span - width)], order[span - width :])
    # windows inside one text
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    if not len(text):
        return empty, empty, empty, empty, empty, sums
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[text]
    anchor = (order[start] & U(0xFFFFFFFF)).astype(np.int64)
    cut = np.ones(len(start), dtype=bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(start)) - 1
    text = text[first]
    number = np.arange(len(first)) - np.searchsorted(text, text)
    return text, number, anchor[first], start[first], start[last], sums


# states of runs or windows, packed by a hash of the text's key, and then by the key
BY_HASH = "part int, keys binary, numbers binary, states binary"
BY_KEY = "key long, numbers binary, states binary"


def _by_hash(key: np.ndarray, number: np.ndarray, state: np.ndarray, parts: int) -> pa.Table:
    """Rows of :data:`BY_HASH`; sorted by key, so that keys compress."""
    part = ((key >> U(20)) % U(parts)).astype(np.int64)
    order = np.lexsort((number, key, part))
    key, number, state, part = key[order], number[order].astype("<u4"), state[order].astype(np.uint8), part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    spans = list(zip(edges[:-1], edges[1:]))
    columns = [[x[a:b].tobytes() for a, b in spans] for x in (key, number, state)]
    return pa.table({
        "part": pa.array([int(part[a]) for a, _ in spans], pa.int32()),
        **{n: pa.array(c, pa.binary()) for n, c in zip(("keys", "numbers", "states"), columns)},
    })


def _by_key(packed: DataFrame) -> DataFrame:
    """One row per key with all its numbers and states, from rows of :data:`BY_HASH`."""

    def rows(table: pa.Table) -> pa.Table:
        key, number, state = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=kind)
            for c, kind in (("keys", U), ("numbers", "<u4"), ("states", np.uint8))
        )
        order = np.argsort(key, kind="stable")
        key, number, state = key[order], number[order], state[order]
        first = np.flatnonzero(_first_of([key])) if len(key) else np.zeros(0, np.int64)
        spans = list(zip(first, np.append(first[1:], len(key))))
        return pa.table({
            "key": pa.array(signed(key[first])),
            "numbers": pa.array([number[a:b].tobytes() for a, b in spans], pa.binary()),
            "states": pa.array([state[a:b].tobytes() for a, b in spans], pa.binary()),
        })

    return packed.groupBy("part").applyInArrow(rows, BY_KEY)


# local is true for rows that a task has settled itself: (key, numbers, states) in a, b, c
PACKED = "bucket int, settled boolean, a binary, b binary, c binary, d binary, e binary"
_NAMES = ["bucket", "settled", "a", "b", "c", "d", "e"]


def _packed(bucket, settled, *columns) -> pa.RecordBatch:
    columns = list(columns) + [[None] * len(bucket)] * (5 - len(columns))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([settled] * len(bucket)), *(pa.array(c, pa.binary()) for c in columns)], _NAMES
    )


def _settled(key: np.ndarray, number: np.ndarray, state: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Settled entries, on their way to the buckets' output; any bucket will do."""
    to = int(key[0] % U(buckets)) if len(key) else 0
    return _packed([to], True, [key.tobytes()], [number.astype("<u4").tobytes()], [state.astype(np.uint8).tobytes()])


def _first_of(sorted_columns: list[np.ndarray]) -> np.ndarray:
    """Marks the first entry of each stretch of equal entries."""
    n = len(sorted_columns[0])
    out = np.ones(n, dtype=bool)
    if n > 1:
        same = np.ones(n - 1, dtype=bool)
        for column in sorted_columns:
            same &= column[1:] == column[:-1]
        out[1:] = ~same
    return out


def _spans(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the number of its stretch, and the stretches' sizes."""
    number = np.cumsum(first) - 1
    return number, np.bincount(number) if len(number) else np.zeros(0, np.int64)


def run_entries(texts: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Entries of the runs of (key, text), packed by the bucket of the gram."""

    def pack(g, u, key, number) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((u, g))
        g, u, key, number = g[order], u[order], key[order], number[order]
        first_g, first_u = _first_of([g]), _first_of([g, u])
        of_g, size_g = _spans(first_g)
        of_u, size_u = _spans(first_u)
        kinds = np.bincount(of_g, weights=first_u).astype(np.int64)[of_g]
        twice = size_u[of_u] > 1
        # one run stands for its gram; the others are settled here
        state = np.where(twice, REPEATED, OPEN).astype(np.uint8)
        state[twice & first_u & (kinds > 1)] = BOTH
        here = ~first_g | (kinds > 1)
        if here.any():
            yield _settled(key[here], number[here], state[here], buckets)
        # what is sent: 0 once here, 1 several equal runs here, 2 different runs with the gram here
        flag = np.where(kinds > 1, 2, np.where(size_g[of_g] > 1, 1, 0)).astype(np.uint8)
        g, u, key, number, flag = (x[first_g] for x in (g, u, key, number, flag))
        bucket = ((g >> U(40)) % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            names, index = np.unique(key[at], return_inverse=True)
            place = (index.astype(U) << U(32)) | number[at].astype(U)
            out.append((int(bucket[at[0]]), planes(g[at], 8), planes(u[at], 6), planes(place, 7), names.tobytes(), flag[at].tobytes()))
        if out:
            cols = list(zip(*out))
            yield _packed(cols[0], False, *cols[1:])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n, seen = 0, set()
        for batch in batches:
            for first, end, block, offsets in utf8_blocks(batch.column(1), BLOCK):
                keys = unsigned(batch.column(0).slice(first, end - first).to_numpy(zero_copy_only=False))
                text, number, anchor, low, high, sums = runs_of(block, offsets, length, gram)
                fresh = np.zeros(len(keys), dtype=bool)
                for i, k in enumerate(keys.tolist()):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                if len(seen) > 1 << 17:
                    seen.clear()
                keep = fresh[text]
                text, number, anchor, low, high = (x[keep] for x in (text, number, anchor, low, high))
                held.append((fingerprint(sums, anchor, anchor + gram), fingerprint(sums, low, high + length), keys[text], number))
                n += len(text)
                if n >= FLUSH:
                    yield from pack(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
        if n:
            yield from pack(*map(np.concatenate, zip(*held)))

    return texts.select("key", "text").mapInArrow(rows, PACKED)


def run_states(entries: DataFrame, spread: int) -> DataFrame:
    """(key, numbers, states) of the runs that are repeated or open; the others' windows are unique."""

    def rows(table: pa.Table) -> pa.Table:
        keys, numbers, states, parts = [], [], [], []
        for settled, a, b, c, d, e in zip(*(table.column(i).to_pylist() for i in range(1, 7))):
            if settled:
                keys.append(np.frombuffer(a, dtype=U))
                numbers.append(np.frombuffer(b, dtype="<u4").astype(np.int64))
                states.append(np.frombuffer(c, dtype=np.uint8))
            else:
                place = from_planes(c, 7)
                parts.append((
                    from_planes(a, 8), from_planes(b, 6), np.frombuffer(d, dtype=U)[(place >> U(32)).astype(np.int64)],
                    (place & U(0xFFFFFFFF)).astype(np.int64), np.frombuffer(e, dtype=np.uint8),
                ))
        if parts:
            g, u, key, number, flag = map(np.concatenate, zip(*parts))
            order = np.lexsort((number, key, u, g))
            # a text that several tasks hold comes once
            order = order[_first_of([g[order], u[order], key[order], number[order]])]
            g, u, key, number, flag = (x[order] for x in (g, u, key, number, flag))
            first_g, first_u = _first_of([g]), _first_of([g, u])
            of_g, size_g = _spans(first_g)
            of_u, size_u = _spans(first_u)
            mixed = (np.bincount(of_g, weights=first_u) + np.bincount(of_g, weights=flag == 2) > 1)[of_g]
            twice = (size_u[of_u] > 1) | (np.bincount(of_u, weights=flag == 1) > 0)[of_u]
            state = np.where(twice, REPEATED, OPEN).astype(np.uint8)
            state[twice & first_u & mixed] = BOTH
            keep = (twice | mixed) & ((flag != 2) | twice)
            # runs of gram kinds settled in their task keep what was said there, and may be repeated besides
            state[(flag == 2) & twice] = BOTH
            keys.append(key[keep])
            numbers.append(number[keep])
            states.append(state[keep])
        if not keys:
            keys, numbers, states = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint8)]
        return _by_hash(np.concatenate(keys), np.concatenate(numbers), np.concatenate(states), spread)

    return _by_key(entries.groupBy("bucket").applyInArrow(rows, BY_HASH))


OPEN_TEXT = "key long, text string, repeated binary, open binary"


def open_texts(texts: DataFrame, states: DataFrame, length: int, gram: int) -> DataFrame:
    """Texts with repeated or open runs: (key, text, repeated, open), packed (first, last) windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, states = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for first, end, block, offsets in utf8_blocks(batch.column(1), BLOCK):
                text, _, _, low, high, _ = runs_of(block, offsets, length, gram)
                begin = np.searchsorted(text, np.arange(end - first + 1))
                repeated, open_ = [], []
                for i in range(end - first):
                    at = np.frombuffer(numbers[first + i], dtype="<u4").astype(np.int64) + begin[i]
                    state = np.frombuffer(states[first + i], dtype=np.uint8)
                    for out, bit in ((repeated, REPEATED), (open_, OPEN)):
                        runs = np.unique(at[(state & bit) > 0])
                        both = np.stack([low[runs], high[runs]], axis=1) - offsets[i]
                        out.append(both.astype("<i8").tobytes())
                size = end - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, size), batch.column(1).slice(first, size),
                        pa.array(repeated, pa.binary()), pa.array(open_, pa.binary()),
                    ],
                    ["key", "text", "repeated", "open"],
                )

    return texts.join(states, "key").select("key", "text", "numbers", "states").mapInArrow(rows, OPEN_TEXT)


def _windows(batches: Iterator[pa.RecordBatch], length: int):
    """(key, start, leading word, fingerprint) of the open windows of (key, text, open)."""
    for batch in batches:
        opened = batch.column(2).to_pylist()
        for first, end, block, offsets in utf8_blocks(batch.column(1), BLOCK):
            sums = prefix_sums(block, _VALUES)
            keys = unsigned(batch.column(0).slice(first, end - first).to_numpy(zero_copy_only=False))
            pairs = [np.frombuffer(x, dtype="<i8").reshape(-1, 2) for x in opened[first:end]]
            owner = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
            if not len(owner):
                continue
            pairs = np.concatenate(pairs)
            n = pairs[:, 1] - pairs[:, 0] + 1
            start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(pairs[:, 0], n)
            owner = np.repeat(owner, n)
            at = start + offsets[owner]
            word = np.zeros(len(at), dtype=U)
            for k in range(6):
                word = (word << U(8)) | block[at + k].astype(U)
            mark = fingerprint(sums, at, at + length)
            yield keys[owner], start, (word << U(16)) | (mark >> U(48)), mark


def splitters(opened: DataFrame, buckets: int, length: int) -> np.ndarray:
    """Leading words that cut the open windows into buckets of similar size, from a sample of them.

    The sample holds about ``SAMPLE`` windows per bucket, whatever the size of the input.
    """
    total = opened.agg(F.sum(F.length("open") / 16)).first()[0] or 0
    step = max(1, int(total * 40 / (SAMPLE * buckets)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, word, mark in _windows(batches, length):
            chosen = word[(mark >> U(8)) % U(step) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(signed(chosen))], ["word"])

    drawn = opened.select("key", "text", "open").mapInArrow(rows, "word long").distinct().collect()
    words = np.sort(unsigned(np.array([r.word for r in drawn], dtype=np.int64)))
    if not len(words):
        return words
    return np.unique(words[np.arange(1, buckets) * len(words) // buckets])


def suffix_entries(opened: DataFrame, cuts: np.ndarray, length: int) -> DataFrame:
    """Entries of the open windows, packed by the bucket of their leading word."""
    buckets = len(cuts) + 1

    def pack(key, start, word, mark) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((mark, word))
        key, start, word, mark = key[order], start[order], word[order], mark[order]
        first = _first_of([word, mark])
        of, size = _spans(first)
        twice = size[of] > 1
        if (~first).any():
            yield _settled(key[~first], start[~first], np.ones((~first).sum(), dtype=np.uint8), buckets)
        key, start, word, mark, twice = (x[first] for x in (key, start, word, mark, twice))
        bucket = np.searchsorted(cuts, word, side="right")
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            names, index = np.unique(key[a:b], return_inverse=True)
            place = (index.astype(U) << U(32)) | start[a:b].astype(U)
            out.append((int(bucket[a]), planes(word[a:b], 8), planes(mark[a:b], 6), planes(place, 7), names.tobytes(), twice[a:b].astype(np.uint8).tobytes()))
        cols = list(zip(*out))
        yield _packed(cols[0], False, *cols[1:])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in _windows(batches, length):
            held.append(part)
            n += len(part[0])
            if n >= FLUSH:
                yield from pack(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield from pack(*map(np.concatenate, zip(*held)))

    return opened.select("key", "text", "open").mapInArrow(rows, PACKED)


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Order by the first word; only stretches that it leaves equal are sorted by the next."""
    order = np.argsort(words[0], kind="stable")
    equal = [words[0]]
    for word in words[1:]:
        first = _first_of([x[order] for x in equal])
        of, size = _spans(first)
        tied = np.flatnonzero(size[of] > 1)
        if not len(tied):
            break
        at = order[tied]
        order[tied] = at[np.lexsort((word[at], of[tied]))]
        equal.append(word)
    return order


def repeated_starts(entries: DataFrame, spread: int) -> DataFrame:
    """(key, numbers): starts of the windows that are found at another place too."""

    def rows(table: pa.Table) -> pa.Table:
        keys, starts, parts = [np.zeros(0, dtype=U)], [np.zeros(0, dtype=np.int64)], []
        for settled, a, b, c, d, e in zip(*(table.column(i).to_pylist() for i in range(1, 7))):
            if settled:
                keys.append(np.frombuffer(a, dtype=U))
                starts.append(np.frombuffer(b, dtype="<u4").astype(np.int64))
            else:
                place = from_planes(c, 7)
                parts.append((
                    from_planes(a, 8), from_planes(b, 6), np.frombuffer(d, dtype=U)[(place >> U(32)).astype(np.int64)],
                    (place & U(0xFFFFFFFF)).astype(np.int64), np.frombuffer(e, dtype=np.uint8),
                ))
        if parts:
            word, mark, key, start, several = map(np.concatenate, zip(*parts))
            order = multikey_order([word, mark, key, start.astype(U)])
            # an entry that came twice, from a repeated task or row, counts once
            columns = [x[order] for x in (word, mark, key, start)]
            first = _first_of(columns)
            of, _ = _spans(_first_of(columns[:2]))
            twice = np.bincount(of, weights=first + several[order]) > 1
            keep = twice[of] & first
            keys.append(columns[2][keep])
            starts.append(columns[3][keep])
        key, start = np.concatenate(keys), np.concatenate(starts)
        return _by_hash(key, start, np.ones(len(key)), spread)

    return _by_key(entries.groupBy("bucket").applyInArrow(rows, BY_HASH)).drop("states")


KEPT = "key long, n_removed long, n_spans long, kept binary"


def cut_texts(opened: DataFrame, starts: DataFrame, length: int) -> DataFrame:
    """(key, n_removed, n_spans, kept) of the texts that lose bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, text, runs, more in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                depth = np.zeros(len(data) + length + 1, dtype=np.int64)
                runs = np.frombuffer(runs, dtype="<i8").reshape(-1, 2)
                np.add.at(depth, runs[:, 0], 1)
                np.add.at(depth, runs[:, 1] + length, -1)
                single = np.frombuffer(more or b"", dtype="<u4").astype(np.int64)
                np.add.at(depth, single, 1)
                np.add.at(depth, single + length, -1)
                gone = np.cumsum(depth)[: len(data)] > 0
                n = int(gone.sum())
                if n:
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((key, n, spans, data[~gone].tobytes()))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())],
                ["key", "n_removed", "n_spans", "kept"],
            )

    joined = opened.select("key", "text", "repeated").join(starts, "key", "left")
    return joined.select("key", "text", "repeated", "numbers").mapInArrow(rows, KEPT)


# bytes of different texts for each bucket of runs and of suffixes
BUCKET_BYTES = 32 << 20


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a fingerprint ``key`` of the whole text; a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumn("key", F.xxhash64("text"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """(key, n_removed, n_spans, kept) for each different text that loses bytes; ``key`` as in :func:`with_key`."""
    gram = GRAM if gram is None and length == LENGTH else gram or max(1, length // 2)
    spark = docs.sparkSession
    # equal texts: one of them goes on, named by its row's id and text
    texts = with_key(docs.select("doc_id", "text")).where(F.octet_length("text") >= length)
    texts = texts.select(F.coalesce(F.col("doc_id").cast("long"), "key").alias("row"), "key", "text")
    with temporary(spark) as left, small_batches(spark):
        kinds = materialize(texts.groupBy("key").agg(F.count("*").alias("copies"), F.min("row").alias("row"), F.first(F.octet_length("text")).alias("n")))
        # groups of bounded bytes, whatever the number of shuffle partitions
        size = kinds.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
        buckets = max(2 * partitions(spark), -(-size // BUCKET_BYTES))
        states = materialize(run_states(run_entries(texts, buckets, length, gram), buckets))
        chosen = kinds.select("key", "row").join(states.select("key"), "key", "left_semi")
        one = texts.join(chosen, ["row", "key"]).select("key", "text")
        opened = materialize(open_texts(one, states, length, gram))
        discard(states)
        cuts = splitters(opened, buckets, length)
        starts = repeated_starts(suffix_entries(opened, cuts, length), buckets)
        kept = materialize(cut_texts(opened, starts, length))
        left += [kinds, kept]
    alone = kept.join(kinds.where("copies = 1"), "key", "left_semi")
    copied = kinds.where("copies > 1").select(
        "key", F.col("n").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")
    )
    return alone.unionByName(copied)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs`` (doc_id, text)."""
    meta = with_key(docs.select("doc_id", "text")).select(
        "doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("whole")
    )
    cut = repeats(docs, length).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    joined = meta.join(cut, "key", "left")
    return joined.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``, and ``n_chars``, if there, counted anew.

    What is left of a character that a cut goes through is dropped.  All rows stay.
    """
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    key, kept = unused(docs, "cut_key", "cut_kept")
    cut = repeats(docs, length).select(F.col("key").alias(key), F.col("kept").alias(kept))
    joined = docs.withColumn(key, own).join(cut, key, "left")
    whole = F.make_valid_utf8(F.col(kept).cast("string"))
    clean = F.when(F.contains("text", F.lit("�")), whole).otherwise(F.translate(whole, "�", ""))
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(clean)
    out = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(kind))
    return joined.withColumns(out).select(*docs.columns)
