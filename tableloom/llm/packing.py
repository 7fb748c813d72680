"""Best-fit decreasing packing of tokenised documents into sequences of fixed capacity.

Documents become pieces of at most ``capacity`` tokens.  Best fit decreasing looks only at
lengths, and there are at most ``capacity`` different ones, so the packing of all pieces of
the input, however many, follows from how many have each length.  The plan is made over
these counts: open sequences are counted by remaining capacity in the leaves of a segment
tree, and the tightest one that still takes a piece is found in logarithmic time; runs of
equal pieces and equal sequences move together.  A piece then finds its place by its length
and its rank among the pieces of that length, which is a count inside its task plus an
offset per task.  The result is that of best fit decreasing run over all pieces at once.

Defined results: a null or empty text is the end token alone; equal rows are packed as rows of
their own; a null ``doc_id`` is carried along; other columns are ignored; no rows, no pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.plans.scratch import materialize

CAPACITY = 1024
END = 2


class CapacityTree:
    """Segment tree over remaining capacities 0..top; a leaf counts the open sequences that have it."""

    def __init__(self, top: int):
        self.size = 1
        while self.size <= top:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open sequence has."""
        at = least + self.size
        if self.count[at]:
            return least
        while at > 1:
            # a right sibling covers the next larger capacities
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset) of the packing.

    Pieces of a length, by rank from 0, fill ``pieces per sequence`` places of sequence after
    sequence from the row's first one on, until the next row's first rank.
    """
    tree = CapacityTree(capacity)
    # runs of open sequences by remaining capacity: [first sequence, how many]
    pools: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    plan, used = [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            pools[left].append([first, n])
            tree.add(left, n)

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            room = tree.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = used, -(-todo // per)
                used += n
            else:
                per = room // length
                run = pools[room][-1]
                n = min(run[1], -(-todo // per))
                first = run[0]
                run[0] += n
                run[1] -= n
                if not run[1]:
                    pools[room].pop()
                tree.add(room, -n)
            plan.append((length, rank, per, first, capacity - room))
            full = min(n, todo // per)
            put(room - per * length, first, full)
            if full < n:
                part = todo - full * per
                put(room - part * length, first + full, 1)
                full, rank, todo = n, rank + todo, 0
            else:
                rank += full * per
                todo -= full * per
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


_encoders: dict[str, tuple] = {}


def _vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def byte_ranks(path: str) -> tuple[dict[bytes, int], str]:
    """(id of each byte string but the added tokens, pattern of words) of a byte-level vocabulary file."""
    spec = _vocabulary(path)
    # the usual printable stand-ins for bytes: printable Latin-1 for itself, the rest from 256 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    return ranks, r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_encoder(path: str):
    """A function from texts to id arrays, as the byte-level vocabulary file at ``path`` gives them.

    Ids of ordinary text come from the vocabulary's ranks; a text with one of the file's added
    tokens in it goes through the file's own tokenizer.
    """
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        spec = _vocabulary(path)
        added = {t["content"] for t in spec["added_tokens"]}
        ranks, pattern = byte_ranks(path)
        fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()

        def encode(text: str) -> np.ndarray:
            if any(t in text for t in added):
                return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return np.array(fast.encode_ordinary(text), dtype="<u4")

        _encoders[path] = (encode,)
    return _encoders[path][0]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of the documents' ids plus the end token; ``rank`` counts a task's pieces of a length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        last = np.array([end], dtype="<u4")
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), last])
                data, n = ids.tobytes(), len(ids)
                head = n % capacity or capacity
                start = 0
                for piece, stop in enumerate(range(head, n + 1, capacity)):
                    length = stop - start
                    out.append((doc, piece, start, length, zlib.crc32(data[4 * start : 4 * stop]), task, int(ranks[length])))
                    ranks[length] += 1
                    start = stop
            cols = list(zip(*out)) if out else [[]] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, PIECE)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs``."""
    # ranks count on a stored order of rows, so the pieces are written once
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end))
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = materialize(counts)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # at most one row per length up to the capacity
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(totals, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    key = (plan[:, 0] << 48) + plan[:, 1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            step = rank - plan[at, 1]
            sequence = plan[at, 3] + step // plan[at, 2]
            offset = plan[at, 4] + step % plan[at, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )
    return ranked.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
