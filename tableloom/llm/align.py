"""Alignment of two tokenizers over the corpus, every distinct text once.

Texts are shuffled by their full text, so that copies meet and are counted where they are
written; each distinct text is then tokenised twice and aligned once.  Both token sequences
spell the same bytes.  Byte offsets at which a token of either ends cut them into groups, and
every token of A is linked with every token of B of its group.  How many documents hold a pair
of ids linked is the sum of the multiplicities of the distinct texts that hold it.

The aligned texts are written once, in blocks of bounded size: a row of measures per text, and
per block and bucket of A ids the pairs of ids, packed, with the texts that hold them.  Counts
of pairs are summed inside tasks before they are shuffled; a bucket's table of counts has at
most (A ids of the bucket) times (B ids) entries, whatever the corpus.  It meets the blocks of
its bucket in groups of a bounded number of blocks, which give every text its part of the
corpus-wide measures.  These are added per text and joined to all rows that have the text.

Defined results: a null or empty text, and one whose tokens do not spell a blank and the text
(one that holds U+2581), has zeros and an empty ``groups``; equal rows give equal results; a null
``doc_id`` is carried along; other columns are ignored; no rows give no rows.  Equal texts are
found by the texts themselves; their measures are joined by SHA-256 of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import from_planes, planes
from tableloom.llm.packing import byte_ranks
from tableloom.plans.scratch import materialize

# characters of texts that are aligned at a time, and links that are listed at a time
PART = 1 << 21
LINKS = 1 << 21
# texts and pair entries of a block, buckets of A ids, blocks that meet a bucket's counts at a time
TEXTS = 1 << 12
ENTRIES = 1 << 21
BUCKETS = 64
TOGETHER = 256


class Spelling:
    """Bytes of the ids of a vocabulary."""

    def __init__(self, parts: list[bytes]):
        self.size = np.array([len(p) for p in parts], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.size[ids])

    def spelt(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.blob[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class Pair:
    """Two tokenizers of the same texts, a byte-level one (A) and one of pieces (B)."""

    def __init__(self, byte_level: str, piece_model: str):
        import tiktoken

        ranks, pattern = byte_ranks(byte_level)
        # special tokens are not given to the encoder: their strings are plain text
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = lib = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        parts = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            parts[i] = token
        self.spell_a = Spelling(parts)
        names = [lib.id_to_piece(i) for i in range(lib.vocab_size())]
        self.spell_b = Spelling([
            bytes([int(t[3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else t.replace("▁", " ").encode()
            for i, t in enumerate(names)
        ])
        self.n_a, self.n_b = len(parts), len(names)
        # how a token is written: followed by a comma, or as the last of its part of a group
        self.written = [f"{i}{end}" for ends, n in ((",|", self.n_a), (",;", self.n_b)) for i in range(n) for end in ends]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both per text; both empty where they do not spell a blank and the text."""
        a = [np.array(self.a.encode_ordinary(" " + t), dtype=np.int64) for t in texts]
        b = [np.array(ids, dtype=np.int64) for ids in self.b.encode(texts, num_threads=1)]
        for i, text in enumerate(texts):
            want = b" " + text.encode()
            if self.spell_a.spelt(a[i]) != want or self.spell_b.spelt(b[i]) != want:
                a[i] = b[i] = np.zeros(0, dtype=np.int64)
        return a, b

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Measures (n_a, n_b, n_groups, n_links, groups) per text, and the different (pair, text)
        with their numbers of links: keys ``(a * n_b + b) << 20 | text``, ascending."""
        per_a, per_b = self.tokens(texts)
        size_a, size_b = (np.array([len(x) for x in p], dtype=np.int64) for p in (per_a, per_b))
        a, b = np.concatenate(per_a), np.concatenate(per_b)
        if not len(a):
            none = np.zeros(0, dtype=np.int64)
            return [(0, 0, 0, 0, "")] * len(texts), none, none
        # offsets run on over all texts; texts end at common ends
        end_a, end_b = self.spell_a.ends(a), self.spell_b.ends(b)
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        after_a, after_b = np.cumsum(n_a), np.cumsum(n_b)
        text = np.repeat(np.arange(len(texts)), size_a)
        owner = text[after_a - 1]
        groups = np.bincount(owner, minlength=len(texts))
        links = np.zeros(len(texts), dtype=np.int64)
        np.add.at(links, owner, n_a * n_b)
        # both sequences in the order of the groups, the tokens of A first
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        last = np.zeros(len(a), dtype=np.int64)
        last[after_a - 1] = 1
        codes[np.arange(len(a)) + (after_b - n_b)[group_a]] = 2 * a + last
        last = np.zeros(len(b), dtype=np.int64)
        last[after_b - 1] = 1
        codes[np.arange(len(b)) + after_a[group_b]] = 2 * (self.n_a + b) + last
        ends = np.cumsum(size_a + size_b).tolist()
        rows, at, written = [], 0, self.written.__getitem__
        for i, end in enumerate(ends):
            said = "".join(map(written, codes[at:end].tolist()))[:-1]
            digest = hashlib.sha256(said.encode()).hexdigest() if end > at else ""
            rows.append((int(size_a[i]), int(size_b[i]), int(groups[i]), int(links[i]), digest))
            at = end
        # links of runs of A tokens, a bounded number at a time
        times = n_b[group_a]
        ends = np.cumsum(times)
        keys, counts, first = [], [], 0
        while first < len(a):
            until = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LINKS, side="right")))
            n = times[first:until]
            left = np.repeat(np.arange(first, until), n)
            place = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            right = (after_b - n_b)[group_a[left]] + place
            key, count = np.unique((a[left] * self.n_b + b[right]) << 20 | text[left], return_counts=True)
            keys.append(key)
            counts.append(count)
            first = until
        return rows, *_summed(np.concatenate(keys), np.concatenate(counts))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


_loaded: dict[tuple[str, str], Pair] = {}

# a row of measures has a text_key, a row of links a bucket
ALIGNED = (
    "block long, at int, text_key binary, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "bucket int, texts int, pairs binary, runs binary, places binary, times binary, copies binary"
)
_COPIES = np.dtype([("at", "<u4"), ("copies", "<i8")])


def aligned_texts(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """Measures of each distinct text of ``docs``, and its links by block and bucket."""
    schema = pa.schema([
        ("block", pa.int64()), ("at", pa.int32()), ("text_key", pa.binary()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("bucket", pa.int32()), ("texts", pa.int32()),
        ("pairs", pa.binary()), ("runs", pa.binary()), ("places", pa.binary()), ("times", pa.binary()), ("copies", pa.binary()),
    ])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (byte_level, piece_model) not in _loaded:
            _loaded[byte_level, piece_model] = Pair(byte_level, piece_model)
        pair = _loaded[byte_level, piece_model]
        digests: list[bytes] = []
        measures: list[tuple] = []
        copies: list[int] = []
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            # distinct texts, so a block's first one names it
            name = int.from_bytes(digests[0][:8], "little", signed=True)
            key, time = np.concatenate(keys), np.concatenate(times)
            both, place = key >> 20, key & 0xFFFFF
            bucket = both // pair.n_b % BUCKETS
            order = np.lexsort((key, bucket))
            both, place, time, bucket = both[order], place[order], time[order], bucket[order]
            n = np.array(copies, dtype=np.int64)
            many = np.flatnonzero(n > 1)
            repeated = np.empty(len(many), dtype=_COPIES)
            repeated["at"], repeated["copies"] = many, n[many]
            out = [
                {"block": name, "at": i, "text_key": d, "n_a": m[0], "n_b": m[1], "n_groups": m[2], "n_links": m[3], "groups": m[4]}
                for i, (d, m) in enumerate(zip(digests, measures))
            ]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist() if len(bucket) else []
            for s, e in zip(edges, edges[1:]):
                first = np.flatnonzero(np.diff(both[s:e], prepend=-1))
                out.append({
                    "block": name, "bucket": int(bucket[s]), "texts": len(digests), "pairs": planes(both[s:e][first], 6),
                    "runs": planes(np.diff(first, append=e - s), 4), "places": planes(place[s:e], 3), "times": planes(time[s:e], 4),
                    "copies": repeated.tobytes(),
                })
            for held in (digests, measures, copies, keys, times):
                held.clear()
            return pa.RecordBatch.from_pylist(out, schema=schema)

        entries = 0
        for batch in batches:
            texts, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size < PART) and len(digests) + end - first < TEXTS:
                    size += len(texts[end])
                    end += 1
                done, key, time = pair.align(texts[first:end])
                keys.append(key + len(digests))
                times.append(time)
                digests += [hashlib.sha256(t.encode()).digest() for t in texts[first:end]]
                measures += done
                copies += n[first:end]
                entries += len(key)
                if len(digests) >= TEXTS or entries >= ENTRIES:
                    yield block()
                    entries = 0
                first = end
        if digests:
            yield block()

    distinct = docs.select(F.col("text").cast("string").alias("text")).where("text is not null and text <> ''")
    return distinct.groupBy("text").agg(F.count("*").alias("copies")).mapInArrow(rows, ALIGNED)


def _copies(n: int, packed: bytes) -> np.ndarray:
    out = np.ones(n, dtype=np.int64)
    many = np.frombuffer(packed, dtype=_COPIES)
    out[many["at"]] = many["copies"]
    return out


def pair_counts(links: DataFrame) -> DataFrame:
    """(bucket, pair, n): in how many documents each pair of ids is linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            pair, n = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair >> 8), pa.array(pair & 0xFF), pa.array(n)], ["pair", "bucket", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                pair, runs = from_planes(row["pairs"], 6).astype(np.int64), from_planes(row["runs"], 4).astype(np.int64)
                if row["copies"]:
                    weight = _copies(row["texts"], row["copies"])[from_planes(row["places"], 3).astype(np.int64)]
                    runs = np.add.reduceat(weight, np.cumsum(runs) - runs)
                held.append((pair << 8 | row["bucket"], runs))
                size += len(pair)
                if size >= ENTRIES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    read = links.select("bucket", "texts", "pairs", "runs", "places", "copies")
    partial = read.mapInArrow(rows, "pair long, bucket long, n long")
    return partial.groupBy(F.col("bucket").cast("int").alias("bucket"), "pair").agg(F.sum("n").alias("n"))


def corpus_measures(links: DataFrame, n_b: int, n_blocks: int) -> DataFrame:
    """(block, at, n_best, count_sum) of the texts that have links."""

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pair")
        pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
        first = np.flatnonzero(np.diff(pair // n_b, prepend=-1))
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(first, append=len(pair)))
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int32()), "pairs": [pair.astype("<i8").tobytes()],
            "counts": [n.astype("<i8").tobytes()], "best": [(n == most).tobytes()],
        })

    def measured(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            known = right.to_pylist()[0]
            pairs, counts = (np.frombuffer(known[c], "<i8") for c in ("pairs", "counts"))
            best = np.frombuffer(known["best"], dtype=bool)
            for batch in left.to_batches():
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in ("block", "texts", "pairs", "runs", "places", "times")}
                    at = np.searchsorted(pairs, from_planes(row["pairs"], 6).astype(np.int64))
                    runs = from_planes(row["runs"], 4).astype(np.int64)
                    place, times = (from_planes(row[c], w).astype(np.int64) for c, w in (("places", 3), ("times", 4)))
                    sums = np.zeros((2, row["texts"]), dtype=np.int64)
                    np.add.at(sums[0], place, times * np.repeat(best[at].astype(np.int64), runs))
                    np.add.at(sums[1], place, times * np.repeat(counts[at], runs))
                    out.append((row["block"], sums.astype("<i8").tobytes()))
        return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "sums": pa.array([o[1] for o in out], pa.binary())})

    def added(key: tuple, table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(s.as_py(), "<i8") for s in table.column("sums")).reshape(2, -1)
        at = np.arange(sums.shape[1])
        return pa.table({
            "block": pa.array(np.full(len(at), key[0].as_py()), pa.int64()), "at": pa.array(at, pa.int32()),
            "n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64()),
        })

    counts = pair_counts(links).groupBy("bucket").applyInArrow(packed, "bucket int, pairs binary, counts binary, best binary")
    salts = max(1, ceil(n_blocks / TOGETHER))
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    read = links.select("bucket", F.pmod("block", F.lit(salts)).cast("int").alias("salt"), "block", "texts", "pairs", "runs", "places", "times")
    sums = read.groupBy("bucket", "salt").cogroup(counts.groupBy("bucket", "salt")).applyInArrow(measured, "block long, sums binary")
    return sums.groupBy("block").applyInArrow(added, "block long, at int, n_best long, count_sum long")


def alignment(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    stored = materialize(aligned_texts(docs, byte_level, piece_model))
    links = stored.where("bucket is not null")
    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_model).vocab_size()
    n_blocks = stored.where("at = 0").count()
    own = stored.where("text_key is not null").select(
        "block", "at", "text_key", "n_a", "n_b", "n_groups", "n_links", F.col("groups").alias("groups_sha256")
    )
    measures = own.join(corpus_measures(links, n_b, n_blocks), ["block", "at"], "left").drop("block", "at")
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("text_key"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return keyed.join(measures, "text_key", "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
