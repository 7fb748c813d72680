"""Subword encoding by a score-ordered agenda, for merge-type piece vocabularies.

A text is prefixed with a blank, blanks become U+2581, and its characters are the first
symbols.  The agenda holds every adjacent pair of symbols whose concatenation is a piece,
the best score first and the leftmost of equals; the top pair merges and its new neighbours
join the agenda, until it is empty.  Characters that are no piece become byte pieces.

No piece holds a blank after another character, so no merge reaches over the start of a run of
blanks: a text falls into units there.  The new units of a block are merged side by side, each
by its own agenda: in every step the best pair of each unit merges (``merge_units``); a unit of
more than ``LONG`` symbols has a heap of its own (``merge_long``).  A worker remembers units up
to a bound of bytes.  Every block is compared with the sentencepiece library, ids and decoded
texts alike; a difference (a vocabulary of another type, another normaliser) is an error that
names the row, never a silent result.

Defined results: a null text is empty and has the begin and end ids alone; equal rows give equal
results; a null ``doc_id`` is carried along; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# bytes of units a worker remembers, and characters of texts worked on at a time
REMEMBERED = 160 << 20
BLOCK = 1 << 21
# what a remembered unit costs besides its text and ids
ENTRY = 200
# symbols of a unit that is merged by a heap of its own, and of the units merged side by side
LONG = 256
BESIDE = 1 << 18

NONE = np.int64(1) << 40
_UNIT = re.compile(r" ( *[^ ]*)")


class PieceVocabulary:
    """Encoder and decoder of a vocabulary file whose pieces are merged by score."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.vocab_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        if any(lib.is_unused(i) for i in plain) or any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("unused pieces, and blanks inside pieces, are not supported")
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(lib.is_byte(i) for i in self.bytes):
            raise ValueError("a vocabulary without byte pieces is not supported")
        ids = {names[i]: i for i in plain}
        # 0 is the best score; equal scores share a rank
        place = {s: k for k, s in enumerate(sorted({lib.get_score(i) for i in plain}, reverse=True))}
        pairs = sorted(
            (ids[t[:k]] << 32 | ids[t[k:]], place[lib.get_score(i)], i)
            for t, i in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids
        )
        # every pair of pieces that concatenates to a piece: its key, the rank and the id of that piece
        self.keys, self.ranks, self.joined = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        self.merge = {k: (r, j) for k, r, j in pairs}
        self.letters = np.full(0x110000, -1, dtype=np.int32)
        for t, i in ids.items():
            if len(t) == 1:
                self.letters[ord(t)] = i
        self.letters[ord(" ")] = self.letters[ord(MARK)]
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        # what each id stands for; control ids for nothing
        shown = {i: names[i].replace(MARK, " ").encode() for i in plain}
        shown |= {i: bytes([b]) for b, i in enumerate(self.bytes)} | {lib.unk_id(): " \u2047 ".encode()}
        parts = [shown.get(i, b"") for i in range(n)]
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.size = np.array([len(t) for t in parts], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.is_byte = np.zeros(n, dtype=bool)
        self.is_byte[self.bytes] = True
        self.opens = np.array([t.startswith(MARK) for t in names])
        self.units: dict[str, bytes] = {}
        self.held = 0

    def symbols(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of all units, and the unit of each."""
        points = np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4")
        owner = np.repeat(np.arange(len(units)), [len(u) for u in units])
        out = self.letters[points].astype(np.int64)
        strange = np.flatnonzero(out < 0)
        if len(strange):
            spelt = [chr(c).encode() for c in points[strange].tolist()]
            times = np.ones(len(out), dtype=np.int64)
            times[strange] = [len(b) for b in spelt]
            out, owner = np.repeat(out, times), np.repeat(owner, times)
            out[out < 0] = np.array(self.bytes, dtype=np.int64)[np.frombuffer(b"".join(spelt), dtype=np.uint8)]
        return out, owner

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the merged pairs; a pair that is no piece has rank ``NONE``."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        return np.where(there, self.ranks[at], NONE), self.joined[at]

    def merge_units(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all units (``owner`` ascending) after the merges of their agendas, and their units."""
        done_symbols, done_owner = [], []
        rank = np.full(len(symbols), NONE)
        into = np.zeros(len(symbols), dtype=np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside], into[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            live = best < NONE
            size = np.diff(first, append=len(symbols))
            if not live.all():
                over = np.repeat(~live, size)
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank, into = symbols[~over], owner[~over], rank[~over], into[~over]
                best, size = best[live], size[live]
                if not len(symbols):
                    break
                first = np.cumsum(size) - size
            # the leftmost pair of the best rank of every unit
            hits = np.flatnonzero(rank == np.repeat(best, size))
            hits = hits[np.flatnonzero(np.diff(owner[hits], prepend=-1))]
            symbols[hits] = into[hits]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            at = hits - np.arange(len(hits))
            symbols, owner, rank, into = symbols[keep], owner[keep], rank[keep], into[keep]
            rank[at] = NONE
            fresh = np.concatenate([at[(at > 0)] - 1, at])
            fresh = fresh[fresh + 1 < len(symbols)]
            fresh = fresh[owner[fresh] == owner[fresh + 1]]
            rank[fresh], into[fresh] = self.pair_ranks(symbols[fresh], symbols[fresh + 1])
        if not done_symbols:
            return symbols, owner
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The symbols of one unit after all merges of its agenda, a heap of (rank, place)."""
        merge, n = self.merge.get, len(symbols)
        pairs = (merge(a << 32 | b) for a, b in zip(symbols, symbols[1:]))
        agenda = [p[0] << 32 | i for i, p in enumerate(pairs) if p is not None]
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            top = heappop(agenda)
            i = top & 0xFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merge(symbols[i] << 32 | symbols[j])
            # passed over when a neighbour has merged since
            if found is None or found[0] != top >> 32:
                continue
            symbols[i], symbols[j] = found[1], -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                found = merge(symbols[i] << 32 | symbols[j])
                if found is not None:
                    heappush(agenda, found[0] << 32 | i)
            j = before[i]
            if j >= 0:
                found = merge(symbols[j] << 32 | symbols[i])
                if found is not None:
                    heappush(agenda, found[0] << 32 | j)
        return [s for s in symbols if s >= 0]

    def remember(self, keys: list[str]) -> None:
        """Encode the units of a blank and each key, and keep their ids."""
        units = self.units
        for key in [k for k in keys if len(k) > LONG]:
            ids = array("I", self.merge_long(self.symbols([" " + key])[0].tolist())).tobytes()
            units[key] = ids
            self.held += ENTRY + len(key) + len(ids)
        keys = [k for k in keys if len(k) <= LONG]
        ends = np.cumsum([len(k) + 1 for k in keys])
        first = 0
        while first < len(keys):
            end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BESIDE, side="right")))
            part = keys[first:end]
            ids, owner = self.merge_units(*self.symbols([" " + k for k in part]))
            cuts = (4 * np.searchsorted(owner, np.arange(len(part) + 1))).tolist()
            packed = ids.astype("<u4").tobytes()
            units.update((k, packed[a:b]) for k, a, b in zip(part, cuts, cuts[1:]))
            self.held += ENTRY * len(part) + int(ends[end - 1]) + len(packed)
            first = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """All ids of each text, begin and end included, as little-endian unsigned 32-bit integers."""
        split = []
        for text in texts:
            text = text.replace(MARK, " ")
            keys = text.split(" ") if text else []
            # two blanks in a row, at the start or at the end
            split.append(_UNIT.findall(" " + text) if "" in keys else keys)
        if self.held > REMEMBERED:
            self.units.clear()
            self.held = 0
        units = self.units
        fresh: set[str] = set()
        for keys in split:
            fresh.update(keys)
        self.remember(list(fresh.difference(units)))
        first, last = (array("I", [i]).tobytes() for i in (self.begin, self.end))
        return [first + b"".join([units[k] for k in keys]) + last for keys in split]

    def decode(self, ids: list[bytes]) -> list[str]:
        """The texts of packed ids: a blank that opens the first piece goes, stray bytes are U+FFFD."""
        out = []
        flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
        size = self.size[flat]
        ends = np.concatenate([[0], np.cumsum(size)])
        data = self.blob[np.repeat(self.start[flat] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        at = 0
        for packed in ids:
            n = len(packed) // 4
            own = flat[at : at + n]
            text = data[ends[at] : ends[at + n]]
            said = np.flatnonzero(size[at : at + n])
            if len(said) and self.opens[own[said[0]]]:
                text = text[1:]
            try:
                # control ids between bytes keep them apart
                apart = len(said) and said[-1] - said[0] >= len(said) and self.is_byte[own].any()
                out.append(self._mended(own, text) if apart else text.decode())
            except UnicodeDecodeError:
                out.append(self._mended(own, text))
            at += n
        return out

    def _mended(self, ids: np.ndarray, text: bytes) -> str:
        """The text when byte pieces do not spell characters: each byte that belongs to none is U+FFFD."""
        skipped, out = int(self.size[ids].sum()) - len(text), []
        raw, edges = self.is_byte[ids], np.cumsum(self.size[ids]) - skipped
        runs = np.flatnonzero(np.diff(raw.astype(np.int8), prepend=-1, append=-1))
        for a, b in zip(runs, runs[1:]):
            part = text[max(0, edges[a - 1] if a else 0) : max(0, edges[b - 1])]
            if not raw[a]:
                out.append(part.decode())
                continue
            at = 0
            while at < len(part):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(part[at : at + n].decode())
                    except UnicodeDecodeError:
                        continue
                    at += n
                    break
                else:
                    out.append("\ufffd")
                    at += 1
        return "".join(out)

    def differs(self, texts: list[str], ids: list[bytes], decoded: list[str]) -> int | None:
        """The first row that the library encodes or decodes otherwise, or None."""
        theirs = self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
        back = self.library.decode(theirs, num_threads=1)
        for i, own in enumerate(theirs):
            if array("I", own).tobytes() != ids[i] or back[i] != decoded[i]:
                return i
        return None


_loaded: dict[str, PieceVocabulary] = {}

ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: all ids as little-endian unsigned 32-bit integers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _loaded:
            _loaded[vocabulary] = PieceVocabulary(vocabulary)
        pieces = _loaded[vocabulary]
        for batch in batches:
            names, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size < BLOCK):
                    size += len(texts[end])
                    end += 1
                ids = pieces.encode(texts[first:end])
                decoded = pieces.decode(ids)
                wrong = pieces.differs(texts[first:end], ids, decoded)
                if wrong is not None:
                    raise ValueError(f"doc_id {names[first + wrong]}: the agenda and the library disagree")
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(first, end - first), pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()), pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
                first = end

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, ENCODED)
