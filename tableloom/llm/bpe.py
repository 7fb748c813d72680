"""BPE encoding by speculation: propose tokens greedily, verify adjacent pairs, merge only on failure.

A sequence of tokens is the BPE encoding of a word exactly when every token is its own
encoding and every two neighbours, encoded together, stay as they are.  So words are first
cut by greedy longest match; the pairs of all new words of a block are looked up at once in
a table of pairs known to be compatible or not, each new pair being merged exactly once; only
words with an incompatible pair undergo exact merging.

Text is taken apart as the vocabulary file says: added tokens, NFC, white space, lower case
by character, words by pattern, bytes as printable characters, an end-of-word mark on the
last one.  No word reaches over a blank, so pieces between blanks are looked up in a bounded
cache.  Decoding joins the tokens' strings by blanks, as the file, which has no decoder, says.

Defined results: a null text is empty and has no tokens; equal rows give equal results; a
null ``doc_id`` is carried along; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# pieces and words a Python worker remembers
PIECES = 200_000
WORDS = 300_000
BLOCK = 1 << 21


class WordBpe:
    """Encoder of words for a vocabulary file with an end-of-word mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.added_pattern = regex.compile("|".join(f"({regex.escape(t)})" for t in sorted(self.added, key=len, reverse=True)))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word_pattern = regex.compile(split)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(plain)]
        self.shown = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
        # lengths of the tokens of four characters or more, by their first four, longest first
        lengths: dict[str, set[int]] = {}
        for t in self.ids:
            t = t.removesuffix(self.mark)
            if len(t) > 3:
                lengths.setdefault(t[:4], set()).add(len(t))
        self.lengths = {k: (*sorted(v, reverse=True), 3, 2, 1) for k, v in lengths.items()}
        self.sound: dict[int, bool] = {}
        # sorted keys of the pairs seen so far, and whether they are compatible
        self.pair_keys = np.zeros(0, dtype=np.int64)
        self.pair_good = np.zeros(0, dtype=bool)
        self.words: dict[str, tuple[str, str]] = {}

    def greedy(self, word: str) -> list[int]:
        ids, out, i, n = self.ids, [], 0, len(word)
        whole = ids.get(word + self.mark)
        if whole is not None:
            return [whole]
        lengths, mark, short = self.lengths, self.mark, (3, 2, 1)
        while i < n:
            left = n - i
            for size in lengths.get(word[i : i + 4], short):
                if size > left:
                    continue
                found = ids.get(word[i : i + size] if size < left else word[i:] + mark)
                if found is not None:
                    out.append(found)
                    i += size
                    break
            else:
                # not in the vocabulary at all: the exact way drops or keeps it
                return []
        return out

    def merged(self, symbols: list[str]) -> list[str]:
        """Exact merging: always the pair of least rank, the leftmost of equals."""
        n = len(symbols)
        symbols = list(symbols)
        if n <= 48:
            rank, none = self.rank.get, len(self.rank)
            ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
            while ranks:
                least = min(ranks)
                if least == none:
                    break
                i = ranks.index(least)
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
                if i < len(ranks):
                    ranks[i] = rank((symbols[i], symbols[i + 1]), none)
            return symbols
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = self.rank.get((symbols[i], symbols[i + 1]))
            if r is not None:
                heap.append((r, i, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, ""
            following[i] = following[j]
            if following[j] < n:
                before[following[j]] = i
            for left, right in ((before[i], i), (i, following[i])):
                if left >= 0 and right < n:
                    r = self.rank.get((symbols[left], symbols[right]))
                    if r is not None:
                        heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [s for s in symbols if s]

    def symbols(self, token: str) -> list[str]:
        bare = token.removesuffix(self.mark) if self.mark and token != self.mark else token
        out = list(bare)
        if bare != token:
            out[-1] += self.mark
        return out

    def exact(self, word: str) -> list[int]:
        return [self.ids[s] for s in self.merged([*word[:-1], word[-1] + self.mark]) if s in self.ids]

    def compatible(self, a: int, b: int) -> bool:
        left, right = self.token[a], self.token[b]
        for i, t in ((a, left), (b, right)):
            if i not in self.sound:
                self.sound[i] = self.merged(self.symbols(t)) == [t]
            if not self.sound[i]:
                return False
        return self.merged(self.symbols(left) + self.symbols(right)) == [left, right]

    def verify(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair (a << 32 | b) is compatible; new pairs are merged once and kept."""
        kinds = np.unique(pairs)
        at = np.searchsorted(self.pair_keys, kinds)
        known = np.zeros(len(kinds), dtype=bool)
        inside = at < len(self.pair_keys)
        known[inside] = self.pair_keys[at[inside]] == kinds[inside]
        fresh = kinds[~known]
        if len(fresh):
            good = np.array([self.compatible(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in fresh], dtype=bool)
            keys = np.concatenate([self.pair_keys, fresh])
            order = np.argsort(keys)
            self.pair_keys, self.pair_good = keys[order], np.concatenate([self.pair_good, good])[order]
        return self.pair_good[np.searchsorted(self.pair_keys, pairs)]

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words (bytes as printable characters)."""
        proposed = [self.greedy(w) for w in words]
        size = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.fromiter((t for p in proposed for t in p), dtype=np.int64, count=int(size.sum()))
        owner = np.repeat(np.arange(len(words)), size)
        inner = owner[1:] == owner[:-1]
        wrong = size == 0
        if inner.any():
            good = self.verify((flat[:-1][inner] << 32) | flat[1:][inner])
            wrong[owner[1:][inner][~good]] = True
        for i in np.flatnonzero(size == 1):
            t = int(proposed[i][0])
            if t not in self.sound:
                self.sound[t] = self.merged(self.symbols(self.token[t])) == [self.token[t]]
            wrong[i] |= not self.sound[t]
        for i in np.flatnonzero(wrong):
            proposed[i] = self.exact(words[i])
        return dict(zip(words, proposed))

    def split(self, piece: str) -> list:
        """Words of a piece, and ids of added tokens in it."""
        if piece.isascii() and piece.isprintable() and "<" not in piece:
            piece = piece.lower()
            return [piece] if piece.isalpha() else self.word_pattern.findall(piece)
        parts = self.added_pattern.split(piece) if "<" in piece else [piece]
        out: list = []
        for part in parts:
            if not part:
                continue
            if part in self.added:
                out.append(self.added[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # by character: the end of a word changes nothing
            part = part.lower() if "Σ" not in part else "".join(c.lower() for c in part)
            for word in self.word_pattern.findall(part):
                out.append(word.encode("utf-8").decode("latin-1").translate(self.shown))
        return out

    def written(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), " ".join([self.token[i] for i in ids])

    def encode_pieces(self, pieces: list[str]) -> dict[str, tuple[str, str]]:
        """For pieces without blanks: ids in decimal and tokens, both joined by blanks."""
        split = [self.split(p) for p in pieces]
        if len(self.words) > WORDS:
            self.words.clear()
        words = self.words
        fresh = {w for s in split for w in s if w not in words and isinstance(w, str)}
        if fresh:
            words.update((w, self.written(ids)) for w, ids in self.encode_words(list(fresh)).items())
        out = {}
        for piece, parts in zip(pieces, split):
            if len(parts) == 1 and parts[0] in words:
                out[piece] = words[parts[0]]
                continue
            found = [words[p] if isinstance(p, str) else self.written([p]) for p in parts]
            out[piece] = (" ".join([f[0] for f in found if f[0]]), " ".join([f[1] for f in found if f[0]]))
        return out


_loaded: dict[str, WordBpe] = {}

ENCODED = "doc_id long, n_tokens long, ids string, decoded string"


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): decimal ids joined by blanks, and the text decoded from them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _loaded:
            _loaded[vocabulary] = WordBpe(vocabulary)
        bpe = _loaded[vocabulary]
        cache: dict[str, tuple[str, str]] = {}
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size < BLOCK):
                    size += len(texts[end] or "")
                    end += 1
                split = [(t or "").split(" ") for t in texts[first:end]]
                if len(cache) > PIECES:
                    cache.clear()
                fresh = {p for s in split for p in s if p not in cache}
                cache.update(bpe.encode_pieces(list(fresh)))
                ids, decoded = [], []
                for s in split:
                    found = [cache[p] for p in s]
                    ids.append(" ".join([f[0] for f in found if f[0]]))
                    decoded.append(" ".join([f[1] for f in found if f[0]]))
                n = [x.count(" ") + 1 if x else 0 for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [docs_.slice(first, end - first), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
                first = end

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, ENCODED)
