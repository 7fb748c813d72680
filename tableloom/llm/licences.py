"""Licence scans by Dice coefficient over word bigrams: texts against templates of any length.

Texts and templates are normalised alike: lower case, runs of other characters than letters and
digits as one blank.  Sets x and y of word bigrams are compared by 2 |x and y| / (|x| + |y|).

``find`` slides a window of each template's word count over all words of a text, so line breaks and
what stands around a notice, a header or a whole licence text do not matter; a text of fewer words
is one window, and every line is compared as well, since a line may be shorter than the template.
Distinct and common bigrams change by at most one at each end when a window moves, so all windows
of a template are running sums.  With c of a template's bigrams anywhere in the text no window
scores above 2 c / (c + |template|), which leaves out most templates without a loss.

Of windows and lines that reach ``THRESHOLD`` with a template, the best are kept first (ties: the
earlier, then the shorter), then all that do not overlap a kept one.  Each is a row; ``best`` marks
those that no row of another licence displaces: rows are taken by score, then words, then the order
of the templates, and a row is best when it overlaps no earlier best row of another licence.

Defined results: ``start`` and ``end`` are characters of the text, ``line`` counts from 0; a text
without a match, also a null or empty one, gives one row with nulls, score 0 and ``best`` false;
templates have two words or more; repeated rows are judged row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
_other = re.compile(r"[\W_]+")
_word = re.compile(r"[^\W_]+")
FOUND = "doc_id long, licence string, template string, line int, start int, end int, score double, best boolean"


# fixed values: words besides those of the ids by which licences of a family differ
NAME_WORDS = frozenset("""
affero lesser library sharealike noderivatives noderivs noncommercial commercial attribution clause simplified
zero dedication domain unlicense
""".split())


def reachable(n: int, m: int, threshold: float) -> bool:
    """Whether sets of these sizes can have that Dice coefficient."""
    return n > 0 and m > 0 and 2 * min(n, m) >= threshold * (n + m)


def licence_texts() -> list[tuple[str, str, str]]:
    """(licence, "header" or "text", text) of the files in ``licence_texts``, sorted by name."""
    folder = files("tableloom.llm") / "licence_texts"
    named = sorted((f.name.removesuffix(".txt").rpartition("."), f) for f in folder.iterdir() if f.name.endswith(".txt"))
    return [(licence, kind, f.read_text(encoding="utf-8")) for (licence, _, kind), f in named]


class Templates:
    """Templates (licence, kind, text) with the bigrams that tell which of them a text can hold."""

    def __init__(self, given: list[tuple[str, str, str]], threshold: float):
        self.names = [(licence, kind) for licence, kind, _ in given]
        words = [_word.findall(text.lower()) for _, _, text in given]
        if any(len(w) < 2 for w in words):
            raise ValueError("a template needs two words at least")
        self.words = [len(w) for w in words]
        self.sets = [frozenset(zip(w, w[1:])) for w in words]
        self.telling = NAME_WORDS.union(*(_word.findall(licence.lower()) for licence, _ in self.names))
        self.marks = [self.told(w) for w in words]
        self.threshold = threshold
        self.holders: dict[tuple, list[int]] = {}
        for k, own in enumerate(self.sets):
            for g in own:
                self.holders.setdefault(g, []).append(k)
        self.every = frozenset(self.holders)

    def told(self, words: list[str]) -> Counter:
        """How often each telling word comes."""
        return Counter(w for w in words if w in self.telling or (len(w) < 3 and w.isdigit()))

    def names_it(self, k: int, words: list[str]) -> bool:
        own, there = self.marks[k], self.told(words)
        return all(abs(own[w] - there[w]) <= max(own[w], there[w]) // 4 for w in own.keys() | there.keys())

    def possible(self, pairs: list[tuple[str, str]]) -> list[int]:
        """Templates of which a part of the text may reach the threshold."""
        counts = Counter(k for g in self.every.intersection(pairs) for k in self.holders[g])
        return sorted(k for k, c in counts.items() if 2 * c / (c + len(self.sets[k])) >= self.threshold)

    def matches(self, text: str) -> list[tuple]:
        """(template number, line, start, end, score, best) of all matches in a text."""
        low = text.lower()
        words = _other.sub(" ", low).split()
        pairs = list(zip(words, words[1:]))
        wanted = self.possible(pairs)
        if not wanted:
            return []
        numbers: dict[tuple, int] = {}
        codes = np.fromiter((numbers.setdefault(p, len(numbers)) for p in pairs), np.int64, len(pairs))
        before, after = neighbours(codes)
        lines, at = [], 0
        for line in low.split("\n"):
            n = len(_other.sub(" ", line).split())
            if n > 1:
                lines.append((at, at + n, frozenset(pairs[at : at + n - 1])))
            at += n
        found = []
        for k in wanted:
            template = self.sets[k]
            member = np.fromiter((p in template for p in numbers), bool, len(numbers))[codes]
            width = min(self.words[k] - 1, len(pairs))
            scores = window_scores(before, after, member, width, len(template))
            spans = [(-scores[i], i, i + width + 1) for i in np.flatnonzero(scores >= self.threshold).tolist()]
            for start, end, own in lines:
                if reachable(len(own), len(template), self.threshold):
                    score = 2 * len(own & template) / (len(own) + len(template))
                    if score >= self.threshold:
                        spans.append((-score, start, end))
            taken = np.zeros(len(words), bool)
            for score, start, end in sorted(spans):
                if not taken[start:end].any():
                    taken[start:end] = True
                    found.append((score, start - end, k, start, end))
        places = word_places(text, low)
        owner, licences, out = np.full(len(words), -1), sorted({self.names[k][0] for k in wanted}), []
        for score, _, k, start, end in sorted(found):
            mine = licences.index(self.names[k][0])
            best = self.names_it(k, words[start:end]) and bool(((owner[start:end] == -1) | (owner[start:end] == mine)).all())
            if best:
                owner[start:end] = mine
            first, last = int(places[start, 0]), int(places[end - 1, 1])
            out.append((k, first, last, -float(score), best))
        out.sort(key=lambda o: (o[1], o[0], o[2]))
        lines_until, at, rows = 0, 0, []
        for k, first, last, score, best in out:
            lines_until += text.count("\n", at, first)
            at = first
            rows.append((k, lines_until, first, last, score, best))
        return rows


def neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the previous and the next equal code, -1 and the length where there is none."""
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    before, after = np.full(len(codes), -1), np.full(len(codes), len(codes))
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def window_scores(before: np.ndarray, after: np.ndarray, member: np.ndarray, width: int, size: int) -> np.ndarray:
    """Dice coefficients of all windows of ``width`` bigrams with a template of ``size`` distinct ones."""
    n = len(before)
    first = before[:width] < 0
    moved = np.arange(n - width)
    # the first bigram leaves the set unless it comes again within the window, the next one enters unless it is there
    leaves, enters = after[: n - width] >= moved + width, before[width:] <= moved

    def counts(flag: np.ndarray) -> np.ndarray:
        steps = (enters & flag[width:]).astype(np.int64) - (leaves & flag[: n - width])
        return np.concatenate([[0], np.cumsum(steps)]) + int((first & flag[:width]).sum())

    distinct, common = counts(np.ones(n, bool)), counts(member)
    return 2 * common / (distinct + size)


def word_places(text: str, low: str) -> np.ndarray:
    """(start, end) in ``text`` of every word of ``low``, its lower case, which may be longer."""
    places = np.array([m.span() for m in _word.finditer(low)], np.int64).reshape(-1, 2)
    if len(low) == len(text):
        return places
    origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    return np.column_stack([origin[places[:, 0]], origin[places[:, 1] - 1] + 1])


def find(docs: DataFrame, templates: list[tuple[str, str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """A row for every match of a template (licence, kind, text) in ``docs`` (doc_id, text), one for a document without."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in batches:
            out = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                matches = known.matches(t.as_py() or "")
                out += [(i, *known.names[k], *rest) for k, *rest in matches] or [(i, None, None, None, None, None, 0.0, False)]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.bool_())
            columns = zip(*out) if out else [[]] * len(kinds)
            names = [c.split()[0] for c in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(rows, FOUND)
