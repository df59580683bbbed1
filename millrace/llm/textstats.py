"""Counts over the lines, words and repeats of a block of documents, by numpy."""

from __future__ import annotations

import numpy as np

from .base import _SPACE, Words, mix64, ngram_hashes, span_hashes

#: Byte classes that are counted for each line.
CLASSES = ("upper", "lower", "digit", "symbol", "shout", "stop", "wide", "points", "space")
_LUT = np.zeros((len(CLASSES), 256), bool)
_LUT[0, 65:91] = True
_LUT[1, 97:123] = True
_LUT[2, 48:58] = True
_LUT[3, [ord(c) for c in "#*$%&|<>"]] = True
_LUT[4, [ord(c) for c in "!?"]] = True
_LUT[5, [ord(c) for c in ".,;:"]] = True
_LUT[6, 0xC0:] = True  # the first byte of each code point beyond ASCII
_LUT[7] = (np.arange(256) & 0xC0) != 0x80
_LUT[8] = _SPACE


class TextStats:
    """line_*: one entry for each \\n-split line; doc_*: one for each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n_docs = len(offsets) - 1
        breaks = np.flatnonzero(data == 10)
        doc_of_break = np.searchsorted(offsets, breaks, "right") - 1
        self.line_doc = np.sort(np.concatenate([np.arange(n_docs), doc_of_break]), kind="stable")
        start = np.concatenate([offsets[:-1], breaks + 1])
        order = np.lexsort((start, np.concatenate([np.arange(n_docs), doc_of_break])))
        start = start[order]
        end = np.empty_like(start)
        last = np.ones(len(start), bool)
        last[:-1] = self.line_doc[1:] != self.line_doc[:-1]
        end[last] = offsets[1:]
        end[~last] = start[np.flatnonzero(~last) + 1] - 1
        self.line_start, self.line_end = start, end
        self.line_first = np.searchsorted(self.line_doc, np.arange(n_docs + 1))
        self.words = w = Words(data, offsets, lower=False)
        counts = []
        for lut in _LUT:
            total = np.concatenate([[0], np.cumsum(lut[data], dtype=np.int64)])
            counts.append(total[end] - total[start])
        self.line_counts = dict(zip(CLASSES, counts, strict=True))
        cut = np.searchsorted(w.start, np.stack([start, end]))
        self.line_words = cut[1] - cut[0]
        self.line_dup = self._dup_lines(data)
        again = np.zeros(len(w.start) + 1, np.int64)
        again[2:] = np.cumsum((w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])) if len(w.start) else 0
        #: words equal to the word before them
        self.line_echo = again[cut[1]] - again[cut[0]]
        self.n_docs = n_docs
        self.doc_words = np.diff(w.first)
        self.repeat = self._repeats()

    def per_doc(self, line_values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(line_values, dtype=np.float64 if line_values.dtype.kind == "f" else np.int64)])
        return total[self.line_first[1:]] - total[self.line_first[:-1]]

    def _dup_lines(self, data: np.ndarray) -> np.ndarray:
        """Lines with a word that equal an earlier line of their document."""
        out = np.zeros(len(self.line_start), bool)
        live = np.flatnonzero(self.line_words > 0)
        if not len(live):
            return out
        key = mix64(span_hashes(data, self.line_start[live], self.line_end[live]) + self.line_doc[live].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        out[live[order[1:][key[order[1:]] == key[order[:-1]]]]] = True
        return out

    def _repeats(self, n: int = 8) -> np.ndarray:
        """Words in windows of n words that occur twice or more in their document."""
        w = self.words
        grams, doc = ngram_hashes(w.hash, w.first, n)
        out = np.zeros(len(self.doc_words), np.int64)
        if not len(grams):
            return out
        key = mix64(grams + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.flatnonzero(twice)
        if not len(hit):
            return out
        counts = np.maximum(np.diff(w.first) - n + 1, 0)
        at = hit - (np.cumsum(counts) - counts)[doc[hit]] + w.first[doc[hit]]
        cover = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
        return covered[w.first[1:]] - covered[w.first[:-1]]

    def word_points(self) -> np.ndarray:
        """Code points in words, for each document."""
        return self.per_doc(self.line_counts["points"] - self.line_counts["space"])


#: What describes a document to a classifier; nothing of its id, source or language.
DOC_FEATURES = ("log_words", "word_length", "upper", "digit", "symbol", "shout", "stop", "wide", "line_words", "dup_lines", "repeat", "distinct", "lone", "worst_line", "echo")


def doc_features(s: TextStats) -> np.ndarray:
    c = {k: s.per_doc(v).astype(float) for k, v in s.line_counts.items()}
    words, points = s.doc_words.astype(float), c["points"]
    at_least = lambda x: np.maximum(x, 1.0)
    letters = at_least(c["upper"] + c["lower"] + c["wide"])
    solid = at_least(points - c["space"])
    key = s.words.hash + s.words.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    distinct = np.bincount(s.words.doc[np.unique(key, return_index=True)[1]], minlength=s.n_docs) if len(key) else np.zeros(s.n_docs)
    bad = (s.line_counts["symbol"] + s.line_counts["shout"] + s.line_counts["upper"]) / at_least(s.line_counts["points"] - s.line_counts["space"])
    worst = np.zeros(s.n_docs)
    np.maximum.at(worst, s.line_doc, bad)
    lines = np.diff(s.line_first)
    live = at_least(s.per_doc((s.line_words > 0).astype(np.int64)))
    lone = s.per_doc((s.line_words == 1).astype(np.int64))
    return np.stack(
        [np.log1p(words), solid / at_least(words), c["upper"] / letters, c["digit"] / solid, c["symbol"] / solid, c["shout"] / solid, c["stop"] / solid, c["wide"] / letters, np.log1p(words / at_least(lines)), s.per_doc(s.line_dup.astype(np.int64)) / live, s.repeat / at_least(words), distinct / at_least(words), lone / live, worst, s.per_doc(s.line_echo) / at_least(words)], 1
    )
