"""Token counts of a unigram model, by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word (a run without white space) with the mark ``\\u2581`` before it. Its
segmentation into vocabulary pieces has the greatest sum of scores, and of equal sums the fewest tokens. The
distinct pre-tokens of a batch are put in a trie; the forward score of a node, the
best over all pieces that end there, is computed once for all words that share the
prefix, level by level for all nodes of a depth at once. Terminal nodes give the counts,
which are remembered for later batches of the task.

Prefixes are looked up by a 64-bit hash of their code points and not compared sign by sign.

Pieces come from a public vocabulary file, read by path. Its order is by frequency, so the
score of a piece is taken from Zipf's law, -ln(rank + ``SHIFT``), in thousandths and whole, which makes
sums exact. A character that is no piece is spelled in bytes, one token each.

Defined results: a null or empty text has no words and no tokens; a word of any length
is counted whole (over ``LONG`` characters without the trie, by the same rule, with tokens counted beside the scores); words
are divided by any Unicode white space, as the pieces of the vocabulary are; equal rows get equal counts;
doc_id may be null. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.keep import small_batches

MARK = "▁"
SHIFT = 10
BYTE = -14_000  # score of a byte of a character that is no piece
LONG = 200  # characters of a word above which its levels are not worth an array each
REMEMBERED = 300_000  # words of a task whose counts are remembered at most
ROWS = 1000  # texts whose new words are put in one trie
_BITS = 24  # in the trie a value is score * 2**_BITS - tokens, so the greatest has the best score and then the fewest tokens
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Unigram:
    def __init__(self, scores: dict[str, int]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        by_length: dict[int, list[str]] = {}
        for piece in scores:
            by_length.setdefault(len(piece), []).append(piece)
        self.tables = {}
        for k, pieces in by_length.items():
            codes = np.array([[ord(c) for c in p] for p in pieces], dtype=np.uint64)
            keys = np.zeros(len(pieces), dtype=np.uint64)
            for j in range(k):  # from the last character to the first, as the trie looks back
                keys = keys * _BASE + codes[:, k - 1 - j] + np.uint64(1)
            order = np.argsort(keys)
            maybe = np.zeros(1 << 18, dtype=bool)
            maybe[keys >> np.uint64(46)] = True
            self.tables[k] = keys[order], self.value(np.array([scores[p] for p in pieces], dtype=np.int64))[order], maybe

    @staticmethod
    def value(score, tokens=1):
        return (score << _BITS) - tokens

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each of the distinct ``words``."""
        out = np.zeros(len(words), dtype=np.int64)
        short = sorted((w, i) for i, w in enumerate(words) if len(w) <= LONG)
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.count_one(w)
        if short:
            out[[i for _, i in short]] = self.count_sorted([w for w, _ in short])
        return out

    def count_one(self, word: str) -> int:
        """The same over one word of any length: scores and tokens are whole numbers of their own, and only the last ones are held."""
        best: deque[tuple[int, int]] = deque([(0, 0)], maxlen=self.longest)  # (score, -tokens), the newest last
        for end in range(1, len(word) + 1):
            found = []
            for k in range(1, len(best) + 1):
                score = self.scores.get(word[end - k:end])
                if score is not None:
                    found.append((best[-k][0] + score, best[-k][1] - 1))
            if word[end - 1] not in self.scores:
                n = len(word[end - 1].encode("utf-8", "replace"))
                found.append((best[-1][0] + n * BYTE, best[-1][1] - n))
            best.append(max(found))
        return -best[-1][1]

    def count_sorted(self, words: list[str]) -> np.ndarray:
        """The same for words in order, over their trie."""
        size = np.array([len(w) for w in words])
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        result = np.zeros(len(words), dtype=np.int64)
        result[size == 0] = 0
        alive = np.flatnonzero(size > 0)
        parent = np.zeros(len(words), dtype=np.int64)
        # of the last levels: the node of every word, and the forward value of every node
        nodes, forward = [parent.copy()], [np.zeros(1, dtype=np.int64)]
        for depth in range(int(size.max(initial=0))):
            sign = codes[begin[alive] + depth]
            above = nodes[-1][alive]
            new = np.ones(len(alive), dtype=bool)
            new[1:] = (above[1:] != above[:-1]) | (sign[1:] != sign[:-1])
            node = np.cumsum(new) - 1
            first = alive[new]  # one word of every node stands for its prefix
            best = np.full(len(first), np.iinfo(np.int64).min, dtype=np.int64)
            known = np.zeros(len(first), dtype=bool)
            key = np.zeros(len(first), dtype=np.uint64)
            for k in range(1, min(self.longest, depth + 1) + 1):
                key = key * _BASE + codes[begin[first] + depth - k + 1] + np.uint64(1)
                if k not in self.tables:
                    continue
                keys, values, maybe = self.tables[k]
                at = np.flatnonzero(maybe[key >> np.uint64(46)])
                place = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
                hit = keys[place] == key[at]
                at, place = at[hit], place[hit]
                best[at] = np.maximum(best[at], forward[-k][nodes[-k][first[at]]] + values[place])
                if k == 1:
                    known[at] = True
            spelled = np.flatnonzero(~known)
            if len(spelled):
                code = codes[begin[first[spelled]] + depth]
                n = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
                best[spelled] = np.maximum(best[spelled], forward[-1][nodes[-1][first[spelled]]] + self.value(n * BYTE, n))
            ids = np.zeros(len(words), dtype=np.int64)
            ids[alive] = node
            nodes, forward = [*nodes[-self.longest + 1:], ids], [*forward[-self.longest + 1:], best]
            ends = size[alive] == depth + 1
            result[alive[ends]] = best[node[ends]]
            alive = alive[~ends]
        return -result & ((1 << _BITS) - 1)


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    """The model over the ordinary pieces of a vocabulary file."""
    given = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(given.get_piece_size()) if not (given.is_control(i) or given.is_unknown(i) or given.is_byte(i) or given.is_unused(i))]
    return Unigram({given.id_to_piece(i): -round(1000 * math.log(rank + SHIFT)) for rank, i in enumerate(plain)})


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = unigram(vocabulary), {}
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                split = [(t.as_py() or "").split() for t in part.column(1)]
                new = list(set().union(*split) - known.keys())
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = list(set().union(*split))
                known.update(zip(new, model.count([MARK + w for w in new]).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in split], pa.int64()),
                     pa.array([sum(map(known.__getitem__, s)) for s in split], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
