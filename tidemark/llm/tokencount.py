"""Operator 1, token counts by dynamic programming on a shared trie.

Pre-tokens (a word, with the word-start mark before it) go into a trie.  A node
holds the forward score of its prefix under the unigram model: the best sum of
piece scores that spells it, and the number of pieces of that best spelling.  It
depends on the prefix alone, so it is computed once for all pre-tokens that share
it; where a pre-token ends, its count is stored.  A document's count is the sum
over its words.

Each task keeps one trie over all its batches and starts it afresh beyond
``MAX_NODES``; that changes no count.  Words longer than ``LONG_WORD`` go through
the same recurrence without the trie, so a hostile word cannot fill it.  Nothing
is shuffled, so no key can be hot.

Defined results: ties between spellings go to fewer pieces; a null, empty or blank
text has 0 words and 0 tokens; rows and their ids are kept as they are (null ids
and repeated rows too); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import MODEL, SPACE, Pieces, load

MAX_NODES = 1_000_000
#: Words whose counts are remembered.
MAX_WORDS = 500_000
LONG_WORD = 64


class Trie:
    """Forward scores of prefixes.  Node ``i`` has ``score[i]`` and ``count[i]``;
    its child by a character is ``child[i, character]``."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.longest = pieces, pieces.longest
        #: Pieces with their scores, and all ends of pieces (None): beyond one that
        #: is not here no longer piece can end.
        self.known: dict[str, int | None] = {p[i:]: None for p in pieces.scores for i in range(len(p))}
        self.known.update(pieces.scores)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = [0], [0]

    def _forward(self, text: str, end: int, score: list[int], count: list[int]) -> tuple[int, int]:
        """Best (score, pieces) of ``text[:end]``, given those of its prefixes."""
        extra, n = self.pieces.fallback(text[end - 1])
        best, fewest = score[end - 1] + extra, count[end - 1] + n
        known = self.known
        for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
            s = known.get(text[start:end], 0)
            if s == 0:  # scores are negative
                break
            if s is not None:
                s += score[start]
                if s > best or s == best and count[start] + 1 < fewest:
                    best, fewest = s, count[start] + 1
        return best, fewest

    def tokens(self, word: str) -> int:
        text = SPACE + word
        score, count = [0], [0]
        if len(text) > LONG_WORD:
            for end in range(1, len(text) + 1):
                s, n = self._forward(text, end, score, count)
                score.append(s)
                count.append(n)
            return count[-1]
        node = 0
        for end in range(1, len(text) + 1):
            key = (node, text[end - 1])
            node = self.child.get(key, -1)
            if node < 0:
                s, n = self._forward(text, end, score, count)
                node = self.child[key] = len(self.score)
                self.score.append(s)
                self.count.append(n)
            score.append(self.score[node])
            count.append(self.count[node])
        return self.count[node]


def _counter(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(pieces), {}
        for batch in batches:
            words, tokens = [], []
            for text in batch["text"].cast(pa.large_binary()).to_pylist():
                own = (text or b"").split()  # bytes: splits at ASCII white space only
                new = {w for w in own if w not in known}
                if new and (len(trie.score) > MAX_NODES or len(known) + len(new) > MAX_WORDS):
                    trie.clear()
                    known.clear()
                    new = set(own)
                long = {}
                for w in new:
                    # words that add no node are not remembered either
                    (known if len(w) <= LONG_WORD else long)[w] = trie.tokens(w.decode("utf-8", "surrogatepass"))
                words.append(len(own))
                tokens.append(sum([known[w] if w in known else long[w] for w in own]) if long else sum(map(known.__getitem__, own)))
                if len(known) > MAX_WORDS:  # one text may have more
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` of each row of ``(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counter(load(model)), "doc_id long, n_words long, n_tokens long")
