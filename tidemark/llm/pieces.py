"""Unigram pieces taken from a SentencePiece model file.

The public file at hand is a BPE model: its scores are merge ranks.  They are
read as a frequency order and turned into unigram log-probabilities by Zipf's
law, ``-ln(rank + 2)``, in integer millionths so that sums and ties are exact.
Characters that no piece spells fall back to byte pieces, one per UTF-8 byte.
The table is bounded by the model (32,000 pieces), so it may be broadcast.
"""

from __future__ import annotations

from array import array
import math
from dataclasses import dataclass

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Stands for a word's start, as in SentencePiece.
SPACE = "▁"
_NEVER = -1e8


@dataclass(frozen=True)
class Pieces:
    ids: dict[str, int]
    scores: dict[str, int]
    byte_ids: tuple[int, ...]
    byte_score: int

    @property
    def longest(self) -> int:
        return max(map(len, self.scores), default=1)

    def fallback(self, char: str) -> tuple[int, int]:
        """(score, number of pieces) of a character spelt in bytes."""
        n = len(char.encode("utf-8", "surrogatepass"))
        return n * self.byte_score, n


def zipf(rank: float) -> int:
    return -round(1e6 * math.log(rank + 2))


def load(path: str = MODEL) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    byte_ids = tuple(i for i in range(n) if model.is_byte(i))
    own = [i for i in range(n) if i not in special and not model.is_byte(i) and model.get_score(i) > _NEVER]
    return Pieces(
        {model.id_to_piece(i): i for i in own},
        {model.id_to_piece(i): zipf(-model.get_score(i)) for i in own},
        byte_ids,
        zipf(n),
    )


def viterbi(word: str, pieces: Pieces) -> list[int]:
    """Ids of the best spelling of one word: highest score, then fewest pieces,
    then the longest last piece."""
    return best_ids(SPACE + word, pieces)


def best_ids(text: str, pieces: Pieces) -> list[int]:
    """Ids of the best spelling of a text without a mark.  Two numbers are held for
    each of its places; scores only for as many as the longest piece has."""
    longest = pieces.longest
    best: dict[int, tuple[int, int]] = {0: (0, 0)}  # end: score, pieces
    starts, ids = array("q", [0]), array("q", [-1])
    for end in range(1, len(text) + 1):
        top: tuple[int, int, int, int] | None = None
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            score, i = pieces.scores.get(piece), pieces.ids.get(piece, -1)
            n = 1
            if score is None:
                if end - start > 1:
                    continue
                score, n = pieces.fallback(piece)
            have = (best[start][0] + score, best[start][1] + n, start, i)
            if top is None or have[0] > top[0] or have[0] == top[0] and have[1] < top[1]:
                top = have
        best[end] = top[:2]
        best.pop(end - longest, None)
        starts.append(top[2])
        ids.append(top[3])
    out: list[int] = []
    at = len(text)
    while at:
        start, i = starts[at], ids[at]
        out += [i] if i >= 0 else [pieces.byte_ids[b] for b in reversed(text[start:at].encode("utf-8", "surrogatepass"))]
        at = start
    return out[::-1]
