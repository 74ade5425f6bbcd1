"""Log-probabilities of the pieces of an existing vocabulary file.

A unigram file gives them. The scores of a merge file are whole numbers, minus the rank of the merge that made the piece;
ranks follow frequency, so a piece of rank r gets the share 1 / r of Zipf's law, over the sum of all shares. Entries
without a rank of their own (bytes, the unknown, runs of marks) count as one rank past the last.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

MARK = "▁"
#: A score as low as this stands for no rank.
NO_RANK = -1e8


@dataclass(frozen=True)
class Vocabulary:
    """pieces and logp by id; unknown: id of the unknown; bytes_: id of each byte's piece, empty without byte fallback."""

    pieces: tuple[str, ...]
    logp: tuple[float, ...]
    unknown: int
    bytes_: tuple[int, ...]
    normal: frozenset[int]


def zipf(scores: list[float], normal: list[bool]) -> list[float]:
    """ln of 1 / rank over the sum of all, for scores that are minus ranks."""
    ranks = [-s for s, n in zip(scores, normal, strict=True) if n and s > NO_RANK]
    last = max(ranks, default=0.0) + 1
    share = [1 / max(-s, 1.0) if n and s > NO_RANK else 1 / last for s, n in zip(scores, normal, strict=True)]
    whole = math.log(math.fsum(share))
    return [math.log(x) - whole for x in share]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One for each process and file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    normal = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in ids]
    scores = [sp.get_score(i) for i in ids]
    merges = all(s == int(s) for s, n in zip(scores, normal, strict=True) if n)
    if merges:
        scores = zipf(scores, normal)
    else:
        least = min((s for s, n in zip(scores, normal, strict=True) if n), default=0.0)
        scores = [s if n else least for s, n in zip(scores, normal, strict=True)]
    raw = tuple(i for i in ids if sp.is_byte(i))
    return Vocabulary(tuple(sp.id_to_piece(i) for i in ids), tuple(scores), sp.unk_id(), raw, frozenset(i for i in ids if normal[i]))
