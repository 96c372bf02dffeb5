"""A piece vocabulary read as a unigram model, shared by token counts and encoding.

The vocabulary file is given by path (never copied).  Its pieces and scores
are taken as a unigram model: a text is marked (a space becomes U+2581 and one
is put in front), and its encoding is the sequence of pieces with the highest
score sum.  Rules, as in the SentencePiece library's unigram encoder:

* a character that is no piece by itself costs the lowest score minus 10 and
  falls back to its UTF-8 bytes;
* of equal scores, the path whose last piece starts earlier (the longer last
  piece) wins, at every position.

Pieces with placeholder scores (under ``PLACEHOLDER``) count as one less than
the lowest real score, so sums of these whole-number scores are exact.

No piece has a mark after another character, so a marked text splits before
each run of marks into *marked words* that encode independently.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

MARK = "▁"
PLACEHOLDER = -1e8
UNKNOWN_PENALTY = 10.0
MARKED_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Pieces:
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: tuple[int, ...]  # of <0x00> .. <0xFF>; empty without byte fallback
    unknown_id: int
    unknown_score: float
    texts: tuple[str, ...]


@lru_cache(maxsize=4)
def load_pieces(path: str = DEFAULT_MODEL) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = tuple(sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    normal = [i for i in range(len(texts))
              if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    lowest = min(s for s in (sp.get_score(i) for i in normal) if s > PLACEHOLDER)
    scores = {texts[i]: s if (s := sp.get_score(i)) > PLACEHOLDER else lowest - 1 for i in normal}
    if any(re.search(f"[^{MARK}]{MARK}", t) for t in scores):
        raise ValueError("a piece crosses a word boundary: words can't be encoded alone")
    byte_of = {texts[i]: i for i in range(len(texts)) if sp.is_byte(i)}
    return Pieces({texts[i]: i for i in normal}, scores,
                  tuple(byte_of[f"<0x{b:02X}>"] for b in range(256)) if byte_of else (),
                  sp.unk_id(), min(scores.values()) - UNKNOWN_PENALTY, texts)


def marked(text: str) -> str:
    """The marked form of a text; a literal U+2581 in the text reads as a space, as in the library."""
    return MARK + text.replace(" ", MARK) if text else ""


def marked_words(text: str) -> list[str]:
    return MARKED_WORD.findall(marked(text))


def utf8(ch: str) -> bytes:
    """The character's bytes; a lone surrogate reads as U+FFFD."""
    try:
        return ch.encode()
    except UnicodeEncodeError:
        return b"\xef\xbf\xbd"
