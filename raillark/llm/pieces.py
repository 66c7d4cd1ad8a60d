"""Pieces of a sentencepiece model and the segments that never share a piece."""

from __future__ import annotations

import re
from functools import lru_cache

import public_tokenizers
import sentencepiece

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Entries a worker keeps of what it has worked out already.
CACHE = 1 << 20


class Pieces:
    """Ordinary pieces by text with id and score; byte pieces by value."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        ordinary = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in ordinary}
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ordinary}
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.longest = max(map(len, self.ids))
        inner = set("".join(self.ids))
        alone = "".join(c for c in "\n\t\r" if c not in inner)
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        if crossing:
            raise ValueError("a piece holds a word mark after other characters; texts cannot be cut at marks")
        stop = re.escape(alone)
        self.segment = re.compile(f"[{stop}]|{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+")

    def segments(self, text: str) -> list[str]:
        """The text with its leading mark, cut where no piece can lie across."""
        return self.segment.findall(MARK + text.replace(" ", MARK)) if text else []


@lru_cache(maxsize=2)
def pieces(path: str | None = None) -> Pieces:
    return Pieces(path or public_tokenizers.path(MODEL))
