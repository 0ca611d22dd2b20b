"""Byte-level BPE vocabularies: what a tokenizers file says, checked."""

from __future__ import annotations

import json
import re

#: Fixed value: how byte-level BPE of this kind divides texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelFile:
    """Vocabulary, merges and special strings of a byte-level BPE file.

    Files of another kind (a normalizer, another pre-tokenizer, a dropout, an
    incomplete byte alphabet, added tokens that strip or match words) would
    give other ids, so they raise ``ValueError``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, pre = said["model"], said.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and said.get("normalizer") is None and pre.get("type") == "ByteLevel"
                 and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        added = said.get("added_tokens") or []
        odd = [t for t in added if not t["content"] or any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
        if not plain or odd:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        of = byte_characters()
        self.special = {t["content"]: t["id"] for t in added}
        self.ids = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = [tuple(bytes(of[c] for c in half) for half in pair) for pair in pairs]
        self.size = max([*self.ids.values(), *self.special.values()]) + 1
        #: Matches any special string, longest first.
        self.special_pattern = re.compile(
            "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id (special ids: their strings)."""
        out = [b""] * self.size
        for token, i in self.ids.items():
            out[i] = token
        for text, i in self.special.items():
            out[i] = text.encode()
        return out
