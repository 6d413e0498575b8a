"""Token ids of texts by a tokenizer file of byte-level BPE, much faster than the file's own library gives them.

Such a tokenizer cuts a text by one fixed pattern and merges the bytes of each piece by rank. Where the
file's merges stand in order of the ids they make, the ids are the ranks, and ``tiktoken`` merges by
ranks. Its pattern and the library's know the same letters, digits and white space only among characters
that no version of Unicode has changed; a text with any other goes through the library itself.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: the pattern by which byte-level BPE of this family cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts without two white spaces in a row, of which no look-ahead is needed: much faster.
_SINGLE_SPACED = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_TWO_SPACES = re.compile("[\t\n\r ][\t\n\r ]")
#: ASCII, Latin, Greek and Cyrillic letters, general punctuation, kana, common Han and Hangul.
_SETTLED = re.compile("[\t\n\r -~¡-ɏΑ-ΡΣ-ώА-я‐-‧、-〃ぁ-ゖァ-ヺ一-龥가-힣]*")


class ByteEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ranks = {bytes_of(token): number for token, number in model["vocab"].items()}
        merged = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
        if merged != sorted(merged) or len(ranks) != len(merged) + 256:
            raise ValueError("the tokenizer's merges are not in order of their ids")
        added = self.tokenizer.get_added_tokens_decoder()
        specials = {token.content: number for number, token in added.items()}
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)
        self.single = tiktoken.Encoding("byte-level-single", pat_str=_SINGLE_SPACED, mergeable_ranks=ranks, special_tokens=specials)
        self.specials = set(specials)

    def encode(self, text: str) -> np.ndarray:
        if not _SETTLED.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        fitting = self.fast if _TWO_SPACES.search(text) else self.single
        return fitting.encode_to_numpy(text, allowed_special=self.specials)


def bytes_of(token: str) -> bytes:
    """Bytes that a token of a byte-level vocabulary stands for."""
    return token.translate(_BYTE_OF).encode("latin-1")


def _byte_of() -> dict[int, int]:
    """The byte for each printable character of a byte-level vocabulary: its own, or those left out from U+0100 on."""
    own = [byte for byte in range(256) if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174]
    others = [byte for byte in range(256) if byte not in own]
    return {byte: byte for byte in own} | {256 + i: byte for i, byte in enumerate(others)}


_BYTE_OF = _byte_of()
