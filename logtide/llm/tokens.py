"""Token ids of texts, by a public byte-level BPE vocabulary.

The ids are those of the ``tokenizers`` library with the vocabulary's JSON file. The same
vocabulary also comes as ranks for ``tiktoken``, which needs a third of the time. Texts of
the characters on which both libraries' patterns are known to agree (COMMON) are encoded
with the ranks, all others with ``tokenizers``; tests compare the two.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

# ASCII with tab and line ends, Latin letters, and general punctuation without its spaces.
COMMON = re.compile(r"[\t\n\r -~¡-ɏ‐-‧‰-⁞]*")

_encoders: dict[str | None, "Encoder"] = {}


def encoder(path: str | None = None) -> "Encoder":
    """The worker's encoder; ``path`` None is the 50k byte-level BPE of the public tokenizers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """``path``: a file of the ``tokenizers`` library, used for all texts if it is named."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.ranks = self.tokenizer = None
        if path is None:
            import public_tokenizers
            import tiktoken

            path = public_tokenizers.path("byte_bpe_50k.json")
            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = path
        with open(path, encoding="utf-8") as file:
            # Their strings are one token wherever they stand in a text.
            self.added = [token["content"] for token in json.load(file).get("added_tokens", [])]

    def slow_ids(self, text: str) -> bytes:
        if self.tokenizer is None:  # loaded with the first text that needs it
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit bytes."""
        if self.ranks is None:
            return [self.slow_ids(t) for t in texts]
        return [
            np.asarray(self.ranks.encode_ordinary(t), "<u4").tobytes()
            if COMMON.fullmatch(t) and not any(token in t for token in self.added) else self.slow_ids(t)
            for t in texts]
