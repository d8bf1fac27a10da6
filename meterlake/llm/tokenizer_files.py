"""Token ids and counts by public tokenizer files, inside tasks.

The files are parameters. A byte-level BPE file may name the same vocabulary as a list of
ranks: it is then encoded from the ranks, several times faster and with the same ids; a text
on which that encoder gives up (over a million blanks in a row, say) goes to the file's own
library. Special strings inside a text become their special id, as is that library's default.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import os
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TokenizerFile:
    """``path``: a ``.json`` of tokenizers or a ``.model`` of sentencepiece; ``ranks``: for a byte-level
    BPE ``.json``, a file with the same vocabulary as base64 words and ranks; ``pattern``: its
    pre-tokenizing expression."""

    path: str
    ranks: str | None = None
    pattern: str | None = None

    def version(self) -> str:
        """Digest of the tokenizer: of its file's bytes."""
        with open(self.path, "rb") as f:
            return hashlib.sha256(f.read()).hexdigest()


def public_byte_bpe() -> TokenizerFile:
    import public_tokenizers as public
    return TokenizerFile(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


class Encoder:
    def __init__(self, file: TokenizerFile):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.file, self.fast, self.pieces = file, None, None
        if file.path.endswith(".model"):
            import sentencepiece
            self.pieces = sentencepiece.SentencePieceProcessor(model_file=file.path)
        elif file.ranks:
            import json

            import tiktoken
            with open(file.ranks, "rb") as f:
                ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}
            with open(file.path, encoding="utf-8") as f:
                special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
            self.fast = tiktoken.Encoding("ranks", pat_str=file.pattern, mergeable_ranks=ranks, special_tokens=special)

    @functools.cached_property
    def whole(self):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.file.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def ids(self, text: str) -> np.ndarray:
        if self.pieces is not None:
            return np.asarray(self.pieces.encode(text, num_threads=1), dtype=np.uint32)
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def count(self, text: str) -> int:
        return len(self.ids(text))


@functools.lru_cache(maxsize=2)
def encoder(file: TokenizerFile) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(file)
