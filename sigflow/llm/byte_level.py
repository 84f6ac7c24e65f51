"""Identifiers of a byte-level BPE tokenizer file.

A plain file of this kind (byte-level pre-tokenizer, no normalizer, merges in
the order of their identifiers) is read into tiktoken, which gives the same
identifiers at a quarter of the CPU time; any other file, and a text that
tiktoken refuses (a white-space run of a million characters), goes to the
tokenizers library.
"""

from __future__ import annotations

import json

import numpy as np

from sigflow.llm.byte_bpe import segments

# Fixed value: the split of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: the
    visible ones of Latin-1 for themselves, the others from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevelTokenizer:
    """``specials``: strings of special tokens inside a text are such tokens
    (the tokenizers library's default); else they are plain text."""

    def __init__(self, path: str, specials: bool):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not specials
        with open(path, encoding="utf-8") as f:
            read = json.load(f)
        alphabet = byte_alphabet()
        vocab = read["model"]["vocab"]
        #: The bytes of each identifier.
        self.tokens: dict[int, bytes] = {i: bytes(map(alphabet.__getitem__, t)) for t, i in vocab.items() if set(t) <= alphabet.keys()}
        self.special = {x["content"]: x["id"] for x in read["added_tokens"]}
        for content, i in self.special.items():
            self.tokens.setdefault(i, content.encode())
        self.fast = self._fast(read, specials) if self._plain(read, alphabet) else None

    @staticmethod
    def _plain(read: dict, alphabet: dict[str, int]) -> bool:
        model, split = read["model"], read["pre_tokenizer"] or {}
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        return (
            model["type"] == "BPE"
            and not any(model.get(x) for x in options)
            and read["normalizer"] is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and all(set(t) <= alphabet.keys() for t in vocab)
            and all(c in vocab and vocab[c] < len(alphabet) for c in alphabet)
            and all(vocab.get("".join(m)) == len(alphabet) + i for i, m in enumerate(merges))
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in read["added_tokens"])
        )

    def _fast(self, read: dict, specials: bool):
        import tiktoken

        ranks = {self.tokens[i]: i for i in read["model"]["vocab"].values()}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special if specials else {})

    def encode(self, text: str) -> list[int]:
        """The identifiers that the library gives without added tokens. A
        long text goes in parts, cut where no match of the split crosses."""
        if self.fast is not None:
            try:
                out: list[int] = []
                for s in segments(text):
                    out += self.fast.encode(s, allowed_special="all", disallowed_special=())
                return out
            except ValueError:
                pass
        return self.library.encode(text, add_special_tokens=False).ids

    def lengths(self) -> np.ndarray:
        """Bytes of each identifier's token."""
        out = np.zeros(max(self.tokens) + 1, np.int64)
        for i, t in self.tokens.items():
            out[i] = len(t)
        return out
