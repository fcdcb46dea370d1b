"""Public tokenizer vocabularies, loaded once a Python worker from paths given as parameters."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import lru_cache

import public_tokenizers
import tiktoken

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=4)
def byte_bpe(path: str = BYTE_BPE) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file, with the same ids, run by ``tiktoken``.

    It is five times as fast as ``tokenizers`` on the same text. Added tokens
    in a text are ordinary text here; ``byte_bpe_ids`` recognises them. The file
    must be a plain byte-level BPE: no normaliser, no prefix space, ids of single
    bytes and merges in rank order.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before, model = spec["pre_tokenizer"], spec["model"]
    if (spec["normalizer"], before["type"], before["add_prefix_space"], model["type"]) != (
        None,
        "ByteLevel",
        False,
        "BPE",
    ):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    # Bytes stand as printable characters: themselves, or from U+0100 on in order.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    as_byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {
        bytes(as_byte[c] for c in token): number
        for token, number in model["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=4)
def byte_bpe_ids(path: str = BYTE_BPE) -> Callable[[str], list[int]]:
    """Text to ids, as ``tokenizers`` with its default settings and ``add_special_tokens=False``.

    Added tokens of the file, such as ``<|endoftext|>``, have their own id
    wherever a text holds them; what is between them is cut by itself.
    """
    encode = byte_bpe(path).encode_ordinary
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path} has added tokens that depend on what is around them")
    if len({t["normalized"] for t in added}) > 1:
        raise ValueError(f"{path} has added tokens of two kinds")
    number = {t["content"]: t["id"] for t in added}
    if not number:
        return encode
    # The leftmost one, and of those that start there the longest.
    longest = sorted(number, key=len, reverse=True)
    split = re.compile(f"({'|'.join(map(re.escape, longest))})").split

    def ids(text: str) -> list[int]:
        parts = split(text)
        found = encode(parts[0])
        for token, rest in zip(parts[1::2], parts[2::2], strict=True):
            found.append(number[token])
            found += encode(rest)
        return found

    return ids


@lru_cache(maxsize=4)
def byte_ranks(path: str) -> tiktoken.Encoding:
    """A vocabulary from a file of ranks."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=4)
def piece_bpe(path: str = PIECE_BPE):
    """A sentencepiece model, and which of its ids stand for single bytes."""
    import numpy as np
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    is_byte = np.array([model.is_byte(i) for i in range(model.vocab_size())])
    return model, is_byte
