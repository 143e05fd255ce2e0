"""Token ids of a byte-level tokenizer file, once per Python worker."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from recprep.llm.chunks import ChunkEncoder

_ROW = 50_000  # chunks encoded by one call


class FileEncoder:
    """Ids of whole texts as bytes (``width`` each, little-endian), as the tokenizer file gives them.

    A text is cut at the file's added tokens first, as the tokenizers library does it; what lies
    between goes through the chunk encoder. Without ``added`` their strings are ordinary text.
    """

    def __init__(self, many: Callable[[list[str]], list[bytes]], width: np.dtype, added: dict[str, int], limit: int):
        self.many, self.width = many, width
        self.chunks = ChunkEncoder(many, limit)
        self.added = {token: np.array([i], width).tobytes() for token, i in added.items()}
        # Of added tokens that start at one place the longest counts.
        longest = sorted(added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.cut is None:
            return self.chunks.encode(texts)
        parts: list[str] = []
        plan = []
        for text in texts:
            pieces = self.cut.split(text) if self.cut.search(text) else [text]
            plan.append((len(parts), pieces[1::2]))
            parts += pieces[::2]
        ids = self.chunks.encode(parts)
        out = []
        for at, marks in plan:
            whole = ids[at]
            for k, mark in enumerate(marks, 1):
                whole += self.added[mark] + ids[at + k]
            out.append(whole)
        return out


@lru_cache(maxsize=4)
def load(path: str, pattern: str, special: bool = True) -> FileEncoder:
    """The encoder of a tokenizers file; ids take two bytes where the vocabulary allows it.

    With ``special`` the strings of added tokens become their ids (the library's default),
    without it they are ordinary text (``encode_special_tokens``). Where the ids of a
    byte-level BPE rise in the order of its merges, ids are ranks, and the rank-based library
    gives the same ids several times faster; else the tokenizer itself encodes.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    width = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    entries = spec.get("added_tokens", [])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or not t.get("special") for t in entries):
        raise ValueError(f"added tokens of {path} take white space or are no special tokens")
    ranks = ranks_of(spec)
    if ranks:
        import tiktoken

        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        many = joined_many(encode, ranks, width)
    else:

        def many(chunks: list[str]) -> list[bytes]:
            return [np.array(e.ids, width).tobytes() for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    return FileEncoder(many, width, {t["content"]: t["id"] for t in entries} if special else {}, 0 if ranks else 300_000)


def joined_many(encode: Callable[[str], list[int]], ranks: dict[bytes, int], width: np.dtype) -> Callable[[list[str]], list[bytes]]:
    """Ids of each chunk as bytes, by one call for many chunks.

    Chunks of a space, then visible characters at both ends, can stand in a row: each space starts a new
    pre-token (see :func:`recprep.llm.chunks.cut`). The bytes of the tokens tell where a chunk's ids end.
    Other chunks are encoded one by one.
    """
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[np.fromiter(ranks.values(), np.int64, len(ranks))] = [len(token) for token in ranks]

    def row(chunks: list[str]) -> list[bytes]:
        ids = np.array(encode("".join(chunks)), np.int64)
        ends = np.cumsum(pc.binary_length(pa.array(chunks, pa.large_string())).to_numpy())
        told = np.cumsum(sizes[ids])
        at = np.searchsorted(told, ends)
        if (told[at] != ends).any():
            raise ValueError("a token spans two chunks: the pattern does not cut before a space")
        data = ids.astype(width).tobytes()
        cuts = [0, *((at + 1) * width.itemsize).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def many(chunks: list[str]) -> list[bytes]:
        fit = [len(c) > 1 and c[0] == " " and not (c[1].isspace() or c[-1].isspace()) for c in chunks]
        held = list(compress(chunks, fit))
        rows = chain.from_iterable(row(held[at : at + _ROW]) for at in range(0, len(held), _ROW))
        return [next(rows) if f else np.array(encode(c), width).tobytes() for c, f in zip(chunks, fit)]

    return many


def byte_stand_ins() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: themselves where printable, else 256 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    stand_in = {chr(b): b for b in shown}
    stand_in.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    return stand_in


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if ids follow the merges and the file asks for nothing but byte-level BPE."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space") and before.get("use_regex", True) and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    )
    if not plain:
        return None
    stand_in, vocabulary = byte_stand_ins(), model["vocab"]
    added = {t["content"] for t in spec.get("added_tokens", [])}
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    singles = [vocabulary.get(c) for c in stand_in]
    if None in singles or any(a >= b for a, b in zip(merged, merged[1:])) or merged and max(singles) >= merged[0]:
        return None
    return {bytes(stand_in[c] for c in token): i for token, i in vocabulary.items() if token not in added}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    """Bytes of each id of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    stand_in = byte_stand_ins()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    return {i: t.encode() if t in added else bytes(stand_in[c] for c in t) for t, i in spec["model"]["vocab"].items()}
