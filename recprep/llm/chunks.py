"""Cut a text where a byte-level pre-tokenizer always cuts, and encode each distinct chunk once."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable
from functools import wraps
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TWO_SPACES = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def no_cycles(work: Callable) -> Callable:
    """Run without the search for reference cycles, which scans large memories again and again and finds none here."""

    @wraps(work)
    def quiet(*args, **options):
        on = gc.isenabled()
        gc.disable()
        try:
            return work(*args, **options)
        finally:
            if on:
                gc.enable()

    return quiet


def cut(text: str) -> tuple[str, list[str]]:
    """The first chunk, and the others without the one space that precedes each of them.

    A single space between two visible characters always starts a new pre-token of the
    patterns used here (a space joins the word to its right, and no other alternative spans
    it), so the chunks can be encoded one by one. Other white space stays inside its chunk.
    """
    if text.startswith(" ") or text.endswith(" ") or _TWO_SPACES.search(text):
        head, *rest = _SAFE_CUT.split(text)
    else:
        head, *rest = text.split(" ")
    return head, rest


class ChunkEncoder:
    """Encode texts chunk by chunk, each distinct chunk of a call once, with a bounded memory of chunks met before.

    ``encode_many`` maps chunks to their ids as bytes. When the memory holds more than ``limit`` chunks,
    the half met first stays, among them most frequent ones; that changes the time, never the ids.
    With a limit of 0 nothing is remembered, for an ``encode_many`` that is as fast or has a memory of its own.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = 300_000):
        self.encode_many, self.limit = encode_many, limit
        self.known: dict[str, bytes] = {}

    @no_cycles
    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known = dict(islice(self.known.items(), self.limit // 2))
        heads, chunks, counts = _cut_all(texts)
        coded = chunks.dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        joined = ids.take(coded.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)[np.cumsum([0, *counts])].tolist()
        data = joined.buffers()[2]
        data = memoryview(data) if data is not None else b""
        return [head + bytes(data[a:b]) for head, a, b in zip(self.encode_many(heads), ends, ends[1:])]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        if not self.limit:
            return self.encode_many([" " + c for c in chunks])
        fresh = [c for c in chunks if c not in self.known]
        self.known.update(zip(fresh, self.encode_many([" " + c for c in fresh])))
        return list(map(self.known.__getitem__, chunks))


def _cut_all(texts: list[str]) -> tuple[list[str], pa.Array, np.ndarray]:
    """:func:`cut` of many texts: the first chunks, the others in a row, and how many each text has of those."""
    counts = np.zeros(len(texts), np.int64)
    plain = [not (t.startswith(" ") or t.endswith(" ") or _TWO_SPACES.search(t)) for t in texts]
    if all(plain):
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        starts = split.offsets.to_numpy()[:-1] if len(texts) else counts
        rest = np.ones(len(split.values), bool)
        rest[starts] = False
        counts = pc.list_value_length(split).to_numpy().astype(np.int64) - 1
        return split.values.take(pa.array(starts)).to_pylist(), split.values.filter(pa.array(rest)), counts
    heads, parts, run = [], [], 0
    while run < len(texts):  # runs of texts of either kind, in their order
        to = next((i for i in range(run, len(texts)) if plain[i] != plain[run]), len(texts))
        if plain[run]:
            head, part, counts[run:to] = _cut_all(texts[run:to])
        else:
            cuts = [cut(t) for t in texts[run:to]]
            head, part = [h for h, _ in cuts], pa.array([c for _, rest in cuts for c in rest], pa.large_string())
            counts[run:to] = [len(rest) for _, rest in cuts]
        heads += head
        parts.append(part)
        run = to
    return heads, pa.concat_arrays(parts), counts
