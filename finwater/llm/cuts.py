"""Texts as parts that tokenizers handle one by one, with a memory of parts.

``spaced`` cuts before a space that follows a character other than white space
and is not the text's last character; ``runs`` also where the usual byte-level
pre-tokenizer must end a match: after an ASCII letter that no letter follows.
The tokenizers of this package never join what stands on the two sides of such
a cut: byte-level matches hold white space only at their start and nothing
after a letter but letters, and no piece of the piece vocabulary has U+2581
after another character (``safe_pieces`` checks it). So a part's tokens are
the same alone as inside its text.

A group of texts is cut in Arrow, and only its distinct parts are looked up;
texts with other white space at a space are cut in Python, to the same parts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts remembered per Python worker, and the bytes of their texts.
PART_CACHE, CACHE_BYTES = 1_500_000, 48 << 20

_SPACED = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
#: An ASCII letter and what is certain to begin another match.
_RUN_END = r"([A-Za-z])([\n!-@\[-`{-~])"
#: What ``_arrow_cut`` does not cut rightly: white space before a space, a
#: space (or nothing) at an end, and the character it cuts with.
_ODD = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] |^ | $|^$|\x00"
)


def spaced(text: str) -> list[str]:
    """The parts of a text, each with the space it starts with."""
    first, *rest = _SPACED.split(text)
    return [first, *(" " + p for p in rest)]


def safe_pieces(pieces: Iterable[str]) -> bool:
    """Whether no piece reaches over a cut at a space."""
    return not any("▁" in p.lstrip("▁") for p in pieces)


def _arrow_cut(texts: pa.Array, runs: bool) -> pa.Array:
    cut = pc.replace_substring(texts, " ", "\0 ")
    if runs:
        cut = pc.replace_substring_regex(cut, _RUN_END, "\\1\0\\2")
    return pc.split_pattern(cut, "\0")


def numbers(texts: list[str], memory: Memory, runs: bool = False, whole: bool = False) -> list[np.ndarray]:
    """Numbers of the parts of each text of a group; ``whole`` leaves the texts
    uncut."""
    if not texts:
        return []
    column = pa.array(texts, pa.string())
    if whole:
        lists, odd = pa.array([[t] for t in texts], pa.list_(pa.string())), np.zeros(len(texts), dtype=bool)
    else:
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False).astype(bool)
        lists = _arrow_cut(column.filter(pa.array(~odd)), runs)
    rest = pa.array([spaced(t) for t, o in zip(texts, odd) if o], pa.list_(pa.string()))
    parts = pa.concat_arrays([lists.flatten(), rest.flatten()]).dictionary_encode()
    found = memory.numbers(parts.dictionary)[parts.indices.to_numpy()]
    lengths = np.empty(len(texts), dtype=np.int64)
    lengths[~odd], lengths[odd] = (pc.list_value_length(x).to_numpy() for x in (lists, rest))
    starts = np.empty(len(texts), dtype=np.int64)
    order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    starts[order] = np.cumsum(lengths[order]) - lengths[order]
    return [found[a : a + n] for a, n in zip(starts, lengths)]


class Memory:
    """Numbers of parts, 0, 1, ... in the order in which ``learn`` is told of
    new ones; ``forget`` is called when the memory starts anew, between two
    groups of texts, so it is bounded by its limits and one group's parts."""

    def __init__(self, learn: Callable[[list[str]], None], forget: Callable[[], None], limit: int = PART_CACHE):
        self.learn, self.forget, self.limit = learn, forget, limit
        self.known = pa.array([], pa.string())

    def numbers(self, parts: pa.Array) -> np.ndarray:
        """Numbers of distinct parts."""
        if len(self.known) > self.limit or self.known.nbytes > CACHE_BYTES:
            self.known = pa.array([], pa.string())
            self.forget()
        # the group's parts are hashed and the remembered ones looked up in them:
        # a hash table of the whole memory would be made anew for every group
        at = pc.index_in(self.known, value_set=parts)
        found = np.full(len(parts), -1, dtype=np.int64)
        found[at.drop_null().to_numpy()] = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        new = parts.filter(pa.array(found < 0))
        if len(new):
            found[found < 0] = np.arange(len(self.known), len(self.known) + len(new))
            self.learn(new.to_pylist())
            self.known = pa.concat_arrays([self.known, new])
        return found


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start : start + length], one range after the other."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return values[np.repeat(start - end + length, length) + np.arange(total)]


class Growing:
    """A flat array that grows by appending (doubling its room)."""

    def __init__(self, dtype) -> None:
        self.room, self.n = np.empty(1024, dtype=dtype), 0

    def extend(self, values) -> None:
        values = np.asarray(values, dtype=self.room.dtype)
        if self.n + len(values) > len(self.room):
            grown = np.empty(max(2 * len(self.room), self.n + len(values)), dtype=self.room.dtype)
            grown[: self.n] = self.room[: self.n]
            self.room = grown
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.n]


__all__ = ["Growing", "Memory", "PART_CACHE", "gather", "numbers", "safe_pieces", "spaced"]
