"""Byte-pair merge lists: loading, merging, and what can be proved about them.

Shared by the token counter and the encoder. Everything here works on one
vocabulary file, whose path is a parameter, and is cached per process.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, lru_cache

import regex

#: White space as the tokenizers' patterns see it (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(None)
def _unknown(letter: str) -> bool:
    return letter > "\u0377" and unicodedata.category(letter) == "Cn"


class Cutter:
    """Cuts texts by a pattern that names letters, numbers, white space and
    other signs as ``<L>``, ``<N>``, ``<S>`` and ``<O>``.

    The regex module knows newer letters than the tokenizers do. Those which
    Python's own tables don't know count as other signs; a text that has one
    is cut by a second, slower pattern, which leaves them out.
    """

    def __init__(self, pattern: str):
        self._pattern = pattern
        self._plain = self._compiled(r"\p{L}", r"\p{N}", rf"[^{SPACE}\p{{L}}\p{{N}}]")

    def _compiled(self, letter: str, number: str, other: str):
        parts = {"<L>": letter, "<N>": number, "<O>": other, "<S>": SPACE}
        return regex.compile(regex.sub("<[LNOS]>", lambda m: parts[m.group()], self._pattern))

    @cached_property
    def _careful(self):
        runs: list[list[int]] = []
        for c in (c for c in range(0x378, 0x3FFFF) if _unknown(chr(c)) and regex.match(r"[\p{L}\p{N}]", chr(c))):
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        new = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
        return self._compiled(rf"(?:(?![{new}])\p{{L}})", rf"(?:(?![{new}])\p{{N}})", rf"(?:[^{SPACE}\p{{L}}\p{{N}}]|[{new}])")

    def words(self, text: str) -> Iterable[str]:
        """The pre-tokens of a text; of a very long one, one at a time."""
        cut = self._plain if text.isascii() or not any(map(_unknown, set(text))) else self._careful
        return cut.findall(text) if len(text) <= LONG else (m.group() for m in cut.finditer(text))


#: Words up to this many symbols are merged by rescanning, longer ones by a heap.
RESCAN = 48
#: Texts beyond this many characters are cut one pre-token at a time.
LONG = 1 << 20


@lru_cache(1)
def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for
    themselves, the others get the letters from 256 on, in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


@dataclass
class Merges:
    """A merge list: ``rank`` of each mergeable pair, ``ids`` of each token."""

    ids: dict[str, int]
    rank: dict[tuple[str, str], int]
    suffix: str
    special: dict[str, int]

    def symbols(self, word: str, ends: bool = True) -> list[str]:
        """One symbol a byte; the last carries the word-end suffix, if any."""
        letters = byte_letters()
        out = list(word) if word.isascii() and word.isprintable() and " " not in word else [letters[b] for b in word.encode("utf-8", "replace")]
        if ends and out and self.suffix:
            out[-1] += self.suffix
        return out

    def merge(self, parts: list[str]) -> list[str]:
        """Merge ``parts``, which are used up: always the lowest-ranked pair, leftmost first."""
        if len(parts) > RESCAN:
            return self._merge_by_heap(parts)
        get, none = self.rank.get, 1 << 60
        ranks = [get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            joined = parts[i] = parts[i] + parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], joined), none)
            if i < len(ranks):
                ranks[i] = get((joined, parts[i + 1]), none)
        return parts

    def _merge_by_heap(self, parts: list[str]) -> list[str]:
        rank, n = self.rank, len(parts)
        parts = list(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j < 0 or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (q := rank.get((parts[left], parts[after[left]]))) is not None:
                    heapq.heappush(heap, (q, left))
        return [p for p in parts if p is not None]

    def lookahead(self) -> int:
        """How many symbols before the end of a known stretch its tokens may
        still change, whatever follows: the list's sufficient lookahead.

        Compare two texts that agree up to some place. Their tokens agree up
        to a frontier, at first that place. The frontier moves left only when
        a pair (x, y) merges in one of them with x the last common token; it
        moves by the length of x, and what then stands right of it starts with
        x, however it grows. The next such pair has a higher rank, because in
        a proper list a token takes part in no rule before the one that makes
        it. So the longest chain of rules of rising rank, where the left token
        of one starts the right token of the next, bounds the movement. It is
        found in one pass over the rules in rank order.
        """
        base = {*byte_letters(), *(c + self.suffix for c in byte_letters())}
        made, lefts = set(base), {}
        reach: dict[str, int] = {}
        longest = 0
        for x, y in sorted(self.rank, key=self.rank.get):
            if x not in made or y not in made:
                raise ValueError(f"rule {x!r} {y!r} uses a token that no earlier rule makes")
            spine, todo = {y}, [y]
            while todo:
                for z in lefts.get(todo.pop(), ()):
                    if z not in spine:
                        spine.add(z)
                        todo.append(z)
            far = self.length(x) + max(reach.get(s, 0) for s in spine)
            reach[x] = max(reach.get(x, 0), far)
            made.add(x + y)
            lefts.setdefault(x + y, set()).add(x)
            longest = max(longest, far)
        return longest

    def length(self, token: str) -> int:
        """Symbols (bytes) of a token."""
        return len(token) - len(self.suffix) * bool(self.suffix and token.endswith(self.suffix))

    def whole(self) -> dict[str, int]:
        """Proof of the whole-token shortcut: the vocabulary strings which,
        merged alone, come out as themselves, as text. (Not all do: the merges
        of a string may run past the pair that its rule joins.)"""
        value = {c: b for b, c in enumerate(byte_letters())}
        out = {}
        for token, i in self.ids.items():
            if token in self.special or not all(c in value for c in token):
                continue
            if self.merge(list(token)) == [token]:
                try:
                    out[bytes(value[c] for c in token).decode()] = i
                except UnicodeDecodeError:  # part of a character is never a pre-token
                    pass
        return out


@lru_cache(4)
def load(path: str) -> Merges:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return Merges(
        model["vocab"],
        {tuple(p): i for i, p in enumerate(pairs)},
        model.get("end_of_word_suffix") or "",
        {t["content"]: t["id"] for t in spec["added_tokens"]},
    )


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
