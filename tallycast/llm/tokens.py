"""Token ids of whole texts by a public tokenizer file.

Most of a corpus repeats the same words, so each different word is encoded
once. Texts are cut only where the tokenizer's own splitting pattern always
cuts; a text for which that isn't certain, or that holds the string of an added
token, is encoded as one piece. Ids are those of the library's plain call.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallycast.llm.batches import ranges

# The encoder forgets words beyond this many ids or words, but for the first it met, which are the commonest.
CACHE_IDS = 5_000_000
CACHE_WORDS = 500_000
KEPT_WORDS = 100_000
CUT = "\x01"
# So many new words are encoded as one text.
TOGETHER = 200
# Stands between them and is a token of its own.
MARKS = {"blank": "\n", "dropped": "~"}
# What may be encoded next to others: no white space but a blank at the start.
WORD = re.compile(r" ?[^\s\x85]+")
# White space after a blank or a line feed, where the pattern looks ahead.
LOOKAHEAD = "[ \n]([\\s\x0b\x85   -     　]|$)"


def cutting(spec: dict) -> str:
    """How texts may be cut: 'blank' (a word keeps the blank before it), 'dropped' or 'never'."""
    pre, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not normalizer:
        return "blank"
    parts = pre.get("pretokenizers") or [{}]
    kinds = {n["type"] for n in (normalizer or {}).get("normalizers", [])}
    if (
        parts[0].get("type") == "Split"
        and parts[0].get("behavior") == "Removed"
        and parts[0].get("invert")
        and "[^\\s" in parts[0].get("pattern", {}).get("Regex", "")
        and not any(p.get("add_prefix_space") for p in parts)
        and kinds <= {"NFC", "Replace", "Lowercase"}
    ):
        return "dropped"
    return "never"


class Encoder:
    """Encodes arrays of texts as the library does one by one."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._cutting = cutting(spec)
        self._added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        self._mark = MARKS.get(self._cutting, "")
        alone = self._tokenizer.encode(self._mark, add_special_tokens=False).ids
        self._mark_id = alone[0] if len(alone) == 1 else None
        self._places: dict[str, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)

    def forget(self, kept: int = KEPT_WORDS) -> None:
        """Keep only the words learned first; a task that is done leaves no more behind."""
        if len(self._places) <= kept:
            return
        self._places = dict(islice(self._places.items(), kept))
        self._starts, self._lengths = self._starts[:kept].copy(), self._lengths[:kept].copy()
        self._ids = self._ids[: int(self._lengths.sum())].copy()

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many at a time as one text with a mark between them."""
        if self._mark_id is None:
            together, alone = [], words
        else:
            together, alone = [], []
            for w in words:
                (together if WORD.fullmatch(w) and self._mark not in w else alone).append(w)
        joint = f" {self._mark} " if self._cutting == "dropped" else self._mark
        groups = [together[i : i + TOGETHER] for i in range(0, len(together), TOGETHER)]
        ids = self._all_ids([joint.join(g) + joint for g in groups])[0]
        ends = np.flatnonzero(ids == self._mark_id) if groups else np.zeros(0, np.int64)
        self._keep(together, np.delete(ids, ends), np.diff(ends, prepend=-1) - 1)
        self._keep(alone, *self._all_ids(alone))

    def _all_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(f, np.uint32) for f in found)]), lengths

    def _keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self._places.update(zip(words, range(len(self._places), len(self._places) + len(words))))
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(lengths) - lengths])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._ids = np.concatenate([self._ids, ids])

    def _pieces(self, texts: pa.LargeStringArray) -> pa.LargeListArray:
        """The pieces of each text; a text holds no ``CUT``."""
        if self._cutting == "never":
            return pc.split_pattern(texts, CUT)
        cut = texts
        for stop in (". ", ", ", ".\n"):
            cut = pc.replace_substring(cut, stop, CUT + stop)
        # A stop that ends a longer run of marks stays with it.
        cut = pc.if_else(pc.match_substring_regex(texts, "(^|[^\\pL\\pN])[.,][ \n]"), texts, cut)
        if self._cutting == "dropped":
            return pc.split_pattern(pc.replace_substring(pc.replace_substring(cut, "\n", CUT), " ", CUT), CUT)
        cut = pc.replace_substring(pc.replace_substring(cut, " ", f"{CUT} "), "\n", f"{CUT}\n{CUT}")
        return pc.split_pattern(pc.if_else(pc.match_substring_regex(texts, LOOKAHEAD), texts, cut), CUT)

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = pc.match_substring(texts, CUT)
        for added in self._added:
            whole = pc.or_(whole, pc.match_substring(texts, added, ignore_case=True))
        whole = whole.to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._cut(texts)
        parts = [self._all_ids(texts.filter(pa.array(whole)).to_pylist()), self._cut(texts.filter(pa.array(~whole)))]
        lengths = np.zeros(len(texts), np.int64)
        lengths[whole], lengths[~whole] = parts[0][1], parts[1][1]
        ids, ends = np.empty(int(lengths.sum()), np.uint32), np.cumsum(lengths)
        for (found, sizes), places in zip(parts, (whole, ~whole)):
            ids[ranges(ends[places] - sizes, sizes)] = found
        return ids, lengths

    def _cut(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for texts that may be cut."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        pieces = self._pieces(texts)
        offsets = pieces.offsets.to_numpy()
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self._ids) > CACHE_IDS or len(self._places) > CACHE_WORDS:
            self.forget()  # before new words are learned, as places change
        if new := [w for w in words if w not in self._places]:
            self._learn(new)
        place = np.fromiter(map(self._places.__getitem__, words), np.int64, len(words))
        place = place[coded.indices.to_numpy()] if len(words) else place
        lengths = self._lengths[place]
        ids = self._ids[ranges(self._starts[place], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[offsets - offsets[0]])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(path)


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and the new lengths."""
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    out[ranges(np.cumsum(lengths + 1) - lengths - 1, lengths)] = ids
    return out, lengths + 1
