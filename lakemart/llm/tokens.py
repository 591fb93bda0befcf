"""Token ids of whole texts with a public tokenizer, word by word where that is the same.

A text is cut where no token can cross the cut; each distinct part is encoded once per worker (a
cache of bounded size). Arrow cuts a run of texts and numbers its distinct parts, and NumPy gathers
their ids, so only distinct parts become Python strings. Which cuts are safe follows from the tokenizer's own
pre-tokenizer; any other tokenizer, and any text with unusual white space, is encoded whole.
"""

from __future__ import annotations

import json
import os
import string
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakemart.llm.common import worker_state

CACHE_PARTS, GROUP, ROWS = 1_000_000, 1000, 2048

#: Signs that may end a word as a token of their own, and the end of the letters for which that is relied on.
SIGNS, LAST_LETTER = string.punctuation, "\u0370"
#: Before the first part of a line in a cut text; texts that hold it themselves are encoded whole.
HEAD = "\x01"


def _gathered(pool: np.ndarray, start: np.ndarray, n: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The ids of each text: those of each part of all texts are ``n`` ids of ``pool`` from ``start`` on, ``first`` are the
    texts' places among the parts."""
    end = np.append(0, np.cumsum(n))
    out = pool[np.repeat(start - end[:-1], n) + np.arange(end[-1])]
    cut = end[first].tolist()
    return [out[a:z].tobytes() for a, z in zip(cut, cut[1:], strict=False)]


def _joined(ids: list[bytes], part: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The ids of each text: ``part`` numbers the parts of all texts, whose ids are ``ids``."""
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    start = np.cumsum(size) - size
    return _gathered(np.frombuffer(b"".join(ids), "<u4"), start[part], size[part], first)


class Pool:
    """Ids of parts, one after another in one array, with each part's place: no object of its own for a part's ids."""

    def __init__(self, first: dict[str, np.ndarray]):
        self.first = first
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.off = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.add(list(self.first), list(self.first.values()), np.fromiter(map(len, self.first.values()), np.int64))

    def keep(self, parts: list[str]) -> None:
        """Keep these parts alone, of all that are here."""
        at = self.find([x for x in parts if x not in self.first])
        start, size = self.off[at], self.off[at + 1] - self.off[at]
        ids = self.ids[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]
        self.clear()
        self.add([x for x in parts if x not in self.first], [ids], size)

    def add(self, parts: list[str], ids: list[np.ndarray], size: np.ndarray) -> None:
        """New parts, with runs of ids that hold theirs in order, and how many each has."""
        at = len(self.off) - 1
        self.place.update(zip(parts, range(at, at + len(parts)), strict=True))
        self.ids = np.concatenate([self.ids, *ids])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(size)])

    def find(self, parts: list[str]) -> np.ndarray:
        """The place of each part, -1 for those that are not here."""
        return np.fromiter(map(self.place.get, parts, repeat(-1)), np.int64, len(parts))


def _cut(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct parts between spaces, the number of each part of all texts, and each text's place in these."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy()


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes; a run of ``ROWS`` texts is
    a good measure, as parts that they share are looked up once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre, norm = conf.get("pre_tokenizer") or {}, conf.get("normalizer")
        steps = [p.get("type") for p in pre.get("pretokenizers", [])]
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            self.mode = "space before"  # a token holds a space at its start only, a line end alone, but for runs of white space
        elif steps == ["Split", "ByteLevel"] and pre["pretokenizers"][0].get("behavior") == "Removed" and (
                conf["model"].get("end_of_word_suffix")):
            self.mode = "words"  # white space is dropped and no token crosses it
        else:
            self.mode = "whole"
        self.size = self.tok.get_vocab_size()
        names = [self.tok.id_to_token(i) or "" for i in range(self.size)]
        suffix = conf["model"].get("end_of_word_suffix") or "</w>"
        self.first = np.array([n.startswith("Ġ") for n in names])
        self.last = np.array([n.endswith(suffix) for n in names])
        self.parts: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.pool = Pool({"": np.zeros(0, "<u4"), "\n": np.frombuffer(self._each(["\n"])[0], "<u4")})

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if self.mode == "whole" or not texts:
            return self._each(texts)
        return self._spaced(texts) if self.mode == "space before" else self._split(texts)

    def _learn(self, known: dict[str, bytes], new: set[str], lead: str, mark: np.ndarray, at_end: bool) -> None:
        """Ids of new parts (each with ``lead`` before it): a word and the signs that end it are encoded apart, words
        in groups whose ids are cut at marked tokens, or one by one if the marks do not add up."""
        ended = {}
        for x in new:
            word = x.rstrip(SIGNS)
            if word and len(word) < len(x) and word.isalpha() and max(word) < LAST_LETTER and word.lower().isalpha():
                ended[x] = (word, x[len(word):])
        whole = new.difference(ended)
        whole.update(w for w, _ in ended.values() if w not in known)
        words = sorted(x for x in whole if x.isalpha()) if at_end else sorted(whole)
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        texts = [lead + " ".join(g) for g in groups]
        for g, e in zip(groups, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            at = np.flatnonzero(mark[ids])
            if len(at) != len(g) or (at[-1] != len(ids) - 1 if at_end else at[0] != 0):
                known.update(zip(g, self._each([lead + x for x in g]), strict=True))
                continue
            raw = ids.tobytes()
            cut = ([0, *((at + 1) * 4).tolist()] if at_end else [*(at * 4).tolist(), len(raw)])
            known.update(zip(g, (raw[a:z] for a, z in zip(cut, cut[1:], strict=False)), strict=True))
        others = sorted(whole.difference(words))
        known.update(zip(others, self._each([lead + x for x in others]), strict=True))
        signs = sorted({t for _, t in ended.values()}.difference(self.signs))
        self.signs.update(zip(signs, self._each(signs), strict=True))
        for x, (word, end) in ended.items():
            known[x] = known[word] + self.signs[end]

    def _known(self, parts: list[str]) -> tuple[list[bytes | None], list[int]]:
        """What the cache has of ``parts``, and the places of those it lacks; it is emptied when it gets too large."""
        ids = list(map(self.parts.get, parts))
        lacks = [i for i, x in enumerate(ids) if x is None]
        if len(self.parts) + len(lacks) > CACHE_PARTS:
            self.parts.clear()
            return [None] * len(parts), list(range(len(parts)))
        return ids, lacks

    def _learn_spaced(self, new: list[str]) -> None:
        """Ids of new parts, in groups whose ids are cut at tokens that begin with a space, or one by one if these do not
        add up; parts at a line's head are encoded one by one. Parts that begin or end in white space are left out, as
        a run of it could cross the cut."""
        if any(x.isspace() for x in {*map(itemgetter(0), new), *map(itemgetter(-1), new), *[x[1] for x in new if x[0] == HEAD and x != HEAD]}):
            new = [x for x in new if not (x[0].isspace() or x[-1].isspace() or x[1:2].isspace() and x[0] == HEAD)]
        words, heads = [x for x in new if x[0] != HEAD], [x for x in new if x[0] == HEAD and x != HEAD]
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        ids, size = [], []
        for g, e in zip(groups, self.tok.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False), strict=True):
            x = np.array(e.ids, dtype="<u4")
            at = np.flatnonzero(self.first[x])
            if len(at) != len(g) or at[0] != 0:
                each = [np.frombuffer(y, "<u4") for y in self._each([" " + y for y in g])]
                x, at = np.concatenate(each), np.cumsum([0, *map(len, each[:-1])])
            ids.append(x)
            size.append(np.diff(np.append(at, len(x))))
        each = [np.frombuffer(y, "<u4") for y in self._each([x[1:] for x in heads])]
        size.append(np.fromiter(map(len, each), np.int64, len(each)))
        self.pool.add(words + heads, ids + each, np.concatenate(size))

    def _spaced(self, texts):
        # a part that is empty, or begins or ends in white space, would let a run of white space cross a cut
        parts, part, first = _cut([HEAD + t.replace("\n", f" \n {HEAD}") for t in texts])
        at = self.pool.find(parts)
        if len(self.pool.place) + np.count_nonzero(at < 0) > CACHE_PARTS:
            self.pool.keep([x for x, k in zip(parts, at.tolist(), strict=True) if k >= 0])
            at = self.pool.find(parts)
        lacks = np.flatnonzero(at < 0)
        new = [parts[i] for i in lacks.tolist()]
        self._learn_spaced(new)
        at[lacks] = self.pool.find(new)
        odd = (at < 0) | (at == self.pool.place[""])
        at[odd] = self.pool.place[""]
        start = self.pool.off[at]
        out = _gathered(self.pool.ids, start[part], (self.pool.off[at + 1] - start)[part], first)
        whole = {i for i, t in enumerate(texts) if HEAD in t}
        if odd.any():
            whole |= set(np.flatnonzero(np.add.reduceat(odd[part], first[:-1], dtype=np.int64)).tolist())
        for i, x in zip(sorted(whole), self._each([texts[i] for i in sorted(whole)]), strict=True):
            out[i] = x
        return out

    def _split(self, texts):
        parts, part, first = _cut([t.replace("\n", " ").replace("\t", " ").replace("\r", " ") for t in texts])
        self.parts[""] = b""
        ids, lacks = self._known(parts)
        self.parts[""] = b""
        self._learn(self.parts, {parts[i] for i in lacks}.difference([""]), "", self.last, True)
        for i in lacks:
            ids[i] = self.parts[parts[i]]
        return _joined(ids, part, first)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    held = worker_state("tokens")
    if path not in held:
        held[path] = Encoder(path)
    return held[path]
