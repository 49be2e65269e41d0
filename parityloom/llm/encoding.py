"""Token ids by a file of the tokenizers library, each distinct chunk once.

A text is cut at single spaces between two characters that are no white space, and
before single line feeds. The pre-tokenizers this is used for never put characters from
both sides of such a cut in one token, so the ids of the chunks, joined, are the ids of
the text. For the same reason a word and the ASCII marks after it are learned apart.
For any other tokenizer file the texts are encoded whole.

The added tokens of the file (such as an end-of-text mark) that stand in a text get
their own ids, as the library does by itself; or, with literal, those of their
characters. The library takes added tokens out first and encodes what is between
them apart, so a text is cut around them.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from functools import lru_cache

import numpy as np

from .common import runs

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: White space but for the space and the line feed.
_ODD = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_FIRST = "^ ^"
#: How byte-level tokens write a space.
_SPACE = "\u0120"
#: They end a run of letters, and none of them combines with a letter.
_MARKS = string.punctuation
#: Chunks that are remembered; beyond it, the memory is emptied. Results never
#: depend on it.
REMEMBERED = 1_000_000
#: Chunks longer than this are encoded each time.
LONGEST_REMEMBERED = 60


def _regular(text: str) -> bool:
    """Every space stands between two characters that are no white space."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return not any(c in text for c in _ODD)


def _cut_of(config: dict) -> str:
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "space stays"
    steps = pre.get("pretokenizers") or [{}]
    norms = {n["type"] for n in (norm or {}).get("normalizers", [])}
    apart = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    plain = all(s.get("type") == "ByteLevel" and not s.get("use_regex") and not s.get("add_prefix_space") for s in steps[1:])
    if apart and plain and norms <= {"NFC", "Replace", "Lowercase"} and r"[^\s" in json.dumps(steps[0]).replace("\\\\", "\\"):
        return "space goes"
    return "whole"


def _apart(added: list[dict]) -> bool:
    """Each added token is found as it stands, in any surroundings, and has no white space."""
    return not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] or re.search(r"\s", a["content"]) for a in added)


class Encoder:
    """Serialised ids (little-endian unsigned 32-bit) of texts."""

    def __init__(self, path: str, literal: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.cut, added = _cut_of(config), [] if literal else config.get("added_tokens") or []
        if not _apart(added):
            self.cut = "whole"
        self.added = {a["content"]: array("I", [a["id"]]).tobytes() for a in added}
        # the longest of those that start at one place, as in the library
        self.around = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        vocabulary, suffix = self.tokenizer.get_vocab(), (config.get("model") or {}).get("end_of_word_suffix")
        self.edge = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self.edge[[i for t, i in vocabulary.items() if (t.startswith(_SPACE) if self.cut == "space stays" else suffix and t.endswith(suffix))]] = True
        #: Ids of runs of marks that follow a word.
        self.tails: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of each of some words after a space, encoded as one text, which is cheaper.

        Where the space stays it is in the first token of each word alone; where it goes,
        the last token of each word has the suffix.
        """
        e = self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0]
        ids = np.array(e.ids, "<u4")
        at = np.flatnonzero(self.edge[ids])
        if len(at) != len(words):
            return self._ids([" " + w for w in words])
        cuts = (4 * (np.append(at, len(ids)) if self.cut == "space stays" else np.append(0, at + 1))).tolist()
        out = ids.tobytes()
        return [out[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    def _chunks(self, text: str) -> list[str]:
        # two line feeds may be one token
        fed = text if "\n\n" in text else text.replace("\n", " \n")
        if self.cut == "space goes":
            return fed.split(" ")
        parts = fed.split(" ") if _regular(text) else _BETWEEN.split(text)
        # the first chunk has no space before it; no other chunk can start like this
        parts[0] = _FIRST + parts[0]
        return parts

    def _bare(self, chunk: str) -> str:
        """The text that a chunk stands for."""
        if chunk.startswith(_FIRST):
            return chunk[len(_FIRST) :]
        return chunk if self.cut == "space goes" or chunk[:1] == "\n" else " " + chunk

    def _learn(self, chunks: set[str]) -> None:
        """Remember the ids of new chunks; a word and the marks after it apart."""
        known, marked, words, other = self.known, [], set(), []
        for c in chunks:
            word = c.rstrip(_MARKS)
            if not word.isalpha() or len(c) >= LONGEST_REMEMBERED:
                other.append(c)
            elif len(word) == len(c):
                words.add(c)
            # letters that no lower-casing ends with a mark of its own, as it does the dotted capital i
            elif word[-1] < "\u0250" and word[-1] != "\u0130":
                marked.append((c, word, c[len(word) :]))
                if word not in known:
                    words.add(word)
            else:
                other.append(c)
        plain = list(words)
        for i in range(0, len(plain), 1000):
            some = plain[i : i + 1000]
            known.update(zip(some, self._together(some), strict=True))
        for i in range(0, len(other), 1000):
            some = other[i : i + 1000]
            known.update(zip(some, self._ids([self._bare(c) for c in some]), strict=True))
        tails = self.tails
        new = list({t for _, _, t in marked}.difference(tails))
        tails.update(zip(new, self._ids(new), strict=True))
        known.update((c, known[word] + tails[t]) for c, word, t in marked)

    def _run(self, texts: list[str]) -> list[bytes]:
        cut = [self._chunks(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        self._learn(new)
        get = self.known.__getitem__
        out = [b"".join(map(get, parts)) for parts in cut]
        for chunk in [c for c in new if len(c) > LONGEST_REMEMBERED]:
            del self.known[chunk]
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.tails.clear()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.cut == "whole":
            return [x for t in texts for x in self._ids([t])]
        # texts and added tokens in turn
        parts = [self.around.split(t) if any(a in t for a in self.added) else [t] for t in texts]
        between = [p for ps in parts for p in ps[::2]]
        out: list[bytes] = []
        for a, b in runs(between):
            out += self._run(between[a:b])
        ids = iter(out)
        return [b"".join(self.added[p] if i % 2 else next(ids) for i, p in enumerate(ps)) for ps in parts]


@lru_cache(maxsize=4)
def encoder(path: str, literal: bool = True) -> Encoder:
    """One encoder a worker process, file and way."""
    return Encoder(path, literal)
