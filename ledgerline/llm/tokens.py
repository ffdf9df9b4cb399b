"""Token ids of whole texts by a public tokenizer, with a word cache per Python worker.

In byte-level BPE a word together with the space before it is encoded without
regard to its neighbours. A text whose only separators are single spaces and
single line ends is therefore the concatenation of its words' ids; words are
encoded by the tokenizer once and looked up afterwards. Any other text, and
any that holds one of the tokenizer's added tokens, is encoded as a whole.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per worker, and bytes of text worked on at a time.
CACHED_WORDS = 600_000
STEP_BYTES = 8_000_000
#: Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _KEPT)}
SPACE_LETTER = chr(BYTE_LETTERS[32])
LATIN_END = "\u0250"
_encoders: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids must fit 16 bits")
        self.cache: dict[str, bytes] = {}
        self.feed = self._ids("\n").tobytes()
        self.line_end = len(self.feed) // 2
        layout = json.loads(self.tokenizer.to_str())
        # their strings in a text are tokens of their own, wherever they stand
        self.added = [x["content"] for x in layout.get("added_tokens") or []]
        # a byte-level BPE that splits at words: a word of letters is one piece, which its model takes as it is
        self.latin_words = (layout["model"]["type"] == "BPE" and layout["normalizer"] is None
                            and layout["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False,
                                                            "trim_offsets": True, "use_regex": True})

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """uint16 ids of each text, in order."""
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, done + STEP_BYTES)))
            yield from self._step(texts.slice(at, stop - at))
            at = stop

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """ids of words as bytes. Full stops and commas after a letter or digit are pieces of their own."""
        stems = {}
        for word in words:
            stem = word.rstrip(".,")
            stems[word] = stem if stem != word and stem[-1:].isalnum() else word
        distinct = set(stems.values())
        new = [stem for stem in distinct if stem not in self.cache]
        ids = {stem: self.cache[stem] for stem in distinct - set(new)}
        if self.latin_words:
            tokenize = self.tokenizer.model.tokenize
            rest = []
            for w in new:
                core = w[1:] if w[0] == "\n" else w
                if core.isalpha() and max(core) < LATIN_END:  # one piece for the model, with the space before it
                    piece = core if core.isascii() else core.encode().decode("latin-1").translate(BYTE_LETTERS)
                    if w is core:
                        ids[w] = array("H", [t.id for t in tokenize(SPACE_LETTER + piece)]).tobytes()
                    else:
                        ids[w] = self.feed + array("H", [t.id for t in tokenize(piece)]).tobytes()
                else:
                    rest.append(w)
        else:
            rest = new
        found = self.tokenizer.encode_batch_fast([w if w[0] == "\n" else " " + w for w in rest],
                                                 add_special_tokens=False)
        ids.update((w, array("H", x.ids).tobytes()) for w, x in zip(rest, found, strict=True))
        out = {stem: ids[stem] for stem in new}
        tails: dict[str, bytes] = {}
        for word, stem in stems.items():
            if word is not stem:
                tail = word[len(stem):]
                if tail not in tails:
                    tails[tail] = self._ids(tail).tobytes()
                out[word] = ids[stem] + tails[tail]
            elif word not in out:
                out[word] = ids[word]
        return out

    def _step(self, texts: pa.Array) -> Iterator[np.ndarray]:
        # a line end at the start makes the first word one like those after a line end
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(lines, " ")
        coded = parts.flatten().dictionary_encode()
        words, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(self.cache.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        odd = np.zeros(len(words), bool)
        fresh = self._words({words[i] for i in missing if _one_word(words[i])})
        for i in missing:
            found[i] = fresh.get(words[i], b"")
            odd[i] = words[i] not in fresh
        if len(self.cache) < CACHED_WORDS:
            self.cache.update(fresh)

        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 2
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        ids = np.frombuffer(b"".join(found), np.uint16)
        each = lengths[at]
        ends = np.cumsum(each)
        source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - each), each)
        ids, ends = ids[source], np.concatenate([[0], ends])
        bounds = parts.offsets.to_numpy()
        has_odd = np.add.reduceat(odd[at], bounds[:-1] - bounds[0]) > 0
        for content in self.added:
            has_odd |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False).astype(bool)
        for i, whole in enumerate(has_odd.tolist()):
            if whole:
                yield self._ids(texts[i].as_py())
            else:
                lo, hi = ends[bounds[i] - bounds[0]], ends[bounds[i + 1] - bounds[0]]
                yield ids[lo + self.line_end:hi]


def _one_word(part: str) -> bool:
    """Nothing but one word, after a line end at most."""
    word = part[1:] if part[:1] == "\n" else part
    return word.split() == [word]
